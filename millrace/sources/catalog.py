"""Catalog tables: external delimited tables, partitioned ORC tables, reads by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    spark.sql(f"USE {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def create_external_csv(
    spark: SparkSession, table: str, schema: str, location: str, sep: str = "|", header: bool = False
) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING csv "
        f"OPTIONS (sep '{sep}', header '{str(header).lower()}') LOCATION '{location}'"
    )


def create_external_orc(
    spark: SparkSession, table: str, schema: str, partition_columns: list[str], location: str, **options
) -> None:
    """``schema`` holds every column; the partition columns are listed again by name. An overwrite of
    the table replaces only the partitions it brings, which is a property of the table here, as are ``options``."""
    more = "".join(f", {name} '{value}'" for name, value in options.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING orc "
        f"OPTIONS (`orc.compress` 'SNAPPY', partitionOverwriteMode 'dynamic'{more}) PARTITIONED BY ({', '.join(partition_columns)}) LOCATION '{location}'"
    )
