"""Writes into catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def insert_overwrite(df: DataFrame, table: str, partition_columns: list[str]) -> None:
    """``INSERT OVERWRITE ... PARTITION`` by column name. Only the partitions at hand are replaced when
    the table says so (catalog.create_external_orc) or the session has dynamic overwrite.

    The rows arrive as they are distributed, so many tasks may add a file to one partition;
    ``layout.write_by_value`` is the form with few files.
    """
    view = f"incoming_{table.replace('.', '_')}"
    df.createOrReplaceTempView(view)
    spark = df.sparkSession
    names = [c for c in df.columns if c not in partition_columns] + partition_columns
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({', '.join(partition_columns)}) "
        f"SELECT {', '.join(names)} FROM {view}"
    )
    spark.catalog.dropTempView(view)
