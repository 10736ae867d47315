"""Partitioned layouts: one file per value, more for large or hot values, never one task for an unbounded value."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import SKETCHED, frequent_values
from ..sources.catalog import create_external_orc
from .files import ROWS_PER_FILE


def _listed(columns: str | list[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _save(
    df: DataFrame, columns: list[str], path: str, fmt: str, mode: str, rows_per_file: int, dynamic: bool = False
) -> None:
    writer = df.write.mode(mode).partitionBy(*columns).option("compression", "snappy")
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", rows_per_file).format(fmt).save(path)


def _value(columns: list[str]) -> Column:
    """The partition value as text: NULLs and several columns included."""
    return F.to_json(F.struct(*columns))


def _spread(df: DataFrame, columns: list[str], files: DataFrame, partitions: int | None) -> DataFrame:
    """Shuffle so that a value sits in one task, a value listed in ``files`` (``_value``, ``_files``) in so many.

    The salt is a function of the row and its input partition: identical rows spread, and a task that
    runs again after a lost executor puts every row where it was. The number of tasks is given, as
    adaptive execution would go by bytes and let one task open all the files.
    """
    spread_key = F.xxhash64(F.spark_partition_id(), *df.columns)
    salt = F.when(F.col("_files") > 1, F.pmod(spread_key, F.col("_files"))).otherwise(F.lit(0))
    tagged = df.withColumn("_own_value", _value(columns)).join(files, F.col("_own_value") == files["_value"], "left")
    tasks = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    moved = tagged.select(*df.columns, salt.alias("_salt")).repartition(tasks, *columns, "_salt")
    return moved.drop("_salt")


def write_by_value(
    df: DataFrame,
    columns: str | list[str],
    path: str,
    rows_per_file: int = ROWS_PER_FILE,
    partitions: int | None = None,
    fmt: str = "orc",
    mode: str = "overwrite",
    dynamic: bool = False,
    count_on: DataFrame | None = None,
    rows_each: float = 1.0,
) -> None:
    """One file per value of ``columns``; a value above ``rows_per_file`` gets as many as it needs.

    The large values come from one sketch over the partition columns of ``count_on``, a narrow table of whose rows each
    stands for about ``rows_each`` of ``df``, or of ``df`` itself, of which only these columns are then computed.
    ``dynamic`` replaces only the partitions that occur in ``df``.
    """
    names = _listed(columns)
    files, tasks = _large_values(df if count_on is None else count_on, names, rows_per_file, rows_each)
    _save(_spread(df, names, files, partitions or tasks), names, path, fmt, mode, rows_per_file, dynamic)


def _large_values(counted: DataFrame, columns: list[str], rows_per_file: int, rows_each: float) -> tuple[DataFrame, int]:
    """The values above ``rows_per_file`` (``_value``) and how many files each needs (``_files``), and the number of tasks:
    the shuffle partitions, or more if these would get more than ``rows_per_file`` rows on average.

    A value with less than one row in about 16,000 is not followed by the sketch and is written by one task, which
    still cuts its files at ``rows_per_file``.
    """
    spark = counted.sparkSession
    total, top = frequent_values(counted, _value(columns), SKETCHED // 2)
    needed = [(value, math.ceil(rows * rows_each / rows_per_file)) for value, rows in top]
    files = spark.createDataFrame([(value, n) for value, n in needed if n > 1], "_value STRING, _files INT")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total * rows_each / rows_per_file))
    return F.broadcast(files), tasks


def write_table_by_value(
    df: DataFrame,
    columns: str | list[str],
    table: str,
    location: str,
    rows_per_file: int = ROWS_PER_FILE,
    partitions: int | None = None,
    count_on: DataFrame | None = None,
    rows_each: float = 1.0,
) -> None:
    """The layout of ``write_by_value`` as a table of the catalogue, which the write tells its partitions.

    A query that names the partitions it wants asks the catalogue for them and opens these folders alone; the other
    folders are not even listed. An insert replaces only the partitions it brings.
    """
    names = _listed(columns)
    stored = [c for c in df.columns if c not in names] + names
    kinds = dict(df.dtypes)
    create_external_orc(
        df.sparkSession, table, ", ".join(f"`{c}` {kinds[c]}" for c in stored), names, location,
        maxRecordsPerFile=rows_per_file,
    )
    files, tasks = _large_values(df if count_on is None else count_on, names, rows_per_file, rows_each)
    _spread(df, names, files, partitions or tasks).select(*stored).write.insertInto(table, overwrite=True)


def write_dynamic(df: DataFrame, columns: list[str], path: str, **options) -> None:
    """Replace only the partitions that occur in ``df``."""
    write_by_value(df, columns, path, dynamic=True, **options)


def write_skew_split(
    df: DataFrame,
    column: str,
    path: str,
    hot: DataFrame,
    hot_files: int = 1,
    rows_per_file: int = ROWS_PER_FILE,
    partitions: int | None = None,
    fmt: str = "orc",
    mode: str = "overwrite",
) -> None:
    """Cold values one file each, the values of ``hot`` ``hot_files`` files each.

    ``hot`` has the values in ``hot_key``; its ``rec_count``, where there is one, raises the number of a
    value's files so that each takes about ``rows_per_file`` rows. One write covers hot and cold, so a
    failed run leaves no half-replaced table and a second run gives the same table. Rows without a value
    keep their own partition.
    """
    files = F.lit(hot_files)
    if "rec_count" in hot.columns:
        files = F.greatest(files, F.ceil(F.col("rec_count") / F.lit(rows_per_file)))
    named = hot.withColumnRenamed("hot_key", column)
    wanted = named.select(_value([column]).alias("_value"), files.cast("int").alias("_files")).dropDuplicates(["_value"])
    _save(_spread(df, [column], wanted, partitions), [column], path, fmt, mode, rows_per_file)


def add_year_month(df: DataFrame, day: Column, prefix: str = "order") -> DataFrame:
    return df.withColumns({f"{prefix}_year": F.year(day), f"{prefix}_month": F.month(day)})


def year_predicates(days: list[str], day: str = "order_date", prefix: str = "order") -> Column:
    """``day IN days`` plus the years that follow from it, which prune the upper directories."""
    parsed = [date.fromisoformat(d) for d in days]
    return F.col(day).isin(parsed) & F.col(f"{prefix}_year").isin(sorted({d.year for d in parsed}))


def date_predicates(days: list[str], day: str = "order_date", prefix: str = "order") -> Column:
    """``day IN days`` plus the year and month predicates that follow from it and prune directories."""
    parsed = [date.fromisoformat(d) for d in days]
    months = F.lit(False)
    for year, month in sorted({(d.year, d.month) for d in parsed}):
        months = months | ((F.col(f"{prefix}_year") == year) & (F.col(f"{prefix}_month") == month))
    return F.col(day).isin(parsed) & months
