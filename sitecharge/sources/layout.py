"""Layouts of the large tables: jobs in folders by month, and tables in buckets of a join key.

Both are made once and read often. Months that a run does not ask for are neither listed nor read, as the
periods of a run are literals (``operators.periods.in_months``); tables in equal buckets are joined where they lie.
"""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecharge.operators.periods import START_MONTH

FILES_PER_MONTH = 8
_SCHEMA = "_schema"  # an empty table; readers pass such names over


def by_month(jobs: DataFrame) -> DataFrame:
    """Jobs with the first day of the month they started in; NULL where they never did."""
    return jobs.withColumn(START_MONTH, F.trunc("actual_start_at", "month"))


def _names(spark: SparkSession, folder: str) -> set[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in files.listStatus(where)} if files.exists(where) else set()


def write_months(rows: DataFrame, path: str, months: list[date] | None = None) -> None:
    """Write rows with a START_MONTH below ``path``, a folder per month.

    Without ``months`` the whole layout is written anew; with them, just these are replaced, and emptied where there
    are no rows: restrict ``rows`` to them beforehand. ``rows`` is read once: a write names its files anew, so a
    folder that still has one of its old files got no rows.
    """
    spark = rows.sparkSession
    how = "static" if months is None else "dynamic"
    folders = [f"{path}/{START_MONTH}={month.isoformat()}" for month in set(months or [])]
    before = {folder: _names(spark, folder) for folder in folders}
    writer = rows.write.partitionBy(START_MONTH).mode("overwrite")
    writer.option("partitionOverwriteMode", how).option("compression", "zstd").parquet(path)
    rows.limit(0).drop(START_MONTH).write.mode("overwrite").parquet(f"{path}/{_SCHEMA}")
    for folder in folders:
        if before[folder] & _names(spark, folder):
            where = spark._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def read_months(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``write_months``, with their month as a column that prunes folders."""
    columns = spark.read.parquet(f"{path}/{_SCHEMA}").schema
    return spark.read.schema(columns.add(START_MONTH, "date")).parquet(path)


def write_jobs_by_month(
    jobs: DataFrame,
    path: str,
    months: list[date] | None = None,
    files: int = FILES_PER_MONTH,
    laid_out: bool = False,
) -> None:
    """Write ``jobs`` below ``path``, a folder per month; with ``months``, just these are replaced, or emptied.

    A month is dealt over ``files`` tasks by a hash of its rows, so that one with very many jobs is not
    the work of one task. ``laid_out`` says that ``jobs`` are read from another layout by month
    (``read_jobs_by_month``): its files are dealt already, and their rows are not moved again.
    """
    rows = jobs if laid_out else by_month(jobs)
    if months is not None:
        rows = rows.where(F.col(START_MONTH).isin(months))
    if not laid_out:
        dealt = F.pmod(F.xxhash64("job_id", "work_order_id", "created_at"), F.lit(files))
        rows = rows.repartition(START_MONTH, dealt)
    write_months(rows, path, months)


def read_jobs_by_month(spark: SparkSession, path: str) -> DataFrame:
    """The jobs of ``write_jobs_by_month``, with their month as a column that operators prune by."""
    return read_months(spark, path)


def _month_files(spark: SparkSession, path: str) -> dict[date, list]:
    """Month -> what its folder lists, for the months of a layout that have files.

    The driver lists folders, as Spark does for any scan.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for folder in files.listStatus(where) if files.exists(where) else []:
        name, _, value = folder.getPath().getName().partition("=")
        if name != START_MONTH or value.startswith("__"):  # Spark's name for no month
            continue
        listed = list(files.listStatus(folder.getPath()))
        if any(not s.getPath().getName().startswith(("_", ".")) for s in listed):
            found[date.fromisoformat(value)] = listed
    return found


def month_marks(spark: SparkSession, path: str) -> dict[date, str]:
    """Month -> a mark of its files (names, sizes, times), for the months of a layout that has them.

    A month that was written again has another mark.
    """
    marks = {}
    for month, listed in _month_files(spark, path).items():
        texts = sorted(f"{s.getPath().getName()} {s.getLen()} {s.getModificationTime()}" for s in listed)
        marks[month] = hashlib.sha256("\n".join(texts).encode()).hexdigest()
    return marks


def months_by_size(spark: SparkSession, path: str, months: list[date], most: int) -> list[list[date]]:
    """``months`` in order, in runs whose files in the layout take ``most`` bytes together; a larger month is a run alone."""
    sizes = {month: sum(s.getLen() for s in listed) for month, listed in _month_files(spark, path).items()}
    runs: list[list[date]] = []
    room = -1
    for month in sorted(months):
        room -= sizes.get(month, 0)
        if room < 0:
            runs.append([])
            room = max(0, most - sizes.get(month, 0))
        runs[-1].append(month)
    return runs


def write_in_buckets(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Catalog table ``table`` in ``buckets`` buckets of ``key``, one sorted file each; rows without a key are left out.

    They match nothing and would all lie in one bucket: keep them in a table of their own
    (``operators.pricing.merged_in_buckets`` takes both).
    """
    rows = df.where(F.col(key).isNotNull()).repartition(buckets, key)
    writer = rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)
