"""The report table: a folder of Parquet files or a catalog table, partitioned by period.

The target has to exist. ``append`` adds rows, so a second run of a period shows it twice, told
apart by UPDATED_AT; ``replace_period`` overwrites exactly the periods of the run, a period being its first and last
day: one that has no rows any more is emptied, and others that overlap it stay as they are.

A load into a folder is seen whole or not at all. Its files go to a folder of their own (``load=...``), and one small
file below ``_commits`` then names the partitions that count from now on. ``read_report`` reads what the last such file
names, so a load that dies on the way leaves the rows as they were. What no commit names any more, ``remove_unused``
deletes. Catalog tables are overwritten partition by partition, and emptied ones dropped after that: Parquet tables of a
catalog have no commit for both.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from datetime import timedelta
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitecharge.functions.dates import datetime_text
from sitecharge.operators.periods import Period
from sitecharge.plans.staging import Staging
from sitecharge.sources.schemas import (
    ID_COLUMNS,
    LOAD_STAMP,
    MONEY_COLUMNS,
    PERCENT_COLUMNS,
    REPORT_COLUMNS,
)

PARTITION = ["START_DATE", "END_DATE"]
_SCHEMA = "_schema"  # of a folder target, as an empty table; readers pass such names over
_COMMITS = "_commits"
_LOAD = "load"
MODES = ("append", "replace_period")


def report_schema(id_type: str = "bigint", text_dates: bool = False) -> T.StructType:
    kinds = {name: id_type for name in ID_COLUMNS}
    kinds.update({name: "double" for name in PERCENT_COLUMNS + MONEY_COLUMNS})
    kinds.update({"START_DATE": "date", "END_DATE": "date"})
    kinds.update({"DATE_OV_TURNED_ON": "timestamp_ntz", LOAD_STAMP: "timestamp_ntz"})
    if text_dates:
        kinds.update({name: "string" for name in _DATES})
    kinds.update({"TOTAL_NUMBER_OF_PROJECTS": "bigint", "TOTAL_NUM_JOBS": "bigint"})
    return T.StructType.fromDDL(
        ", ".join(f"{name} {kinds[name]}" for name in [*REPORT_COLUMNS, LOAD_STAMP])
    )


_DATES = ["START_DATE", "END_DATE", "DATE_OV_TURNED_ON", LOAD_STAMP]


def render_dates(report: DataFrame) -> DataFrame:
    """Dates and timestamps as 'YYYY-MM-DD HH:MM:SS' text."""
    return report.withColumns(
        {name: datetime_text(F.col(name)) for name in _DATES if name in report.columns}
    )


def _is_path(target: str) -> bool:
    return "/" in target


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def create_report(
    spark: SparkSession, target: str, id_type: str = "bigint", text_dates: bool = False
) -> None:
    """Make an empty report table with ids of a type, and dates as dates or as text."""
    empty = spark.createDataFrame([], report_schema(id_type, text_dates))
    if _is_path(target):
        empty.write.mode("overwrite").parquet(f"{target}/{_SCHEMA}")
        return
    empty.write.partitionBy(*PARTITION).format("parquet").saveAsTable(target)


def _names(spark: SparkSession, path: str, start: str = "") -> list[str]:
    files, where = _folder(spark, path)
    found = [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []
    return [name for name in found if name.startswith(start)]


def _partitions(spark: SparkSession, target: str, load: str = "") -> list[list[str]]:
    """[load, folder of the start, folder of the end] of what a load wrote; files without a load lie in the target itself."""
    below = f"{target}/{_LOAD}={load}" if load else target
    return [
        [load, start, end]
        for start in _names(spark, below, f"{PARTITION[0]}=")
        for end in _names(spark, f"{below}/{start}", f"{PARTITION[1]}=")
    ]


def _state(spark: SparkSession, target: str) -> tuple[int, list[list[str]]]:
    """Number of the last commit, and the partitions that it names; a target without commits has what lies there."""
    numbers = [int(n[:-5]) for n in _names(spark, f"{target}/{_COMMITS}") if re.fullmatch(r"\d+\.json", n)]
    for number in sorted(numbers, reverse=True):
        files, where = _folder(spark, f"{target}/{_COMMITS}/{number:08d}.json")
        stream = files.open(where)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        if text.endswith("\n"):  # else its writer is not done, or died
            return max(numbers), json.loads(text)
    return max(numbers, default=0), _partitions(spark, target)


def _commit(spark: SparkSession, target: str, change) -> None:
    """Write the next commit, ``change`` of the last one; if another load was faster, on top of that."""
    while True:
        number, live = _state(spark, target)
        files, where = _folder(spark, f"{target}/{_COMMITS}/{number + 1:08d}.json")
        try:
            stream = files.create(where, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in str(error.java_exception):
                continue
            raise
        stream.write(bytearray(f"{json.dumps(change(live))}\n", "utf-8"))
        stream.close()
        return


def remove_unused(spark: SparkSession, target: str, older_than: timedelta = timedelta(days=7)) -> list[str]:
    """Delete loads into a folder that no longer count and have not been touched for a while; their names."""
    used = {load for load, _, _ in _state(spark, target)[1]}
    limit = (time.time() - older_than.total_seconds()) * 1000
    gone = []
    for name in _names(spark, target, f"{_LOAD}="):
        files, where = _folder(spark, f"{target}/{name}")
        if name.partition("=")[2] not in used and files.getFileStatus(where).getModificationTime() <= limit:
            files.delete(where, True)
            gone.append(name)
    return gone


def read_report(spark: SparkSession, target: str) -> DataFrame:
    """All rows of committed loads."""
    names = report_schema().names
    if not _is_path(target):
        return spark.table(target).select(*names)
    schema = _target_schema(spark, target)
    rows = spark.createDataFrame([], schema).select(*names)
    _, live = _state(spark, target)
    # files of a load lie one folder deeper than those without
    for deep in (False, True):
        paths = [f"{target}/{_LOAD}={load}/{start}/{end}" if deep else f"{target}/{start}/{end}" for load, start, end in live if bool(load) == deep]
        if paths:
            rows = rows.unionByName(spark.read.schema(schema).option("basePath", target).parquet(*paths).select(*names))
    return rows


def _target_schema(spark: SparkSession, target: str) -> T.StructType:
    """Columns of an existing target."""
    if not _is_path(target):
        if not spark.catalog.tableExists(target):
            raise ValueError(f"report table {target} does not exist")
        return spark.table(target).schema
    files, where = _folder(spark, target)
    if not files.exists(where):
        raise ValueError(f"report folder {target} does not exist")
    if files.exists(_folder(spark, f"{target}/{_SCHEMA}")[1]):
        return spark.read.parquet(f"{target}/{_SCHEMA}").schema
    return report_schema()


def _fitted(report: DataFrame, target: str) -> DataFrame:
    """The report with the id types and column order of the target, which has to match otherwise."""
    schema = _target_schema(report.sparkSession, target)
    ids = {f.name: f.dataType for f in schema.fields if f.name in ID_COLUMNS}
    cast = report.withColumns({name: F.col(name).cast(kind) for name, kind in ids.items()})
    wanted = {f.name: f.dataType for f in cast.schema.fields}
    found = {f.name: f.dataType for f in schema.fields}
    if wanted != found:
        odd = sorted(n for n in {*wanted, *found} if wanted.get(n) != found.get(n))
        raise ValueError(f"columns of {target} differ from the report: {', '.join(odd)}")
    # a table inserts by place, its partition columns being the last
    return cast.select(*[n for n in schema.names if n not in PARTITION], *PARTITION)


def _own_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark``, in which an overwrite replaces the partitions of the new rows only.

    Inserts into catalog tables take this from the session, not from writer options.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return own


def _emptied(rows: DataFrame, periods: list[Period]) -> list[tuple[str, str]]:
    """Periods of the run, as partition values, that have no rows; as many as periods at most are collected."""
    text = isinstance(rows.schema[PARTITION[0]].dataType, T.StringType)
    shown = " 00:00:00" if text else ""
    found = rows.select(*(F.col(c).cast("string") for c in PARTITION)).distinct()
    written = {tuple(row) for row in found.collect()}
    every = [(f"{p.start.isoformat()}{shown}", f"{p.end.isoformat()}{shown}") for p in periods]
    return [period for period in every if period not in written]


def _drop_partition(spark: SparkSession, target: str, start: str, end: str) -> None:
    named = f"{PARTITION[0]} = '{start}', {PARTITION[1]} = '{end}'"
    spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({named})")


def _load_folder(rows: DataFrame, target: str, replace: bool, periods: list[Period]) -> None:
    spark, load = rows.sparkSession, uuid.uuid4().hex
    rows.write.partitionBy(*PARTITION).parquet(f"{target}/{_LOAD}={load}")
    new = _partitions(spark, target, load)
    shown = " 00:00:00" if isinstance(rows.schema[PARTITION[0]].dataType, T.StringType) else ""
    days = [(f"{p.start.isoformat()}{shown}", f"{p.end.isoformat()}{shown}") for p in periods]
    replaced = {tuple(names) for _, *names in new}
    replaced |= {tuple(f"{c}={day}" for c, day in zip(PARTITION, both)) for both in days}
    replaced = {tuple(map(unquote, names)) for names in replaced} if replace else set()
    _commit(spark, target, lambda live: [p for p in live if tuple(map(unquote, p[1:])) not in replaced] + new)


def _load_table(rows: DataFrame, target: str, replace: bool, periods: list[Period]) -> None:
    spark = rows.sparkSession
    staging = Staging(spark)
    try:
        stored = staging.store(rows, "report")
        own = _own_session(spark)
        there = own.read.schema(stored.schema).parquet(*stored.inputFiles()) if stored.inputFiles() else None
        if there is not None:
            there.write.insertInto(target, overwrite=replace)
        for start, end in _emptied(stored, periods) if replace else []:
            _drop_partition(spark, target, start, end)
        spark.catalog.refreshTable(target)
    finally:
        staging.clear()


def write_report(
    report: DataFrame, target: str, mode: str = "append", periods: list[Period] = ()
) -> None:
    """Write stamped report rows; ``periods`` are those of the run, of which ``replace_period``
    empties the ones without rows."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    rows = _fitted(report, target)
    load = _load_folder if _is_path(target) else _load_table
    load(rows, target, mode == "replace_period", list(periods))
