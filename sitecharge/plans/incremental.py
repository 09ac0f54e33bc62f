"""Months that are kept: what a month's jobs add up to is stored, and computed again only when its files changed.

Per month the store has the totals per (site, work order) and the first starts, both long before any price: charges,
scenarios, units and owners are joined anew in each run, so a change of theirs needs no bookkeeping. First starts are
stored per month too, and not as one running minimum, so that a month that is written again may lose jobs. Both are
columns of one table, so that the jobs are folded and moved once.

Marks of the months are written last. A run that dies before that leaves months whose marks do not fit, which the
next run computes again; what it replaced in the meantime were whole months.
"""

from __future__ import annotations

import calendar
import json
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecharge.operators.jobs import month_sums, starts_of_months, totals_of_months
from sitecharge.operators.periods import START_MONTH, Period, months_of, year_to_date
from sitecharge.plans.report import ReportOptions, build_report, stamp
from sitecharge.plans.staging import Staging
from sitecharge.sources.layout import (
    month_marks,
    months_by_size,
    read_jobs_by_month,
    read_months,
    write_months,
)
from sitecharge.sources.sinks import write_report
from sitecharge.sources.tables import Tables, typed

_SUMS = "totals_and_starts"  # the store's table; part of the marks, so that a store laid out otherwise is made anew
# Months are folded together while their files take this much: what one task folds then lies in few of them, and is
# written as it is, without being dealt by month once more.
_RUN_BYTES = 256 << 20


def _month(first: date) -> Period:
    return Period(first, first.replace(day=calendar.monthrange(first.year, first.month)[1]))


def _marks_path(store: str) -> str:
    return f"{store}/marks"


def _known_marks(spark: SparkSession, store: str) -> dict[str, str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(_marks_path(store))
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return {}
    return json.loads("".join(row.value for row in spark.read.text(_marks_path(store)).collect()) or "{}")


def refresh(tables: Tables, jobs_path: str, store: str, end: str = ReportOptions.end) -> list[date]:
    """Bring the store up to date with the jobs laid out by month below ``jobs_path``; the months that changed.

    Only these are read, small months together. ``end`` is the rule for the last day of a month; another one than
    last time makes all months count as changed.
    """
    spark = tables.jobs.sparkSession
    marks = {m.isoformat(): f"{_SUMS} {end} {mark}" for m, mark in month_marks(spark, jobs_path).items()}
    known = _known_marks(spark, store)
    changed = sorted(date.fromisoformat(m) for m in {*marks, *known} if marks.get(m) != known.get(m))
    if not changed:
        return []
    jobs = typed(read_jobs_by_month(spark, jobs_path), "jobs")
    for months in months_by_size(spark, jobs_path, changed, _RUN_BYTES):
        sums = month_sums(jobs.where(F.col(START_MONTH).isin(months)), end)
        write_months(sums, f"{store}/{_SUMS}", months)
    written = spark.createDataFrame([(json.dumps(marks),)], "value string")
    written.coalesce(1).write.mode("overwrite").text(_marks_path(store))
    return changed


def stored_totals(spark: SparkSession, store: str, periods: list[Period]) -> DataFrame:
    """``job_totals`` of ``periods``, which have to be whole months."""
    if any(p != _month(p.start) for p in periods):
        raise ValueError("stored totals are of whole months")
    sums = read_months(spark, f"{store}/{_SUMS}")
    return totals_of_months(sums.where(F.col(START_MONTH).isin(months_of(periods))))


def stored_starts(spark: SparkSession, store: str) -> DataFrame:
    """``first_starts`` of all time: one row per site, work order and month."""
    return starts_of_months(read_months(spark, f"{store}/{_SUMS}")).drop(START_MONTH)


def incremental_report(
    tables: Tables,
    jobs_path: str,
    store: str,
    periods: list[Period],
    staging: Staging,
    options: ReportOptions = ReportOptions(),
) -> DataFrame:
    """The report rows of ``periods``, whole months, from the refreshed store: only changed months of jobs are read."""
    spark = tables.jobs.sparkSession
    refresh(tables, jobs_path, store, options.end)
    sums = stored_totals(spark, store, periods)
    return build_report(tables, periods, staging, options, sums, stored_starts(spark, store))


def run_incremental(
    tables: Tables,
    jobs_path: str,
    store: str,
    as_of: date,
    target: str,
    mode: str = "replace_period",
    options: ReportOptions = ReportOptions(),
    loaded_at: datetime | None = None,
) -> None:
    """``plans.report.run_report`` over the store."""
    staging = Staging(tables.jobs.sparkSession)
    try:
        periods = year_to_date(as_of)
        report = incremental_report(tables, jobs_path, store, periods, staging, options)
        write_report(stamp(staging.store(report, "report"), loaded_at), target, mode, periods)
    finally:
        staging.clear()
