"""Stored months: the same report, and only changed months are read."""

import json
import os
from dataclasses import replace
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_report import expect_equal
from world import random_world, spark_tables

from sitecharge.operators.jobs import first_starts, job_totals, turned_on_dates
from sitecharge.operators.periods import FULL_DAY, MIDNIGHT, START_MONTH, Period, year_to_date
from sitecharge.plans import incremental
from sitecharge.plans.report import ReportOptions, build_report
from sitecharge.plans.staging import Staging
from sitecharge.sources.layout import by_month, month_marks, write_jobs_by_month
from sitecharge.sources.sinks import create_report, read_report

MARCH = date(2000, 3, 15)
JANUARY, FEBRUARY = date(2000, 1, 1), date(2000, 2, 1)


def rows_of(df):
    return sorted(map(repr, df.collect()))


def spoilt(folder: Path, month: date):
    """Files of the same names, sizes and times that nobody can read."""
    for path in (folder / f"start_month={month.isoformat()}").glob("*.parquet"):
        was = path.stat()
        path.write_bytes(b"?" * was.st_size)
        os.utime(path, ns=(was.st_atime_ns, was.st_mtime_ns))
        (path.parent / f".{path.name}.crc").unlink(missing_ok=True)


def test_report_from_stored_months(spark, tmp_path):
    world = random_world(51)
    tables = spark_tables(spark, world)
    folder, store = tmp_path / "jobs", str(tmp_path / "store")
    periods = year_to_date(MARCH)
    early = tables.jobs.where(F.col("actual_start_at") < FEBRUARY)
    write_jobs_by_month(early, str(folder))
    assert incremental.refresh(tables, str(folder), store) == [JANUARY]
    assert incremental.refresh(tables, str(folder), store) == []
    expected = rows_of(turned_on_dates(replace(tables, jobs=early)))
    assert rows_of(turned_on_dates(tables, incremental.stored_starts(spark, store))) == expected

    # January is not read again
    write_jobs_by_month(tables.jobs, str(folder), months=[FEBRUARY, date(2000, 3, 1)])
    marks = month_marks(spark, str(folder))
    spoilt(folder, JANUARY)
    assert month_marks(spark, str(folder)) == marks
    found = incremental.incremental_report(tables, str(folder), store, periods, Staging(spark))
    assert rows_of(found) == rows_of(build_report(tables, periods, Staging(spark)))
    assert rows_of(turned_on_dates(tables, incremental.stored_starts(spark, store))) == rows_of(turned_on_dates(tables))

    # a month that loses its jobs
    write_jobs_by_month(tables.jobs.limit(0), str(folder), months=[FEBRUARY])
    assert incremental.refresh(tables, str(folder), store) == [FEBRUARY]
    left = replace(tables, jobs=tables.jobs.where(F.trunc("actual_start_at", "month") != FEBRUARY))
    found = incremental.incremental_report(left, str(folder), store, periods, Staging(spark))
    assert rows_of(found) == rows_of(build_report(left, periods, Staging(spark)))


def test_other_rule_for_the_last_day(spark, tmp_path):
    tables = spark_tables(spark, random_world(52))
    folder, store = str(tmp_path / "jobs"), str(tmp_path / "store")
    write_jobs_by_month(tables.jobs, folder)
    every = incremental.refresh(tables, folder, store)
    assert incremental.refresh(tables, folder, store, FULL_DAY) == every
    options = ReportOptions(end=FULL_DAY)
    periods = year_to_date(MARCH)
    found = incremental.incremental_report(tables, folder, store, periods, Staging(spark), options)
    assert rows_of(found) == rows_of(build_report(tables, periods, Staging(spark), options))
    with pytest.raises(ValueError, match="whole months"):
        incremental.stored_totals(spark, store, [Period(JANUARY, date(2000, 1, 30))])


@pytest.mark.parametrize("end", [MIDNIGHT, FULL_DAY])
def test_jobs_are_folded_and_moved_once(spark, tmp_path, monkeypatch, end):
    """One table with one exchange, whether the months are folded together or each alone."""
    tables = spark_tables(spark, random_world(55))
    folder = str(tmp_path / "jobs")
    write_jobs_by_month(tables.jobs, folder)
    plans, write = [], incremental.write_months

    def noting(rows, path, months):
        plans.append(rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        write(rows, path, months)

    monkeypatch.setattr(incremental, "write_months", noting)
    periods = year_to_date(date(2000, 5, 1))
    for most, store in ((1 << 30, str(tmp_path / "together")), (1, str(tmp_path / "alone"))):
        monkeypatch.setattr(incremental, "_RUN_BYTES", most)
        plans.clear()
        changed = incremental.refresh(tables, folder, store, end)
        assert len(changed) > 1 and plans == [1] * (1 if most > 1 else len(changed))
        totals = incremental.stored_totals(spark, store, periods)
        assert totals.columns == job_totals(tables, periods, end).columns
        assert rows_of(totals) == rows_of(job_totals(tables, periods, end))
        months = first_starts(by_month(tables.jobs), START_MONTH)
        assert rows_of(incremental.stored_starts(spark, store)) == rows_of(months.drop(START_MONTH))


def test_store_of_another_layout_is_made_anew(spark, tmp_path):
    tables = spark_tables(spark, random_world(56))
    folder, store = str(tmp_path / "jobs"), str(tmp_path / "store")
    write_jobs_by_month(tables.jobs, folder)
    marks = {m.isoformat(): f"{MIDNIGHT} {mark}" for m, mark in month_marks(spark, folder).items()}
    spark.createDataFrame([(json.dumps(marks),)], "value string").write.text(f"{store}/marks")
    assert [m.isoformat() for m in incremental.refresh(tables, folder, store)] == sorted(marks)
    assert rows_of(turned_on_dates(tables, incremental.stored_starts(spark, store))) == rows_of(turned_on_dates(tables))


def test_run_that_died_before_its_marks(spark, tmp_path, monkeypatch):
    tables = spark_tables(spark, random_world(53))
    folder, store = str(tmp_path / "jobs"), str(tmp_path / "store")
    write_jobs_by_month(tables.jobs, folder)
    incremental.refresh(tables, folder, store)
    doubled = tables.jobs.unionByName(tables.jobs.withColumn("job_id", F.col("job_id") + 10_000))
    write_jobs_by_month(doubled, folder, months=[JANUARY, FEBRUARY])
    write = incremental.write_months

    def dying(rows, path, months):
        if path.endswith("starts"):
            raise RuntimeError("lost")
        write(rows, path, months)

    monkeypatch.setattr(incremental, "write_months", dying)
    with pytest.raises(RuntimeError):
        incremental.refresh(tables, folder, store)
    monkeypatch.undo()
    assert incremental.refresh(tables, folder, store) == [JANUARY, FEBRUARY]


def test_run_incremental(spark, tmp_path):
    world = random_world(54)
    tables = spark_tables(spark, world)
    folder, target = str(tmp_path / "jobs"), str(tmp_path / "report")
    write_jobs_by_month(tables.jobs, folder)
    create_report(spark, target)
    for day in (15, 16):
        incremental.run_incremental(tables, folder, str(tmp_path / "store"), MARCH, target, loaded_at=datetime(2000, 3, day))
    rows = read_report(spark, target)
    assert {r.UPDATED_AT for r in rows.select("UPDATED_AT").distinct().collect()} == {datetime(2000, 3, 16)}
    keyed = {
        ((r.START_DATE, r.END_DATE), (r.COMPANY_ID, r.ACCOUNT_ID, r.SITE_ID)): r.asDict()
        for r in rows.collect()
    }
    expect_equal(keyed, world)
