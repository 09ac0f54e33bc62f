"""Report targets: folder and catalog table, both modes."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from world import base_world, job, random_world, spark_tables

from sitecharge.sources import sinks
from sitecharge.plans.report import build_report, run_report, stamp
from sitecharge.plans.staging import Staging
from sitecharge.operators.periods import Period, year_to_date
from sitecharge.sources.schemas import LOAD_STAMP, REPORT_COLUMNS
from sitecharge.sources.sinks import create_report, read_report, render_dates, write_report

MARCH, FEBRUARY = date(2000, 3, 15), date(2000, 2, 15)
FIRST, SECOND = datetime(2000, 3, 15, 6), datetime(2000, 3, 16, 6)


@pytest.fixture(params=["folder", "table"])
def target(request, spark, tmp_path):
    name = str(tmp_path / "report") if request.param == "folder" else "report_table"
    spark.sql("DROP TABLE IF EXISTS report_table")
    create_report(spark, name)
    return name


def loads(spark, target):
    rows = read_report(spark, target).groupBy("START_DATE", LOAD_STAMP).count().collect()
    return {(r.START_DATE.month, r[LOAD_STAMP]) for r in rows}


def test_append_then_replace(spark, target):
    tables = spark_tables(spark, random_world(21))
    assert read_report(spark, target).count() == 0
    run_report(tables, MARCH, target, loaded_at=FIRST)
    rows = read_report(spark, target)
    assert rows.columns == [*REPORT_COLUMNS, LOAD_STAMP]
    once = rows.count()
    run_report(tables, MARCH, target, loaded_at=SECOND)
    assert read_report(spark, target).count() == 2 * once
    assert loads(spark, target) == {(1, FIRST), (1, SECOND), (2, FIRST), (2, SECOND)}
    third = datetime(2000, 3, 17, 6)
    run_report(tables, FEBRUARY, target, mode="replace_period", loaded_at=third)
    assert loads(spark, target) == {(1, third), (2, FIRST), (2, SECOND)}


def test_target_must_exist_and_match(spark, tmp_path):
    world = base_world()
    world["jobs"] = [job(1)]
    report = stamp(
        build_report(spark_tables(spark, world), year_to_date(MARCH), Staging(spark)), FIRST
    )
    with pytest.raises(ValueError, match="does not exist"):
        write_report(report, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="does not exist"):
        write_report(report, "no_such_table")
    folder = str(tmp_path / "there")
    create_report(spark, folder)
    write_report(report, folder)
    changed = report.withColumn("TOTAL_FCPU", F.col("TOTAL_FCPU").cast("string"))
    with pytest.raises(ValueError, match="TOTAL_FCPU"):
        write_report(changed, folder)
    with pytest.raises(ValueError, match="mode"):
        write_report(report, folder, "merge")


def test_ids_take_the_type_of_the_table(spark):
    spark.sql("DROP TABLE IF EXISTS text_report")
    create_report(spark, "text_report", id_type="string")
    world = base_world()
    world["jobs"] = [job(1)]
    run_report(spark_tables(spark, world), MARCH, "text_report", loaded_at=FIRST)
    (row,) = read_report(spark, "text_report").collect()
    assert (row.COMPANY_ID, row.ACCOUNT_ID, row.SITE_ID) == ("1", "10", "100")


def test_rendered_dates(spark):
    world = base_world()
    world["work_orders"] = [(1000, 7, 70, 3.0)]
    world["jobs"] = [job(1)]
    report = build_report(spark_tables(spark, world), year_to_date(MARCH), Staging(spark))
    row = render_dates(stamp(report, FIRST)).first()
    assert row.START_DATE == "2000-01-01 00:00:00"
    assert row.END_DATE == "2000-01-31 00:00:00"
    assert row.DATE_OV_TURNED_ON == "2000-01-10 05:00:00"
    assert row.UPDATED_AT == "2000-03-15 06:00:00"


def test_replace_empties_periods_without_rows(spark, target):
    world = base_world()
    world["jobs"] = [job(1), job(2, start=datetime(2000, 2, 10))]
    run_report(spark_tables(spark, world), MARCH, target, loaded_at=FIRST)
    assert loads(spark, target) == {(1, FIRST), (2, FIRST)}
    world["jobs"] = [job(1)]
    run_report(spark_tables(spark, world), MARCH, target, "replace_period", loaded_at=SECOND)
    assert loads(spark, target) == {(1, SECOND)}
    world["jobs"] = []
    run_report(spark_tables(spark, world), MARCH, target, "replace_period", loaded_at=SECOND)
    assert loads(spark, target) == set()


def test_replace_leaves_overlapping_periods(spark, target):
    world = base_world()
    world["jobs"] = [job(1), job(2, start=datetime(2000, 2, 10))]
    tables, staging = spark_tables(spark, world), Staging(spark)
    run_report(tables, MARCH, target, loaded_at=FIRST)
    quarter = [Period(date(2000, 1, 1), date(2000, 3, 31))]
    for loaded_at in (FIRST, SECOND):
        rows = stamp(build_report(tables, quarter, staging), loaded_at)
        write_report(rows, target, "replace_period", quarter)
    found = {(r.END_DATE.month, r[LOAD_STAMP]) for r in read_report(spark, target).collect()}
    assert found == {(1, FIRST), (2, FIRST), (3, SECOND)}


@pytest.mark.parametrize("kind", ["folder", "table"])
def test_text_dates(spark, tmp_path, kind):
    name = str(tmp_path / "texts") if kind == "folder" else "text_dates_report"
    spark.sql("DROP TABLE IF EXISTS text_dates_report")
    create_report(spark, name, id_type="string", text_dates=True)
    assert dict(read_report(spark, name).dtypes)["COMPANY_ID"] == "string"
    world = base_world()
    world["jobs"] = [job(1), job(2, start=datetime(2000, 2, 10))]
    tables = spark_tables(spark, world)
    for loaded_at in (FIRST, SECOND):
        run_report(tables, MARCH, name, loaded_at=loaded_at, text_dates=True)
    rows = read_report(spark, name).collect()
    assert {(r.START_DATE, r.END_DATE, r.UPDATED_AT) for r in rows} == {
        (f"2000-0{m}-01 00:00:00", end, f"2000-03-{d} 06:00:00")
        for m, end in ((1, "2000-01-31 00:00:00"), (2, "2000-02-29 00:00:00"))
        for d in (15, 16)
    }
    world["jobs"] = [job(1)]
    run_report(
        spark_tables(spark, world), MARCH, name, "replace_period", loaded_at=SECOND, text_dates=True
    )
    assert [r.START_DATE for r in read_report(spark, name).collect()] == ["2000-01-01 00:00:00"]


def test_left_over_folders_are_not_rows(spark, tmp_path):
    target = str(tmp_path / "report")
    create_report(spark, target, id_type="string")
    (tmp_path / "report" / "_temporary").mkdir()
    assert read_report(spark, target).count() == 0
    world = base_world()
    world["jobs"] = [job(1)]
    run_report(spark_tables(spark, world), MARCH, target, loaded_at=FIRST)
    (row,) = read_report(spark, target).collect()
    assert row.SITE_ID == "100"


def test_staging_is_cleared(spark, tmp_path):
    staging = Staging(spark)
    one, two = (staging.store(spark.range(n), "numbers") for n in (3, 4))
    assert (one.count(), two.count()) == (3, 4)
    (path,) = {row.path.rsplit("/", 2)[0] for row in one.select(F.input_file_name().alias("path")).collect()}
    assert staging.folder in path
    staging.clear()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(staging.folder)


def test_a_load_that_dies_is_not_seen(spark, tmp_path, monkeypatch):
    """Between its files and its commit, a load that replaces one month and empties another leaves the old rows."""
    target = str(tmp_path / "report")
    create_report(spark, target)
    world = base_world()
    world["jobs"] = [job(1), job(2, start=datetime(2000, 2, 10))]
    run_report(spark_tables(spark, world), MARCH, target, loaded_at=FIRST)
    before = sorted(map(repr, read_report(spark, target).collect()))
    world["jobs"] = [job(1), job(3)]

    def dying(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_commit", dying)
        with pytest.raises(RuntimeError):
            run_report(spark_tables(spark, world), MARCH, target, "replace_period", loaded_at=SECOND)
    assert sorted(map(repr, read_report(spark, target).collect())) == before
    # nor is one whose commit was begun and never ended
    (tmp_path / "report" / "_commits" / "00000002.json").write_text("[[")
    assert sorted(map(repr, read_report(spark, target).collect())) == before
    run_report(spark_tables(spark, world), MARCH, target, "replace_period", loaded_at=SECOND)
    assert loads(spark, target) == {(1, SECOND)}
    assert len(sinks.remove_unused(spark, target, timedelta(0))) == 2
    assert loads(spark, target) == {(1, SECOND)} and sinks.remove_unused(spark, target, timedelta(0)) == []


def test_readers_keep_what_they_began_with(spark, tmp_path):
    target = str(tmp_path / "report")
    create_report(spark, target)
    world = base_world()
    world["jobs"] = [job(1)]
    run_report(spark_tables(spark, world), MARCH, target, loaded_at=FIRST)
    old = read_report(spark, target)
    run_report(spark_tables(spark, world), MARCH, target, "replace_period", loaded_at=SECOND)
    assert [r[LOAD_STAMP] for r in old.collect()] == [FIRST]
    assert loads(spark, target) == {(1, SECOND)}


def test_faster_commits_are_built_upon(spark, tmp_path):
    target = str(tmp_path / "report")
    create_report(spark, target)
    sinks._commit(spark, target, lambda live: live + [["a", "START_DATE=x", "END_DATE=y"]])
    taken = []

    def change(live):
        return live + [["b", "START_DATE=x", "END_DATE=y"]]

    state = sinks._state

    def late(spark, target):
        found = state(spark, target)
        if not taken:  # another load commits in between
            taken.append(1)
            sinks._commit(spark, target, lambda live: live + [["c", "START_DATE=x", "END_DATE=y"]])
        return found

    sinks._state = late
    try:
        sinks._commit(spark, target, change)
    finally:
        sinks._state = state
    assert [load for load, *_ in state(spark, target)[1]] == ["a", "c", "b"]


def test_folder_without_commits(spark, tmp_path):
    """Partitions written by other means count until a load replaces them."""
    target = str(tmp_path / "report")
    create_report(spark, target)
    world = base_world()
    world["jobs"] = [job(1), job(2, start=datetime(2000, 2, 10))]
    rows = stamp(build_report(spark_tables(spark, world), year_to_date(MARCH), Staging(spark)), FIRST)
    rows.write.partitionBy("START_DATE", "END_DATE").mode("append").parquet(target)
    assert loads(spark, target) == {(1, FIRST), (2, FIRST)}
    run_report(spark_tables(spark, world), FEBRUARY, target, "replace_period", loaded_at=SECOND)
    assert loads(spark, target) == {(1, SECOND), (2, FIRST)}


def test_session_is_left_as_it_is(spark):
    spark.sql("DROP TABLE IF EXISTS own_report")
    create_report(spark, "own_report")
    before = dict(spark.conf.getAll)
    world = base_world()
    world["jobs"] = [job(1)]
    seen = []

    class Watched(type(spark.conf)):
        def set(self, key, value):
            seen.append(key)
            super().set(key, value)

    watched, kind = spark.conf, type(spark.conf)
    watched.__class__ = Watched
    try:
        run_report(spark_tables(spark, world), MARCH, "own_report", "replace_period", loaded_at=FIRST)
    finally:
        watched.__class__ = kind
    assert "spark.sql.sources.partitionOverwriteMode" not in seen and dict(spark.conf.getAll) == before
