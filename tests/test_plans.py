"""What the plans look like, and that hot keys neither change results nor sit in one task."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_report import MARCH, expect_equal, run
from world import base_world, job, random_world, spark_tables

from sitecharge.operators.jobs import job_picks, job_totals, scenario_charges, turned_on_dates
from sitecharge.operators.periods import year_to_date
from sitecharge.operators.pricing import merged_jobs
from sitecharge.operators.rollup import REPORT_MEASURES
from sitecharge.operators.skew import attach_by_key, left_join, lookup_join
from sitecharge.plans.report import build_report, needed_totals
from sitecharge.plans.staging import Staging, shared_folder
from sitecharge.sources.schemas import INPUT_COLUMNS
from sitecharge.sources.tables import tables_from_path

PERIODS = year_to_date(MARCH)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    tables = spark_tables(spark, random_world(31))
    for name in INPUT_COLUMNS:
        getattr(tables, name).write.parquet(f"{folder}/{name}")
    return tables_from_path(spark, str(folder))


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan, table):
    return re.findall(rf"FileScan parquet \[[^\n]*/{table}\][^\n]*", plan)


def test_one_filtered_scan_of_the_jobs(spark, stored):
    plan = physical(needed_totals(stored, PERIODS, measures=REPORT_MEASURES))
    (scan,) = scans(plan, "jobs")
    assert "GreaterThan(produced_quantity_value_in_reference_uom,0.99)" in scan
    assert "GreaterThanOrEqual(actual_start_at,2000-01-01T00:00)" in scan
    assert "created_at" not in scan
    for banned in ("Python", "NestedLoop", "Cartesian", "Window"):
        assert banned not in plan


def test_report_after_the_fold_does_not_touch_jobs_but_for_the_first_starts(spark, stored):
    plan = physical(build_report(stored, PERIODS, Staging(spark)))
    (scan,) = scans(plan, "jobs")
    schema = scan.split("ReadSchema:")[1]
    assert re.findall(r"(\w+):", schema) == ["site_id", "work_order_id", "actual_start_at"]
    for banned in ("Python", "NestedLoop", "Cartesian"):
        assert banned not in plan


def test_jobs_move_for_the_work_order_only(spark, stored):
    for df in (merged_jobs(stored, PERIODS), scenario_charges(stored, PERIODS)):
        assert "hashpartitioning(site_id" not in physical(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in physical(merged_jobs(stored, PERIODS))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_facts_are_combined_before_they_move(stored):
    for df in (job_totals(stored, PERIODS), turned_on_dates(stored)):
        plan = physical(df)
        below = plan[: plan.index("FileScan parquet")]
        last_move = below.rindex("Exchange hashpartitioning")
        assert "partial_" in below[last_move:]


def hot_world():
    """Most jobs on one site and one work order, whose scenario has many tied charges."""
    world = random_world(32)
    tied = datetime(2000, 1, 1)
    world["scenarios"].append((77, 1))
    world["scenario_charges"] += [
        (2000 + i, 77, tied, 1.0 * (i % 4), 0.5, 0.25, None) for i in range(12)
    ]
    world["sites"].append((500, 10, True))
    world["work_orders"] += [(5000 + i, 1, 77, None) for i in range(20)]
    start = datetime(2000, 1, 3)
    world["jobs"] += [
        job(10_000 + i, 500, 5000 if i % 2 else 5000 + i % 20, start + timedelta(minutes=i), 2.0)
        for i in range(300)
    ]
    return world


def test_hot_world(spark):
    world = hot_world()
    expect_equal(run(spark, world), world)


def test_hot_work_order_is_split(spark, tmp_path):
    """A third of the jobs on one work order: the row-level join is split at run time."""
    world = base_world()
    world["work_orders"] = [(i, 7, 70, None) for i in range(300)]
    tables = spark_tables(spark, world)
    many = spark.range(0, 120_000, 1, 8)
    jobs = many.select(
        F.col("id").alias("job_id"),
        F.lit(100).cast("bigint").alias("site_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 300).alias("work_order_id"),
        F.expr("TIMESTAMP_NTZ'2000-01-02 00:00:00'").alias("created_at"),
        F.expr("TIMESTAMP_NTZ'2000-01-02 00:00:00'").alias("actual_start_at"),
        F.lit(2.0).alias("produced_quantity_value_in_reference_uom"),
    )
    tables = type(tables)(**{**tables.__dict__, "jobs": jobs})
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        merged = merged_jobs(tables, PERIODS)
        assert merged._jdf.queryExecution().toRdd().count() == 120_000
        assert "SortMergeJoin(skew=true)" in physical(merged)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_salted_attach(spark):
    rows = spark.range(0, 3000, 1, 4).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    facts = rows.select("k").distinct().withColumn("f", F.length("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = attach_by_key(rows, facts, ["k"], "v", salts=8)
        assert sorted(joined.collect()) == sorted(rows.join(facts, "k").collect())
        dealt = rows.withColumn("_salt", F.pmod(F.xxhash64("v"), F.lit(8)))
        assert dealt.where("k = 'hot'").groupBy("_salt").count().count() == 8
        assert "hashpartitioning(k" in physical(joined) and "_salt" in physical(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "d")], "k int, l string")
    right = spark.createDataFrame([(1, 10), (1, 11), (3, 12)], "k int, r int")
    key = lambda row: (row.l, row.r or 0)
    ours = sorted(left_join(left, right, "k").collect(), key=key)
    assert ours == sorted(left.join(right, "k", "left").collect(), key=key)


def test_shared_folder_is_the_sessions(spark):
    assert Staging(spark).folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert Staging(spark, "/some/where").folder.startswith("/some/where/run-")
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_work_orders_are_priced_once(spark, stored):
    plan = physical(merged_jobs(stored, PERIODS))
    assert len(scans(plan, "jobs")) == len(scans(plan, "work_orders")) == 1
    assert len(scans(plan, "scenario_charges")) <= 2
    assert "HashAggregate" not in physical(job_picks(stored, PERIODS)).split("Union")[0]


def test_rows_without_key_are_spread(spark):
    rows = spark.range(400).selectExpr("CAST(NULL AS BIGINT) AS k", "id AS job_id")
    rows = rows.unionByName(spark.range(3).selectExpr("id AS k", "id + 1000 AS job_id"))
    lookup = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    joined = lookup_join(rows, lookup.hint("merge"), ["k"], "job_id")
    assert {(r.k, r.v) for r in joined.collect()} == {(None, None), (0, None), (1, "a"), (2, "b")}
    assert joined.count() == 403
    plan = physical(joined)
    assert "_salt" in plan.split("hashpartitioning(")[1].split(")")[0]
