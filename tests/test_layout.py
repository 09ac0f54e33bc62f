"""Jobs by month, tables in buckets, and frequent work orders: same results, less read and moved."""

import re
from dataclasses import replace
from datetime import date, datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F
from world import base_world, random_world, spark_tables

from sitecharge.operators.jobs import job_facts, period_jobs
from sitecharge.operators.periods import START_MONTH, Period, months_of, year_to_date
from sitecharge.operators.pricing import merged_in_buckets, merged_jobs, order_prices
from sitecharge.operators.skew import heavy_keys, lookup_join
from sitecharge.sources import layout
from sitecharge.sources.layout import read_jobs_by_month, read_months, write_in_buckets, write_jobs_by_month, write_months
from sitecharge.sources.tables import typed

PERIODS = year_to_date(date(2000, 3, 15))


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def tables(spark):
    return spark_tables(spark, random_world(41))


def by_month(tables, spark, path):
    return replace(tables, jobs=typed(read_jobs_by_month(spark, path), "jobs"))


def test_months_of_periods():
    assert months_of(PERIODS) == [date(2000, 1, 1), date(2000, 2, 1)]
    assert months_of([Period(date(1999, 11, 30), date(2000, 1, 1))]) == [date(1999, 11, 1), date(1999, 12, 1), date(2000, 1, 1)]


def test_only_the_months_asked_for_are_read(spark, tables, tmp_path):
    path = str(tmp_path / "jobs")
    write_jobs_by_month(tables.jobs, path)
    laid_out = by_month(tables, spark, path)
    assert rows_of(laid_out.jobs.drop(START_MONTH)) == rows_of(tables.jobs)
    assert laid_out.jobs.where(f"{START_MONTH} IS NULL").count() == tables.jobs.where("actual_start_at IS NULL").count() > 0
    for periods in (PERIODS, PERIODS[1:]):
        assert rows_of(job_facts(laid_out, periods)) == rows_of(job_facts(tables, periods))
        counted = period_jobs(laid_out, periods)
        plan = physical(counted)
        assert START_MONTH in re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
        files = {row[0] for row in counted.select(F.input_file_name()).distinct().collect()}
        assert {re.search(rf"{START_MONTH}=([^/]*)", f)[1] for f in files} == {p.start.isoformat() for p in periods}
    scan = period_jobs(laid_out, PERIODS[1:])._jdf.queryExecution().executedPlan()
    while scan.children().nonEmpty():
        scan = scan.children().head()
    assert scan.selectedPartitions().partitionCount() == 1


def test_a_month_is_replaced_or_emptied(spark, tables, tmp_path):
    path = str(tmp_path / "jobs")
    write_jobs_by_month(tables.jobs, path)
    january, february = date(2000, 1, 1), date(2000, 2, 1)
    late = tables.jobs.withColumn("actual_start_at", F.expr("actual_start_at + INTERVAL 31 DAYS"))
    write_jobs_by_month(late, path, months=[january, february])
    found = read_jobs_by_month(spark, path)
    assert found.where(F.col(START_MONTH) == january).count() == 0
    expected = late.where(F.trunc("actual_start_at", "month") == february)
    assert rows_of(found.where(F.col(START_MONTH) == february).drop(START_MONTH)) == rows_of(expected)
    before = tables.jobs.where(F.trunc("actual_start_at", "month") == date(2000, 3, 1))
    assert rows_of(found.where(F.col(START_MONTH) == date(2000, 3, 1)).drop(START_MONTH)) == rows_of(before)
    write_jobs_by_month(tables.jobs.limit(0), path)
    assert read_jobs_by_month(spark, path).count() == 0


def test_rows_of_replaced_months_are_read_once(spark, tmp_path):
    """The months that got rows are known from the folders, not from another pass over the rows."""
    path = str(tmp_path / "rows")
    january, february, march = (date(2000, m, 1) for m in (1, 2, 3))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("date")
    def month(number):
        seen.add(1)
        return january if number % 2 else february

    write_months(spark.createDataFrame([(0, january), (1, march)], f"n int, {START_MONTH} date"), path)
    rows = spark.range(10).select("id", month.asNondeterministic()("id").alias(START_MONTH))
    write_months(rows.withColumnRenamed("id", "n"), path, [january, february, march])
    assert seen.value == 10
    found = read_months(spark, path)
    assert {(r.n, r[START_MONTH]) for r in found.collect()} == {(i, january if i % 2 else february) for i in range(10)}
    write_months(rows.limit(0), path, [january])
    assert {r[START_MONTH] for r in read_months(spark, path).collect()} == {february}


def test_rows_of_a_layout_are_not_moved_again(spark, tables, tmp_path, monkeypatch):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    write_jobs_by_month(tables.jobs, one, files=1)
    plans, write = [], layout.write_months
    monkeypatch.setattr(layout, "write_months", lambda rows, *more: (plans.append(physical(rows)), write(rows, *more)))
    write_jobs_by_month(read_jobs_by_month(spark, one), two, laid_out=True)
    january = [date(2000, 1, 1)]
    write_jobs_by_month(read_jobs_by_month(spark, one), two, months=january, laid_out=True)
    write_jobs_by_month(tables.jobs, two, months=january)
    assert ["Exchange" in plan for plan in plans] == [False, False, True]
    assert rows_of(read_jobs_by_month(spark, two)) == rows_of(read_jobs_by_month(spark, one))


def test_months_by_size(tmp_path, spark):
    """Runs of months in order; a large one alone; one without files costs nothing."""
    sizes = {1: 4, 2: 5, 3: 30, 4: 10, 6: 1}
    for m, size in sizes.items():
        folder = tmp_path / f"{START_MONTH}=2000-{m:02}-01"
        folder.mkdir()
        (folder / "part-0.parquet").write_bytes(b"?" * size)
    months = [date(2000, m, 1) for m in (6, 5, 4, 3, 2, 1)]
    runs = layout.months_by_size(spark, str(tmp_path), months, 10)
    assert [[m.month for m in run] for run in runs] == [[1, 2], [3], [4, 5], [6]]
    assert layout.months_by_size(spark, str(tmp_path), months, 50) == [months[::-1]]
    assert layout.months_by_size(spark, str(tmp_path / "none"), months[:2], 1) == [[months[1], months[0]]]


def test_jobs_in_buckets_do_not_move(spark, tables, tmp_path):
    for name in ("bucketed_jobs", "bucketed_prices"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    write_in_buckets(tables.jobs, "bucketed_jobs", "work_order_id", 4, str(tmp_path / "jobs"))
    write_in_buckets(order_prices(tables), "bucketed_prices", "work_order_id", 4, str(tmp_path / "prices"))
    laid_out = replace(tables, jobs=spark.table("bucketed_jobs"))
    nameless = tables.jobs.where("work_order_id IS NULL")
    assert nameless.count() > 0
    found = merged_in_buckets(laid_out, nameless, spark.table("bucketed_prices"), PERIODS)
    assert rows_of(found) == rows_of(merged_jobs(tables, PERIODS))
    named = physical(merged_jobs(laid_out, PERIODS, prices=spark.table("bucketed_prices"), bucketed=True))
    join = named[named.index("SortMergeJoin") :]
    assert "Exchange hashpartitioning" not in join and join.count("Bucketed: true") == 2


@pytest.fixture(scope="module")
def hot(spark):
    """120,000 jobs, a third of them on one work order, a tenth on another, some on none."""
    world = base_world()
    world["work_orders"] = [(i, 7, 70, None) for i in range(300)]
    order = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, 7).when(F.col("id") % 50 == 2, None)
    start = (datetime(2000, 1, 1) + timedelta(days=1)).isoformat(" ")
    jobs = spark.range(0, 120_000, 1, 8).select(
        F.col("id").alias("job_id"),
        F.lit(100).cast("bigint").alias("site_id"),
        order.otherwise(F.col("id") % 300).alias("work_order_id"),
        F.expr(f"TIMESTAMP_NTZ'{start}'").alias("created_at"),
        F.expr(f"TIMESTAMP_NTZ'{start}'").alias("actual_start_at"),
        F.lit(2.0).alias("produced_quantity_value_in_reference_uom"),
    )
    return replace(spark_tables(spark, world), jobs=jobs)


def test_heavy_keys(hot, spark):
    assert heavy_keys(hot.jobs, "work_order_id", share=1 / 20) == [0, 7]
    assert heavy_keys(hot.jobs.limit(0), "work_order_id") == []
    assert heavy_keys(hot.jobs.where("work_order_id IS NULL"), "work_order_id") == []
    texts = hot.jobs.select(F.concat(F.lit("w"), "work_order_id").alias("work_order_id"))
    assert heavy_keys(texts, "work_order_id", share=1 / 20) == ["w0", "w7"]


def test_heavy_work_orders_are_dealt_out(spark, hot):
    """Without adaptive execution: no task has three times the rows of the median one."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    heavy = heavy_keys(hot.jobs, "work_order_id")
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        # sites are joined first and put all jobs of the one site into one task, so look at the join with the prices alone
        rows = hot.jobs.withColumn("has_id", F.lit(True))
        prices = order_prices(hot)
        sizes = {}
        for keys in ([], heavy):
            joined = lookup_join(rows, prices.hint("merge"), ["work_order_id", "has_id"], "job_id", heavy=keys)
            assert joined.count() == 120_000
            tasks = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
            sizes[len(keys)] = [t["count"] for t in tasks]
        assert max(sizes[0]) > 3 * median(sizes[0])
        assert max(sizes[len(heavy)]) < 3 * median(sizes[len(heavy)])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert rows_of(merged_jobs(hot, PERIODS, heavy=heavy).drop("created_at")) == rows_of(merged_jobs(hot, PERIODS).drop("created_at"))


def test_work_orders_without_item_or_scenario_are_spread(spark, tables):
    """Neither meet in the one task that NULL hashes to."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, keys in ((order_prices(tables), {"item_id", "scenario_id"}), (job_facts(tables, PERIODS), {"item_id"})):
            joins = re.findall(r"SortMergeJoin \[((?:item|scenario)_id)#([^\]]*)\], [^\n]*LeftOuter", physical(df))
            assert {key for key, _ in joins} == keys
            assert all("_salt" in rest for _, rest in joins)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
