"""Joining the five frames gives the rows that are built from the tables directly."""

from collections import Counter

from pyspark.sql import functions as F
from test_report import MARCH
from world import random_world, spark_tables

from sitecharge.operators.periods import year_to_date
from sitecharge.operators.pricing import merged_jobs
from sitecharge.operators.rollup import REPORT_MEASURES, SITE_KEYS
from sitecharge.plans.frames import merge_frames, pull_frames
from sitecharge.plans.report import SKETCHED, ReportOptions, rows_rollup
from sitecharge.plans.staging import Staging


def test_frames_equal_tables(spark):
    world = random_world(41)
    # a job id names one job here, as the joins on it require
    world["jobs"] = [row for row in world["jobs"] if row[0] is not None]
    tables = spark_tables(spark, world)
    periods = year_to_date(MARCH)
    built = merged_jobs(tables, periods)
    joined = merge_frames(pull_frames(tables, periods)).select(*built.columns)

    def weights(df):
        found = Counter()
        for row in df.collect():
            found[tuple(v for k, v in row.asDict().items() if k != "copies")] += row.copies
        return found

    assert weights(joined) == weights(built)
    assert sum(weights(built).values()) > 400


def merged_rows(spark, projects):
    """Merged job rows of one world, over many projects that have several charges each; some have none."""
    tables = spark_tables(spark, random_world(42))
    rows = merge_frames(pull_frames(tables, year_to_date(MARCH)))
    number = F.pmod(F.xxhash64("job_id", "n"), F.lit(projects))
    many = rows.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(40))))
    return many.withColumn("project_id", F.when(number > 2, number)).drop("n")


def test_projects_are_counted_in_one_reading(spark):
    staging = Staging(spark)
    rows = staging.store(merged_rows(spark, 50), "rows")
    read = []

    class Watching(Staging):
        def store(self, df, name):
            read.append((name, df._jdf.queryExecution().executedPlan().toString()))
            return super().store(df, name)

    rollup = rows_rollup(rows, Watching(spark), measures=REPORT_MEASURES)
    found = {tuple(r[k] for k in SITE_KEYS): r.total_number_of_projects for r in rollup.collect()}
    owned = rows.where("company_id IS NOT NULL AND account_id IS NOT NULL AND site_id IS NOT NULL")
    expected = owned.groupBy(*SITE_KEYS).agg(F.countDistinct("project_id").alias("n")).collect()
    assert found == {tuple(r[k] for k in SITE_KEYS): r.n for r in expected} and max(found.values()) > 20
    assert [name for name, plan in read if "/rows-1" in plan] == ["row_groups"]
    assert dict(read)["row_groups"].count("/rows-1") == 1
    assert "/rows-1" not in rollup._jdf.queryExecution().executedPlan().toString()


def test_sketched_projects(spark):
    rows = Staging(spark).store(merged_rows(spark, 3000), "rows")
    options = ReportOptions(projects=SKETCHED, project_bits=10)
    exact = rows_rollup(rows, Staging(spark), measures=REPORT_MEASURES)
    sketched = rows_rollup(rows, Staging(spark), options, REPORT_MEASURES)
    assert sorted(exact.columns) == sorted(sketched.columns)
    true = {tuple(r[k] for k in SITE_KEYS): r.asDict() for r in exact.collect()}
    found = {tuple(r[k] for k in SITE_KEYS): r.asDict() for r in sketched.collect()}
    assert set(true) == set(found) and max(r["total_number_of_projects"] for r in true.values()) > 500
    for key, row in found.items():
        n, wanted = row.pop("total_number_of_projects"), true[key].pop("total_number_of_projects")
        # four of the standard errors that ReportOptions states
        assert abs(n - wanted) <= 4 * 1.04 / 2 ** (options.project_bits / 2) * wanted + 1
        assert row == true[key]
