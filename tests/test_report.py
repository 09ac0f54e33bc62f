"""The report against a plain job-by-job computation, and its rules on hand-made worlds."""

from datetime import date, datetime

import pytest
from world import FEB, JAN, base_world, brute_report, job, random_world, spark_tables

from sitecharge.operators.dimensions import report_keys
from sitecharge.operators.periods import FULL_DAY, Period, year_to_date
from sitecharge.plans.report import ReportOptions, build_report, build_rollup
from sitecharge.plans.staging import Staging
from sitecharge.sources.tables import validate_keys

MARCH = date(2000, 3, 15)


def run(spark, world, as_of=MARCH, periods=None, **options):
    tables = spark_tables(spark, world)
    wanted = year_to_date(as_of) if periods is None else periods
    rows = build_report(tables, wanted, Staging(spark), ReportOptions(**options)).collect()
    return {
        ((r.START_DATE, r.END_DATE), (r.COMPANY_ID, r.ACCOUNT_ID, r.SITE_ID)): r.asDict()
        for r in rows
    }


def only(spark, world, **options):
    (row,) = run(spark, world, **options).values()
    return row


def expect_equal(found, world, ties="keep"):
    expected = {
        (period, owner): numbers
        for period in (JAN, FEB)
        for owner, numbers in brute_report(world, period, ties).items()
    }
    assert set(found) == set(expected)
    for key, numbers in expected.items():
        assert {name: found[key][name] for name in numbers} == numbers, key


@pytest.mark.parametrize("seed", range(3))
def test_random_worlds(spark, seed):
    world = random_world(seed)
    expect_equal(run(spark, world), world)


def test_ties_counted_once(spark):
    world = random_world(11)
    expect_equal(run(spark, world, ties="dedupe"), world, ties="dedupe")


def test_zero_case_ratio_is_infinite(spark):
    world = base_world()
    world["uom_ratios"][1] = (502, 10, 2, 0.0)
    world["jobs"] = [job(1)]
    found = run(spark, world)
    expect_equal(found, world)
    assert next(iter(found.values()))["OV_W_OUTLIERS"] == float("inf")


def test_all_months_at_once_equal_single_months(spark):
    world = random_world(13)
    together = run(spark, world)
    alone = {}
    for period in year_to_date(MARCH):
        alone.update(run(spark, world, periods=[period]))
    assert together == alone


def test_overlapping_periods(spark):
    world = random_world(14)
    quarter = Period(date(2000, 1, 1), date(2000, 2, 29))
    january = Period(*JAN)
    both = run(spark, world, periods=[quarter, january])
    assert both == {
        **run(spark, world, periods=[quarter]),
        **run(spark, world, periods=[january]),
    }


def test_last_day_counts_to_midnight_unless_asked(spark):
    world = base_world()
    world["jobs"] = [job(1), job(2, start=datetime(2000, 1, 31)),
                     job(3, start=datetime(2000, 1, 31, 0, 0, 1))]
    assert only(spark, world)["TOTAL_NUM_JOBS"] == 2
    assert only(spark, world, end=FULL_DAY)["TOTAL_NUM_JOBS"] == 3


def test_no_jobs_and_january_give_no_rows(spark):
    assert run(spark, base_world()) == {}
    world = base_world()
    world["jobs"] = [job(1)]
    assert run(spark, world, as_of=date(2000, 1, 20)) == {}


def test_null_job_id_is_a_row_but_not_a_job(spark):
    world = base_world()
    world["jobs"] = [job(1), job(None)]
    row = only(spark, world)
    filled, none = row["PERCENT_FILL_RATE"], row["PERCENT_NO_CHARGES"]
    assert (row["TOTAL_NUM_JOBS"], filled, none) == (1, 100.0, 100.0)


@pytest.mark.parametrize(
    "materials, adjusted",
    [(0.05, None), (0.5, 0.62), (1.0, None), (1.5, None)],
)
def test_adjusted_only_for_a_middling_share(spark, materials, adjusted):
    """Final charge 1 per unit, so the materials charge is the materials share."""
    world = base_world()
    world["work_orders"] = [(1000, 7, 70, 1.0)]
    world["scenarios"] = [(70, 1)]
    world["scenario_charges"] = [(900, 70, datetime(1999, 1, 1), 0.0, materials, 0.0, None)]
    world["jobs"] = [job(1, quantity=100.0)]
    row = only(spark, world)
    assert row["OV_WO_OUTLIERS"] == 100.0
    assert row["PERCENT_OV_MATERIALS"] == materials * 100
    assert row["ADJUSTED_OV_WO_OUTLIERS"] == (100.0 if adjusted is None else adjusted * 100)


def test_invariants(spark):
    for row in run(spark, random_world(15)).values():
        shares = [row[f"PERCENT_{n}"] for n in
                  ("FCPU", "OVERRIDDEN", "SUM_SCENARIO", "SUM_SCENARIO_WO_CUSTOM", "NO_CHARGES")]
        assert sum(shares) == pytest.approx(100, abs=0.05)
        assert row["PERCENT_OUTLIERS"] >= row["PERCENT_NO_CHARGES"]


def test_key_filter_changes_nothing(spark):
    tables = spark_tables(spark, random_world(16))
    rollup = build_rollup(tables, year_to_date(MARCH), Staging(spark))
    assert report_keys(tables, rollup).count() == rollup.count() > 0


def test_validate_keys(spark):
    world = base_world()
    world["jobs"] = [job(1), job(1), job(None)]
    found = validate_keys(spark_tables(spark, world))
    assert sorted(r["rows"] for r in found["jobs"].collect()) == [1, 2]
    assert found["sites"].count() == 0
