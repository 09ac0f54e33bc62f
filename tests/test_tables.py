"""Reading the input tables."""

import pytest
from world import base_world, job, spark_tables

from sitecharge.operators.jobs import period_jobs
from sitecharge.operators.periods import year_to_date
from sitecharge.operators.pricing import merged_jobs
from sitecharge.plans.report import build_report
from sitecharge.plans.staging import Staging
from sitecharge.sources.schemas import INPUT_COLUMNS
from sitecharge.sources.tables import load_tables, tables_from_catalog, tables_from_path
from test_report import MARCH


def world_with_jobs():
    world = base_world()
    world["jobs"] = [job(1), job(2, quantity=0.5)]
    return world


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_formats_give_the_same_report(spark, tmp_path, fmt):
    options = {"header": "true"} if fmt == "csv" else {}
    tables = spark_tables(spark, world_with_jobs())
    for name in INPUT_COLUMNS:
        getattr(tables, name).write.format(fmt).options(**options).save(f"{tmp_path}/{name}")
    read = tables_from_path(spark, str(tmp_path), fmt, **options)
    reports = [build_report(t, year_to_date(MARCH), Staging(spark)).collect()
               for t in (tables, read)]
    assert reports[0] == reports[1] and len(reports[0]) == 1


def test_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS inputs")
    tables = spark_tables(spark, world_with_jobs())
    for name in INPUT_COLUMNS:
        getattr(tables, name).write.mode("overwrite").saveAsTable(f"inputs.{name}")
    assert tables_from_catalog(spark, "inputs").jobs.count() == 2
    spark.sql("DROP DATABASE inputs CASCADE")


def test_text_ids_pass_through(spark):
    tables = spark_tables(spark, world_with_jobs())
    textual = load_tables(
        lambda name: getattr(tables, name).selectExpr(
            *[f"CAST({c} AS STRING) AS {c}" if k == "id" else c
              for c, k in INPUT_COLUMNS[name].items()]
        )
    )
    (row,) = build_report(textual, year_to_date(MARCH), Staging(spark)).collect()
    assert (row.COMPANY_ID, row.ACCOUNT_ID, row.SITE_ID) == ("1", "10", "100")


def test_nan_and_missing_columns(spark):
    world = world_with_jobs()
    world["jobs"].append(job(3, quantity=float("nan")))
    world["work_orders"] = [(1000, 7, 70, float("nan"))]
    tables = spark_tables(spark, world)
    assert tables.work_orders.first().final_charge_per_unit is None
    assert period_jobs(tables, year_to_date(MARCH)).count() == 1
    with pytest.raises(ValueError, match="has no column"):
        load_tables(lambda name: spark.range(1))


def test_merged_row(spark):
    """Eight pieces are two cases; the charge parts come from the scenario."""
    row = merged_jobs(spark_tables(spark, world_with_jobs()), year_to_date(MARCH)).first()
    assert (row.produced_quantity, row.case_ratio, row.copies) == (8.0, 4.0, 1)
    assert (row.custom_sum_charge_per_unit, row.scenario_charge_id) == (0.25, 900)
