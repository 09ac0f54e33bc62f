"""Jobs, or totals of jobs, with everything that prices them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecharge.operators.dimensions import owned_sites, site_lookup, weighted_item_units
from sitecharge.operators.jobs import QUANTITY, job_totals, period_jobs
from sitecharge.operators.periods import MIDNIGHT, PERIOD, Period
from sitecharge.operators.scenario import KEEP, folded_scenarios, priced_scenarios
from sitecharge.operators.skew import co_located_join, left_join, lookup_join
from sitecharge.sources.tables import Tables

_PARTS = [
    "labour_charge_per_unit",
    "materials_charge_per_unit",
    "overhead_charge_per_unit",
    "overridden_charge_per_unit",
    "custom_sum_charge_per_unit",
]


def unit_work_orders(tables: Tables) -> DataFrame:
    """Work orders with the unit data of their item, one row per distinct context.

    ``context_copies`` is the multiplicity of the row, ``project_rows`` is 1 on exactly one row
    per work order.
    """
    units = weighted_item_units(tables)
    return (
        lookup_join(tables.work_orders, units, ["item_id"], "work_order_id")
        .withColumns(
            {
                "project_id": F.col("work_order_id"),
                "context_copies": _or_one("context_copies"),
                "project_rows": F.when(F.coalesce("first_context", F.lit(True)), 1).otherwise(0),
            }
        )
        .drop("first_context", "item_id")
    )


def _or_one(name: str) -> Column:
    return F.coalesce(name, F.lit(1).cast("bigint"))


def _account_case_ratio() -> Column:
    """The case ratio counts only when it belongs to the account of the site."""
    return F.when(F.col("case_account_id") == F.col("account_id"), F.col("case_ratio"))


def order_prices(tables: Tables, ties: str = KEEP) -> DataFrame:
    """Per work order, distinct context and applying charge, all that prices a job.

    ``has_id`` is true on the rows for jobs with an id; jobs without one have no scenario charge, so a
    work order has one row per context for them. ``copies`` is the multiplicity.
    """
    charges = priced_scenarios(tables, ties).drop("effective_date_at")
    rows = lookup_join(unit_work_orders(tables), charges, ["scenario_id"], "work_order_id")
    both, one = F.array(F.lit(True), F.lit(False)), F.array(F.lit(True))
    first = F.coalesce("first_charge", F.lit(True))
    rows = rows.withColumn("has_id", F.explode(F.when(first, both).otherwise(one)))
    charged = ["scenario_charge_id", "scen_uom", "charge_copies"]
    charged += [name for name in _PARTS if name in charges.columns]
    known = {name: F.when(F.col("has_id"), F.col(name)) for name in charged}
    return (
        rows.withColumns(known)
        .withColumn("copies", _or_one("context_copies") * _or_one("charge_copies"))
        .drop("scenario_id", "first_charge", "charge_copies", "context_copies", "project_rows")
    )


def merged_jobs(
    tables: Tables,
    periods: list[Period],
    end: str = MIDNIGHT,
    ties: str = KEEP,
    prices: DataFrame | None = None,
    heavy: list = (),
    bucketed: bool = False,
) -> DataFrame:
    """Jobs of active sites with unit data, applying charges and the case ratio of the account.

    Equals joining the job facts, the scenario charges, the active sites and the case ratios one
    after the other, but scans the jobs once and moves them for one join only: prices are put
    together per work order first (``prices``: a stored ``order_prices``). ``copies`` is the
    multiplicity of a row.

    ``heavy`` names work orders with a large part of the jobs (``operators.skew.heavy_keys``), whose jobs
    are dealt over many tasks. ``bucketed`` says that jobs and ``prices`` lie in equal buckets of
    work_order_id (``sources.layout.write_in_buckets``): then no job moves.
    """
    prices = order_prices(tables, ties) if prices is None else prices
    owned = (
        period_jobs(tables, periods, end=end)
        .withColumn("has_id", F.col("job_id").isNotNull())
        .join(site_lookup(tables, owned_sites(tables)), "site_id")
    )
    on = ["work_order_id", "has_id"]
    if bucketed:
        priced = co_located_join(owned, prices, on)
    else:
        priced = lookup_join(owned, prices, on, "job_id", heavy=heavy)
    return priced.select(
        *PERIOD,
        "company_id",
        "account_id",
        "site_id",
        "job_id",
        "project_id",
        "created_at",
        F.try_divide(QUANTITY, "default_ratio").alias("produced_quantity"),
        "uom_produced",
        "case_uom_id",
        _account_case_ratio().alias("case_ratio"),
        "scenario_charge_id",
        "scen_uom",
        "final_charge_per_unit",
        *_PARTS,
        _or_one("copies").alias("copies"),
    )


def merged_in_buckets(
    tables: Tables,
    nameless: DataFrame,
    prices: DataFrame,
    periods: list[Period],
    end: str = MIDNIGHT,
) -> DataFrame:
    """``merged_jobs`` with jobs and prices in equal buckets of work_order_id; no job moves.

    ``nameless`` are the jobs without work order, which are kept beside the buckets and meet no price.
    """
    named = merged_jobs(tables, periods, end, prices=prices, bucketed=True)
    others = replace(tables, jobs=nameless.where("work_order_id IS NULL"))
    unpriced = merged_jobs(others, periods, end, prices=prices.where(F.lit(False)))
    return named.unionByName(unpriced)


def order_totals(
    tables: Tables,
    sites: DataFrame,
    periods: list[Period],
    prices: DataFrame,
    end: str = MIDNIGHT,
) -> DataFrame:
    """Job totals per work order with its prices: what decides unit charges and how many rows have them."""
    totals = job_totals(tables, periods, end, dates=False).join(
        site_lookup(tables, sites), "site_id"
    )
    return totals.join(prices, ["work_order_id", "has_id"], "left").withColumns(
        {
            "produced_quantity": F.try_divide("reference_quantity", "default_ratio"),
            "case_ratio": _account_case_ratio(),
            "copies": _or_one("copies"),
        }
    )


def pricing_totals(
    tables: Tables,
    sites: DataFrame,
    periods: list[Period],
    end: str = MIDNIGHT,
    dates: bool = True,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Job totals folded once more, per (period, site) and everything that decides a price.

    What is left of a site is one row per scenario, final charge and pair of units, however many
    jobs and work orders it has; only these rows meet the tied charges of a scenario. ``totals`` are
    stored ``job_totals`` of the periods, in place of the jobs.
    """
    totals = job_totals(tables, periods, end, dates) if totals is None else totals
    produced = F.try_divide("reference_quantity", "default_ratio")
    copies = _or_one("context_copies")
    created = [
        F.min("first_created_at").alias("first_created_at"),
        F.max("last_created_at").alias("last_created_at"),
    ]
    created = created if dates else []
    return (
        totals.join(site_lookup(tables, sites), "site_id")
        .join(unit_work_orders(tables), "work_order_id", "left")
        .withColumns(
            {
                "case_ratio": _account_case_ratio(),
                "scenario_id": F.when(F.col("has_id"), F.col("scenario_id")),
                "project_rows": F.when(F.col("first_of_order"), F.col("project_rows")),
            }
        )
        .groupBy(
            *PERIOD,
            "company_id",
            "account_id",
            "site_id",
            "scenario_id",
            "final_charge_per_unit",
            "uom_produced",
            "case_ratio",
        )
        .agg(
            F.sum(produced * copies).alias("produced_quantity"),
            F.sum(F.col("job_rows") * copies).alias("job_rows"),
            F.sum(F.col("job_count") * copies).alias("job_count"),
            F.sum(F.coalesce("project_rows", F.lit(0))).alias("project_rows"),
            *created,
        )
    )


def priced_totals(
    tables: Tables, totals: DataFrame, ties: str = KEEP, folded: DataFrame | None = None
) -> DataFrame:
    """Pricing totals, one row per distinct applying charge; ``totals`` and ``folded`` (``folded_scenarios``) are best
    stored tables."""
    first = F.coalesce("first_charge", F.lit(True))
    folded = folded_scenarios(tables, ties) if folded is None else folded
    return (
        left_join(totals, folded, "scenario_id")
        .withColumns(
            {
                "copies": _or_one("charge_copies"),
                "project_rows": F.when(first, F.col("project_rows")).otherwise(0),
            }
        )
        .drop("charge_copies", "first_charge")
    )
