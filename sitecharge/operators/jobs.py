"""Jobs of the reporting periods, at job grain and folded to work-order totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecharge.operators.dimensions import item_units, site_lookup
from sitecharge.operators.periods import MIDNIGHT, PERIOD, START_MONTH, Period, in_month, in_months, tag_periods
from sitecharge.operators.scenario import KEEP, applying_charges, priced_scenarios, scenario_picks
from sitecharge.operators.skew import lookup_join
from sitecharge.sources.tables import Tables

# Smallest quantities that count, for job facts and for scenario charges.
MIN_JOBQUANTITY = 0.99
MIN_SCENARIOQUANTITY = 0.0

QUANTITY = "produced_quantity_value_in_reference_uom"


def period_jobs(
    tables: Tables,
    periods: list[Period],
    above: float = MIN_JOBQUANTITY,
    end: str = MIDNIGHT,
) -> DataFrame:
    """Jobs started in a period with a quantity above the floor, tagged with the period."""
    quantity = F.col(QUANTITY)
    counted = tables.jobs.where((quantity > above) & ~F.isnan(quantity))
    return tag_periods(in_months(counted, periods), "actual_start_at", periods, end)


def job_facts(tables: Tables, periods: list[Period], end: str = MIDNIGHT) -> DataFrame:
    """Job with work order, site account, unit data and quantity in the item's default unit.

    Unit data is attached to the work orders first; the jobs are then joined once, on
    work_order_id.
    """
    orders = lookup_join(tables.work_orders, item_units(tables), ["item_id"], "work_order_id")
    orders = orders.withColumn("project_id", F.col("work_order_id"))
    accounts = tables.sites.select("site_id", "account_id")
    return (
        lookup_join(period_jobs(tables, periods, end=end), orders, ["work_order_id"], "job_id")
        .join(site_lookup(tables, accounts), "site_id", "left")
        .select(
            *PERIOD,
            "account_id",
            "site_id",
            "project_id",
            "final_charge_per_unit",
            "scenario_id",
            "job_id",
            "created_at",
            F.col("created_at").alias("created_at_v2"),
            F.try_divide(QUANTITY, "default_ratio").alias("produced_quantity"),
            "uom_produced",
            "uom_produced_label",
            F.col("item_id").alias("sku_id"),
            "case_uom_id",
            "pallet_uom_id",
            F.col("uom_produced").alias("ratio_uom"),
            "uom_ratios_id",
        )
    )


def scenario_charges(
    tables: Tables, periods: list[Period], end: str = MIDNIGHT, ties: str = KEEP
) -> DataFrame:
    """Job with each scenario charge that applies to it; ``charge_copies`` is its multiplicity."""
    labels = tables.unit_of_measures.select(
        F.col("unit_of_measure_id").alias("scen_uom"), F.col("label").alias("scen_uom_label")
    )
    priced = priced_scenarios(tables, ties).where(F.col("scenario_charge_id").isNotNull())
    orders = (
        tables.work_orders.select("work_order_id", "scenario_id")
        .join(priced, "scenario_id")
        .join(labels, "scen_uom", "left")
    )
    accounts = tables.sites.select("site_id", F.col("account_id").alias("_account_id")).join(
        tables.accounts.select("account_id"), F.col("_account_id") == F.col("account_id"), "left"
    )
    return (
        period_jobs(tables, periods, MIN_SCENARIOQUANTITY, end)
        .where(F.col("job_id").isNotNull())
        .join(orders, "work_order_id")
        .join(site_lookup(tables, accounts), "site_id", "left")
        .select(
            *PERIOD,
            "account_id",
            "site_id",
            "job_id",
            F.col("scenario_charge_id").alias("scenario_charges_id"),
            "effective_date_at",
            "labour_charge_per_unit",
            "materials_charge_per_unit",
            "overhead_charge_per_unit",
            "overridden_charge_per_unit",
            "custom_sum_charge_per_unit",
            "scen_uom",
            "scen_uom_label",
            "charge_copies",
        )
    )


def job_picks(
    tables: Tables, periods: list[Period], which: str = "latest", end: str = MIDNIGHT
) -> DataFrame:
    """Distinct (job, scenario charge at the latest or earliest date); NULL where there is none.

    Job ids and charge ids are unique, so only the rows of jobs without id can repeat.
    """
    orders = tables.work_orders.select("work_order_id", "scenario_id").join(
        scenario_picks(tables, which), "scenario_id", "left"
    )
    counted = period_jobs(tables, periods, MIN_SCENARIOQUANTITY, end)
    named = lookup_join(
        counted.where(F.col("job_id").isNotNull()), orders, ["work_order_id"], "job_id"
    )
    pair = ["job_id", "scenario_charge_id"]
    return named.select(*pair).unionByName(_nameless_picks(counted, orders).select(*pair))


def _nameless_picks(counted: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct picks of the jobs without id, found per work order first."""
    nameless = counted.where(F.col("job_id").isNull()).select("work_order_id", "job_id").distinct()
    return nameless.join(orders, "work_order_id", "left").select("job_id", "scenario_charge_id").distinct()


def resolved_charges(
    tables: Tables, periods: list[Period], end: str = MIDNIGHT, ties: str = KEEP
) -> DataFrame:
    """(job, applying scenario charge) with the multiplicity of the pair.

    Jobs without id cannot be matched with themselves: what they pick at the latest and at the earliest date
    stands side by side, each distinct charge once.
    """
    orders = tables.work_orders.select("work_order_id", "scenario_id").join(
        applying_charges(tables, ties).select("scenario_id", "scenario_charge_id", "charge_copies"),
        "scenario_id",
        "left",
    )
    counted = period_jobs(tables, periods, MIN_SCENARIOQUANTITY, end)
    named = lookup_join(
        counted.where(F.col("job_id").isNotNull()), orders, ["work_order_id"], "job_id"
    ).select(
        "job_id",
        "scenario_charge_id",
        F.coalesce("charge_copies", F.lit(1).cast("bigint")).alias("copies"),
    )
    at_work = tables.work_orders.select("work_order_id", "scenario_id")
    nameless = [
        _nameless_picks(counted, at_work.join(scenario_picks(tables, which), "scenario_id", "left"))
        for which in ("latest", "earliest")
    ]
    pairs = nameless[0].unionByName(nameless[1]).groupBy("job_id", "scenario_charge_id")
    return named.unionByName(pairs.agg(F.count("*").alias("copies")))


def first_starts(jobs: DataFrame, *by: str) -> DataFrame:
    """First start per site and work order, and per ``by``; the jobs are folded before they move."""
    known = ("work_order_id", "site_id", "actual_start_at")
    counted = jobs.where(" AND ".join(f"{name} IS NOT NULL" for name in known))
    return counted.groupBy("site_id", "work_order_id", *by).agg(F.min("actual_start_at").alias("first_start"))


def turned_on_dates(tables: Tables, starts: DataFrame | None = None) -> DataFrame:
    """First start of a job with a final charge, per company and account, over all time.

    The jobs are folded per (site, work order) before any join, which is all that crosses the
    network of the full history. ``starts`` are stored ``first_starts`` to be used instead, of any parts of the history.
    """
    found = first_starts(tables.jobs) if starts is None else starts
    charged = tables.work_orders.where(F.col("final_charge_per_unit").isNotNull()).select(
        "work_order_id"
    )
    accounts = tables.accounts.withColumnRenamed("company_id", "_company_id").join(
        tables.companies.select("company_id"),
        F.col("_company_id") == F.col("company_id"),
        "left",
    )
    owners = (
        tables.sites.where("active")
        .withColumnRenamed("account_id", "_account_id")
        .join(accounts, F.col("_account_id") == F.col("account_id"), "left")
        .select("site_id", "company_id", "account_id")
    )
    return (
        found.join(charged, "work_order_id")
        .groupBy("site_id")
        .agg(F.min("first_start").alias("_start"))
        .join(owners, "site_id")
        .groupBy("company_id", "account_id")
        .agg(F.min("_start").alias("date_ov_turned_on"))
    )


def _totals(counted: Column, dates: bool) -> Column:
    """Of a group's ``counted`` jobs, the totals of those with and of those without id; the empty ones are left out later."""
    named = F.col("job_id").isNotNull()

    def total(these: Column, has_id: bool) -> Column:
        created = F.when(these, F.col("created_at"))
        created_columns = [
            F.min(created).alias("first_created_at"),
            F.max(created).alias("last_created_at"),
        ]
        return F.struct(
            F.sum(F.when(these, F.col(QUANTITY))).alias("reference_quantity"),
            F.count_if(these).alias("job_rows"),
            F.lit(has_id).alias("has_id"),
            *(created_columns if dates else []),
        )

    return F.array(total(counted & named, True), total(counted & ~named, False))


def _total_rows(folded: DataFrame) -> DataFrame:
    """A row per total of ``_totals`` that has jobs."""
    there = F.filter("_totals", lambda t: t["job_rows"] > 0)
    return folded.select(
        *PERIOD, "site_id", "work_order_id", F.posexplode(there).alias("_at", "_t")
    ).select(
        *PERIOD,
        "site_id",
        "work_order_id",
        "_t.*",
        F.when(F.col("_t.has_id"), F.col("_t.job_rows")).otherwise(0).alias("job_count"),
        (F.col("_at") == 0).alias("first_of_order"),
    )


def job_totals(
    tables: Tables, periods: list[Period], end: str = MIDNIGHT, dates: bool = True
) -> DataFrame:
    """Period jobs folded per (period, site, work order).

    All jobs of a work order at a site share every charge, and job value is linear in the
    quantity, so the fold loses nothing the report needs. Partial aggregation happens before the
    shuffle: a work order that owns a large part of all jobs arrives as one row per task. Jobs
    without id have no scenario charge and form a row of their own (``has_id``);
    ``first_of_order`` is true on one row per work order. ``dates`` adds the first and last creation.
    """
    counted = period_jobs(tables, periods, end=end).groupBy(*PERIOD, "site_id", "work_order_id")
    return _total_rows(counted.agg(_totals(F.lit(True), dates).alias("_totals")))


def month_sums(jobs: DataFrame, end: str = MIDNIGHT) -> DataFrame:
    """Jobs laid out by month, folded once per (month, site, work order) into what ``totals_of_months`` and
    ``starts_of_months`` take apart: the totals of ``job_totals`` of whole months, and the first start of any job.
    """
    quantity, start = F.col(QUANTITY), F.col("actual_start_at")
    counted = (quantity > MIN_JOBQUANTITY) & ~F.isnan(quantity) & in_month(start, F.col(START_MONTH), end)
    return jobs.groupBy(START_MONTH, "site_id", "work_order_id").agg(
        _totals(counted, dates=True).alias("_totals"), F.min(start).alias("first_start")
    )


def totals_of_months(sums: DataFrame) -> DataFrame:
    """``job_totals`` of the months of ``month_sums``."""
    month = F.col(START_MONTH)
    return _total_rows(sums.withColumns({"start_date": month, "end_date": F.last_day(month)}))


def starts_of_months(sums: DataFrame) -> DataFrame:
    """``first_starts`` of the months of ``month_sums``, per month."""
    known = ("work_order_id", "site_id", "first_start")
    found = sums.where(" AND ".join(f"{name} IS NOT NULL" for name in known))
    return found.select("site_id", "work_order_id", START_MONTH, "first_start")
