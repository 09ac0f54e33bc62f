"""Which scenario charge applies to a work order.

The charge of a scenario is its latest one; the effective date is not compared with the job's.
All charges that share the latest date apply, each as often as the scenario has charges at its
earliest date. That multiplicity is carried in ``charge_copies`` instead of repeating rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecharge.sources.tables import Tables

KEEP = "keep"
DEDUPE = "dedupe"


def scenario_bounds(tables: Tables) -> DataFrame:
    """Earliest and latest charge date per scenario."""
    dates = tables.scenario_charges.groupBy("scenario_id").agg(
        F.max("effective_date_at").alias("max_effective_date_at"),
        F.min("effective_date_at").alias("min_effective_date_at"),
    )
    return dates.join(tables.scenarios.select("scenario_id"), "scenario_id", "left_semi")


def _bound_details(tables: Tables) -> DataFrame:
    """Per scenario: latest date, one charge id there, and the number of charges at the earliest.

    Charges are counted per (scenario, date) first, so a scenario with very many charges is
    reduced on the map side and never gathered in one place.
    """
    by_date = (
        tables.scenario_charges.where(F.col("effective_date_at").isNotNull())
        .groupBy("scenario_id", "effective_date_at")
        .agg(
            F.count("scenario_charge_id").alias("_charges"),
            F.min("scenario_charge_id").alias("_first_id"),
        )
    )
    return by_date.groupBy("scenario_id").agg(
        F.max("effective_date_at").alias("_latest"),
        F.max_by("_first_id", "effective_date_at").alias("_first_id"),
        F.min_by("_charges", "effective_date_at").alias("charge_copies"),
    )


def scenario_picks(tables: Tables, which: str = "latest") -> DataFrame:
    """(scenario_id, scenario_charge_id) at the latest or earliest date, ties kept."""
    edge = {"latest": "max_effective_date_at", "earliest": "min_effective_date_at"}[which]
    bounds = scenario_bounds(tables).select("scenario_id", F.col(edge).alias("effective_date_at"))
    return (
        tables.scenario_charges.join(bounds, ["scenario_id", "effective_date_at"])
        .select("scenario_id", "scenario_charge_id")
    )


def custom_charges(tables: Tables) -> DataFrame:
    """Custom per-unit charges summed (percentages averaged) per scenario charge."""
    return tables.custom_per_unit_charges.groupBy("scenario_charge_id").agg(
        F.sum("cost_per_unit").alias("custom_sum_cost_per_unit"),
        F.sum("charge_per_unit").alias("custom_sum_charge_per_unit"),
        F.sum("markup_per_unit").alias("custom_sum_markup_per_unit"),
        F.avg("markup_percentage").alias("custom_avg_markup_percentage"),
        F.avg("percentage").alias("custom_avg_percentage"),
    )


def applying_charges(tables: Tables, ties: str = KEEP) -> DataFrame:
    """Charges of known scenarios at their latest date, with the scenario's unit.

    ``charge_copies`` is the multiplicity; ``ties="dedupe"`` counts every charge once.
    ``first_charge`` marks one row per scenario.
    """
    if ties not in (KEEP, DEDUPE):
        raise ValueError(f"unknown ties rule {ties!r}")
    details = _bound_details(tables).withColumnRenamed("_latest", "effective_date_at")
    units = tables.scenarios.select("scenario_id", F.col("unit_of_measure_id").alias("scen_uom"))
    picked = (
        tables.scenario_charges.join(details, ["scenario_id", "effective_date_at"])
        .join(units, "scenario_id")
        .withColumn("first_charge", F.col("scenario_charge_id") == F.col("_first_id"))
        .drop("_first_id")
    )
    if ties == DEDUPE:
        return picked.withColumn("charge_copies", F.lit(1).cast("bigint"))
    return picked


def priced_scenarios(tables: Tables, ties: str = KEEP) -> DataFrame:
    """Applying charges with the sum of their custom parts."""
    custom = custom_charges(tables).select("scenario_charge_id", "custom_sum_charge_per_unit")
    return applying_charges(tables, ties).join(custom, "scenario_charge_id", "left")


def folded_scenarios(tables: Tables, ties: str = KEEP) -> DataFrame:
    """Priced scenarios with equal charges of a scenario folded into ``charge_copies``."""
    parts = [
        "labour_charge_per_unit",
        "materials_charge_per_unit",
        "overhead_charge_per_unit",
        "overridden_charge_per_unit",
        "custom_sum_charge_per_unit",
    ]
    return (
        priced_scenarios(tables, ties)
        .groupBy("scenario_id", "scen_uom", *parts)
        .agg(
            F.sum("charge_copies").alias("charge_copies"),
            F.max("first_charge").alias("first_charge"),
        )
    )
