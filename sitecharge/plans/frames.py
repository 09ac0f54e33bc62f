"""The five frames a report is made of, for users who bring or change one of them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecharge.operators.dimensions import case_uom_ratios, site_projection
from sitecharge.operators.jobs import job_facts, scenario_charges, turned_on_dates
from sitecharge.operators.periods import MIDNIGHT, PERIOD, Period
from sitecharge.operators.scenario import KEEP
from sitecharge.operators.skew import small_side
from sitecharge.sources.tables import Tables


@dataclass(frozen=True)
class Frames:
    active_sites: DataFrame
    job_facts: DataFrame
    turned_on: DataFrame
    case_ratios: DataFrame
    scenario_charges: DataFrame


def pull_frames(
    tables: Tables, periods: list[Period], end: str = MIDNIGHT, ties: str = KEEP
) -> Frames:
    """All five, lazily."""
    return Frames(
        active_sites=site_projection(tables),
        job_facts=job_facts(tables, periods, end),
        turned_on=turned_on_dates(tables),
        case_ratios=case_uom_ratios(tables),
        scenario_charges=scenario_charges(tables, periods, end, ties),
    )


def _join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi join in which unknown equals unknown; the keys of ``left`` are kept."""
    theirs = {key: f"_right_{key}" for key in keys}
    same = [F.col(key).eqNullSafe(F.col(theirs[key])) for key in keys]
    on = reduce(lambda a, b: a & b, same)
    return left.join(right.withColumnsRenamed(theirs), on, how).drop(*theirs.values())


def merge_frames(frames: Frames) -> DataFrame:
    """Job facts with their scenario charges, active site and case ratio.

    Works on any frames of these columns, at the price of joining facts with facts;
    ``merged_jobs`` gives the same rows from the tables with one move of the jobs.
    """
    keys = [*PERIOD, "job_id", "site_id", "account_id"]
    priced = _join_same(frames.job_facts, frames.scenario_charges.where("job_id IS NOT NULL"), keys, "left")
    sites = small_side(frames.active_sites, frames.active_sites)
    owned = _join_same(priced, sites, ["site_id", "account_id"], "inner")
    return (
        _join_same(owned, frames.case_ratios, ["account_id", "case_uom_id"], "left")
        .withColumnsRenamed(
            {"ratio_to_reference_uom": "case_ratio", "scenario_charges_id": "scenario_charge_id"}
        )
        .withColumn("copies", F.coalesce("charge_copies", F.lit(1).cast("bigint")))
        .drop("charge_copies")
    )
