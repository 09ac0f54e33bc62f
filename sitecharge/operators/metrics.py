"""Ratios, extrapolated values, and the value adjusted for materials."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecharge.functions.numeric import float_divide
from sitecharge.operators.rollup import SITE_KEYS

_RATES = [
    "materials_charge_fill_rate",
    "overhead_charge_fill_rate",
    "labor_charge_fill_rate",
    "custom_charge_fill_rate",
    "overridden_charge_fill_rate",
]
_PERCENTS = {
    "percent_fill_rate": "charge_fill_rate",
    "percent_fcpu": "fcpu_fill",
    "percent_overridden": "overridden_fill",
    "percent_sum_scenario": "sum_scenario_fill",
    "percent_sum_scenario_wo_custom": "sum_scenario_wo_custom_fill",
    "percent_no_charges": "no_charge_fill",
    "percent_outliers": "num_outliers",
}
# Totals that stay beside the ratios, those of them that the rollup has.
_KEPT = [
    "charge_fill_rate",
    "charge_fill_rate_wo_outliers",
    "fcpu_fill",
    "total_custom_charge",
    "total_fcpu",
    "total_labor_charge",
    "total_material_charge",
    "total_num_jobs",
    "total_number_of_projects",
    "total_overhead_charge",
    "total_overridden_charge",
]


@dataclass(frozen=True)
class MaterialsRule:
    """Materials share from ``floor`` up to below ``cap`` counts at ``floor`` plus ``rate`` of the
    part above ``floor``."""

    floor: float = 0.1
    cap: float = 1
    rate: float = 0.05


def site_ratios(rollup: DataFrame) -> DataFrame:
    """Shares of the jobs, and totals extrapolated to the jobs without a charge."""
    jobs = F.col("total_num_jobs").cast("double")

    def share(name: str) -> Column:
        return float_divide(F.col(name).cast("double"), jobs)

    new = {name: share(source) for name, source in _PERCENTS.items()}
    new["ov_extrapolated"] = float_divide(F.col("total_charge"), share("charge_fill_rate"))
    new["ov_impute_extrapolated"] = float_divide(
        F.col("total_charge_impute"), share("charge_fill_rate_wo_outliers")
    )
    new.update({name: share(name) for name in _RATES if name in rollup.columns})
    kept = [name for name in _KEPT if name in rollup.columns]
    return rollup.select(*SITE_KEYS, *kept, *(made.alias(name) for name, made in new.items()))


def add_materials_share(ratios: DataFrame) -> DataFrame:
    """Materials total, outliers included, over the extrapolated value without outliers."""
    share = float_divide(F.col("total_material_charge"), F.col("ov_impute_extrapolated"))
    return ratios.withColumn("percent_ov_impute_materials", share)


def add_adjusted_value(ratios: DataFrame, rule: MaterialsRule = MaterialsRule()) -> DataFrame:
    value, share = F.col("ov_impute_extrapolated"), F.col("percent_ov_impute_materials")
    adjusted = (
        value * (1 - share)
        + value * rule.floor
        + value * (share - rule.floor) * rule.rate
    )
    applies = (share >= rule.floor) & (share < rule.cap)
    return ratios.withColumn(
        "adjusted_ov_impute_extrapolated", F.when(applies, adjusted).otherwise(value)
    )


def zero_missing(ratios: DataFrame) -> DataFrame:
    """Values that could not be computed (no filled job) count as 0."""
    return ratios.na.fill(
        0.0,
        [
            "percent_ov_impute_materials",
            "ov_extrapolated",
            "ov_impute_extrapolated",
            "adjusted_ov_impute_extrapolated",
        ],
    )


def adjusted_values(ratios: DataFrame, rule: MaterialsRule = MaterialsRule()) -> DataFrame:
    return zero_missing(add_adjusted_value(add_materials_share(ratios), rule))
