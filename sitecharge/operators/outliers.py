"""Per site and period: median absolute deviation, upper bound, outlier flag."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecharge.operators.periods import PERIOD
from sitecharge.operators.quantiles import exact_quantiles, sketched_quantiles, value_sketch
from sitecharge.operators.skew import SALTS, attach_by_key

SITE_PERIOD = [*PERIOD, "site_id"]


@dataclass(frozen=True)
class OutlierRule:
    """Upper bound = quantile + scaled MAD / mad_factor + upper_pad; lower bound is fixed.

    ``sketch_bits``, unset by default, takes quantiles from mergeable sketches: order statistics are then off by
    2^-sketch_bits of themselves at most, of charges and of deviations.
    """

    mad_factor: float = 5
    quantile: float = 0.95
    mad_scale: float = 1.4826
    lower_bound: float = 0.001
    upper_pad: float = 1
    salts: int = SALTS
    sketch_bits: int | None = None


def _quantiles(hist: DataFrame, value: str, probs: dict[str, float], rule: OutlierRule) -> DataFrame:
    if rule.sketch_bits is None:
        return exact_quantiles(hist, SITE_PERIOD, value, "n", probs)
    sketch = value_sketch(hist, SITE_PERIOD, value, "n", rule.sketch_bits)
    return sketched_quantiles(sketch, SITE_PERIOD, probs)


def charge_bounds(
    hist: DataFrame, store: Callable[[DataFrame], DataFrame], rule: OutlierRule = OutlierRule()
) -> DataFrame:
    """Median, quantile, MAD and upper bound per (period, site).

    ``hist`` is read several times: pass a stored table, not a long plan. ``store`` writes a frame and
    returns a reader of it, for the medians, which are read twice.
    """
    value = "imputed_charge_per_unit"
    probs = {"median": 0.5, "high": rule.quantile}
    centre = store(_quantiles(hist, value, probs, rule))
    deviations = attach_by_key(
        hist, centre.select(*SITE_PERIOD, "median"), SITE_PERIOD, value, rule.salts
    ).select(*SITE_PERIOD, F.abs(F.col(value) - F.col("median")).alias("deviation"), "n")
    spread = _quantiles(deviations, "deviation", {"raw_mad": 0.5}, rule)
    mad = F.col("raw_mad") * rule.mad_scale
    return (
        centre.join(spread, SITE_PERIOD)
        .withColumn("mad", mad)
        .withColumn(
            "upper_bound", F.col("high") + F.col("mad") / rule.mad_factor + rule.upper_pad
        )
        .drop("raw_mad")
    )


def is_outlier(rule: OutlierRule = OutlierRule()) -> Column:
    """Above the site's bound or below the fixed one; a job without charge (0) is below it."""
    charge = F.col("imputed_charge_per_unit")
    return (charge > F.col("upper_bound")) | (charge < rule.lower_bound)


def flag_outliers(
    rows: DataFrame, bounds: DataFrame, spread: str, rule: OutlierRule = OutlierRule()
) -> DataFrame:
    """Add outlier_charge (0/1) and the charge with outliers set to 0."""
    outlier = is_outlier(rule)
    upper = bounds.select(*SITE_PERIOD, "upper_bound")
    return attach_by_key(rows, upper, SITE_PERIOD, spread, rule.salts).withColumns(
        {
            "imputed_charge_per_unit_wo_outliers": F.when(outlier, 0.0).otherwise(
                F.col("imputed_charge_per_unit")
            ),
            "outlier_charge": F.when(outlier, 1).otherwise(0),
        }
    )
