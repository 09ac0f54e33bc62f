"""Totals per site and period.

The priced rows are first folded per unit charge (``charge_groups``): an outlier is decided by the
unit charge alone, so the fold can be stored once and serves both the bounds and the rollup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitecharge.functions.charges import FILL_TYPES
from sitecharge.operators.impute import impute
from sitecharge.operators.outliers import OutlierRule, flag_outliers
from sitecharge.operators.periods import PERIOD

SITE_KEYS = [*PERIOD, "company_id", "account_id", "site_id"]
_GROUP = [*SITE_KEYS, "imputed_charge_per_unit"]

# Total in the rollup -> unit charge it sums.
_MONEY = {
    "total_charge": "imputed_charge_per_unit",
    "total_material_charge": "materials_charge_per_unit",
    "total_fcpu": "final_charge_per_unit",
    "total_overhead_charge": "overhead_charge_per_unit",
    "total_labor_charge": "labour_charge_per_unit",
    "total_custom_charge": "custom_sum_charge_per_unit",
    "total_overridden_charge": "overridden_charge_per_unit",
}
# Number of rows in which a unit charge is above zero.
_POSITIVE = {
    "materials_charge_fill_rate": "materials_charge_per_unit",
    "overhead_charge_fill_rate": "overhead_charge_per_unit",
    "labor_charge_fill_rate": "labour_charge_per_unit",
    "custom_charge_fill_rate": "custom_sum_charge_per_unit",
    "overridden_charge_fill_rate": "overridden_charge_per_unit",
}
_FILLS = [f"{t}_fill" for t in FILL_TYPES]
# Measures that do not add up.
_OVER = {"first_job_created_date": "min", "last_job_created_date": "max"}
#: Sketch of a group's projects.
SKETCH = "project_sketch"

# What the report itself reads; the rest of the rollup is for users of the rollup.
REPORT_MEASURES = [
    "n",
    "total_num_jobs",
    "total_number_of_projects",
    "total_charge",
    "total_material_charge",
    "total_fcpu",
    *_FILLS,
]


def _measures() -> dict[str, str]:
    """SQL of every measure; rows count job_rows * copies times."""
    weight = "job_rows * copies"
    out = {
        "n": f"sum({weight})",
        "total_num_jobs": "sum(job_count * copies)",
        "total_number_of_projects": "sum(project_rows)",
        "first_job_created_date": "min(first_created_at)",
        "last_job_created_date": "max(last_created_at)",
    }
    for name, unit in _MONEY.items():
        # an infinite quantity times a zero charge is no value
        out[name] = f"sum(nullif({unit} * (modified_quantity * copies), double('NaN')))"
    for name, unit in _POSITIVE.items():
        out[name] = f"sum(CASE WHEN {unit} > 0 THEN {weight} ELSE 0 END)"
    for label in FILL_TYPES:
        out[f"{label}_fill"] = f"sum(CASE WHEN fill_type = '{label}' THEN {weight} ELSE 0 END)"
    return out


def charge_groups(
    priced: DataFrame, measures: list[str] | None = None, project_bits: int | None = None
) -> DataFrame:
    """Fold priced totals per (period, site keys, imputed unit charge).

    The imputed charge is part of the shuffle key, so the rows of one big site spread out, and a
    charge that very many rows share (0, say) is combined before the shuffle. With ``project_bits`` a mergeable
    sketch of the projects of each group is added.
    """
    made = _measures()
    names = list(made) if measures is None else measures
    aggs = [F.expr(f"{made[n]} AS {n}") for n in names]
    if project_bits is not None:
        aggs.append(F.hll_sketch_agg("project_id", project_bits).alias(SKETCH))
    return impute(priced).groupBy(*_GROUP).agg(*aggs)


def project_groups(rows: DataFrame, measures: list[str] | None = None) -> DataFrame:
    """``charge_groups`` of job rows, with total_number_of_projects a count of distinct projects per site.

    The rows are folded per project as well; of the few charges that a project has at a site the least carries
    the 1. Rows without project carry none.
    """
    made = _measures()
    names = list(made) if measures is None else measures
    per_project = impute(rows).groupBy(*_GROUP, "project_id")
    folded = per_project.agg(*[F.expr(f"{made[n]} AS {n}") for n in names])
    charges = Window.partitionBy(*SITE_KEYS, "project_id").orderBy("imputed_charge_per_unit")
    first = F.col("project_id").isNotNull() & (F.row_number().over(charges) == 1)
    marked = folded.withColumn("total_number_of_projects", first.cast("bigint"))
    aggs = [F.expr(f"{_OVER.get(n, 'sum')}({n}) AS {n}") for n in names]
    return marked.groupBy(*_GROUP).agg(*aggs)


def site_rollup(
    groups: DataFrame, bounds: DataFrame, rule: OutlierRule = OutlierRule()
) -> DataFrame:
    """One row per (period, company, account, site). Sums without any value are 0."""
    flagged = flag_outliers(groups, bounds, "imputed_charge_per_unit", rule)
    aggs = {
        "total_charge_impute": "sum(CASE WHEN outlier_charge = 0 THEN total_charge END)",
        "charge_fill_rate": "sum(CASE WHEN imputed_charge_per_unit > 0 THEN n ELSE 0 END)",
        "charge_fill_rate_wo_outliers": "sum(CASE WHEN outlier_charge = 0"
        " AND imputed_charge_per_unit > 0 THEN n ELSE 0 END)",
        "num_outliers": "sum(outlier_charge * n)",
    }
    for name in groups.columns:
        if name not in (*_GROUP, "n"):
            aggs[name] = f"{_OVER.get(name, 'sum')}({name})"
    for name in ("total_charge_impute", *_MONEY):
        if name in aggs:
            aggs[name] = f"coalesce({aggs[name]}, 0D)"
    return flagged.groupBy(*SITE_KEYS).agg(*[F.expr(f"{a} AS {n}") for n, a in aggs.items()])
