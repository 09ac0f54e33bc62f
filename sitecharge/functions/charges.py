"""Unit charge of a job: the fallback order, the label of the rung used, unit conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitecharge.functions.numeric import float_divide

# Labels of the fallback rungs, in order, and of the case where none applies.
FILL_TYPES = ["fcpu", "overridden", "sum_scenario", "sum_scenario_wo_custom", "no_charge"]


_THREE_PARTS = "labour_charge_per_unit + materials_charge_per_unit + overhead_charge_per_unit"

# Candidate charge per fill type, best first. A sum with a missing part is NULL.
_RUNGS = {
    "fcpu": "final_charge_per_unit",
    "overridden": "overridden_charge_per_unit",
    "sum_scenario": f"{_THREE_PARTS} + custom_sum_charge_per_unit",
    "sum_scenario_wo_custom": _THREE_PARTS,
}


def imputed_charge() -> Column:
    """First candidate above zero, else 0."""
    whens = " ".join(f"WHEN {charge} > 0 THEN {charge}" for charge in _RUNGS.values())
    return F.expr(f"CASE {whens} ELSE 0D END")


def fill_type() -> Column:
    """Which candidate ``imputed_charge`` took."""
    whens = " ".join(f"WHEN {charge} > 0 THEN '{label}'" for label, charge in _RUNGS.items())
    return F.expr(f"CASE {whens} ELSE 'no_charge' END")


def modified_quantity(quantity: Column) -> Column:
    """Quantity in the scenario's unit: through the case ratio when the units differ.

    Without scenario unit the quantity stays. An unknown produced unit counts as different.
    """
    differs = F.expr("scen_uom IS NOT NULL AND NOT uom_produced <=> scen_uom")
    return F.when(differs, float_divide(quantity, F.col("case_ratio"))).otherwise(quantity)
