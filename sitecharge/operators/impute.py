"""Quantity conversion, imputed unit charge, fill flags and charges per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecharge.functions.charges import FILL_TYPES, fill_type, imputed_charge, modified_quantity
from sitecharge.functions.numeric import nan_to_null

# Per-row charge column -> unit charge it is made of.
CHARGE_PARTS = {
    "total_charge_per_job": "imputed_charge_per_unit",
    "total_charge_per_job_impute": "imputed_charge_per_unit_wo_outliers",
    "materials_charge_per_job": "materials_charge_per_unit",
    "fcpu_charge_per_job": "final_charge_per_unit",
    "overhead_charge_per_job": "overhead_charge_per_unit",
    "labor_charge_per_job": "labour_charge_per_unit",
    "custom_charge_per_job": "custom_sum_charge_per_unit",
    "overridden_charge_per_job": "overridden_charge_per_unit",
}


def add_modified_quantity(df: DataFrame) -> DataFrame:
    return df.withColumn("modified_quantity", modified_quantity(F.col("produced_quantity")))


def add_imputed_charge(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"imputed_charge_per_unit": imputed_charge(), "fill_type": fill_type()}
    )


def add_fill_flags(df: DataFrame) -> DataFrame:
    """One 0/1 column per fill type."""
    return df.withColumns(
        {f"{t}_fill": F.when(F.col("fill_type") == t, 1).otherwise(0) for t in FILL_TYPES}
    )


def impute(df: DataFrame) -> DataFrame:
    return add_imputed_charge(add_modified_quantity(df))


def add_job_charges(df: DataFrame) -> DataFrame:
    """Unit charges times the modified quantity."""
    quantity = F.col("modified_quantity")
    return df.withColumns(
        {name: nan_to_null(F.col(unit) * quantity) for name, unit in CHARGE_PARTS.items()}
    )
