"""Declared columns of the eleven input tables and of the report.

``ID`` columns keep whatever type the source gives them (integers in one warehouse, strings in
another); they are only ever compared, never computed with.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID = "id"

INPUT_COLUMNS: dict[str, dict[str, str]] = {
    "sites": {"site_id": ID, "account_id": ID, "active": "boolean"},
    "accounts": {
        "account_id": ID,
        "company_id": ID,
        "enable_order_value_pricing_model": "boolean",
    },
    "companies": {"company_id": ID},
    "jobs": {
        "job_id": ID,
        "site_id": ID,
        "work_order_id": ID,
        "created_at": "timestamp",
        "actual_start_at": "timestamp",
        "produced_quantity_value_in_reference_uom": "double",
    },
    "work_orders": {
        "work_order_id": ID,
        "item_id": ID,
        "scenario_id": ID,
        "final_charge_per_unit": "double",
    },
    "uom_contexts": {
        "item_id": ID,
        "default_uom_ratio_id": ID,
        "case_uom_ratio_id": ID,
        "full_pallet_uom_ratio_id": ID,
    },
    "uom_ratios": {
        "uom_ratio_id": ID,
        "account_id": ID,
        "unit_of_measure_id": ID,
        "ratio_to_reference_uom": "double",
    },
    "unit_of_measures": {"unit_of_measure_id": ID, "label": "string"},
    "scenarios": {"scenario_id": ID, "unit_of_measure_id": ID},
    "scenario_charges": {
        "scenario_charge_id": ID,
        "scenario_id": ID,
        "effective_date_at": "timestamp",
        "labour_charge_per_unit": "double",
        "materials_charge_per_unit": "double",
        "overhead_charge_per_unit": "double",
        "overridden_charge_per_unit": "double",
    },
    "custom_per_unit_charges": {
        "scenario_charge_id": ID,
        "cost_per_unit": "double",
        "charge_per_unit": "double",
        "markup_per_unit": "double",
        "markup_percentage": "double",
        "percentage": "double",
    },
}

# Keys the joins take to be unique and non-null.
UNIQUE_KEYS: dict[str, str] = {
    "sites": "site_id",
    "accounts": "account_id",
    "companies": "company_id",
    "jobs": "job_id",
    "work_orders": "work_order_id",
    "uom_ratios": "uom_ratio_id",
    "unit_of_measures": "unit_of_measure_id",
    "scenarios": "scenario_id",
    "scenario_charges": "scenario_charge_id",
}

# The report columns in write order.
REPORT_COLUMNS = [
    "START_DATE",
    "END_DATE",
    "COMPANY_ID",
    "ACCOUNT_ID",
    "SITE_ID",
    "DATE_OV_TURNED_ON",
    "TOTAL_NUMBER_OF_PROJECTS",
    "TOTAL_NUM_JOBS",
    "PERCENT_FCPU",
    "TOTAL_FCPU",
    "PERCENT_OVERRIDDEN",
    "PERCENT_SUM_SCENARIO",
    "PERCENT_SUM_SCENARIO_WO_CUSTOM",
    "PERCENT_NO_CHARGES",
    "PERCENT_FILL_RATE",
    "PERCENT_OV_MATERIALS",
    "OV_W_OUTLIERS",
    "PERCENT_OUTLIERS",
    "OV_WO_OUTLIERS",
    "ADJUSTED_OV_WO_OUTLIERS",
]
PERCENT_COLUMNS = [name for name in REPORT_COLUMNS if name.startswith("PERCENT_")]
MONEY_COLUMNS = [n for n in REPORT_COLUMNS if n == "TOTAL_FCPU" or n.endswith("_OUTLIERS")]
MONEY_COLUMNS = [name for name in MONEY_COLUMNS if name not in PERCENT_COLUMNS]
LOAD_STAMP = "UPDATED_AT"
ID_COLUMNS = ["COMPANY_ID", "ACCOUNT_ID", "SITE_ID"]


def input_schema(table: str, id_type: str = "bigint") -> T.StructType:
    """Read schema for sources that carry no types of their own (CSV, JSON)."""
    columns = INPUT_COLUMNS[table]
    ddl = ", ".join(f"{name} {id_type if kind == ID else kind}" for name, kind in columns.items())
    return T.StructType.fromDDL(ddl)
