"""The eleven input tables as one bundle of lazy DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecharge.functions.numeric import nan_to_null
from sitecharge.operators.periods import START_MONTH
from sitecharge.sources.schemas import ID, INPUT_COLUMNS, UNIQUE_KEYS, input_schema

# Range-filtered at the scan: left bare so that the predicate reaches the files.
# The filters on it exclude NaN themselves.
_SCAN_FILTERED = {("jobs", "produced_quantity_value_in_reference_uom")}
# Kept where the source has it: the folder column of a layout.
_LAYOUT = {"jobs": START_MONTH}


@dataclass(frozen=True)
class Tables:
    sites: DataFrame
    accounts: DataFrame
    companies: DataFrame
    jobs: DataFrame
    work_orders: DataFrame
    uom_contexts: DataFrame
    uom_ratios: DataFrame
    unit_of_measures: DataFrame
    scenarios: DataFrame
    scenario_charges: DataFrame
    custom_per_unit_charges: DataFrame


def typed(df: DataFrame, table: str) -> DataFrame:
    """Select the declared columns with their declared types; NaN becomes NULL."""
    present = {field.name.lower(): field for field in df.schema.fields}
    out = []
    for name, kind in INPUT_COLUMNS[table].items():
        if name not in present:
            raise ValueError(f"table {table} has no column {name}")
        have = present[name].dataType.typeName()
        column = F.col(present[name].name)
        if kind == "double":
            if have != "double":
                column = column.cast("double") if have != "string" else column.try_cast("double")
            if (table, name) not in _SCAN_FILTERED:
                column = nan_to_null(column)
        elif kind == "timestamp":
            if have not in ("timestamp", "timestamp_ntz"):
                column = column.cast("timestamp_ntz")
        elif kind != ID and have != kind:
            column = column.cast(kind)
        out.append(column.alias(name))
    if (layout := _LAYOUT.get(table)) in present:
        out.append(F.col(present[layout].name).alias(layout))
    return df.select(*out)


def load_tables(read: Callable[[str], DataFrame]) -> Tables:
    """Bundle the tables that ``read(name)`` returns, typed and lazy."""
    return Tables(**{f.name: typed(read(f.name), f.name) for f in fields(Tables)})


def tables_from_path(
    spark: SparkSession,
    base: str,
    fmt: str = "parquet",
    id_type: str = "bigint",
    suffix: str = "",
    **options: str,
) -> Tables:
    """One dataset per table below ``base``; text formats are read with the declared schema."""

    def read(name: str) -> DataFrame:
        reader = spark.read.format(fmt).options(**options)
        if fmt in ("csv", "json"):
            reader = reader.schema(input_schema(name, id_type))
        return reader.load(f"{base.rstrip('/')}/{name}{suffix}")

    return load_tables(read)


def tables_from_catalog(spark: SparkSession, namespace: str) -> Tables:
    """Catalog tables ``namespace.<name>``."""
    return load_tables(lambda name: spark.table(f"{namespace}.{name}"))


def validate_keys(tables: Tables) -> dict[str, DataFrame]:
    """Per table, the key values that break the uniqueness or non-null rule of the joins."""
    found = {}
    for table, key in UNIQUE_KEYS.items():
        found[table] = (
            getattr(tables, table)
            .groupBy(key)
            .agg(F.count("*").alias("rows"))
            .where((F.col("rows") > 1) | F.col(key).isNull())
        )
    return found
