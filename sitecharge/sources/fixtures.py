"""Sample input tables derived from a TPC-H-like data set.

One text per table serves Spark and any ANSI SQL engine. Charges are multiples of 0.25, quantities
halves and ratios powers of two, so sums and products are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitecharge.sources.tables import Tables, load_tables

# Source tables with their columns, declared so that reading them needs no look at the files.
SOURCE_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
    " c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
    " p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,"
    " l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}

# Keys of region, used as units of measure.
UNITS = range(5)

# table -> (row source, {column: expression}, distinct)
VIEWS: dict[str, tuple[str, dict[str, str], bool]] = {
    "companies": ("{region}", {"company_id": "r_regionkey"}, False),
    "accounts": (
        "{nation}",
        {
            "account_id": "n_nationkey",
            "company_id": "CASE WHEN n_nationkey % 13 = 12 THEN NULL ELSE n_regionkey END",
            "enable_order_value_pricing_model": "n_nationkey % 2 = 0",
        },
        False,
    ),
    "sites": (
        "{supplier}",
        {
            "site_id": "s_suppkey",
            "account_id": (
                "CASE WHEN s_suppkey % 17 = 7 THEN NULL WHEN s_suppkey % 17 = 8 THEN 999"
                " ELSE s_nationkey END"
            ),
            "active": "s_suppkey % 9 <> 8",
        },
        False,
    ),
    "unit_of_measures": (
        "{region}",
        {
            "unit_of_measure_id": "r_regionkey",
            "label": "concat('UOM', CAST(r_regionkey AS VARCHAR(4)))",
        },
        False,
    ),
    # every account has a ratio for every unit; a few are zero, as case or as default ratio
    "uom_ratios": (
        "(" + " UNION ALL ".join(f"SELECT n_nationkey, {u} AS unit FROM {{nation}}" for u in UNITS)
        + ") AS account_units",
        {
            "uom_ratio_id": "n_nationkey * 10 + unit",
            "account_id": "n_nationkey",
            "unit_of_measure_id": "unit",
            "ratio_to_reference_uom": (
                "CAST(CASE WHEN n_nationkey % 9 = 4 AND unit = 1 THEN 0 WHEN n_nationkey % 12 = 5"
                " AND unit = 2 THEN 0 ELSE power(2.0, unit) END AS DOUBLE)"
            ),
        },
        False,
    ),
    # one item in six has two equal contexts, another one two that differ in the default ratio
    "uom_contexts": (
        "(SELECT p_partkey, p_size, 0 AS again FROM {part} UNION ALL"
        " SELECT p_partkey, p_size + p_partkey % 6, 1 FROM {part} WHERE p_partkey % 6 < 2)"
        " AS contexts",
        {
            "item_id": "p_partkey",
            "default_uom_ratio_id": "(p_partkey % 25) * 10 + p_size % 5",
            "case_uom_ratio_id": (
                "CASE WHEN p_partkey % 11 = 10 THEN NULL ELSE (p_partkey % 25) * 10 + 2 END"
            ),
            "full_pallet_uom_ratio_id": "(p_partkey % 25) * 10 + 4",
        },
        False,
    ),
    "work_orders": (
        "{lineitem} JOIN {supplier} ON s_suppkey = l_suppkey",
        {
            "work_order_id": "l_suppkey * 100 + l_orderkey % 40",
            "item_id": (
                "CASE WHEN l_orderkey % 40 = 13 THEN NULL"
                " ELSE s_nationkey + 25 * ((l_suppkey * 7 + l_orderkey % 40) % (SELECT"
                " CAST(floor((max(p_partkey) + 1) / 25) AS BIGINT) FROM {part})) END"
            ),
            "scenario_id": (
                "CASE WHEN l_orderkey % 40 % 7 = 6 THEN NULL"
                " ELSE (l_suppkey * 40 + l_orderkey % 40) %"
                " (SELECT max(c_custkey) + 1 FROM {customer}) END"
            ),
            "final_charge_per_unit": (
                "CAST(CASE WHEN l_orderkey % 40 = 35 THEN 500"
                " WHEN l_orderkey % 40 % 5 = 0 THEN 5 + l_suppkey % 10 + (l_orderkey % 40) * 0.25"
                " WHEN l_orderkey % 40 % 5 = 1 THEN 0 ELSE NULL END AS DOUBLE)"
            ),
        },
        True,
    ),
    "jobs": (
        "{lineitem}",
        {
            "job_id": (
                "CASE WHEN l_orderkey % 31 = 9 THEN NULL ELSE"
                " (l_orderkey * 10 + l_linenumber) * 100 + ROW_NUMBER() OVER ("
                "PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey, l_partkey, l_shipdate,"
                " l_quantity, l_extendedprice, l_discount, l_tax) END"
            ),
            "site_id": "CASE WHEN l_orderkey % 53 = 7 THEN NULL ELSE l_suppkey END",
            "work_order_id": (
                "CASE WHEN l_orderkey % 40 = 17 THEN NULL WHEN l_orderkey % 40 = 18"
                " THEN -1 - l_suppkey ELSE l_suppkey * 100 + l_orderkey % 40 END"
            ),
            "created_at": "l_shipdate",
            "actual_start_at": "l_shipdate + INTERVAL '1' HOUR * (l_orderkey % 24)",
            "produced_quantity_value_in_reference_uom": (
                "CASE WHEN l_linenumber = 7 THEN 0.5 ELSE l_quantity END"
            ),
        },
        False,
    ),
    "scenarios": (
        "{customer}",
        {"scenario_id": "c_custkey", "unit_of_measure_id": "c_nationkey % 5"},
        False,
    ),
    "scenario_charges": (
        "{orders}",
        {
            "scenario_charge_id": "o_orderkey",
            "scenario_id": "o_custkey",
            "effective_date_at": "CAST(date_trunc('year', o_orderdate) AS TIMESTAMP)",
            "labour_charge_per_unit": (
                "CAST(CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE (o_orderkey % 9) * 0.5 END"
                " AS DOUBLE)"
            ),
            "materials_charge_per_unit": "CAST((o_orderkey % 7) * 0.75 AS DOUBLE)",
            "overhead_charge_per_unit": "CAST((o_orderkey % 4) * 0.25 AS DOUBLE)",
            "overridden_charge_per_unit": (
                "CAST(CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 20) * 0.5 ELSE NULL END"
                " AS DOUBLE)"
            ),
        },
        False,
    ),
    # one charge in four has no custom parts; the rows without a charge stay in the table
    "custom_per_unit_charges": (
        "{lineitem}",
        {
            "scenario_charge_id": "CASE WHEN l_orderkey % 4 = 3 THEN NULL ELSE l_orderkey END",
            "cost_per_unit": "CAST(l_linenumber * 0.25 AS DOUBLE)",
            "charge_per_unit": "CAST((l_linenumber - 1) * 0.5 AS DOUBLE)",
            "markup_per_unit": "CAST(l_linenumber * 0.25 AS DOUBLE)",
            "markup_percentage": "l_discount",
            "percentage": "l_tax",
        },
        False,
    ),
}


def view_sql(table: str) -> str:
    """SELECT text of a table, with ``{source}`` marks for the tables it reads."""
    rows, columns, distinct = VIEWS[table]
    listed = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return f"SELECT {'DISTINCT ' if distinct else ''}{listed} FROM {rows}"


def sample_tables(spark: SparkSession, sf_dir: str) -> Tables:
    sources = {
        name: spark.read.schema(columns).parquet(f"{sf_dir}/{name}.parquet")
        for name, columns in SOURCE_TABLES.items()
    }

    def read(table: str) -> DataFrame:
        text = view_sql(table)
        used = {name: df for name, df in sources.items() if "{" + name + "}" in text}
        return spark.sql(text, **used)

    return load_tables(read)
