"""Sites with their owners, unit ratios, and unit data per work order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecharge.operators.skew import small_side
from sitecharge.sources.tables import Tables


def active_sites(tables: Tables) -> DataFrame:
    """Active sites with account and company, either NULL where the owner is unknown."""
    companies = tables.companies.select("company_id")
    accounts = tables.accounts.withColumnRenamed("company_id", "_company_id").join(
        companies.withColumn("_known", F.lit(True)),
        F.col("_company_id") == F.col("company_id"),
        "left",
    )
    sites = tables.sites.where("active").withColumnRenamed("account_id", "_site_account_id")
    return sites.join(
        accounts, F.col("_site_account_id") == F.col("account_id"), "left"
    ).select(
        "company_id",
        "account_id",
        "enable_order_value_pricing_model",
        "site_id",
        "_site_account_id",
    )


def site_projection(tables: Tables) -> DataFrame:
    return active_sites(tables).drop("_site_account_id")


def owned_sites(tables: Tables) -> DataFrame:
    """Active sites whose account, as the job side sees it, equals the resolved one.

    Unknown equals unknown here: a site without account is kept with NULL owners, a site whose
    account does not exist is not.
    """
    return (
        active_sites(tables)
        .where(F.col("_site_account_id").eqNullSafe(F.col("account_id")))
        .select("company_id", "account_id", "site_id", "enable_order_value_pricing_model")
    )


def site_lookup(tables: Tables, sites: DataFrame) -> DataFrame:
    """``sites`` (one row per site id) for a join with the fact: broadcast when small."""
    return small_side(sites, tables.sites, tables.accounts, tables.companies)


def reportable_sites(tables: Tables) -> DataFrame:
    """Owned sites that can appear in the report: no part of the group key is unknown."""
    return (
        owned_sites(tables)
        .select("company_id", "account_id", "site_id")
        .where("company_id IS NOT NULL AND account_id IS NOT NULL AND site_id IS NOT NULL")
    )


def report_keys(tables: Tables, report: DataFrame) -> DataFrame:
    """Report rows whose keys belong to an active site."""
    keys = active_sites(tables).select("company_id", "account_id", "site_id")
    same = [report[k].eqNullSafe(keys[k]) for k in keys.columns]
    return report.join(keys, same[0] & same[1] & same[2], "left_semi")


def case_uom_ratios(tables: Tables) -> DataFrame:
    return tables.uom_ratios.select(
        "account_id", "ratio_to_reference_uom", F.col("uom_ratio_id").alias("case_uom_id")
    )


def _default_ratios(tables: Tables) -> DataFrame:
    return tables.uom_ratios.select(
        F.col("uom_ratio_id").alias("uom_ratios_id"),
        F.col("unit_of_measure_id").alias("uom_produced"),
        F.col("ratio_to_reference_uom").alias("default_ratio"),
    )


def item_units(tables: Tables) -> DataFrame:
    """Per item context: default unit and ratio, unit label, case and pallet ratio ids."""
    labels = tables.unit_of_measures.select(
        F.col("unit_of_measure_id").alias("uom_produced"),
        F.col("label").alias("uom_produced_label"),
    )
    return (
        tables.uom_contexts.select(
            "item_id",
            F.col("default_uom_ratio_id").alias("uom_ratios_id"),
            F.col("case_uom_ratio_id").alias("case_uom_id"),
            F.col("full_pallet_uom_ratio_id").alias("pallet_uom_id"),
        )
        .withColumnRenamed("uom_ratios_id", "_ratio")
        .join(_default_ratios(tables), F.col("_ratio") == F.col("uom_ratios_id"), "left")
        .drop("_ratio")
        .join(labels, "uom_produced", "left")
    )


def weighted_item_units(tables: Tables) -> DataFrame:
    """Unit data per item for pricing, equal contexts folded into ``context_copies``.

    ``first_context`` marks one row per item, so that a count over items (or over work orders,
    which have one item each) can be taken as a sum after the fan-out.
    """
    pair = ["_default_id", "_case_id"]
    contexts = tables.uom_contexts.select(
        "item_id",
        F.col("default_uom_ratio_id").alias("_default_id"),
        F.col("case_uom_ratio_id").alias("_case_id"),
    ).where("item_id IS NOT NULL")
    folded = contexts.groupBy("item_id", *pair).agg(F.count("*").alias("context_copies"))
    first = contexts.groupBy("item_id").agg(F.min(F.struct(*pair)).alias("_first"))
    case_ratios = case_uom_ratios(tables).select(
        F.col("case_uom_id"),
        F.col("account_id").alias("case_account_id"),
        F.col("ratio_to_reference_uom").alias("case_ratio"),
    )
    return (
        folded.join(first, "item_id")
        .withColumn("first_context", F.struct(*pair).eqNullSafe(F.col("_first")))
        .join(_default_ratios(tables), F.col("_default_id") == F.col("uom_ratios_id"), "left")
        .join(case_ratios, F.col("_case_id") == F.col("case_uom_id"), "left")
        .select(
            "item_id",
            "context_copies",
            "first_context",
            "uom_produced",
            "default_ratio",
            F.col("_case_id").alias("case_uom_id"),
            "case_account_id",
            "case_ratio",
        )
    )
