"""The monthly report: all periods in one run."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecharge.functions.names import upper_names
from sitecharge.functions.numeric import round_cents, round_percent
from sitecharge.operators.dimensions import owned_sites, reportable_sites
from sitecharge.operators.impute import impute
from sitecharge.operators.jobs import turned_on_dates
from sitecharge.operators.metrics import MaterialsRule, adjusted_values, site_ratios
from sitecharge.operators.outliers import (
    SITE_PERIOD,
    OutlierRule,
    charge_bounds,
    flag_outliers,
)
from sitecharge.operators.periods import MIDNIGHT, Period, year_to_date
from sitecharge.operators.pricing import (
    merged_jobs,
    order_prices,
    order_totals,
    priced_totals,
    pricing_totals,
)
from sitecharge.operators.rollup import (
    REPORT_MEASURES,
    SITE_KEYS,
    SKETCH,
    charge_groups,
    project_groups,
    site_rollup,
)
from sitecharge.operators.scenario import KEEP, folded_scenarios
from sitecharge.plans.frames import Frames, merge_frames
from sitecharge.plans.staging import Staging
from sitecharge.sources.schemas import (
    LOAD_STAMP,
    MONEY_COLUMNS,
    PERCENT_COLUMNS,
    REPORT_COLUMNS,
)
from sitecharge.sources.sinks import render_dates, write_report
from sitecharge.sources.tables import Tables


#: How projects of job rows are counted: exactly, or by HyperLogLog sketches.
EXACT, SKETCHED = "exact", "sketched"


@dataclass(frozen=True)
class ReportOptions:
    """``projects`` is for reports of frames, whose job rows may share projects over many charges; SKETCHED has a
    relative standard error of 1.04 / 2^(project_bits / 2), that is 1.6% with 12 bits."""

    end: str = MIDNIGHT
    ties: str = KEEP
    outliers: OutlierRule = field(default_factory=OutlierRule)
    materials: MaterialsRule = field(default_factory=MaterialsRule)
    projects: str = EXACT
    project_bits: int = 12


def needed_totals(
    tables: Tables,
    periods: list[Period],
    options: ReportOptions = ReportOptions(),
    measures: list[str] | None = None,
    sites: DataFrame | None = None,
    job_sums: DataFrame | None = None,
) -> DataFrame:
    """Pricing totals, without the creation dates where no measure reads them."""
    chosen = reportable_sites(tables) if sites is None else sites
    dates = measures is None or "first_job_created_date" in measures
    return pricing_totals(tables, chosen, periods, options.end, dates, job_sums)


def stored_groups(
    tables: Tables,
    periods: list[Period],
    staging: Staging,
    options: ReportOptions = ReportOptions(),
    measures: list[str] | None = None,
    sites: DataFrame | None = None,
    job_sums: DataFrame | None = None,
) -> DataFrame:
    """Charge groups of the periods, from one scan of the jobs (of ``job_sums``, if there are such).

    Stored on the way: the totals, behind which the jobs are not needed any more, the folded charges of the
    scenarios, whose size is known then, and the groups, which bounds and rollup both read.
    """
    totals = needed_totals(tables, periods, options, measures, sites, job_sums)
    totals = staging.store(totals, "totals")
    folded = staging.store(folded_scenarios(tables, options.ties), "scenarios")
    priced = priced_totals(tables, totals, options.ties, folded)
    return staging.store(charge_groups(priced, measures), "charge_groups")


def bounds_of(
    groups: DataFrame, staging: Staging, options: ReportOptions = ReportOptions()
) -> DataFrame:
    hist = groups.select(*SITE_PERIOD, "imputed_charge_per_unit", "n")
    return charge_bounds(hist, lambda df: staging.store(df, "centre"), options.outliers)


def site_bounds(
    tables: Tables,
    periods: list[Period],
    staging: Staging,
    options: ReportOptions = ReportOptions(),
) -> DataFrame:
    """Bounds of all active sites, those without known owner included; a stored table."""
    sites = owned_sites(tables).select("company_id", "account_id", "site_id")
    groups = stored_groups(tables, periods, staging, options, ["n"], sites)
    return staging.store(bounds_of(groups, staging, options), "bounds")


def flagged_jobs(
    tables: Tables,
    periods: list[Period],
    staging: Staging,
    options: ReportOptions = ReportOptions(),
) -> DataFrame:
    """Imputed job rows with the outlier flag.

    The bounds come from totals per work order, so the job rows themselves are neither stored nor
    gathered per site: they pass through once. Work orders are priced once, for both.
    """
    prices = staging.store(order_prices(tables, options.ties), "prices")
    sites = owned_sites(tables).select("company_id", "account_id", "site_id")
    totals = order_totals(tables, sites, periods, prices, options.end)
    groups = staging.store(charge_groups(totals, ["n"]), "charge_groups")
    bounds = staging.store(bounds_of(groups, staging, options), "bounds")
    rows = impute(merged_jobs(tables, periods, options.end, options.ties, prices))
    return flag_outliers(rows, bounds, "job_id", options.outliers)


def build_rollup(
    tables: Tables,
    periods: list[Period],
    staging: Staging,
    options: ReportOptions = ReportOptions(),
    measures: list[str] | None = None,
    job_sums: DataFrame | None = None,
) -> DataFrame:
    groups = stored_groups(tables, periods, staging, options, measures, job_sums=job_sums)
    return site_rollup(groups, bounds_of(groups, staging, options), options.outliers)


def build_values(
    tables: Tables,
    periods: list[Period],
    staging: Staging,
    options: ReportOptions = ReportOptions(),
    job_sums: DataFrame | None = None,
) -> DataFrame:
    """Unrounded ratios and values per site and period, with what the report needs only."""
    rollup = build_rollup(tables, periods, staging, options, REPORT_MEASURES, job_sums)
    return adjusted_values(site_ratios(rollup), options.materials)


def shape_report(values: DataFrame, turned_on: DataFrame) -> DataFrame:
    """Add the turned-on date, round, and select the report columns."""
    named = upper_names(
        values.join(turned_on, ["company_id", "account_id"], "left").withColumnsRenamed(
            {
                "ov_extrapolated": "ov_w_outliers",
                "ov_impute_extrapolated": "ov_wo_outliers",
                "adjusted_ov_impute_extrapolated": "adjusted_ov_wo_outliers",
                "percent_ov_impute_materials": "percent_ov_materials",
            }
        )
    )
    rounded = {name: round_percent(F.col(name)) for name in PERCENT_COLUMNS}
    rounded.update({name: round_cents(F.col(name)) for name in MONEY_COLUMNS})
    rounded["DATE_OV_TURNED_ON"] = F.col("DATE_OV_TURNED_ON").cast("timestamp_ntz")
    return named.withColumns(rounded).select(*REPORT_COLUMNS)


def build_report(
    tables: Tables,
    periods: list[Period],
    staging: Staging,
    options: ReportOptions = ReportOptions(),
    job_sums: DataFrame | None = None,
    starts: DataFrame | None = None,
) -> DataFrame:
    """Report rows of all periods, without load stamp.

    ``job_sums`` and ``starts`` are stored ``job_totals`` of the periods and ``first_starts`` of all
    time (``plans.incremental``); with both, the jobs are not read.
    """
    values = build_values(tables, periods, staging, options, job_sums)
    return shape_report(values, turned_on_dates(tables, starts))


def rows_rollup(
    rows: DataFrame,
    staging: Staging,
    options: ReportOptions = ReportOptions(),
    measures: list[str] | None = None,
) -> DataFrame:
    """The rollup of merged job rows (``copies`` being their multiplicity), whoever made them.

    Rows are folded per unit charge like totals are, from one reading. Projects are counted in the same fold: exactly, by
    a mark on one charge of each project, or by sketches (``ReportOptions.projects``).
    """
    owned = rows.where("company_id IS NOT NULL AND account_id IS NOT NULL AND site_id IS NOT NULL")
    single = owned.withColumns(
        {
            "job_rows": F.lit(1).cast("bigint"),
            "job_count": F.when(F.col("job_id").isNotNull(), 1).otherwise(0).cast("bigint"),
            "project_rows": F.lit(0).cast("bigint"),
            "first_created_at": F.col("created_at"),
            "last_created_at": F.col("created_at"),
        }
    )
    if options.projects == SKETCHED:
        groups = staging.store(charge_groups(single, measures, options.project_bits), "row_groups")
        rollup = site_rollup(groups.drop(SKETCH), bounds_of(groups, staging, options), options.outliers)
        counted = groups.groupBy(*SITE_KEYS).agg(
            F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias("_projects")
        )
        joined = rollup.join(counted, SITE_KEYS)
        return joined.withColumn("total_number_of_projects", F.col("_projects")).drop("_projects")
    groups = staging.store(project_groups(single, measures), "row_groups")
    return site_rollup(groups, bounds_of(groups, staging, options), options.outliers)


def report_of_frames(
    frames: Frames, staging: Staging, options: ReportOptions = ReportOptions()
) -> DataFrame:
    """Report rows from a bundle of frames, of which the user may have made or changed any."""
    rows = staging.store(merge_frames(frames), "merged_frames")
    rollup = rows_rollup(rows, staging, options, REPORT_MEASURES)
    values = adjusted_values(site_ratios(rollup), options.materials)
    return shape_report(values, frames.turned_on)


def stamp(report: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Add the load time (UTC, no zone)."""
    moment = loaded_at or datetime.now(timezone.utc).replace(tzinfo=None)
    return report.withColumn(LOAD_STAMP, F.lit(moment.isoformat(" ")).cast("timestamp_ntz"))


def run_report(
    tables: Tables,
    as_of: date,
    target: str,
    mode: str = "append",
    options: ReportOptions = ReportOptions(),
    loaded_at: datetime | None = None,
    text_dates: bool = False,
) -> None:
    """Compute the closed months of the year of ``as_of`` and write them to ``target``.

    ``text_dates`` writes dates and times as text, for a target made with the same option.
    """
    staging = Staging(tables.jobs.sparkSession)
    try:
        periods = year_to_date(as_of)
        report = staging.store(build_report(tables, periods, staging, options), "report")
        report = stamp(report, loaded_at)
        write_report(render_dates(report) if text_dates else report, target, mode, periods)
    finally:
        staging.clear()
