"""The registered queries: every stage of the report on the sample tables, whole and unsampled."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecharge.functions.dates import closed_months, coerce_datetimes, date_text, datetime_text
from sitecharge.functions.numeric import money_text, parse_money, parse_percent, percent_text
from sitecharge.operators import dimensions, impute, jobs, metrics, pricing, scenario
from sitecharge.operators.outliers import OutlierRule
from sitecharge.operators.periods import FULL_DAY, START_MONTH, Period, year_to_date
from sitecharge.operators.skew import heavy_keys
from sitecharge.plans import incremental, report
from sitecharge.plans.frames import pull_frames
from sitecharge.plans.session import configure
from sitecharge.plans.staging import Staging
from sitecharge.sources.fixtures import sample_tables
from sitecharge.sources.layout import read_jobs_by_month, write_in_buckets, write_jobs_by_month
from sitecharge.sources.sinks import create_report, read_report, render_dates, write_report
from sitecharge.sources.tables import Tables, typed

AS_OF = date(2000, 7, 15)

_ROW = ["start_date", "end_date", "site_id", "job_id", "scenario_charge_id"]
_SITE = ["start_date", "end_date", "company_id", "account_id", "site_id"]
_MONEY_TEXT = [
    "ov_extrapolated",
    "ov_impute_extrapolated",
    "adjusted_ov_impute_extrapolated",
    "total_fcpu",
    "total_material_charge",
]
_PERCENT_TEXT = [
    "percent_fcpu",
    "percent_overridden",
    "percent_sum_scenario",
    "percent_sum_scenario_wo_custom",
    "percent_no_charges",
    "percent_fill_rate",
    "percent_ov_impute_materials",
    "percent_outliers",
]


class Run:
    """Tables and periods of one query run."""

    def __init__(self, spark: SparkSession, tables: Tables):
        self.spark = spark
        self.tables = tables
        self.periods: list[Period] = year_to_date(AS_OF)
        self.staging = Staging(spark)

    def merged(self) -> DataFrame:
        return pricing.merged_jobs(self.tables, self.periods)

    def flagged(self) -> DataFrame:
        return report.flagged_jobs(self.tables, self.periods, self.staging)

    def bounds(self) -> DataFrame:
        return report.site_bounds(self.tables, self.periods, self.staging)

    def rollup(self) -> DataFrame:
        return report.build_rollup(self.tables, self.periods, self.staging)

    def ratios(self) -> DataFrame:
        return metrics.site_ratios(self.rollup())

    def values(self) -> DataFrame:
        return report.build_values(self.tables, self.periods, self.staging)

    def texts(self) -> DataFrame:
        values = self.values()
        shown = [money_text(F.col(c)).alias(c) for c in _MONEY_TEXT]
        shown += [percent_text(F.col(c)).alias(c) for c in _PERCENT_TEXT]
        return values.select(*_SITE, *shown)

    def moments(self) -> DataFrame:
        """Charge dates as text of several kinds and as integer nanoseconds."""
        at, number = F.col("effective_date_at"), F.col("scenario_charge_id")
        kind = F.pmod(number, F.lit(5))
        text = (
            F.when(kind == 0, datetime_text(at))
            .when(kind == 1, date_text(at))
            .when(kind == 2, "not a date")
            .when(kind == 3, "2000-02-30")
        )
        nanos = F.unix_micros(at.cast("timestamp_ltz")) * 1000 + number * 1000
        raw = self.tables.scenario_charges.select(
            number, text.alias("from_text"), nanos.alias("from_nanos")
        )
        return coerce_datetimes(raw, ["from_text", "from_nanos"])

    def site_report(self) -> DataFrame:
        return report.build_report(self.tables, self.periods, self.staging)


def _reporting_periods(run: Run) -> DataFrame:
    days = run.tables.jobs.select(F.to_date("actual_start_at").alias("as_of")).distinct()
    months = days.select("as_of", F.explode(closed_months(F.col("as_of"))).alias("m"))
    return months.select(
        "as_of",
        date_text(F.col("m.start_date")).alias("start_date"),
        date_text(F.col("m.end_date")).alias("end_date"),
    )


def _last_day_cutoff(run: Run) -> DataFrame:
    whole_days = jobs.period_jobs(run.tables, run.periods, end=FULL_DAY)
    in_time = F.col("actual_start_at") <= F.col("end_date")
    return whole_days.groupBy("start_date", "end_date").agg(
        F.count_if(in_time).alias("kept"), F.count_if(~in_time).alias("dropped")
    )


def _custom_charges(run: Run) -> DataFrame:
    averages = ["custom_avg_markup_percentage", "custom_avg_percentage"]
    charges = scenario.custom_charges(run.tables)
    return charges.withColumns({c: F.round(c, 6) for c in averages})


def _weighted(rows: DataFrame) -> DataFrame:
    """Equal rows as one, with the sum of their ``copies``: jobs without id are not told apart."""
    return rows.groupBy(*[c for c in rows.columns if c != "copies"]).agg(F.sum("copies").alias("copies"))


def _modified_quantity(run: Run) -> DataFrame:
    rows = impute.add_modified_quantity(run.merged())
    return _weighted(rows.select(*_ROW, "produced_quantity", "modified_quantity", "copies"))


def _imputed_charge(run: Run) -> DataFrame:
    return _weighted(impute.impute(run.merged()).select(*_ROW, "imputed_charge_per_unit", "copies"))


def _fill_flags(run: Run) -> DataFrame:
    rows = impute.add_fill_flags(impute.impute(run.merged()))
    flags = [c for c in rows.columns if c.endswith("_fill")]
    return _weighted(rows.select(*_ROW, "fill_type", *flags, "copies"))


def _outlier_flags(run: Run) -> DataFrame:
    charge = "imputed_charge_per_unit"
    return _weighted(run.flagged().select(*_ROW, charge, f"{charge}_wo_outliers", "outlier_charge", "copies"))


def _job_charges(run: Run) -> DataFrame:
    rows = impute.add_job_charges(run.flagged())
    return _weighted(rows.select(*_ROW, *impute.CHARGE_PARTS, "copies"))


def _site_upper_bound(run: Run) -> DataFrame:
    rounded = [F.round(c, 6).alias(c) for c in ("high", "upper_bound")]
    return run.bounds().select("start_date", "end_date", "site_id", *rounded)


def _site_sketched_bound(run: Run) -> DataFrame:
    """Whether median and quantile from sketches of 10 bits lie within 2^-10 of the exact ones, which bound the interpolated too."""
    rule = OutlierRule(sketch_bits=10)
    sites = dimensions.owned_sites(run.tables).select("company_id", "account_id", "site_id")
    groups = report.stored_groups(run.tables, run.periods, run.staging, measures=["n"], sites=sites)
    keys, names = ["start_date", "end_date", "site_id"], ["median", "high"]
    sketched = report.bounds_of(groups, run.staging, report.ReportOptions(outliers=rule))
    exact = report.bounds_of(groups, run.staging)
    both = exact.join(sketched.select(*keys, *(F.col(c).alias(f"{c}_sketch") for c in names)), keys)
    near = {
        f"{c}_near": (F.col(f"{c}_sketch") == F.col(c))
        | (F.abs(F.col(f"{c}_sketch") - F.col(c)) <= F.abs(F.col(c)) / 2**10 + 1e-12)
        for c in names
    }
    return both.select(*keys, *(test.alias(name) for name, test in near.items()))


def _materials_share(run: Run) -> DataFrame:
    shares = metrics.add_materials_share(run.ratios())
    return shares.select(*_SITE, "percent_ov_impute_materials")


def _adjusted_value(run: Run) -> DataFrame:
    return run.values().select(
        *_SITE,
        "percent_ov_impute_materials",
        "ov_extrapolated",
        "ov_impute_extrapolated",
        "adjusted_ov_impute_extrapolated",
    )


def _money_percent_parse(run: Run) -> DataFrame:
    numbers = {c: parse_money(F.col(c)) for c in _MONEY_TEXT}
    numbers.update({c: parse_percent(F.col(c)) for c in _PERCENT_TEXT})
    return run.texts().withColumns(numbers)


def _datetime_text(run: Run) -> DataFrame:
    return run.moments().withColumns(
        {c: datetime_text(F.col(c)) for c in ("from_text", "from_nanos")}
    )


def _report_keys(run: Run) -> DataFrame:
    """Keys of all sites with jobs, active or not; the filter keeps those of active sites."""
    totals = jobs.job_totals(run.tables, run.periods, dates=False)
    accounts = run.tables.accounts.select("account_id", "company_id")
    owners = run.tables.sites.select("site_id", "account_id").join(accounts, "account_id", "left")
    keys = totals.join(owners, "site_id").select(*_SITE).distinct()
    return dimensions.report_keys(run.tables, keys)


def _report_append(run: Run) -> DataFrame:
    """Three loads into one target: all months, two months again, the first two replaced."""
    rows = run.staging.store(run.site_report(), "report")
    target = f"{run.staging.folder}/target"
    create_report(run.spark, target)
    start = F.col("START_DATE")
    march, april = date(2000, 3, 1), date(2000, 4, 1)
    loads = [
        (rows, datetime(2000, 7, 15, 6), "append"),
        (rows.where(start.between(march, april)), datetime(2000, 7, 16, 6), "append"),
        (rows.where(start < march), datetime(2000, 7, 17, 6), "replace_period"),
    ]
    for part, loaded_at, mode in loads:
        write_report(report.stamp(part, loaded_at), target, mode)
    return read_report(run.spark, target)


def _report_replace(run: Run) -> DataFrame:
    """All months; then a run without jobs in February; then one over a quarter that overlaps them."""
    rows = run.staging.store(run.site_report(), "report")
    target = f"{run.staging.folder}/replaced"
    create_report(run.spark, target)
    start = F.col("START_DATE")
    january, end = date(2000, 1, 1), date(2000, 3, 31)
    quarter = rows.where(start == january).withColumn("END_DATE", F.lit(end))
    loads = [
        (rows, datetime(2000, 7, 15, 6), "append", []),
        (rows.where(start != date(2000, 2, 1)), datetime(2000, 7, 16, 6), "replace_period", run.periods),
        (quarter, datetime(2000, 7, 17, 6), "replace_period", [Period(january, end)]),
        (quarter, datetime(2000, 7, 18, 6), "replace_period", [Period(january, end)]),
    ]
    for part, loaded_at, mode, periods in loads:
        write_report(report.stamp(part, loaded_at), target, mode, periods)
    return read_report(run.spark, target)


def _report_text_dates(run: Run) -> DataFrame:
    """Two loads with dates as text, the second one of two months."""
    rows = run.staging.store(run.site_report(), "report")
    target = f"{run.staging.folder}/texts"
    create_report(run.spark, target, id_type="string", text_dates=True)
    late = rows.where(F.col("START_DATE") >= date(2000, 5, 1))
    for part, day in ((rows, 15), (late, 16)):
        stamped = report.stamp(part, datetime(2000, 7, day, 6))
        write_report(render_dates(stamped), target)
    return read_report(run.spark, target)


def _jobs_by_month(run: Run) -> DataFrame:
    """Job facts from jobs in folders by month, one of which has been written again."""
    folder = f"{run.staging.folder}/jobs_by_month"
    write_jobs_by_month(run.tables.jobs, folder)
    write_jobs_by_month(run.tables.jobs, folder, months=[date(2000, 2, 1)])
    laid_out = replace(run.tables, jobs=typed(read_jobs_by_month(run.spark, folder), "jobs"))
    return jobs.job_facts(laid_out, run.periods)


def _two_loads(run: Run) -> tuple[str, str]:
    """Jobs by month in two loads, and a store refreshed after each: the second brings March to May and changes February.

    A third load brings what the first left out. All three take the jobs from one layout by month, which is made once.
    """
    folder, store, whole = (f"{run.staging.folder}/{name}" for name in ("jobs", "store", "whole"))
    write_jobs_by_month(run.tables.jobs, whole)
    every = typed(read_jobs_by_month(run.spark, whole), "jobs")
    start = F.col("actual_start_at")
    early = every.where((start < date(2000, 3, 1)) | (start >= date(2000, 6, 1)))
    february, late = date(2000, 2, 1), [date(2000, m, 1) for m in (3, 4, 5)]
    write_jobs_by_month(early.where(F.dayofmonth(start) != 20), folder, laid_out=True)
    incremental.refresh(run.tables, folder, store)
    write_jobs_by_month(every, folder, months=[february, *late], laid_out=True)
    incremental.refresh(run.tables, folder, store)
    others = every.where((F.dayofmonth(start) == 20) & (start < date(2000, 2, 1)) | (start >= date(2000, 6, 1)))
    months = others.select(START_MONTH).distinct().collect()
    write_jobs_by_month(every, folder, months=sorted(row[0] for row in months), laid_out=True)
    return folder, store


def _turned_on_incremental(run: Run) -> DataFrame:
    folder, store = _two_loads(run)
    incremental.refresh(run.tables, folder, store)
    return jobs.turned_on_dates(run.tables, incremental.stored_starts(run.spark, store))


def _report_incremental(run: Run) -> DataFrame:
    return incremental.incremental_report(run.tables, *_two_loads(run), run.periods, run.staging)


def _merged_in_buckets(run: Run) -> DataFrame:
    """Merged jobs from jobs and prices in equal buckets."""
    name, folder = f"b{uuid.uuid4().hex}", run.staging.folder
    made = {"jobs": run.tables.jobs, "prices": pricing.order_prices(run.tables)}
    for table, df in made.items():
        write_in_buckets(df, f"{table}_{name}", "work_order_id", 8, f"{folder}/{table}")
    nameless = run.staging.store(run.tables.jobs.where("work_order_id IS NULL"), "nameless")
    laid_out = replace(run.tables, jobs=run.spark.table(f"jobs_{name}"))
    prices = run.spark.table(f"prices_{name}")
    return _weighted(pricing.merged_in_buckets(laid_out, nameless, prices, run.periods))


def _merged_heavy(run: Run) -> DataFrame:
    """Merged jobs with the jobs of frequent work orders dealt over many tasks."""
    counted = jobs.period_jobs(run.tables, run.periods)
    heavy = heavy_keys(counted, "work_order_id", share=1 / 256)
    return _weighted(pricing.merged_jobs(run.tables, run.periods, heavy=heavy))


def _empty_months(run: Run) -> DataFrame:
    """A month with jobs between two that have none."""
    far = [Period(date(y, 1, 1), date(y, 1, 31)) for y in (1901, 2000, 2099)]
    return report.build_report(run.tables, far, run.staging)


def _report_from_frames(run: Run) -> DataFrame:
    frames = pull_frames(run.tables, run.periods)
    return report.report_of_frames(frames, run.staging)


_QUERIES: dict[str, Callable[[Run], DataFrame]] = {
    "active_sites": lambda run: dimensions.site_projection(run.tables),
    "reporting_periods": _reporting_periods,
    "job_facts": lambda run: jobs.job_facts(run.tables, run.periods),
    "last_day_cutoff": _last_day_cutoff,
    "turned_on_dates": lambda run: jobs.turned_on_dates(run.tables),
    "case_uom_ratios": lambda run: dimensions.case_uom_ratios(run.tables),
    "scenario_bounds": lambda run: scenario.scenario_bounds(run.tables),
    "scenario_latest": lambda run: jobs.job_picks(run.tables, run.periods, "latest"),
    "scenario_earliest": lambda run: jobs.job_picks(run.tables, run.periods, "earliest"),
    "scenario_resolved": lambda run: _weighted(jobs.resolved_charges(run.tables, run.periods)),
    "custom_charges": _custom_charges,
    "scenario_charges": lambda run: jobs.scenario_charges(run.tables, run.periods),
    "merged_jobs": lambda run: _weighted(run.merged()),
    "modified_quantity": _modified_quantity,
    "imputed_charge": _imputed_charge,
    "fill_flags": _fill_flags,
    "site_mad": lambda run: run.bounds().drop("high", "upper_bound"),
    "site_upper_bound": _site_upper_bound,
    "site_sketched_bound": _site_sketched_bound,
    "outlier_flags": _outlier_flags,
    "job_charges": _job_charges,
    "site_rollup": Run.rollup,
    "site_ratios": Run.ratios,
    "materials_share": _materials_share,
    "adjusted_value": _adjusted_value,
    "money_percent_text": Run.texts,
    "money_percent_parse": _money_percent_parse,
    "datetime_parse": Run.moments,
    "datetime_text": _datetime_text,
    "report_keys": _report_keys,
    "site_report": Run.site_report,
    "report_append": _report_append,
    "report_replace": _report_replace,
    "report_text_dates": _report_text_dates,
    "report_empty_months": _empty_months,
    "report_from_frames": _report_from_frames,
    "jobs_by_month": _jobs_by_month,
    "turned_on_incremental": _turned_on_incremental,
    "report_incremental": _report_incremental,
    "merged_in_buckets": _merged_in_buckets,
    "merged_heavy": _merged_heavy,
}


def on_tables(name: str, spark: SparkSession, tables: Tables) -> DataFrame:
    """Query ``name`` on any tables of the input schema."""
    return _QUERIES[name](Run(spark, tables))


def _registered(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return on_tables(name, spark, sample_tables(spark, sf_dir))

    query.__name__ = name
    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _registered(name) for name in _QUERIES}
