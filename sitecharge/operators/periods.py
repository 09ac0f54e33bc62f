"""Reporting periods as a group key, so that all months are computed in one pass."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How the last day of a period counts: up to its first instant only, or in full.
MIDNIGHT = "midnight_of_last_day"
FULL_DAY = "exclusive_next_day"

PERIOD = ["start_date", "end_date"]
#: Column of jobs that are laid out by month: the first day of the month of their start.
START_MONTH = "start_month"


@dataclass(frozen=True, order=True)
class Period:
    start: date
    end: date


def year_to_date(as_of: date) -> list[Period]:
    """Closed months of the year of ``as_of``: January up to the month before; none in January."""
    starts = [date(as_of.year, month, 1) for month in range(1, as_of.month + 1)]
    return [Period(a, b - timedelta(days=1)) for a, b in zip(starts, starts[1:])]


def months_of(periods: list[Period]) -> list[date]:
    """First days of all months that a period touches."""
    numbers = {
        n
        for p in periods
        for n in range(p.start.year * 12 + p.start.month - 1, p.end.year * 12 + p.end.month)
    }
    return [date(n // 12, n % 12 + 1, 1) for n in sorted(numbers)]


def in_months(df: DataFrame, periods: list[Period]) -> DataFrame:
    """Of rows laid out by month, those of the months of ``periods``: literals, which leave the other folders unread."""
    if START_MONTH not in df.columns:
        return df
    return df.where(F.col(START_MONTH).isin(months_of(periods))).drop(START_MONTH)


def _inside(moment: str, first: date, last: date, end: str) -> str:
    if end == FULL_DAY:
        return f"({moment} >= DATE'{first}' AND {moment} < DATE'{last + timedelta(days=1)}')"
    if end == MIDNIGHT:
        return f"({moment} >= DATE'{first}' AND {moment} <= DATE'{last}')"
    raise ValueError(f"unknown end rule {end!r}")


def in_month(moment: Column, month: Column, end: str) -> Column:
    """Whether a ``moment`` of the month that starts at ``month`` counts in it: by the rule for its last day."""
    if end == FULL_DAY:
        return moment.isNotNull()
    if end == MIDNIGHT:
        return moment <= F.last_day(month)
    raise ValueError(f"unknown end rule {end!r}")


def tag_periods(df: DataFrame, moment: str, periods: list[Period], end: str = MIDNIGHT) -> DataFrame:
    """Keep the rows whose ``moment`` lies in a period; add its start_date and end_date.

    The periods are literals: the hull of them is a plain range predicate that reaches the scan,
    and no join is needed. Overlapping periods give a row per period.
    """
    if not periods:
        none = F.lit(None).cast("date")
        return df.where(F.lit(False)).withColumns({name: none for name in PERIOD})
    ordered = sorted(set(periods))
    hull = _inside(moment, ordered[0].start, max(p.end for p in ordered), end)
    inside = [_inside(moment, p.start, p.end, end) for p in ordered]
    if all(a.end < b.start for a, b in zip(ordered, ordered[1:])):
        # A start date names its period; plain dates keep the per-row work on the fact small.
        starts = [f"WHEN {i} THEN DATE'{p.start}'" for i, p in zip(inside, ordered)]
        ends = [f"WHEN DATE'{p.start}' THEN DATE'{p.end}'" for p in ordered]
        return (
            df.where(hull)
            .withColumn("start_date", F.expr(f"CASE {' '.join(starts)} END"))
            .where("start_date IS NOT NULL")
            .withColumn("end_date", F.expr(f"CASE start_date {' '.join(ends)} END"))
        )
    spans = [
        f"IF({i}, named_struct('start_date', DATE'{p.start}', 'end_date', DATE'{p.end}'), NULL)"
        for i, p in zip(inside, ordered)
    ]
    return (
        df.where(hull)
        .withColumn("_period", F.expr(f"explode(array({', '.join(spans)}))"))
        .where("_period IS NOT NULL")
        .withColumns({name: F.col(f"_period.{name}") for name in PERIOD})
        .drop("_period")
    )
