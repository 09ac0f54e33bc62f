"""Month arithmetic and tolerant datetime conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def closed_months(as_of: Column) -> Column:
    """Array of (start_date, end_date) for the months of the year that ended before ``as_of``'s.

    Empty for a date in January.
    """
    first = F.trunc(as_of, "YEAR")
    last = F.add_months(F.trunc(as_of, "MM"), -1)
    months = F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))
    spans = F.transform(
        months, lambda m: F.struct(m.alias("start_date"), F.last_day(m).alias("end_date"))
    )
    none = F.expr("CAST(array() AS array<struct<start_date:date,end_date:date>>)")
    return F.when(F.month(as_of) > 1, spans).otherwise(none)


def date_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def datetime_text(moment: Column) -> Column:
    """Seconds-resolution text; NULL stays NULL."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def parse_datetime(text: Column) -> Column:
    """Datetime without zone; unparsable text is NULL."""
    return text.try_cast("timestamp_ntz")


def epoch_nanos(value: Column) -> Column:
    """Integer nanoseconds since 1970 as a datetime without zone, to the microsecond below."""
    whole_micros = (value - F.pmod(value, F.lit(1000))).cast("decimal(20,0)")
    seconds = (whole_micros / F.lit(10**9).cast("decimal(10,0)")).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        zero, zero, zero, seconds
    )


def coerce_datetimes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text is parsed, integers are read as epoch nanoseconds, dates and timestamps pass."""
    kinds = dict(df.dtypes)
    new = {}
    for name in columns:
        kind = kinds[name]
        if kind == "string":
            new[name] = parse_datetime(F.col(name))
        elif kind in ("bigint", "int"):
            new[name] = epoch_nanos(F.col(name).cast("bigint"))
        else:
            new[name] = F.col(name).cast("timestamp_ntz")
    return df.withColumns(new)
