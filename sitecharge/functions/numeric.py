"""Floating-point rules of the report: IEEE division, NULL for NaN, cent rounding, text forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INF = float("inf")


def nan_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(float("nan")))


def float_divide(a: Column, b: Column) -> Column:
    """a / b on doubles as IEEE has it: x/0 is a signed infinity, 0/0 (NaN) is NULL."""
    by_zero = F.when(a > 0, F.lit(_INF)).when(a < 0, F.lit(-_INF))
    return nan_to_null(F.when(b == 0, by_zero).otherwise(F.try_divide(a, b)))


def round_cents(x: Column) -> Column:
    """Two decimals, decided on the exact binary value (as C-style formatting decides).

    ``round`` works on the shortest decimal text instead and differs on values such as 2.675.
    """
    text = F.translate(F.format_number(x, 2), ",", "")
    return F.when(F.abs(x) == _INF, x).otherwise(text.try_cast("double"))


def round_percent(ratio: Column) -> Column:
    """A 0-1 ratio on the 0-100 scale with two decimals."""
    return round_cents(ratio * 100)


def _fixed_text(x: Column) -> Column:
    """Grouped digits with two decimals. From 2**46 on, doubles are coarser than a cent; the cents
    shown are then those of the shortest decimal text of the number."""
    infinite = F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf"))
    return F.when(F.abs(x) == _INF, infinite).otherwise(F.format_number(x, 2))


def money_text(x: Column) -> Column:
    """1234.5 -> $1,234.50; the sign follows the currency mark."""
    return F.concat(F.lit("$"), _fixed_text(x))


def percent_text(ratio: Column) -> Column:
    """0.125 -> 12.50%."""
    return F.concat(_fixed_text(ratio * 100), F.lit("%"))


def parse_number(text: Column) -> Column:
    """Number or NULL. A type suffix such as 1d or 1f is no number here."""
    suffixed = text.rlike(r"[0-9.]\s*[dDfF]\s*$")
    return nan_to_null(F.when(~suffixed, text.try_cast("double")))


def parse_percent(text: Column) -> Column:
    """12.50% -> 12.5; text that is no number once the % is gone (1,234.00%) is NULL."""
    return parse_number(F.regexp_replace(text, "%+$", ""))


def parse_money(text: Column) -> Column:
    """$1,234.50 -> 1234.5."""
    return parse_number(F.translate(text, "$,", ""))


def coerce_numbers(df: DataFrame, columns: list[str] | None = None, spare: tuple = ()) -> DataFrame:
    """Turn text columns into doubles, unparsable text into NULL.

    Without ``columns`` every string column is taken, but for those in ``spare`` (the ids).
    """
    spared = {name.lower() for name in spare}
    if columns is None:
        columns = [n for n, t in df.dtypes if t == "string" and n.lower() not in spared]
    return df.withColumns({n: parse_number(F.col(n).cast("string")) for n in columns})
