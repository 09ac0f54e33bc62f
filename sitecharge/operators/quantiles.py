"""Exact weighted quantiles per group, whatever the size of the group.

Input is a histogram: (keys, value, weight), weight being a positive integer count. Quantiles
interpolate linearly between the two neighbouring order statistics.

Ranks come from prefix sums in three steps, for all probabilities at once. Values are cut into
ranges by their sign, power of two and next 20 binary digits, the same ranges for every group; weights
are summed per group and range on the map side. A running sum over the ranges of a group tells at which
rank each of them starts, and so which few hold a wanted rank. Only the rows of those
ranges are put in order, from the rank at which their range starts. A group's rows are never gathered: what is
sorted of it is its ranges, some million per power of two at most, and the values of the ranges picked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANGE_BITS = 20
#: Bits kept for the digits of a range; more than _RANGE_BITS, as exponents are cut off at 2^1000.
_DIGIT_BITS = 46

# Expressions are SQL texts here: the same plans, made in a few calls instead of hundreds.


def value_range(v: str, bits: int = _RANGE_BITS) -> str:
    """SQL for the number of the range of column ``v``.

    It grows with v, and the values of a range differ by 2^-bits of themselves at most.
    """
    # power of two at or next to |v|; only its being monotone matters
    exponent = f"CAST(floor(log2(greatest(least(abs({v}), pow(2D, 1000D)), pow(2D, -900D)))) AS BIGINT)"
    scale = f"CASE WHEN {v} > 0 THEN {exponent} + 2000 WHEN {v} < 0 THEN -({exponent} + 2000) ELSE 0L END"
    leading = f"{v} * pow(2D, CAST({bits} - {exponent} AS DOUBLE))"
    most = f"pow(2D, {_DIGIT_BITS - 1}D)"
    return f"({scale}) * {1 << _DIGIT_BITS}L + floor(greatest(least({leading}, {most}), -{most}))"


def _position(p: float) -> str:
    return f"((_total - 1) * {float(p)!r}D)"


def _wanted(probs: dict[str, float]) -> list[str]:
    """The ranks below and above the position of each probability."""
    return [f"{side}({_position(p)})" for p in probs.values() for side in ("floor", "ceil")]


def _placed(ranges: DataFrame, keys: list[str], *more: str) -> DataFrame:
    """(keys, _range, _n) with the group's weight, and the rank at which the range starts."""
    group = f"PARTITION BY {', '.join(keys)}"
    before = f"sum(_n) OVER ({group} ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return ranges.selectExpr(
        *keys, "_range", "_n", f"sum(_n) OVER ({group}) AS _total", f"coalesce({before}, 0) AS _start", *more
    )


def _interpolated(
    rows: DataFrame, keys: list[str], probs: dict[str, float], start: str, end: str
) -> DataFrame:
    """Quantiles from rows of (_v, _total) that hold the ranks from ``start`` to below ``end``."""
    slots = [
        F.expr(f"max(CASE WHEN {rank} >= {start} AND {rank} < {end} THEN _v END) AS _o{s}")
        for s, rank in enumerate(_wanted(probs))
    ]
    found = rows.groupBy(*keys).agg(F.max("_total").alias("_total"), *slots)
    out = []
    for i, (name, p) in enumerate(probs.items()):
        low, high, at = f"_o{2 * i}", f"_o{2 * i + 1}", _position(p)
        between = f"(ceil({at}) - {at}) * {low} + ({at} - floor({at})) * {high}"
        out.append(f"CASE WHEN {low} = {high} THEN {low} ELSE {between} END AS {name}")
    return found.selectExpr(*keys, *out)


def value_sketch(
    hist: DataFrame, keys: list[str], value: str, weight: str, bits: int
) -> DataFrame:
    """(keys, _range, _n, _sum): weights and weighted sums per group and range of ``bits`` binary digits.

    Sketches of parts of the rows are merged by adding up equal ranges.
    """
    rows = hist.selectExpr(*keys, f"{value_range(value, bits)} AS _range", f"{value} AS _v", f"{weight} AS _n")
    return rows.groupBy(*keys, "_range").agg(F.sum("_n").alias("_n"), F.expr("sum(_v * _n) AS _sum"))


def sketched_quantiles(sketch: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """Quantiles of a ``value_sketch``, in one exchange: order statistics are the means of their ranges.

    The rank is right, the value is not: each order statistic is off by 2^-bits of itself at most.
    """
    placed = _placed(sketch, keys, "_sum / _n AS _v")
    return _interpolated(placed, keys, probs, "_start", "_start + _n")


def exact_quantiles(
    hist: DataFrame, keys: list[str], value: str, weight: str, probs: dict[str, float]
) -> DataFrame:
    """One row per group with one column per entry of ``probs`` (name -> probability).

    ``hist`` is read twice: pass a stored table or a cheap plan.
    """
    rows = hist.selectExpr(*keys, f"{value} AS _v", f"{weight} AS _n", f"{value_range(value)} AS _range")
    ranges = rows.groupBy(*keys, "_range").agg(F.sum("_n").alias("_n"))
    inside = " OR ".join(f"{rank} >= _start AND {rank} < _start + _n" for rank in _wanted(probs))
    picked = _placed(ranges, keys).where(inside).drop("_n")

    # the explicit exchange serves both the order within a range and the last grouping
    held = rows.join(picked, [*keys, "_range"]).repartition(*keys)
    running = (
        f"sum(_n) OVER (PARTITION BY {', '.join(keys)}, _range ORDER BY _v"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    ordered = held.selectExpr("*", f"_start + {running} AS _end")
    return _interpolated(ordered, keys, probs, "_end - _n", "_end")
