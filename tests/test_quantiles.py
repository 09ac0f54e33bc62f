"""Exact quantiles against sorting, over awkward values."""

import random

from pyspark.sql import functions as F
from world import _quantile

from sitecharge.operators.quantiles import exact_quantiles, sketched_quantiles, value_range, value_sketch

PROBS = {"median": 0.5, "high": 0.95, "low": 0.0, "top": 1.0}


def groups():
    r = random.Random(5)
    smooth = [r.expovariate(1) * 10 ** r.randrange(-6, 7) for _ in range(500)]
    close = [1 + i * 2.0**-52 for i in range(300)]
    mixed = [r.uniform(-50, 50) for _ in range(301)] + [0.0] * 40
    grid = [r.randrange(2000) * 0.25 for _ in range(700)]
    extreme = [0.0, 5e-324, 1e-290, 1e300, -1e300, 1.7e308, 2.0**-900, 2.0**1000]
    powers = [2.0**e for e in range(-60, 60)]
    return {
        "smooth": [(v, 1) for v in smooth],
        "close": [(v, 1 + i % 3) for i, v in enumerate(close)],
        "mixed": [(v, 1) for v in mixed],
        "grid": [(v, r.randrange(1, 6)) for v in grid],
        "extreme": [(v, 1) for v in extreme],
        "powers": [(v, 1) for v in powers],
        "single": [(3.5, 1)],
        "same": [(2.25, 1000)],
        "hot": [(0.0, 10_000_000), (7.0, 1)],
    }


def test_equals_sorting(spark):
    rows = [(name, v, n) for name, pairs in groups().items() for v, n in pairs]
    hist = spark.createDataFrame(rows, "g string, v double, n bigint").repartition(5)
    found = {r.g: r for r in exact_quantiles(hist, ["g"], "v", "n", PROBS).collect()}
    assert set(found) == set(groups())
    for name, pairs in groups().items():
        if name == "hot":
            values = {p: 0.0 if p != "top" else 7.0 for p in PROBS}
        else:
            spread = [v for v, n in pairs for _ in range(n)]
            values = {p: _quantile(spread, q) for p, q in PROBS.items()}
        assert {p: found[name][p] for p in PROBS} == values, name


def test_three_exchanges_for_all_probabilities(spark, tmp_path):
    rows = [(name, v, n) for name, pairs in groups().items() for v, n in pairs]
    spark.createDataFrame(rows, "g string, v double, n bigint").write.parquet(f"{tmp_path}/hist")
    hist = spark.read.parquet(f"{tmp_path}/hist")
    plan = exact_quantiles(hist, ["g"], "v", "n", PROBS)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]
    assert len(moved) == 3 and "SortMergeJoin" not in plan


def test_ranges_are_monotone(spark):
    values = sorted({v for pairs in groups().values() for v, _ in pairs} | {float("-inf"), float("inf"), -5e-324, -1.5, -1e308})
    frame = spark.createDataFrame([(v,) for v in values], "v double").select("v", F.expr(value_range("v")).alias("r"))
    found = [r.r for r in frame.orderBy("v").collect()]
    assert found == sorted(found)


def test_sketches_are_merged_and_near(spark):
    import math

    rows = [(name, v, n) for name, pairs in groups().items() for v, n in pairs if name != "extreme"]
    hist = spark.createDataFrame(rows, "g string, v double, n bigint").repartition(5)
    bits = 8
    half = [hist.where(F.xxhash64("v") % 2 == i) for i in (0, 1, -1)]
    parts = [value_sketch(h, ["g"], "v", "n", bits) for h in half]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("g", "_range").agg(F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"))
    found = {r.g: r for r in sketched_quantiles(merged, ["g"], PROBS).collect()}
    assert set(found) == {name for name, *_ in rows}
    for name, pairs in groups().items():
        if name in found and name != "hot":
            values = sorted(v for v, n in pairs for _ in range(n))
            for prob, p in PROBS.items():
                at = (len(values) - 1) * p
                low, high = values[math.floor(at)], values[math.ceil(at)]
                off = max(abs(low), abs(high)) * 2.0**-bits + 1e-12
                assert min(low, high) - off <= found[name][prob] <= max(low, high) + off, (name, prob)
    plan = sketched_quantiles(parts[0], ["g"], PROBS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan
