import math

import numpy as np
import pytest
from plain import groups

from sitecharge.llm.cap_filters import near_vectors, units


def plain(rows, cosine=0.95):
    def sound(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    kept = [(i, v) for i, v in rows if i is not None and sound(v)]
    links = {n: set() for n in range(len(kept))}
    for n, (_, v) in enumerate(kept):
        for m, (_, w) in enumerate(kept[:n]):
            if len(v) == len(w) and (units(np.array([v])) @ units(np.array([w])).T)[0, 0] >= cosine:
                links[n].add(m)
                links[m].add(n)
    top = groups(links, [(a, b) for a, bs in links.items() for b in bs])
    least = {}
    for n, t in top.items():
        least[t] = min(least.get(t, kept[n][0]), kept[n][0])
    out = [(kept[n][0], len(links[n]), least[top[n]], kept[n][0] == least[top[n]]) for n in links]
    out += [(i, 0, i, True) for i, v in rows if i is None or not sound(v)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    random = np.random.default_rng(8)
    out, at = [], 0

    def add(*vectors):
        nonlocal at
        for v in vectors:
            out.append((at, None if v is None else [None if x is None else float(np.float32(x)) for x in v]))
            at += 1

    for _ in range(300):
        add(random.standard_normal(16))
    for _ in range(10):  # near copies
        center = random.standard_normal(16)
        add(*(center + 0.1 * random.standard_normal(16) for _ in range(5)))
    center = random.standard_normal(16)
    add(*(center + 0.15 * random.standard_normal(16) for _ in range(700)))  # more than a block
    add(*[center] * 30)  # equal
    add(center * 1e30, center * 1e-30, None, [], [0.0] * 16, [None] + [1.0] * 15, [math.nan] + [1.0] * 15, [math.inf] + [1.0] * 15)
    add([1.0, 0.0], [1.0, 0.01], [1.0], [2.0])
    out += [(None, out[0][1]), (5, out[5][1]), (5, out[5][1])]
    return out


def test_table(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    from pyspark.sql import functions as F

    for name in ("node", "d1", "weight", "filter", "component", "links"):
        table = table.withColumn(name, F.lit("extra"))
    found = sorted((tuple(r) for r in near_vectors(table).collect()), key=repr)
    expected = plain(rows)
    assert [r[0] for r in found] == [r[0] for r in expected]
    assert all(a[1] <= b[1] for a, b in zip(found, expected))
    assert sum(r[1] for r in found) >= 0.99 * sum(r[1] for r in expected)
    assert sum(a == b for a, b in zip(found, expected)) >= 0.98 * len(found)


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
