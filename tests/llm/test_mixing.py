import collections

import pytest
from plain import WORD

from sitecharge.llm.mixing import mixed_documents, schedule, taken, targets


def levels(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), share * sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in full]
        rest = total - most * sum(sizes[s] for s in full)
        over = {s for s in free if rest * weight[s] / sum(weight[f] for f in free) > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else rest * weight[s] / sum(weight[f] for f in free) for s in sizes}
        full |= over


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_table(messy, messy_documents, block):
    sizes = [len(WORD.findall(t or "")) for _, t, *_ in messy]
    by_source = collections.Counter()
    for (_, _, _, source, _), size in zip(messy, sizes):
        by_source[source] += size
    goal = levels(by_source)
    rows = taken(messy_documents, block=block).collect()
    plain = [(i, source, size, by_source[source]) for (i, _, _, source, _), size in zip(messy, sizes)]
    assert sorted(((r.doc_id, r.source, r.size, r.source_size) for r in rows), key=repr) == sorted(plain, key=repr)
    got = collections.Counter()
    for r in rows:
        assert r.target == pytest.approx(goal[r.source])
        assert 0 <= r.taken <= 2 * r.size
        got[r.source] += r.taken
    assert all(abs(got[s] - goal[s]) <= 0.51 for s in goal)
    assert sorted(map(repr, rows)) == sorted(map(repr, taken(messy_documents, block=block).collect()))


def test_blocks_are_shared_evenly(spark):
    goals = targets(spark.createDataFrame([("a", 40_000), ("b", 20_000), (None, 0), ("c", 30_000)], "source string, source_size long"))
    slots = sorted(map(tuple, schedule(goals, 100).collect()))
    assert len({(s, p) for s, p, *_ in slots}) == len(slots)
    places = [p for _, p, *_ in slots]
    for p in set(places):  # any stretch has its share of each source
        whole = places.count(p) / len(places)
        for at in range(0, len(places) - 200, 50):
            assert abs(places[at : at + 200].count(p) / 200 - whole) < 0.05
        nth = [(e, b) for _, q, b, e, _ in slots if q == p]
        assert nth == sorted(nth)


def test_pieces_cover_what_is_taken(messy_documents):
    placed, mix = mixed_documents(messy_documents, block=50)
    size = {r.row: r.size for r in placed.collect()}
    for r in mix.collect():
        assert 0 <= r["first"] < r["last"] <= size[r.row]


def test_empty_table(messy_documents):
    assert taken(messy_documents.limit(0)).count() == 0
    assert {r.taken for r in taken(messy_documents.where("text IS NULL")).collect()} == {0}
