import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from sitecharge.llm import importance, shared
from sitecharge.llm.queries import oracle_sql, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, low, high):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) for g in grams]


def plain(rows, target, low=1, high=1, buckets=10_000, least_words=20, percent=10, seed=2024):
    found = [(doc_id, text, *features(text, low, high)) for doc_id, text, *_ in rows]
    s = collections.Counter(f % buckets for *_, fs in found for f in fs)
    t = collections.Counter(f % buckets for text in target for f in features(text, low, high)[1])
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))

    out = []
    for doc_id, text, n, fs in found:
        weight = sum(gain(f % buckets) for f in fs)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    drawn = sum(r[1] >= least_words for r in out) * percent // 100
    best = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, best[:drawn]


def test_running_crcs():
    data = np.frombuffer(random.Random(1).randbytes(3000), np.uint8)
    found = importance.running_crcs(data)
    assert found.tolist() == [zlib.crc32(data[:i].tobytes()) for i in range(len(data) + 1)]
    assert importance.running_crcs(data[:0]).tolist() == [0]


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.text(alphabet="abAZ09 .-\n\x00éß中😀'", max_size=40), max_size=6), size=st.integers(3, 30), high=st.integers(1, 4))
def test_features_of_parts(texts, size, high):
    """Texts above the size of a part, which overlap, give what whole texts give."""
    before, shared.CHUNK_BYTES = shared.CHUNK_BYTES, size
    try:
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        (counts,) = importance._counted(iter([batch]), 1, high, 97)
    finally:
        shared.CHUNK_BYTES = before
    expected = collections.Counter(f % 97 for t in texts for f in features(t, 1, high)[1])
    assert dict(zip(*(c.to_pylist() for c in counts.columns))) == expected


def test_table(spark, messy, messy_documents):
    target = ["the tion erin", None, "", "one two one two " * 10]
    frame = spark.createDataFrame([(t, "x") for t in target], "text string, doc_id string")
    for options in ({}, {"low": 1, "high": 3, "buckets": 500, "percent": 37, "least_words": 2}):
        found = importance.resampled(messy_documents, frame, **options).collect()
        expected, drawn = plain(messy, target, **options)
        assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(expected, key=repr)
        ranks = sorted((r.rank, r.doc_id, r.score) for r in found if r["rank"] is not None)
        assert ranks == [(i, r[0], r[4]) for i, r in enumerate(drawn, 1)]


def test_long_text(spark, documents):
    words = random.Random(3).choices(["alpha", "Beta", "gamma1", "délta"], k=300_000)
    rows = [(1, " ".join(words), "en", "a", 0), (2, "x" * 2_500_000 + " end", "en", "a", 0), (3, "alpha beta", "en", "a", 0)]
    found = importance.resampled(documents(rows), documents(rows[2:]), high=2, percent=100, least_words=1).collect()
    expected, drawn = plain(rows, ["alpha beta"], high=2, percent=100, least_words=1)
    assert sorted(tuple(r)[:5] for r in found) == sorted(expected)
    assert [r.doc_id for r in sorted(found, key=lambda r: r["rank"])] == [r[0] for r in drawn]


def test_empty_tables(spark, messy_documents):
    nothing = messy_documents.limit(0)
    assert importance.resampled(nothing, messy_documents).count() == 0
    found = importance.resampled(messy_documents, nothing)
    assert found.count() == messy_documents.count()


def test_sql(spark, documents, messy, tmp_path):
    rows = [r for r in messy if r[0] is not None and "\x00" not in (r[1] or "")]
    rows = list({r[0]: r for r in rows}.values())
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    target = spark.createDataFrame([(1, "the tion erin one two"), (2, None)], "item_id long, text string")
    target.write.parquet(f"{tmp_path}/benchmark.parquet")
    with duckdb.connect() as connection:
        for name in ("documents", "benchmark"):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
        expected = connection.execute(oracle_sql()["op12_importance"]).fetchall()
        names = [c[0] for c in connection.description]
    found = queries()["op12_importance"](spark, str(tmp_path))
    assert found.columns == names and {t for _, t in found.dtypes} == {"bigint"}
    assert sorted(map(tuple, found.collect())) == sorted(expected)
