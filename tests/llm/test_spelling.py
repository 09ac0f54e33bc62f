import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from sitecharge.llm import spelling
from sitecharge.llm.queries import oracle_sql, queries

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows, least=7, times=2, every=31):
    out = collections.Counter()
    for doc_id, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += len(run) >= least
    return {w: n for w, n in out.items() if n >= times}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, ratio=10):
    near = {w: [o for o in counts if abs(len(w) - len(o)) < 2 and one_edit(w, o)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while ratio and form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out)


def made(r, n, letters="abé", sizes=(7, 8, 9)):
    """Words close to one another, with very different counts."""
    words = set()
    while len(words) < n:
        words.add("".join(r.choices(letters, k=r.choice(sizes))))
    return {w: int(2 + 10 ** r.uniform(0, 4)) for w in words}


@pytest.fixture()
def small_cells(monkeypatch):
    monkeypatch.setattr(spelling, "CELL_WORDS", 12)
    monkeypatch.setattr(spelling, "LEAF", 4)


def run_cells(counts, trees):
    """The tasks of ``near_words`` without Spark."""

    class Shared:
        value = trees

    words = sorted(counts)
    batch = pa.RecordBatch.from_arrays([pa.array(words), pa.array([counts[w] for w in words], pa.int64())], names=["word", "n"])
    placed = [r for b in spelling._placed(iter([batch]), Shared) for r in b.to_pylist()]
    placed.sort(key=lambda r: (r["cell"], r["role"]))
    schema = pa.schema({"cell": pa.int64(), "role": pa.int32(), "word": pa.string(), "n": pa.int64()})
    batches = [pa.RecordBatch.from_pylist(placed[i : i + 7], schema) for i in range(0, len(placed), 7)]
    near = collections.defaultdict(lambda: [0, (0, "")])
    for b in spelling._compared(iter(batches)):
        for r in b.to_pylist():
            near[r["word"]][0] += r["n_near"]
            near[r["word"]][1] = min(near[r["word"]][1], (-r["best_n"], r["best"]))
    return placed, near


@pytest.mark.parametrize("seed", range(6))
def test_links_of_cells(monkeypatch, seed):
    """Trees of several cells, and of one, find the same links as all pairs do."""
    monkeypatch.setattr(spelling, "LEAF", 3)
    r = random.Random(seed)
    counts = made(r, 300, "ab" if seed % 2 else "abcdéÿ×", (7, 8, 9, 10) if seed % 3 else (7, 40))
    trees = {}
    for size in {len(w) for w in counts}:
        words = sorted(w.encode("latin-1") for w in counts if len(w) == size)
        trees[size] = (0, spelling.Tree(spelling.Points(words[::3], np.zeros(0, np.int64)).counts, 2, 4))
    for upper in ({}, trees):
        placed, near = run_cells(counts, upper)
        assert len({p["cell"] for p in placed if p["role"] == 0}) > (len(trees) if upper else 0)
        for word, form, _, n, n_near, form_n in plain(counts, ratio=0):
            assert (near[word][0] if word in near else 0) == n_near
            if n_near:
                assert near[word][1] == (-form_n, form)


def test_bits_never_exceed_the_distance():
    r = random.Random(3)
    words = ["".join(r.choices("abàÀÿĀ"[:5], k=300)).encode("latin-1") for _ in range(60)]
    points = spelling.Points(words, np.zeros(60, np.int64))
    for i in range(60):
        apart = np.bitwise_count(points.bits ^ points.bits[i]).sum(1)
        real = [sum(abs(a.count(c) - words[i].count(c)) for c in set(a + words[i])) for a in words]
        assert (apart <= real).all()


def test_variants(spark, small_cells):
    counts = made(random.Random(1), 400)
    counts |= {"aaaaaaa": 3, "aaaaaab": 40, "aaaaabb": 500, "aaaabbb": 6000, "aaabbbb": 70_000}
    words = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    found = spelling.variants(spelling.stored(words))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, found.collect()), key=lambda r: r[0]) == plain(counts)


def test_long_words(spark):
    base = "ab" * 3000
    words = [base, base[:-1], "c" + base, base[:100] + "x" + base[101:], base[::-1], "z" * 6000]
    counts = {w: 10**i for i, w in enumerate(words)}
    found = spelling.variants(spelling.stored(spark.createDataFrame(sorted(counts.items()), "word string, n long")))
    assert sorted(map(tuple, found.collect()), key=lambda r: r[0]) == plain(counts)


def test_documents(spark, messy, messy_documents):
    found = {r.word: r.n for r in spelling.word_counts(messy_documents).collect()}
    assert found == counted(messy)
    assert {r.word: r.n for r in spelling.word_counts(messy_documents, 3, 5, 0).collect()} == counted(messy, 3, 5, 0)
    rows = spelling.spelling_variants(messy_documents).collect()
    assert sorted(map(tuple, rows), key=lambda r: r[0]) == plain(counted(messy))


def test_empty(spark, documents, messy_documents):
    assert spelling.spelling_variants(messy_documents.limit(0)).count() == 0
    assert spelling.spelling_variants(documents([(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "short one", "en", "a", 0)])).count() == 0


def test_sql(spark, documents, messy, tmp_path):
    r = random.Random(6)
    rows = [row for row in messy if row[0] is not None and "\x00" not in (row[1] or "")]
    rows += [(500 + i, " ".join(r.choices(sorted(made(r, 30, "aeÉßn", (6, 7, 8))), k=60)), "en", "a", 0) for i in range(20)]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        expected = connection.execute(oracle_sql()["op13_spelling"]).fetchall()
        names = [c[0] for c in connection.description]
    found = queries()["op13_spelling"](spark, str(tmp_path))
    assert found.columns == names
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr) == sorted(plain(counted(rows)), key=repr)
