import random
import zlib

import numpy as np
import pytest

from sitecharge.llm import quality


def made(n, seed):
    r = random.Random(seed)
    syllables = ["the", "an", "er", "tion", "ou", "re", "st", "é"]

    def word():
        return "".join(r.choices(syllables, k=r.randint(1, 4)))

    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(r.randint(20, 120))]
        bad = i % 4 == 0
        if bad:
            words = [w.upper() + "!!" for w in words] if i % 8 else [w + r.choice(["$$$", "%%%"]) for w in words]
        rows.append((i, " ".join(words) + ".", "en", "a", 0))
        labels.append((i, 0 if bad else 1))
    return rows, labels


@pytest.fixture(scope="module")
def judged(spark, documents):
    rows, labels = made(600, 1)
    rows += [(None, "some words without id", "en", "a", 0), (9000, None, "en", "a", 0), (9001, "", "en", "a", 0), (5, rows[5][1], "en", "a", 0)]
    rows.append((9002, "tion " * 200_000, "en", "a", 0))
    labels += [(5, 1), (6, None), (None, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    return dict(enumerate(rows)), labels, quality.judged(documents(rows), table).collect()


def test_rows_and_held_out(judged):
    rows, _, found = judged
    assert sorted(repr(r.doc_id) for r in found) == sorted(repr(i) for i, *_ in rows.values())
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_held_out_accuracy(judged):
    _, labels, found = judged
    label = {i: q for i, q in labels if q is not None}
    held = [(r.predicted, label[r.doc_id]) for r in found if r.held_out and r.doc_id in label]
    assert len(held) > 60
    assert sum(p == q for p, q in held) / len(held) > 0.95
    assert len({r.score for r in found if r.doc_id == 5}) == 1  # equal texts score alike


def test_held_out_labels_are_not_used(spark, documents):
    rows, labels = made(200, 2)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    one, two = (
        {r.doc_id: r.score for r in quality.judged(documents(rows), spark.createDataFrame(x, "doc_id long, quality int")).collect()}
        for x in (labels, turned)
    )
    assert one == two


def test_without_labels_and_empty(spark, documents):
    rows, _ = made(10, 3)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.judged(documents(rows), none).collect()} == {0.5}
    assert quality.judged(documents([]), none).count() == 0
    ones = spark.createDataFrame([(i, 1) for i in range(10)], "doc_id long, quality int")
    assert all(r.score > 0.7 for r in quality.judged(documents(rows), ones).collect())


def test_temperature_is_that_of_the_labels():
    random_ = np.random.default_rng(1)
    logits = random_.normal(0, 2, 20_000)
    labels = (random_.random(20_000) < 1 / (1 + np.exp(-logits))).astype(int)
    assert quality._temperature(3 * logits, labels) == pytest.approx(3, rel=0.1)


def test_network_learns_what_no_line_parts():
    random_ = np.random.default_rng(2)
    x = random_.normal(size=(4000, 4)).astype(np.float32)
    y = (x[:, 0] * x[:, 1] > 0).astype(np.int64)
    network = quality.fit(x, y)
    assert ((network.scores(x) > 0.5) == y).mean() > 0.93


def test_context_sums_are_those_of_a_plain_loop():
    import pyarrow as pa

    rows, _ = made(12, 4)
    texts = [t for _, t, *_ in rows] + ["", None, "one", "A-b 12 !!"]
    index = quality.index_vectors()
    expected = np.zeros(index.shape)
    for text in texts:
        data = np.frombuffer((text or "").encode(), np.uint8)
        words, shapes, _ = quality.tokens(data, np.array([0, len(data)]))
        own = index[words] + index[shapes]
        for t in range(len(words)):
            context = index[shapes[t]].copy()
            for s in range(max(0, t - quality.REACH), min(len(words), t + quality.REACH + 1)):
                if s != t:
                    context += own[s]
            expected[words[t]] += context
            expected[shapes[t]] += context
    batches = [pa.RecordBatch.from_arrays([pa.array(part, pa.string())], names=["text"]) for part in (texts[:5], texts[5:])]
    (found,) = quality._contexts(iter(batches))
    sums = np.zeros(index.shape)
    sums[found.column(0).to_numpy()] = np.column_stack([found.column(1 + d).to_numpy() for d in range(quality.DIMENSIONS)])
    assert (sums == expected).all()


def test_one_text_is_learnt_from_per_label(spark, documents, monkeypatch):
    rows, labels = made(60, 5)
    shared = next(i for i in range(60) if zlib.crc32(str(i).encode()) % 5)
    rows += [(shared, f"text {k} of the shared id", "en", "a", 0) for k in range(300)]
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y: (seen.append(len(x)), fit(x, y))[1])
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    assert quality.judged(documents(rows), table).count() == len(rows)
    assert seen == [sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(60))]
