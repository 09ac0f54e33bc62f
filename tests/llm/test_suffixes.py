import random

import numpy as np
import pytest
from plain import removals as plain_removals

from sitecharge.llm import suffixes
from sitecharge.llm.suffixes import SuffixArray, removals


def test_table(messy, messy_documents):
    plain = plain_removals([t for _, t, *_ in messy], 400)
    expected = [(doc_id, *found) for (doc_id, *_), found in zip(messy, plain)]
    found = removals(messy_documents).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_empty_table(messy_documents):
    assert removals(messy_documents.limit(0)).count() == 0


def test_short_windows_of_repetitive_texts(documents):
    r = random.Random(4)
    texts = ["".join(r.choices("ab", k=r.randint(0, 300))) for _ in range(40)] + ["ab" * 200, "a" * 500, "a" * 70, "é" * 60]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    found = removals(documents(rows), length=40, gram=8).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, found)) == [(i, *x) for i, x in enumerate(plain_removals(texts, 40))]


def test_anchor_spread_over_shards(documents, monkeypatch):
    """Variants around one common string make more than a shard holds, so shards are merged."""
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 4000)
    r = random.Random(6)
    core = "".join(r.choices("abcdefgh", k=90))
    texts = []
    for _ in range(60):
        side = ["".join(r.choices("abcdefgh", k=60)) for _ in range(2)]
        cut = r.randint(0, 60)
        texts.append(side[0] + core[: 90 - cut] + side[1])
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    found = removals(documents(rows), length=40, gram=8).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, found)) == [(i, *x) for i, x in enumerate(plain_removals(texts, 40))]


@pytest.mark.parametrize("letters", ["a", "ab", "\x00a", "abcdefgh"])
def test_suffix_array(letters):
    r = random.Random(letters)
    parts = ["".join(r.choices(letters, k=r.randint(1, 60))).encode() for _ in range(12)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    array = SuffixArray(data, offsets)
    suffix = [(parts[k][i:], offsets[k] + i) for k in range(12) for i in range(len(parts[k]))]
    assert [at for _, at in sorted(suffix)] == array.order.tolist()
    windows = np.maximum(0, np.diff(offsets) - 4)
    marks = array.repeats(windows, 5)
    every = [s[:5] for s, _ in suffix if len(s) >= 5]
    assert {at for s, at in suffix if len(s) >= 5 and every.count(s[:5]) > 1} == set(np.flatnonzero(marks).tolist())
