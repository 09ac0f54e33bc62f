import random

import numpy as np
from plain import near_components, shingles

from sitecharge.llm.minhash import near_duplicates, sketch


def test_table(messy, messy_documents):
    component = near_components(messy)
    expected = [(i, len(shingles(t)), component.get(i), i is None or component[i] == i) for i, t, *_ in messy]
    found = [tuple(r) for r in near_duplicates(messy_documents).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_empty_table(messy_documents):
    assert near_duplicates(messy_documents.limit(0)).count() == 0


def test_links_through_members_only(documents):
    """A chain in which the smallest document is near its neighbour alone."""
    r = random.Random(2)
    words = [f"w{r.random()}" for _ in range(400)]
    rows = []
    for i in range(12):
        text = list(words)
        text[: 16 * i] = [f"{i}x{k}" for k in range(16 * i)]
        rows.append((100 - i, " ".join(text), "en", "a", 0))
    near = near_components(rows)
    found = {r.doc_id: r.component_id for r in near_duplicates(documents(rows)).collect()}
    assert found == near


def test_large_group_of_near_copies(documents):
    r = random.Random(3)
    words = [f"w{r.randint(0, 10**9)}" for _ in range(120)]
    rows = []
    for i in range(400):
        text = list(words)
        for k in r.sample(range(120), r.choice([1, 1, 2, 3])):
            text[k] = f"v{r.random()}"
        rows.append((i, " ".join(text), "en", "a", 0))
    found = {r.doc_id: r.component_id for r in near_duplicates(documents(rows)).collect()}
    assert found == near_components(rows)


def test_sketch_estimates_similarity():
    random_ = np.random.default_rng(1)
    for n in (1, 3, 40, 5000):
        items = random_.integers(0, 2**63, 2 * n, dtype=np.uint64)
        a, b = sketch(items[: int(1.5 * n) or 1], 512), sketch(items[n // 2 :], 512)
        x, y = set(items[: int(1.5 * n) or 1].tolist()), set(items[n // 2 :].tolist())
        assert abs((a == b).mean() - len(x & y) / len(x | y)) < 0.12
        assert (a != np.iinfo(np.uint64).max).all()
