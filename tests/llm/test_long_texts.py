"""Texts of more than a megabyte, which tasks take in parts, beside short ones."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from plain import near_components, removals

from sitecharge.llm import suffixes
from sitecharge.llm.licenses import license_findings
from sitecharge.llm.minhash import near_duplicates
from sitecharge.llm.sentencepiece_codec import transcoded, with_digests
from sitecharge.llm.shared import CHUNK_BYTES
from sitecharge.llm.unit_dedup import unit_report, units


@pytest.fixture(scope="module")
def rows():
    r = random.Random(31)
    words = ["".join(r.choices("aeionrst", k=r.randint(2, 9))) for _ in range(5000)]
    sentences = [" ".join(r.choices(words, k=r.randint(4, 30))) for _ in range(14_000)]
    long = ". ".join(sentences) + "."
    near = long.replace(sentences[7000], "some other sentence that was put here in its place")
    license = "Released under the MIT License."
    other = ". ".join(r.sample(sentences, 3000)) + ". " + license + " " + ". ".join(" ".join(r.choices(words, k=20)) for _ in range(9000))
    texts = {1: long, 2: near, 3: other, 4: sentences[3] + ". " + license, 5: long[600_000:602_000], 6: None, 7: ""}
    assert min(len(texts[i]) for i in (1, 2, 3)) > CHUNK_BYTES
    return [(i, t, "en", "a", 0) for i, t in texts.items()]


@pytest.fixture(scope="module")
def docs(documents, rows):
    return documents(rows).repartition(2).cache()


def test_sentencepiece(docs, rows):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in with_digests(transcoded(docs, path)).collect()}
    for i, text, *_ in rows:
        ids = library.encode(text or "")
        assert found[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_near_duplicates(docs, rows):
    found = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert found == near_components(rows) and found[2] == 1


def test_units(docs, rows):
    seen, expected = set(), {}
    for i, text, *_ in rows:
        spans = []
        for a, b, unit in units(text or "", True):
            if unit.count(" ") + 1 >= 6:
                spans += [(a, b)] if unit in seen else []
                seen.add(unit)
        expected[i] = spans
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in unit_report(docs).collect()} == expected


def test_repeated_bytes(docs, rows):
    length = 120
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.removals(docs, length).collect()}
    assert found == dict(zip([i for i, *_ in rows], removals([t for _, t, *_ in rows], length)))


def test_licenses(docs, rows):
    """Found where it stands; another template of the license may save a byte more and be confirmed with fewer words."""
    statement = "Released under the MIT License."
    places = {i: t.index(statement) for i, t, *_ in rows if t and statement in t}
    found = license_findings(docs).collect()
    assert sorted((r.doc_id, r.license) for r in found) == sorted((i, "MIT") for i in places)
    for r in found:
        at = places[r.doc_id]
        assert at <= r["first"] <= at + len("Released ") and r["last"] == at + len(statement)
