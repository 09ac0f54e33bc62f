import pytest

from sitecharge.llm.unit_dedup import unit_report, units, without_repeats


def plain(rows, sentences, least):
    """doc rows -> (doc_id, units, removed, chars, spans)."""
    unique = {(i is None, i or 0, t or "") for i, t, *_ in rows}
    seen, lost = set(), {}
    for none, i, text in sorted(unique):
        for a, b, unit in units(text, sentences):
            if unit.count(" ") + 1 >= least:
                if unit in seen:
                    lost.setdefault((none, i, text), []).append((a, b))
                seen.add(unit)
    out = []
    for i, t, *_ in rows:
        spans = lost.get((i is None, i or 0, t or ""), [])
        out.append((i, len(list(units(t or "", sentences))), len(spans), sum(b - a for a, b in spans), spans))
    return out


@pytest.mark.parametrize("sentences", [True, False])
def test_table(messy, messy_documents, sentences):
    # of one id and several texts, which is first goes by a hash: leave it out here
    several = {i for i, t, *_ in messy if i is not None and len({u for j, u, *_ in messy if j == i}) > 1} | {None}
    rows = [r for r in messy if r[0] not in several]
    from pyspark.sql import functions as F

    docs = messy_documents.where(F.col("doc_id").isNotNull() & ~F.col("doc_id").isin([i for i in several if i is not None]))
    found = unit_report(docs, sentences=sentences).collect()
    shown = [(r.doc_id, r.n_units, r.n_removed, r.removed_chars, [tuple(s) for s in r.spans]) for r in found]
    assert sorted(shown, key=repr) == sorted(plain(rows, sentences, 6), key=repr)
    texts = {r.doc_id: r.text for r in without_repeats(docs, sentences=sentences).collect()}
    for (i, text, *_), (_, _, _, _, spans) in zip(rows, plain(rows, sentences, 6)):
        kept, at = "", 0
        for a, b in spans:
            kept, at = kept + text[at:a], b
        assert texts[i] == (text if not spans else kept + text[at:])


def test_units_follow_each_other():
    text = "One two. Three!?  four\n\nfive. \t six...seven\n."
    for sentences in (True, False):
        found = list(units(text, sentences))
        assert "".join(text[a:b] for a, b, _ in found) == text


def test_all_rows_and_empty(messy, messy_documents):
    assert unit_report(messy_documents).count() == len(messy)
    assert without_repeats(messy_documents).columns == messy_documents.columns
    assert unit_report(messy_documents.limit(0)).count() == 0


def test_repeated_stretches_of_short_sentences(documents):
    import random

    r = random.Random(6)

    def shout(n):
        return " ".join(f"W{r.randint(0, 10**9)}!!" for _ in range(n))

    first, second = shout(60), "Thus. " + shout(3) + f" Of w{r.random():.9f}".replace(".", "") + " on. " + shout(4)
    texts = [f"{shout(9)} {first} {shout(7)}", f"{shout(5)} {first} {shout(8)}\n{second}", f"{second}\n{shout(2)}", shout(70), "Yes. No.", "Yes. No."]
    docs = documents([(i, t, "en", "a", 0) for i, t in enumerate(texts)])
    assert all(row.n_removed == 0 for row in unit_report(docs).collect())
    kept = {row.doc_id: row.text for row in without_repeats(docs, joined=True).collect()}
    assert [kept[i] for i in (0, 3, 4, 5)] == [texts[i] for i in (0, 3, 4, 5)]
    assert kept[1] == texts[1].replace(first + " ", "") and kept[2].strip() == texts[2].split("\n")[1]


def test_joined_keeps_an_earliest_occurrence_of_every_unit(messy, messy_documents):
    rows = {i: t for i, t, *_ in messy if i is not None}
    report = unit_report(messy_documents, joined=True).collect()
    alone = {(r.doc_id, r.n_units, tuple(map(tuple, r.spans))) for r in unit_report(messy_documents).collect()}
    assert len(report) == len(messy)
    assert sum(r.n_removed for r in report) >= sum(len(spans) for _, _, spans in alone)
    left = {u for r in without_repeats(messy_documents, joined=True).collect() for *_, u in units(r.text or "", True)}
    assert {u for t in rows.values() for *_, u in units(t or "", True)} <= left
