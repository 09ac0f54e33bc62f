import random

import public_tokenizers
import pytest
import sentencepiece
from plain import near_components, removals

import corpus_pipeline
from sitecharge.llm.mixing import mixed_documents


@pytest.fixture(scope="module")
def folder(spark, documents, messy, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    r = random.Random(9)
    rows = list(messy) + [(1000 + i, " ".join(f"BAD{r.random()}!!" for _ in range(40)), "en", "a", 0) for i in range(40)]
    documents(rows).drop("rank", "row").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 0 if i >= 1000 else 1) for i, *_ in rows if i is not None]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").cache()
    columns = docs.columns
    (_, first), (_, second), (_, third), (_, fourth), (_, last) = corpus_pipeline.STAGES

    good = first(spark, docs, folder).cache()
    assert good.columns == columns
    ids = {r.doc_id for r in good.collect()}
    assert not any(i is not None and i >= 1000 for i in ids) and len(ids) > 50

    single = second(spark, good, folder).cache()
    assert single.columns == columns
    rows = [(r.doc_id, r.text) for r in good.collect()]
    component = near_components(rows)
    kept = [r.doc_id for r in single.collect()]
    assert sorted(i for i in kept if i is not None) == sorted(set(component.values()))
    assert kept.count(None) == sum(i is None for i, _ in rows)

    cut = third(spark, single, folder).cache()
    assert cut.columns == columns and cut.count() == single.count()
    rows = [(r.doc_id, r.text) for r in single.collect()]
    plain = removals([t for _, t in rows], 400)
    after = {r.doc_id: (r.text, r.n_chars) for r in cut.collect()}
    for (i, text), (size, removed, _, _) in zip(rows, plain):
        if i is not None and not removed:
            assert after[i][0] == text
        elif i is not None:
            left = after[i][0]
            # a character that is cut stays whole
            assert size - removed <= len(left.encode()) <= size - removed + 6 and after[i][1] == len(left)

    mix = fourth(spark, cut, folder).cache()
    assert mix.columns == columns
    placed, pieces = mixed_documents(cut)
    starts = pieces.where("first = 0").join(placed, "row").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in mix.groupBy("doc_id").count().collect()} == {r.doc_id: r["count"] for r in starts}

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.TOKENIZER))
    found = sorted(((r.doc_id, list(r.ids)) for r in last(spark, mix, folder).collect()), key=repr)
    assert found == sorted(((r.doc_id, library.encode(r.text or "")) for r in mix.collect()), key=repr)


def test_pairs_between_80_and_85_are_near(spark, documents):
    r = random.Random(4)
    rows = []
    for i in range(60):
        words = [f"w{r.random()}" for _ in range(204)]
        rows.append((2 * i, " ".join(words), "en", "a", 0))
        # 200 shingles, of which 20 differ, or 18 when the last words do: 180 / 220 and 182 / 218 are shared
        for k in (20, 60, 100, 140) if i % 2 else (20, 60, 100, 202):
            words[k] = f"v{r.random()}"
        rows.append((2 * i + 1, " ".join(words), "en", "a", 0))
    assert len(set(near_components(rows, percent=85).values())) == 120
    kept = corpus_pipeline.one_of_each_group(spark, documents(rows), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(near_components(rows, percent=80).values())) == list(range(0, 120, 2))


def test_run(spark, folder):
    once = corpus_pipeline.run(spark, folder)
    assert once.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(repr, once.collect())) == sorted(map(repr, again.collect()))


def test_empty(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
