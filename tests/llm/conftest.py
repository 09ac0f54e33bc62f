import random

import pytest

#: Columns that operators use inside, as extra columns of the input.
CLASHING = ["rank", "row", "h", "id", "node", "text_id", "spans", "size", "block", "score", "component", "n_removed", "bands", "place"]


def _words(random_, n):
    syllables = ["the", "an", "er", "tion", "ou", "re", "st", "é", "ß", "ing", "ha"]
    return " ".join("".join(random_.choices(syllables, k=random_.randint(1, 3))) for _ in range(n))


def messy_rows():
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared passages, nulls, empty and long texts."""
    r = random.Random(5)
    passage = _words(r, 90)
    base = _words(r, 140) + ". " + _words(r, 40)
    texts = {i: ". ".join(_words(r, r.randint(3, 30)) for _ in range(r.randint(1, 8))) for i in range(30)}
    texts |= {40 + i: base for i in range(6)}
    for i in range(8):  # one word changed
        words = base.split(" ")
        words[10 + 15 * i] = "changed"
        texts[50 + i] = " ".join(words)
    texts |= {60 + i: f"{_words(r, 20)}. {passage}. {_words(r, 20)}\n{_words(r, 8)}" for i in range(4)}
    texts |= {70: None, 71: None, 72: "", 73: " \n\t ", 74: "one two", 75: "One\tTWO", 76: "ab" * 700, 77: "\x00" * 900, 78: "é" * 900}
    texts |= {80: "Line that is the same in many texts.\n" * 40, 81: _words(r, 12_000), 82: texts[81] if 81 in texts else "x"}
    texts |= {90: "Released under the MIT License. All of it is here.", 91: "SHOUT!! " * 30, 92: "  two  spaces ①\n\n▁x "}
    rows = [(i, t, "en" if i % 2 else None, [None, "a", "b", "c", "hot", "hot", "hot"][i % 7]) for i, t in texts.items()]
    rows += [(3, texts[3], "en", "a"), (3, texts[3], "en", "a"), (4, "another text of the same id", "en", "b")]
    rows += [(None, "a text without id. " + passage, "en", "a"), (None, None, None, None), (None, base, "de", "hot")]
    return [(*row, None if row[1] is None else len(row[1])) for row in rows]


@pytest.fixture(scope="session")
def messy():
    return messy_rows()


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        df = spark.createDataFrame(rows, schema)
        for name in CLASHING:
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit("extra"))
        return df

    return make


@pytest.fixture(scope="session")
def messy_documents(documents, messy, tmp_path_factory, spark):
    path = str(tmp_path_factory.mktemp("messy") / "documents.parquet")
    documents(messy).repartition(3).write.parquet(path)
    return spark.read.parquet(path)
