"""Line and paragraph dedup: units of text that occur again, in the same text or in another, are removed.

A text is cut into lines, and with ``sentences`` each line further behind . ! ? and the blanks that follow, so
that a passage which stands inside a longer paragraph is found too. Units are normalised (A-Z lowered,
white space made one blank, none at the ends) and those of at least ``least_words`` words are
grouped by digest over all texts. Of a group, the earliest occurrence stays, in order of doc_id (null last), a
hash of the text, and position; the others are removed. Offsets are in characters of the original
text.

With ``joined``, neighbouring units that are shorter are grouped too, across line ends: every run that starts or ends
at one and goes on until it has ``least_words`` words. A unit is removed where it lies in a run, or is a unit, that
occurred earlier. So every stretch of whole units that has ``least_words`` words or more and occurs again goes
as a whole, whatever its units' lengths; the earliest occurrence of a unit always stays. Pieces of a unit do not count.
The registered query is held to ``ORACLE`` and does without.

Null texts count as empty and have no units. Rows of equal doc_id and text are one document, returned as
often as it occurs. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import string
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecharge.llm.shared import in_tasks, slices, stored, text_bytes

LEAST_WORDS = 6
_LINES = re.compile(r"[^\n]+\n?|\n")
_SENTENCES = re.compile(r"[^\n.!?]+(?:[.!?]+[ \t]*|\n)?|[.!?]+[ \t]*|\n")
_SPACE = re.compile(r"[ \t\n\x0b\f\r]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def units(text: str, sentences: bool) -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised) of every unit; they follow each other without gaps."""
    for match in (_SENTENCES if sentences else _LINES).finditer(text):
        yield match.start(), match.end(), _SPACE.sub(" ", match.group().translate(_LOWER)).strip(" ")


def runs(found: list[tuple[int, int, str]], least_words: int) -> Iterator[tuple[int, int, str]]:
    """(first, last, normalised) of the shortest runs of ``least_words`` words from each unit on and up to each unit.

    ``first`` and ``last`` are numbers of units. Units without words neither start nor end a run.
    """
    worded = [i for i, (_, _, unit) in enumerate(found) if unit]
    words = list(accumulate((found[i][2].count(" ") + 1 for i in worded), initial=0))
    seen = set()
    for k in range(len(worded)):
        onward = (k, bisect_left(words, words[k] + least_words) - 1)
        back = (bisect_right(words, words[k + 1] - least_words) - 1, k)
        for a, b in (onward, back):
            if 0 <= a and b < len(worded) and (a, b) not in seen:
                seen.add((a, b))
                yield worded[a], worded[b], " ".join(found[i][2] for i in worded[a : b + 1])


def _grouped(found: list[tuple[int, int, str]], least_words: int, joined: bool) -> Iterator[tuple[list[int], str]]:
    """(offsets of units, what is grouped): a unit's own start and end, or those of every unit of a run."""
    if joined:
        for first, last, run in runs(found, least_words):
            yield [x for a, b, unit in found[first : last + 1] if unit for x in (a, b)], run
    else:
        for a, b, unit in found:
            if unit.count(" ") + 1 >= least_words:
                yield [a, b], unit


def _digested(batches: Iterator[pa.RecordBatch], sentences: bool, least_words: int, joined: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "h", "first", "cuts", "d1", "d2"]
    for batch in batches:
        for start, stop in slices(text_bytes(batch.column(2))[1]):
            rows, first, cuts, d1, d2 = [], [], [], [], []
            for row, text in enumerate(batch.column(2)[start:stop].to_pylist(), start):
                for offsets, unit in _grouped(list(units(text or "", sentences)), least_words, joined):
                    digest = hashlib.blake2b(unit.encode(), digest_size=16).digest()
                    rows.append(row)
                    first.append(offsets[0])
                    cuts.append(offsets)
                    d1.append(int.from_bytes(digest[:8], "little", signed=True))
                    d2.append(int.from_bytes(digest[8:], "little", signed=True))
            at = pa.array(rows, pa.int64())
            columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(first, pa.int32()), pa.array(cuts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(d1, pa.int64()), pa.array(d2, pa.int64())], names=names)


def _counted(batches: Iterator[pa.RecordBatch], sentences: bool) -> Iterator[pa.RecordBatch]:
    pattern = _SENTENCES if sentences else _LINES
    for batch in batches:
        many = [sum(1 for _ in pattern.finditer(text or "")) for text in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(many, pa.int64())], names=["doc_id", "h", "n_units"])


def repeated_units(docs: DataFrame, sentences: bool = True, least_words: int = LEAST_WORDS, joined: bool = False) -> DataFrame:
    """(doc_id, h, spans) of documents that lose units; spans are sorted (first, last) offsets, h the text's hash."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    schema = f"doc_id {kind}, h long, first int, cuts array<int>, d1 long, d2 long"
    digested = stored(in_tasks(named, partial(_digested, sentences=sentences, least_words=least_words, joined=joined), schema))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "first")
    groups = digested.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(place).alias("at")).where("n > 1")
    again = digested.join(groups.select("d1", "d2", "at"), ["d1", "d2"]).where(place != F.col("at"))
    lost = again.select("doc_id", "h", F.explode(F.sequence(F.lit(0), F.size("cuts") - 2, F.lit(2))).alias("i"), "cuts")
    lost = lost.select("doc_id", "h", F.col("cuts")[F.col("i")].alias("first"), F.col("cuts")[F.col("i") + 1].alias("last")).distinct()
    return lost.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))


def unit_report(docs: DataFrame, sentences: bool = True, least_words: int = LEAST_WORDS, joined: bool = False) -> DataFrame:
    """(doc_id, n_units, n_removed, removed_chars, spans) per row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = repeated_units(docs, sentences, least_words, joined)
    named = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    rows = in_tasks(named, partial(_counted, sentences=sentences), f"doc_id {kind}, h long, n_units long")
    same = F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("r.h") == F.col("s.h"))
    joined = rows.alias("r").join(spans.alias("s"), same, "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<first:int,last:int>>"))
    return joined.select(
        "r.doc_id",
        "n_units",
        F.size(spans).cast("long").alias("n_removed"),
        F.aggregate(spans, F.lit(0).cast("long"), lambda sum_, s: sum_ + s["last"] - s["first"]).alias("removed_chars"),
        spans.alias("spans"),
    )


def without_repeats(docs: DataFrame, sentences: bool = True, least_words: int = LEAST_WORDS, joined: bool = False) -> DataFrame:
    """``docs`` with the units that occurred earlier cut out of ``text``."""
    spans = repeated_units(docs, sentences, least_words, joined)
    same = F.col("_d.doc_id").eqNullSafe(F.col("_s.doc_id")) & (F.xxhash64("_d.text") == F.col("_s.h"))
    joined = docs.alias("_d").join(spans.alias("_s"), same, "left")
    kept = F.aggregate(
        F.col("_s.spans"),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda held, s: F.struct(
            F.concat(held["out"], F.substring(F.col("_d.text"), held["at"] + 1, s["first"] - held["at"])).alias("out"), s["last"].alias("at")
        ),
        lambda held: F.concat(held["out"], F.substring(F.col("_d.text"), held["at"] + 1, F.char_length("_d.text"))),
    )
    text = F.when(F.col("_s.spans").isNull(), F.col("_d.text")).otherwise(kept)
    return joined.select(*(text.alias(c) if c == "text" else F.col(f"_d.`{c}`").alias(c) for c in docs.columns))


#: The report of ``unit_report`` as DuckDB SQL, with spans as text.
ORACLE = rf"""
WITH cut AS (
  SELECT DISTINCT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\n.!?]+(?:[.!?]+[ \t]*|\n)?|[.!?]+[ \t]*|\n') AS parts
  FROM documents
), laid AS (
  SELECT doc_id, text, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS pos FROM cut
), placed AS (
  SELECT doc_id, text, pos, length(part) AS chars,
         coalesce(sum(length(part)) OVER (PARTITION BY doc_id, text ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins,
         trim(regexp_replace(translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\f\r]+', ' ', 'g')) AS unit
  FROM laid
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY unit ORDER BY doc_id NULLS LAST, text, pos) AS nth FROM placed
), lost AS (
  SELECT doc_id, text, begins, chars FROM ranked WHERE nth > 1 AND length(unit) - length(replace(unit, ' ', '')) + 1 >= {LEAST_WORDS}
), summed AS (
  SELECT doc_id, text, count(*) AS n, sum(chars) AS chars,
         string_agg(CAST(begins AS BIGINT) || '-' || CAST(begins + chars AS BIGINT), ',' ORDER BY begins) AS spans
  FROM lost GROUP BY ALL
)
SELECT d.doc_id, CAST(len(regexp_extract_all(coalesce(d.text, ''), '[^\n.!?]+(?:[.!?]+[ \t]*|\n)?|[.!?]+[ \t]*|\n')) AS BIGINT) AS n_units,
       CAST(coalesce(s.n, 0) AS BIGINT) AS n_removed, CAST(coalesce(s.chars, 0) AS BIGINT) AS removed_chars, coalesce(s.spans, '') AS spans
FROM documents d LEFT JOIN summed s ON d.doc_id IS NOT DISTINCT FROM s.doc_id AND d.text IS NOT DISTINCT FROM s.text
"""
