"""Importance resampling of documents towards a target: hashed n-gram features, log ratios, Gumbel draws.

A text is lower-cased (A-Z only) and cut into words of ASCII letters, digits and everything beyond ASCII. Its
words joined by one space are scanned once: the CRC-32 of every prefix is kept, and the CRC of any run of words
follows from the prefixes at its two ends, since ``crc(AB) = crc(A) * x^(8|B|) xor crc(B)`` over GF(2). The CRC modulo
``buckets`` is the feature. Counts per bucket over all documents and over all target texts give each bucket a
gain in thousandths of a nat; a document's weight is the sum over its features, repeats counted, and
weight plus Gumbel noise, which comes from the doc_id alone, decides who is drawn.

Null texts count as empty: no words, no features, weight 0, never drawn as long as ``least_words`` is above 0. Equal
rows are drawn on their own; ties of the score go to the smaller doc_id (null last), then to the smaller text hash.
A null doc_id is noise of the bare seed. An empty target leaves gains that only depend on the documents; extra columns
are ignored. Texts over CHUNK_BYTES are read in parts that overlap by ``high - 1`` words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecharge.llm import shared
from sitecharge.llm.shared import in_tasks, ranked, slices, stored, text_bytes

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024

#: The CRC-32 polynomial of zlib, lowest power in the highest bit (a fixed value).
POLYNOMIAL = 0xEDB88320
#: Bytes in a lane of the running CRCs.
LANE = 256

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_IS_WORD = (_LOWER >= 128) | ((_LOWER >= 97) & (_LOWER <= 122)) | ((_LOWER >= 48) & (_LOWER <= 57))


def _byte_table() -> np.ndarray:
    """What one zero byte turns the low byte of a CRC into."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(POLYNOMIAL), value >> 1)
    return value.astype(np.uint32)


_TABLE = _byte_table()


def _applied(operator: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map, as four tables of 256 for the bytes of its argument, on many values."""
    out = operator[0][values & 255]
    for i in (1, 2, 3):
        out = out ^ operator[i][(values >> np.uint32(8 * i)) & 255]
    return out


@cache
def _shift_operator(power: int) -> np.ndarray:
    """Multiplication by x^(8 * 2^power) modulo the polynomial, that is the passing of 2^power zero bytes."""
    digits = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    if power == 0:
        return _TABLE[digits & 255] ^ (digits >> np.uint32(8))
    half = _shift_operator(power - 1)
    return _applied(half, _applied(half, digits))


def shifted(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRCs after as many zero bytes as ``sizes`` says, without the inversions of the first and last step."""
    out = values.copy()
    for power in range(int(sizes.max(initial=0)).bit_length()):
        chosen = np.flatnonzero((sizes >> power) & 1)
        out[chosen] = _applied(_shift_operator(power), out[chosen])
    return out


def running_crcs(data: np.ndarray) -> np.ndarray:
    """zlib's CRC-32 of every prefix of ``data``, the empty one first.

    The bytes stand in lanes, which one step of the CRC passes together, column by column.
    """
    n = len(data)
    lanes = -(-n // LANE)
    padded = np.zeros(lanes * LANE, np.uint8)
    padded[:n] = data
    padded = padded.reshape(lanes, LANE)
    state = np.empty(lanes, np.uint32)
    crc = 0
    for i in range(lanes):
        state[i] = crc
        crc = crc32(padded[i], crc)
    state ^= np.uint32(0xFFFFFFFF)
    columns = np.ascontiguousarray(padded.T)
    out = np.empty((LANE, lanes), np.uint32)
    for i in range(LANE):
        state = _TABLE[(state ^ columns[i]) & 255] ^ (state >> np.uint32(8))
        out[i] = state
    prefixes = np.zeros(n + 1, np.uint32)
    prefixes[1:] = (out.T.reshape(-1) ^ np.uint32(0xFFFFFFFF))[:n]
    return prefixes


class Words:
    """The words of several texts, given as bytes one after another, and the CRCs at their borders."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = _IS_WORD[data]
        # an edge lies before each byte whose class is another one's, and where a text begins
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < len(data))]
        before[cuts] = False
        after[cuts - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        lengths = ends - self.starts
        self.owner = np.searchsorted(offsets, self.starts, "right") - 1
        joined = np.full(int(lengths.sum()) + len(lengths), 32, np.uint8)
        nth_word = np.repeat(np.arange(len(lengths)), lengths)
        joined[np.arange(len(nth_word)) + nth_word] = _LOWER[data[inside]]
        self.last = np.cumsum(lengths + 1) - 1
        self.first = self.last - lengths
        crcs = running_crcs(joined)
        self.crc_first, self.crc_last = crcs[self.first], crcs[self.last]

    def features(self, n: int, buckets: int, fresh: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(text, bucket) of all runs of n words of one text that end at word ``fresh`` or later."""
        ends = np.arange(max(fresh, n - 1), len(self.owner))
        begins = ends - (n - 1)
        same = self.owner[begins] == self.owner[ends]
        begins, ends = begins[same], ends[same]
        crc = self.crc_last[ends] ^ shifted(self.crc_first[begins], self.last[ends] - self.first[begins])
        return self.owner[ends], (crc % np.uint32(buckets)).astype(np.int64)


def _parts(data: np.ndarray, offsets: np.ndarray, high: int) -> Iterator[tuple[int, int, Words, int]]:
    """(first row, rows, words, words that the part before had already): all texts, some CHUNK_BYTES at a time."""
    for first, last in slices(offsets, shared.CHUNK_BYTES):
        begin, end = int(offsets[first]), int(offsets[last])
        if last - first > 1 or end - begin <= shared.CHUNK_BYTES:
            yield first, last - first, Words(data[begin:end], offsets[first : last + 1] - begin), 0
            continue
        fresh, stop = 0, begin
        while stop < end:
            # a part ends where a word does, and goes on beyond the part before
            stop = max(begin + shared.CHUNK_BYTES, stop + 1)
            while stop < end and _IS_WORD[data[stop]]:
                gap = np.flatnonzero(~_IS_WORD[data[stop : stop + shared.CHUNK_BYTES]])
                stop = stop + int(gap[0]) if len(gap) else stop + shared.CHUNK_BYTES
            stop = min(stop, end)
            words = Words(data[begin:stop], np.array([0, stop - begin]))
            yield first, 1, words, fresh
            kept = min(high - 1, len(words.starts))
            begin, fresh = (begin + int(words.starts[-kept]) if kept else stop), kept


def _counted(batches: Iterator[pa.RecordBatch], low: int, high: int, buckets: int) -> Iterator[pa.RecordBatch]:
    totals = np.zeros(buckets, np.int64)
    for batch in batches:
        for _, _, words, fresh in _parts(*text_bytes(batch.column(0)), high):
            for n in range(low, high + 1):
                totals += np.bincount(words.features(n, buckets, fresh)[1], minlength=buckets)
    found = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(totals[found])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, low: int = 1, high: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features per bucket over all texts; a task hands on at most one row per bucket."""
    counted = in_tasks(texts.select("text"), partial(_counted, low=low, high=high, buckets=buckets), "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket, from the ``bucket_counts`` of both."""
    spark = documents.sparkSession
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    s = documents.select("bucket", F.col("n").alias("s"))
    t = target.select("bucket", F.col("n").alias("t"))
    both = every.join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0, ["s", "t"])
    all_s, all_t = both.agg(F.sum("s"), F.sum("t")).first()
    real = {c: F.col(c).cast("double") for c in ("s", "t")}
    ratio = (real["t"] + 1) * F.lit(float(all_s + buckets)) / ((real["s"] + 1) * F.lit(float(all_t + buckets)))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def _weighed(batches: Iterator[pa.RecordBatch], low: int, high: int, gain: Broadcast) -> Iterator[pa.RecordBatch]:
    of = np.frombuffer(gain.value, np.int64)
    for batch in batches:
        counts = np.zeros((3, batch.num_rows), np.int64)
        for first, rows, words, fresh in _parts(*text_bytes(batch.column(1)), high):
            here = counts[:, first : first + rows]
            here[0] += np.bincount(words.owner[fresh:], minlength=rows)
            for n in range(low, high + 1):
                owner, bucket = words.features(n, len(of), fresh)
                here[1] += np.bincount(owner, minlength=rows)
                sums = np.concatenate([[0], np.cumsum(of[bucket])])
                cuts = np.searchsorted(owner, np.arange(rows + 1))
                here[2] += sums[cuts[1:]] - sums[cuts[:-1]]
        names = ["doc_id", "tie", "n_words", "n_features", "weight"]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *map(pa.array, counts)], names=names)


def noise(doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of sha256 of ``<seed>:<doc_id>``."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    low: int = 1,
    high: int = 1,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) per row; rank counts the drawn ones from 1, others have null.

    Of the documents with ``least_words`` words, ``percent`` in a hundred (rounded down) are drawn.
    """
    if not 1 <= low <= high:
        raise ValueError("runs of words have at least one word")
    spark = docs.sparkSession
    counts = [stored(bucket_counts(texts, low, high, buckets)) for texts in (docs, target)]
    rows = sorted(map(tuple, gains(*counts, buckets).collect()))  # one per bucket
    gain = spark.sparkContext.broadcast(np.array([g for _, g in rows], np.int64).tobytes())
    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = in_tasks(
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie")),
        partial(_weighed, low=low, high=high, gain=gain),
        f"doc_id {kind}, tie long, n_words long, n_features long, weight long",
    )
    weighed = stored(weighed.withColumn("score", F.col("weight") + noise(seed=seed)))
    eligible = F.col("n_words") >= least_words
    drawn = weighed.where(eligible).count() * percent // 100
    placed = ranked(weighed, [eligible.desc(), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("tie")])
    rank = F.when(F.col("rank") < drawn, F.col("rank") + 1)
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


#: The query as SQL: CRC-32 byte by byte from its polynomial, distinct words only.
ORACLE = rf"""
WITH crc_table AS (
    SELECT list(c ORDER BY b) AS steps
    FROM (
        SELECT b, list_reduce(list_concat([b], range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {POLYNOMIAL}) ELSE c >> 1 END) AS c
        FROM range(256) t(b)
    )
),
lines AS (
    SELECT row_number() OVER () AS line, 0 AS side, doc_id, text FROM documents
    UNION ALL SELECT row_number() OVER (), 1, NULL, text FROM benchmark
),
cut AS (
    SELECT line, side, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM lines
),
tokens AS (SELECT side, line, unnest(words) AS word FROM cut),
vocabulary AS (
    SELECT word, hex(word) AS digits FROM (SELECT DISTINCT word FROM tokens)
),
hashed AS (
    SELECT word, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(range(0, length(digits) // 2), lambda i:
            (strpos('0123456789ABCDEF', digits[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', digits[2 * i + 2]) - 1)),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) % {BUCKETS} AS bucket
    FROM vocabulary, crc_table
),
counted AS (
    SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t
    FROM tokens JOIN hashed USING (word) GROUP BY bucket
),
gain AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counted) + {BUCKETS})::DOUBLE
        / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counted) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
    FROM counted
),
sums AS (
    SELECT line, sum(gain)::BIGINT AS weight
    FROM tokens JOIN hashed USING (word) JOIN gain USING (bucket) WHERE side = 0 GROUP BY line
),
scored AS (
    SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln(
            (('0x' || sha256('{SEED}:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM cut LEFT JOIN sums USING (line) WHERE side = 0
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place FROM scored
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
    CASE WHEN n_features >= {LEAST_WORDS}
        AND place <= (SELECT count(*) FROM scored WHERE n_features >= {LEAST_WORDS}) * {PERCENT} // 100 THEN place END AS rank
FROM placed
"""
