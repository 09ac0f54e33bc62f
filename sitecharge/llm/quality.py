"""Quality scores: random-indexing word vectors, pooled per document, and a small calibrated network.

A text is read as tokens: runs of letters, of digits, or of one symbol. Each token has a word (its hash,
lower-cased, in one of ``WORDS`` rows) and a shape (kind, length, case, whether it repeats the token before it,
whether the text has had it before). Every row has a fixed sparse random index vector, and a row's context
vector is the sum, over all documents, of the index vectors next to its tokens: whole numbers, so sums do not
depend on their order. The table's size is fixed, so it may travel to the driver and the tasks. A document's
features are the means of its words' and of its shapes' normalised vectors.

The network (one hidden layer) is fitted in numpy on at most ``FIT_ROWS`` labelled documents, chosen by hash;
its temperature is set on a part of them that it has not seen. Only labels of documents whose
crc32(doc_id as text) mod 5 is not 0 are used; labels, language, source and doc_id are no features.

Null texts count as empty; a text without tokens has features of zero and a score like any other. Rows with a
null doc_id are scored, not learnt from, and not held out. A document with labels 0 and 1 is learnt as 0; of several
rows with its doc_id one is learnt from, that of the lowest text hash.
Without labels of both kinds, every score is the smoothed share of ones. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecharge.llm.shared import Rolling, in_tasks, mixed, slices, text_bytes

WORDS = 1 << 14
DIMENSIONS = 32
#: Entries of an index vector that are not zero.
ONES = 4
#: Tokens on either side that a context takes in.
REACH = 2
FIT_ROWS = 20_000
HIDDEN = 24
THRESHOLD = 0.3
_SHAPES = 3 * 8 * 3 * 2 * 2
_SEED = 7

_KIND = np.full(256, 3, np.uint8)  # 0 space, 1 letters, 2 digits, 3 symbols
_KIND[[32, *range(9, 14)]] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_UPPER = np.zeros(256, np.int32)
_UPPER[65:91] = 1


def index_vectors() -> np.ndarray:
    """Sparse vectors of 1 and -1, a row per word and per shape."""
    random = np.random.default_rng(_SEED)
    out = np.zeros((WORDS + _SHAPES, DIMENSIONS), np.float32)
    at = random.random(out.shape).argsort(axis=1)[:, :ONES]
    np.put_along_axis(out, at, random.choice(np.array([-1, 1], np.float32), at.shape), axis=1)
    return out


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of the word and of the shape of every token, and where each text's tokens start."""
    kind = _KIND[data]
    new = np.ones(len(data), bool)
    new[1:] = (kind[1:] != kind[:-1]) | ((kind[1:] == 3) & (data[1:] != data[:-1]))
    new[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(data))
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    words = Rolling(_LOWER[data]).of(starts, ends)
    first = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    seen = np.ones(len(words), bool)
    seen[np.unique(mixed(words + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]] = False
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    capitals = upper[ends] - upper[starts]
    case = np.where(capitals == 0, 0, np.where(capitals == 1, 1, 2))
    shape = (kind[starts].astype(np.int64) - 1) * 8 + np.minimum(ends - starts, 8) - 1
    shape = ((shape * 3 + case) * 2 + again) * 2 + (seen & (ends - starts >= 4))
    return (words % np.uint64(WORDS)).astype(np.int64), WORDS + shape, first


def _each(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    data, offsets = text_bytes(column)
    for first, last in slices(offsets, 1 << 20):
        base = offsets[first]
        yield tokens(data[base : offsets[last]], offsets[first : last + 1] - base)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = index_vectors()
    sums = np.zeros(index.shape, np.float64)
    for batch in batches:
        for words, shapes, first in _each(batch.column(0)):
            n = len(words)
            if not n:
                continue
            own = index[words] + index[shapes]
            text = np.repeat(np.arange(len(first) - 1), np.diff(first))
            near = index[shapes]
            for step in range(1, min(REACH, n - 1) + 1):
                same = (text[step:] == text[:-step])[:, None]
                near[step:] += own[:-step] * same
                near[:-step] += own[step:] * same
            for rows in (words, shapes):
                order = np.argsort(rows, kind="stable")
                cuts = np.flatnonzero(np.diff(rows[order], prepend=-1))
                sums[rows[order][cuts]] += np.add.reduceat(near[order], cuts, axis=0)
    filled = np.flatnonzero(sums.any(axis=1))
    columns = [pa.array(filled, pa.int32()), *(pa.array(sums[filled, d]) for d in range(DIMENSIONS))]
    yield pa.RecordBatch.from_arrays(columns, names=["row", *(f"d{d}" for d in range(DIMENSIONS))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The normalised context vectors of all rows, from all documents; rows that no text has are zero."""
    schema = "row int, " + ", ".join(f"d{d} double" for d in range(DIMENSIONS))
    parts = in_tasks(docs.select("text"), _contexts, schema)
    sums = parts.groupBy("row").agg(*(F.sum(f"d{d}").alias(f"d{d}") for d in range(DIMENSIONS))).toPandas()
    out = np.zeros((WORDS + _SHAPES, DIMENSIONS), np.float32)
    values = sums.drop(columns="row").to_numpy(np.float64)
    out[sums["row"].to_numpy()] = values / np.maximum(np.linalg.norm(values, axis=1, keepdims=True), 1e-9)
    return out


def _pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Two means per text: of its words' vectors and of its shapes' vectors."""
    out = np.zeros((len(column), 2 * DIMENSIONS), np.float32)
    at = 0
    for words, shapes, first in _each(column):
        n = len(first) - 1
        full = np.flatnonzero(np.diff(first))
        if len(full):
            many = np.diff(first)[full][:, None]
            for k, rows in enumerate((words, shapes)):
                out[at + full, k * DIMENSIONS : (k + 1) * DIMENSIONS] = np.add.reduceat(vectors[rows], first[full], axis=0) / many
        at += n
    return out


@dataclass
class Network:
    """Standardised features, one hidden layer of tanh units, a logit, and its temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((features - self.mean) / self.scale) @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -50, 50)))


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by narrowing a range of its logarithm."""

    def loss(log_t: float) -> float:
        return float(np.mean(np.logaddexp(0, np.where(labels == 1, -1, 1) * logits / np.exp(log_t))))

    low, high = -2.0, 3.0
    for _ in range(40):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(features: np.ndarray, labels: np.ndarray, epochs: int = 60, batch: int = 128, rate: float = 3e-3, decay: float = 1e-4) -> Network:
    """Fits on four fifths of the rows with Adam, and sets the temperature on the rest."""
    d = features.shape[1]
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        zero = np.zeros(d, np.float32)
        return Network(zero, zero + 1, np.zeros((d, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    random = np.random.default_rng(_SEED)
    order = random.permutation(len(labels))
    rest, learn = order[: len(order) // 5], order[len(order) // 5 :]
    mean, scale = features[learn].mean(axis=0), features[learn].std(axis=0) + 1e-6
    x, y = ((features - mean) / scale).astype(np.float32), labels.astype(np.float32)
    values = [
        (random.standard_normal((d, HIDDEN)) / np.sqrt(d)).astype(np.float32),
        np.zeros(HIDDEN, np.float32),
        (random.standard_normal(HIDDEN) / np.sqrt(HIDDEN)).astype(np.float32),
        np.zeros(1, np.float32),
    ]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(epochs):
        random.shuffle(learn)
        for at in range(0, len(learn), batch):
            rows = learn[at : at + batch]
            hidden = np.tanh(x[rows] @ values[0] + values[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ values[2] + values[3][0], -50, 50))) - y[rows]) / len(rows)
            back = np.outer(error, values[2]) * (1 - hidden**2)
            gradients = [x[rows].T @ back, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
            step += 1
            for i, gradient in enumerate(gradients):
                gradient = gradient + decay * values[i]
                first[i] = 0.9 * first[i] + 0.1 * gradient
                second[i] = 0.999 * second[i] + 0.001 * gradient**2
                values[i] -= (rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    out = Network(mean, scale, values[0], values[1], values[2], float(values[3][0]))
    if len(rest) and len(set(labels[rest].tolist())) == 2:
        out.temperature = _temperature(out.logits(features[rest]), labels[rest])
    return out


def _features(batches: Iterator[pa.RecordBatch], vectors: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pooled = pa.array(list(_pooled(batch.column(0), vectors.value)), pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch.column(1), pooled], names=["quality", "features"])


def _scored(batches: Iterator[pa.RecordBatch], vectors: Broadcast, network: Network, at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = network.scores(_pooled(batch.column(at), vectors.value)).astype(np.float64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"])


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name`` between 0 and 1: how likely a document is of label 1."""
    vectors = docs.sparkSession.sparkContext.broadcast(word_vectors(docs))
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("_quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    named = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # one text per label, however many rows share its doc_id
    chosen = named.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.min("_quality").alias("_quality"))
    chosen = chosen.select("text", "_quality")
    rows = in_tasks(chosen, partial(_features, vectors=vectors), "quality int, features array<float>").toPandas()
    # the order in which rows arrive must not matter
    x = np.array(rows["features"].tolist(), np.float32).reshape(len(rows), 2 * DIMENSIONS)
    order = np.lexsort(x.T) if len(x) else np.zeros(0, int)
    network = fit(x[order], rows["quality"].to_numpy(np.int64)[order])
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    out = in_tasks(plain, partial(_scored, vectors=vectors, network=network, at=names.index("text")), f"{schema}, score double")
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), F.col("score").alias(name))


def judged(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row."""
    rows = scored(docs.select("doc_id", "text"), labels, fit_rows)
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
