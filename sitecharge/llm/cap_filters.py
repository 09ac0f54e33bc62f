"""Embedding near-dedup by spherical-cap filters with structured random product codes.

Vectors are turned by a fixed random rotation and split into two halves; a filter's direction joins one code
word of each half, so with B words a half there are B * B directions, and the inner product with a
direction is a sum of two entries. A vector passes the filters whose direction it exceeds a threshold in;
sorting one half's entries lists them without trying all directions (list decoding). Vectors are
joined on filters, and pairs are verified by cosine in double precision, block by block in the tasks: a pair counts in the
first filter that both pass, a block hands on a count per vector and the edges of a spanning forest, never
its pairs. The share of vectors that pass a filter is set from their number, the number of filters from
the chance that vectors at the threshold pass one together (``recall``).

Equal vectors form one class with a weight before that. Vectors that are null, empty, zero, or hold null or
not finite components link with nothing, and only vectors of equal length are compared. Rows with a null vec_id link with
nothing either (component_id null, kept). Rows with equal vec_id and unequal vectors are vectors of their
own. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecharge.llm.shared import components, cuts_of, in_tasks, ranked, stored, whole_blocks

COSINE = 0.95
#: Expected misses of a pair at the threshold: exp(-MEETINGS).
MEETINGS = 10.0
#: A vector that exceeds the threshold in fewer directions passes the filters of this many best ones.
FEWEST = 16
#: Vectors that pass a filter, on average, and at most in one block.
BUCKET = 256
BLOCK_ROWS = 512
#: Bytes of vectors in whole blocks that a task compares at a time.
_HELD = 4 << 20
_SEED = 11


def design(n: int, cosine: float) -> tuple[float, int]:
    """(quantile of a vector's entry in a direction, code words per half) for n vectors."""
    normal = NormalDist()
    share = min(0.25, BUCKET / max(1, n))
    z = normal.inv_cdf(1 - share)
    # of a pair at the threshold, one vector passes; the other does with this chance
    typical = normal.pdf(z) / share  # mean entry of those that pass
    together = normal.cdf((cosine * typical - z) / math.sqrt(1 - cosine**2))
    filters = MEETINGS / max(0.05, together)
    return z, math.ceil(math.sqrt(filters / share))


def _codes(d: int, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rotation, and the code words of both halves."""
    random = np.random.default_rng([_SEED, d])
    rotation = np.linalg.qr(random.standard_normal((d, d)))[0]
    half = (d + 1) // 2
    halves = []
    for size in (half, d - half):
        code = random.standard_normal((words, max(1, size)))[:, :size]
        halves.append(code / np.maximum(np.linalg.norm(code, axis=1, keepdims=True), 1e-12))
    return rotation, halves[0], halves[1]


def units(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def passed(vectors: np.ndarray, z: float, words: int) -> list[np.ndarray]:
    """The filters that each unit vector passes, in order."""
    d = vectors.shape[1]
    rotation, one, two = _codes(d, words)
    half = one.shape[1]
    turned = vectors @ rotation
    first, second = turned[:, :half] @ one.T, turned[:, half:] @ two.T
    # a direction has length sqrt(2) before it is scaled
    least = z / math.sqrt(d) * math.sqrt(2)
    order = np.argsort(-second, axis=1)
    out = []
    for a, b, by in zip(first, second, order):
        many = np.searchsorted(-b[by], a - least, "right")
        if many.sum() < FEWEST:
            # the best sums are among the best of both halves
            best = np.argsort(-a)[:FEWEST]
            sums = (a[best][:, None] + b[by[:FEWEST]][None, :]).ravel()
            take = np.argsort(-sums)[:FEWEST]
            width = len(by[:FEWEST])
            out.append(np.sort(best[take // width] * words + by[take % width]))
            continue
        held = np.flatnonzero(many)
        many = many[held]
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        out.append(np.sort(np.repeat(held, many) * words + by[at]))
    return out


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), offsets - offsets[0]


def _filtered(batches: Iterator[pa.RecordBatch], z: float, words: int) -> Iterator[pa.RecordBatch]:
    """(node, filters) of (node, vector)."""
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            flat, offsets = _lists(part.column(1))
            sizes = np.diff(offsets)
            for d in np.unique(sizes):
                rows = np.flatnonzero(sizes == d)
                lists = passed(units(flat[offsets[rows][:, None] + np.arange(d)]), z, words)
                ends = np.cumsum([0, *map(len, lists)])
                filters = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists), pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), filters], names=["node", "filters"])


def _labels(links: np.ndarray, ids: np.ndarray, others: np.ndarray) -> list[tuple[int, int]]:
    """Edges (id, least id) that connect what a matrix of links connects."""
    big = np.iinfo(np.int64).max
    a, b = ids.copy(), others.copy()
    while True:
        least = np.minimum(a, np.where(links, b[None, :], big).min(axis=1, initial=big))
        other = np.minimum(b, np.where(links, least[:, None], big).min(axis=0, initial=big))
        if (least == a).all() and (other == b).all():
            break
        a, b = least, other
    return [(int(x), int(y)) for x, y in zip(np.append(ids, others), np.append(a, b)) if x != y]


def _compared(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """(a, b, links): an edge, or with b null the weight of the vectors linked with a.

    Batches have (block, side, filter, node, weight, vector, filters) in order of block; side 0 meets
    side 1, side 2 meets all.
    """
    for rows in whole_blocks(batches, _HELD):
        block, side, own, node, weight = (rows.column(i).to_numpy() for i in range(5))
        flat, offsets = _lists(rows.column(5).combine_chunks())
        listed = rows.column(6).combine_chunks()
        passing, at = listed.flatten().to_numpy(), listed.offsets.to_numpy()
        at = at - at[0]
        edges, counts = [], []
        cuts = cuts_of(block)
        for first, last in zip(cuts[:-1], cuts[1:]):
            for d in np.unique(np.diff(offsets)[first:last]):
                here = first + np.flatnonzero(np.diff(offsets)[first:last] == d)
                vectors = units(flat[(offsets[here][:, None] + np.arange(d))])
                left, right = np.flatnonzero(side[here] != 1), np.flatnonzero(side[here] != 0)
                if not len(left) or not len(right):
                    continue
                links = vectors[left] @ vectors[right].T >= cosine
                links &= node[here][left][:, None] != node[here][right][None, :]
                left, links = left[links.any(axis=1)], links[links.any(axis=1)]
                right, links = right[links.any(axis=0)], links[:, links.any(axis=0)]
                if not links.size:
                    continue
                # filters before this one that both pass
                rows_of = [here[left], here[right]]
                earlier = [[passing[at[r] : at[r + 1]] for r in which] for which in rows_of]
                earlier = [[f[: np.searchsorted(f, own[first])] for f in which] for which in earlier]
                known = np.unique(np.concatenate(earlier[0] + earlier[1]))
                held = []
                for which in earlier:
                    marks = np.zeros((len(which), len(known)), np.float32)
                    for i, f in enumerate(which):
                        marks[i, np.searchsorted(known, f)] = 1
                    held.append(marks)
                links &= held[0] @ held[1].T == 0
                if not links.any():
                    continue
                one, two = node[rows_of[0]], node[rows_of[1]]
                edges += _labels(links, one, two)
                counts += zip(one.tolist(), (links @ weight[rows_of[1]]).tolist())
                if side[here[0]] != 2:
                    counts += zip(two.tolist(), (weight[rows_of[0]] @ links).tolist())
        a = pa.array([e[0] for e in edges] + [c[0] for c in counts], pa.int64())
        b = pa.array([e[1] for e in edges] + [None] * len(counts), pa.int64())
        links = pa.array([None] * len(edges) + [int(c[1]) for c in counts], pa.int64())
        yield pa.RecordBatch.from_arrays([a, b, links], names=["a", "b", "links"])


def near_vectors(embeddings: DataFrame, cosine: float = COSINE, column: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row."""
    vector = F.col(column).cast("array<double>")
    sound = F.col("vec_id").isNotNull() & (F.size(vector) > 0)
    sound &= F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = embeddings.select(
        "vec_id", F.coalesce(sound, F.lit(False)).alias("sound"), F.xxhash64(column).alias("d1"), F.hash(column).alias("d2"), F.col(column).alias("vector")
    )
    classes = rows.where("sound").groupBy("d1", "d2").agg(F.min(F.struct("vec_id", "vector")).alias("s"), F.count("*").alias("weight"))
    classes = classes.select("d1", "d2", "s.vec_id", "s.vector", "weight")
    classes = stored(ranked(classes, [F.col("d1"), F.col("d2")], "node"))
    z, words = design(classes.count(), cosine)

    vectors = classes.select("node", "weight", "vector")
    passing = in_tasks(vectors.drop("weight"), partial(_filtered, z=z, words=words), "node long, filters array<long>")
    passing = stored(passing)
    each = passing.select("node", F.explode("filters").alias("filter"))
    parts = each.groupBy("filter").agg(F.count("*").alias("n")).where("n > 1")
    parts = parts.select("filter", F.ceil(F.col("n") / BLOCK_ROWS).alias("parts"))
    placed = each.join(parts, "filter").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    blocks = placed.select(
        F.xxhash64("filter", F.least("part", "other"), F.greatest("part", "other")).alias("block"),
        F.when(F.col("part") == F.col("other"), 2).when(F.col("part") < F.col("other"), 0).otherwise(1).alias("side"),
        "filter", "node",
    )
    blocks = blocks.join(vectors, "node").join(passing, "node").select("block", "side", "filter", "node", "weight", "vector", "filters")
    dealt = blocks.repartition("block").sortWithinPartitions("block", "filter")
    found = stored(in_tasks(dealt, partial(_compared, cosine=cosine), "a long, b long, links long"))

    links = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    label = components(found.where("b IS NOT NULL").select("a", "b"))
    named = classes.select("node", "vec_id", "weight", "d1", "d2").join(label, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    named = named.join(least, "component").join(links, named["node"] == links["a"], "left")
    named = named.select("d1", "d2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = rows.drop("vector").join(named.withColumn("sound", F.lit(True)), ["d1", "d2", "sound"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
