"""MinHash near-dedup by fast similarity sketching, banding and exact verification.

A document's set holds its distinct shingles of ``words`` words (ASCII capitals lowered, words split at
ASCII white space); with fewer words, the whole sequence is its one shingle; without words it is empty
and links with nothing. Equal sets meet in one class first. A sketch throws every shingle into one of
its coordinates, round after round, and keeps the least (round, value) per coordinate; after as many
rounds as coordinates, round r throws all shingles into coordinate r, so every coordinate is filled.
Bands of coordinates give buckets.

Links are confirmed on full sets in two passes, so that no group is expanded into pairs: first every
class against the smallest class it shares a bucket with; then, in the buckets whose members are still
in different components, every pair of members from different components, block by block.

Null texts count as empty. Rows without doc_id link with nothing (component_id null, kept). Rows that
share a doc_id are one node, and each of their rows is returned. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecharge.llm.shared import Rolling, components, cuts_of, in_tasks, mixed, slices, stored, text_bytes, whole_blocks

WORDS = 5
BANDS = 21
ROWS = 6
#: Bytes of text that a block of documents to verify holds about.
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of every text, and where each text's words start."""
    letter = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = letter[:-1]
    starts = np.flatnonzero(letter & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = letter[1:]
    ends = np.flatnonzero(letter & (~after | edge[1:])) + 1
    return Rolling(_LOWER[data]).of(starts, ends), np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, words: int = WORDS) -> np.ndarray:
    """The distinct shingle hashes of one text's word hashes, sorted."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(words, n)
    k = np.uint64(0xC2B2AE3D27D4EB4F)
    out = np.full(n - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        out = out * k + hashes[i : n - width + 1 + i]
    return np.unique(mixed(out))


def sketch(items: np.ndarray, size: int) -> np.ndarray:
    """The fast similarity sketch of a non-empty set of 64-bit hashes."""
    out = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    step, low = np.uint64(0x9E3779B97F4A7C15), np.uint64(32)
    first = 0
    while first < size and (out == np.iinfo(np.uint64).max).any():
        # as many rounds at a time as usually fill what is empty
        rounds = min(size - first, max(1, int(size * (np.log(size) + 2) / len(items))), 1 + (1 << 20) // len(items))
        numbers = np.arange(first, first + rounds, dtype=np.uint64)
        thrown = mixed(items[None, :] + ((numbers + np.uint64(1)) * step)[:, None])
        bins = ((thrown >> low) * np.uint64(size)) >> low
        np.minimum.at(out, bins.ravel().astype(np.int64), ((numbers << low)[:, None] | (thrown & np.uint64(0xFFFFFFFF))).ravel())
        first += rounds
    for place in np.flatnonzero(out == np.iinfo(np.uint64).max):
        number = np.array([size + place], np.uint64)
        thrown = mixed(items + (number + np.uint64(1)) * step) & np.uint64(0xFFFFFFFF)
        out[place] = (number[0] << low) | thrown.min()
    return out


def band_hashes(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    grid = coordinates.reshape(bands, rows)
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        out = mixed(out * np.uint64(0xC2B2AE3D27D4EB4F) + grid[:, i])
    return out


def _sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The shingle set of each text, in order."""
    data, offsets = text_bytes(column)
    for first, last in slices(offsets):
        base = offsets[first]
        hashes, starts = word_hashes(data[base : offsets[last]], offsets[first : last + 1] - base)
        for i in range(last - first):
            yield shingles(hashes[starts[i] : starts[i + 1]], words)


def _sign(batches: Iterator[pa.RecordBatch], words: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        sizes, ones, twos = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        keys = np.zeros((n, bands), np.uint64)
        for i, items in enumerate(_sets(batch.column(1), words)):
            sizes[i] = len(items)
            if len(items):
                ones[i], twos[i] = items.sum(dtype=np.uint64), mixed(items ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
                keys[i] = band_hashes(sketch(items, bands * rows), bands, rows)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(0, n * bands + 1, bands), pa.int32()), pa.array(keys.view(np.int64).ravel())
        )
        columns = [batch.column(0), pa.array(sizes), pa.array(ones.view(np.int64)), pa.array(twos.view(np.int64)), lists]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "d1", "d2", "bands"])


def signatures(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands) per document; d1 and d2 tell equal sets."""
    return in_tasks(
        docs.select("doc_id", "text"),
        partial(_sign, words=words, bands=bands, rows=rows),
        "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>",
    )


def _block_links(ids, comps, sides, sets, threshold: float) -> list[tuple[int, int]]:
    """Links between members of different components; side 0 meets side 1, side 2 meets all.

    Members of the largest component need not meet each other, so one side at a time is compared with
    the other in the cheapest of three ways. A link between components that the block has joined
    already is left out.
    """
    full = [i for i, s in enumerate(sets) if len(s)]
    ids, comps, sides, sets = ids[full], comps[full], sides[full], [sets[i] for i in full]
    if len(full) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    label = np.unique(comps, return_inverse=True)[1]
    outside = label != np.bincount(label).argmax()
    mark = np.zeros(int(codes.max()) + 1, bool)
    found: list[tuple[int, int]] = []

    def meet(these: np.ndarray, those: np.ndarray) -> None:
        if not len(these) or not len(those):
            return
        held = np.concatenate([codes[starts[y] : starts[y + 1]] for y in those])
        cuts = np.concatenate([[0], np.cumsum(sizes[those])])[:-1]
        for x in these:
            apart = label[those] != label[x]
            if not apart.any():
                continue
            own = codes[starts[x] : starts[x + 1]]
            mark[own] = True
            common = np.add.reduceat(mark[held].astype(np.int32), cuts)
            mark[own] = False
            near = 100 * common >= threshold * (sizes[those] + sizes[x] - common)
            for y in those[near & apart]:
                if label[y] != label[x]:
                    found.append((int(ids[x]), int(ids[y])))
                    label[label == label[y]] = label[x]

    left, right = np.flatnonzero(sides != 1), np.flatnonzero(sides != 0)
    ways = [[(left, right)], [(right, left)], [(left[outside[left]], right), (right[outside[right]], left)]]
    if (sides == 2).any():
        ways = [[(left[outside[left]], right)]]
    for these, those in min(ways, key=lambda way: sum(len(x) * int(sizes[y].sum()) for x, y in way)):
        meet(these, those)
    return found


def _verify(batches: Iterator[pa.RecordBatch], words: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links in batches of (block, doc_id, comp, side, text) in order of block; a block may span batches."""

    def links(rows: pa.Table) -> pa.RecordBatch:
        block, ids, comps, sides = (rows.column(i).to_numpy() for i in range(4))
        sets = list(_sets(rows.column(4).combine_chunks(), words))
        cuts = cuts_of(block)
        found = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            found += _block_links(ids[a:b], comps[a:b], sides[a:b], sets[a:b], threshold)
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    for rows in whole_blocks(batches, BLOCK_BYTES):
        yield links(rows)


def _verified(blocks: DataFrame, words: int, threshold: float) -> DataFrame:
    """Links (a, b) found in blocks of (block, doc_id, comp, side, text)."""
    dealt = blocks.select("block", "doc_id", "comp", "side", "text").repartition("block").sortWithinPartitions("block")
    return in_tasks(dealt, partial(_verify, words=words, threshold=threshold), "a long, b long")


def near_duplicates(
    docs: DataFrame, threshold: float = 85, words: int = WORDS, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row; links have 100 * |A n B| >= threshold * |A u B|."""
    signed = stored(signatures(docs, words, bands, rows))
    named = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    key = ["n_shingles", "d1", "d2"]
    first = named.groupBy(*key).agg(F.min(F.struct("doc_id", "bands")).alias("s"))
    classes = stored(first.select(*key, F.col("s.doc_id").alias("rep"), F.col("s.bands").alias("bands")))

    # buckets of two classes and more
    rows_of = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = rows_of.groupBy("band", "key").agg(F.min("rep").alias("center"), F.count("*").alias("n")).where("n > 1")
    members = stored(rows_of.join(shared, ["band", "key"]).select("band", "key", "rep", "center"))

    # the texts of the classes that meet another; texts are moved by doc_id whatever the size of the other side
    met = members.select(F.col("rep").alias("doc_id")).distinct().hint("merge")
    texts = stored(docs.select("doc_id", "text").join(met, "doc_id", "left_semi"))

    # every class against the smallest one that it shares a bucket with
    star = members.where("rep > center").groupBy("rep").agg(F.min("center").alias("center"))
    length = texts.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("bytes"))
    star = stored(star.join(length, star["rep"] == length["doc_id"]).select("rep", "center", "bytes"))
    share = star.groupBy("center").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).alias("parts"))
    part = F.pmod(F.xxhash64("rep"), F.greatest(F.lit(1), F.col("parts")))
    others = star.join(share, "center").select(
        F.xxhash64("center", part).alias("block"), F.col("rep").alias("doc_id"), F.col("rep").alias("comp"), F.lit(1).alias("side")
    )
    centers = share.select("center", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(1), F.col("parts")) - 1)).alias("part"))
    centers = centers.select(
        F.xxhash64("center", "part").alias("block"), F.col("center").alias("doc_id"), F.col("center").alias("comp"), F.lit(0).alias("side")
    )
    blocks = others.unionByName(centers).hint("merge").join(texts, "doc_id")
    links = stored(_verified(blocks, words, threshold))
    label = components(links)

    # what still lies apart in a bucket
    apart = members.join(label, members["rep"] == label["node"], "left").select(
        "band", "key", "rep", F.coalesce("component", "rep").alias("comp")
    )
    buckets = (
        apart.groupBy("band", "key")
        .agg(
            F.min("comp").alias("low"),
            F.max("comp").alias("high"),
            F.count("*").alias("n"),
            F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("who"),
        )
        .where("low < high")
        .groupBy("n", "who")  # the same members in several bands are compared once
        .agg(F.min(F.struct("band", "key")).alias("bucket"))
        .select("bucket.band", "bucket.key")
    )
    apart = stored(apart.join(buckets, ["band", "key"]).join(length, apart["rep"] == length["doc_id"]).drop("doc_id"))
    parts = apart.groupBy("band", "key").agg(F.greatest(F.lit(1), F.ceil(F.sum("bytes") / BLOCK_BYTES)).alias("parts"))
    placed = apart.join(parts, ["band", "key"]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    blocks = placed.select(
        F.xxhash64("band", "key", F.least("part", "other"), F.greatest("part", "other")).alias("block"),
        F.col("rep").alias("doc_id"),
        "comp",
        F.when(F.col("part") == F.col("other"), 2).when(F.col("part") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    blocks = blocks.hint("merge").join(texts, "doc_id")
    more = stored(_verified(blocks, words, threshold))

    # rows of one doc_id are one node, whatever classes they are in
    several = named.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    classed = named.join(several, "doc_id", "left_semi").join(classes, key).select("doc_id", "rep")
    hub = classed.groupBy("doc_id").agg(F.min("rep").alias("hub"))
    own = classed.join(hub, "doc_id").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    label = components(links.unionByName(more).unionByName(own))

    found = classes.join(label, classes["rep"] == label["node"], "left")
    found = found.select(*key, F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("doc_id", *key).join(found, key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
