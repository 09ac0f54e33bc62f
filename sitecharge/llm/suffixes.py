"""Suffix-array dedup: bytes of texts that lie in a string of ``length`` bytes which starts elsewhere too.

Every window of ``length`` bytes has an anchor, the leftmost of its 32-byte grams with the least hash, so
equal windows have equal anchors and windows can be sharded by anchor. Windows in a row that share an anchor make
a run; the bytes of a run are its segment. Only anchors that occur more than once go on, and equal
segments of an anchor are counted and kept once. Shards are packs of whole anchors of a few MB (an
anchor with more than that is spread over several shards). In each shard a suffix array over the
segments is built by Larsson-Sadakane refinement, prefixes common to neighbours come from Kasai's scan (all
segments in step), and windows with ``length`` bytes in common with a neighbour repeat. Shards of one
anchor are merged by binary search of one's windows in the other's array.

Texts are bytes in UTF-8; null counts as empty, and texts shorter than ``length`` have no windows. Matches
never cross documents. All strings are judged on the input: every occurrence goes, the first one too.
Rows keep their doc_id whatever it is; equal rows are returned as often as they occur; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitecharge.llm.shared import CHUNK_BYTES, Rolling, cuts_of, in_tasks, mixed, slices, stored, text_bytes, whole_blocks

LENGTH = 400
GRAM = 32
#: Bytes of segments in a shard, about.
SHARD_BYTES = 2 << 20
#: Windows of a run at most; what is longer continues in another run.
RUN = 1024

_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    out, done = values, 1
    while 2 * done <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    return np.minimum(out[: len(out) - (width - done)], out[width - done :]) if done < width else out


def _runs_of(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of several texts: (text, start, windows, anchor, content, whether two grams of the run tie)."""
    width = length - gram + 1
    rolling = Rolling(data)
    grams = mixed((rolling.sums[gram:] - rolling.sums[:-gram]) * Rolling._inverses[: len(data) - gram + 1])
    low = np.uint64((1 << max(1, (len(grams) - 1).bit_length())) - 1)
    least = _least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), width)
    place = (least & low).astype(np.int64)  # the leftmost least gram of each window
    anchor = grams[place]
    text = np.searchsorted(offsets, np.arange(len(place)), "right") - 1
    change = np.ones(len(place), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(change)
    sizes = np.diff(np.append(starts, len(place)))
    if sizes.max(initial=0) > RUN:  # continue long runs
        pieces = -(-sizes // RUN)
        first = np.repeat(starts, pieces)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = first + nth * RUN
    ends = np.append(starts[1:], len(place))
    ends = np.minimum(ends, offsets[text[starts] + 1] - length + 1)
    real = ends > starts
    starts, ends = starts[real], ends[real]
    ties = place[starts] != place[ends - 1]
    owner = text[starts]
    return owner, starts - offsets[owner], ends - starts, anchor[starts], rolling.of(starts, ends + length - 1), ties


def _runs(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_id", "start", "windows", "anchor", "content", "ties"]
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        for first, last in slices(offsets):
            # a long text is cut into overlapping parts, each with windows of its own
            step = CHUNK_BYTES if last - first == 1 else 1 << 62
            begin = int(offsets[first])
            while begin + length <= offsets[last]:
                end = min(int(offsets[last]), begin + step + length - 1)
                cuts = np.clip(offsets[first : last + 1], begin, end) - begin
                owner, start, windows, anchor, content, ties = _runs_of(data[begin:end], cuts, length, gram)
                rows = pa.array(first + owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(start + (begin - int(offsets[first])), pa.int64()),
                        pa.array(windows, pa.int32()),
                        pa.array(anchor.view(np.int64)),
                        pa.array(content.view(np.int64)),
                        pa.array(ties),
                    ],
                    names=names,
                )
                begin += step


class SuffixArray:
    """Over segments one after another; each ends with a mark of its own, below all bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        lengths = np.diff(offsets)
        self.data, self.offsets = data, offsets
        self.ends = np.repeat(offsets[1:], lengths)
        rest = self.ends - np.arange(n)
        padded = np.append(data, np.zeros(8, np.uint8)).astype(np.uint64)
        words = np.zeros(n, np.uint64)
        for i in range(8):
            words = (words << np.uint64(8)) | np.where(rest > i, padded[i : n + i], np.uint64(0))
        self.words = words
        self.order, self.rank = self._sorted(words, rest, int(lengths.max(initial=0)))

    def _sorted(self, words: np.ndarray, rest: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(words)
        short = np.minimum(rest, 8)
        # a text that ends stands before one that goes on with zero bytes
        order = np.lexsort((short, words)) if (self.data == 0).any() else np.argsort(words)
        new = np.ones(n, bool)
        new[1:] = (words[order][1:] != words[order][:-1]) | (short[order][1:] != short[order][:-1])
        head = np.flatnonzero(new)
        rank = np.empty(n, np.int64)
        rank[order] = np.repeat(head, np.diff(np.append(head, n)))
        h = 8
        while h < longest:
            # the slots of groups that are not yet single
            sizes = np.diff(np.append(head, n))
            slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
            if not len(slots):
                break
            places = order[slots]
            ahead = places + h
            inside = ahead < self.ends[places]
            after = np.zeros(len(places), np.int64)
            after[inside] = rank[ahead[inside]] + 1
            keys = (rank[places] << 32) | after
            moved = np.argsort(keys)
            keys, places = keys[moved], places[moved]
            order[slots] = places
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            fresh = slots[new]
            rank[places] = np.repeat(fresh, np.diff(np.append(np.flatnonzero(new), len(keys))))
            mark = np.zeros(n, bool)
            mark[head] = True
            mark[fresh] = True
            head = np.flatnonzero(mark)
            h *= 2
        # equal suffixes end at marks of their own, which follow the order of the segments
        sizes = np.diff(np.append(head, n))
        slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
        places = order[slots]
        order[slots] = places[np.lexsort((places, rank[places]))]
        rank[order] = np.arange(n)
        return order, rank

    def _extended(self, a: np.ndarray, b: np.ndarray, b_words, b_ends, common: np.ndarray, most: int) -> np.ndarray:
        """Bytes that suffixes a of this and b of another array share, of which ``common`` are known."""
        limit = np.minimum(np.minimum(self.ends[a] - a, b_ends[b] - b), most)
        common = np.minimum(common, limit)
        live = np.flatnonzero(common < limit)
        while len(live):
            at = common[live]
            x = self.words[a[live] + at] ^ b_words[b[live] + at]
            equal = np.where(x == 0, 8, 0)
            apart = np.flatnonzero(x)
            if len(apart):
                equal[apart] = np.searchsorted(_TOPS, x[apart], "right") - 1
                equal[apart] = 7 - equal[apart]
            common[live] = np.minimum(at + equal, limit[live])
            live = live[(equal == 8) & (common[live] < limit[live])]
        return common

    def repeats(self, windows: np.ndarray, length: int) -> np.ndarray:
        """Marks the first ``windows`` positions of each segment that share ``length`` bytes with another position."""
        out = np.zeros(len(self.data), bool)
        starts = self.offsets[:-1]
        order = np.argsort(-windows, kind="stable")
        known = np.zeros(len(starts), np.int64)
        for t in range(int(windows.max(initial=0))):
            order = order[: int(np.searchsorted(-windows[order], -t, "left"))]
            place = starts[order] + t
            slot = self.rank[place]
            before = self.order[slot - 1]  # slot 0 has none; what it meets is set right below
            common = np.maximum(known[order] - 1, 0)
            common[slot == 0] = 0
            common = self._extended(place, before, self.words, self.ends, common, 1 << 40)
            common[slot == 0] = 0
            known[order] = common
            same = common >= length
            out[place[same]] = True
            out[before[same]] = True
        return out

    def found(self, other: SuffixArray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Binary search of windows of ``other``: which share ``length`` bytes with a suffix, and that suffix."""
        low, high = np.zeros(len(places), np.int64), np.full(len(places), len(self.order))
        hit = np.full(len(places), -1)
        while len(live := np.flatnonzero((low < high) & (hit < 0))):
            middle = (low[live] + high[live]) // 2
            mine, theirs = self.order[middle], places[live]
            common = self._extended(mine, theirs, other.words, other.ends, np.zeros(len(live), np.int64), length)
            full = common >= length
            hit[live[full]] = mine[full]
            ended = mine + common >= self.ends[mine]
            x = self.data[np.minimum(mine + common, len(self.data) - 1)].astype(np.int64)
            x[ended] = -1
            y = other.data[np.minimum(theirs + common, len(other.data) - 1)]
            less = x < y
            low[live[less]] = middle[less] + 1
            high[live[~less]] = middle[~less]
        return hit >= 0, hit


#: Least 64-bit words with 1 to 8 bytes that are not zero at the front.
_TOPS = np.array([1 << (8 * i) for i in range(8)], np.uint64)


def _intervals(marks: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of marks within segments: (segment, from, to)."""
    edge = np.zeros(len(marks) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], marks[:-1]]) & ~edge[:-1]
    after = np.concatenate([marks[1:], [False]]) & ~edge[1:]
    starts, ends = np.flatnonzero(marks & ~before), np.flatnonzero(marks & ~after) + 1
    owner = np.searchsorted(offsets, starts, "right") - 1
    return owner, starts - offsets[owner], ends - offsets[owner]


def _shard(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeats in batches of (block, side, anchor, content, windows, segment) in order of block.

    Whole blocks are packed into shards; a block with sides 0 and 1 holds two shards to merge.
    """
    names = ["anchor", "content", "low", "high"]

    def out(rows: pa.Table, marks: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        owner, low, high = _intervals(marks, offsets)
        owner = pa.array(owner)
        columns = [rows.column("anchor").take(owner).combine_chunks(), rows.column("content").take(owner).combine_chunks()]
        return pa.RecordBatch.from_arrays([*columns, pa.array(low, pa.int32()), pa.array(high, pa.int32())], names=names)

    def array(rows: pa.Table) -> tuple[SuffixArray, np.ndarray, np.ndarray]:
        column = rows.column("segment").combine_chunks().cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        return SuffixArray(data, offsets - offsets[0]), rows.column("windows").to_numpy().astype(np.int64), offsets - offsets[0]

    def repeats(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        side = rows.column("side").to_numpy()
        alone = rows.filter(pa.array(side == 2))
        if len(alone):
            suffixes, windows, offsets = array(alone)
            yield out(alone, suffixes.repeats(windows, length), offsets)
        pairs = rows.filter(pa.array(side != 2))
        block = pairs.column("block").to_numpy()
        cuts = cuts_of(block)
        for a, b in zip(cuts[:-1], cuts[1:]):
            whole = pairs.slice(a, b - a)
            side = whole.column("side").to_numpy()
            left, right = whole.filter(pa.array(side == 0)), whole.filter(pa.array(side == 1))
            if not len(left) or not len(right):
                continue
            one, _, one_offsets = array(left)
            two, windows, offsets = array(right)
            places = np.repeat(offsets[:-1], windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
            same, hit = one.found(two, places, length)
            marks = np.zeros(len(two.data), bool)
            marks[places[same]] = True
            yield out(right, marks, offsets)
            marks = np.zeros(len(one.data), bool)
            marks[hit[same]] = True
            yield out(left, marks, one_offsets)

    for rows in whole_blocks(batches, SHARD_BYTES):
        yield from repeats(rows)


def _cut(batches: Iterator[pa.RecordBatch], whole_characters: bool) -> Iterator[pa.RecordBatch]:
    """(text_id, kept) of (text_id, text, spans): the bytes that stay."""
    for batch in batches:
        for first, last in slices(text_bytes(batch.column(1))[1]):
            part = batch.slice(first, last - first)
            kept = []
            for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                data = text.encode()
                out, at = [], 0
                for span in spans:
                    low, high = span["low"], span["high"]
                    if whole_characters:  # a character that is cut stays
                        while low < high and data[low] & 0xC0 == 0x80:
                            low += 1
                        while low < high < len(data) and data[high] & 0xC0 == 0x80:
                            high -= 1
                    out.append(data[at:low])
                    at = high
                kept.append(b"".join([*out, data[at:]]))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(kept, pa.binary())], names=["text_id", "kept"])


def text_id() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def _united(spans: DataFrame) -> DataFrame:
    """(text_id, spans, n_removed, n_spans) of overlapping (text_id, low, high)."""
    order = Window.partitionBy("text_id").orderBy("low", "high")
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("new", F.coalesce(F.col("low") > reach, F.lit(True)).cast("int"))
    whole = opened.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    islands = whole.groupBy("text_id", "island").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return islands.groupBy("text_id").agg(
        F.array_sort(F.collect_list(F.struct("low", "high"))).alias("spans"),
        F.sum(F.col("high") - F.col("low")).alias("n_removed"),
        F.count("*").alias("n_spans"),
    )


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(text_id, spans, n_removed, n_spans) of texts with repeated bytes, and (text_id, text) of all texts that may have some.

    Spans are sorted, do not touch, and count bytes; a text may stand in the second table more than
    once if whole rows are repeated.
    """
    texts = docs.select("doc_id", text_id().alias("text_id"), "text").where(F.octet_length("text") >= length)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_id binary, start long, windows int, anchor long, content long, ties boolean"
    runs = stored(in_tasks(texts, partial(_runs, length=length, gram=gram), schema))
    again = runs.groupBy("anchor").agg(F.count("*").alias("times"), F.max("ties").alias("ties")).where("times > 1 OR ties")
    runs = stored(runs.join(again.select("anchor"), "anchor", "left_semi"))

    contents = runs.groupBy("anchor", "content", "windows").agg(
        F.count("*").alias("times"), F.max("ties").alias("ties"), F.min(F.struct("text_id", "start")).alias("at")
    )
    contents = stored(contents)
    anchors = contents.groupBy("anchor").agg(
        F.count("*").alias("contents"),
        F.min("times").alias("times"),
        F.max("ties").alias("ties"),
        F.ceil(F.sum(F.col("windows") + (length - 1)) / SHARD_BYTES).alias("parts"),
    )
    # where every segment occurs twice as it is, all its windows are known to repeat
    open_anchors = anchors.where("times = 1 AND (contents > 1 OR ties)").select("anchor", "parts")
    wanted = contents.join(open_anchors, "anchor").groupBy("at.text_id")
    wanted = wanted.agg(F.collect_list(F.struct("anchor", "content", "windows", "parts", F.col("at.start").alias("start"))).alias("segments"))
    named = runs.groupBy("text_id").agg(F.min("doc_id").alias("doc_id")).join(wanted, "text_id", "left")
    same = (F.col("n.text_id") == F.col("t.text_id")) & F.col("n.doc_id").eqNullSafe(F.col("t.doc_id"))
    held = stored(texts.alias("t").join(named.alias("n"), same).select("t.text_id", "text", "segments"))

    each = held.select(F.col("text").cast("binary").alias("data"), F.explode("segments").alias("s"))
    each = each.select(
        "s.anchor",
        "s.content",
        "s.windows",
        F.pmod("s.content", "s.parts").alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("s.parts") - 1)).alias("other"),
        F.expr(f"substring(data, cast(s.start + 1 as int), s.windows + {length - 1})").alias("segment"),
    )
    blocks = each.select(
        F.xxhash64("anchor", F.least("part", "other"), F.greatest("part", "other")).alias("block"),
        F.when(F.col("part") == F.col("other"), 2).when(F.col("part") < F.col("other"), 0).otherwise(1).alias("side"),
        "anchor",
        "content",
        "windows",
        "segment",
    )
    dealt = blocks.repartition("block").sortWithinPartitions("block")
    merged = in_tasks(dealt, partial(_shard, length=length), "anchor long, content long, low int, high int")

    whole = contents.where("times > 1").select("anchor", "content", F.lit(0).alias("low"), F.col("windows").alias("high"))
    single = contents.where("times = 1").select("anchor", "content")
    repeated = whole.unionByName(merged.join(single, ["anchor", "content"], "left_semi").distinct())
    spans = runs.select("text_id", "start", "anchor", "content").distinct().join(repeated, ["anchor", "content"])
    high = F.col("start") + F.col("high") + (length - 1)
    spans = spans.select("text_id", (F.col("start") + F.col("low")).alias("low"), high.alias("high")).distinct()
    return stored(_united(spans)), held.select("text_id", "text")


def kept_bytes(spans: DataFrame, held: DataFrame, whole_characters: bool = False) -> DataFrame:
    """(text_id, kept) of the texts of which a part is removed, from what ``repeated_bytes`` gave.

    ``whole_characters`` leaves a character of which only some bytes repeat.
    """
    partly = held.join(spans, "text_id").where(F.col("n_removed") < F.octet_length("text")).select("text_id", "text", "spans")
    kept = in_tasks(partly, partial(_cut, whole_characters=whole_characters), "text_id binary, kept binary")
    return kept


def removals(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256) per row."""
    spans, held = repeated_bytes(docs, length, gram)
    kept = kept_bytes(spans, held).select("text_id", F.sha2("kept", 256).alias("kept_sha256"))
    kept = kept.groupBy("text_id").agg(F.min("kept_sha256").alias("kept_sha256"))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", text_id().alias("text_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha256")
    )
    found = spans.join(kept, "text_id", "left")
    rows = rows.join(found, "text_id", "left")
    removed = F.coalesce("n_removed", F.lit(0).cast("long"))
    return rows.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        "spans",
        F.when(removed == 0, F.col("sha256"))
        .when(removed == F.col("n_bytes"), F.lit(_EMPTY_SHA))
        .otherwise(F.col("kept_sha256"))
        .alias("kept_sha256"),
    )
