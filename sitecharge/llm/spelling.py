"""Spelling variants: words that differ by one letter put in, left out or exchanged, by k-d trees over letter counts.

A word is a point: how often it has each letter. One edit moves the point by an L1 distance of 1 (to the next
length) or 2 (one letter less, another one more), so near words are found by range searches, one per pair of
lengths, in k-d trees over the words of a length; boxes that more than one letter must leave or enter are pruned. What
is left is verified by the order of the letters.

The tree of a length is cut off at cells of some CELL_WORDS words; its upper part, which all tasks know, is made from a
sample (some SAMPLE_WORDS words, those of the lowest hashes) and has at most CELLS cells, whatever the corpus. It only decides where
words meet: every word is placed, and every word visits each cell that the range search can reach. Each cell is a
group of a task, with a tree of its own inside. Links are reduced in the task to a count and the
best partner per word.

Words are runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF); A-Z only are lower-cased. Null and empty texts have
none, texts of any length are read whole, repeated rows count again, extra columns are ignored, and an empty table gives
no words. Of partners that are equally frequent the first in code-point order is the best. A null doc_id is an empty name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecharge.llm.shared import CHUNK_BYTES, cuts_of, in_tasks, stored

LEAST_LETTERS = 7
LEAST_TIMES = 2
#: A form is that many times as frequent as its variant.
RATIO = 10
#: One word in that many loses a letter.
EVERY = 31

#: Words of a cell, about, and their letters.
CELL_WORDS = 30_000
CELL_BYTES = 2_000_000
#: Cells of all lengths at most, beside one for each length.
CELLS = 4096
SAMPLE_WORDS = 1 << 16
#: Words of a leaf of the tree inside a cell.
LEAF = 32
#: Distinct words that a task counts before it hands them on.
COUNTED_WORDS = 200_000
#: Bytes of letters that are compared at a time.
COMPARED = 1 << 23

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _counted(batches: Iterator[pa.RecordBatch], least: int, every: int) -> Iterator[pa.RecordBatch]:
    """(word, n) of (doc_id as text, text); words repeat between batches."""
    run = re.compile(rb"[a-z\xc0-\xff]{%d,}" % least)
    counts: Counter[bytes] = Counter()

    def handed() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def spelled(data: bytes, name: int) -> Iterator[bytes]:
        found = run.findall(data) if len(data) < CHUNK_BYTES else (m[0] for m in run.finditer(data))
        for word in found:
            h = crc32(word if word.isascii() else word.decode("latin-1").encode(), name)
            if every and h % every == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
                if len(word) < least:
                    continue
            yield word

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if text.is_valid:
                # whatever is no Latin letter ends a run, so it may become a question mark
                data = text.as_py().encode("latin-1", "replace").translate(_LOWER)
                counts.update(spelled(data, crc32(f"{doc_id or ''}:".encode())))
                if len(counts) >= COUNTED_WORDS:
                    yield handed()
                    counts.clear()
    if counts:
        yield handed()


def word_counts(docs: DataFrame, least: int = LEAST_LETTERS, times: int = LEAST_TIMES, every: int = EVERY) -> DataFrame:
    """(word, n) of the words of ``least`` letters that occur ``times`` times.

    Where ``every`` divides the CRC-32 of ``<doc_id>:<word>``, the occurrence loses the letter at that CRC modulo its length
    first; with 0, all words stay as they are.
    """
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    counted = in_tasks(texts, partial(_counted, least=least, every=every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


class Points:
    """Words of one length: letters, counts per letter, and 128 bits whose difference no L1 distance falls below."""

    def __init__(self, words: list[bytes], n: np.ndarray):
        self.n = n
        self.words = words
        size = len(words[0]) if words else 0
        self.letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), size)
        # a-z are 1 to 26 and U+00C0 on 32 to 95; counts above 255 stay there, which only shortens distances
        places = np.where(self.letters < 128, self.letters & 31, self.letters - 160).astype(np.int64)
        self.counts = np.zeros((len(words), 96), np.uint8)
        for first in range(0, len(words), 4096):
            part = places[first : first + 4096] + 96 * np.arange(min(4096, len(words) - first))[:, None]
            sums = np.bincount(part.ravel(), minlength=96 * len(part)).reshape(-1, 96)
            self.counts[first : first + 4096] = np.minimum(sums, 255)
        folded = sum(np.minimum(self.counts[:, i : i + 32], 4).astype(np.int64) for i in (0, 32, 64))
        folded = np.minimum(folded, 4)
        bits = (folded[:, :, None] > np.arange(4)).reshape(len(words), 128)
        self.bits = np.packbits(bits, axis=1).view(np.uint64)

    def __len__(self) -> int:
        return len(self.words)


class Tree:
    """A k-d tree over letter counts: inner nodes are (letter, most of the left side, left, right), leaves are numbers."""

    def __init__(self, counts: np.ndarray, leaf: int, depth: int = 64):
        self.leaves: list[np.ndarray] = []
        self.root = self._grown(counts, np.arange(len(counts)), leaf, depth)

    def _grown(self, counts: np.ndarray, rows: np.ndarray, leaf: int, depth: int):
        if depth and len(rows) > leaf:
            here = counts[rows]
            # the letter and count that halve best
            best = None
            for most in range(int(here.max(initial=0))):
                left = (here <= most).sum(0)
                letter = int(np.argmin(np.abs(2 * left - len(rows))))
                even = abs(2 * int(left[letter]) - len(rows))
                if best is None or even < best[0]:
                    best = (even, letter, most)
                if most >= 8:
                    break
            if best is not None and best[0] < len(rows):
                _, letter, most = best
                low = here[:, letter] <= most
                left = self._grown(counts, rows[low], leaf, depth - 1)
                return (letter, most, left, self._grown(counts, rows[~low], leaf, depth - 1))
        self.leaves.append(rows)
        return len(self.leaves) - 1

    def home(self, counts: np.ndarray) -> np.ndarray:
        """The leaf that each point belongs to."""
        out = np.zeros(len(counts), np.int64)
        todo = [(self.root, np.arange(len(counts)))]
        while todo:
            node, rows = todo.pop()
            if isinstance(node, int):
                out[rows] = node
            elif len(rows):
                letter, most, left, right = node
                low = counts[rows, letter] <= most
                todo += [(left, rows[low]), (right, rows[~low])]
        return out

    def reached(self, counts: np.ndarray, lose: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, points) with points that may come into the leaf's box when ``lose`` letters go and one comes."""
        values = counts.astype(np.int16)
        rows = np.arange(len(values))
        zero = np.zeros(len(values), np.int16)
        todo = [(self.root, rows, zero, zero, {})]
        while todo:
            node, rows, less, more, box = todo.pop()
            if not len(rows):
                continue
            if isinstance(node, int):
                yield node, rows
                continue
            letter, most, left, right = node
            low, high = box.get(letter, (0, 255))
            value = values[rows, letter]
            # how many of the letter have to go to reach the left side, or to come to reach the right one
            down = less + np.maximum(value - most, 0) - np.maximum(value - high, 0)
            up = more + np.maximum(most + 1 - value, 0) - np.maximum(low - value, 0)
            go = down <= lose
            todo.append((left, rows[go], down[go], more[go], box | {letter: (low, most)}))
            go = up <= 1
            todo.append((right, rows[go], less[go], up[go], box | {letter: (most + 1, high)}))


class Near:
    """Links between the words of one cell and visitors, with what a word needs of them."""

    def __init__(self, homes: Points):
        self.homes = homes
        self.tree = Tree(homes.counts, LEAF)

    def _verified(self, visitors: Points, pairs: list[tuple[np.ndarray, np.ndarray]], lose: int) -> tuple[np.ndarray, np.ndarray]:
        mine, theirs = (np.concatenate(x) for x in zip(*pairs))
        a, b = self.homes.letters[mine], visitors.letters[theirs]
        if lose:
            right = (a != b).sum(1) == 1
        else:  # the visitor is one letter shorter: equal in front of the letter that is put in, and behind it
            front = np.logical_and.accumulate(a[:, :-1] == b, axis=1)
            behind = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1)[:, ::-1]
            right = behind[:, 0] | front[:, -1] | (front[:, :-1] & behind[:, 1:]).any(1)
        return mine[right], theirs[right]

    def links(self, visitors: Points, lose: int) -> tuple[np.ndarray, np.ndarray]:
        """(home, visitor) of near words; ``lose`` is 1 for equal lengths, 0 for visitors one letter shorter."""
        most = 2 * COMPARED // max(1, self.homes.letters.shape[1])
        found, held, size = [], [], 0
        for leaf, rows in self.tree.reached(visitors.counts, lose):
            homes = self.tree.leaves[leaf]
            mine = self.homes.bits[homes]
            for first in range(0, len(rows), 1 << 14):
                part = rows[first : first + (1 << 14)]
                theirs = visitors.bits[part]
                apart = np.bitwise_count(theirs[:, None, 0] ^ mine[None, :, 0])
                apart += np.bitwise_count(theirs[:, None, 1] ^ mine[None, :, 1])
                j, i = np.nonzero(apart <= 1 + lose)
                held.append((homes[i], part[j]))
                size += len(i)
                if size >= most:
                    found.append(self._verified(visitors, held, lose))
                    held, size = [], 0
        if held:
            found.append(self._verified(visitors, held, lose))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        mine, theirs = zip(*found)
        return np.concatenate(mine), np.concatenate(theirs)

    def among(self) -> pa.RecordBatch:
        mine, theirs = self.links(self.homes, 1)
        return _summed(self.homes, mine, self.homes, theirs)

    def with_visitors(self, visitors: Points, lose: int) -> Iterator[pa.RecordBatch]:
        mine, theirs = self.links(visitors, lose)
        yield _summed(self.homes, mine, visitors, theirs)
        yield _summed(visitors, theirs, self.homes, mine)


def _summed(words: Points, own: np.ndarray, others: Points, other: np.ndarray) -> pa.RecordBatch:
    """(word, n_near, best_n, best) of links; the best is the most frequent, then the first one."""
    place = np.empty(len(others), np.int64)
    place[np.argsort(np.array(others.words, "S") if len(others) else [], kind="stable")] = np.arange(len(others))
    order = np.lexsort((place[other], -others.n[other], own))
    own, other = own[order], other[order]
    cuts = cuts_of(own)
    first = cuts[:-1]
    columns = [
        pa.array([words.words[i].decode("latin-1") for i in own[first].tolist()], pa.string()),
        pa.array(np.diff(cuts)),
        pa.array(others.n[other[first]]),
        pa.array([others.words[i].decode("latin-1") for i in other[first].tolist()], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "best_n", "best"])


#: Roles of a row in a cell: it belongs there, or visits with as many letters, or with one less.
_HOME, _EQUAL, _SHORTER = 0, 1, 2


def _latin(column: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def _placed(batches: Iterator[pa.RecordBatch], trees: Broadcast) -> Iterator[pa.RecordBatch]:
    """(cell, role, word, n): every word at home, and in the cells that its range searches reach."""
    base = trees.value
    for batch in batches:
        words = _latin(batch.column(0))
        n = batch.column(1).to_numpy()
        rows: list[tuple[int, int, np.ndarray]] = []
        lengths = np.array([len(w) for w in words])
        for length in np.unique(lengths).tolist():
            chosen = np.flatnonzero(lengths == length)
            points = Points([words[i] for i in chosen], n[chosen])
            cell, tree = base.get(length, (0, None))
            home = tree.home(points.counts) if tree else np.zeros(len(points), np.int64)
            for leaf in np.unique(home).tolist():
                rows.append((length * CELLS * 2 + cell + leaf, _HOME, chosen[home == leaf]))
            if tree:
                for leaf, own in tree.reached(points.counts, 1):
                    rows.append((length * CELLS * 2 + cell + leaf, _EQUAL, chosen[own[home[own] < leaf]]))
            cell, tree = base.get(length + 1, (0, None))
            for leaf, own in tree.reached(points.counts, 0) if tree else [(0, np.arange(len(points)))]:
                rows.append(((length + 1) * CELLS * 2 + cell + leaf, _SHORTER, chosen[own]))
        for cell, role, chosen in rows:
            part = pa.array(chosen)
            columns = [pa.array(np.full(len(chosen), cell)), pa.array(np.full(len(chosen), role, np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(0).take(part), batch.column(1).take(part)], names=["cell", "role", "word", "n"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n_near, best_n, best) of rows sorted by cell and role."""
    cell, near = None, None
    held: list[tuple[list[bytes], np.ndarray]] = []

    def opened() -> Near:
        words = [w for ws, _ in held for w in ws]
        return Near(Points(words, np.concatenate([n for _, n in held])))

    for batch in batches:
        cells, roles = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = cuts_of(cells * 4 + roles)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if cells[a] != cell:
                if held:
                    yield opened().among()
                cell, near, held = int(cells[a]), None, []
            words, n = _latin(batch.column(2)[a:b]), batch.column(3).to_numpy()[a:b]
            if roles[a] == _HOME:
                held.append((words, n))
                continue
            if held:
                near, held = opened(), []
                yield near.among()
            if near is not None:
                yield from near.with_visitors(Points(words, n), int(roles[a] == _EQUAL))
    if held:
        yield opened().among()


def _trees(words: DataFrame) -> dict[int, tuple[int, Tree]]:
    """length -> (number of its first cell, upper part of its tree), for lengths of more than one cell."""
    length = F.length("word")
    per_cell = F.least(F.lit(CELL_WORDS), F.greatest(F.lit(1), F.floor(CELL_BYTES / length)))
    sizes = words.groupBy(length.alias("length")).agg(F.count("*").alias("n"), F.max(per_cell).alias("per_cell"))
    sizes = {r["length"]: r for r in sizes.where("n > per_cell").orderBy(F.desc(F.col("n") / F.col("per_cell"))).limit(CELLS // 2).collect()}
    if not sizes:
        return {}
    wanted = sum(r["n"] / r["per_cell"] for r in sizes.values())
    wider = max(1.0, wanted / (CELLS // 4))
    # the words of the lowest hashes, about SAMPLE_WORDS of them: every task sends its share only
    share = min(1.0, SAMPLE_WORDS / sum(r["n"] for r in sizes.values()))
    chosen = F.shiftrightunsigned(F.xxhash64("word"), 32) < int(share * 2**32)
    sample = words.where(length.isin(list(sizes)) & chosen).select("word")
    sample = sorted((r.word.encode("latin-1") for r in sample.collect()), key=lambda w: (len(w), w))
    out, first = {}, 0
    for size, group in groupby(sample, key=len):
        points = Points(found := list(group), np.zeros(0, np.int64))
        cells = sizes[size]["n"] / (sizes[size]["per_cell"] * wider)
        depth = int(np.ceil(np.log2(max(1, cells))))
        tree = Tree(points.counts, max(1, int(len(found) / (2 * max(1, cells)))), depth)
        leaves = len(tree.leaves)
        tree.leaves = []  # where sampled words lie matters no more
        out[size] = (first, tree)
        first += leaves
    return out


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the (word, n) that have near words; ``words`` is a stored table of distinct words."""
    trees = words.sparkSession.sparkContext.broadcast(_trees(words))  # at most CELLS cells
    placed = in_tasks(words.select("word", "n"), partial(_placed, trees=trees), "cell long, role int, word string, n long")
    placed = placed.repartition("cell").sortWithinPartitions("cell", "role")
    partly = in_tasks(placed, _compared, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct(-F.col("best_n"), F.col("best"))).alias("b")
    return partly.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.col1")).alias("best_n"), F.col("b.best").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last of the forms that follow one another.

    Forms grow more frequent from step to step, so there is an end; the way left doubles in each round.
    """
    found = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stored(found.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        found = joined.drop("next")
        if not joined.where("next IS NOT NULL").head(1):
            return found


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n), a stored table of distinct words of Latin letters."""
    near = near_words(words)
    is_form = F.col("best_n") >= ratio * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word",
        F.when(is_form, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    formed = stored(formed)
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``variants`` of the words of documents, counted as ``word_counts`` does."""
    return variants(stored(word_counts(docs)))


#: The query as SQL: near words share what is left when a letter goes.
ORACLE = rf"""
WITH RECURSIVE crc_table AS (
    SELECT list(c ORDER BY b) AS steps
    FROM (
        SELECT b, list_reduce(list_concat([b], range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) t(b)
    )
),
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents
),
named AS (
    SELECT run, hex(doc_id || ':' || run) AS digits FROM runs WHERE length(run) >= {LEAST_LETTERS}
),
hashed AS (
    SELECT run, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(range(0, length(digits) // 2), lambda i:
            (strpos('0123456789ABCDEF', digits[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', digits[2 * i + 2]) - 1)),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS h
    FROM named, crc_table
),
spelled AS (
    SELECT CASE WHEN h % {EVERY} = 0
        THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word
    FROM hashed
),
words AS (
    SELECT word, count(*) AS n FROM spelled WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING count(*) >= {LEAST_TIMES}
),
left_out AS (
    SELECT word, place, substring(word, 1, place) || substring(word, place + 2) AS rest
    FROM (SELECT word, unnest(range(0, length(word)))::INT AS place FROM words)
),
near AS (
    SELECT a.word, b.word AS other FROM left_out a JOIN left_out b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
    UNION ALL SELECT DISTINCT a.word, w.word FROM left_out a JOIN words w ON a.rest = w.word
    UNION ALL SELECT DISTINCT w.word, a.word FROM left_out a JOIN words w ON a.rest = w.word
),
best AS (
    SELECT near.word, near.other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
        row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, encode(near.other)) AS place
    FROM near JOIN words o ON near.other = o.word
),
formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
        CASE WHEN b.other_n >= {RATIO} * w.n THEN b.other END AS form, CASE WHEN b.other_n >= {RATIO} * w.n THEN b.other_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word AND b.place = 1
),
followed AS (
    SELECT word, word AS root, form AS next FROM formed
    UNION ALL SELECT f.word, g.word, g.form FROM followed f JOIN formed g ON f.next = g.word
)
SELECT word, form, root, n, n_near, form_n
FROM formed JOIN (SELECT word, root FROM followed WHERE next IS NULL) USING (word)
"""
