"""Byte-level BPE with word ends, by a table of distinct words; decoding by a join of ids with pieces.

Texts are cut at white space into words. A task numbers the distinct words of a chunk of its documents, so a document
is a list of word numbers. The (word, chunk, number) entries of all chunks meet in buckets by the word's hash, packed, one row
per bucket and chunk; there each distinct word is normalised, cut by the tokenizer's own pattern and merged once, and
its ids go back to all chunks that have it. Rows of a chunk meet again, ids take the places of the numbers, and pieces,
looked up by id, are joined as the library joins them. Words move once per chunk and not once per occurrence, and no
dictionary is larger than a bucket or a chunk.

The documents are cut twice, for the words and for the numbers; a chunk is known by the hash of its words, so
a second reading that differs from the first one is an error, never a wrong result. ``docs`` should be a stored
table or a frame whose rows come in the same order each time.

Null texts count as empty: no ids, an empty decoded text. Rows keep their doc_id whatever it is, null and repeated
ones included; extra columns are ignored. A text of any length is cut whole; a word is never cut, so a long
text without white space is one word. Special tokens in a text become their ids, as in the library.
Characters that this Python's Unicode tables do not know yet are normalised and cut by the library.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecharge.llm.shared import cuts_of, in_tasks, slices, text_bytes

#: Distinct words, and words in all, from which on a chunk is closed.
CHUNK_WORDS = 250_000
CHUNK_SIZE = 5_000_000
#: Buckets of words: this many, or four for each shuffle partition. A task has one of them in memory at a time.
LEAST_BUCKETS = 256
#: Pieces of words that a task keeps merged, and words of a bucket; the tables are emptied beyond.
CACHED_WORDS = 100_000
BUCKET_WORDS = 1_000_000


def _byte_letters() -> list[str]:
    """The letter of each byte: itself where it can be printed, else the next one from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def read_tokenizer(path: str) -> str:
    """The tokenizer file, refused if it has steps that this module does not take."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    t = json.loads(text)
    normal = [n["type"] for n in t["normalizer"]["normalizers"]]
    space = t["normalizer"]["normalizers"][1]
    split, level = t["pre_tokenizer"]["pretokenizers"]
    model = t["model"]
    known = (
        normal == ["NFC", "Replace", "Lowercase"]
        and (space["pattern"], space["content"]) == ({"Regex": r"\s+"}, " ")
        and (split["type"], split["behavior"], split["invert"]) == ("Split", "Removed", True)
        and (level["type"], level["add_prefix_space"], level["use_regex"]) == ("ByteLevel", False, False)
        and model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        and t["decoder"] is None
        and t["truncation"] is None
        and t["padding"] is None
        and not any(a[k] for a in t["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        and not any(re.search(r"\s", a["content"]) for a in t["added_tokens"])
    )
    if not known:
        raise ValueError(f"{path}: only lower-casing byte-level BPE whose pattern keeps no white space")
    return text


def pieces(tokenizer: str) -> list[str]:
    """The piece of each id."""
    t = json.loads(tokenizer)
    named = t["model"]["vocab"] | {a["content"]: a["id"] for a in t["added_tokens"]}
    out = [""] * (max(named.values()) + 1)
    for piece, i in named.items():
        out[i] = piece
    return out


class Encoder:
    """Ids of words between white space."""

    def __init__(self, tokenizer: str):
        t = json.loads(tokenizer)
        self.tokenizer, self.library = tokenizer, None
        model = t["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        letters = _byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.final = [vocab[c + suffix] for c in letters]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        split = t["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split)
        self.special = {a["content"]: a["id"] for a in t["added_tokens"]}
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.specials = re.compile(f"({'|'.join(names)})") if names else None
        self.kind = "H" if len(vocab) + len(self.special) <= 1 << 16 else "I"
        self.cache: dict[str, array] = {}
        self.odd = _unassigned()

    def _cut(self, text: str) -> list[str]:
        """What the pattern keeps of a normalised text."""
        if text.isascii():
            return self.pattern.findall(text.lower())
        if self.odd.search(text):
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_str(self.tokenizer)
                self.bytes_of = {c: b for b, c in enumerate(_byte_letters())}
            kept = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(map(self.bytes_of.__getitem__, piece)).decode() for piece, _ in kept]
        # letters are lowered one by one, without the sigma that ends a word
        return self.pattern.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def _merged(self, word: str) -> array:
        """Merges pair by pair: the lowest rank first, of equal ones the leftmost."""
        data = word.encode()
        ids = [self.inner[b] for b in data]
        ids[-1] = self.final[data[-1]]
        n = len(ids)
        if n == 1:
            return array(self.kind, ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.merges.get
        heap = [(found[0], i, found[1]) for i in range(n - 1) if (found := get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, i, new = heapq.heappop(heap)
            if ids[i] < 0 or (j := after[i]) >= n or get((ids[i], ids[j])) != (rank, new):
                continue
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := get((new, ids[k])):
                    heapq.heappush(heap, (found[0], i, found[1]))
            if (k := before[i]) >= 0 and (found := get((ids[k], new))):
                heapq.heappush(heap, (found[0], k, found[1]))
        return array(self.kind, [t for t in ids if t >= 0])

    def _plain(self, text: str) -> array:
        out = array(self.kind)
        for word in self._cut(text):
            ids = self.cache.get(word)
            if ids is None:
                if len(self.cache) >= CACHED_WORDS:
                    self.cache.clear()
                ids = self.cache[word] = self._merged(word)
            out += ids
        return out

    def encode(self, word: str) -> array:
        if self.specials is None or not self.specials.search(word):
            return self._plain(word)
        out = array(self.kind)
        for i, part in enumerate(self.specials.split(word)):
            out += array(self.kind, [self.special[part]]) if i % 2 else self._plain(part)
        return out


def _unassigned() -> re.Pattern:
    """Characters without a category in this Python's tables."""
    unknown = [cp for cp in range(sys.maxunicode + 1) if unicodedata.category(chr(cp)) == "Cn"]
    starts = [cp for cp, before in zip(unknown, [-2, *unknown]) if cp != before + 1]
    ends = [cp for cp, after in zip(unknown, [*unknown[1:], -2]) if after != cp + 1]
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends)) + "]")


_SPACED = regex.compile(r"\S+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def words_of(text: str) -> list[str]:
    """The words between white space; U+001C to U+001F, where ``str.split`` cuts, are none."""
    return _SPACED.findall(text) if _SEPARATORS.search(text) else text.split()


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


_compress = zstandard.ZstdCompressor(level=3).compress
_decompress = zstandard.ZstdDecompressor().decompress


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as bytes: all first ones, all second ones and so on, compressed."""
    return _compress(np.asarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _numbers(planes: bytes) -> np.ndarray:
    data = np.frombuffer(_decompress(planes), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(data.T).reshape(-1).view("<u4").astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Numbers, list]]:
    """(chunk, words, documents) of (doc_id, text), with documents as (doc_ids, [numbers of each row]).

    Where a chunk ends depends on the rows alone, not on the batches that they come in.
    """
    words, held, size = _Numbers(), [], 0

    def closed() -> tuple[int, _Numbers, list]:
        digest = hashlib.blake2b("\n".join(words).encode(), digest_size=8).digest()
        return int.from_bytes(digest, "little", signed=True), words, held

    for batch in batches:
        begin, rows = 0, []
        for first, last in slices(text_bytes(batch.column(1))[1]):
            for row, text in enumerate(batch.column(1)[first:last].to_pylist(), first):
                rows.append(_planes(np.array(list(map(words.__getitem__, words_of(text))), np.int64)) if text else b"")
                size += len(text or "") // 5
                if len(words) >= CHUNK_WORDS or size >= CHUNK_SIZE:
                    held.append((batch.column(0)[begin : row + 1], rows))
                    yield closed()
                    words, held, size = _Numbers(), [], 0
                    begin, rows = row + 1, []
        if rows:
            held.append((batch.column(0)[begin:], rows))
    if held:
        yield closed()


def _word_rows(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(bucket, chunk, words, numbers) of all distinct words of the chunks of (doc_id, text)."""
    for chunk, words, _ in _chunks(batches):
        names = list(words)
        if not names:
            continue
        bucket = np.fromiter((crc32(w.encode()) for w in names), np.int64, len(names)) % buckets
        order = np.argsort(bucket, kind="stable")
        cuts = cuts_of(bucket[order])
        columns: list[list] = [[], [], [], []]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            held = order[a:b]
            row = (int(bucket[held[0]]), chunk, _compress("\n".join([names[i] for i in held.tolist()]).encode()), _planes(np.diff(held, prepend=0)))
            for column, value in zip(columns, row):
                column.append(value)
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "chunk", "words", "numbers"])


def _document_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, bucket, numbers, doc_id) of (doc_id, text), with bucket null and the numbers of the text's words."""
    for chunk, _, held in _chunks(batches):
        for ids, rows in held:
            columns = [pa.array(np.full(len(rows), chunk)), pa.nulls(len(rows), pa.int32()), pa.array(rows, pa.binary()), ids]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "bucket", "numbers", "doc_id"])


_encoders: dict[str, Encoder] = {}


def _encoder(tokenizer: Broadcast) -> Encoder:
    key = hashlib.sha256(tokenizer.value.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokenizer.value)
    return _encoders[key]


def _encoded(batches: Iterator[pa.RecordBatch], tokenizer: Broadcast) -> Iterator[pa.RecordBatch]:
    """(chunk, bucket, numbers, sizes, ids) of (bucket, chunk, words, numbers) in order of bucket: each word is encoded once."""
    encoder = _encoder(tokenizer)
    bucket, table = None, {}
    for batch in batches:
        sizes, ids = [], []
        for b, packed in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if b != bucket or len(table) > BUCKET_WORDS:
                bucket, table = b, {}
            found = []
            for word in _decompress(packed).decode().split("\n"):
                own = table.get(word)
                if own is None:
                    own = table[word] = encoder.encode(word)
                found.append(own)
            sizes.append(_planes(np.fromiter(map(len, found), np.int64, len(found))))
            ids.append(_compress(b"".join(found)))
        columns = [batch.column(1), batch.column(0), batch.column(3), pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["chunk", "bucket", "numbers", "sizes", "ids"])


_LOST = "words are missing: the documents came in another order when they were read again"


class _Chunk:
    """The ids and the decoded text of each word of a chunk, by number."""

    def __init__(self, rows: list[dict], names: list[str]):
        kind = np.uint16 if len(names) <= 1 << 16 else np.uint32
        empty = np.zeros(0, np.int64)
        numbers = np.concatenate([empty, *(np.cumsum(_numbers(r["numbers"])) for r in rows)])
        sizes = np.concatenate([empty, *(_numbers(r["sizes"]) for r in rows)])
        ids = np.frombuffer(b"".join(_decompress(r["ids"]) for r in rows), kind)
        order = np.argsort(numbers)
        if (numbers[order] != np.arange(len(numbers))).any():
            raise ValueError(_LOST)
        starts = (np.cumsum(sizes) - sizes)[order]
        self.ends = np.concatenate([[0], np.cumsum(sizes[order])])
        self.ids = ids[_ranges(starts, sizes[order])].astype(np.int32)
        joined = [names[i] for i in self.ids.tolist()]
        bounds = self.ends.tolist()
        self.decoded = [" ".join(joined[a:b]) for a, b in zip(bounds, bounds[1:])]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several ranges, one after another."""
    stops = np.cumsum(sizes)
    return np.arange(stops[-1] if len(stops) else 0) + np.repeat(starts - (stops - sizes), sizes)


def _rebuilt(batches: Iterator[pa.RecordBatch], tokenizer: Broadcast) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids, decoded) of (chunk, bucket, numbers, sizes, ids, doc_id), sorted by chunk and bucket, documents last."""
    names = pieces(tokenizer.value)
    chunk, words = None, None
    held: list[dict] = []
    for batch in batches:
        for first in range(0, batch.num_rows, 1000):
            part = batch.slice(first, 1000)
            chunks = part.column(0).to_numpy()
            for begin, end in _runs(chunks, part.column(1).is_null().to_numpy(zero_copy_only=False)):
                rows = part.slice(begin, end - begin)
                if chunks[begin] != chunk:
                    chunk, words, held = int(chunks[begin]), None, []
                if rows.column(1)[0].is_valid:
                    for row in rows.to_pylist():
                        # chunks with the same words bring the same rows more than once
                        if not held or held[-1]["bucket"] != row["bucket"]:
                            held.append(row)
                    continue
                if words is None:
                    words, held = _Chunk(held, names), []
                yield from _texts(rows, words)


def _runs(chunks: np.ndarray, documents: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows of one chunk and one kind."""
    change = np.flatnonzero((chunks[1:] != chunks[:-1]) | (documents[1:] != documents[:-1])) + 1
    cuts = [0, *change.tolist(), len(chunks)]
    return zip(cuts[:-1], cuts[1:])


def _texts(rows: pa.RecordBatch, words: _Chunk) -> Iterator[pa.RecordBatch]:
    held, size, begin = [], 0, 0
    blobs = rows.column(2).to_pylist()
    for i, blob in enumerate(blobs):
        held.append(_numbers(blob) if blob else np.zeros(0, np.int64))
        if held[-1].max(initial=-1) >= len(words.decoded):
            raise ValueError(_LOST)
        size += len(held[-1])
        if size >= 100_000 or i + 1 == len(blobs):
            numbers = np.concatenate(held)
            sizes = words.ends[numbers + 1] - words.ends[numbers]
            flat = words.ids[_ranges(words.ends[numbers], sizes)]
            cuts = np.concatenate([[0], np.cumsum([len(h) for h in held])])
            ends = np.concatenate([[0], np.cumsum(sizes)])[cuts]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            texts = [" ".join(filter(None, map(words.decoded.__getitem__, h.tolist()))) for h in held]
            columns = [rows.column(5)[begin : i + 1], lists, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])
            held, size, begin = [], 0, i + 1


def transcoded(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids, decoded) per row: the ids of the whole text, and the pieces that they decode to."""
    spark = docs.sparkSession
    tokenizer = spark.sparkContext.broadcast(read_tokenizer(tokenizer_path))  # as large as its file
    buckets = max(LEAST_BUCKETS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text")  # both readings take the same columns, and so the same parts of files
    words = in_tasks(texts, partial(_word_rows, buckets=buckets), "bucket int, chunk long, words binary, numbers binary")
    words = words.repartition("bucket").sortWithinPartitions("bucket")
    packed = "chunk long, bucket int, numbers binary, sizes binary, ids binary"
    words = in_tasks(words, partial(_encoded, tokenizer=tokenizer), packed)
    numbered = in_tasks(texts, _document_rows, f"chunk long, bucket int, numbers binary, doc_id {kind}")
    both = words.unionByName(numbered, allowMissingColumns=True)
    both = both.repartition("chunk").sortWithinPartitions("chunk", F.asc_nulls_last("bucket"))
    return in_tasks(both, partial(_rebuilt, tokenizer=tokenizer), f"doc_id {kind}, ids array<int>, decoded string")


def with_digests(found: DataFrame) -> DataFrame:
    """What ``transcoded`` returns, with n_tokens, ids_sha256 (of the ids in decimal, joined by a space) and decoded_sha256."""
    return (
        found.withColumn("n_tokens", F.size("ids").cast("long"))
        .withColumn("ids_sha256", F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256))
        .withColumn("decoded_sha256", F.sha2("decoded", 256))
    )
