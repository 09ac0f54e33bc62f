"""SentencePiece encoding and decoding for merge-type (BPE) models, by a prefix table.

In merge order, the encoding of every prefix of a word has one last token, and a token can follow
another only if merging their joint text gives just these two. So a word is encoded from left to
right: an automaton gives the tokens that end at each position, the one that fits the last token of
the prefix before it is stored, and the ids are recovered backwards from the end. Two tokens fit
unless, at some point of their own merges, the pieces that touch at the border would have merged
earlier. Words are encoded once per worker while they stay in its bounded cache.

Nothing merges across a space mark that follows another character, nor across characters that the
vocabulary lacks (written as byte tokens), so texts of any length are encoded whole, word by word.
Null texts count as empty: no ids, an empty decoded text. Rows keep their doc_id whatever it is, null and
repeated ones included; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecharge.llm.shared import in_tasks, slices, text_bytes

MARK = "▁"
#: Words that a worker keeps encoded in each of two generations; what is used again moves to the younger one.
CACHED_WORDS = 120_000

Vocabulary = list[tuple[str, float, str]]


def vocabulary(model_path: str) -> Vocabulary:
    """(piece, score, kind) by id; kind is normal, byte, control or unknown."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    out = []
    for i in range(model.vocab_size()):
        kind = "control" if model.is_control(i) else "unknown" if model.is_unknown(i) else "byte" if model.is_byte(i) else "normal"
        out.append((model.id_to_piece(i), model.get_score(i), "control" if model.is_unused(i) else kind))
    return out


def packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class _Words(dict):
    def __init__(self, encode):
        self.encode = encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        out = self.older.get(word)
        out = self[word] = self.encode(word) if out is None else out
        return out


class Codec:
    """Encodes and decodes with one vocabulary: byte fallback, a leading space mark, no other normalising."""

    def __init__(self, pieces: Vocabulary):
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == "normal"}
        order = sorted(self.ids.values(), key=lambda i: (-pieces[i][1], i))
        self.time = {t: n for n, t in enumerate(order)}
        self.text = [p for p, _, _ in pieces]
        self.length = [len(p) for p in self.text]
        self.score = [score for _, score, _ in pieces]
        self.unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == "unknown")
        self.byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == "byte"}
        self.known = {p for p in self.ids if len(p) == 1}
        runs = [t for p, t in self.ids.items() if len(p) > 1 and not p.strip(MARK)]
        words = [t for t in order if t not in runs]
        latest = max((self.time[t] for t in words if self.length[t] > 1), default=-1)
        if any(MARK in self.text[t][1:] for t in words) or any(self.time[t] < latest for t in runs if self.length[t] == 2):
            raise ValueError("space marks may start a word or stand in runs of their own that merge last")
        forever = len(pieces)
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.fits: dict[int, bool] = {}
        automaton = ahocorasick.Automaton()
        for t in sorted(words, key=lambda t: (self.length[t] > 1, self.time[t])):
            if self.length[t] == 1:
                self.left[t] = self.right[t] = [(t, forever)]
            else:
                halves = self._halves(t)
                if halves is None:
                    continue  # no merges lead to this piece
                now = self.time[t]
                self.left[t] = [(a, min(end, now)) for a, end in self.left[halves[0]]] + [(t, forever)]
                self.right[t] = [(a, min(end, now)) for a, end in self.right[halves[1]]] + [(t, forever)]
            automaton.add_word(self.text[t], t)
        automaton.make_automaton()
        self.automaton = automaton
        self.neighbours = {pair for t in self.left for pair in zip(self.text[t], self.text[t][1:])}
        self.spaced = _Words(lambda word: self._word(MARK + word))
        self.bare = _Words(self._word)
        self.runs: dict[int, bytes] = {}
        self.surface = [self._surface(*piece) for piece in pieces]
        self.opening = {i for i, (p, _, kind) in enumerate(pieces) if kind == "normal" and p.startswith(MARK)}

    def _halves(self, t: int) -> tuple[int, int] | None:
        piece = self.text[t]
        for cut in range(1, len(piece)):
            a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
            if a in self.right and b in self.left and not self._meet(a, b, self.time[t]):
                return a, b
        return None

    def _meet(self, a: int, b: int, before: int) -> bool:
        """Whether a merge across the border of tokens a and b comes first, and before the given time."""
        for x, x_end in self.right[a]:
            for y, y_end in self.left[b]:
                joined = self.ids.get(self.text[x] + self.text[y])
                if joined is not None:
                    now = self.time[joined]
                    # of equal merges the one further left is made first
                    if now < before and now < x_end and now <= y_end:
                        return True
        return False

    def _known(self, word: str) -> bytes:
        """The ids of a word whose characters the vocabulary has."""
        last: list[int | None] = [None] * len(word)
        length, fits, size = self.length, self.fits, len(self.text)
        for end, t in self.automaton.iter(word):
            if last[end] is not None:
                continue
            before = end - length[t]
            if before >= 0:
                left = last[before]
                if left is None:
                    continue
                pair = left * size + t
                fit = fits.get(pair)
                if fit is None:
                    if len(fits) >= 3 * CACHED_WORDS:
                        fits.clear()
                    fit = fits[pair] = not self._meet(left, t, len(self.text))
                if not fit:
                    continue
            last[end] = t
        out = []
        end = len(word) - 1
        while end >= 0:
            out.append(last[end])
            end -= length[last[end]]
        out.reverse()
        return packed(out)

    def _word(self, word: str) -> bytes:
        """A word is cut where no piece holds both neighbours; the parts are encoded on their own."""
        cuts = [i for i, pair in enumerate(zip(word, word[1:]), 1) if pair not in self.neighbours]
        if cuts:
            parts = [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]
            return b"".join(map(self.bare.__getitem__, parts))
        if word in self.known or len(word) > 1:
            return self._known(word)
        return packed([self.byte.get(b, self.unknown) for b in word.encode()] if self.byte else [self.unknown])

    def _run(self, n: int) -> bytes:
        """n space marks that no letter takes, merged pair by pair."""
        if n not in self.runs:
            out = [MARK] * n
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            heap: list[tuple[float, int, str]] = []

            def offer(i: int) -> None:
                if i >= 0 and after[i] < n and (t := self.ids.get(joined := out[i] + out[after[i]])) is not None:
                    heapq.heappush(heap, (-self.score[t], i, joined))

            for i in range(n):
                offer(i)
            while heap:
                _, i, joined = heapq.heappop(heap)
                j = after[i] if out[i] else n
                if j < n and out[i] + out[j] == joined:
                    out[i], out[j] = joined, ""
                    after[i] = after[j]
                    if after[j] < n:
                        before[after[j]] = i
                    offer(before[i])
                    offer(i)
            found = packed([self.ids[p] for p in out if p])
            if n > 1000:
                return found
            self.runs[n] = found
        return self.runs[n]

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit integers."""
        if not text:
            return b""
        one = packed([self.ids.get(MARK, self.unknown)])
        end_of_line = self.bare["\n"]
        lines = (" " + text.replace(MARK, " ")).split("\n") if "\n" not in self.known else [" " + text.replace(MARK, " ")]
        out: list[bytes] = []
        for k, line in enumerate(lines):
            if k:
                out.append(end_of_line)
            first, *words = line.split(" ")
            if first:
                out.append(self.bare[first])
            if "" not in words:
                out += map(self.spaced.__getitem__, words)
                continue
            marks = 0
            for word in words:
                marks += 1
                if word:
                    ids = self.spaced[word]
                    if marks > 1:
                        alone = ids[:4] == one
                        out.append(self._run(marks if alone else marks - 1))
                        ids = ids[4:] if alone else ids
                    out.append(ids)
                    marks = 0
            if marks:
                out.append(self._run(marks))
        return b"".join(out)

    @staticmethod
    def _surface(piece: str, score: float, kind: str) -> bytes:
        if kind == "byte":
            return bytes([int(piece[3:5], 16)])
        return {"control": "", "unknown": " ⁇ "}.get(kind, piece.replace(MARK, " ")).encode()

    def decode(self, ids: list[int]) -> str:
        if not ids:
            return ""
        out = b"".join(map(self.surface.__getitem__, ids))
        if ids[0] in self.opening:
            out = out[1:]
        try:
            return out.decode()
        except UnicodeDecodeError:
            return self._lenient(out)

    @staticmethod
    def _lenient(data: bytes) -> str:
        """Every byte that belongs to no character becomes U+FFFD."""
        out = []
        while data:
            try:
                return "".join(out) + data.decode()
            except UnicodeDecodeError as error:
                out.append(data[: error.start].decode() + "�")
                data = data[error.start + 1 :]
        return "".join(out)


_codecs: dict[str, Codec] = {}


def _codec(key: str, pieces: Broadcast) -> Codec:
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(pieces.value)
    return _codecs[key]


def _transcode(batches: Iterator[pa.RecordBatch], key: str, pieces: Broadcast) -> Iterator[pa.RecordBatch]:
    codec = _codec(key, pieces)
    for batch in batches:
        for first, last in slices(text_bytes(batch.column(1))[1]):
            encoded, decoded = [], []
            for text in batch.column(1)[first:last].to_pylist():
                encoded.append(codec.encode(text or ""))
                decoded.append(codec.decode(np.frombuffer(encoded[-1], np.int32).tolist()))
            ends = np.cumsum([0, *(len(ids) // 4 for ids in encoded)])
            flat = pa.array(np.frombuffer(b"".join(encoded), np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            columns = [batch.column(0)[first:last], lists, pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])


def transcoded(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, decoded) per row: the ids of the whole text, and the text that they decode to."""
    pieces = vocabulary(model_path)
    key = hashlib.sha256(repr(pieces).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_tasks(
        docs.select("doc_id", "text"), partial(_transcode, key=key, pieces=shared), f"doc_id {kind}, ids array<int>, decoded string"
    )


def with_digests(found: DataFrame) -> DataFrame:
    """What ``transcoded`` returns, with n_tokens, ids_sha256 (of the ids in decimal, joined by commas) and decoded_sha256."""
    return (
        found.withColumn("n_tokens", F.size("ids").cast("long"))
        .withColumn("ids_sha256", F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256))
        .withColumn("decoded_sha256", F.sha2("decoded", 256))
    )
