import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sitecharge.llm import word_bpe
from sitecharge.llm.word_bpe import Encoder, pieces, read_tokenizer, transcoded, with_digests, words_of

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    return Encoder(read_tokenizer(PATH)), Tokenizer.from_file(PATH)


def same(both, text):
    own, library = both
    ids = [i for word in words_of(text) for i in own.encode(word)]
    assert ids == library.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=400, deadline=None)
@given(text=st.text(alphabet="  \n\t\x1c\x85\xa0abehinorst'SDVLM▁é①中😀.,!<>|0x\x00ΣσÀİ́̈K͸​　", max_size=60))
def test_any_text(both, text):
    same(both, text)


def test_every_assigned_kind_of_character(both):
    r = random.Random(2)
    for _ in range(300):
        same(both, "".join(chr(cp) for cp in r.choices(range(0x2FA20), k=40) if not 0xD800 <= cp < 0xE000))


def test_special_tokens_contractions_and_long_words(both):
    for text in ("<|endoftext|>", "a<|startoftext|>B<|endoftext|><|endoftext|> <|endoftext |>", "<|ENDOFTEXT|>", "I'LL don't 're''s'vex o'd"):
        same(both, text)
    same(both, "tion" * 5000 + "x" * 5000 + "é" * 3000 + "1234" * 50)
    same(both, "")


def plain(rows):
    library = Tokenizer.from_file(PATH)
    out = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]
        out.append((doc_id, len(ids), *digests))
    return sorted(out, key=repr)


def found(frame):
    return sorted(map(tuple, with_digests(transcoded(frame, PATH)).drop("ids", "decoded").collect()), key=repr)


def test_table(spark, messy, messy_documents):
    assert found(messy_documents) == plain(messy)
    assert transcoded(messy_documents.limit(0), PATH).count() == 0


def test_special_and_long_texts(spark, documents):
    r = random.Random(8)
    words = ["the", "And,", "<|endoftext|>", "naïve", "ΑΣ", "ét", "͸x", "a\x1cb"]
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 30))), "en", "a", 0) for i in range(60)]
    rows += [(100, " ".join(f"w{i}" for i in range(200_000)), "en", "a", 0), (101, "<|startoftext|>" * 40, "en", "a", 0)]
    assert found(documents(rows)) == plain(rows)


def test_chunks(both, monkeypatch):
    """Small chunks, some with the same words, in one partition."""
    import pyarrow as pa

    monkeypatch.setattr(word_bpe, "CHUNK_WORDS", 3)
    monkeypatch.setattr(word_bpe, "CHUNK_SIZE", 4)

    class Shared:
        value = read_tokenizer(PATH)

    texts = ["one two three", "one two three", None, "", "four", "one two three four five", "six " * 9] * 3
    docs = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t], pa.string())], names=["doc_id", "text"]) for i, t in enumerate(texts)]
    whole = pa.Table.from_batches(docs).combine_chunks().to_batches()[0]  # other batches, the same chunks
    words = [r for b in word_bpe._word_rows(iter([whole]), 2) for r in b.to_pylist()]
    words.sort(key=lambda r: r["bucket"])
    packed = pa.schema({"bucket": pa.int32(), "chunk": pa.int64(), "words": pa.binary(), "numbers": pa.binary()})
    batch = pa.RecordBatch.from_pylist(words, packed)
    encoded = [r for b in word_bpe._encoded(iter([batch]), Shared) for r in b.to_pylist()]
    numbered = [r for b in word_bpe._document_rows(iter(docs)) for r in b.to_pylist()]
    rows = sorted(encoded + numbered, key=lambda r: (r["chunk"], r["bucket"] is None, r["bucket"] or 0))
    schema = pa.schema(
        {"chunk": pa.int64(), "bucket": pa.int32(), "numbers": pa.binary(), "sizes": pa.binary(), "ids": pa.binary(), "doc_id": pa.int64()}
    )
    out = [r for b in word_bpe._rebuilt(iter([pa.RecordBatch.from_pylist(rows, schema)]), Shared) for r in b.to_pylist()]
    _, library = both
    assert sorted((r["doc_id"], r["ids"]) for r in out) == [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)]
    lost = [r for r in rows if r["bucket"] != 1]
    with pytest.raises(ValueError, match="another order"):
        list(word_bpe._rebuilt(iter([pa.RecordBatch.from_pylist(lost, schema)]), Shared))


def test_pieces_and_other_tokenizers(both):
    _, library = both
    assert pieces(read_tokenizer(PATH)) == [library.id_to_token(i) for i in range(library.get_vocab_size())]
    with pytest.raises((ValueError, KeyError, TypeError)):
        read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
