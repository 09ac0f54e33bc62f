import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from sitecharge.llm.sentencepiece_codec import Codec, transcoded, vocabulary, with_digests

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return Codec(vocabulary(PATH)), sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(both, text):
    codec, library = both
    ids = np.frombuffer(codec.encode(text), np.int32).tolist()
    assert ids == library.encode(text), text
    assert codec.decode(ids) == library.decode(ids), text


@settings(max_examples=400, deadline=None)
@given(text=st.text(alphabet="  \n\tabehinorst▁é①中😀.,!<>0x\x00", max_size=60))
def test_any_text(both, text):
    same(both, text)


def test_runs_of_spaces_and_long_words(both):
    for n in [*range(40), 500, 3000]:
        same(both, " " * n)
        same(both, "a" + " " * n + "the" + " " * n)
    same(both, "tion" * 20_000)
    same(both, "x" * 5000 + "①" * 50)


def test_decode_of_any_ids(both):
    codec, library = both
    for ids in ([3 + 0xE2, 3 + 0x91], [3 + 0xE2, 3 + 0x91, 3 + 0xA0], [3 + 0xFF, 264], [264, 1, 2, 264], [259, 264]):
        assert codec.decode(ids) == library.decode(ids)


def test_table(spark, messy, messy_documents, both):
    _, library = both
    found = sorted(map(tuple, with_digests(transcoded(messy_documents, PATH)).drop("ids", "decoded").collect()), key=repr)
    expected = []
    for doc_id, text, *_ in messy:
        ids = library.encode(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((doc_id, len(ids), digest, hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert found == sorted(expected, key=repr)
    assert transcoded(messy_documents.limit(0), PATH).count() == 0
