import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seasonframe.llm.bpe import PairIndexBpe, decode_documents, encode_documents, encoding_digests

PATH = public_tokenizers.path("word_bpe_49k.json")
RNG = random.Random(6)
POOL = [chr(c) for c in [*range(32, 127)] * 6 + [*range(0xC0, 0x250)]] + list("\n\t\x1c\x85\xa0\u2028\u200b\u0301\u0308ΣςİẞK가각\U0001f600\U00010d50\ua7cb\U000105c0")
TEXTS = ["".join(RNG.choice(POOL) for _ in range(RNG.randint(0, 80))) for _ in range(1500)]
TEXTS += ["", "<|startoftext|>Hi<|endoftext|> <|endoftext|", "don't I'LL we'Re 'S", "a" * 3000, "ab" * 3000, "the " * 5000, "\n" * 500, "ΣΑΣ Σ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_and_texts_equal_the_library(library):
    bpe = PairIndexBpe(PATH)
    for text, ids in zip(TEXTS, bpe.encode(TEXTS), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert bpe.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_memory_starts_anew_without_a_change(library, monkeypatch):
    import seasonframe.llm.bpe as module

    monkeypatch.setattr(module, "MEMORY_WORDS", 20)
    monkeypatch.setattr(module, "INDEX_CHARS", 300)
    bpe = PairIndexBpe(PATH)
    assert [x.tolist() for x in bpe.encode(TEXTS[:200])] == [library.encode(t, add_special_tokens=False).ids for t in TEXTS[:200]]


def test_documents_round_trip(documents, library):
    rows = [*enumerate(TEXTS[::40]), (900, None), (None, "no id"), (901, "twice"), (901, "twice")]
    docs = documents(rows)
    want = sorted(((i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows), key=repr)
    encoded = encode_documents(docs, PATH)
    assert sorted(((r.doc_id, tuple(r.ids)) for r in encoded.collect()), key=repr) == want
    decoded = sorted(((r.doc_id, r.text) for r in decode_documents(encoded, PATH).collect()), key=repr)
    assert decoded == sorted(((i, library.decode(list(ids), skip_special_tokens=False)) for i, ids in want), key=repr)
    for r in encoding_digests(docs, PATH).collect():
        own = [ids for i, ids in want if i == r.doc_id]
        assert r.n_tokens == len(own[0])
        assert r.ids_sha256 == hashlib.sha256(np.array(own[0], "<u4").tobytes()).hexdigest()
        text = library.decode(list(own[0]), skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    for made in (encode_documents, encoding_digests):
        assert made(documents([]), PATH).collect() == []
