import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import seasonframe.llm.pieces as module
from seasonframe.llm.pieces import PieceBpe, decode_documents, encode_documents, piece_digests

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def bpe():
    return PieceBpe(PATH)


@pytest.fixture(scope="module")
def texts(bpe):
    rng = random.Random(4)
    pieces = [p.replace("▁", " ") for p, kind in zip(bpe.piece, bpe.kind, strict=True) if kind == module.NORMAL]
    pool = list("  ▁\n\t\0éßÀ日本語😀ｆ́") + [chr(rng.randrange(0x20, 0xD7FF)) for _ in range(300)]
    made = ["".join(rng.choice(pieces if rng.random() < 0.7 else pool) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    made += ["".join(rng.choice("abethinos ") for _ in range(rng.randint(0, 200))) for _ in range(1000)]
    made += [" " * n + end for n in range(70) for end in ("", "x", "\n")]
    return [*made, "", "a" * 3000, "the" * 2000, "<0x41><s></s><unk>", "▁" * 20, " " * 40_000 + "x", "".join(rng.choice("abcdefgh") for _ in range(50_000))]


def test_ids_and_texts_equal_the_library(bpe, library, texts):
    for text, ids in zip(texts, bpe.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text), repr(text)
        assert bpe.decode(ids) == library.decode(ids.tolist())


def test_any_ids_are_decoded_like_the_library(bpe, library):
    rng = random.Random(5)
    for _ in range(4000):
        ids = [rng.randrange(32_000) if rng.random() < 0.5 else rng.randrange(300) for _ in range(rng.randint(0, 12))]
        assert bpe.decode(np.array(ids, int)) == library.decode(ids), ids


def test_memory_starts_anew_without_a_change(library, texts, monkeypatch):
    monkeypatch.setattr(module, "MEMORY_WORDS", 20)
    monkeypatch.setattr(module, "ROUND_CHARS", 300)
    found = PieceBpe(PATH).encode(texts[:300])
    assert [x.tolist() for x in found] == [library.encode(t) for t in texts[:300]]


def test_documents_round_trip(documents, library, texts):
    rows = [*enumerate(texts[::60]), (900, None), (None, "no id"), (901, "twice"), (901, "twice")]
    docs = documents(rows)
    want = sorted(((i, tuple(library.encode(t or ""))) for i, t in rows), key=repr)
    encoded = encode_documents(docs, PATH)
    assert sorted(((r.doc_id, tuple(r.ids)) for r in encoded.collect()), key=repr) == want
    decoded = sorted(((r.doc_id, r.text) for r in decode_documents(encoded, PATH).collect()), key=repr)
    assert decoded == sorted(((i, library.decode(list(ids))) for i, ids in want), key=repr)
    for r in piece_digests(docs, PATH).collect():
        ids = next(list(ids) for i, ids in want if i == r.doc_id)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    for made in (encode_documents, piece_digests):
        assert made(documents([]), PATH).collect() == []


def test_other_models_are_refused(tmp_path):
    (tmp_path / "unigram.model").write_bytes(b"\x12\x02\x18\x01")  # a trainer of model type 1 and no pieces
    with pytest.raises(ValueError):
        PieceBpe(str(tmp_path / "unigram.model"))
