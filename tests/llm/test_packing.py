import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seasonframe.llm.packing import best_fit_decreasing, lower_bound, pack, pack_documents, token_pieces
from seasonframe.llm.tokens import byte_encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def fewest(lengths, capacity):
    best = len(lengths)
    for count in range(1, len(lengths) + 1):
        for places in itertools.product(range(count), repeat=len(lengths)):
            loads = [0] * count
            for length, place in zip(lengths, places, strict=True):
                loads[place] += length
            if max(loads) <= capacity:
                return count
    return best


def test_bound_never_exceeds_the_optimum_nor_the_packing():
    rng = random.Random(2)
    for _ in range(60):
        capacity = rng.choice([10, 17, 30])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 6))), reverse=True)
        bound = lower_bound(np.array(lengths), capacity)
        bins = len(best_fit_decreasing(np.array(lengths), capacity)[2])
        assert bound <= fewest(lengths, capacity) <= bins
    assert lower_bound(np.array([6] * 7), 10) == 7  # two of them never share a bin
    assert lower_bound(np.array([34] * 9), 100) == 5  # at most two to a bin: a rounding function sees it


def places_are_sound(rows, capacity):
    """rows: (sequence, offset, length)."""
    for _, group in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        at = 0
        for _, offset, length in group:
            assert offset == at
            at += length
        assert at <= capacity


@pytest.mark.parametrize(("part_rows", "excess"), [(10_000, 1.01), (40, 1.08)])
def test_rows_keep_their_places_through_exchanges(spark, part_rows, excess):
    rng = random.Random(3)
    data = [(i, rng.randint(1, 100)) for i in range(600)]
    found = pack(spark.createDataFrame(data, "k long, length int"), ["k"], capacity=100, part_rows=part_rows).collect()
    assert sorted((r.k, r.length) for r in found) == data
    places_are_sound([(r.sequence_id, r.offset, r.length) for r in found], 100)
    bins = len({r.sequence_id for r in found})
    assert bins <= excess * lower_bound(np.array([x for _, x in data]), 100)


def test_lengths_out_of_range_raise(spark):
    with pytest.raises(Exception, match="a length outside"):
        pack(spark.createDataFrame([(1, 0)], "k long, length int"), ["k"]).collect()


def test_pieces_carry_the_tokenizers_ids(documents):
    tokenizer = Tokenizer.from_file(PATH)
    rng = random.Random(4)
    odd = ["", None, "Hello <|endoftext|> world", "naïve   café\n\n\tx", "z" * 5000, "    \n" * 900, " ".join(str(rng.random()) for _ in range(900))]
    rows = [*enumerate(odd), (None, "no id"), (77, "twice"), (77, "twice")]
    pieces = token_pieces(documents(rows), PATH).collect()
    packed = pack_documents(documents(rows), PATH).collect()
    places_are_sound([(r.sequence_id, r.offset, r.length) for r in packed], 1024)
    sums = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in packed}
    assert len(packed) == len(pieces)
    for i, text in rows:
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted({(r.piece, r.start, r.length, tuple(r.ids)) for r in pieces if r.doc_id == i})
        assert [x for p in own for x in p[3]] == want
        assert [p[0] for p in own] == list(range(len(own)))
        assert all(p[2] == 1024 for p in own[1:])
        for piece, start, length, ids in own:
            assert sums[i, piece] == (start, length, zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_white_space_of_every_length_gives_the_tokenizers_ids():
    tokenizer = Tokenizer.from_file(PATH)
    rng = random.Random(5)
    short_runs, usual = byte_encoder(PATH, long_run=3), byte_encoder(PATH)
    pieces = ["a", "é", "12", "<|endoftext|>", "!", " ", "  ", "    ", "\n\n\n", "\t \n ", "\xa0\xa0\xa0", "\u2003 \u3000", "\x1c\x1d\x1e", "\u200b" * 4]
    for _ in range(2000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert short_runs(text).tolist() == want == usual(text).tolist(), repr(text)
    for text in (" " * 1_000_000, "x" + "\n" * 300_000 + "y", "a" * 100_000, " " * 50_000 + "<|endoftext|>"):
        assert usual(text).size > 0


def test_empty_table(documents):
    assert pack_documents(documents([]), PATH).collect() == []


def test_equal_rows_are_dealt_to_all_partitions(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("id"), F.lit(600).alias("length"))
    packed = pack(rows, ["id"], part_rows=1000, rounds=0)
    assert packed.count() == 20_000
    # the partition is part of a sequence's number
    assert packed.select((F.shiftright("sequence_id", 28)).alias("part")).distinct().count() == 20
