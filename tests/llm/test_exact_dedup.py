import hashlib
import random

import pytest

from seasonframe.llm.exact_dedup import chunks, exact_duplicates

RNG = random.Random(1)
WORDS = [("".join(RNG.choice("abcdehrst") for _ in range(RNG.randint(1, 9)))) for _ in range(300)]
LONG = " ".join(RNG.choice(WORDS) for _ in range(40_000))
ROWS = [
    (5, "same text"), (9, "same text"), (2, "same text"), (3, "Same text"), (4, "same text "),
    (6, None), (7, ""), (8, LONG), (10, LONG), (11, LONG + "x"), (12, "x" + LONG), (13, "x" * 50_000), (14, "x" * 50_000),
    (None, "only"), (None, "same text"), (15, "twice"), (15, "twice"), (16, "ß\n\U0001f600é"), (17, "ß\n\U0001f600é"),
]


def expected(rows, best=max):
    out = []
    for i, text in rows:
        same = [j for j, t in rows if (t or "") == (text or "")]
        known = [j for j in same if j is not None]
        keep = best(known) if known else None
        out.append((i, keep, len(same), i == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [64, 3])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_groups_equal_a_comparison_of_all_texts(documents, bits, keep):
    found = exact_duplicates(documents(ROWS), keep=keep, hash_bits=bits, min_chunk=8, max_chunk=64)
    got = sorted((tuple(r)[:5] for r in found.collect()), key=repr)
    assert got == expected(ROWS, {"largest": max, "smallest": min}[keep])


def test_chunks_join_to_the_text_and_follow_the_content(spark):
    from pyspark.sql import functions as F

    rows = [(LONG,), ("x" + LONG[:60_000],), ("",), ("x" * 10_000,), ("\n  é" * 3000,)]
    got = spark.createDataFrame(rows, "t string").select("t", chunks(F.col("t")).alias("c")).collect()
    assert all("".join(r.c) == r.t for r in got)
    shared = set(got[0].c) & set(got[1].c)
    assert len(shared) > 0.8 * len(got[1].c), "an insertion at the front must not move the later cuts"


def test_empty_table(documents):
    assert exact_duplicates(documents([])).collect() == []
