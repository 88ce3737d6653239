"""Results from combined rows: longest runs by words of bits, rank correlation, distinct counts by bitmaps."""

import random
from collections import defaultdict

import pytest
from helpers import rows
from pyspark.sql import functions as F

from seasonframe import operators as op


def longest(periods):
    best = now = 0
    for p in sorted(periods):
        now = now + 1 if p - 1 in periods else 1
        best = max(best, now)
    return best


@pytest.mark.parametrize("skip", [(), (3, 64, 65, 130, -1)])
def test_longest_runs(spark, skip):
    rng = random.Random(31)
    seen = defaultdict(set)
    made = []
    for entity in ["a", "b", "c", None]:
        for _ in range(12):
            start = rng.randint(-400, 400)
            for p in range(start, start + rng.choice([1, 2, 63, 64, 65, 130])):
                seen[entity].add(p)
                made += [(entity, p)] * rng.choice([1, 1, 3])
    made += [("d", p) for p in (0, 63, 64, 127, 128, 2**40, 2**40 + 1)] + [("e", None), ("f", -(2**62)), ("f", 5)]
    seen["d"], seen["f"] = {0, 63, 64, 127, 128, 2**40, 2**40 + 1}, {-(2**62), 5}
    df = spark.createDataFrame(made, "e string, p bigint").repartition(3)

    def index(p):
        return p - sum(s < p for s in skip)

    want = sorted(((e, longest({index(p) for p in ps if p not in skip})) for e, ps in seen.items()), key=repr)
    for rows_per_slice in (10, 10**6):
        assert rows(op.streaks(df, "e", "p", skip=skip, longest_only=True, rows_per_slice=rows_per_slice)) == want
    assert rows(op.streaks(df, "e", "p", skip=skip, longest_only=True, calendar=True)) == want


def test_rank_correlation_equals_ranks_joined_to_all_rows(spark):
    rng = random.Random(32)
    made = [(rng.choice(["g", "g", "h", None]), rng.choice([None, 1, 2, 2, 5]), rng.randint(0, 30), rng.random()) for _ in range(600)]
    made += [("one", 1, 1, 0.5), ("flat", 1, 1, 0.5), ("flat", 1, 2, 0.25)]
    df = spark.createDataFrame(made, "g string, x int, y int, z double")
    pairs = {"xy": ("x", "y"), "yz": ("y", "z")}
    for direction in ("asc", "desc"):
        ranked = df
        for c in ("x", "y", "z"):
            ranked = op.add_ranks(ranked, ["g"], (c, direction), f"{c}_rank", None, rows_per_slice=None)
        want = op.grouped_corr(ranked, "g", {n: (f"{a}_rank", f"{b}_rank") for n, (a, b) in pairs.items()}, digits=9)
        for rows_per_slice in (50, None):
            got = op.grouped_rank_corr(df, "g", pairs, direction, 9, rows_per_slice)
            assert rows(got) == rows(want)
    with pytest.raises(ValueError):
        op.grouped_rank_corr(df, "g", {})


def test_distinct_counts(spark):
    rng = random.Random(33)
    made = [(rng.choice(["a", "b", None]), rng.choice([None, -1, 0, 1, 32767, 32768, -32768, -32769, 2**62, -(2**62), rng.randint(-9, 9)])) for _ in range(500)]
    made += [("none", None), ("none", None)]
    df = spark.createDataFrame(made, "g string, v bigint").repartition(4)
    want = sorted(((g, len({v for h, v in made if h == g and v is not None})) for g in {h for h, _ in made}), key=repr)
    for method in ("bitmap", "rows"):
        assert rows(op.distinct_counts(df, "g", "v", method=method)) == want
    assert rows(op.distinct_counts(df.limit(0), "g", "v")) == []
    with pytest.raises(ValueError):
        op.distinct_counts(df.withColumn("v", F.col("v").cast("double")), "g", "v")
