"""Range joins and totals against plain comparison of every point with every range."""

import datetime
import random
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from seasonframe import operators as op
from seasonframe.operators import intervals


def brute(points, ranges):
    """Index pairs; points are (key, value), ranges (key, low, high)."""
    found = []
    for i, (k, low, high) in enumerate(ranges):
        for j, (p, v) in enumerate(points):
            if None not in (low, high, v, k, p) and k == p and low <= v <= high:
                found.append((i, j))
    return found


def made(seed):
    rng = random.Random(seed)
    size = [10, 1000, 2**40, 2**61][seed % 4]

    def value():
        return rng.choice([None, 7, 7, 7, *(rng.randint(-size, size) for _ in range(12))])

    points = [(rng.choice(["a", "a", "b", None]), value()) for _ in range(150)]
    ranges = []
    for _ in range(60):
        low = value()
        high = None if low is None else rng.choice([None, low, low - 1, low + 1, low + rng.randint(0, 9), low + rng.randint(0, size // 2), low + size // 3])
        ranges.append((rng.choice(["a", "b", "c", None]), low, high))
    ranges += [("a", -size, size), ("a", 0, 0), ("a", 0, 15), ("a", 16, 31), ("b", -1, 0), ("b", -16, 255), ranges[0], ranges[0]]
    return points, ranges


def tables(spark, points, ranges):
    p = spark.createDataFrame([(*r, j, j % 5 - 2) for j, r in enumerate(points)], "key string, v bigint, j int, amount int")
    r = spark.createDataFrame([(*r, i) for i, r in enumerate(ranges)], "key string, lo bigint, hi bigint, i int")
    return p.repartition(3), r


@pytest.mark.parametrize("seed", range(4))
def test_every_pair_meets_once(spark, seed):
    points, ranges = made(seed)
    p, r = tables(spark, points, ranges)
    want = brute(points, ranges)
    assert len(want) > 50
    found = op.range_join(p, r, "v", "lo", "hi", on="key", level_step=1 + seed)
    assert rows(found, "i", "j") == sorted(want, key=repr)
    assert found.columns == ["key", "lo", "hi", "i", "v", "j", "amount"]
    kept = op.range_join(p, r, "v", "lo", "hi", on="key", how="left")
    lone = [(i, None) for i in range(len(ranges)) if i not in {x for x, _ in want}]
    assert rows(kept, "i", "j") == sorted(want + lone, key=repr)
    assert lone


@pytest.mark.parametrize("seed", range(4))
def test_totals_equal_the_sums_of_the_pairs(spark, seed):
    points, ranges = made(seed)
    p, r = tables(spark, points, ranges)
    pairs = brute(points, ranges)
    want = []
    for i in range(len(ranges)):
        hits = [j % 5 - 2 for x, j in pairs if x == i]
        want.append((i, len(hits), sum(hits) if hits else None))
    for bits in (1, 4):
        found = op.range_totals(p, r, "v", "lo", "hi", {"total": "amount"}, on="key", tree_bits=bits)
        assert rows(found, "i", "n", "total") == sorted(want, key=repr)


def test_without_a_key_and_for_other_types(spark):
    days = [datetime.date(2000, 1, 1) + datetime.timedelta(days=d) for d in (0, 3, 3, 40, 400)]
    stamps = [datetime.datetime(2000, 1, 1, 0, 0, s) for s in (0, 1, 1, 30, 59)]
    for kind, values in (("date", days), ("timestamp", stamps), ("timestamp_ntz", stamps)):
        p = spark.createDataFrame([(v, Decimal(i)) for i, v in enumerate(values)], f"v {kind}, m decimal(9,2)")
        r = spark.createDataFrame([(values[1], values[3]), (values[0], values[0]), (values[4], values[0]), (None, values[4])], f"lo {kind}, hi {kind}")
        assert rows(op.range_totals(p, r, "v", "lo", "hi", {"m_sum": "m"}), "n", "m_sum") == sorted(
            [(3, Decimal("6.00")), (1, Decimal("0.00")), (0, None), (0, None)], key=repr
        )
        assert op.range_join(p, r, "v", "lo", "hi").count() == 4
        assert op.range_join(p, r, "v", "lo", "hi", how="left").count() == 6


def test_widths_beyond_63_bits_still_join(spark):
    top = 2**63 - 1
    p = spark.createDataFrame([(-top,), (0,), (top,)], "v bigint")
    r = spark.createDataFrame([(-top, top), (-1, top), (top, top)], "lo bigint, hi bigint")
    assert rows(op.range_join(p, r, "v", "lo", "hi"), "lo", "v") == sorted([(-top, -top), (-top, 0), (-top, top), (-1, 0), (-1, top), (top, top)], key=repr)


def test_empty_sides(spark):
    p, r = spark.createDataFrame([(1,)], "v int"), spark.createDataFrame([(0, 5)], "lo int, hi int")
    assert op.range_join(p, r.limit(0), "v", "lo", "hi", how="left").count() == 0
    assert rows(op.range_join(p.limit(0), r, "v", "lo", "hi", how="left")) == [(0, 5, None)]
    assert rows(op.range_totals(p.limit(0), r, "v", "lo", "hi", {"s": "v"})) == [(0, 5, 0, None)]


def test_what_is_refused(spark):
    p, r = spark.createDataFrame([(1, 1.5)], "v int, x double"), spark.createDataFrame([(0, 5)], "lo int, hi int")
    with pytest.raises(ValueError, match="share"):
        op.range_join(p.withColumnRenamed("x", "lo"), r, "v", "lo", "hi")
    with pytest.raises(ValueError, match="whole numbers"):
        op.range_join(p, r.selectExpr("cast(lo as double) lo", "cast(hi as double) hi"), "x", "lo", "hi")
    with pytest.raises(ValueError, match="one type"):
        op.range_join(p.selectExpr("date'2000-01-01' v"), r, "v", "lo", "hi")
    with pytest.raises(ValueError, match="cast it"):
        op.range_totals(p, r, "v", "lo", "hi", {"s": "x"})
    with pytest.raises(ValueError, match="already"):
        op.range_totals(p, r, "v", "lo", "hi", {"lo": "v"})


def test_no_plan_compares_all_pairs(spark):
    p, r = spark.range(1000).withColumnRenamed("id", "v"), spark.range(50).selectExpr("id lo", "id + id % 7 hi")
    for df in (op.range_join(p, r, "v", "lo", "hi", how="left"), op.range_totals(p, r, "v", "lo", "hi", {"s": "v"})):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_tiles_are_not_broadcast_by_an_estimate(spark):
    p, r = spark.range(1000).withColumnRenamed("id", "v"), spark.range(50).selectExpr("id lo", "id + id % 7 hi")
    plan = op.range_totals(p, r, "v", "lo", "hi", {"s": "v"})._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
    assert plan.count("SortMergeJoin") == 2


def cut_small(monkeypatch, crowded, block, pairs):
    for name, value in (("CROWDED", crowded), ("BLOCK", block), ("PAIRS_PER_TASK", pairs)):
        monkeypatch.setattr(intervals, name, value, raising=False)


@pytest.mark.parametrize("seed", range(2))
def test_every_pair_meets_once_in_cut_bins(spark, monkeypatch, seed):
    cut_small(monkeypatch, 2, 3 + seed, 100)
    points, ranges = made(seed)
    points += [("a", 7)] * 20
    p, r = tables(spark, points, ranges)
    want = brute(points, ranges)
    lone = [(i, None) for i in range(len(ranges)) if i not in {x for x, _ in want}]
    found = op.range_join(p, r, "v", "lo", "hi", on="key", how="left")
    assert rows(found, "i", "j") == sorted(want + lone, key=repr)
    assert found.columns == ["key", "lo", "hi", "i", "v", "j", "amount"]


def test_cut_bins_of_one_table_with_itself(spark, monkeypatch):
    cut_small(monkeypatch, 0, 2, 50)
    df = spark.createDataFrame([(i % 3, i // 2, i) for i in range(60)], "key int, v int, i int")
    r = df.select("key", F.col("i").alias("of"), (F.col("v") + 1).alias("lo"), (F.col("v") + F.col("i") % 9).alias("hi"))
    want = [(i, j) for i in range(60) for j in range(60) if i % 3 == j % 3 and i // 2 + 1 <= j // 2 <= i // 2 + i % 9]
    assert rows(op.range_join(df, r, "v", "lo", "hi", on="key"), "of", "i") == sorted(want, key=repr)


def test_tasks_follow_the_number_of_pairs(spark, monkeypatch):
    cut_small(monkeypatch, 8, 64, 20_000)
    p = spark.range(1000).selectExpr("id v")
    r = spark.range(200).selectExpr("id i", "id lo", "id + 700 hi")
    tasks = op.range_join(p, r, "v", "lo", "hi").groupBy(F.spark_partition_id()).count().collect()
    assert sum(t["count"] for t in tasks) == 200 * 701
    assert max(t["count"] for t in tasks) <= 60_000
