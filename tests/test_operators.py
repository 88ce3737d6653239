"""Operator edge cases, parameters and properties that the statements do not reach."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from helpers import dec, rows
from pyspark.sql import functions as F

from seasonframe import operators as op
from seasonframe.functions import (
    SortKey,
    exact_ratio,
    guarded_corr,
    integer_ratio,
    join_on_same,
    require_columns,
    row_differs,
    sort_keys,
)


def test_exact_ratio_equals_half_up(spark):
    rng = random.Random(3)
    pairs = [(rng.randint(-10**9, 10**9), rng.choice([-1, 1]) * rng.randint(1, 400)) for _ in range(300)]
    pairs += [(n, 8) for n in range(-20, 20)] + [(1, 200), (-1, 200), (3, 200), (0, 7)]
    df = spark.createDataFrame(pairs, "n long, d long").select("n", "d", exact_ratio(F.col("n"), F.col("d")).alias("r"))
    for n, d, got in df.collect():
        exact = Decimal(n * 1000000) / Decimal(d * 1000000)
        assert got == exact.quantize(Decimal("0.01"), ROUND_HALF_UP), (n, d)


def test_ratios_by_zero_and_null_are_null(spark):
    df = spark.createDataFrame([(1, 0), (None, 2), (3, None), (0, 0)], "n int, d int")
    got = df.select(exact_ratio(F.col("n"), F.col("d")), integer_ratio(F.col("n"), F.col("d")))
    assert rows(got) == [(None, None)] * 4


def test_integer_ratio_cuts_towards_zero(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2)], "n int, d int")
    assert rows(df.select(integer_ratio(F.col("n"), F.col("d")))) == [(-3,), (3,)]


def test_exact_ratio_of_decimals(spark):
    df = spark.createDataFrame([(dec("10.05"), 2), (dec("-10.05"), 2)], "n decimal(19,2), d int")
    assert rows(df.select(exact_ratio(F.col("n"), F.col("d"), 2, scale=2))) == [(dec("-5.03"),), (dec("5.03"),)]


def test_binary_fractions_are_refused(spark):
    df = spark.createDataFrame([("e", 1, 0.5)], "e string, p int, v double")
    with pytest.raises(ValueError, match="double"):
        op.centered_anomaly(df, "e", "p", "v")
    exact = df.withColumn("v", F.col("v").cast("decimal(9,2)"))
    assert rows(op.centered_anomaly(exact, "e", "p", "v"), "window_mean") == [(dec("0.5000"),)]


def test_row_differs_is_three_valued(spark):
    names = [("Barry", "Bonds"), (None, "Bonds"), ("Barry", None), (None, "X"), ("Al", "Bonds"), (None, None)]
    df = spark.createDataFrame(names, "f string, l string")
    assert rows(df.where(row_differs(["f", "l"], ["Barry", "Bonds"]))) == [("Al", "Bonds"), (None, "X")]


def test_guarded_corr_uses_complete_pairs(spark):
    data = [("one", 1.0, 2.0), ("flat", 0.1, 1.0), ("flat", 0.1, 2.0), ("flat", 0.1, 3.0)]
    data += [("neg", 1.0, 3.0), ("neg", 2.0, 2.0), ("neg", 3.0, 1.0), ("neg", None, 99.0), ("neg", 50.0, None)]
    df = spark.createDataFrame(data, "g string, x double, y double")
    got = dict(rows(df.groupBy("g").agg(guarded_corr(F.col("x"), F.col("y")))))
    assert got == {"one": None, "flat": None, "neg": dec("-1.0000")}


def test_sort_keys_default_null_is_largest():
    assert [k.nulls_first for k in sort_keys(["a", ("b", "desc"), ("c", "desc", "last"), SortKey("d")])] == [
        False, True, False, False,
    ]
    with pytest.raises(ValueError):
        sort_keys(("a", "down"))


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([(1,)], "A int")
    require_columns(df, "a")
    with pytest.raises(ValueError, match="nope"):
        op.extreme_row(df, "nope")


def test_join_on_same_matches_null(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (None, "z")], "k int, v string")
    counts = df.groupBy("k").agg(F.count("*").alias("n"))
    assert rows(join_on_same(df, counts, ["k"], "left")) == [(1, "x", 1), (None, "y", 2), (None, "z", 2)]


@pytest.mark.parametrize("strict,expected", [(False, [("a",)]), (True, [])])
def test_null_key_in_the_excluded_set(spark, strict, expected):
    df = spark.createDataFrame(
        [("a", "X", 1), ("a", "X", 2), ("b", "X", 1), ("b", "X", 9), (None, "X", 9)], "k string, g string, p int"
    )
    got = op.single_group_members(df, "k", "g", "p", 1, 9, strict=strict)
    assert rows(got, "k") == expected


def test_members_of_all_needs_every_value(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("a", "z"), ("b", "x"), ("b", "x"), (None, "x"), (None, "y")], "k string, c string"
    )
    assert rows(op.members_of_all(df, "k", "c", ["x", "y", "y"])) == [("a", "x"), ("a", "y"), ("a", "z")]


def test_extreme_row_n_largest_with_ties(spark):
    df = spark.createDataFrame([(1, 9), (2, 9), (3, 8), (4, 8), (5, 7), (6, None)], "id int, v int")
    assert rows(op.extreme_row(df, "v", n=3), "id") == [(1,), (2,), (3,), (4,)]
    assert rows(op.extreme_row(df, "v", n=3, ties="one", tie_break="id"), "id") == [(1,), (2,), (3,)]
    assert rows(op.extreme_row(df, "v", "min", n=1, nulls="first"), "id") == [(6,)]
    with pytest.raises(ValueError):
        op.extreme_row(df, "v", ties="one")


def test_rank_tally_counts_rows_before_the_rank(spark):
    df = spark.createDataFrame([("g", "a", 1), ("g", "b", 1), ("g", "c", 2), ("g", "d", 2), ("g", "e", 3)], "g string, k string, v int")

    def tally(rank):
        return rows(op.rank_tally(df, "g", "v", "k", rank))

    assert tally(1) == [("a", 1), ("b", 1)] and tally(2) == []
    assert tally(3) == [("c", 1), ("d", 1)] and tally(5) == [("e", 1)]


def test_ranks_and_steps_beyond_the_group_limit(spark):
    df = spark.range(1500).selectExpr("'g' AS g", "id AS k", "id AS v", "1 AS one")
    assert rows(op.rank_tally(df, "g", "v", "k", 1200)) == [(1199, 1)]
    rows_ = df.unionByName(spark.range(1500).selectExpr("'h' AS g", "id AS k", "id AS v", "2 AS one"))
    assert rows(op.pace_vs_benchmark(rows_, "g", "v", "one", "g", at_step=1200)) == [(1200, "h", 2400, 1200)]


def test_rank_tally_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id AS k", "id AS v")
    plan = op.rank_tally(df, "g", "v", "k", 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_spine_ratio_plan_has_no_nested_loop(spark):
    df = spark.createDataFrame([(1, 1, 1)], "p int, n int, d int")
    plan = op.spine_ratio(df, "p", 0, 100, 10, "n", "d")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "BroadcastHashJoin" in plan


def test_spine_ratio_uneven_last_bin(spark):
    df = spark.createDataFrame([(0, 1, 1), (9, 3, 2), (11, 5, 1), (12, 9, 1)], "p int, n int, d int")
    got = rows(op.spine_ratio(df, "p", 0, 11, 4, "n", "d"))
    assert got == [(0, 3, 1), (4, 7, None), (8, 11, dec("2.67"))]


def test_running_total_over_rows_is_total_order(spark):
    df = spark.createDataFrame([("e", 1, 5, 1), ("e", 1, 7, 2), ("e", 2, None, 3), ("e", 2, 1, 4)], "e string, p int, v int, id int")
    got = op.running_total(df, "e", "p", "v", frame="rows", tie_break="id")
    assert rows(got, "id", "running_total", "period_number") == [(1, 5, 1), (2, 12, 1), (3, 12, 2), (4, 13, 2)]
    with pytest.raises(ValueError):
        op.running_total(df, "e", "p", "v", frame="rows")


@pytest.fixture(scope="module")
def long_series(spark):
    """One entity with most of the periods; the period type gives no bound on the length."""
    rng = random.Random(11)
    data = [("hot", p, rng.randint(0, 30)) for p in rng.sample(range(900), 600)]
    data += [(e, p, rng.randint(0, 30)) for e in "abc" for p in rng.sample(range(900), 40)]
    return spark.createDataFrame(data, "e string, p long, v int").cache()


SERIES = {
    "next": lambda df, n: op.next_period_change(df, "e", "p", "v", rows_per_slice=n),
    "running": lambda df, n: op.running_total(df, "e", "p", "v", rows_per_slice=n),
    "anomaly_rows": lambda df, n: op.centered_anomaly(df, "e", "p", "v", mode="rows", rows_per_slice=n),
    "streaks": lambda df, n: op.streaks(df, "e", "p", where="v > 3", skip=[100, 500], rows_per_slice=n),
    "before_after": lambda df, n: op.before_after(df, "e", "p", F.col("v") > 20, "v", mode="rows", rows_per_slice=n),
    "repeats": lambda df, n: op.repeat_winners(df, "p", "v", tie_break="e", require_adjacent=False, rows_per_slice=n),
    "pace_step": lambda df, n: op.pace_vs_benchmark(
        df, "e", "p", "v", "a", at_step=7, aggregate=False, tie_break="v", rows_per_slice=n
    ),
}


@pytest.mark.parametrize("name", SERIES)
def test_long_series_cut_equals_whole(long_series, name):
    cut = rows(SERIES[name](long_series, 90))
    assert cut == rows(SERIES[name](long_series, 10_000_000)) and cut


def test_range_modes_equal_on_long_and_int_periods(long_series):
    short = long_series.withColumn("p", F.col("p").cast("int"))
    for build in (
        lambda df: op.centered_anomaly(df, "e", "p", "v"),
        lambda df: op.before_after(df, "e", "p", F.col("v") > 20, "v", pre=2, post=(0, 1)),
    ):
        assert rows(build(long_series)) == rows(build(short))


def test_streak_positions_run_from_one(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.choice("abcd"), rng.randint(0, 60)) for _ in range(120)], "e string, p int")
    placed = op.streaks(df, "e", "p")
    seen = {}
    for e, p, streak in sorted(map(tuple, placed.collect())):
        assert streak == seen.get((e, p - 1), 0) + 1
        seen[e, p] = streak
    longest = dict(rows(op.streaks(df, "e", "p", longest_only=True)))
    assert longest == {e: max(s for (x, _), s in seen.items() if x == e) for e in longest}


def test_conversion_groups_add_up(spark):
    people = spark.createDataFrame([(i, [None, "x", "y"][i % 3]) for i in range(30)], "k int, g string")
    base = spark.createDataFrame([(i // 2,) for i in range(40)], "k int")
    winners = spark.createDataFrame([(0,), (0,), (3,), (4,), (25,)], "k int")
    got = op.cohort_conversion(people, base, winners, "k", "g")
    assert sum(r[1] for r in rows(got)) == op.cohort(people, base, "k").count() == 20
    assert rows(got) == [("x", 7, 1, dec("14.29")), ("y", 6, 0, dec("0.00")), (None, 7, 2, dec("28.57"))]


def test_result_does_not_depend_on_partitioning(spark):
    rng = random.Random(4)
    df = spark.createDataFrame(
        [(rng.choice("abc"), rng.choice("XYZ"), rng.randint(1990, 2000), rng.randint(0, 9), i) for i in range(300)],
        "k string, g string, p int, v int, id int",
    )
    for build in (
        lambda d: op.bookend_members(d, "k", "g", "p", count="rows"),
        lambda d: op.leader_overlap(d, "p", "v", F.col("g") == "X"),
        lambda d: op.rankings(d, ("v", "desc"), "k", "id"),
        lambda d: op.running_total(d, "k", "p", "v", frame="rows", tie_break="id"),
    ):
        assert rows(build(df.repartition(1))) == rows(build(df.repartition(7, "id")))


def test_next_period_needs_whole_number_periods(spark):
    df = spark.createDataFrame([("e", 1.5, 1)], "e string, p double, v int")
    with pytest.raises(ValueError, match="whole-number"):
        op.next_period_change(df, "e", "p", "v")
    assert rows(op.next_period_change(df, "e", "p", "v", require_adjacent=False), "next_v") == [(None,)]


def test_bad_modes_are_refused(spark):
    df = spark.createDataFrame([("e", 1, 1)], "e string, p int, v int")
    for call in (
        lambda: op.centered_anomaly(df, "e", "p", "v", mode="weeks"),
        lambda: op.leader_overlap(df, "p", "v", F.lit(True), method="guess"),
        lambda: op.bookend_members(df, "e", "v", "p", count="all"),
        lambda: op.streaks(df, "e", "p", skipped_rows="keep"),
        lambda: op.pace_vs_benchmark(df, "e", "p", "v", "e"),
        lambda: op.spine_ratio(df, "p", 5, 5, 1, "v", "v"),
        lambda: op.unit_cost(df, df, "e", "v", "v", "v", 1, qualify="all"),
        lambda: op.cohort_conversion(df, df, df, "e", "v", how="right"),
    ):
        with pytest.raises(ValueError):
            call()


def test_season_tables_are_read_with_declared_types(spark, tmp_path):
    from seasonframe.sources import SEASON_SCHEMAS, read_season_tables, register_views, season_tables_from_catalog

    for name, ddl in SEASON_SCHEMAS.items():
        spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    tables = read_season_tables(spark, str(tmp_path))
    assert set(tables) == set(SEASON_SCHEMAS)
    assert tables["salaries"].schema["salary"].dataType.simpleString() == "decimal(19,2)"

    register_views(tables)
    named = season_tables_from_catalog(spark)
    assert {n: t.schema for n, t in named.items()} == {n: t.schema for n, t in tables.items()}


def test_period_bins_stay_in_step(spark):
    assert rows(op.period_bins(spark, 1920, 2011, 10))[:2] == [(1920, 1929), (1930, 1939)]
    assert op.period_bins(spark, 1920, 2011, 10).count() == 10
