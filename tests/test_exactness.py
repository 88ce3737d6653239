"""Exact ratios at every size, missing periods, long skip lists, and the plans of cut groups."""

from decimal import ROUND_HALF_UP, Decimal, getcontext

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonframe import operators as op
from seasonframe.functions import exact_ratio, integer_ratio
from seasonframe.plans.inputs import nation_years, order_years

getcontext().prec = 80
SF_DIR = "/root/testdata/sf0.01"


def numbers(scale):
    import random

    rng = random.Random(scale)
    sizes = [1, 3, 9, 10, 14, 15, 16, 18, 19, 20, 22, 25, 28, 30]
    out = [(10**16, 1), (3 * 10**15, 1), (-3 * 10**19, 1), (3 * 10**20, 1), (0, 7), (5, 0), (1, 2), (-1, 2), (5, 10**30), (10**30, 10**30 - 1)]
    out += [(rng.choice([-1, 1]) * rng.randrange(10**s), rng.choice([-1, 1]) * rng.randrange(1, 10 ** rng.choice(sizes))) for s in sizes for _ in range(4)]
    return [(Decimal(a).scaleb(-scale), Decimal(b).scaleb(-scale)) for a, b in out]


@pytest.mark.parametrize("scale", [0, 2, 6])
def test_ratios_are_exact_or_raise(spark, scale):
    pairs = numbers(scale)
    df = spark.createDataFrame(list(enumerate(pairs)), f"i int, p struct<n:decimal(38,{scale}),d:decimal(38,{scale})>")
    exact = raised = 0
    for digits in (0, 2, 4, 6):
        for percent in (False, True):
            ratio = exact_ratio(F.col("p.n"), F.col("p.d"), digits, percent, scale)
            for i, (n, d) in enumerate(pairs):
                want = None if d == 0 else (n * (100 if percent else 1) / d).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)
                if want is not None and (abs(want) >= 10**28 or abs(d) >= 10**22):
                    continue  # below, where it may raise
                exact += 1
                pairs[i] = (n, d)
            small = [i for i, (n, d) in enumerate(pairs) if d == 0 or (abs(n * 100 / d) < 10**28 and abs(d) < 10**22)]
            got = {r.i: r.r for r in df.where(F.col("i").isin(small)).select("i", ratio.alias("r")).collect()}
            for i in small:
                n, d = pairs[i]
                want = None if d == 0 else (n * (100 if percent else 1) / d).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)
                assert got[i] == want, (n, d, digits, percent)
    for i in range(len(pairs)):
        if i in small:
            continue
        n, d = pairs[i]
        try:
            found = df.where(F.col("i") == i).select(exact_ratio(F.col("p.n"), F.col("p.d"), 4, False, scale).alias("r")).first().r
        except Exception:
            raised += 1
        else:
            assert found == (n / d).quantize(Decimal("0.0001"), ROUND_HALF_UP)
    assert exact > 100


def test_whole_quotients_fit_or_raise(spark):
    df = spark.createDataFrame([(Decimal(7), Decimal(-2)), (Decimal(2**63 - 1), Decimal(1)), (Decimal(5), Decimal(0)), (None, Decimal(1))], "n decimal(38,0), d decimal(38,0)")
    got = df.select(integer_ratio(F.col("n"), F.col("d")).alias("r")).collect()
    assert [r.r for r in got] == [-3, 2**63 - 1, None, None]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            too_large = spark.createDataFrame([(Decimal(2**63), Decimal(1))], "n decimal(38,0), d decimal(38,0)")
            with pytest.raises(Exception):
                too_large.select(integer_ratio(F.col("n"), F.col("d"))).collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")


ROWS = [("a", 2000, 5), ("a", 2001, 7), ("a", 2003, 1), ("a", None, 9), ("b", 2001, 2), ("b", None, 4), (None, 2001, 3), ("c", 2005, None)]


@pytest.mark.parametrize("kind", ["smallint", "int", "bigint"])
def test_period_types_do_not_change_results(spark, kind):
    df = spark.createDataFrame(ROWS, "e string, p int, v int").withColumn("p", F.col("p").cast(kind))
    wide = df.withColumn("p", F.col("p").cast("bigint"))

    def results(rows_in, **options):
        return [
            rows(op.centered_anomaly(rows_in, "e", "p", "v", mode="range")),
            rows(op.centered_anomaly(rows_in, "e", "p", "v", mode="rows", **options)),
            rows(op.running_total(rows_in, "e", "p", "v", **options)),
            rows(op.next_period_change(rows_in, "e", "p", "v", **options)),
            rows(op.streaks(rows_in, "e", "p", **options)),
            rows(op.before_after(rows_in, "e", "p", F.lit(True), "v", pre=1, post=(1, 1))),
        ]

    assert results(df) == results(wide) == results(df, rows_per_slice=2) == results(df, calendar=True)
    assert len(rows(op.centered_anomaly(df, "e", "p", "v"))) == len(ROWS), "rows without a period stay"


def test_thousands_of_skipped_periods(spark):
    periods = [p for p in range(0, 20_000) if p % 4]
    df = spark.createDataFrame([("a", p) for p in periods[:3000]], "e string, p int")
    got = rows(op.streaks(df, "e", "p", skip=range(0, 20_000, 4), longest_only=True))
    assert got == [("a", 3000)]


def test_positions_by_another_column(spark):
    df = spark.createDataFrame([("t", "A", 1950), ("t", "B", 1951), ("t", "A", 1952), ("u", "C", 1950), ("w", "C", 1950)], "team string, name string, p int")
    assert rows(op.streaks(df, "team", "p", position_by="name"), "name", "p", "streak") == [
        ("A", 1950, 1), ("A", 1952, 2), ("B", 1951, 1), ("C", 1950, 1), ("C", 1950, 2),
    ]
    with pytest.raises(ValueError, match="position_by"):
        op.streaks(df, "team", "p", position_by="name", longest_only=True)


def single_partition_windows(df):
    """Windows on a single-partition exchange of anything but totals per slice or partition, or few distinct values."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines, found = plan.split("\n"), []
    for i, line in enumerate(lines):
        if "Window [" in line:
            below = " ".join(lines[i + 1 : i + 4])
            if "Exchange SinglePartition" in below and not any(x in line for x in ("__part", "__slice", "__peers")):
                found.append(line)
    return found


def test_cut_groups_leave_no_window_over_all_rows(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("v"))
    assert single_partition_windows(op.rankings(df, "v", tie_break="k")), "the plain form has one, so the search works"
    for cut in (
        op.rankings(df, ("v", "desc"), tie_break="k", rows_per_slice=100),
        op.running_total(df, None, "k", "v", rows_per_slice=100),
        op.running_total(df.withColumn("k", F.col("k").cast("int")), None, "k", "v", rows_per_slice=100),
        op.repeat_winners(df, "k", "v", require_adjacent=False, rows_per_slice=100),
        op.add_ranks(df, [], "v", rows_per_slice=100),
    ):
        assert not single_partition_windows(cut)


def test_year_filters_reach_the_reader(spark):
    import os

    if not os.path.isdir(SF_DIR):
        pytest.skip("driver tables not present")
    from seasonframe.plans.queries import QUERIES

    for name in ("season_rankings", "busiest_untitled_season", "ahead_of_pace_in_year", "ahead_of_pace_by_row"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.split("\n") if "FileScan" in line and "o_orderdate" in line]
        assert scans and all("GreaterThanOrEqual(o_orderdate" in x or "LessThan(o_orderdate" in x or "EqualTo(o_custkey,1)]" in x for x in scans), name
    assert nation_years(spark, SF_DIR, 1997, 1997).select("yr").distinct().count() == 1
    assert isinstance(order_years(spark, SF_DIR).schema["yr"].dataType, T.ShortType)


def test_tally_scans_its_rows_once(spark):
    import os

    if not os.path.isdir(SF_DIR):
        pytest.skip("driver tables not present")
    from seasonframe.plans.queries import QUERIES

    df = QUERIES["smallest_line_tally"](spark, SF_DIR)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") - plan.count("ReusedExchange") <= 1
