"""Sliced scans must equal the plain windows, whatever is cut and wherever."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seasonframe.operators import add_ranks, over_neighbours, prefix_sums, rankings
from seasonframe.operators.ordered import ROWS_PER_SLICE, find_slices, over_distance
from seasonframe.functions import sort_keys


@pytest.fixture(scope="module")
def skewed(spark):
    """One group and one value each hold about a third of the rows; NULLs everywhere."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        group = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", None])
        value = 7 if rng.random() < 0.4 else rng.choice([None, *range(40)])
        label = rng.choice([None, "x", "y", "zz"])
        rows.append((group, value, label, rng.randint(-5, 5) if rng.random() < 0.9 else None, i))
    return spark.createDataFrame(rows, "g string, v int, s string, m int, id int").cache()


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    rows = [sorted(map(repr, df.select(columns).collect())) for df in (left, right)]
    assert rows[0] == rows[1]


ORDERS = [
    [("v", "asc"), "id"],
    [("v", "desc"), ("s", "asc", "first"), ("id", "desc")],
    [("s", "desc", "last"), ("v", "asc", "first"), "id"],
]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("group", [[], ["g"], ["g", "s"]])
def test_prefix_sums_sliced_equals_plain(skewed, group, order):
    sums = {"total": F.col("m"), "n": F.lit(1)}
    assert find_slices(skewed, group, sort_keys(order), 100) is not None
    same(prefix_sums(skewed, group, order, sums, 100), prefix_sums(skewed, group, order, sums, None))


@pytest.mark.parametrize("direction,nulls", [("asc", None), ("desc", None), ("desc", "last"), ("asc", "first")])
@pytest.mark.parametrize("group", [[], ["g"]])
def test_ranks_sliced_equal_plain(skewed, group, direction, nulls):
    order = ("v", direction, nulls)
    same(
        rankings(skewed, order, group, ["id"], rows_per_slice=60),
        rankings(skewed, order, group, ["id"], rows_per_slice=None),
    )
    same(add_ranks(skewed, group, order, rows_per_slice=50), add_ranks(skewed, group, order, rows_per_slice=None))


@pytest.mark.parametrize("group", [[], ["g"]])
@pytest.mark.parametrize("rows_per_slice", [40, 333])
def test_neighbours_sliced_equal_plain(skewed, group, rows_per_slice):
    def columns(w):
        return {
            "back": F.lag("id", 2).over(w),
            "next": F.lead("id").over(w),
            "moving": F.sum("m").over(w.rowsBetween(-2, 3)),
        }

    order = [("v", "desc"), "id"]
    same(
        over_neighbours(skewed, group, order, columns, 2, 3, rows_per_slice),
        over_neighbours(skewed, group, order, columns, 2, 3, None),
    )


def test_distance_blocks_equal_plain(spark):
    rng = random.Random(8)
    periods = rng.sample(range(-400, 400), 300)
    df = spark.createDataFrame([("e", p, rng.randint(0, 9)) for p in periods], "e string, p long, v int")

    def columns(w):
        return {"near": F.sum("v").over(w.rangeBetween(-3, 2)), "n": F.count("v").over(w.rangeBetween(-3, 2))}

    plain = Window.partitionBy("e").orderBy("p")
    expected = df.select("*", *(c.alias(n) for n, c in columns(plain).items()))
    same(over_distance(df, ["e"], "p", columns, 3, 2, 7), expected)


@pytest.mark.parametrize("kind", ["double", "decimal(12,3)", "date", "timestamp", "timestamp_ntz", "string", "boolean", "bigint"])
def test_sort_columns_of_every_type(spark, kind):
    numbers = F.when(F.col("id") % 11 == 0, None).otherwise((F.col("id") * 7919) % 101)
    value = {
        "double": F.when(F.col("id") % 13 == 0, F.lit(float("nan"))).otherwise(numbers / 7),
        "date": F.date_add(F.lit("1999-12-25").cast("date"), numbers.cast("int")),
        "timestamp": F.timestamp_seconds(numbers * 1000).cast("timestamp"),
        "timestamp_ntz": F.timestamp_seconds(numbers * 1000).cast("timestamp_ntz"),
        "string": F.concat(F.chr(numbers + 70), F.lit("é")),
        "boolean": numbers > 50,
        "bigint": numbers + (1 << 60),
    }.get(kind, numbers.cast(kind))
    df = spark.range(600).select("id", value.alias("v"), (F.col("id") % 3 == 0).alias("g"))
    for direction in ("asc", "desc"):
        order = [("v", direction), "id"]
        cut = prefix_sums(df, ["g"], order, {"n": F.lit(1)}, 30)
        same(cut, prefix_sums(df, ["g"], order, {"n": F.lit(1)}, None))


def test_small_input_is_not_cut(skewed):
    assert find_slices(skewed, ["g"], sort_keys(["v", "id"]), 3000) is None


@pytest.mark.parametrize("group", [[], ["g"]])
def test_slices_are_bounded_and_follow_the_order(skewed, group):
    keys = sort_keys([("v", "desc"), "id"])
    sliced = find_slices(skewed, group, keys, 100)
    sizes = sliced.rows.groupBy("__slice").count().collect()
    assert sum(r["count"] for r in sizes) == 3000 and max(r["count"] for r in sizes) <= 100
    assert 30 <= len(sizes) <= sliced.slices
    assert sliced.rows.select("__part").distinct().count() > 1
    by_row = [(r.g, r.v, r.id) for r in sliced.rows.orderBy("__row").collect()]
    order = [*(F.col(c).asc_nulls_first() for c in group), *(k.sort() for k in keys)]
    assert by_row == [(r.g, r.v, r.id) for r in skewed.orderBy(*order).collect()]
    if group:
        cut = {r.g for r in sliced.cut_groups().collect()}
        spread = sliced.rows.groupBy("g").agg(F.count_distinct("__slice").alias("n")).where("n > 1")
        assert cut == {r.g for r in spread.collect()}


def test_the_rows_above_are_computed_once(spark):
    rows = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    plan = prefix_sums(rows, [], ["k"], {"n": F.lit(1)}, 100)._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in plan and "ExistingRDD" in plan


def test_derived_rows_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    rows = spark.range(900).select(F.col("id").alias("k"), (F.col("id") % 5).alias("g"))
    counted = rows.mapInPandas(pass_on, "k bigint, g bigint")
    for rows_per_slice in (100, 10_000):
        before = made.value
        assert prefix_sums(counted, ["g"], "k", {"n": F.lit(1)}, rows_per_slice, derived=True).count() == 900
        assert made.value - before == 900


def test_one_pass_sizes_the_ranks(skewed, monkeypatch):
    import seasonframe.operators.ordered as module

    counted = []
    plain = module.find_slices
    monkeypatch.setattr(module, "find_slices", lambda *a: counted.append(a[4]) or plain(*a))
    add_ranks(skewed, ["g"], "id", rows_per_slice=100).collect()
    assert counted == [3000]


def test_sliced_plan_joins_by_key(skewed):
    plan = prefix_sums(skewed, [], ["v", "id"], {"n": F.lit(1)}, 100)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_task_gets_few_rows_however_well_they_pack(skewed, monkeypatch):
    """Slices are dealt by their number: by their bytes, one task would sort them all."""
    monkeypatch.setattr("seasonframe.operators.ordered.ROWS_PER_TASK", 300, raising=False)
    ranked = rankings(skewed, ("v", "asc"), ["g"], ["id"], rows_per_slice=100)
    tasks = ranked.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(t["count"] for t in tasks) == 3000
    assert max(t["count"] for t in tasks) <= 900


def test_groups_beyond_a_task_are_cut_without_being_told(spark):
    sliced = find_slices(spark.range(600_000), [], sort_keys("id"), ROWS_PER_SLICE)
    sizes = sliced.rows.groupBy(F.spark_partition_id()).count().collect()
    assert max(s["count"] for s in sizes) < 400_000
