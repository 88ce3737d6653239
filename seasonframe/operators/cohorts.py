"""Membership, cohort conversion and per-group correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonframe.functions import as_names, exact_ratio, guarded_corr, join_on_same, require_columns
from seasonframe.operators.ordered import ROWS_PER_SLICE, prefix_sums
from seasonframe.sources import written_and_observed


def members_of_all(df: DataFrame, keys: str | Sequence[str], category: str, values: Sequence) -> DataFrame:
    """All rows of the key tuples that occur with every one of the category values."""
    names, wanted = as_names(keys), list(dict.fromkeys(values))
    require_columns(df, names, category)
    pairs = df.where(F.col(category).isin(wanted)).select(*names, category).distinct()
    complete = pairs.groupBy(*names).agg(F.count("*").alias("_n")).where(F.col("_n") == len(wanted))
    return df.join(complete.select(*names), names, "left_semi")


def grouped_corr(
    df: DataFrame, by: str | Sequence[str], pairs: dict[str, tuple[str, str]], digits: int | None = 4
) -> DataFrame:
    """Correlation per group for several column pairs; NULL where it is not defined."""
    names = as_names(by)
    require_columns(df, names, [c for pair in pairs.values() for c in pair])
    return df.groupBy(*names).agg(
        *(guarded_corr(F.col(x), F.col(y), digits).alias(n) for n, (x, y) in pairs.items())
    )


def grouped_rank_corr(
    df: DataFrame,
    by: str | Sequence[str],
    pairs: dict[str, tuple[str, str]],
    direction: str = "desc",
    digits: int | None = 4,
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Per group, the correlation of the ranks that rows have by one column and by another.

    Ranks are those of ``rank()`` over all rows of the group: rows that share a value share a rank, and NULL
    counts as the largest value. NULL results below two rows and where one side is constant.

    Rows are combined to distinct pairs of values first. Ranks come from the value counts and meet those
    pairs, never the rows, and the moments are taken around the mean ranks, so that they lose no digits.
    """
    names = as_names(by)
    require_columns(df, names, [c for pair in pairs.values() for c in pair])
    result = None
    for name, (x, y) in pairs.items():
        counts = df.groupBy(*names, F.col(x).alias("_x"), F.col(y).alias("_y")).agg(F.count("*").alias("_n"))
        counts, _ = written_and_observed(counts, rows=F.count(F.lit(1)))
        for side in ("_x", "_y"):
            values = counts.groupBy(*names, side).agg(F.sum("_n").alias("_peers"))
            through = prefix_sums(values, names, (side, direction), {"_through": F.col("_peers")}, rows_per_slice, derived=True)
            ranks = through.select(*names, side, (F.col("_through") - F.col("_peers") + 1).cast("double").alias(f"{side}_rank"))
            counts = join_on_same(counts, ranks, [*names, side], "left")
        means = counts.groupBy(*names).agg(
            F.sum("_n").alias("_rows"), *((F.sum(F.col("_n") * F.col(f"{s}_rank")) / F.sum("_n")).alias(f"{s}_mean") for s in ("_x", "_y"))
        )
        centred = join_on_same(counts, means, names, "left")
        dx, dy = (F.col(f"{s}_rank") - F.col(f"{s}_mean") for s in ("_x", "_y"))
        moments = centred.groupBy(*names).agg(
            *(F.sum(F.col("_n") * product).alias(m) for m, product in {"_xy": dx * dy, "_xx": dx * dx, "_yy": dy * dy}.items())
        )
        spread = F.nullif(F.sqrt(F.col("_xx")) * F.sqrt(F.col("_yy")), F.lit(0.0))
        corr = F.col("_xy") / spread
        corr = corr if digits is None else F.round(corr.cast(T.DecimalType(20, 15)), digits)
        one = moments.select(*names, corr.alias(name))
        result = one if result is None else join_on_same(result, one, names, "left")
    if result is None:
        raise ValueError("pairs must name at least one pair of columns")
    return result


def distinct_counts(df: DataFrame, by: str | Sequence[str], column: str, name: str = "n", method: str = "bitmap") -> DataFrame:
    """Exact number of distinct values of a whole-number column per group; NULL is no value.

    ``method="bitmap"`` sets one bit per value in maps of 32,768 neighbouring values, which are combined
    map-side: a group with very many rows reaches the shuffle as one map per task and neighbourhood, and no
    task holds a group's values. It suits keys, which lie densely; for values that lie far apart
    ``method="rows"`` combines equal rows instead.
    """
    names = as_names(by)
    require_columns(df, names, column)
    if not isinstance(df.schema[column].dataType, T.IntegralType):
        raise ValueError(f"{column!r} must be a whole-number column")
    if method == "rows":
        return df.groupBy(*names).agg(F.count_distinct(column).cast("bigint").alias(name))
    if method != "bitmap":
        raise ValueError("method must be 'bitmap' or 'rows'")
    value = F.col(column).cast("bigint")
    # bits of the value itself, so that negative ones have neighbourhoods of their own
    maps = df.groupBy(*names, F.shiftright(value, 15).alias("_near")).agg(
        F.bitmap_construct_agg(F.pmod(value, F.lit(1 << 15))).alias("_bits"), F.count(value).alias("_values")
    )
    size = F.when(F.col("_values") > 0, F.bitmap_count("_bits")).otherwise(F.lit(0))
    return maps.groupBy(*names).agg(F.sum(size).cast("bigint").alias(name))


def cohort(people: DataFrame, base: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The people whose key occurs in ``base``, each once per people row."""
    names = as_names(key)
    require_columns(people, names)
    require_columns(base, names)
    return people.join(base.select(*names).distinct(), names, "left_semi")


def group_counts(df: DataFrame, group: str, key: str, counts: dict[str, object]) -> DataFrame:
    """One row of key counts, one column per listed group value; None counts the NULL group."""
    require_columns(df, group, key)

    def count(value: object) -> Column:
        hit = F.col(group).isNull() if value is None else F.col(group) == F.lit(value)
        return F.count(F.when(hit, F.col(key)))

    return df.agg(*(count(v).alias(n) for n, v in counts.items()))


def cohort_conversion(
    people: DataFrame,
    base: DataFrame,
    winners: DataFrame,
    key: str,
    group: str,
    how: str = "left",
    distinct: bool = True,
    digits: int = 2,
    labels: Sequence[str] = (),
) -> DataFrame:
    """How many members of a base cohort are winners, per group (NULL is a group too).

    ``distinct`` counts a winner once however many winning rows there are; otherwise a
    member counts once per winning row. People have one row per key.
    ``how="full"`` returns the listing instead: every base member and every winner, with
    the ``labels`` and a ``won`` mark; a winner outside the base keeps NULL labels.
    """
    require_columns(people, key, group, labels)
    require_columns(winners, key)
    if how not in ("left", "full"):
        raise ValueError("how must be 'left' or 'full'")
    members = cohort(people, base, key).select(key, group, *labels)
    won = winners.groupBy(key).agg(F.count("*").alias("_times"))
    if how == "full":
        mark = F.lit(True).alias("won")
        if distinct:
            listing = members.join(won.select(key, mark), key, "full")
        else:
            # Every winning row is kept, so it must be the side that a hot key can split.
            alone = members.join(won, key, "left_anti")
            listing = winners.select(key, mark).join(members, key, "left")
            listing = listing.unionByName(alone, allowMissingColumns=True)
        return listing.select(key, group, *labels, F.coalesce("won", F.lit(False)).alias("won"))
    marked = members.select(key, group).join(won, key, "left")
    # Without distinct, a member counts once per winning row on both sides of the ratio.
    times = F.when(F.col("_times").isNotNull(), 1) if distinct else F.col("_times")
    return (
        marked.groupBy(group)
        .agg(F.sum(F.coalesce(times, F.lit(1))).alias("members"), F.coalesce(F.sum(times), F.lit(0)).alias("converted"))
        .withColumn("percent", exact_ratio(F.col("converted"), F.col("members"), digits, percent=True))
    )


def _outside(df: DataFrame, key: str, period: str, exclude_period, strict: bool) -> DataFrame:
    """Rows with a key; none at all when ``strict`` and an excluded row lacks its key."""
    rows = df.where(F.col(key).isNotNull())
    if strict and exclude_period is not None:
        unknown = df.where(F.col(key).isNull() & (F.col(period) == F.lit(exclude_period)))
        rows = rows.where(~unknown.exists())
    return rows


def _careers(rows: DataFrame, key: str, group: str, period: str, exclude_period) -> DataFrame:
    """Per key: first and last period, number of periods, smallest and largest group.

    ``rows`` are distinct seasons: the extremes of a text column cannot be kept in a hash
    table, so they are taken from combined rows and not from raw ones. One distinct count
    only; "exactly one group" is ``low = high``, "several" is ``low <> high``.
    """
    active = F.lit(False) if exclude_period is None else F.col(period) == F.lit(exclude_period)
    careers = rows.groupBy(key).agg(
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
        F.count_distinct(period).alias("periods"),
        F.min(group).alias("_low"),
        F.max(group).alias("_high"),
        F.coalesce(F.max(active), F.lit(False)).alias("_active"),
    )
    return careers.where(~F.col("_active"))


def single_group_members(
    df: DataFrame,
    key: str,
    group: str,
    period: str,
    min_periods: int = 1,
    exclude_period=None,
    strict: bool = False,
) -> DataFrame:
    """Keys with exactly one group over at least ``min_periods`` distinct periods.

    Keys with a row in ``exclude_period`` are left out. ``strict`` keeps the meaning of
    NOT IN: one excluded row with a NULL key empties the result.
    """
    require_columns(df, key, group, period)
    seasons = _outside(df, key, period, exclude_period, strict).select(key, group, period).distinct()
    careers = _careers(seasons, key, group, period, exclude_period)
    kept = careers.where((F.col("_low") == F.col("_high")) & (F.col("periods") >= min_periods))
    return kept.select(key, F.col("_low").alias(group), "periods", "first_period", "last_period")


def bookend_members(
    df: DataFrame,
    key: str,
    group: str,
    period: str,
    min_periods: int = 1,
    exclude_period=None,
    strict: bool = False,
    count: str = "keys",
) -> DataFrame:
    """How many keys start and end with the same group but have others as well.

    ``count="keys"`` counts each key once; ``"rows"`` counts the pairs of a first-period
    row and a last-period row that share a group.
    """
    require_columns(df, key, group, period)
    if count not in ("keys", "rows"):
        raise ValueError("count must be 'keys' or 'rows'")
    rows = _outside(df, key, period, exclude_period, strict)
    seasons = rows.groupBy(key, group, period).agg(F.count("*").alias("_rows"))
    careers = _careers(seasons, key, group, period, exclude_period)
    careers = careers.where((F.col("_low") != F.col("_high")) & (F.col("periods") >= min_periods))
    ends = (
        seasons.join(careers.select(key, "first_period", "last_period"), key)
        .where(F.col(group).isNotNull() & F.col(period).isin(F.col("first_period"), F.col("last_period")))
        .groupBy(key, group)
        .agg(
            F.sum(F.when(F.col(period) == F.col("first_period"), F.col("_rows"))).alias("_first"),
            F.sum(F.when(F.col(period) == F.col("last_period"), F.col("_rows"))).alias("_last"),
        )
        .where(F.col("_first").isNotNull() & F.col("_last").isNotNull())
    )
    if count == "keys":
        return ends.select(key).distinct().agg(F.count("*").alias("members"))
    return ends.agg(F.coalesce(F.sum(F.col("_first") * F.col("_last")), F.lit(0)).alias("members"))
