"""Extremes, leaders, peaks and ranks, with explicit rules for ties and NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonframe.functions import SortKey, as_names, exact_ratio, join_on_same, require_columns, sort_keys
from seasonframe.operators.ordered import GROUP_LIMIT, ROWS_PER_SLICE, prefix_sums, scan_rows

BROADCAST_ROWS = 100_000


def extreme_row(
    df: DataFrame,
    order_by: str,
    direction: str = "max",
    where: Column | str | None = None,
    exclude: Column | str | None = None,
    n: int = 1,
    ties: str = "all",
    tie_break: str | Sequence[str] = (),
    nulls: str = "last",
) -> DataFrame:
    """Whole rows that hold the ``n`` largest or smallest values of a column.

    ``ties="all"`` keeps every row whose rank is at most ``n``. ``ties="one"`` keeps
    exactly ``n`` rows, chosen by ``tie_break``. Rows where ``exclude`` is true, or
    cannot be decided, are left out. ``nulls="first"`` lets NULL win.
    """
    breakers = as_names(tie_break)
    require_columns(df, order_by, breakers)
    if direction not in ("max", "min"):
        raise ValueError("direction must be 'max' or 'min'")
    rows = df if where is None else df.where(where)
    if exclude is not None:
        rows = rows.where(~(F.expr(exclude) if isinstance(exclude, str) else exclude))
    key = SortKey(order_by, "desc" if direction == "max" else "asc", nulls)
    if ties == "one":
        if not breakers:
            raise ValueError("ties='one' needs tie_break columns that make the order total")
        return rows.orderBy(key.sort(), *(SortKey(b).sort() for b in breakers)).limit(n)
    if ties != "all":
        raise ValueError("ties must be 'all' or 'one'")
    # A row ranks in the first n exactly when its value is among the first n values.
    best = rows.select(order_by).orderBy(key.sort()).limit(n).distinct()
    if n <= BROADCAST_ROWS:
        best = F.broadcast(best)
    return join_on_same(rows, best, [order_by], "left_semi")


def leader_overlap(
    df: DataFrame,
    period: str,
    measure: str,
    flag: Column,
    method: str = "rank",
    denominator: int | str = "flagged_periods",
    digits: int = 2,
) -> DataFrame:
    """How many flagged rows also lead ``measure`` in their period, as count and percentage.

    ``denominator`` is a fixed number or ``"flagged_periods"`` (periods with any flagged
    row). ``method="rank"`` ranks NULL as the largest value, ``"max"`` ignores it.

    The period's best value is an aggregate, and only the flagged rows are then joined with
    it, so the other rows are combined map-side and never shuffled. Rows without a period
    are left out.
    """
    require_columns(df, period, measure)
    if method not in ("rank", "max"):
        raise ValueError("method must be 'rank' or 'max'")
    rows = df.where(F.col(period).isNotNull())
    empty = F.col(measure).isNull()
    best = rows.groupBy(period).agg(F.max(measure).alias("_best"), F.bool_or(empty).alias("_any_empty"))
    flagged = rows.where(flag).select(period, measure).join(best, period)
    at_best = F.coalesce(F.col(measure) == F.col("_best"), F.lit(False))
    leads = F.when(F.col("_any_empty"), empty).otherwise(at_best) if method == "rank" else at_best
    counted = flagged.groupBy(period).agg(F.count_if(leads).alias("_hits")).agg(
        F.coalesce(F.sum("_hits"), F.lit(0)).alias("hits"),
        F.count(F.lit(1)).alias("flagged_periods"),
    )
    periods = F.col("flagged_periods") if denominator == "flagged_periods" else F.lit(denominator).cast("bigint")
    return counted.select(
        "hits", periods.alias("periods"), exact_ratio(F.col("hits"), periods, digits, percent=True).alias("percent")
    )


def peak_in_period(
    facts: DataFrame,
    key: str,
    period: str,
    value: str,
    target,
    min_periods: int = 1,
    above=None,
) -> DataFrame:
    """Keys whose best period total is reached in the target period (ties count).

    ``min_periods`` counts periods with rows; ``above`` asks for a best total above it.
    """
    require_columns(facts, key, period, value)
    yearly = facts.groupBy(key, period).agg(F.sum(value).alias(value))
    career = yearly.groupBy(key).agg(
        F.max(value).alias("_best"),
        F.max(F.when(F.col(period) == F.lit(target), F.col(value))).alias(value),
        F.count(period).alias("periods"),
    )
    kept = career.where((F.col(value) == F.col("_best")) & (F.col("periods") >= min_periods))
    if above is not None:
        kept = kept.where(F.col(value) > F.lit(above))
    return kept.select(key, value, "periods")


def rankings(
    df: DataFrame,
    order_by,
    partition_by: str | Sequence[str] | None = None,
    tie_break: str | Sequence[str] = (),
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Row number, rank and dense rank side by side.

    Ranks follow ``order_by``; the row number also follows ``tie_break``, which must make
    the order total. Without ``partition_by`` the ranking is over the whole input.
    """
    group, keys, breakers = as_names(partition_by), sort_keys(order_by), sort_keys(as_names(tie_break))
    require_columns(df, group, [k.name for k in keys + breakers])
    if not breakers:
        raise ValueError("tie_break must name columns that make the order total")
    ranks = {"rank": "rank", "dense_rank": "dense_rank"}
    return scan_rows(df, group, keys, as_names(tie_break), {"row_number": F.lit(1)}, ranks, rows_per_slice)


def rank_tally(
    df: DataFrame,
    partition_by: str | Sequence[str],
    order_by,
    keys: str | Sequence[str],
    target_rank: int = 1,
    tally: str = "times",
) -> DataFrame:
    """How often each key holds a rank within its partition.

    Rows are counted once, per sort value and key. Only the first ``target_rank`` values per
    partition can hold the rank. The limit on the row number is applied by every task
    before the shuffle, so a large partition is never gathered. Spark does so for ranks up
    to GROUP_LIMIT; beyond, large partitions are cut.
    """
    group, sorts, names = as_names(partition_by), sort_keys(order_by), as_names(keys)
    columns = [k.name for k in sorts]
    require_columns(df, group, columns, names)
    if target_rank < 1:
        raise ValueError("target_rank must be at least 1")
    level = list(dict.fromkeys([*group, *columns]))
    w = Window.partitionBy(*group).orderBy(*(k.sort() for k in sorts))
    counts = df.groupBy(*dict.fromkeys([*level, *names])).agg(F.count("*").alias("_n"))
    levels = counts.groupBy(*level).agg(F.sum("_n").alias("_peers"))
    if target_rank <= GROUP_LIMIT:
        levels = levels.withColumn("_level", F.row_number().over(w)).where(F.col("_level") <= target_rank)
        through = levels.withColumn("_through", F.sum("_peers").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    else:
        through = prefix_sums(levels, group, sorts, {"_through": F.col("_peers")}, derived=True)
    at_rank = through.where(F.col("_through") - F.col("_peers") + 1 == target_rank)
    # levels are unique; a semi-join would be pushed below the counts and read the rows again
    held = join_on_same(counts, at_rank.select(*level), level, "inner")
    return held.groupBy(*names).agg(F.sum("_n").alias(tally))
