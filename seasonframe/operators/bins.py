"""Grouping by value buckets and by fixed-width bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonframe.functions import decimal_places, exact_ratio, integer_ratio, require_columns

BROADCAST_BINS = 100_000


def bucket_agg(
    df: DataFrame,
    column: str,
    buckets: dict[str, Sequence],
    default: str | None,
    aggs: Sequence[Column],
    where: Column | str | None = None,
    label: str = "bucket",
) -> DataFrame:
    """Aggregate per bucket label; unlisted values and NULL fall into ``default``."""
    require_columns(df, column)
    if not buckets:
        raise ValueError("buckets must name at least one label")
    rows = df if where is None else df.where(where)
    case = None
    for name, values in buckets.items():
        hit = F.col(column).isin(list(values))
        case = F.when(hit, name) if case is None else case.when(hit, name)
    return rows.groupBy(case.otherwise(F.lit(default)).alias(label)).agg(*aggs)


def period_bins(spark: SparkSession, start: int, stop: int, width: int) -> DataFrame:
    """Bins ``[begin, end]`` of equal width from ``start``; ``stop`` lies past the last begin.

    One generator gives the begin and arithmetic the end, so the two stay in step.
    """
    if width < 1 or stop <= start:
        raise ValueError("need width >= 1 and stop > start")
    return spark.range(start, stop, width).select(
        F.col("id").alias("begin"), (F.col("id") + (width - 1)).alias("end")
    )


def spine_ratio(
    df: DataFrame,
    on: str,
    start: int,
    stop: int,
    width: int,
    num: str,
    den: str,
    den_divisor: int = 1,
    digits: int = 2,
    ratio: str = "ratio",
) -> DataFrame:
    """Ratio of totals per bin ``[begin, begin + width - 1]``; a bin without rows stays, with NULL.

    ``start`` is the first bin's begin and ``stop`` lies past the last bin. The facts are
    aggregated by their bin number first, so the join to the bins is a small equi-join
    and not a range join. The divided denominator is cut to a whole number.
    """
    require_columns(df, on, num, den)
    scale = decimal_places(df, num, den)
    bins = period_bins(df.sparkSession, start, stop, width)
    n_bins = -(-(stop - start) // width)
    end = start + n_bins * width
    begin = F.call_function("div", F.col(on) - start, F.lit(width)) * width + start
    totals = (
        df.where((F.col(on) >= start) & (F.col(on) < end))
        .groupBy(begin.cast("bigint").alias("begin"))
        .agg(F.sum(num).alias("_num"), F.sum(den).alias("_den"))
    )
    if n_bins <= BROADCAST_BINS:
        totals = F.broadcast(totals)
    share = integer_ratio(F.col("_den"), F.lit(den_divisor)) if den_divisor != 1 else F.col("_den")
    # a column of its own, since the ratio refers to it several times
    return bins.join(totals, "begin", "left").withColumn("_share", share).select(
        "begin",
        "end",
        exact_ratio(F.col("_num"), F.col("_share"), digits, scale=scale).alias(ratio),
    )
