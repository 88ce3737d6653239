"""Operators over an ordered series per entity.

Unless a parameter says otherwise, rows are first summed to one per (entity, period).
With dates, small whole numbers or declared calendar periods (``calendar=True``: years, months
or days of any whole-number type) the length of a series is then bounded by the number of
distinct periods, however many rows the entity holds, and a plain window is used. For any
other period, and for row-level frames, group sizes are checked and oversized groups are
cut (see ``seasonframe.operators.ordered``).

Rows with a NULL period are rows of their own: they sort last in row frames, see only each
other in range frames, and belong to no streak.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonframe.functions import as_names, decimal_places, exact_ratio, join_on_same, require_columns, sort_keys
from seasonframe.operators.ordered import (
    GROUP_LIMIT,
    PERIODS_PER_BLOCK,
    ROWS_PER_SLICE,
    has_few_periods,
    over_distance,
    over_neighbours,
    prefix_sums,
    scan_rows,
    series_slice_rows,
)


def _per_period(df: DataFrame, entity: Sequence[str], period: str, value: str) -> DataFrame:
    return df.groupBy(*entity, period).agg(F.sum(value).alias(value))


def _require_whole_number(df: DataFrame, period: str) -> None:
    if not isinstance(df.schema[period].dataType, T.IntegralType):
        raise ValueError(f"{period!r} must be a whole-number column, so that adjacent periods differ by 1")


def next_period_change(
    df: DataFrame,
    entity: str | Sequence[str],
    period: str,
    values: str | Sequence[str],
    where: Column | str | None = None,
    require_adjacent: bool = True,
    summary: bool = False,
    digits: int = 0,
    keep: str | Sequence[str] = (),
    rows_per_slice: int | None = ROWS_PER_SLICE,
    calendar: bool = False,
) -> DataFrame:
    """Each row's values, those of the entity's next row, and the differences.

    The input has one row per (entity, period). ``where`` picks the reported rows after
    the next row is known, so the next row itself need not match. ``require_adjacent``
    accepts the next row only when its period is the following one. ``summary`` returns
    the average change of each value instead, rounded to ``digits``; rows without a next
    row do not count.
    """
    group, columns, kept = as_names(entity), as_names(values), as_names(keep)
    require_columns(df, group, period, columns, kept)
    if require_adjacent:
        _require_whole_number(df, period)

    def following(w: WindowSpec) -> dict[str, Column]:
        ahead = {"next_period": F.lead(period).over(w)}
        return ahead | {f"next_{c}": F.lead(c).over(w) for c in columns}

    slice_rows = series_slice_rows(df, period, rows_per_slice, calendar)
    framed = over_neighbours(df, group, period, following, 0, 1, slice_rows)
    rows = framed if where is None else framed.where(where)
    if require_adjacent:
        adjacent = F.col("next_period") == F.col(period) + 1
        nexts = ["next_period", *(f"next_{c}" for c in columns)]
        rows = rows.withColumns({n: F.when(adjacent, F.col(n)) for n in nexts})
    changes = {f"{c}_change": F.col(f"next_{c}") - F.col(c) for c in columns}
    if summary:
        scale = decimal_places(df, *columns)
        parts = [e for n, c in changes.items() for e in (F.sum(c).alias(f"_s_{n}"), F.count(c).alias(f"_n_{n}"))]
        means = [exact_ratio(F.col(f"_s_{n}"), F.col(f"_n_{n}"), digits, scale=scale) for n in changes]
        return rows.agg(*parts).select(*(m.alias(f"avg_{n}") for n, m in zip(changes, means)))
    nexts = ["next_period", *(f"next_{c}" for c in columns)]
    return rows.select(*group, period, *kept, *columns, *nexts, *(c.alias(n) for n, c in changes.items()))


def running_total(
    df: DataFrame,
    entity: str | Sequence[str] | None,
    period: str,
    value: str,
    frame: str = "range",
    tie_break: str | Sequence[str] = (),
    per_row: bool = False,
    rows_per_slice: int | None = ROWS_PER_SLICE,
    calendar: bool = False,
) -> DataFrame:
    """Running sum and period number (distinct periods so far) along each entity's series.

    ``frame="range"``: rows of one period share the total at its end. The result has one
    row per (entity, period), or with ``per_row`` one per input row.
    ``frame="rows"``: one row per input row, in the total order (period, tie_break).
    """
    group, breakers = as_names(entity), as_names(tie_break)
    require_columns(df, group, period, value, breakers)
    if frame == "rows":
        if not breakers:
            raise ValueError("frame='rows' needs tie_break columns that make the order total")
        sums, ranks = {"running_total": F.col(value)}, {"period_number": "dense_rank"}
        return scan_rows(df, group, period, breakers, sums, ranks, rows_per_slice)
    if frame != "range":
        raise ValueError("frame must be 'range' or 'rows'")
    series = _per_period(df, group, period, value)
    sums = {"running_total": F.col(value), "period_number": F.lit(1)}
    slice_rows = series_slice_rows(series, period, rows_per_slice, calendar)
    totals = prefix_sums(series, group, period, sums, slice_rows, derived=True)
    if not per_row:
        return totals
    return join_on_same(df, totals.drop(value), [*group, period], "left")


def pace_vs_benchmark(
    df: DataFrame,
    entity: str,
    period: str,
    value: str,
    benchmark,
    at_period=None,
    at_step: int | None = None,
    aggregate: bool = True,
    tie_break: str | Sequence[str] = (),
    exclude: Column | None = None,
    per_benchmark_row: bool = False,
    rows_per_slice: int | None = ROWS_PER_SLICE,
    calendar: bool = False,
) -> DataFrame:
    """Entities whose running total is ahead of one entity's total at the same step.

    The step is the number of distinct periods so far. Give ``at_period`` (compare where
    everyone stands in that period) or ``at_step`` (compare after so many periods). The
    benchmark entity is left out by key; ``exclude`` leaves out further rows.
    ``aggregate=False`` compares the others' single rows along (period, tie_break) instead
    of their periods. The benchmark has one total per step, the one at the period's end, so
    that a benchmark with many rows does not pair them all with everyone else's;
    ``per_benchmark_row`` compares with its running total at each of its rows instead.

    In the aggregated form the totals need no window over whole series: rows up to the
    period are summed, or only the first ``at_step`` periods of each entity are kept.
    """
    require_columns(df, entity, period, value, as_names(tie_break))
    if (at_period is None) == (at_step is None):
        raise ValueError("give either at_period or at_step")
    is_benchmark = F.col(entity) == F.lit(benchmark)
    others = df.where(~is_benchmark)
    if exclude is not None:
        others = others.where(~exclude)
    if per_benchmark_row:
        pace = running_total(
            df.where(is_benchmark), entity, period, value, "rows", tie_break, rows_per_slice=rows_per_slice
        ).withColumnRenamed("period_number", "step")
        if at_step is not None:
            pace = pace.where(F.col("step") == at_step)
    elif at_period is not None:
        pace = running_total(
            df.where(is_benchmark), entity, period, value, rows_per_slice=rows_per_slice, calendar=calendar
        )
        pace = pace.withColumnRenamed("period_number", "step")
    else:
        pace = _first_periods(df.where(is_benchmark), entity, period, value, at_step, rows_per_slice)
    pace = pace.select("step", F.col("running_total").alias("benchmark_total"))
    if not per_benchmark_row and (at_step is not None or has_few_periods(df, period, calendar)):
        pace = F.broadcast(pace)  # one row, or one per distinct year or day

    if at_period is not None:
        others = others.where(F.col(period) <= F.lit(at_period))  # later rows have no say
    if not aggregate:
        standing = running_total(others, entity, period, value, "rows", tie_break, rows_per_slice=rows_per_slice)
        reached = F.col("period_number") == at_step if at_period is None else F.col(period) == F.lit(at_period)
        standing = standing.where(reached).select(entity, F.col("period_number").alias("step"), "running_total")
    elif at_period is not None:
        so_far = _per_period(others, [entity], period, value)
        standing = so_far.groupBy(entity).agg(
            F.count("*").alias("step"), F.sum(value).alias("running_total"), F.max(period).alias("_last")
        )
        standing = standing.where(F.col("_last") == F.lit(at_period)).drop("_last")
    else:
        standing = _first_periods(others, entity, period, value, at_step, rows_per_slice)
    return standing.join(pace, "step").where(F.col("running_total") > F.col("benchmark_total"))


def _first_periods(
    df: DataFrame, entity: str, period: str, value: str, steps: int, rows_per_slice: int | None
) -> DataFrame:
    """Totals after exactly so many periods; every task keeps only an entity's first ones."""
    if steps > GROUP_LIMIT:
        totals = running_total(df, entity, period, value, rows_per_slice=rows_per_slice)
        totals = totals.withColumnRenamed("period_number", "step")
        return totals.where(F.col("step") == steps).select(entity, "step", "running_total")
    w = Window.partitionBy(entity).orderBy(*(k.sort() for k in sort_keys(period)))
    series = _per_period(df, [entity], period, value)
    early = series.withColumn("_step", F.row_number().over(w)).where(F.col("_step") <= steps)
    totals = early.groupBy(entity).agg(
        F.max("_step").cast("bigint").alias("step"), F.sum(value).alias("running_total")
    )
    return totals.where(F.col("step") == steps)


def centered_anomaly(
    df: DataFrame,
    entity: str | Sequence[str],
    period: str,
    value: str,
    before: int = 2,
    after: int = 2,
    mode: str = "range",
    digits: int = 4,
    rows_per_slice: int | None = ROWS_PER_SLICE,
    calendar: bool = False,
) -> DataFrame:
    """Each period's total, the mean of the window around it, and the signed and absolute gap.

    ``mode="range"`` measures the window in true period distance, ``"rows"`` in rows, so
    that a gap in the series pulls in more distant periods. Windows shrink at the ends.
    """
    group = as_names(entity)
    require_columns(df, group, period, value)
    series = _per_period(df, group, period, value)
    slice_rows = series_slice_rows(series, period, rows_per_slice, calendar)
    scale = decimal_places(df, value)

    def stats(frame: WindowSpec) -> dict[str, Column]:
        return {"_sum": F.sum(value).over(frame), "_n": F.count(value).over(frame)}

    if mode == "range":
        _require_whole_number(df, period)
        framed = over_distance(
            series, group, period, lambda w: stats(w.rangeBetween(-before, after)), before, after, None if slice_rows is None else PERIODS_PER_BLOCK
        )
    elif mode == "rows":
        framed = over_neighbours(
            series, group, period, lambda w: stats(w.rowsBetween(-before, after)), before, after, slice_rows
        )
    else:
        raise ValueError("mode must be 'range' or 'rows'")
    # columns of their own, since what follows refers to them several times
    framed = framed.withColumn("_over", F.col(value) * F.col("_n") - F.col("_sum"))
    framed = framed.withColumn("_gap", exact_ratio(F.col("_over"), F.col("_n"), digits, scale=scale))
    gap = F.col("_gap")
    return framed.select(
        *group,
        period,
        value,
        exact_ratio(F.col("_sum"), F.col("_n"), digits, scale=scale).alias("window_mean"),
        gap.alias("gap"),
        F.abs(gap).alias("abs_gap"),
    )


def repeat_winners(
    df: DataFrame,
    period: str,
    winner: str,
    where: Column | str | None = None,
    require_adjacent: bool = True,
    tie_break: str | Sequence[str] = (),
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """How many winning rows repeat the winner of the previous winning row.

    ``require_adjacent`` asks that the previous row be of the period just before. Name
    ``tie_break`` columns if a period can have several winning rows.
    """
    breakers = as_names(tie_break)
    require_columns(df, period, winner, breakers)
    if require_adjacent:
        _require_whole_number(df, period)
    rows = df if where is None else df.where(where)
    rows = rows.select(*dict.fromkeys([period, winner, *breakers]))

    def previous(w: WindowSpec) -> dict[str, Column]:
        return {"_winner": F.lag(winner).over(w), "_period": F.lag(period).over(w)}

    framed = over_neighbours(rows, [], [period, *breakers], previous, 1, 0, rows_per_slice)
    repeated = F.col(winner) == F.col("_winner")
    if require_adjacent:
        repeated = repeated & (F.col(period) == F.col("_period") + 1)
    return framed.agg(F.count_if(repeated).alias("repeats"))


def streaks(
    df: DataFrame,
    entity: str | Sequence[str],
    period: str,
    where: Column | str | None = None,
    skip: Sequence[int] = (),
    skipped_rows: str = "drop",
    longest_only: bool = False,
    position_by: str | Sequence[str] | None = None,
    rows_per_slice: int | None = ROWS_PER_SLICE,
    calendar: bool = False,
) -> DataFrame:
    """Position of every period in its entity's run of consecutive periods.

    Periods in ``skip`` do not break a run for anyone. Rows that lie in a skipped period
    are dropped; with ``skipped_rows="count"`` they form a run of their own and still use
    up a position, which breaks the run they lie in. ``longest_only`` returns the length
    of each entity's longest run. Rows without a period belong to no run and are left out.

    ``position_by`` numbers the positions by other columns than the runs: a run is told apart by
    its entity's rows, and its positions count within (``position_by``, run), which entities
    may share. The result then has ``position_by`` as well.
    """
    group, places = as_names(entity), as_names(position_by)
    require_columns(df, group, period, places)
    if places and longest_only:
        raise ValueError("longest_only counts the runs of entities; leave out position_by")
    _require_whole_number(df, period)
    if skipped_rows not in ("drop", "count"):
        raise ValueError("skipped_rows must be 'drop' or 'count'")
    rows = df if where is None else df.where(where)
    seen = rows.where(F.col(period).isNotNull()).select(*dict.fromkeys([*group, *places, period]))
    rows = seen.distinct()
    skipped = np.array(sorted(set(skip)), dtype=np.int64)
    in_skip = F.array_contains(F.lit(skipped), F.col(period).cast("bigint")) if len(skipped) else F.lit(False)
    if skipped_rows == "drop":
        rows, seen = rows.where(~in_skip), seen.where(~in_skip)
    index = F.col(period)
    if len(skipped):
        index = index - F.size(F.filter(F.lit(skipped), lambda gap: gap < F.col(period)))
    slice_rows = series_slice_rows(rows, period, rows_per_slice, calendar)
    if longest_only and slice_rows is not None and (skipped_rows == "drop" or not len(skipped)):
        return _longest_runs(seen.select(*group, index.cast("bigint").alias("_index")), group, slice_rows)
    order = [period, *(c for c in places if c not in group)]
    numbered = prefix_sums(rows, group, order, {"_n": F.lit(1)}, slice_rows, derived=True)
    numbered = numbered.withColumn("_run", F.when(~in_skip, index - F.col("_n")))
    if places:
        tie_break = [c for c in group if c not in places]
        positioned = prefix_sums(numbered, [*places, "_run"], [period, *tie_break], {"streak": F.lit(1)}, rows_per_slice, derived=True)
        return positioned.select(*dict.fromkeys([*group, *places]), period, "streak")
    run = [*group, "_run"]
    if longest_only:
        lengths = numbered.groupBy(*run).agg(F.count("*").alias("_length"))
        return lengths.groupBy(*group).agg(F.max("_length").alias("longest_streak"))
    positioned = prefix_sums(numbered, run, period, {"streak": F.lit(1)}, slice_rows, derived=True)
    return positioned.select(*group, period, "streak")


def _longest_runs(rows: DataFrame, group: Sequence[str], slice_rows: int) -> DataFrame:
    """The longest run of consecutive ``_index`` per group; repeated rows count once.

    Periods are combined map-side into words of 64 bits, and a word is cut into its runs of set bits. So
    the ordered scan has a row for each run within a word, not for each period, and joins the runs that meet
    at the edges of words.
    """
    word = F.shiftright("_index", 6)
    place = F.pmod(F.col("_index"), F.lit(64)).cast("int")
    words = rows.groupBy(*group, word.alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), place)).alias("_bits")
    )
    bits = F.col("_bits")
    first = bits.bitwiseAND(F.bitwise_not(F.shiftleft(bits, 1)))
    last = bits.bitwiseAND(F.bitwise_not(F.shiftrightunsigned(bits, 1)))

    def places(of: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(of, i) == 1)

    runs = words.select(*group, "_word", F.inline(F.arrays_zip(places(first).alias("_a"), places(last).alias("_b"))))
    runs = runs.select(*group, (F.col("_word") * 64 + F.col("_a")).alias("_start"), (F.col("_word") * 64 + F.col("_b")).alias("_end"))
    framed = over_neighbours(runs, group, "_start", lambda w: {"_before": F.lag("_end").over(w)}, 1, 0, slice_rows)
    begins = F.coalesce(F.col("_before") + 1 != F.col("_start"), F.lit(True)).cast("bigint")
    numbered = prefix_sums(framed, group, "_start", {"_run": begins}, slice_rows, derived=True)
    lengths = numbered.groupBy(*group, "_run").agg((F.max("_end") - F.min("_start") + 1).alias("_length"))
    return lengths.groupBy(*group).agg(F.max("_length").alias("longest_streak"))


def before_after(
    df: DataFrame,
    entity: str | Sequence[str],
    period: str,
    event: Column,
    value: str,
    pre: int = 3,
    post: tuple[int, int] = (1, 3),
    mode: str = "range",
    digits: int = 4,
    rows_per_slice: int | None = ROWS_PER_SLICE,
    calendar: bool = False,
) -> DataFrame:
    """Mean of the ``pre`` periods before an event against periods ``post[0]..post[1]`` after it.

    The input has one row per (entity, period); ``event`` marks the event rows. Events
    without a complete stretch on both sides are left out. ``mode`` counts in true period
    distance (``"range"``) or in rows (``"rows"``).
    """
    group = as_names(entity)
    require_columns(df, group, period, value)
    low, high = post
    if pre < 1 or not 0 <= low <= high:
        raise ValueError("need pre >= 1 and 0 <= post[0] <= post[1]")
    scale = decimal_places(df, value)
    marked = df.select(*group, period, value, event.alias("_event"))

    def stretches(frames: dict[str, WindowSpec]) -> dict[str, Column]:
        return {
            f"{name}_{side}": agg(value).over(frame)
            for side, frame in frames.items()
            for name, agg in (("_sum", F.sum), ("_n", F.count))
        }

    if mode == "range":
        _require_whole_number(df, period)
        framed = over_distance(
            marked,
            group,
            period,
            lambda w: stretches({"pre": w.rangeBetween(-pre, -1), "post": w.rangeBetween(low, high)}),
            pre,
            high,
            None if has_few_periods(df, period, calendar) else PERIODS_PER_BLOCK,
        )
    elif mode == "rows":
        framed = over_neighbours(
            marked,
            group,
            period,
            lambda w: stretches({"pre": w.rowsBetween(-pre, -1), "post": w.rowsBetween(low, high)}),
            pre,
            high,
            series_slice_rows(df, period, rows_per_slice, calendar),
        )
    else:
        raise ValueError("mode must be 'range' or 'rows'")
    whole = framed.where(F.col("_event") & (F.col("_n_pre") == pre) & (F.col("_n_post") == high - low + 1))
    pre_mean = exact_ratio(F.col("_sum_pre"), F.col("_n_pre"), digits, scale=scale)
    post_mean = exact_ratio(F.col("_sum_post"), F.col("_n_post"), digits, scale=scale)
    whole = whole.withColumns(
        {"_both": F.col("_n_pre") * F.col("_n_post"), "_change": F.col("_sum_post") * F.col("_n_pre") - F.col("_sum_pre") * F.col("_n_post")}
    )
    return whole.select(
        *group,
        period,
        pre_mean.alias("pre_mean"),
        post_mean.alias("post_mean"),
        exact_ratio(F.col("_change"), F.col("_both"), digits, scale=scale).alias("change"),
    )
