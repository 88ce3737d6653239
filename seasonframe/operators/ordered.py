"""Ordered scans (running sums, ranks, neighbour frames) without an unbounded group.

A Spark window sorts each of its partitions in one task, so an unpartitioned window, or
one over a key that holds a large share of the rows, does not scale. The functions here
check the size first. Small inputs use the plain window. Larger ones are dealt by ranges of the
full order, sorted, numbered where they lie and written once; every ``rows_per_slice`` rows of a
partition are a *slice*. The window runs per (group, slice), and what the earlier slices of
the group add up to is added: carries within a partition first, then carries of the partitions.
Where the ranges are cut decides only how the work is dealt, never the result.

The sort order must be total (end it with a unique column); otherwise the order among
equal rows is arbitrary, as in any SQL window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonframe.functions import SortKey, join_on_same, require_columns, sort_keys
from seasonframe.sources import written_and_observed, written_once

ROWS_PER_SLICE = 250_000
ROWS_PER_TASK = 250_000  # rows that one task sorts (or one slice, if that is larger), as long as there are no more than MAX_PARTS tasks
SLICES_PER_PART = 8  # at most, where slices are small
MAX_PARTS = 20_000
BROADCAST_CARRIES = 200_000
PERIODS_PER_BLOCK = 100_000
GROUP_LIMIT = 1_000  # largest "first k per group" that Spark applies before the shuffle

_ROW = "__row"
_SLICE = "__slice"
_PART = "__part"
_INDEX = "__index"
_BLOCK = "__block"
_PART_BITS = 33  # monotonically_increasing_id counts a partition's rows in its lower bits


@dataclass(frozen=True)
class Sliced:
    """Rows with their slice (the number of its first row, which ascends along the order) and partition, written once."""

    rows: DataFrame
    partition_by: list[str]
    slices: int
    tasks: int

    def dealt(self, rows: DataFrame, place: str = _SLICE) -> DataFrame:
        """Rows dealt by group and slice to a fixed number of tasks: by their packed bytes, many slices would be sorted in one."""
        return rows.repartition(self.tasks, *self.partition_by, place)

    def cut_groups(self) -> DataFrame:
        """The groups that lie in several slices: first or last in one, so at most two for each slice."""
        names = self.partition_by
        ends = self.rows.select(F.struct(*names).alias("_g"), _ROW, _SLICE).groupBy(_SLICE).agg(F.min_by("_g", _ROW).alias("_a"), F.max_by("_g", _ROW).alias("_b"))
        at_ends = ends.select(_SLICE, F.explode(F.array_distinct(F.array("_a", "_b"))).alias("_g"))
        several = at_ends.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        return several.select("_g.*")

    def hinted(self, few: DataFrame) -> DataFrame:
        """A table of a few rows for each slice at most, to be broadcast while there are few slices."""
        return F.broadcast(few) if self.slices <= BROADCAST_CARRIES else few


def has_few_periods(df: DataFrame, period: str, calendar: bool = False) -> bool:
    """True if the type bounds a series' length (dates and whole numbers of up to 16 bits), or if
    the caller declares that the periods are of a calendar (years, months, days)."""
    return calendar or isinstance(df.schema[period].dataType, (T.ByteType, T.ShortType, T.DateType))


def series_slice_rows(df: DataFrame, period: str, rows_per_slice: int | None, calendar: bool = False) -> int | None:
    """Slice size for rows that are unique per (entity, period); None means a plain window."""
    return None if has_few_periods(df, period, calendar) else rows_per_slice


def find_slices(
    df: DataFrame, partition_by: Sequence[str], keys: Sequence[SortKey], rows_per_slice: int | None, total: int | None = None
) -> Sliced | None:
    """The rows in slices of at most ``rows_per_slice``, or None when one slice holds them all.

    ``total`` is the number of rows where it is known; otherwise one job counts them. The rows are then
    read for the range bounds (a sample of bounded size, Spark's own) and to be written.
    """
    if rows_per_slice is None:
        return None
    total = df.count() if total is None else total
    if total <= rows_per_slice:
        return None
    per_part = rows_per_slice * max(1, min(SLICES_PER_PART, ROWS_PER_TASK // rows_per_slice))
    parts = min(MAX_PARTS, -(-total // per_part))
    order = [*(F.col(c).asc_nulls_first() for c in partition_by), *(k.sort() for k in keys)]
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    held = written_once(ranged.withColumn(_ROW, F.monotonically_increasing_id()))
    place = F.col(_ROW).bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    held = held.withColumn(_SLICE, F.col(_ROW) - place % rows_per_slice).withColumn(_PART, F.shiftright(_ROW, _PART_BITS))
    tasks = min(MAX_PARTS, -(-total // max(rows_per_slice, ROWS_PER_TASK)) * 2)  # twice as many, since slices meet by hash
    return Sliced(held, list(partition_by), parts + -(-total // rows_per_slice), tasks)


def _sum_of(here: Column, before: Column) -> Column:
    return F.when(before.isNull(), here).when(here.isNull(), before).otherwise(here + before)


def _earlier(
    totals: DataFrame, partition_by: Sequence[str], sums: Sequence[str] = (), maxima: Sequence[str] = (), lasts: Sequence[str] = ()
) -> DataFrame:
    """Adds ``<name>_before``: the sum, the maximum or the last of the group's earlier slices, NULL where there is none.

    In two levels, so that no window is longer than a partition's slices or the number of partitions.
    """
    group = [*partition_by]
    by_slice, by_part = Window.partitionBy(*group, _PART).orderBy(_SLICE), Window.partitionBy(*group).orderBy(_PART)
    before = (Window.unboundedPreceding, -1)
    parts = totals.groupBy(*group, _PART).agg(
        *(F.sum(c).alias(c) for c in sums), *(F.max(c).alias(c) for c in maxima), *(F.max_by(c, _SLICE).alias(c) for c in lasts)
    )
    parts = parts.select(
        *group,
        _PART,
        *(F.sum(c).over(by_part.rowsBetween(*before)).alias(f"{c}__part") for c in sums),
        *(F.max(c).over(by_part.rowsBetween(*before)).alias(f"{c}__part") for c in maxima),
        *(F.lag(c).over(by_part).alias(f"{c}__part") for c in lasts),
    )
    here = totals.select(
        "*",
        *(F.sum(c).over(by_slice.rowsBetween(*before)).alias(f"{c}_before") for c in sums),
        *(F.max(c).over(by_slice.rowsBetween(*before)).alias(f"{c}_before") for c in maxima),
        *(F.lag(c).over(by_slice).alias(f"{c}_before") for c in lasts),
        F.row_number().over(by_slice).alias("__place"),
    )
    joined = join_on_same(here, parts, [*group, _PART], "left")
    return joined.select(
        *totals.columns,
        *(_sum_of(F.col(f"{c}_before"), F.col(f"{c}__part")).alias(f"{c}_before") for c in sums),
        *(F.greatest(f"{c}_before", f"{c}__part").alias(f"{c}_before") for c in maxima),
        *(F.when(F.col("__place") == 1, F.col(f"{c}__part")).otherwise(F.col(f"{c}_before")).alias(f"{c}_before") for c in lasts),
    )


def _of_cut_groups(sliced: Sliced) -> DataFrame:
    """The rows whose group lies in several slices; only those need carries."""
    if not sliced.partition_by:
        return sliced.rows
    return join_on_same(sliced.rows, sliced.hinted(sliced.cut_groups()), sliced.partition_by, "left_semi")


def _prefix_sums(
    df: DataFrame,
    partition_by: Sequence[str],
    keys: Sequence[SortKey],
    sums: dict[str, Column],
    sliced: Sliced | None,
) -> DataFrame:
    sorts = [k.sort() for k in keys]
    so_far = (Window.unboundedPreceding, Window.currentRow)
    if sliced is None:
        w = Window.partitionBy(*partition_by).orderBy(*sorts).rowsBetween(*so_far)
        return df.select("*", *(F.sum(c).over(w).alias(n) for n, c in sums.items()))

    group = [*partition_by, _SLICE]
    in_slice = Window.partitionBy(*group).orderBy(*sorts).rowsBetween(*so_far)
    running = sliced.dealt(sliced.rows).select(*df.columns, _SLICE, *(F.sum(c).over(in_slice).alias(n) for n, c in sums.items()))
    totals = _of_cut_groups(sliced).groupBy(*group, _PART).agg(*(F.sum(c).alias(f"__{n}") for n, c in sums.items()))
    carries = _earlier(totals, partition_by, sums=[f"__{n}" for n in sums])
    # a slice that follows on in its group: fewer than there are slices
    carries = carries.where(" or ".join(f"`__{n}_before` is not null" for n in sums)).drop(_PART, *(f"__{n}" for n in sums))
    joined = join_on_same(running, sliced.hinted(carries), group, "left")

    def add(name: str) -> Column:
        return _sum_of(F.col(name), F.col(f"__{name}_before")).cast(running.schema[name].dataType).alias(name)

    return joined.select(*df.columns, *(add(n) for n in sums))


def prefix_sums(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by,
    sums: dict[str, Column],
    rows_per_slice: int | None = ROWS_PER_SLICE,
    total: int | None = None,
    derived: bool = False,
) -> DataFrame:
    """Add inclusive running sums per group in a total order; ``{"n": F.lit(1)}`` numbers rows.

    ``total`` is the number of rows where the caller knows it, which saves a count. ``derived`` says that
    the rows cost work to make (a grouping, a join): they are then written once and counted on the way,
    instead of being made again for the count, the range bounds and the scan.
    """
    keys = sort_keys(order_by)
    require_columns(df, partition_by, [k.name for k in keys])
    if derived and total is None and rows_per_slice is not None:
        df, seen = written_and_observed(df, rows=F.count(F.lit(1)))
        total = seen["rows"]
    return _prefix_sums(df, partition_by, keys, sums, find_slices(df, partition_by, keys, rows_per_slice, total))


def add_ranks(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by,
    rank: str | None = "rank",
    dense_rank: str | None = "dense_rank",
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Add rank and/or dense rank.

    For oversized groups the scan runs over the distinct sort values with their row counts,
    so rows that share one value never meet in one task, and the ranks are joined back. The combined
    values are written once, which tells both how many rows and how many values there are.
    """
    keys = sort_keys(order_by)
    require_columns(df, partition_by, [k.name for k in keys])
    outputs = {name: kind for name, kind in ((rank, "rank"), (dense_rank, "dense_rank")) if name}
    if rows_per_slice is None:
        return _ranks_by_window(df, partition_by, keys, outputs)
    group = list(dict.fromkeys([*partition_by, *(k.name for k in keys)]))
    peers = df.groupBy(*group).agg(F.count("*").alias("__peers"))
    peers, size = written_and_observed(peers, values=F.count(F.lit(1)), rows=F.sum("__peers"))
    if size["rows"] <= rows_per_slice:
        return _ranks_by_window(df, partition_by, keys, outputs)
    scans = {"__through": F.col("__peers"), "__dense": F.lit(1)}
    scanned = prefix_sums(peers, partition_by, keys, scans, rows_per_slice, size["values"])
    ranks = {"rank": F.col("__through") - F.col("__peers") + 1, "dense_rank": F.col("__dense")}
    ranked = scanned.select(*group, *(ranks[kind].cast("bigint").alias(n) for n, kind in outputs.items()))
    return join_on_same(df, ranked, group, "left")


def _ranks_by_window(
    df: DataFrame, partition_by: Sequence[str], keys: Sequence[SortKey], outputs: dict[str, str]
) -> DataFrame:
    w = Window.partitionBy(*partition_by).orderBy(*(k.sort() for k in keys))
    ranks = {"rank": F.rank(), "dense_rank": F.dense_rank()}
    return df.select("*", *(ranks[kind].over(w).cast("bigint").alias(n) for n, kind in outputs.items()))


def scan_rows(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by,
    tie_break: Sequence[str],
    sums: dict[str, Column],
    ranks: dict[str, str],
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Running sums in the order including ``tie_break``, with ranks along ``order_by`` alone.

    ``ranks`` maps output names to ``"rank"`` or ``"dense_rank"``. One size check serves both.
    """
    keys, breakers = sort_keys(order_by), sort_keys(list(tie_break))
    sliced = find_slices(df, partition_by, keys + breakers, rows_per_slice)
    if sliced is None:
        return _ranks_by_window(_prefix_sums(df, partition_by, keys + breakers, sums, None), partition_by, keys, ranks)
    return _scan_slices(df, partition_by, keys, breakers, sums, ranks, sliced)


def _scan_slices(
    df: DataFrame,
    partition_by: Sequence[str],
    keys: Sequence[SortKey],
    breakers: Sequence[SortKey],
    sums: dict[str, Column],
    ranks: dict[str, str],
    sliced: Sliced,
) -> DataFrame:
    """Running sums and ranks of cut groups in one pass over the slices.

    A slice passes on its sums, its number of rows and of distinct sort values, its first and
    last sort value and where the last one's rows start. So rows that share a value rank alike
    although a cut runs between them.
    """
    group, values = [*partition_by, _SLICE], F.struct(*(F.col(k.name) for k in keys))
    by_key = Window.partitionBy(*group).orderBy(*(k.sort() for k in keys))
    by_row = Window.partitionBy(*group).orderBy(*(k.sort() for k in [*keys, *breakers]))
    by_row = by_row.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = sliced.dealt(sliced.rows).select(
        *df.columns,
        _SLICE,
        *(F.sum(c).over(by_row).alias(n) for n, c in sums.items()),
        F.rank().over(by_key).cast("bigint").alias("__rank"),
        F.dense_rank().over(by_key).cast("bigint").alias("__dense"),
    )

    ends = sliced.dealt(_of_cut_groups(sliced)).select(
        *group,
        _PART,
        *(c.alias(f"__sum_{n}") for n, c in sums.items()),
        values.alias("__value"),
        F.rank().over(by_key).cast("bigint").alias("__rank"),
        F.dense_rank().over(by_key).cast("bigint").alias("__dense"),
    )
    ends = ends.groupBy(*group, _PART).agg(
        *(F.sum(f"__sum_{n}").alias(f"__sum_{n}") for n in sums),
        F.count("*").alias("__rows"),
        F.max("__dense").alias("__values"),
        F.max("__rank").alias("__last_start"),
        F.min_by("__value", "__rank").alias("__first"),
        F.max_by("__value", "__rank").alias("__last"),
    )
    carries = _earlier(ends, partition_by, sums=["__rows", *(f"__sum_{n}" for n in sums)], lasts=["__last"])
    # only slices that follow on in their group: fewer than there are slices
    joined = F.col("__rows_before").isNotNull() & F.col("__first").eqNullSafe(F.col("__last_before"))
    carries = carries.withColumn("__joined", joined)
    # a slice of one value that goes on from the last slice starts no run of its own
    goes_on = F.col("__joined") & (F.col("__values") == 1)
    carries = carries.withColumns(
        {
            "__start": F.when(~goes_on, F.coalesce("__rows_before", F.lit(0)) + F.col("__last_start")),
            "__new": F.col("__values") - F.col("__joined").cast("bigint"),
        }
    )
    carries = _earlier(carries, partition_by, sums=["__new"], maxima=["__start"]).where("__rows_before is not null")
    carries = carries.select(
        *group,
        *(f"__sum_{n}_before" for n in sums),
        "__rows_before",
        "__joined",
        "__start_before",
        (F.col("__new_before") - F.col("__joined").cast("bigint")).alias("__dense_before"),
    )
    both = join_on_same(scanned, sliced.hinted(carries), group, "left")

    def add(name: str) -> Column:
        return _sum_of(F.col(name), F.col(f"__sum_{name}_before")).cast(scanned.schema[name].dataType).alias(name)

    found = {
        "rank": F.when(F.col("__joined") & (F.col("__dense") == 1), F.col("__start_before")).otherwise(
            F.coalesce("__rows_before", F.lit(0)) + F.col("__rank")
        ),
        "dense_rank": F.coalesce("__dense_before", F.lit(0)) + F.col("__dense"),
    }
    return both.select(*df.columns, *(add(n) for n in sums), *(found[kind].cast("bigint").alias(n) for n, kind in ranks.items()))


def over_neighbours(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by,
    columns: Callable[[WindowSpec], dict[str, Column]],
    before: int,
    after: int,
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Add window columns that look at most ``before`` rows back and ``after`` rows ahead.

    ``columns`` receives the ordered window and returns named columns (lag, lead, or an
    aggregate over ``rowsBetween``). Oversized groups are cut into blocks by exact row
    number, and each block also receives copies of the rows its edge frames reach.
    """
    keys = sort_keys(order_by)
    require_columns(df, partition_by, [k.name for k in keys])
    sliced = find_slices(df, partition_by, keys, rows_per_slice)
    if sliced is None:
        w = Window.partitionBy(*partition_by).orderBy(*(k.sort() for k in keys))
        return df.select("*", *(c.alias(n) for n, c in columns(w).items()))

    size = max(rows_per_slice, before + 1, after + 1)
    indexed = _prefix_sums(df, partition_by, keys, {_INDEX: F.lit(1)}, sliced)
    home = F.call_function("div", F.col(_INDEX), F.lit(size))
    offset = F.col(_INDEX) % size
    reached = F.array(
        home,
        F.when(offset >= size - before, home + 1),
        F.when(offset < after, home - 1),
    )
    copies = sliced.dealt(indexed.withColumn(_BLOCK, F.explode(F.array_compact(reached))), _BLOCK)
    w = Window.partitionBy(*partition_by, _BLOCK).orderBy(_INDEX)
    framed = copies.select("*", *(c.alias(n) for n, c in columns(w).items()))
    return framed.where(F.col(_BLOCK) == home).drop(_INDEX, _BLOCK)


def over_distance(
    df: DataFrame,
    partition_by: Sequence[str],
    period: str,
    columns: Callable[[WindowSpec], dict[str, Column]],
    before: int,
    after: int,
    periods_per_block: int | None = PERIODS_PER_BLOCK,
) -> DataFrame:
    """Add window columns that reach ``before`` periods back and ``after`` ahead, by value.

    For whole-number periods, one row per group and period; ``columns`` uses
    ``rangeBetween``. Groups are cut into blocks of fixed period width, which bounds the
    rows per block without any sampling; a block also receives copies of the rows its edge
    frames reach. Rows without a period form a block of their own and see only each other,
    as in a plain window. None: the periods bound a group's length, so a plain window does.
    """
    require_columns(df, partition_by, period)
    sort = SortKey(period).sort()
    if periods_per_block is None:
        w = Window.partitionBy(*partition_by).orderBy(sort)
        return df.select("*", *(c.alias(n) for n, c in columns(w).items()))
    size = max(periods_per_block, before + 1, after + 1)
    value = F.col(period).cast("bigint")
    offset = F.pmod(value, F.lit(size))
    home = F.call_function("div", value - offset, F.lit(size))
    reached = F.array(
        home,
        F.when(offset >= size - before, home + 1),
        F.when(offset < after, home - 1),
    )
    copies = df.withColumn(_BLOCK, F.explode_outer(F.array_compact(reached)))
    w = Window.partitionBy(*partition_by, _BLOCK).orderBy(sort)
    framed = copies.select("*", *(c.alias(n) for n, c in columns(w).items()))
    return framed.where(F.col(_BLOCK).eqNullSafe(home)).drop(_BLOCK)
