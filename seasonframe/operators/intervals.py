"""Joins of points with the closed ranges that hold them, whatever the ranges' widths and overlaps.

A plain BETWEEN join compares every point with every range. Here both meet by equal keys. For single
rows, a range is filed under the one or two bins of the power of two that is as wide as itself, and a point looks
into its bin of each width in use; the bounds are then checked exactly. For totals, points are first
combined per value and per bin of a tree, and a range is put together from the few whole bins that
tile it, so that neither overlaps nor hot values multiply rows.

Bounds and points are whole numbers, dates or timestamps. A point without a value lies in no range,
and a range with a missing bound, or whose end lies before its begin, holds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonframe.functions import as_names, decimal_places, join_on_same, require_columns
from seasonframe.sources import written_and_observed, written_once

#: Powers of two between the bin widths of single-row joins: 1 files ranges tightest, more makes a point look less often.
LEVEL_STEP = 2
#: A bin of the widest level with more points than this is crowded: pairs are then counted, and dealt by their number.
CROWDED = 64
#: Points, or ranges, of a bin that meet in one piece, where the bin is cut.
BLOCK = 2_048
#: Pairs that one task compares, and rows that it sorts, about.
PAIRS_PER_TASK = 8_000_000
ROWS_PER_TASK = 1_000_000
MAX_TASKS = 100_000
BROADCAST_BINS = 200_000
#: Bits of a tree level of totals: a range is tiled by less than 2 * 2**bits bins a level.
TREE_BITS = 4


def _unit(df: DataFrame, name: str) -> Column:
    """The column as a bigint in its smallest unit, so that neighbouring values differ by 1."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, T.TimestampNTZType):
        # by its fields, since a zone may lack or repeat an hour
        seconds = F.unix_date(F.to_date(name)).cast("bigint") * 86_400 + F.hour(name) * 3600 + F.minute(name) * 60
        return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), F.col(name)) * 1_000_000).cast("bigint")
    raise ValueError(f"{name!r} is {kind.simpleString()}; ranges need whole numbers, dates or timestamps")


def _check(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, on: Sequence[str]) -> None:
    require_columns(points, point, on)
    require_columns(ranges, low, high, on)
    kinds = {points.schema[point].dataType, ranges.schema[low].dataType, ranges.schema[high].dataType}
    if len(kinds) > 1 and not all(isinstance(k, T.IntegralType) for k in kinds):
        raise ValueError("points and bounds must be of one type, or all whole numbers")


def _bin(value: Column, level: Column) -> Column:
    """The bin of a value among bins of 2**level, numbered from below zero up."""
    return F.call_function("shiftright", value, level)


def _filed(ranges: DataFrame, low: str, high: str, step: int) -> DataFrame:
    """Adds ``_lo``, ``_hi`` and ``_level``: the power of two as wide as the range, up to a multiple of ``step``; 63 at most."""
    bounded = ranges.withColumns({"_lo": _unit(ranges, low), "_hi": _unit(ranges, high)}).where(F.col("_lo") <= F.col("_hi"))
    width = F.try_subtract("_hi", "_lo")  # NULL where it is beyond 63 bits
    bits = F.when(width > 0, F.length(F.bin(width))).otherwise(F.lit(0))
    level = F.ceil(bits / step) * step
    return bounded.withColumn("_level", F.when(width.isNull(), 63).otherwise(F.least(level, F.lit(63))).cast("int"))


def _is_crowded(points: DataFrame, point: str, names: Sequence[str], level: int) -> bool:
    """Whether many points share a bin of the widest level in use; no narrower one holds more."""
    binned = points.select(*names, _bin(_unit(points, point), F.lit(level)).alias("_bin")).where(F.col("_bin").isNotNull())
    return not binned.groupBy(*names, "_bin").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > CROWDED).isEmpty()


def _cut(filed: DataFrame, looking: DataFrame, keys: list[str], rows: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides dealt so that a task compares a bounded number of pairs, and the columns on which they meet.

    A bin of many points or ranges is cut into blocks of either by the numbers of their rows, and every block
    of points meets every block of ranges in a piece of its own. The tasks follow the number of copies and of
    pairs, which the bytes of the two sides do not tell.
    """
    held = looking.groupBy(*keys).agg(F.count(F.lit(1)).alias("_points")).join(filed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ranges")), keys)
    cut = (F.col("_points") > BLOCK) | (F.col("_ranges") > BLOCK)
    pairs = F.sum(F.col("_points").cast("double") * F.col("_ranges"))
    copies = F.sum(F.col("_points") * F.ceil(F.col("_ranges") / BLOCK).cast("double") + F.col("_ranges") * F.ceil(F.col("_points") / BLOCK))
    held, seen = written_and_observed(held, pairs=pairs, copies=copies, bins=F.count_if(cut))
    copying = min(MAX_TASKS, int((seen["copies"] + rows) // ROWS_PER_TASK) + 1)
    tasks = min(MAX_TASKS, int(seen["pairs"] // PAIRS_PER_TASK) + copying)
    blocks = held.where(cut).select(*keys, *(F.ceil(F.col(n) / BLOCK).cast("bigint").alias(n) for n in ("_points", "_ranges")))
    blocks = F.broadcast(blocks) if seen["bins"] <= BROADCAST_BINS else blocks

    def dealt(side: DataFrame, number: str, own: str, other: str) -> DataFrame:
        side = join_on_same(side.repartition(copying, number), blocks, keys, "left").withColumns({n: F.coalesce(n, F.lit(1).cast("bigint")) for n in ("_points", "_ranges")})
        side = side.withColumn(f"{own}_block", F.pmod(number, own)).withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)))
        return side.drop("_points", "_ranges", number).repartition(tasks, *keys, "_points_block", "_ranges_block")

    return dealt(filed, "_range", "_ranges", "_points"), dealt(looking, "_row", "_points", "_ranges"), [*keys, "_points_block", "_ranges_block"]


def range_join(
    points: DataFrame,
    ranges: DataFrame,
    point: str,
    low: str,
    high: str,
    on: str | Sequence[str] = (),
    how: str = "inner",
    level_step: int = LEVEL_STEP,
) -> DataFrame:
    """Each range with each of the points from its ``low`` to its ``high``, both included.

    ``on`` names columns that must be equal as well; a NULL there equals nothing. Other columns must
    not share names. ``how="left"`` keeps ranges without a point, with NULL for the points' columns.

    A point is copied once per width in use (at most 64 / ``level_step``), a range twice at most; a pair
    meets in one bin only. Where bins are crowded, both sides are written once, the pairs to compare are counted,
    and the work is dealt by their number, hot bins in blocks. Ranges without a point are found by combined
    counts, not by an outer join.
    """
    names = as_names(on)
    _check(points, ranges, point, low, high, names)
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if not 1 <= level_step <= 63:
        raise ValueError("level_step must be from 1 to 63")
    shared = {c.lower() for c in points.columns if c not in names} & {c.lower() for c in ranges.columns}
    if shared:
        raise ValueError(f"points and ranges share the columns {sorted(shared)}; rename them or list them in on")
    filed = _filed(ranges, low, high, level_step)
    levels = sorted(r["_level"] for r in filed.select("_level").distinct().collect())  # 64 at most
    crowded = bool(levels) and _is_crowded(points, point, names, levels[-1])
    columns = [*ranges.columns, *(c for c in points.columns if c not in names)]
    keys, value = [*names, "_level", "_bin"], _unit(points, point)
    looking = points.withColumn("_at", value).where(F.col("_at").isNotNull())
    if crowded:
        filed = written_once(filed.withColumn("_range", F.monotonically_increasing_id()))
        looking, seen = written_and_observed(looking.withColumn("_row", F.monotonically_increasing_id()), rows=F.count(F.lit(1)))
    first, last = _bin(F.col("_lo"), F.col("_level")), _bin(F.col("_hi"), F.col("_level"))
    filed = filed.withColumn("_bin", F.explode(F.array_distinct(F.array(first, last))))
    places = [F.struct(F.lit(k).alias("_level"), _bin(F.col("_at"), F.lit(k)).alias("_bin")) for k in levels]
    looking = looking.select("*", F.inline(F.array(*places))) if levels else looking.select("*", F.lit(0).alias("_level"), F.lit(0).alias("_bin")).limit(0)
    if crowded:
        filed, looking, keys = _cut(filed, looking, keys, seen["rows"] * len(levels))
    # as in range_totals, the copies are beyond Spark's estimates
    met = filed.hint("merge").join(looking.hint("merge"), keys).where(F.col("_at").between(F.col("_lo"), F.col("_hi")))
    found = met.select(*columns)
    if how == "inner":
        return found
    empty = range_totals(points, ranges, point, low, high, {}, names, count="__points").where("__points = 0").drop("__points")
    return found.unionByName(empty, allowMissingColumns=True)


def _tiles(levels: int, bits: int) -> Column:
    """The whole bins that tile ``_lo`` to ``_hi``, as (level, bin): on each level those that the next one leaves."""
    end = F.col("_hi") + 1

    def bounds(level: int) -> tuple[Column, Column]:
        size = F.lit(level * bits)
        return _bin(F.col("_lo") + F.lit((1 << (level * bits)) - 1), size), _bin(end, size)

    def on_level(level: int) -> Callable[[Column], Column]:
        return lambda x: F.struct(F.lit(level).alias("_level"), x.alias("_bin"))

    parts = []
    for level in range(levels):
        start, stop = bounds(level)
        if level + 1 < levels:
            above, above_stop = (F.call_function("shiftleft", b, F.lit(bits)) for b in bounds(level + 1))
            taken = above < above_stop
            stretches = [(start, F.when(taken, above).otherwise(stop)), (F.when(taken, above_stop), stop)]
        else:
            stretches = [(start, stop)]
        for a, b in stretches:
            bins = F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))
            parts.append(F.transform(bins, on_level(level)))
    return F.flatten(F.array(*parts))


def range_totals(
    facts: DataFrame,
    ranges: DataFrame,
    point: str,
    low: str,
    high: str,
    sums: dict[str, str],
    on: str | Sequence[str] = (),
    count: str | None = "n",
    tree_bits: int = TREE_BITS,
) -> DataFrame:
    """Every range with its number of facts and the sums of their columns; without facts 0 and NULL.

    ``sums`` maps result names to whole-number or decimal columns. ``on`` names columns that must be
    equal as well; a NULL there equals nothing. Bounds must lie within 62 bits.

    Facts are combined per value map-side, then per bin of a tree of ``2 ** tree_bits``; a range is the sum of
    the bins that tile it. So the join has a few rows per range and level, however many facts a range holds
    and however many ranges overlap.
    """
    names, values = as_names(on), list(dict.fromkeys(sums.values()))
    _check(facts, ranges, point, low, high, names)
    require_columns(facts, values)
    taken = {c.lower() for c in ranges.columns} & {n.lower() for n in [*sums, *([count] if count else [])]}
    if taken:
        raise ValueError(f"the ranges already have the columns {sorted(taken)}")
    places = {v: decimal_places(facts, v) for v in values}
    wide = {v: T.DecimalType(38, places[v]) for v in values}
    per_value = facts.select(*names, _unit(facts, point).alias("_at"), *values).where(F.col("_at").isNotNull())
    per_value = per_value.groupBy(*names, "_at").agg(
        F.count(F.lit(1)).alias("_n"), *(F.sum(F.col(v).cast(wide[v])).alias(f"_s{i}") for i, v in enumerate(values))
    )
    bounded = ranges.select(*names, _unit(ranges, low).alias("_lo"), _unit(ranges, high).alias("_hi")).where(F.col("_lo") <= F.col("_hi")).distinct()
    widest = bounded.agg(F.max(F.try_subtract("_hi", "_lo"))).first()[0] or 0
    levels = max(1, -(-int(widest + 1).bit_length() // tree_bits))
    partial = ["_n", *(f"_s{i}" for i in range(len(values)))]
    upwards = [F.struct(F.lit(k).alias("_level"), _bin(F.col("_at"), F.lit(k * tree_bits)).alias("_bin")) for k in range(levels)]
    bins = per_value.select(*names, *partial, F.inline(F.array(*upwards))).groupBy(*names, "_level", "_bin").agg(*(F.sum(p).alias(p) for p in partial))
    tiled = bounded.select(*names, "_lo", "_hi", F.inline(_tiles(levels, tree_bits)))
    # Spark's estimates know neither the tiles of a range nor how well a file is packed, so it would broadcast what is large
    totals = tiled.hint("merge").join(bins.hint("merge"), [*names, "_level", "_bin"]).groupBy(*names, "_lo", "_hi").agg(*(F.sum(p).alias(p) for p in partial))
    keyed = ranges.withColumns({"_lo": _unit(ranges, low), "_hi": _unit(ranges, high)})
    joined = join_on_same(keyed, totals.hint("merge"), [*names, "_lo", "_hi"], "left")

    def total(column: str) -> Column:
        kind = facts.schema[column].dataType
        out = F.col(f"_s{values.index(column)}")
        return out.cast("bigint") if isinstance(kind, T.IntegralType) else out

    counted = [F.coalesce("_n", F.lit(0)).cast("bigint").alias(count)] if count else []
    return joined.select(*ranges.columns, *counted, *(total(v).alias(n) for n, v in sums.items()))
