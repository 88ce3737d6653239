"""Column expressions that pin down null order, division, rounding and correlation.

Everything here is a built-in Spark expression, so it stays inside code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_PLACES = 6


def as_names(columns: str | Iterable[str] | None) -> list[str]:
    """Column names as a list; a single name and None are accepted."""
    if columns is None:
        return []
    return [columns] if isinstance(columns, str) else list(columns)


def require_columns(df: DataFrame, *names: str | Iterable[str] | None) -> None:
    """Raise ValueError when ``df`` lacks one of ``names`` (case does not matter)."""
    have = {c.lower() for c in df.columns}
    wanted = [n for group in names for n in as_names(group)]
    missing = [n for n in wanted if n.lower() not in have]
    if missing:
        raise ValueError(f"columns {missing} not found; the input has {df.columns}")


def decimal_places(df: DataFrame, *names: str) -> int:
    """The decimal places that exact arithmetic on these columns needs.

    Refuses binary fractions: their sums depend on the order of the rows, so they must be
    cast to a decimal of the caller's choice first.
    """
    places = 0
    for name in names:
        kind = df.schema[name].dataType
        if isinstance(kind, T.DecimalType) and kind.scale <= MAX_PLACES:
            places = max(places, kind.scale)
        elif not isinstance(kind, T.IntegralType):
            raise ValueError(
                f"{name!r} is {kind.simpleString()}; cast it to a whole number "
                f"or a decimal of at most {MAX_PLACES} places"
            )
    return places


@dataclass(frozen=True)
class SortKey:
    """A sort column with explicit direction and null position.

    Without ``nulls`` a NULL counts as the largest value: last when ascending,
    first when descending.
    """

    name: str
    direction: str = "asc"
    nulls: str | None = None

    def __post_init__(self) -> None:
        if self.direction not in ("asc", "desc"):
            raise ValueError(f"direction must be 'asc' or 'desc', not {self.direction!r}")
        if self.nulls not in (None, "first", "last"):
            raise ValueError(f"nulls must be 'first' or 'last', not {self.nulls!r}")

    @property
    def nulls_first(self) -> bool:
        if self.nulls is None:
            return self.direction == "desc"
        return self.nulls == "first"

    def sort(self) -> Column:
        c = F.col(self.name)
        if self.direction == "asc":
            return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()
        return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()


def sort_keys(order_by: str | SortKey | tuple | Sequence) -> list[SortKey]:
    """``"yr"``, ``("w", "desc")``, ``("w", "desc", "last")``, or a list of those."""
    if isinstance(order_by, SortKey):
        return [order_by]
    if isinstance(order_by, str):
        return [SortKey(order_by)]
    if isinstance(order_by, tuple):
        return [SortKey(*order_by)]
    return [key for item in order_by for key in sort_keys(item)]


_WHOLE = T.DecimalType(38, 0)
_LARGEST_BIGINT = (1 << 63) - 1


def _zero_free(den: Column) -> Column:
    return F.nullif(den, F.lit(0))


def _whole_quotient(num: Column, den: Column) -> Column:
    """Quotient of decimals cut towards zero, exact up to 32 digits; ``div`` would wrap past 2^63."""
    return ((num - num % den) / den).cast(_WHOLE)


def _loud(result: Column, kind: T.DataType, *inputs: Column) -> Column:
    """The result, or an error where it has none although no input is missing: never a wrong number."""
    given = reduce(lambda a, b: a & b, [c.isNotNull() for c in inputs])
    failed = F.raise_error(F.lit("a ratio has more digits than a decimal of 38 can hold")).cast(kind)
    return F.when(given & result.isNull(), failed).otherwise(result)


def integer_ratio(num: Column, den: Column) -> Column:
    """Quotient as a bigint, cut towards zero; NULL where ``den`` is 0, an error where it does not fit."""
    exact = T.DecimalType(38, MAX_PLACES)
    n, d = num.cast(exact), _zero_free(den.cast(exact))
    quotient = _whole_quotient(n, d)
    fits = F.abs(quotient) <= F.lit(Decimal(_LARGEST_BIGINT))
    return _loud(F.when(fits, quotient).cast("bigint"), T.LongType(), num, d)


def exact_ratio(num: Column, den: Column, digits: int = 2, percent: bool = False, scale: int = 0) -> Column:
    """``num / den`` as a decimal rounded half away from zero; NULL where ``den`` is 0.

    Worked out on scaled whole numbers, so a quotient that ends exactly on a half is never
    seen through a binary fraction. ``scale`` is the number of decimal places that the
    inputs carry (0 for whole numbers). A quotient of up to 30 digits is exact; where the
    work needs more than 38 digits there is an error, never a wrapped number.

    Numbers that leave room in 64 bits, nearly all, take one whole-number division; only the others
    are divided as decimals.
    """
    if not 0 <= digits <= MAX_PLACES:
        raise ValueError(f"digits must be from 0 to {MAX_PLACES}")
    factor = (100 if percent else 1) * 10**digits
    kind = T.DecimalType(38, digits)
    a, b = (_small_units(c, scale) for c in (num, den))
    room = 10**18 // (2 * factor) - 1
    fits = (F.abs(a) <= F.lit(room)) & (F.abs(b) <= F.lit(10**17))
    short = F.call_function("div", F.abs(a) * F.lit(2 * factor) + F.abs(b), F.nullif(F.abs(b) * F.lit(2), F.lit(0)))
    short = F.when((a < 0) != (b < 0), -short).otherwise(short)
    step = F.lit(Decimal(1).scaleb(-digits))
    return F.when(fits, (short.cast(T.DecimalType(18, 0)) * step).cast(kind)).otherwise(_long_ratio(num, den, digits, factor, scale))


def _small_units(value: Column, scale: int) -> Column:
    """The number in its smallest unit as a bigint, or NULL where it is none."""
    return (value if not scale else _units(value, scale)).try_cast("bigint")


def _long_ratio(num: Column, den: Column, digits: int, factor: int, scale: int) -> Column:
    """The same on decimals of 38 digits, or an error."""
    n, d = (_units(c, scale) for c in (num, den))
    x, y = F.abs(n), _zero_free(F.abs(d))
    # the whole part first, so that only the rest, below y, is scaled up
    rounded = _whole_quotient(x % y * F.lit(Decimal(2 * factor)) + y, y * F.lit(2))
    units = (_whole_quotient(x, y) * F.lit(Decimal(factor)) + rounded).cast(_WHOLE)
    signed = F.when((n < 0) != (d < 0), -units).otherwise(units)
    kind = T.DecimalType(38, digits)
    step = Decimal(1).scaleb(-digits)
    return _loud((signed.cast(_WHOLE) * F.lit(step)).cast(kind), kind, num, den, y)


def _units(value: Column, scale: int) -> Column:
    """A number of ``scale`` places as a whole number of its smallest unit."""
    if not scale:
        return value.cast(_WHOLE)
    return (value.cast(T.DecimalType(38, scale)) * F.lit(Decimal(10**scale))).cast(_WHOLE)


def row_differs(columns: Sequence[str], values: Sequence) -> Column:
    """Tuple inequality under three-valued logic: NULL, so not true, when undecided."""
    if not columns or len(columns) != len(values):
        raise ValueError("columns and values must have the same, non-zero length")
    return reduce(lambda a, b: a | b, [F.col(c) != F.lit(v) for c, v in zip(columns, values)])


def join_on_same(left: DataFrame, right: DataFrame, names: Iterable[str], how: str) -> DataFrame:
    """Join on ``names`` with NULL equal to NULL; only the left side's key columns are kept.

    The right side's keys are renamed first, so both sides may stem from one DataFrame.
    """
    keys = list(names)
    other = right.withColumnsRenamed({n: f"__right_{n}" for n in keys})
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"__right_{n}")) for n in keys])
    return left.join(other, same, how).drop(*(f"__right_{n}" for n in keys))


def left_join_many(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """``one LEFT JOIN many`` where ``many`` may repeat a key very often.

    An outer join cannot split a hot key on its inner side, an inner join can. So the
    matches come from an inner join, and the rows without a match are added.
    """
    alone = one.join(many.select(key).distinct(), key, "left_anti")
    return many.join(one, key).unionByName(alone, allowMissingColumns=True)


def guarded_corr(x: Column, y: Column, digits: int | None = 4) -> Column:
    """Pearson correlation over complete pairs; NULL below two pairs or when a side is constant."""
    x, y = x.cast("double"), y.cast("double")
    spread_x = F.stddev_pop(F.when(y.isNotNull(), x))
    spread_y = F.stddev_pop(F.when(x.isNotNull(), y))
    corr = F.covar_pop(x, y) / F.nullif(spread_x * spread_y, F.lit(0.0))
    if digits is None:
        return corr
    return F.round(corr.cast(T.DecimalType(20, 15)), digits)
