"""Totals per key: optional membership, thresholds, rates and unit costs.

Facts are always aggregated before they meet another table, so a key that holds a large
share of the fact rows is combined map-side and reaches the join as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonframe.functions import as_names, decimal_places, exact_ratio, integer_ratio, left_join_many, require_columns


def entity_totals(
    entities: DataFrame,
    members: DataFrame,
    facts: DataFrame,
    key: str,
    sums: dict[str, str],
    distinct_counts: dict[str, str],
    labels: Sequence[str] = (),
) -> DataFrame:
    """Totals of every entity that occurs in ``members``.

    ``sums`` and ``distinct_counts`` map output names to fact columns. An entity without
    facts keeps NULL totals and a distinct count of 0.
    """
    require_columns(entities, key, labels)
    require_columns(members, key)
    require_columns(facts, key, list(sums.values()), list(distinct_counts.values()))
    chosen = entities.select(key, *labels).join(members.select(key).distinct(), key, "left_semi")
    totals = facts.groupBy(key).agg(
        *(F.sum(c).alias(n) for n, c in sums.items()),
        *(F.count_distinct(c).alias(n) for n, c in distinct_counts.items()),
    )
    return chosen.join(totals, key, "left").select(
        key, *labels, *sums, *(F.coalesce(n, F.lit(0)).alias(n) for n in distinct_counts)
    )


def success_rate(
    df: DataFrame,
    hit: str,
    miss: str,
    min_attempts: int,
    keys: str | Sequence[str] | None = None,
    digits: int = 2,
    where: Column | str | None = None,
) -> DataFrame:
    """Attempts and success percentage with a minimum number of attempts.

    With ``keys`` the hits and misses are summed per key first. Without, every input row is
    judged on its own and all its columns are kept.
    """
    names = as_names(keys)
    require_columns(df, hit, miss, names)
    scale = decimal_places(df, hit, miss)
    rows = df if where is None else df.where(where)
    if names:
        rows = rows.groupBy(*names).agg(F.sum(hit).alias(hit), F.sum(miss).alias(miss))
    attempts = F.col(hit) + F.col(miss)
    return rows.where(attempts >= min_attempts).select(
        "*",
        attempts.alias("attempts"),
        exact_ratio(F.col(hit), attempts, digits, percent=True, scale=scale).alias("success_percent"),
    )


def unit_cost(
    cost: DataFrame,
    output: DataFrame,
    key: str,
    cost_col: str,
    out_col: str,
    qualify_col: str,
    qualify_min,
    qualify: str = "total",
    digits: int = 2,
) -> DataFrame:
    """Cost per unit of output for keys with enough of ``qualify_col``.

    ``qualify="total"`` tests the sum over the key's rows, ``"row"`` each row before the
    output is summed. Keys without cost keep NULL; an output of 0 gives a NULL unit cost.
    """
    require_columns(cost, key, cost_col)
    require_columns(output, key, out_col, qualify_col)
    if qualify == "row":
        made = output.where(F.col(qualify_col) >= qualify_min).groupBy(key).agg(F.sum(out_col).alias("total_output"))
    elif qualify == "total":
        made = output.groupBy(key).agg(F.sum(out_col).alias("total_output"), F.sum(qualify_col).alias("_qualifier"))
        made = made.where(F.col("_qualifier") >= qualify_min).drop("_qualifier")
    else:
        raise ValueError("qualify must be 'total' or 'row'")
    scale = max(decimal_places(cost, cost_col), decimal_places(output, out_col))
    spent = cost.groupBy(key).agg(F.sum(cost_col).alias("total_cost"))
    return made.join(spent, key, "left").select(
        key,
        "total_output",
        "total_cost",
        exact_ratio(F.col("total_cost"), F.col("total_output"), digits, scale=scale).alias("unit_cost"),
    )


def threshold_with_attribute(
    facts: DataFrame,
    key: str,
    sum_col: str,
    minimum,
    attributes: DataFrame,
    attribute: str,
    attr_where: Column | str | None = None,
    total: str = "total",
) -> DataFrame:
    """Keys whose total reaches ``minimum``, with an optional attribute (NULL where absent).

    A key with several matching attribute rows appears once per row.
    """
    require_columns(facts, key, sum_col)
    require_columns(attributes, key, attribute)
    chosen = attributes if attr_where is None else attributes.where(attr_where)
    high = facts.groupBy(key).agg(F.sum(sum_col).alias(total)).where(F.col(total) >= minimum)
    return left_join_many(high, chosen.select(key, attribute), key).select(key, total, attribute)


def repeat_threshold(
    facts: DataFrame,
    key: str,
    sub_key: str,
    sum_col: str,
    minimum,
    inclusive: bool = True,
    min_groups: int = 2,
) -> DataFrame:
    """Keys that reach (or, if not ``inclusive``, exceed) a total in several sub-groups."""
    require_columns(facts, key, sub_key, sum_col)
    total = F.col("_total")
    passed = total >= minimum if inclusive else total > minimum
    per_group = facts.groupBy(key, sub_key).agg(F.sum(sum_col).alias("_total")).where(passed)
    counted = per_group.groupBy(key).agg(F.count("*").alias("groups"))
    return counted.where(F.col("groups") >= min_groups)


def grouped_totals(
    df: DataFrame,
    keys: str | Sequence[str],
    sums: dict[str, str],
    per: str | None = None,
    integer_per: bool = True,
    digits: int = 2,
) -> DataFrame:
    """Totals per key, and with ``per`` (one of the totals) every other total per unit of it.

    ``integer_per`` cuts the average to a whole number; otherwise it is rounded to ``digits``.
    """
    names = as_names(keys)
    require_columns(df, names, list(sums.values()))
    if per is not None and per not in sums:
        raise ValueError(f"per must be one of {list(sums)}")
    totals = df.groupBy(*names).agg(*(F.sum(c).alias(n) for n, c in sums.items()))
    if per is None:
        return totals
    scale = decimal_places(df, *sums.values())

    def average(name: str) -> Column:
        if integer_per:
            return integer_ratio(F.col(name), F.col(per))
        return exact_ratio(F.col(name), F.col(per), digits, scale=scale)

    return totals.select("*", *(average(n).alias(f"{n}_per_{per}") for n in sums if n != per))
