"""The driver's tables in the shapes the operators take: yearly facts and nation seasons.

Amounts are whole cents, so that sums are exact and do not depend on their order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonframe.sources import read_driver_table as read_table


def cents(column: str) -> Column:
    """A stored price as whole cents; prices are not negative."""
    return F.floor(F.col(column) * 100 + 0.5)


def day_number(column: str) -> Column:
    return F.unix_date(F.to_date(column))


def between_years(column: str, first: int | None = None, last: int | None = None) -> Column:
    """A range on the stored column, which the parquet reader can use; ``year(x)`` it cannot."""
    bounds = []
    if first is not None:
        bounds.append(F.col(column) >= F.lit(f"{first}-01-01").cast("timestamp_ntz"))
    if last is not None:
        bounds.append(F.col(column) < F.lit(f"{last + 1}-01-01").cast("timestamp_ntz"))
    return reduce(lambda a, b: a & b, bounds, F.lit(True))


def order_years(spark: SparkSession, directory: str, where: Column | None = None) -> DataFrame:
    """Orders as season rows: customer, year, status, amount, unique key; ``where`` is on the stored columns."""
    orders = read_table(spark, directory, "orders")
    return (orders if where is None else orders.where(where)).select(
        F.col("o_custkey").alias("pid"),
        F.year("o_orderdate").cast("smallint").alias("yr"),
        F.col("o_orderstatus").alias("team"),
        cents("o_totalprice").alias("cents"),
        F.col("o_orderkey").alias("k"),
    )


def customers(spark: SparkSession, directory: str) -> DataFrame:
    return read_table(spark, directory, "customer").withColumnRenamed("c_custkey", "pid")


def nation_years(spark: SparkSession, directory: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Per nation and year: orders ``w``, amount ``rev``, and ``won`` for the year's most orders.

    Orders are summed per customer and year before the join, so a customer with very many
    orders reaches it as one row per year. The window runs over the nations of one year.
    """
    yearly = order_years(spark, directory, between_years("o_orderdate", first, last)).groupBy("pid", "yr").agg(
        F.count("*").alias("w"), F.sum("cents").alias("rev")
    )
    homes = customers(spark, directory).select("pid", F.col("c_nationkey").alias("teamid"))
    seasons = yearly.join(homes, "pid").groupBy("teamid", "yr").agg(F.sum("w").alias("w"), F.sum("rev").alias("rev"))
    nations = read_table(spark, directory, "nation").select(
        F.col("n_nationkey").alias("teamid"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")
    )
    place = F.row_number().over(Window.partitionBy("yr").orderBy(F.col("w").desc_nulls_last(), F.col("teamid").asc()))
    return seasons.join(nations, "teamid").withColumn("won", F.when(place == 1, "Y").otherwise("N"))


def user_days(spark: SparkSession, directory: str) -> DataFrame:
    """Events as user, day and type."""
    return read_table(spark, directory, "events").select("user_id", day_number("ts").alias("day"), "event_type")


def plain_types(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and decimals as double, so that engines can be compared."""

    def cast(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double")
        if isinstance(field.dataType, T.IntegralType):
            return F.col(field.name).cast("bigint")
        return F.col(field.name)

    return df.select(*(cast(f).alias(f.name) for f in df.schema))
