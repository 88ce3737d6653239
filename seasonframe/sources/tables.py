"""Reading input tables. Season tables have declared schemas; nothing is inferred from rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(19, 2)

# The season tables as stored. `seq` in batting tells apart rows of one player and year.
SEASON_SCHEMAS: dict[str, str] = {
    "people": "playerid STRING NOT NULL, namefirst STRING, namelast STRING, throws STRING",
    "collegeplaying": "playerid STRING NOT NULL, schoolid STRING",
    "schools": "schoolid STRING NOT NULL",
    "salaries": "playerid STRING NOT NULL, teamid STRING, yearid INT, salary DOUBLE",
    "fielding": "pos STRING, po INT, yearid INT",
    "teams": (
        "teamid STRING NOT NULL, yearid INT NOT NULL, name STRING, lgid STRING, divid STRING, "
        "w INT, g INT, so INT, hr INT, wswin STRING, divwin STRING, wcwin STRING, lgwin STRING"
    ),
    "batting": (
        "playerid STRING NOT NULL, yearid INT NOT NULL, teamid STRING, h INT, hr INT, sb INT, cs INT, seq INT"
    ),
    "pitching": "playerid STRING NOT NULL, yearid INT, so INT, gs INT",
    "awardsmanagers": "playerid STRING NOT NULL, awardid STRING, yearid INT, lgid STRING",
    "managers": "playerid STRING NOT NULL, yearid INT, lgid STRING, teamid STRING",
    "awardsplayers": "playerid STRING NOT NULL, awardid STRING",
    "halloffame": "playerid STRING NOT NULL, yearid INT, inducted STRING, category STRING",
    "homegames": "team STRING, year INT, attendance INT, games INT",
}

# The driver's tables that the registered queries read.
DRIVER_SCHEMAS: dict[str, str] = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def read_driver_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One parquet table of the driver's directory, without a job that looks up its schema."""
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{directory}/{name}.parquet")


def season_table(name: str, df: DataFrame) -> DataFrame:
    """``df`` with the declared columns and types; the salary becomes an exact decimal."""
    schema = T.StructType.fromDDL(SEASON_SCHEMAS[name])
    table = df.select(*(F.col(f.name).cast(f.dataType) for f in schema))
    return table.withColumn("salary", F.col("salary").cast(MONEY)) if name == "salaries" else table


def read_season_tables(
    spark: SparkSession, directory: str, fmt: str = "parquet", **options: str
) -> dict[str, DataFrame]:
    """All season tables of a directory, one ``<name>.<fmt>`` each, with the declared schemas."""

    def read(name: str, ddl: str) -> DataFrame:
        reader = spark.read.schema(ddl).format(fmt).options(**options)
        return season_table(name, reader.load(f"{directory}/{name}.{fmt}"))

    return {name: read(name, ddl) for name, ddl in SEASON_SCHEMAS.items()}


def season_tables_from_catalog(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """All season tables by name from the session's catalogue."""
    prefix = f"{database}." if database else ""
    return {name: season_table(name, spark.table(f"{prefix}{name}")) for name in SEASON_SCHEMAS}


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make tables available to ``spark.sql`` under their names, for the session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
