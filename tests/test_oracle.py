"""Registered queries against their SQL in DuckDB, on the driver's tables."""

import glob
import math
import os

import duckdb
import pytest

from seasonframe.plans.queries import QUERIES, SQL

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module", autouse=True)
def compiled(spark):
    """These run as in production, with whole stages compiled."""
    before = spark.conf.get("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", before)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(round(value, 9))
    return "null" if value is None else repr(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    got = sorted(tuple(map(normal, row)) for row in result.select(columns).collect())
    relation = duck.sql(SQL[name])
    assert sorted(relation.columns) == columns
    want = sorted(tuple(map(normal, row)) for row in relation.select(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert got == want
    assert got, "the query selects nothing, so it checks nothing"
    spark_types = {f.name: f.dataType.simpleString() for f in result.schema}
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    names = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
    assert {c: names[t] for c, t in spark_types.items()} == duck_types


def test_declared_schemas_match_the_files(spark):
    from pyspark.sql import types as T

    from seasonframe.sources import DRIVER_SCHEMAS

    for name, ddl in DRIVER_SCHEMAS.items():
        stored = {f.name: f.dataType for f in spark.read.parquet(f"{SF_DIR}/{name}.parquet").schema}
        assert stored == {f.name: f.dataType for f in T.StructType.fromDDL(ddl)}
