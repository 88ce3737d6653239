from decimal import Decimal

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from seasonframe.sources import SEASON_SCHEMAS, season_table


def make(spark, table, rows):
    """A season table from dicts; absent columns are NULL."""
    schema = T.StructType.fromDDL(SEASON_SCHEMAS[table])
    columns = {f.name: pa.array([r.get(f.name) for r in rows], to_arrow_type(f.dataType)) for f in schema}
    return season_table(table, spark.createDataFrame(pa.table(columns)))


def rows(df, *columns):
    """Result rows in an order of their own, for comparison without regard to order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def listed(df, *columns):
    """Result rows in the order they come."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def dec(text):
    return Decimal(text)
