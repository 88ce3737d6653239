"""Helpers shared by the training-data operators: reading tables, cutting lineage, streaming groups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, through Spark's own reader, so that any file system will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """How many tasks a shuffle of the session gets."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that all executors share, as the session names it.

    Only where none is set (tests on one machine) a temporary one is made; on a cluster that would
    lose data with a machine, so it is refused there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows written as a Parquet table in the shared folder, and read from there."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Ids up to which a table of them is broadcast: about 16 bytes each.
BROADCAST_IDS = 200_000


def without(rows: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows whose id is not among ``ids`` (one column of that name; null ids are compared too).

    Few ids, by count, are broadcast, so that the rows stay where they are; more are joined by a shuffle.
    """
    gone = ids.select(F.col(id_col).alias("_gone")).distinct()
    if ids.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return rows.join(gone, F.col(id_col).eqNullSafe(F.col("_gone")), "left_anti")


def whole_text(text: Column) -> Column:
    """The text, with null counted as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Re-cut a partition sorted on ``keys`` into tables of whole groups.

    A group is kept in memory whole; callers bound its size before they sort.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        last = [batch.column(k)[batch.num_rows - 1] for k in keys]
        first_of_last = _run_start(batch, keys, last)
        if first_of_last > 0 or (held and not _same(held[-1], batch, keys)):
            if first_of_last > 0:
                held.append(batch.slice(0, first_of_last))
            yield pa.Table.from_batches(held)
            held = [batch.slice(first_of_last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _same(one: pa.RecordBatch, other: pa.RecordBatch, keys: list[str]) -> bool:
    return all(one.column(k)[one.num_rows - 1] == other.column(k)[0] for k in keys)


def _run_start(batch: pa.RecordBatch, keys: list[str], last: list[pa.Scalar]) -> int:
    """First row of the run of equal keys that ends the sorted batch, by bisection."""
    low, high = 0, batch.num_rows - 1
    while low < high:
        middle = (low + high) // 2
        if all(batch.column(k)[middle] == v for k, v in zip(keys, last, strict=True)):
            high = middle
        else:
            low = middle + 1
    return low


def over_sorted_groups(
    df: DataFrame, keys: list[str], function: Callable[[pa.Table], pa.Table], schema: str, order: list[str] | None = None
) -> DataFrame:
    """Apply ``function`` to tables of whole groups of ``keys``; many small groups share one call."""
    spread = df.repartition(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys, *(order or []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, keys):
            yield from function(group).to_batches()

    return spread.mapInArrow(run, schema)


def pair_blocks(rows: DataFrame, keys: list[str], item: str, slice_rows: int) -> DataFrame:
    """Spread each group of ``keys`` so that every pair of its rows still meets in some block.

    Groups of up to ``slice_rows`` rows stay one block. Larger ones are cut into slices by the hash
    of ``item``, and each pair of slices becomes a block of at most about twice ``slice_rows``
    rows, so no group, however hot, has to fit one task. Adds ``slice``, ``low`` and ``high``: in a
    block with ``low < high`` only pairs across the two slices are wanted.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = sizes.where(F.col("_n") > slice_rows).select(*keys, F.ceil(F.col("_n") / slice_rows).cast("int").alias("_s"))
    cut_rows = (
        rows.join(hot, keys, "left")
        .withColumn("_s", F.coalesce("_s", F.lit(1)))
        .withColumn("slice", F.pmod(F.xxhash64(F.lit("slice"), item), F.col("_s")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_s") - 1)))
    )
    return cut_rows.select(
        *rows.columns,
        "slice",
        F.least("slice", "_other").alias("low"),
        F.greatest("slice", "_other").alias("high"),
    )
