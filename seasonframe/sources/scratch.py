"""Intermediate rows that are written once, in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def _share_a_folder(spark: SparkSession) -> None:
    """Set the checkpoint folder that the session names; only on one machine, and where none is named, a new one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = context.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    context.setCheckpointDir(folder)


def written_once(df: DataFrame) -> DataFrame:
    """The same rows from a reliable checkpoint: nothing is computed again where an executor is lost."""
    _share_a_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written_and_observed(df: DataFrame, **totals: Column) -> tuple[DataFrame, dict[str, int]]:
    """The rows written once, and totals that are observed while they are written: one pass for both."""
    seen = Observation()
    held = written_once(df.observe(seen, *(total.alias(name) for name, total in totals.items())))
    return held, {name: seen.get.get(name) or 0 for name in totals}
