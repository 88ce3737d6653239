"""Shared by the tests of the training-data operators."""

from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def documents(spark: SparkSession):
    """Makes a documents table with extra columns whose names clash with results."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "src", 0 if t is None else len(t), True, "x", 7) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, kept boolean, spans string, component_id int",
        )

    return make
