"""A training corpus from the documents table, in five stages.

Each stage takes (spark, docs, sf_dir), works on all documents that the one before kept, and
returns documents again; the last returns the packed sequences. Between stages the documents are
written as Parquet to the folder that all executors share, and read again, so a lost executor
costs the work of one stage at most.

A document is kept if any row of its id is; null ids count as one id. Null and empty texts have no
language and go in the first stage. Empty tables pass through all stages. Extra columns stay with their rows
until the last stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonframe.llm.common import cut, shared_folder, table, without
from seasonframe.llm.exact_dedup import exact_duplicates
from seasonframe.llm.language import document_evidence, identify, train_text_model
from seasonframe.llm.packing import pack_documents
from seasonframe.llm.pii import redact
from seasonframe.llm.simhash import simhash_duplicates

ORACLE_SQL = None


def _only_kept(docs: DataFrame, decisions: DataFrame, kept: Column) -> DataFrame:
    dropped = cut(decisions.groupBy("doc_id").agg(F.bool_or(kept).alias("_kept")).where("not _kept").select("doc_id"))
    return without(docs, dropped, "doc_id")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the fused evidence settles; those without a letter have none."""
    decisions = identify(document_evidence(docs), train_text_model(docs), "doc_id")
    return _only_kept(docs, decisions, F.col("accepted"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id; of rows that repeat it, one."""
    decisions = cut(exact_duplicates(docs, keep="largest"))
    kept = _only_kept(docs, decisions, F.col("kept"))
    repeated = cut(decisions.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1").select("doc_id"))
    if repeated.isEmpty():
        return kept
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    again = kept.join(repeated.distinct().withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return without(kept, repeated, "doc_id").unionByName(
        again.withColumn("_digest", digest).dropDuplicates(["doc_id", "_digest"]).drop("_digest")
    )


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-equal fingerprints, the one with the smallest id."""
    decisions = simhash_duplicates(docs, words_per_shingle=3, most=3)
    return _only_kept(docs, decisions, F.col("doc_id").eqNullSafe(F.col("component_id")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind; null ids and repeated rows stay rows."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 1024, one row per piece."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the result of the last."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
