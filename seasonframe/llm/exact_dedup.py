"""Exact deduplication through content-defined chunk recipes; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonframe.llm.common import cut, whole_text

#: A chunk has MIN_CHUNK characters or more and ends where a word that ends in one of a few letters
#: meets a word that starts with one of a few; at the latest it ends after MAX_CHUNK characters.
MIN_CHUNK = 512
MAX_CHUNK = 4096
_BOUNDARY = r"(?<=[a-dr-t]\s)(?=[a-h])"


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The text cut at places that its own content decides; joined again, the pieces give the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{{least},{most}}}?{_BOUNDARY}|.{{1,{most}}}"), F.lit(0))


def _chunk_hash(chunk: Column, bits: int) -> Column:
    return F.xxhash64(chunk) if bits >= 64 else F.xxhash64(chunk).bitwiseAND(F.lit((1 << bits) - 1))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    keep: str = "largest",
    min_chunk: int = MIN_CHUNK,
    max_chunk: int = MAX_CHUNK,
    hash_bits: int = 64,
) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256, n_chunks``.

    Each text becomes a recipe, the ordered list of its chunks' identifiers. Every distinct chunk
    moves once, combined in the map tasks first, to be compared byte by byte with the others of its
    hash: chunks that share a hash but not their content get identifiers of their own, so equal
    recipes mean equal texts. After that only recipes move.

    ``keep``: which id of a group stays, ``largest`` or ``smallest``. A null text counts as empty and
    equals other empty texts; texts are compared unchanged. A null id is below every other id and is
    kept only in a group without any other. Rows that repeat the kept id are all reported as kept.
    Extra columns are ignored. An empty table gives an empty result. ``hash_bits`` below 64 is for
    tests that need colliding hashes.
    """
    best = {"largest": F.max, "smallest": F.min}[keep]
    texts = docs.select(F.col(id_col).alias("_id"), whole_text(F.col(text_col)).alias("_text"))
    pieces = chunks(F.col("_text"), min_chunk, max_chunk)
    recipes = cut(
        texts.select(
            "_id",
            F.unhex(F.sha2(F.col("_text"), 256)).alias("_sha"),
            F.transform(pieces, lambda c: _chunk_hash(c, hash_bits)).alias("_recipe"),
        )
    )
    distinct_chunks = (
        texts.select(F.explode(pieces).alias("_chunk"))
        .withColumn("_h", _chunk_hash(F.col("_chunk"), hash_bits))
        .groupBy("_h", "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    clashing = cut(distinct_chunks.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h"))
    if clashing.isEmpty():
        verified = recipes.withColumn("_numbers", F.lit(None).cast("array<int>"))
    else:
        verified = _split_clashes(texts, pieces, recipes, clashing, hash_bits)

    verified = verified.withColumn("_numbers", F.coalesce("_numbers", F.array().cast("array<int>")))
    groups = verified.groupBy("_recipe", "_numbers").agg(best("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return verified.join(groups, ["_recipe", "_numbers"]).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
        F.size("_recipe").cast("long").alias("n_chunks"),
    )


def _split_clashes(texts: DataFrame, pieces: Column, recipes: DataFrame, clashing: DataFrame, hash_bits: int) -> DataFrame:
    """Recipes with, where a chunk's hash is shared, the number of each chunk among those of its hash.

    Only chunks of a clashing hash move again. The text's own digest keys its recipe, so equal
    texts share the work; the digest only finds the recipe, it does not decide equality.
    """
    hashed = texts.select(
        "_id",
        F.unhex(F.sha2(F.col("_text"), 256)).alias("_sha"),
        F.posexplode(pieces).alias("_pos", "_chunk"),
    ).withColumn("_h", _chunk_hash(F.col("_chunk"), hash_bits))
    touched = hashed.join(clashing, "_h", "left_semi")
    # the rank of a content among those of its hash: how many distinct ones are not larger
    contents = touched.select("_h", "_chunk").distinct()
    numbers = (
        contents.groupBy("_h")
        .agg(F.array_sort(F.collect_list("_chunk")).alias("_all"))
        .select("_h", F.posexplode("_all").alias("_number", "_chunk"))
    )
    marks = (
        touched.join(numbers, ["_h", "_chunk"])
        .select("_sha", "_id", "_pos", "_number")
        .distinct()
        .groupBy("_sha", "_id")
        .agg(F.map_from_entries(F.collect_set(F.struct("_pos", "_number"))).alias("_marks"))
    )
    joined = recipes.alias("r").join(
        marks.alias("m"),
        F.col("r._sha").eqNullSafe(F.col("m._sha")) & F.col("r._id").eqNullSafe(F.col("m._id")),
        "left",
    )
    numbers_in_order = F.when(
        F.col("_marks").isNotNull(),
        F.transform(F.sequence(F.lit(0), F.size("_recipe") - 1), lambda i: F.coalesce(F.col("_marks")[i], F.lit(0))),
    )
    return joined.select("r._id", "r._sha", "_recipe", numbers_in_order.alias("_numbers"))
