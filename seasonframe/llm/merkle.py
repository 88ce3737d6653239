"""A Merkle manifest of a table, with a proof for each row, by a butterfly exchange of subtree roots."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from seasonframe.llm.common import cut, partitions, stored

#: Levels of the tree that are hashed inside one block of leaves.
BLOCK_LEVELS = 3


def row_digest(*fields: Column) -> Column:
    """Lowercase hex SHA-256 of the fields: each its UTF-8 byte count, ``:`` and the value; ``-`` if null."""
    written = []
    for field in fields:
        text = field.cast("string")
        written.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*written), 256)


def _ordered_places(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds ``_from``: how many leaves of the same group come before, along ``order``; a row counts ``_copies`` leaves.

    Rows are dealt by ranges of (group, order) and counted in their sorted partition. Only a group that
    goes on from an earlier partition needs a carry, so there are fewer carries than partitions.
    """
    keys = [group, *order]
    ranged = rows.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before, started = None, 0, False
        for batch in batches:
            places = []
            for value, copies in zip(batch.column(group).to_pylist(), batch.column("_copies").to_pylist(), strict=True):
                if not started or value != now:
                    now, before, started = value, 0, True
                places.append(before)
                before += copies
            yield batch.append_column("_here", pa.array(places, pa.int64()))

    counted = ranged.mapInArrow(count, _with_field(rows, "_here long"))
    held = stored(counted.withColumn("_part", F.spark_partition_id()))
    totals = held.groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p")).agg(F.sum("_copies").alias("_n"))
    earlier = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.withColumn("_carry", F.sum("_n").over(earlier)).where("_carry is not null").drop("_n")
    placed = held.join(F.broadcast(carries), F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")), "left")
    return placed.withColumn("_from", F.col("_here") + F.coalesce("_carry", F.lit(0))).drop("_here", "_part", "_g", "_p", "_carry")


def _with_field(rows: DataFrame, field: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), field])


def _blocks(leaves: DataFrame, group: str, size: int, columns: Sequence[str]) -> DataFrame:
    """One row per block of ``size`` places: its ``items``, runs of equal leaves with their places in the block.

    A run of equal leaves may span many blocks; it is cut at their edges before it is dealt out.
    """
    last = F.col("_from") + F.col("_copies") - 1
    pieces = leaves.withColumn("_block", F.explode(F.sequence(F.call_function("div", F.col("_from"), F.lit(size)), F.call_function("div", last, F.lit(size)))))
    start = F.col("_block") * size
    item = F.struct(
        F.greatest(F.col("_from") - start, F.lit(0)).cast("int").alias("first"),
        F.least(last - start, F.lit(size - 1)).cast("int").alias("last"),
        *columns,
    )
    return pieces.groupBy(group, "_block").agg(F.array_sort(F.collect_list(item)).alias("items"))


def _digest(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def _tree(leaves: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """The levels above and with the leaves; up to one node where ``levels`` is None."""
    found = [leaves]
    while len(found) <= levels if levels is not None else len(found[-1]) > 1:
        below = found[-1]
        found.append([_digest("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return found


def _levels_of(block: int, n: int, fanout: int) -> int | None:
    """A block that is not the only one of its group is hashed up to its own height, however few leaves it has."""
    return BLOCK_LEVELS if block > 0 or n == fanout**BLOCK_LEVELS else None


def _roots(blocks: DataFrame, group: str, kind: str, fanout: int) -> DataFrame:
    """``group, _block, digest``: the root of each block's subtree."""
    group_type = to_arrow_type(blocks.schema[group].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            leaves = [i["leaf"] for i in row["items"] for _ in range(i["first"], i["last"] + 1)]
            root = _tree(leaves, fanout, _levels_of(row["_block"], len(leaves), fanout))[-1][0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[group]], group_type), pa.array([row["_block"]], pa.int64()), pa.array([root], pa.string())],
                names=[group, "_block", "digest"],
            )

    return blocks.select(group, "_block", "items").mapInArrow(run, f"`{group}` {kind}, _block long, digest string")


def _climb(roots: DataFrame, group: str, fanout: int) -> DataFrame:
    """Adds to each block its ``path`` up to its group's root, and that root as ``digest``.

    In a round, blocks whose numbers differ in one digit (to the base ``fanout``) swap the roots of
    the subtrees they stand in, and each hashes the next ancestor itself, so nothing has to come
    down again. The last group may lack blocks; those that it has stand in for the missing ones.
    ``path`` lists per level the siblings before and after, each joined.
    """
    none = F.array().cast("array<struct<before:string,after:string>>")
    sizes = cut(roots.groupBy(F.col(group).alias("_g")).agg((F.max("_block") + 1).alias("_blocks")))
    longest = sizes.agg(F.max("_blocks")).first()[0] or 0
    many = sizes.where("_blocks > 1")
    # groups of one block are done; the others are fewer than the blocks by far
    now = cut(
        roots.join(many, F.col(group).eqNullSafe(F.col("_g")), "left")
        .drop("_g")
        .select(group, "_block", F.coalesce("_blocks", F.lit(1)).alias("_blocks"), "digest", none.alias("path"))
    )
    stride = 1
    while stride < longest:
        now = cut(_swap(now, group, stride, fanout))
        stride *= fanout
    return now.drop("_blocks")


def _swap(now: DataFrame, group: str, stride: int, fanout: int) -> DataFrame:
    """One round: subtrees of ``stride`` blocks, in aligned groups of ``fanout``, become one."""
    number, low = F.col("_block"), F.col("_block") % stride
    taking = now.where(F.col("_blocks") > stride).select(
        "*",
        F.call_function("div", number, F.lit(stride * fanout)).alias("_family"),
        low.alias("_low"),
        (F.call_function("div", number, F.lit(stride)) % fanout).alias("_digit"),
    )
    # blocks of the sender's own subtree: all but the last one have `stride`
    present = F.least(F.lit(stride).cast("long"), F.col("_blocks") - (number - low))
    sent = taking.select(
        F.col(group).alias("_g"),
        F.col("_family").alias("_f"),
        F.explode(F.sequence(F.col("_low"), F.lit(stride - 1).cast("long"), present)).alias("_l"),
        F.struct(F.col("_digit").alias("digit"), F.col("digest").alias("digest")).alias("_root"),
    )
    family = sent.groupBy("_g", "_f", "_l").agg(F.array_sort(F.collect_list("_root")).alias("_roots"))
    same = F.col(group).eqNullSafe(F.col("_g")) & (F.col("_family") == F.col("_f")) & (F.col("_low") == F.col("_l"))

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("_roots", keep), lambda r: r["digest"]), "")

    step = F.struct(
        joined(lambda r: r["digit"] < F.col("_digit")).alias("before"), joined(lambda r: r["digit"] > F.col("_digit")).alias("after")
    )
    climbed = taking.join(family, same).select(
        group, "_block", "_blocks", F.sha2(joined(lambda r: F.lit(True)), 256).alias("digest"), F.concat("path", F.array(step)).alias("path")
    )
    return climbed.unionByName(now.where(F.col("_blocks") <= stride))


def _forest(leaves: DataFrame, group: str, order: Sequence[str], columns: Sequence[str], fanout: int) -> tuple[DataFrame, DataFrame]:
    """The blocks with their ``items``, and for each block its ``path`` and its group's root as ``digest``."""
    kind = leaves.schema[group].dataType.simpleString()
    blocks = stored(_blocks(_ordered_places(leaves, group, order), group, fanout**BLOCK_LEVELS, columns))
    return blocks, _climb(_roots(blocks, group, kind, fanout), group, fanout)


def _with_paths(blocks: DataFrame, paths: DataFrame, group: str) -> DataFrame:
    """Each block with its row of ``paths``."""
    above = paths.withColumnsRenamed({group: "_g", "_block": "_b"})
    return blocks.join(above, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_block") == F.col("_b"))).drop("_g", "_b")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Row by row, since one row is a block."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def manifest(
    docs: DataFrame,
    fields: Sequence[str],
    id_col: str = "doc_id",
    group_col: str = "source",
    fanout: int = 16,
    changed: dict[str, Column] | None = None,
    changed_where: Column | None = None,
    proofs: bool = True,
) -> DataFrame:
    """A leaf digest per row, a tree per group, a tree over the groups' roots, and a proof per row.

    Returns one row per row of ``docs``: ``id_col, group_col, leaf, subroot, root``; ``proof_sha256``,
    the digest of all siblings from the leaf to the root, left to right within a level; ``folded_root``,
    worked out anew from the leaf and the siblings, and ``verified``, whether it equals the root. With
    ``proofs`` also ``siblings``, per level the siblings before and after the row's ancestor.
    To test that a change is found, ``changed`` gives other expressions for some of ``fields``; rows
    where ``changed_where`` holds are folded from the digest of those.

    Leaves ascend by id in a group, groups by name; nulls come first, and form a group of their own.
    Rows that share an id are in the order of their digests, and equal rows have one digest, so their
    order does not matter; they count as often as they occur, and are counted before they are dealt
    out. Null and empty fields differ. An empty table gives an empty result. Extra columns are ignored.

    A leaf's texts are read once; after that only digests move. Blocks of ``fanout ** 3`` leaves are the
    unit of work, so no group has to fit a task. The first level's digests are rebuilt from a written
    table where an executor is lost, the rounds are checkpointed.
    """
    fields_now = [F.col(f) for f in fields]
    leaf = row_digest(*fields_now)
    other = leaf
    if changed:
        given = F.coalesce(changed_where, F.lit(False)) if changed_where is not None else F.lit(True)
        other = F.when(given, row_digest(*((changed.get(f, F.col(f))) for f in fields)))
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(group_col).alias("_group"), leaf.alias("leaf"), (other if changed else F.lit(None).cast("string")).alias("other")
    )
    id_kind, group_kind = (rows.schema[c].dataType.simpleString() for c in ("_id", "_group"))
    counted = rows.groupBy("_id", "_group", "leaf", "other").agg(F.count(F.lit(1)).alias("_copies"))
    blocks, climbed = _forest(counted, "_group", ["_id", "leaf", "other"], ["_id", "leaf", "other"], fanout)

    # the tree over the groups: one leaf for each, with its subroot
    subroots = climbed.where("_block = 0").select(
        F.lit(0).alias("_all"), F.col("_group").alias("_name"), F.col("digest").alias("leaf"), F.lit(1).cast("long").alias("_copies")
    )
    top_blocks, top_climbed = _forest(subroots, "_all", ["_name"], ["_name", "leaf"], fanout)
    top = _top_paths(_with_paths(top_blocks, top_climbed, "_all"), group_kind, fanout)
    paths = climbed.withColumnRenamed("digest", "subroot").join(top, F.col("_group").eqNullSafe(F.col("_name"))).drop("_name")
    proved = _prove(_with_paths(blocks, paths, "_group"), id_kind, group_kind, fanout, proofs)
    return proved.withColumnsRenamed({"_id": id_col, "_group": group_col})


def _steps(tree: list[list[str]], place: int, fanout: int) -> list[tuple[str, str]]:
    """The siblings before and after a leaf's ancestor, joined, on each level of a block's tree."""
    found = []
    for level in tree[:-1]:
        start = place - place % fanout
        found.append(("".join(level[start:place]), "".join(level[place + 1 : start + fanout])))
        place //= fanout
    return found


_PATH = "array<struct<before:string,after:string>>"
_ARROW_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def _top_paths(top: DataFrame, group_kind: str, fanout: int) -> DataFrame:
    """``_name, top_path, root`` per group."""
    name_type = to_arrow_type(top.schema["items"].dataType.elementType["_name"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            items = row["items"]
            tree = _tree([i["leaf"] for i in items], fanout, _levels_of(row["_block"], len(items), fanout))
            paths = [[{"before": b, "after": a} for b, a in _steps(tree, i["first"], fanout)] + row["path"] for i in items]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i["_name"] for i in items], name_type), pa.array(paths, _ARROW_PATH), pa.array([row["digest"]] * len(items), pa.string())],
                names=["_name", "top_path", "root"],
            )

    chosen = top.select("_block", "items", "path", "digest")
    return cut(chosen.mapInArrow(run, f"_name {group_kind}, top_path {_PATH}, root string"))


def _prove(whole: DataFrame, id_kind: str, group_kind: str, fanout: int, proofs: bool) -> DataFrame:
    """One row per leaf, from its block's tree and the two paths above it."""
    names = ["_id", "_group", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    kinds = [id_kind, group_kind, *["string"] * 5, "boolean"]
    if proofs:
        names, kinds = [*names, "siblings"], [*kinds, _PATH]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    arrow = pa.schema(
        [("_id", to_arrow_type(whole.schema["items"].dataType.elementType["_id"].dataType)), ("_group", to_arrow_type(whole.schema["_group"].dataType))]
        + [(n, pa.string()) for n in names[2:7]]
        + [("verified", pa.bool_()), ("siblings", _ARROW_PATH)][: len(names) - 7]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            items, root = row["items"], row["root"]
            leaves = [i["leaf"] for i in items for _ in range(i["first"], i["last"] + 1)]
            tree = _tree(leaves, fanout, _levels_of(row["_block"], len(leaves), fanout))
            above = [(s["before"], s["after"]) for s in [*row["path"], *row["top_path"]]]
            upper = "".join(b + a for b, a in above)
            found = []
            for item in items:
                for place in range(item["first"], item["last"] + 1):
                    steps = _steps(tree, place, fanout)
                    node = item["leaf"] if item["other"] is None else item["other"]
                    for before, after in [*steps, *above]:
                        node = _digest(before + node + after)
                    proof = _digest("".join(b + a for b, a in steps) + upper)
                    found.append([item["_id"], row["_group"], item["leaf"], row["subroot"], root, proof, node, node == root])
                    if proofs:
                        found[-1].append([{"before": b, "after": a} for b, a in [*steps, *above]])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), arrow, strict=True)], schema=arrow)

    return whole.select("_block", "items", "path", "top_path", "subroot", "root", "_group").mapInArrow(run, schema)


def fold(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf's digest and its ``siblings`` give, as Spark's own expression."""
    return F.aggregate(siblings, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))
