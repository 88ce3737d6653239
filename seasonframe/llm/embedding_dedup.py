"""Embedding near-duplicates by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonframe.llm.common import cut, over_sorted_groups, pair_blocks
from seasonframe.llm.components import connected_components
from seasonframe.llm.simhash import merge_labels

COSINE = 0.98
#: Hash tables, hash functions joined to a table's bucket, and rounds of signs and Hadamard transform.
TABLES = 6
FUNCTIONS = 2
ROUNDS = 3
#: Vectors of a block in which all pairs of a bucket are compared.
SLICE_ROWS = 1024
SEED = 42


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    width, out, half = rows.shape[1], rows.copy(), 1
    while half < width:
        view = out.reshape(len(out), width // (2 * half), 2, half)
        top, low = view[:, :, 0, :] + view[:, :, 1, :], view[:, :, 0, :] - view[:, :, 1, :]
        view[:, :, 0, :], view[:, :, 1, :] = top, low
        half *= 2
    return out


def buckets(rows: np.ndarray, tables: int = TABLES, functions: int = FUNCTIONS, seed: int = SEED) -> np.ndarray:
    """Codes of shape (rows, tables, 1 + functions): a vector's bucket, then its probes.

    A function rotates by signs and Hadamard transforms and takes the nearest corner of the
    cross-polytope, the coordinate of largest size with its sign. A probe replaces one function's
    corner by the next nearest. The rotations depend on the width and the seed alone.
    """
    width = 1 << max(0, rows.shape[1] - 1).bit_length()
    padded = np.zeros((len(rows), width))
    padded[:, : rows.shape[1]] = rows
    random = np.random.default_rng([seed, width])
    out = np.zeros((len(rows), tables, 1 + functions), np.int64)
    place = np.arange(len(rows))
    for t in range(tables):
        corners, seconds = [], []
        for _ in range(functions):
            turned = padded
            for _ in range(ROUNDS):
                turned = hadamard(turned * random.choice((-1.0, 1.0), width)) / np.sqrt(width)
            size = np.abs(turned)
            best = size.argmax(axis=1)
            corners.append(2 * best + (turned[place, best] < 0))
            size[place, best] = -1
            next_best = size.argmax(axis=1)
            seconds.append(2 * next_best + (turned[place, next_best] < 0))
        for probe in range(1 + functions):
            code = np.zeros(len(rows), np.int64)
            for f in range(functions):
                code = code * (2 * width) + (seconds[f] if probe == f + 1 else corners[f])
            out[:, t, probe] = code
    return out


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that no square over- or underflows."""
    wide = values.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), width)


def _bucket_rows(classes: DataFrame, tables: int, functions: int) -> DataFrame:
    """Each class once in its bucket of every table and once in each bucket it probes."""
    per_row = tables * (1 + functions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = np.asarray(batch.column("_width"))
            for width in np.unique(widths):
                same = batch.filter(pa.array(widths == width))
                for start in range(0, same.num_rows, 1024):
                    part = same.slice(start, 1024)
                    codes = buckets(unit_rows(_matrix(part.column("_vector"), int(width))), tables, functions)
                    again = pa.array(np.repeat(np.arange(part.num_rows), per_row))
                    flat = pa.array(codes.reshape(-1).astype(np.int64))
                    all_codes = pa.FixedSizeListArray.from_arrays(flat, per_row).cast(pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(part.column(c).take(again) for c in ("_group", "_rep", "_copies", "_width", "_vector")),
                            all_codes.take(again),
                            pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), 1 + functions), part.num_rows)),
                            flat,
                        ],
                        names=["_group", "_rep", "_copies", "_width", "_vector", "_codes", "_table", "_bucket"],
                    )

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    return classes.mapInArrow(
        run,
        f"_group {kinds['_group']}, _rep {kinds['_rep']}, _copies long, _width int, _vector {kinds['_vector']}, "
        "_codes array<bigint>, _table int, _bucket bigint",
    )


def _first_meeting(one: np.ndarray, other: np.ndarray, table: int, bucket: int) -> np.ndarray:
    """Whether a pair (codes of both) meets here first: no earlier table, no smaller bucket of this one."""
    same_first = one[:, :, 0][:, :, None] == other  # the first's bucket among the second's codes
    same_second = other[:, :, 0][:, :, None] == one
    in_second, in_first = same_first.any(axis=2), same_second.any(axis=2)
    earlier = (in_second | in_first)[:, :table].any(axis=1)
    far = np.iinfo(np.int64).max
    least = np.minimum(
        np.where(in_second[:, table], one[:, table, 0], far), np.where(in_first[:, table], other[:, table, 0], far)
    )
    return ~earlier & (least == bucket)


def _found(members: dict[str, np.ndarray], start: int, stop: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (places) of one block that meet here first."""
    table, bucket = int(members["_table"][start]), int(members["_bucket"][start])
    codes = members["_codes"][start:stop]
    home = codes[:, table, 0] == bucket
    if not home.any() or stop - start < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    unit, side = unit_rows(members["_vector"][start:stop]), members["slice"][start:stop]
    cross = members["low"][start] < members["high"][start]
    near = np.triu(unit @ unit.T >= cosine, 1)
    near &= home[:, None] | home[None, :]
    if cross:
        near &= side[:, None] != side[None, :]
    i, j = np.nonzero(near)
    keep = np.zeros(len(i), bool)
    for a in range(0, len(i), 65536):
        keep[a : a + 65536] = _first_meeting(codes[i[a : a + 65536]], codes[j[a : a + 65536]], table, bucket)
    return i[keep] + start, j[keep] + start


def _links(rows: DataFrame, cosine: float, tables: int, functions: int, slice_rows: int) -> DataFrame:
    """Per block and class: links found there (``_n``), and the class it hangs on in the block's forest (``_to``)."""
    keys = ["_group", "_width", "_table", "_bucket"]
    blocks = pair_blocks(rows, keys, "_rep", slice_rows)
    block_keys = [*keys, "low", "high"]
    rep_type = rows.schema["_rep"].dataType.simpleString()

    def run(groups: pa.Table) -> pa.Table:
        size = groups.num_rows
        key = [groups[k].combine_chunks().dictionary_encode() for k in block_keys]
        codes = [np.asarray(k.indices) for k in key]
        new = np.any([c[1:] != c[:-1] for c in codes], axis=0) if size > 1 else np.zeros(0, bool)
        starts = np.r_[0, np.flatnonzero(new) + 1, size]
        copies, rep = groups["_copies"].to_numpy(), groups["_rep"].combine_chunks()
        place, count, to = [], [], []
        small = {k: groups[k].to_numpy() for k in ("_table", "_bucket", "slice", "low", "high")}
        for first, end in zip(starts[:-1], starts[1:], strict=True):
            if end - first < 2:
                continue
            part = groups.slice(first, end - first)
            width = part["_width"][0].as_py()
            members = {k: v[first:end] for k, v in small.items()} | {
                "_vector": _matrix(part["_vector"], width),
                "_codes": _matrix(part["_codes"], tables * (1 + functions)).reshape(-1, tables, 1 + functions),
            }
            i, j = _found(members, 0, end - first, cosine)
            if not len(i):
                continue
            total = np.zeros(end - first, np.int64)
            np.add.at(total, i, copies[first + j])
            np.add.at(total, j, copies[first + i])
            labels = merge_labels(np.arange(end - first), i, j)
            hit = np.flatnonzero(total)
            place.append(hit + first)
            count.append(total[hit])
            to.append(labels[hit] + first)
        at = np.concatenate(place) if place else np.zeros(0, np.int64)
        onto = np.concatenate(to) if to else np.zeros(0, np.int64)
        n = np.concatenate(count) if count else np.zeros(0, np.int64)
        return pa.table({"_rep": rep.take(pa.array(at)), "_n": pa.array(n), "_to": rep.take(pa.array(onto))})

    return over_sorted_groups(blocks, block_keys, run, f"_rep {rep_type}, _n long, _to {rep_type}")


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    group_col: str = "label",
    *,
    cosine: float = COSINE,
    tables: int = TABLES,
    functions: int = FUNCTIONS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per vector: ``id_col, n_links, component_id, kept``.

    Two vectors link if their groups are equal and not null and their cosine in double precision is at
    least ``cosine``. Candidates come from ``tables`` hash tables with probes and every one is verified;
    every vector is indexed and bucket sizes have no cap. Equal vectors enter the index as one class
    with a count. A pair counts in the first table and bucket where it meets, so links are
    summed without listing pairs, and a block returns only a forest of its links. Pairs that meet in
    no table are missed (the README has the measured recall).

    A vector that is null, empty, zero or holds a null, NaN or infinity links with nothing, nor does
    one whose group is null; vectors of different widths never link. Ids are taken as they are: rows
    that repeat an id count as vectors of their own, and a null id links with nothing. ``component_id``
    is the smallest id that links reach. Extra columns are ignored; an empty table gives an empty result.
    """
    chosen = vectors.select(
        F.col(id_col).alias("_id"), F.col(group_col).alias("_group"), F.col(vector_col).alias("_vector")
    )
    usable = _usable(F.col("_vector")) & F.col("_group").isNotNull() & F.col("_id").isNotNull()
    # numbered where the checkpoint is written: an id may stand on different vectors
    classes = cut(
        chosen.where(usable)
        .groupBy("_group", "_vector")
        .agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_copies"))
        .withColumns({"_rep": F.monotonically_increasing_id(), "_width": F.size("_vector")})
    )
    found = cut(_links(_bucket_rows(classes.drop("_least"), tables, functions), cosine, tables, functions, slice_rows))
    links = found.groupBy("_rep").agg(F.sum("_n").alias("_n"))
    component = cut(connected_components(found, "_rep", "_to"))
    least = classes.select(F.col("_rep").alias("node"), "_least").join(component, "node").groupBy("component").agg(F.min("_least").alias("_smallest"))
    named = component.join(least, "component").select("node", "_smallest")
    known = (
        classes.join(links, "_rep", "left")
        .join(named, F.col("_rep") == F.col("node"), "left")
        .select("_group", "_vector", "_copies", "_n", F.coalesce("_smallest", "_least").alias("component"))
    )
    same = (
        chosen.withColumn("_key", F.when(usable, F.col("_vector")))
        .alias("a")
        .join(known.alias("k"), (F.col("a._group") == F.col("k._group")) & (F.col("a._key") == F.col("k._vector")), "left")
    )
    component_id = F.coalesce(F.col("k.component"), F.col("a._id"))
    return same.select(
        F.col("a._id").alias(id_col),
        (F.coalesce(F.col("k._copies") - 1, F.lit(0)) + F.coalesce(F.col("k._n"), F.lit(0))).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        F.col("a._id").eqNullSafe(component_id).alias("kept"),
    )
