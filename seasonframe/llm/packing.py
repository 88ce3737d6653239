"""Best-fit packing of token sequences, certified by dual-feasible-function bounds."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonframe.llm.common import cut, over_sorted_groups, whole_text
from seasonframe.llm.tokens import byte_encoder

CAPACITY = 1024
END_ID = 2
#: Pieces of a partition that one task packs.
PART_ROWS = 32768
#: Times that partitions with a gap exchange their documents.
ROUNDS = 3
#: Denominators of the rounding functions tried as bounds.
_STEPS = 32
#: Ids of a task that wait to be sent on.
_HELD_IDS = 1 << 19


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing of the lengths needs: the best of two families of dual feasible functions.

    A dual feasible function never lets the values of a bin's items exceed one, so the values' sum
    is a bound. The first family drops items below a threshold and counts those above its
    complement as whole bins; the second rounds sizes down to multiples of 1/k, strictly between.
    """
    if len(lengths) == 0:
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(object)
    size = np.arange(capacity + 1)
    total = int((count * size).sum())
    best = -(-total // capacity)
    tail_n = np.r_[np.cumsum(count[::-1])[::-1], 0]  # items of at least this size
    tail_sum = np.r_[np.cumsum((count * size)[::-1])[::-1], 0]
    for threshold in range(1, capacity // 2 + 1):
        over = capacity - threshold + 1
        whole = int(tail_n[over])
        rest = int(tail_sum[threshold] - tail_sum[over])
        best = max(best, whole - (-rest // capacity))
    for k in range(1, _STEPS + 1):
        scaled = size * (k + 1)
        exact = scaled % capacity == 0
        # in units of 1 / (k * capacity)
        value = np.where(exact, size * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length (sorted, longest first), and what each bin holds.

    Each item goes to the fullest bin with room. Bins wait by the room they have left, and one bit
    per amount of room tells which amounts exist.
    """
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    exists, filled = 0, []
    for i, length in enumerate(lengths.tolist()):
        fitting = exists >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = waiting[room].pop()
            if not waiting[room]:
                exists ^= 1 << room
        else:
            room, chosen = capacity, len(filled)
            filled.append(0)
        bin_of[i], offset[i] = chosen, filled[chosen]
        filled[chosen] += length
        left = room - length
        if left:
            waiting[left].append(chosen)
            exists |= 1 << left
    return bin_of, offset, np.array(filled, np.int64)


def pack(
    pieces: DataFrame,
    keys: list[str],
    length_col: str = "length",
    *,
    capacity: int = CAPACITY,
    part_rows: int = PART_ROWS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``keys`` and ``length_col`` of each row with ``sequence_id`` and ``offset``, in few sequences.

    ``keys`` name a row. Lengths are from 1 to ``capacity``; others raise. Rows are dealt by the hash
    of their key and a number of their own to partitions of about ``part_rows`` and each is packed longest first, best fit. A
    partition whose bin count equals its lower bound is certified and stays. The others keep their
    full bins, exchange the documents of the rest and pack again, for up to ``rounds`` rounds or
    until a round saves no bin. Every row keeps a place; rows that repeat a key are placed as rows of
    their own. An empty table gives an empty result.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    pool = pieces.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(length_col).cast("long").alias("_length"))
    # numbered where the checkpoint is written, so that rows that repeat a key are dealt apart
    pool = cut(pool.withColumn("_row", F.monotonically_increasing_id()))
    names = [*names, "_row"]
    pool = pool.withColumn(
        "_length",
        F.when(F.col("_length").between(1, capacity), F.col("_length")).otherwise(
            F.raise_error(F.concat(F.lit(f"a length outside 1 to {capacity}: "), F.coalesce(F.col("_length").cast("string"), F.lit("null"))))
        ),
    )
    settled: list[DataFrame] = []
    kept: DataFrame | None = None
    bins_before = None
    for turn in range(rounds + 1):
        n = pool.count()
        if n == 0:
            break
        packed = cut(_pack_parts(pool, names, turn, max(1, -(-n // part_rows)), capacity))
        open_rows = packed.where("_open")
        bins = packed.agg(F.countDistinct("_bin")).first()[0] if kept is not None else None
        if kept is not None and bins >= bins_before:
            break  # the exchange saved nothing: the earlier places stay
        settled.append(packed.where("not _open"))
        kept, pool = open_rows, open_rows.select(*names, "_length")
        bins_before = kept.agg(F.countDistinct("_bin")).first()[0]
        if bins_before <= 1:
            break
    if kept is not None:
        settled.append(kept)
    if not settled:
        settled.append(_pack_parts(pool, names, 0, 1, capacity))
    result = settled[0]
    for more in settled[1:]:
        result = result.unionByName(more)
    return result.select(
        *[F.col(n).alias(k) for k, n in zip(keys, names, strict=False)],
        F.col("_length").alias(length_col),
        F.col("_bin").alias("sequence_id"),
        F.col("_offset").alias("offset"),
    )


def _pack_parts(pool: DataFrame, names: list[str], turn: int, parts: int, capacity: int) -> DataFrame:
    """Every row's place, and whether it lies in a bin with room of a partition that has a gap."""
    dealt = pool.withColumn("_part", F.pmod(F.xxhash64(F.lit(turn), *names), F.lit(parts)))

    def run(groups: pa.Table) -> pa.Table:
        part = groups["_part"].to_numpy()
        starts = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, len(part)]
        place, offset, is_open = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64), np.zeros(len(part), bool)
        lengths = -groups["_down"].to_numpy()
        for first, end in zip(starts[:-1], starts[1:], strict=True):
            own = lengths[first:end]
            bin_of, at, filled = best_fit_decreasing(own, capacity)
            place[first:end] = (turn << 58) + (int(part[first]) << 28) + bin_of
            offset[first:end] = at
            if len(filled) > lower_bound(own, capacity):
                is_open[first:end] = filled[bin_of] < capacity
        placed = {"_length": lengths, "_bin": place, "_offset": offset, "_open": is_open}
        return pa.table({n: groups[n] for n in names} | {k: pa.array(v) for k, v in placed.items()})

    kinds = {f.name: f.dataType.simpleString() for f in pool.schema}
    schema = ", ".join([*(f"{n} {kinds[n]}" for n in names), "_length long", "_bin long", "_offset long", "_open boolean"])
    return over_sorted_groups(
        dealt.withColumn("_down", -F.col("_length")).drop("_length"), ["_part"], run, schema, ["_down", *names]
    )


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32`` and ``ids`` per piece; only the first piece of a cut
    document may be short.

    A null text counts as empty and gives the end id alone. ``with_ids=False`` leaves the ids themselves
    out, where their place and sum are enough.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(tokenizer)
        for batch in batches:
            rows, piece, start, ids = [], [], [], []
            held = 0
            for row, text in enumerate(batch.column("_text")):
                own = np.append(encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                head = len(own) if len(own) <= capacity else len(own) % capacity or capacity
                edges = [0, *range(head, len(own) + 1, capacity)]
                for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    rows.append(row)
                    piece.append(i)
                    start.append(a)
                    ids.append(own[a:b])
                held += len(own)
                if held > _HELD_IDS:
                    yield _piece_batch(batch.column("_id"), rows, piece, start, ids, with_ids)
                    rows, piece, start, ids, held = [], [], [], [], 0
            if rows:
                yield _piece_batch(batch.column("_id"), rows, piece, start, ids, with_ids)

    chosen = docs.select(F.col(id_col).alias("_id"), whole_text(F.col(text_col)).alias("_text"))
    kind = chosen.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return chosen.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def _piece_batch(
    id_column: pa.Array, rows: list[int], piece: list[int], start: list[int], ids: list[np.ndarray], with_ids: bool
) -> pa.RecordBatch:
    sizes = [len(x) for x in ids]
    columns = {
        "_id": id_column.take(pa.array(rows)),
        "piece": pa.array(piece, pa.int32()),
        "start": pa.array(start, pa.int64()),
        "length": pa.array(sizes, pa.int64()),
        "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
    }
    if with_ids:
        ends = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
        columns["ids"] = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids).astype(np.int32)))
    return pa.RecordBatch.from_pydict(columns)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    part_rows: int = PART_ROWS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset``.

    Documents are encoded by the tokenizer file (strings of special tokens in a text give their ids)
    and end with ``end_id``. Longer ones than ``capacity`` are cut, with the short piece first. Join
    ``token_pieces`` on the id and piece for the ids themselves. Null texts count as empty; a null id
    and repeated rows are packed like any other, and rows that repeat are dealt apart. An empty table
    gives an empty result. Extra columns are ignored.
    """
    pieces = token_pieces(docs, tokenizer, id_col, text_col, capacity=capacity, end_id=end_id, with_ids=False)
    placed = pack(pieces.withColumnRenamed(id_col, "_id"), ["_id", "piece", "start", "ids_crc32"], capacity=capacity, part_rows=part_rows, rounds=rounds)
    return placed.select(F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
