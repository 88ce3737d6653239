"""Near-duplicates by SimHash fingerprints and a hierarchical index in Gray order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonframe.llm.common import cut, over_sorted_groups, pair_blocks, whole_text
from seasonframe.llm.components import connected_components

WORDS_PER_SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Rows of a block of the index, and children of a node.
SLICE_ROWS = 1024
FAN = 8
#: Queries that walk the index at a time: bounds the frontier.
QUERY_ROWS = 8192
#: Shingles whose bits are counted at a time.
_COUNT_ROWS = 1 << 16


def fingerprint(text: str, words_per_shingle: int = WORDS_PER_SHINGLE) -> int:
    """64 majority bits of the XXH64 values of the word shingles; 0 without a word."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    join, digest = b" ".join, xxhash.xxh64_intdigest
    if len(words) < words_per_shingle:
        shingles = iter((join(words),))
        total = 1
    else:
        shingles = map(join, zip(*(words[i:] for i in range(words_per_shingle)), strict=False))
        total = len(words) - words_per_shingle + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, total, _COUNT_ROWS):
        size = min(_COUNT_ROWS, total - start)
        hashes = np.fromiter((digest(s, SEED) for _, s in zip(range(size), shingles)), np.uint64, size)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(size, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * ones > total))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int = WORDS_PER_SHINGLE) -> DataFrame:
    """``_id`` and ``_fp`` (the 64 bits as a signed long) of each document's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py(), words_per_shingle) for t in batch.column("_text")), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(found.view(np.int64))], names=["_id", "_fp"])

    chosen = docs.select(F.col(id_col).alias("_id"), whole_text(F.col(text_col)).alias("_text"))
    id_type = chosen.schema["_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"_id {id_type}, _fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence, in which neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(codes: np.ndarray, group: np.ndarray) -> list[dict[str, np.ndarray]]:
    """The index over codes sorted by (group, Gray rank), from its members up to one root per group.

    A node holds the bits that all members below share (``mask``) and their values (``pattern``).
    """
    full = np.full(len(codes), np.uint64(0xFFFFFFFFFFFFFFFF))
    levels = [{"mask": full, "pattern": codes, "group": group}]
    while True:
        below = levels[-1]
        starts = np.flatnonzero(np.r_[True, below["group"][1:] != below["group"][:-1]])
        if len(starts) == len(below["group"]) and len(levels) > 1:
            return levels
        sizes = np.diff(np.r_[starts, len(below["group"])])
        within = np.arange(len(below["group"])) - np.repeat(starts, sizes)
        heads = np.flatnonzero(within % FAN == 0)
        every = np.bitwise_and.reduceat(below["pattern"], heads)
        some = np.bitwise_or.reduceat(below["pattern"], heads)
        mask = np.bitwise_and.reduceat(below["mask"], heads) & ~(every ^ some)
        below["parent_mask"] = np.repeat(mask, np.diff(np.r_[heads, len(within)]))
        levels.append(
            {
                "mask": mask,
                "pattern": every & mask,
                "group": below["group"][heads],
                "first": heads,
                "count": np.diff(np.r_[heads, len(within)]),
            }
        )


def _matches(levels: list[dict[str, np.ndarray]], queries: np.ndarray, roots: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) pairs within ``most`` bits; roots: each query's root in the top level.

    A query carries the differences met so far down the tree. At a node only the bits which its
    parent does not share are compared, and the node's whole group goes once the sum exceeds
    ``most``.
    """
    top = levels[-1]
    query = np.arange(len(queries))
    node = roots
    spent = np.bitwise_count((queries ^ top["pattern"][node]) & top["mask"][node]).astype(np.int16)
    alive = spent <= most
    query, node, spent = query[alive], node[alive], spent[alive]
    for depth in range(len(levels) - 1, 0, -1):
        upper, lower = levels[depth], levels[depth - 1]
        count = upper["count"][node]
        query, spent = np.repeat(query, count), np.repeat(spent, count)
        ends = np.cumsum(count)
        node = np.repeat(upper["first"][node] - (ends - count), count) + np.arange(len(query))
        residual = lower["mask"][node] & ~lower["parent_mask"][node]
        spent = spent + np.bitwise_count((queries[query] ^ lower["pattern"][node]) & residual).astype(np.int16)
        alive = spent <= most
        query, node, spent = query[alive], node[alive], spent[alive]
    return query, node


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the place of a smaller member or its own) after joining the pairs ``a``, ``b``."""
    while True:
        one, other = labels[a], labels[b]
        apart = one != other
        if not apart.any():
            return labels
        a, b = a[apart], b[apart]
        low, high = np.minimum(one[apart], other[apart]), np.maximum(one[apart], other[apart])
        np.minimum.at(labels, high, low)
        while not np.array_equal(shorter := labels[labels], labels):
            labels = shorter


def linked(codes: np.ndarray, group: np.ndarray, side: np.ndarray, cross: np.ndarray, most: int) -> np.ndarray:
    """A label per code: codes of a group that are linked, directly or in steps, share it.

    ``side``: the slice of a code; where ``cross`` is set only pairs of different slices are compared.
    """
    order = np.lexsort((gray_rank(codes), group))
    levels = _levels(codes[order], group[order])
    side, cross = side[order], cross[order]
    root_of = np.searchsorted(levels[-1]["group"], group[order])
    labels = np.arange(len(codes))
    for start in range(0, len(codes), QUERY_ROWS):
        stop = min(start + QUERY_ROWS, len(codes))
        query, member = _matches(levels, codes[order][start:stop], root_of[start:stop], most)
        query = query + start
        wanted = (query < member) & ~(cross[query] & (side[query] == side[member]))
        labels = merge_labels(labels, query[wanted], member[wanted])
    found = np.empty(len(codes), np.int64)
    found[order] = order[labels]
    return found


def fingerprint_links(prints: DataFrame, most: int = MAX_BITS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Edges ``u, v`` among distinct fingerprints (column ``_fp``): a spanning forest of each block's links.

    Two codes at most ``most`` bits apart agree on one of ``most + 1`` bit ranges, the top level of
    the index: codes meet under each of their ranges' patterns. Below it every block is indexed in
    Gray order. All links within a block are searched, but only its forest is returned.
    """
    bounds = [64 * i // (most + 1) for i in range(most + 2)]
    tops = [
        F.struct(
            F.lit(i).alias("_range"),
            F.shiftrightunsigned("_fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1 if high - low < 64 else -1)).alias("_bits"),
        )
        for i, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False))
    ]
    rows = prints.select("_fp", F.explode(F.array(*tops)).alias("_top")).select("_fp", "_top._range", "_top._bits")
    blocks = pair_blocks(rows, ["_range", "_bits"], "_fp", slice_rows)
    keys = ["_range", "_bits", "low", "high"]

    def run(groups: pa.Table) -> pa.Table:
        code = groups["_fp"].to_numpy().view(np.uint64)
        key = [groups[k].to_numpy() for k in keys]
        new = np.any([k[1:] != k[:-1] for k in key], axis=0) if len(code) > 1 else np.zeros(0, bool)
        group = np.r_[0, np.cumsum(new)].astype(np.int64)
        label = linked(code, group, groups["slice"].to_numpy(), key[2] < key[3], most)
        other = np.flatnonzero(label != np.arange(len(code)))
        signed = code.view(np.int64)
        return pa.table({"u": signed[other], "v": signed[label[other]]})

    return over_sorted_groups(blocks, keys, run, "u long, v long")


def simhash_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    words_per_shingle: int = WORDS_PER_SHINGLE,
    most: int = MAX_BITS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per input row: ``id_col, fingerprint, component_id``.

    Letters A-Z are lowered, words are runs without ASCII white space, shingles repeat as often as
    they occur; with fewer words than a shingle takes the whole sequence is one, and without any the
    fingerprint is zero. Fingerprints that differ in ``most`` bits or fewer link; ``component_id`` is
    the smallest id that links reach, the row's own included. The search is exact: no cap on buckets,
    partners or group sizes. Documents of equal fingerprint enter the index as one.

    A null text counts as empty; empty texts share fingerprint zero and link to each other. A null id
    takes part but never is the smallest; a component of null ids only has a null id. Repeated rows
    stay rows. Extra columns are ignored, and an empty table gives an empty result.
    """
    prints = cut(fingerprints(docs, id_col, text_col, words_per_shingle))
    distinct = prints.groupBy("_fp").agg(F.min("_id").alias("_least"))
    component = connected_components(fingerprint_links(distinct.select("_fp"), most, slice_rows))
    placed = distinct.join(component, distinct["_fp"] == component["node"], "left").select(
        "_fp", "_least", F.coalesce("component", "_fp").alias("_root")
    )
    least = placed.groupBy("_root").agg(F.min("_least").alias("component_id"))
    by_print = placed.join(least, "_root").select("_fp", "component_id")
    return prints.join(by_print, "_fp").select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
