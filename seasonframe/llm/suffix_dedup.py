"""Removal of long repeated byte strings, by distributed merge sort of suffixes in front-coded runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonframe.llm.common import over_sorted_groups, stored, whole_text

MIN_BYTES = 400
#: Bytes of the strings whose hashes choose the suffixes that are sorted.
GRAM = 64
#: Sorted contexts of a bucket, and contexts with one gram that are compared with each other.
BUCKET_ITEMS = 20_000
GROUP_ITEMS = 8_192
#: Items up to which what all pairs share is held at once.
_SQUARE_ITEMS = 512
#: Bytes of contexts that make a run, and of text that is hashed at a time.
RUN_BYTES = 32 << 20
CHUNK_BYTES = 2 << 20
SEED = 42

_MASK = (1 << 64) - 1
_FACTOR = 0x9E3779B97F4A7C15 | 1
_PLACE_BITS = 24


class Anchors:
    """Chooses, for every ``least``-byte window of a text, one place in it by its content alone.

    The place is the leftmost start of the gram with the smallest hash in the window, so equal
    windows choose equal places. Neighbouring windows mostly agree: there are far fewer anchors than windows.
    """

    def __init__(self, least: int, gram: int):
        self.least, self.gram = least, gram
        self.window = least - gram + 1
        self.size = CHUNK_BYTES + 4 * least
        inverse = pow(_FACTOR, -1, 1 << 64)
        self.up, self.down = self._powers(_FACTOR), self._powers(inverse)
        self.byte = np.random.default_rng(SEED).integers(1, _MASK, 256, dtype=np.uint64)

    def _powers(self, base: int) -> np.ndarray:
        out = np.full(self.size, np.uint64(base))
        out[0] = 1
        return np.multiply.accumulate(out)

    def __call__(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The anchor of each window of the bytes, and the hash of the gram that starts there."""
        n = len(data)
        value = np.zeros(n + 1, np.uint64)
        np.cumsum(self.byte[data] * self.up[:n], out=value[1:])
        grams = (value[self.gram :] - value[: -self.gram]) * self.down[: n - self.gram + 1]
        grams ^= grams >> np.uint64(31)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        grams ^= grams >> np.uint64(29)
        places = np.arange(len(grams), dtype=np.uint64)
        low = np.uint64((1 << _PLACE_BITS) - 1)
        least = (grams & ~low) | places
        span = 1
        while 2 * span <= self.window:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = self.window - span
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        anchor = (least & low).astype(np.int64)
        return anchor, grams


def _pieces(texts: list[bytes], least: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts joined to chunks: rows, where in its text each part begins, and the parts.

    Longer texts come in parts that overlap by all but one byte of a window.
    """
    rows, begins, parts, held = [], [], [], 0
    for row, text in enumerate(texts):
        for begin in range(0, max(1, len(text) - least + 1), CHUNK_BYTES):
            part = text[begin : begin + CHUNK_BYTES + least - 1]
            if len(part) < least:
                continue
            if held and held + len(part) > CHUNK_BYTES:
                yield rows, begins, parts
                rows, begins, parts, held = [], [], [], 0
            rows.append(row)
            begins.append(begin)
            parts.append(part)
            held += len(part)
    if parts:
        yield rows, begins, parts


def occurrences(texts: list[bytes], choose: Anchors) -> Iterator[tuple[int, int, int, int, int, int, int, int]]:
    """(row, gram hash, context hash as two numbers, anchor, first and last window, times) of each anchor.

    The windows from the first to the last choose this anchor; its context are the bytes of all of
    them. Contexts that repeat at even steps, as in runs of one byte, come once with their number.
    """
    least = choose.least
    for rows, begins, parts in _pieces(texts, least):
        joined = b"".join(parts)
        anchor, grams = choose(np.frombuffer(joined, np.uint8))
        sizes = np.array([len(p) for p in parts])
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        new = np.ones(len(anchor), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        inside = np.zeros(len(anchor), bool)
        for a, size in zip(starts.tolist(), sizes.tolist(), strict=True):
            inside[a : a + size - least + 1] = True
            new[a] = True
        first = np.flatnonzero(new & inside)
        ends_run = np.r_[new[1:] | ~inside[1:], True] & inside
        last = np.flatnonzero(ends_run)
        at = anchor[first]
        part_of = np.searchsorted(starts, first, side="right") - 1
        offset = (np.array(begins) - starts)[part_of]
        row_of = np.array(rows)[part_of]
        held: list[int] | None = None
        for row, h, a, lo, hi, shift in zip(
            row_of.tolist(), grams[at].view(np.int64).tolist(), at.tolist(), first.tolist(), last.tolist(), offset.tolist(), strict=True
        ):
            context = joined[lo : hi + least]
            digest = xxhash.xxh3_128_intdigest(context, a - lo)
            c, d = (digest >> 64) - (1 << 63), (digest & _MASK) - (1 << 63)
            if held and held[:4] == [row, h, c, d] and held[5] + held[8] == lo + shift and held[8] == hi - lo + 1:
                held[5] += held[8]  # the next repetition
                held[7] += 1
                continue
            if held:
                yield _closed(held)
            held = [row, h, c, d, a + shift, lo + shift, hi + shift, 1, hi - lo + 1]
        if held:
            yield _closed(held)


def _closed(held: list[int]) -> tuple[int, int, int, int, int, int, int, int]:
    row, h, c, d, anchor, last_lo, hi, times, step = held
    lo = last_lo - (times - 1) * step
    return row, h, c, d, anchor, lo, hi + (times - 1) * step, times


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Bytes that two strings share at their start; the first ``known`` are not compared."""
    size = min(len(a), len(b)) - known
    if size <= 0:
        return known
    differ = int.from_bytes(a[known : known + size], "big") ^ int.from_bytes(b[known : known + size], "big")
    return known + size - (differ.bit_length() + 7) // 8


def front_coded(items: list[bytes]) -> tuple[list[int], bytes, list[int]]:
    """A sorted run as prefix lengths shared with the item before, joined rests, and their ends."""
    shared, rests, ends, before, at = [], [], [], b"", 0
    for item in items:
        prefix = common_prefix(before, item)
        shared.append(prefix)
        rests.append(item[prefix:])
        at += len(item) - prefix
        ends.append(at)
        before = item
    return shared, b"".join(rests), ends


def front_decoded(shared: list[int], rests: bytes, ends: list[int]) -> Iterator[tuple[bytes, int]]:
    """Each item of a run and the length of the prefix it shares with the one before."""
    before, start = b"", 0
    for prefix, end in zip(shared, ends, strict=True):
        before = before[:prefix] + rests[start:end]
        start = end
        yield before, prefix


class LoserTree:
    """Merges sorted runs; knows each candidate's common prefix with the last winner.

    Of two candidates the one that shares more with the last winner is smaller, without a look at
    the strings; only equals are compared, from the end of the shared prefix on, and the loser
    remembers what it shares with its winner. So no prefix is compared twice.
    """

    def __init__(self, runs: list[Iterator[tuple[bytes, int]]]):
        self.runs = runs
        size = 1
        while size < len(runs):
            size *= 2
        self.size = size
        self.now: list[tuple[bytes, int] | None] = [next(r, None) for r in runs] + [None] * (size - len(runs))
        self.shared = [0] * size
        self.loser = [0] * size
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        won, lost = self._play(self._build(2 * node), self._build(2 * node + 1))
        self.loser[node] = lost
        return won

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's shared prefix becomes that with the winner."""
        one, other = self.now[a], self.now[b]
        if one is None or other is None:
            return (b, a) if one is None else (a, b)
        x, y = self.shared[a], self.shared[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        p = common_prefix(one[0], other[0], x)
        if one[0][p : p + 1] <= other[0][p : p + 1]:
            self.shared[b] = p
            return a, b
        self.shared[a] = p
        return b, a

    def __iter__(self) -> Iterator[tuple[int, bytes, int]]:
        """Run, item, and the length of the prefix it shares with the item before, in sorted order."""
        while (item := self.now[self.winner]) is not None:
            run = self.winner
            yield run, item[0], self.shared[run]
            following = next(self.runs[run], None)
            self.now[run] = following
            self.shared[run] = following[1] if following else 0
            won, node = run, (run + self.size) // 2
            while node:
                won, self.loser[node] = self._play(won, self.loser[node])
                node //= 2
            self.winner = won


def reaches(rights: list[int], lefts: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray]:
    """How far, left and right of its anchor, each item's repeated strings reach (0, 0: none).

    Items are sorted by what follows the anchor and ``rights[i]`` is the prefix that item ``i`` shares with
    ``i - 1``; ``lefts`` are the bytes before the anchors, backwards. Two items repeat a string over
    the anchor when what they share on both sides adds up to ``least``.
    """
    m = len(lefts)
    if m == 2:
        left, right = common_prefix(*lefts), rights[1]
        if left + right < least:
            return np.zeros(2, np.int64), np.zeros(2, np.int64)
        return np.full(2, left), np.full(2, right)
    order = sorted(range(m), key=lefts.__getitem__)
    shared = [0] + [common_prefix(lefts[order[i - 1]], lefts[order[i]]) for i in range(1, m)]
    rank = np.empty(m, np.int64)
    rank[order] = np.arange(m)
    if m > _SQUARE_ITEMS:
        return _reaches_by_row(np.array(rights), np.array(shared), rank, least)
    right, left = _all_shared(np.array(rights)), _all_shared(np.array(shared))
    left = left[rank][:, rank]
    enough = left + right >= least
    np.fill_diagonal(enough, False)
    return np.where(enough, left, 0).max(axis=1), np.where(enough, right, 0).max(axis=1)


def _reaches_by_row(rights: np.ndarray, shared: np.ndarray, rank: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for large groups, with memory for one item's row at a time."""
    lefts_reach, rights_reach = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
    for i in range(len(rank)):
        right, left = _shared_with(rights, i), _shared_with(shared, int(rank[i]))[rank]
        enough = left + right >= least
        if enough.any():
            lefts_reach[i], rights_reach[i] = left[enough].max(), right[enough].max()
    return lefts_reach, rights_reach


def _shared_with(neighbours: np.ndarray, i: int) -> np.ndarray:
    """What the sorted item ``i`` shares with each item, nothing with itself."""
    before = np.minimum.accumulate(neighbours[i:0:-1])[::-1]
    return np.concatenate([before, [0], np.minimum.accumulate(neighbours[i + 1 :])])


def _all_shared(neighbours: np.ndarray) -> np.ndarray:
    """Shared prefixes of all pairs of sorted items, from those of neighbours."""
    m = len(neighbours)
    out = np.zeros((m, m), np.int32)
    for i in range(m - 1):
        out[i, i + 1 :] = np.minimum.accumulate(neighbours[i + 1 :])
    return out + out.T


_SPANS = "_doc long, _version long, start long, end long"


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents with a key: the id (null: the least number) and a hash of the text."""
    text = whole_text(F.col(text_col))
    return docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("_doc"),
        F.xxhash64(text).alias("_version"),
        text.alias("_text"),
    )


def _anchors(texts: DataFrame, least: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        choose = Anchors(least, gram)
        names = ["_row", "_gram", "_c", "_d", "_anchor", "_lo", "_hi", "_times"]
        for batch in batches:
            found = list(occurrences([t.as_buffer().to_pybytes() for t in batch.column("_text")], choose))
            columns = dict(zip(names, (pa.array(c, pa.int64()) for c in zip(*found, strict=True)), strict=True)) if found else {}
            if columns:
                row = columns.pop("_row")
                owner = {k: batch.column(k).take(row) for k in ("_doc", "_version")}
                yield pa.RecordBatch.from_pydict(owner | columns)

    return texts.select("_doc", "_version", "_text").mapInArrow(
        run, "_doc long, _version long, _gram long, _c long, _d long, _anchor long, _lo long, _hi long, _times long"
    )


def _wanted(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes, list[dict]]]:
    for doc, version, text, items in zip(
        batch.column("_doc").to_pylist(), batch.column("_version").to_pylist(), batch.column("_text"), batch.column("_items").to_pylist(), strict=True
    ):
        yield doc, version, text.as_buffer().to_pybytes(), items


def _runs(with_text: DataFrame, least: int, buckets: int) -> DataFrame:
    """Front-coded runs of contexts, sorted by what follows the anchor; a row per run and bucket."""

    def flush(held: dict[int, list[tuple[bytes, bytes, int, int, int]]]) -> Iterator[pa.RecordBatch]:
        for bucket, items in held.items():
            items.sort()
            shared, rests, ends = front_coded([x[0] for x in items])
            left_shared, left_rests, left_ends = front_coded([x[1] for x in items])
            yield pa.RecordBatch.from_pydict(
                {
                    "_bucket": pa.array([bucket], pa.int64()),
                    "shared": pa.array([shared], pa.list_(pa.int32())),
                    "rests": pa.array([rests], pa.binary()),
                    "ends": pa.array([ends], pa.list_(pa.int32())),
                    "left_shared": pa.array([left_shared], pa.list_(pa.int32())),
                    "left_rests": pa.array([left_rests], pa.binary()),
                    "left_ends": pa.array([left_ends], pa.list_(pa.int32())),
                    "doc": pa.array([[x[2] for x in items]], pa.list_(pa.int64())),
                    "version": pa.array([[x[3] for x in items]], pa.list_(pa.int64())),
                    "anchor": pa.array([[x[4] for x in items]], pa.list_(pa.int64())),
                }
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[bytes, bytes, int, int, int]]] = {}
        size = 0
        for batch in batches:
            for doc, version, text, items in _wanted(batch):
                for item in items:
                    at = item["_anchor"]
                    right, left = text[at : item["_hi"] + least], text[item["_lo"] : at][::-1]
                    # an item whose context was found twice is complete: it only helps others
                    place = at if item["_n"] == 1 else -1
                    held.setdefault(item["_gram"] % buckets, []).append((right, left, doc, version, place))
                    size += len(right) + len(left)
                    if size > RUN_BYTES:
                        yield from flush(held)
                        held, size = {}, 0
        yield from flush(held)

    return with_text.mapInArrow(
        run,
        "_bucket long, shared array<int>, rests binary, ends array<int>, left_shared array<int>, left_rests binary, "
        "left_ends array<int>, doc array<bigint>, version array<bigint>, anchor array<bigint>",
    )


def _merged_spans(runs: pa.Table, least: int, gram: int) -> Iterator[tuple[int, int, int, int]]:
    """Spans that the contexts of one bucket repeat."""
    rows = runs.to_pylist()
    lefts = [front_decoded(r["left_shared"], r["left_rests"], r["left_ends"]) for r in rows]
    owners = [zip(r["doc"], r["version"], r["anchor"], strict=True) for r in rows]
    tree = LoserTree([front_decoded(r["shared"], r["rests"], r["ends"]) for r in rows])
    group: list[tuple[int, bytes, tuple[int, int, int]]] = []
    for run, _, shared in tree:
        if shared < gram and group:
            yield from _group_spans(group, least)
            group = []
        group.append((shared, next(lefts[run])[0], next(owners[run])))
    if group:
        yield from _group_spans(group, least)


def _group_spans(group: list[tuple[int, bytes, tuple[int, int, int]]], least: int) -> Iterator[tuple[int, int, int, int]]:
    if len(group) < 2:
        return
    left, right = reaches([g[0] for g in group], [g[1] for g in group], least)
    for i in np.flatnonzero(right).tolist():
        doc, version, at = group[i][2]
        if at >= 0:
            yield doc, version, at - int(left[i]), at + int(right[i])


def _sorted_spans(runs: DataFrame, least: int, gram: int) -> DataFrame:
    def run(groups: pa.Table) -> pa.Table:
        bucket = groups["_bucket"].to_numpy()
        edges = np.r_[0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)]
        spans = [s for a, b in zip(edges[:-1], edges[1:], strict=True) for s in _merged_spans(groups.slice(a, b - a), least, gram)]
        names = ["_doc", "_version", "start", "end"]
        return pa.table({n: pa.array([s[i] for s in spans], pa.int64()) for i, n in enumerate(names)})

    return over_sorted_groups(runs, ["_bucket"], run, _SPANS)


def _window_spans(with_text: DataFrame, least: int) -> DataFrame:
    """The way for grams in very many contexts: their windows one by one, counted by 128-bit hash.

    Rows spread by window and equal ones are summed before the shuffle, so no group lands in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int, int, int, int, int]] = []
            for doc, version, text, items in _wanted(batch):
                for item in items:
                    for i in range(item["_lo"], item["_hi"] + 1):
                        digest = xxhash.xxh3_128_intdigest(text[i : i + least])
                        found.append((doc, version, i, item["_n"], (digest >> 64) - (1 << 63), (digest & _MASK) - (1 << 63)))
                if len(found) > 1 << 17:
                    yield _window_batch(found)
                    found = []
            if found:
                yield _window_batch(found)

    windows = stored(with_text.mapInArrow(run, "_doc long, _version long, start long, _n long, _c long, _d long"))
    repeated = windows.groupBy("_c", "_d").agg(F.sum("_n").alias("_all")).where("_all > 1").select("_c", "_d")
    return windows.where("_n = 1").join(repeated, ["_c", "_d"], "left_semi").select(
        "_doc", "_version", "start", (F.col("start") + least).alias("end")
    )


def _window_batch(found: list[tuple[int, int, int, int, int, int]]) -> pa.RecordBatch:
    names = ["_doc", "_version", "start", "_n", "_c", "_d"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=names)


def repeated_spans(
    texts: DataFrame, *, least: int = MIN_BYTES, gram: int = GRAM, bucket_items: int = BUCKET_ITEMS, group_items: int = GROUP_ITEMS
) -> DataFrame:
    """``_doc, _version, start, end``: spans that cover all bytes of repeated ``least``-byte strings."""
    found = stored(_anchors(texts, least, gram))
    contexts = found.groupBy("_gram", "_c", "_d").agg(
        F.sum("_times").alias("_n"),
        *[F.first(c).alias(c) for c in ("_doc", "_version", "_anchor", "_lo", "_hi", "_times")],
    )
    grams = contexts.groupBy("_gram").agg(F.count(F.lit(1)).alias("_contexts"), F.sum((F.col("_n") == 1).cast("long")).alias("_open"))
    several = grams.where("_contexts > 1 and _open > 0")
    complete = found.join(contexts.where("_n > 1").select("_gram", "_c", "_d"), ["_gram", "_c", "_d"], "left_semi")
    spans = complete.select("_doc", "_version", F.col("_lo").alias("start"), (F.col("_hi") + least).alias("end"))

    # the first repetition of a context that repeats at even steps stands for all
    one = (F.col("_hi") - F.col("_lo") + 1) / F.col("_times")
    items = stored(
        contexts.join(several, "_gram")
        .withColumn("_hi", (F.col("_lo") + one - 1).cast("long"))
        .select("_doc", "_version", "_contexts", F.struct("_gram", "_anchor", "_lo", "_hi", F.least("_n", F.lit(2)).cast("long").alias("_n")).alias("_item"))
    )
    buckets = max(1, -(-items.count() // bucket_items))
    keys = ["_doc", "_version"]
    plain = texts.select("_doc", "_version", "_text")
    usual = items.where(F.col("_contexts") <= group_items).groupBy(*keys).agg(F.collect_list("_item").alias("_items"))
    sorted_spans = _sorted_spans(_runs(plain.join(usual, keys), least, buckets), least, gram)
    out = spans.unionByName(sorted_spans)
    hot = items.where(F.col("_contexts") > group_items)
    if not hot.isEmpty():
        hot = hot.groupBy(*keys).agg(F.collect_list("_item").alias("_items"))
        out = out.unionByName(_window_spans(plain.join(hot, keys), least))
    return out


def _joined(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for span in sorted(spans, key=lambda s: s["start"]):
        a, b = span["start"], span["end"]
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    least: int = MIN_BYTES,
    gram: int = GRAM,
    bucket_items: int = BUCKET_ITEMS,
    group_items: int = GROUP_ITEMS,
) -> DataFrame:
    """``id_col, n_bytes, n_removed, spans, kept`` per row: the text's UTF-8 bytes without repeated strings.

    A byte goes if a string of ``least`` bytes that covers it also starts anywhere else in the table, at
    another place of the same text included; strings are judged on the input and never cross
    documents. ``spans`` are the maximal removed runs, ``kept`` the remaining bytes (which need not be
    valid UTF-8).

    Every window of ``least`` bytes chooses an anchor by its content. Contexts of anchors that are
    equal as a whole are known by a 128-bit hash. Of the others with a common gram, the suffixes from
    the anchors are sorted: tasks exchange front-coded sorted runs, loser trees merge them without
    comparing a known prefix again, and what neighbours share, on both sides of the anchor, gives the
    repeated strings. Grams in more than ``group_items`` contexts are counted window by window.

    Null texts count as empty. Null ids and repeated rows stay rows; rows that repeat an id and text are
    repeats of each other. Extra columns are ignored; an empty table gives an empty result.
    """
    texts = _texts(docs, id_col, text_col)
    spans = repeated_spans(texts.drop("_id"), least=least, gram=gram, bucket_items=bucket_items, group_items=group_items)
    # equal spans of repeated rows are one; a document has no more spans than bytes
    listed = spans.distinct().groupBy("_doc", "_version").agg(F.collect_list(F.struct("start", "end")).alias("_spans"))
    rows = texts.join(listed, ["_doc", "_version"], "left").select("_id", "_text", "_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            size, removed, runs, kept = [], [], [], []
            for text, spans in zip(batch.column("_text"), batch.column("_spans"), strict=True):
                data, out, at = text.as_buffer().to_pybytes(), [], 0
                merged = _joined(spans.as_py() or [])
                for a, b in merged:
                    out.append(data[at:a])
                    at = b
                out.append(data[at:])
                kept.append(b"".join(out))
                size.append(len(data))
                removed.append(len(data) - len(kept[-1]))
                runs.append([{"start": a, "end": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.binary())],
                names=["_id", "n_bytes", "n_removed", "spans", "kept"],
            )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"_id {kind}, n_bytes long, n_removed long, spans array<struct<start:bigint,end:bigint>>, kept binary"
    ).withColumnRenamed("_id", id_col)
