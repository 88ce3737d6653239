"""Spelling variants of words: neighbours at one edit by pairs of trie nodes, and the form each word stands for."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonframe.llm.common import cut, over_sorted_groups, partitions, stored, whole_text

#: Distinct words that a task counts before it passes them on.
COUNTED_WORDS = 300_000
#: Characters of words whose pairs are made at once.
PAIR_CHARS = 1_000_000
#: Bits of a node number that count nodes within a partition.
NODE_BITS = 40
#: Kinds of a pair: a character is skipped between the nodes; skipped, as the last of equal ones; none is.
SKIPPED, LAST_SKIPPED, WHOLE = 0, 1, 2


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 7, least: int = 2, slip_every: int | None = 31
) -> DataFrame:
    """``word, n``: the words of at least ``shortest`` code points that occur at least ``least`` times.

    A word is a maximal run of ``A-Z a-z`` and U+00C0 to U+00FF, with A-Z in lower case. With
    ``slip_every``, a run loses a code point where that number divides the CRC-32 of ``id:run``; which
    one is the CRC modulo its length. Null texts hold no word, a null id is written as nothing.
    """
    pattern = re.compile(rb"[a-z\xc0-\xff]{%d,}" % shortest)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for key, text in zip(batch.column("_id").to_pylist(), batch.column("_text"), strict=True):
                # one byte a character: those beyond Latin-1 are no letters here, and upper case is plain ASCII
                runs = Counter(pattern.findall(text.as_py().encode("latin-1", "replace").lower()))
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for run, times in runs.items():
                    if slip_every:
                        wide = run if run.isascii() else run.decode("latin-1").encode("utf-8")
                        mark = zlib.crc32(wide, start)
                        if mark % slip_every == 0:
                            at = mark % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < shortest:
                                continue
                    found[run] += times
                if len(found) > COUNTED_WORDS:
                    yield _counted(found)
                    found = Counter()
        yield _counted(found)

    chosen = docs.select(F.col(id_col).cast("string").alias("_id"), whole_text(F.col(text_col)).alias("_text"))
    counts = chosen.mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _counted(found: Counter[bytes]) -> pa.RecordBatch:
    words = pa.array([w.decode("latin-1") for w in found], pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(found.values(), pa.int64())], names=["word", "n"])


def _common(one: str, other: str) -> int:
    """Length of the common prefix."""
    n = 0
    for a, b in zip(one, other, strict=False):
        if a != b:
            break
        n += 1
    return n


def _with_nodes(rows: DataFrame, key: str, nodes: str) -> DataFrame:
    """Adds the numbers of the trie nodes from the root to the end of ``key``, whose values are distinct.

    Sorted by range, a word shares with the one before the nodes of their common prefix and has new ones
    after it, numbered by partition and place. A partition's first word takes the shared ones from the
    last word of the partition before, so one row a partition settles the numbers everywhere. Numbers of
    whole words ascend with the words.
    """
    ranged = rows.repartitionByRange(partitions(rows.sparkSession), key).sortWithinPartitions(key)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        base = part << NODE_BITS
        made, path, before = 0, [], None
        for batch in batches:
            ends, flat = [0], []
            for word in batch.column(key).to_pylist():
                shared = 0 if before is None else _common(before, word) + 1
                new = len(word) + 1 - shared
                path = path[:shared] + list(range(base + made, base + made + new))
                made += new
                before = word
                flat += path
                ends.append(len(flat))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
            yield batch.append_column(nodes, lists).append_column("_part", pa.array([part] * batch.num_rows, pa.int64()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    held = stored(ranged.mapInArrow(number, f"{fields}, `{nodes}` array<long>, _part long"))
    edge = F.struct(key, nodes)
    ends = held.groupBy("_part").agg(F.min(key).alias("first"), F.max(edge).alias("last")).orderBy("_part").collect()
    carries, before = [], None
    for row in ends:
        base, taken = row["_part"] << NODE_BITS, []
        if before is not None:
            taken = before[1][: _common(before[0], row["first"]) + 1]
            carries.append((row["_part"], taken))
        before = (row["last"][0], [taken[x - base] if x - base < len(taken) else x for x in row["last"][1]])
    session = rows.sparkSession
    # fewer rows than partitions, each as long as two neighbouring words' common prefix
    carried = F.broadcast(session.createDataFrame(carries, "_part long, _taken array<long>"))
    own = F.col("_part") * (1 << NODE_BITS)
    taken_over = F.transform(nodes, lambda x: F.when(x - own < F.size("_taken"), F.get("_taken", (x - own).cast("int"))).otherwise(x))
    settled = F.when(F.col("_taken").isNull(), F.col(nodes)).otherwise(taken_over)
    return held.join(carried, "_part", "left").withColumn(nodes, settled).drop("_part", "_taken")


def _pairs(words: DataFrame) -> DataFrame:
    """``before, after, kind, word_id, n``: the node pairs of every word, with a character skipped and with none."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([len(w) for w in batch.column("word").to_pylist()])
            total = np.cumsum(lengths)
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + PAIR_CHARS, "right")))
                yield _pairs_of(batch.slice(start, stop - start), lengths[start:stop])
                start = stop

    chosen = words.select("word", "n", "word_id", "forward", "backward")
    return chosen.mapInArrow(emit, "before long, after long, kind int, word_id long, n long")


def _pairs_of(batch: pa.RecordBatch, lengths: np.ndarray) -> pa.RecordBatch:
    letters = np.frombuffer("".join(batch.column("word").to_pylist()).encode("utf-32-le"), "<u4")
    forward, backward = (batch.column(c).flatten().to_numpy() for c in ("forward", "backward"))
    row = np.arange(len(lengths))
    first_letter = np.cumsum(lengths) - lengths
    first_node = first_letter + row  # a word of L letters has L + 1 nodes each way

    at_letter = np.repeat(row, lengths)
    place = np.arange(len(letters)) - first_letter[at_letter]
    ends = place == lengths[at_letter] - 1
    follows = np.r_[letters[1:], letters[:1]]
    kind = np.where(ends | (letters != follows), LAST_SKIPPED, SKIPPED)
    skip_before = forward[first_node[at_letter] + place]
    skip_after = backward[first_node[at_letter] + lengths[at_letter] - 1 - place]

    at_node = np.repeat(row, lengths + 1)
    node = np.arange(len(forward)) - first_node[at_node]
    whole_after = backward[first_node[at_node] + lengths[at_node] - node]

    ids, n = (batch.column(c).to_numpy() for c in ("word_id", "n"))
    both = np.r_[at_letter, at_node]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.r_[skip_before, forward]),
            pa.array(np.r_[skip_after, whole_after]),
            pa.array(np.r_[kind, np.full(len(at_node), WHOLE)].astype(np.int32)),
            pa.array(ids[both]),
            pa.array(n[both]),
        ],
        names=["before", "after", "kind", "word_id", "n"],
    )


def _first_two(group: np.ndarray, n: np.ndarray, ids: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Per group the row of the largest n (ties: the least id) and the next one; -1 where there is none."""
    order = np.lexsort((ids, -n, group))
    ordered = group[order]
    first, second = np.full(groups, -1), np.full(groups, -1)
    leads = np.r_[True, ordered[1:] != ordered[:-1]] if len(order) else np.zeros(0, bool)
    first[ordered[leads]] = order[leads]
    next_ones = np.r_[False, leads[:-1]] & ~leads if len(order) else leads
    second[ordered[next_ones]] = order[next_ones]
    return first, second


def _links_of(table: pa.Table) -> pa.Table:
    """What each word's groups say of it: how many near words, and the best one of them.

    All words of a pair of nodes with a character skipped differ in that character alone; a word with
    none skipped there is each of theirs without it. Which of equal neighbouring characters is left out
    makes no difference, so only the last of them counts: every near word is met once.
    """
    before, after, kind, ids, n = (table.column(c).to_numpy() for c in ("before", "after", "kind", "word_id", "n"))
    starts = np.r_[True, (before[1:] != before[:-1]) | (after[1:] != after[:-1])]
    group = np.cumsum(starts) - 1
    shared = np.bincount(group)[group] > 1
    kind, ids, n = kind[shared], ids[shared], n[shared]
    _, group = np.unique(group[shared], return_inverse=True)
    groups = int(group.max()) + 1 if len(group) else 0
    skips, lasts, wholes = kind != WHOLE, kind == LAST_SKIPPED, kind == WHOLE
    n_skips, n_lasts = (np.bincount(group[m], minlength=groups) for m in (skips, lasts))
    whole_row = np.full(groups, -1)
    whole_row[group[wholes]] = np.flatnonzero(wholes)

    def rows_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.flatnonzero(mask)
        first, second = _first_two(group[mask], n[mask], ids[mask], groups)
        return tuple(np.where(x >= 0, place[x] if len(place) else -1, -1) for x in (first, second))

    first, second = rows_of(skips)
    first_last, _ = rows_of(lasts)
    here = np.arange(len(ids))
    near = np.where(wholes, n_lasts[group], n_skips[group] - 1 + (lasts & (whole_row[group] >= 0)))
    among = np.where(wholes, first_last[group], np.where(first[group] == here, second[group], first[group]))
    shorter = np.where(lasts, whole_row[group], -1)

    def value(rows: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.where(rows >= 0, of[rows] if len(of) else 0, -1)

    better = (shorter >= 0) & (
        (value(shorter, n) > value(among, n)) | ((value(shorter, n) == value(among, n)) & (value(shorter, ids) < value(among, ids)))
    )
    best = np.where(better, shorter, among)
    keep = near > 0
    return pa.table(
        {
            "word_id": pa.array(ids[keep]),
            "near": pa.array(near[keep].astype(np.int64)),
            "best_n": pa.array(value(best, n)[keep]),
            "best_id": pa.array(value(best, ids)[keep]),
        }
    )


def near_words(words: DataFrame) -> DataFrame:
    """``word_id, n_near, best_n, best_id`` per numbered word that has a near one.

    Words meet at pairs of nodes only, at most one for each character that may stand there and one
    without it, so no group is large and no pairs of words are listed.
    """
    found = over_sorted_groups(_pairs(words), ["before", "after"], _links_of, "word_id long, near long, best_n long, best_id long")
    best = F.max(F.struct(F.col("best_n"), (-F.col("best_id")).alias("least")))
    return found.groupBy("word_id").agg(F.sum("near").alias("n_near"), best.alias("_best")).select(
        "word_id", "n_near", F.col("_best.best_n").alias("best_n"), (-F.col("_best.least")).alias("best_id")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word_id, root_id``: where the forms lead to in the end, in steps of twice the length each round."""
    now = cut(forms.select("word_id", F.col("form_id").alias("root_id")))
    while True:
        onward = now.select(F.col("word_id").alias("_at"), F.col("root_id").alias("_to"))
        moved = cut(now.join(onward, F.col("root_id") == F.col("_at"), "left").select("word_id", F.coalesce("_to", "root_id").alias("root_id"), F.col("_to").isNotNull().alias("_moved")))
        now = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return now


def spelling_groups(counts: DataFrame, times: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for a table of distinct words (``word, n``).

    Two words are near if they differ by one inserted, deleted or replaced code point. A word's form is
    its near word of largest n (of equal ones the first in code-point order) if that n is at least
    ``times`` the word's own; the root is where the forms lead. Words without a form have a null form and
    are their own root. Null words are left out; an empty table gives an empty one. ``times`` must be
    at least 2, so that forms lead somewhere.

    The nodes of a trie of the words and of one of the reversed words are numbered by a sort in ranges.
    Integer pairs (node before, node after) stand for "these characters, one skipped, those characters";
    equality of pairs is equality of strings, so nothing has to be verified.
    """
    if times < 2:
        raise ValueError("times must be at least 2")
    words = counts.where(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n"))
    ahead = _with_nodes(words, "word", "forward").withColumn("word_id", F.element_at("forward", -1))
    ahead = cut(ahead)
    back = _with_nodes(ahead.select("word_id", F.reverse("word").alias("_turned")), "_turned", "backward")
    links = cut(near_words(ahead.join(back.select("word_id", "backward"), "word_id")))
    known = ahead.select("word_id", "word", "n")
    linked = known.join(links, "word_id", "left")
    forms = cut(linked.where(F.col("best_n") >= F.col("n") * times).select("word_id", F.col("best_id").alias("form_id"), F.col("best_n").alias("form_n")))
    named = forms.join(_roots(forms), "word_id")
    for key, name in (("form_id", "form"), ("root_id", "_root")):
        named = named.join(known.select(F.col("word_id").alias(key), F.col("word").alias(name)), key)
    return linked.join(named.select("word_id", "form", "form_n", "_root"), "word_id", "left").select(
        "word", "form", F.coalesce("_root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
