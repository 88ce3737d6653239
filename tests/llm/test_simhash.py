import random

import numpy as np
import pytest

from seasonframe.llm import simhash
from seasonframe.llm.components import connected_components


def smallest_reachable(items, linked):
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def test_fingerprint_counts_every_bit():
    import xxhash

    text = "The quick\tbrown  fox É the quick brown\x0bfox"
    words = "the quick brown fox É the quick brown fox".split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint(" \t\n") == 0
    assert simhash.fingerprint("Two words") == xxhash.xxh64_intdigest(b"two words", 42)


def test_index_finds_exactly_the_near_codes():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    codes = base[rng.integers(0, 40, 600)]
    for _ in range(5):
        codes ^= np.uint64(1) << rng.integers(0, 64, 600, dtype=np.uint64) * (rng.random(600) < 0.5)
    codes = np.unique(codes)
    group = np.sort(rng.integers(0, 3, len(codes)))
    got = simhash.linked(codes, group, np.zeros(len(codes), int), np.zeros(len(codes), bool), 3)
    pairs = list(zip(codes.tolist(), group.tolist(), strict=True))
    want = smallest_reachable(pairs, lambda x, y: x[1] == y[1] and (x[0] ^ y[0]).bit_count() <= 3)
    partition = lambda labels: sorted(tuple(np.flatnonzero(np.array(labels) == x)) for x in set(map(int, labels)))
    assert partition(got) == partition(want)


@pytest.mark.parametrize("slice_rows", [1024, 4])
def test_links_across_slices_of_hot_patterns(spark, slice_rows):
    rng = random.Random(5)
    codes = {0, (1 << 64) - 1}
    for _ in range(12):
        start = rng.getrandbits(64)
        for _ in range(12):
            codes.add(start)
            for _ in range(rng.randint(1, 4)):
                start ^= 1 << rng.randrange(64)
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    edges = simhash.fingerprint_links(spark.createDataFrame([(c,) for c in signed], "_fp long"), 3, slice_rows)
    found = {r.node: r.component for r in connected_components(edges).collect()}
    want = smallest_reachable(codes, lambda x, y: (x ^ y).bit_count() <= 3)
    for i, c in enumerate(signed):
        group = [signed[j] for j in range(len(codes)) if want[j] == want[i]]
        assert found.get(c, c) == min(group)


def test_documents_with_every_odd_value(documents):
    long = " ".join(f"w{i % 97}x{i % 89}" for i in range(60_000))
    rows = [(4, "a b c d"), (2, "A  b\nc d"), (9, None), (7, ""), (8, " \t"), (1, "other words here"), (None, "a b c d"), (3, long), (5, long), (5, long)]
    got = {}
    for r in simhash.simhash_duplicates(documents(rows)).collect():
        got.setdefault((r.doc_id, r.fingerprint), []).append(r.component_id)
    by_id = {k[0]: (k[1], v) for k, v in got.items()}
    assert by_id[4][1] == by_id[2][1] == by_id[None][1] == [2]
    assert by_id[9] == by_id[7] == by_id[8] == ("0" * 16, [7])
    assert by_id[3][1] == [3] and by_id[5][1] == [3, 3] and by_id[1][1] == [1]
    assert simhash.simhash_duplicates(documents([])).collect() == []


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 240)] + [(5, 5), (None, 3), (240, 239)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 241)] if i != 240 or True}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []
