import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from seasonframe.llm.merkle import fold, manifest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + fanout])) for i in range(0, len(levels[-1]), fanout)])
    return levels


def siblings(levels, place, fanout):
    found = []
    for level in levels[:-1]:
        start = place - place % fanout
        found.append(("".join(level[start:place]), "".join(level[place + 1 : start + fanout])))
        place //= fanout
    return found


def brute(rows, fanout):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[name] = tree([leaf_of(r) for r in groups[name]], fanout)
    top = tree([trees[n][-1][0] for n in names], fanout)
    root = top[-1][0] if names else None
    found = []
    for at, name in enumerate(names):
        for place, row in enumerate(groups[name]):
            path = siblings(trees[name], place, fanout) + siblings(top, at, fanout)
            node = leaf_of(row)
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                node = leaf_of((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for before, after in path:
                node = digest(before + node + after)
            found.append((row[0], name, leaf_of(row), trees[name][-1][0], root, digest("".join(b + a for b, a in path)), node, node == root))
    return sorted(found, key=repr)


def found(spark, rows, fanout):
    docs = spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, root int"
    ).repartition(4)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return manifest(
        docs, FIELDS, fanout=fanout, changed={"text": F.translate("text", upper, upper.lower())}, changed_where=F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    )


def columns(rows):
    return sorted(((r.doc_id, r.source, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in rows), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    made = [(i, rng.choice(["hot"] * 4 + ["b", "c"]), "en", 5, f"Text {i}") for i in range(700)]
    made += [(i, f"s{i}", None, i, "Ä single leaf") for i in range(700, 760)]
    made += [(None, "hot", "en", None, None), (None, "hot", "en", 1, ""), (5, None, "de", 0, ""), (6, None, "de", 0, None), (7, "", "x", 1, "É z A")]
    made += [(3, "b", "en", 5, "other row of this id"), (3, "b", "en", 5, "other row of this id")]
    return made + [(9000, "hot", "en", 1, "Same")] * 300


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_equals_whole_trees(spark, rows, fanout):
    # with a fanout of 2 a block has 8 leaves, so the hot group climbs seven rounds with a last group that is not full
    result = found(spark, rows, fanout).collect()
    assert columns(result) == brute(rows, fanout)
    assert 0 < sum(not r.verified for r in result) < len(result)


def test_siblings_are_a_proof(spark, rows):
    result = found(spark, rows[:200], 3)
    odd = result.where(fold(F.col("leaf"), F.col("siblings")) != F.col("root"))
    assert odd.count() == 0
    joined = F.array_join(F.transform("siblings", lambda s: F.concat(s["before"], s["after"])), "")
    assert result.where(F.sha2(joined, 256) != F.col("proof_sha256")).count() == 0


def test_one_row_and_none(spark):
    (only,) = found(spark, [(1, "a", "en", 2, "hi")], 16).collect()
    assert only.leaf == only.subroot == only.root == only.folded_root and only.siblings == []
    assert found(spark, [], 16).collect() == []


def test_a_very_long_text(spark):
    long = [(i, "a", "en", 1, "Wörd " * 200_000) for i in range(3)]
    assert columns(found(spark, long, 16).collect()) == brute(long, 16)
