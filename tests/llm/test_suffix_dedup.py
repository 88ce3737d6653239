import random
from collections import Counter

import numpy as np
import pytest

from seasonframe.llm.suffix_dedup import Anchors, LoserTree, common_prefix, front_coded, front_decoded, reaches, remove_repeats


def brute(rows, least):
    data = [(t or "").encode() for _, t in rows]
    count = Counter(b[i : i + least] for b in data for i in range(len(b) - least + 1))
    out = []
    for (i, _), b in zip(rows, data, strict=True):
        covered = np.zeros(len(b), bool)
        for at in range(len(b) - least + 1):
            if count[b[at : at + least]] > 1:
                covered[at : at + least] = True
        edges = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(int))).reshape(-1, 2)
        out.append((i, len(b), int(covered.sum()), [tuple(map(int, e)) for e in edges], b"".join(bytes([x]) for x, c in zip(b, covered, strict=True) if not c)))
    return sorted(out, key=repr)


def got(docs, **options):
    rows = remove_repeats(docs, **options).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in rows), key=repr)


def texts(seed, alphabet, n=60):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    passages = [word(rng.randint(15, 120)) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            passage = rng.choice(passages)
            if rng.random() < 0.4:  # a part of one, or one with a change inside
                a = rng.randrange(len(passage))
                passage = passage[a:] if rng.random() < 0.5 else passage[:a] + word(1) + passage[a + 1 :]
            parts += [word(rng.randint(0, 30)), passage]
        out.append("".join(parts))
    return out


@pytest.mark.parametrize(("seed", "alphabet", "group_items"), [(1, "abcdefghijklmnop", 1000), (2, "ab", 1000), (3, "aé\U0001f600bc ", 3), (4, "ab", 2)])
def test_equals_brute_force(documents, seed, alphabet, group_items):
    rows = list(enumerate(texts(seed, alphabet)))
    rows += [(100, None), (101, ""), (None, rows[0][1]), (102, "a" * 500), (103, "ab" * 400), (104, "xyz"), (105, rows[1][1]), (105, rows[1][1])]
    assert got(documents(rows), least=24, gram=8, bucket_items=50, group_items=group_items) == brute(rows, 24)


def test_production_lengths_and_a_very_long_text(documents, monkeypatch):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh \n") for _ in range(n))
    passage, long = text(450), text(3_000_000)
    rows = [(1, text(700) + passage + text(30)), (2, passage), (3, passage[:399]), (4, passage[51:]), (5, long), (6, long[2_000_000:2_300_000]), (7, "z" + passage[:400])]
    found = {r[0]: r for r in got(documents(rows))}
    assert found[1][3] == [(700, 1150)] and found[2][2] == 450 and found[4][2] == 399 * 0 + (0 if len(passage[51:]) < 400 else 399)
    assert found[3][2] == 0 and found[7][3] == [(1, 401)]
    assert found[5][3] == [(2_000_000, 2_300_000)] and found[6][2] == 300_000


def test_empty_table(documents):
    assert got(documents([])) == []


def test_loser_tree_merges_and_knows_what_neighbours_share():
    rng = random.Random(4)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 40))) for _ in range(7)]
    merged = list(LoserTree([front_decoded(*front_coded(run)) for run in runs]))
    items = [m[1] for m in merged]
    assert items == sorted(x for run in runs for x in run)
    assert [m[2] for m in merged[1:]] == [common_prefix(a, b) for a, b in zip(items, items[1:])]  # noqa: B905


@pytest.mark.parametrize("square", [512, 2])
def test_reaches_equal_all_pairs(monkeypatch, square):
    monkeypatch.setattr("seasonframe.llm.suffix_dedup._SQUARE_ITEMS", square)
    rng = random.Random(8)
    items = sorted((bytes(rng.choice(b"ab") for _ in range(12)), bytes(rng.choice(b"ab") for _ in range(12))) for _ in range(40))
    rights = [0] + [common_prefix(items[i - 1][0], items[i][0]) for i in range(1, 40)]
    left, right = reaches(rights, [x[1] for x in items], 11)
    for i, (a, b) in enumerate(items):
        pairs = [(common_prefix(b, d), common_prefix(a, c)) for j, (c, d) in enumerate(items) if j != i]
        pairs = [p for p in pairs if sum(p) >= 11] or [(0, 0)]
        assert (left[i], right[i]) == (max(p[0] for p in pairs), max(p[1] for p in pairs))


def test_equal_windows_choose_equal_places():
    choose = Anchors(40, 8)
    data = np.frombuffer(random.Random(1).randbytes(3000), np.uint8)
    a, _ = choose(data)
    b, _ = choose(data[137:1500])
    assert (a[137 : 137 + len(b)] - 137 == b).all()
    assert (a >= np.arange(len(a))).all() and (a < np.arange(len(a)) + 33).all()
