import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

import seasonframe.llm.spelling as module
from seasonframe.llm.spelling import spelling_groups, word_counts

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def counted(docs, shortest, least, slip_every):
    found = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            mark = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if slip_every and mark % slip_every == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            if len(run) >= shortest:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= least}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def grouped(counts, times):
    near = defaultdict(set)
    for a in counts:
        for b in counts:
            if a < b and one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for word, n in counts.items():
        if near[word]:
            best = min(near[word], key=lambda x: (-counts[x], x))
            if counts[best] >= times * n:
                form[word] = best
    rows = []
    for word, n in counts.items():
        root = word
        while root in form:
            root = form[root]
        rows.append((word, form.get(word), root, n, len(near[word]), counts[form[word]] if word in form else None))
    return sorted(rows, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_neighbours_forms_and_roots(spark, seed, monkeypatch):
    monkeypatch.setattr(module, "PAIR_CHARS", 50)
    rng = random.Random(seed)
    counts = {}
    while len(counts) < 500:
        word = "".join(rng.choice("aabc" if seed == 1 else "aé日\U0001f600") for _ in range(rng.randint(1, 7)))
        counts[word] = rng.choice([1, 2, 5, 10, 60, 100, 700, 1000, 10**6])
    counts |= {"a" * n: 10 ** (n % 5) for n in range(8, 40)}
    counts[""] = 3
    made = spark.createDataFrame([*counts.items(), (None, 9)], "word string, n int").repartition(3)
    want = grouped(counts, 10)
    assert rows_of(spelling_groups(made)) == want
    assert any(r[2] != r[1] for r in want if r[1]) and any(r[4] > 3 for r in want)


def test_words_of_documents(documents):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abÄéz×Ω") for _ in range(rng.randint(3, 9))) for _ in range(200)) for _ in range(20)]
    rows = [*enumerate(texts), (None, texts[0]), (None, texts[0]), (50, None), (51, ""), (52, "ABABABAB" * 20_000), (53, "ABABABAB" * 20_000)]
    for slip in (31, 2, None):
        found = word_counts(documents(rows), shortest=4, least=2, slip_every=slip)
        assert {r.word: r.n for r in found.collect()} == counted(rows, 4, 2, slip)


def test_counts_are_passed_on_in_parts(documents, monkeypatch):
    monkeypatch.setattr(module, "COUNTED_WORDS", 3)
    rows = [(i, "alphabet betabet gammabet deltabet alphabet") for i in range(50)]
    assert {r.word: r.n for r in word_counts(documents(rows)).collect()} == counted(rows, 7, 2, 31)


def test_very_long_words(spark):
    long = "xyzw" * 5000
    counts = {long: 100, long[:-1]: 5, long[:7] + long[8:]: 1, "b" + long[1:]: 2, "other": 1}
    made = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: r for r in spelling_groups(made).collect()}
    assert found[long].n_near == 3 and found[long].form is None
    assert {w: r.root for w, r in found.items()} == {w: long if w != "other" else w for w in counts}


def test_empty_tables(spark, documents):
    assert spelling_groups(word_counts(documents([]))).collect() == []
    assert rows_of(spelling_groups(spark.createDataFrame([("alone", 2)], "word string, n long"))) == [("alone", None, "alone", 2, 0, None)]
    with pytest.raises(ValueError):
        spelling_groups(spark.createDataFrame([], "word string, n long"), times=1)
