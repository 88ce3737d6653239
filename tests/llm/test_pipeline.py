import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from seasonframe.llm.simhash import fingerprint

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list(LETTERS), rng.integers(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    texts = [prose(i, 60) for i in range(30)]
    long = prose(99, 3000)
    near = long.replace(long.split()[1500], "changed", 1)
    assert (fingerprint(long) ^ fingerprint(near)).bit_count() <= 3
    rows = [*enumerate(texts), (40, texts[3]), (41, texts[3]), (42, long), (43, near), (44, None), (45, ""), (46, "12345 !!"), (47, "mail a@b.org now " + texts[5])]
    rows += [(48, prose(77, 60)), (48, prose(77, 60))]
    return spark.createDataFrame([(i, t, "en", "src", len(t or ""), "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string")


def written(spark, df, folder, name):
    df.write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")


def test_every_stage_takes_effect(spark, docs, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "personal_data", "best_fit_packing"]
    columns, now, kept = docs.columns, docs, []
    for name, stage in corpus_pipeline.STAGES:
        now = written(spark, stage(spark, now, ""), tmp_path, name)
        if name != "best_fit_packing":
            assert now.columns == columns
            kept.append({(r.doc_id, r.text) for r in now.collect()})
            assert len(kept[-1]) == now.count() or name == "language_id"
    ids = [{i for i, _ in k} for k in kept]
    assert ids[0] == set(range(30)) | {40, 41, 42, 43, 47, 48}
    assert ids[1] == ids[0] - {3, 40}
    assert ids[2] == ids[1] - {43}
    assert ids[3] == ids[2]
    changed = {i: t for i, t in kept[3] if (i, t) not in kept[2]}
    assert list(changed) == [47] and changed[47].startswith("mail [EMAIL] now ")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept[3]}
    got = {}
    for r in now.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


def test_run_equals_the_stages_in_turn(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = written(spark, stage(spark, now, str(tmp_path)), tmp_path, name)
    key = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert key(corpus_pipeline.run(spark, str(tmp_path)).collect()) == key(now.collect())


def test_empty_table(spark, docs, tmp_path):
    now = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        now = written(spark, stage(spark, now, ""), tmp_path, name)
        assert now.count() == 0


def test_only_the_entry_guards_imports():
    import pathlib

    here = pathlib.Path(corpus_pipeline.__file__).parent
    for path in [here / "corpus_pipeline.py", *(here / "seasonframe" / "llm").glob("*.py")]:
        assert not re.search(r"except\s+(ImportError|ModuleNotFoundError|Exception)\b", path.read_text()), path
