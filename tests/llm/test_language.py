import math
import random

import numpy as np
import pytest

import seasonframe.llm.language as module
from seasonframe.llm.language import BUCKETS, document_evidence, identify, page_evidence, train_text_model

WORDS = {
    "en": "the of and to in is that for it with as was on are by this from".split(),
    "de": "der die und das ist nicht ein zu mit auf für von den sich auch dem".split(),
    "fr": "le la les et est une pour dans que qui avec sur des pas plus être".split(),
}


def prose(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, prose(lang, 30, i), lang) for i, lang in enumerate(list(WORDS) * 40)] + [(999, "x", None), (None, "y", "")]
    return train_text_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_docs=100)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 0.5) for r in rows], "page_id long, url string, html string, language string, confidence double")


def decided(spark, model, rows):
    return {r.page_id: r for r in identify(page_evidence(pages(spark, rows)), model, "page_id").collect()}


def test_texts_decide_where_they_are_clear(spark, model):
    rows = [(i, f"https://h{i % 7}.example.com/x", f"<html lang='en'><p>{prose(lang, 60, i)}</p>") for i, lang in enumerate(list(WORDS) * 20)]
    got = decided(spark, model, rows)
    assert [got[i].language for i in range(60)] == list(WORDS) * 20
    assert all(r.accepted for r in got.values())


def test_hosts_declarations_and_addresses_decide_short_texts(spark, model):
    rows = [(i, "http://de.example.org/p", f"<HTML class=a LANG=de><p>{prose('de', 50, i)}") for i in range(40)]
    rows += [(40 + i, "http://fr.example.fr/p", f"<html lang=fr>{prose('fr', 50, i)}") for i in range(40)]
    rows += [(100, "http://de.example.org/q", "<html>z"), (101, "http://fr.example.fr/q", "z"), (102, "http://new.example.net/fr/q", '<html lang="fr-CA">z')]
    got = decided(spark, model, rows)
    assert (got[100].language, got[101].language, got[102].language) == ("de", "fr", "fr")
    assert (got[102].declared_language, got[102].address_language) == ("fr", "fr")


def test_odd_rows_have_defined_results(spark, model):
    long = prose("de", 200_000, 1)
    rows = [(1, None, None), (2, "", ""), (3, "no url", "<p>12345 &&& ***</p>"), (4, "http://a/b", long), (None, "http://a/b", long), (5, "x://y", "the"), (5, "x://y", "the")]
    got = identify(page_evidence(pages(spark, rows)), model, "page_id").collect()
    by_id = {r.page_id: r for r in got}
    assert len(got) == 7
    assert not any(by_id[i].accepted for i in (1, 2, 3)) and by_id[3].text_language is None
    assert by_id[4].language == by_id[None].language == "de" and by_id[4].letters > 500_000
    assert identify(page_evidence(pages(spark, [])), model, "page_id").collect() == []


def test_a_hidden_text_and_scripts_are_no_evidence(spark, model):
    got = decided(spark, model, [(1, "http://a.b/c", f"<script>{prose('en', 500, 1)}</script><!-- {prose('en', 99, 2)} --><p title='the of'>{prose('fr', 40, 3)}")])
    assert got[1].text_language == "fr"


def test_without_labels_nothing_is_accepted(spark):
    empty = train_text_model(spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string"))
    docs = spark.createDataFrame([(1, "the", None, None)], "doc_id long, text string, lang string, source string")
    rows = identify(document_evidence(docs), empty, "doc_id").collect()
    assert [(r.language, r.accepted) for r in rows] == [(None, False)]


def test_a_rare_label_is_a_language(spark):
    rows = [(i, prose("en", 8, i), "en") for i in range(3000)] + [(None, prose("de", 30, 1), " DE"), (5, prose("fr", 30, 2), "fr"), (6, "123", "xx")]
    rows += [(9, prose("en", 8, 9), "en")] * 500
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train_text_model(labelled, sample_docs=20)
    assert model.languages == ["de", "en", "fr"]
    got = decided(spark, model, [(1, "http://a.b/c", f"<html lang=de>{prose('de', 60, 3)}"), (2, "http://a.b/fr/c", f"<html lang=fr>{prose('fr', 60, 4)}")])
    assert [(got[i].language, got[i].declared_language) for i in (1, 2)] == [("de", "de"), ("fr", "fr")]
    assert got[2].address_language == "fr"
    again = train_text_model(labelled.repartition(7), sample_docs=20)
    for part in ("floor", "starts", "language", "above"):
        assert (getattr(again, part) == getattr(model, part)).all()


def test_the_sample_is_bounded_for_each_label(spark):
    rows = [(i, "abc", lang) for i in range(400) for lang in ("aa", "bb")] + [(1, "abc", "aa")] * 300 + [(i, "abc", "cc") for i in range(3)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for docs in (1, 10):
        model = train_text_model(labelled, sample_docs=docs)
        # each document has three triples, counted over 0.2 in every bucket
        for i, n in enumerate((docs, docs, min(docs, 3))):
            most = model.floor[i] + model.above[model.language == i].max()
            assert np.exp(most) == pytest.approx((n + 0.2) / (3 * n + 0.2 * BUCKETS))


def test_all_samples_together_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(module, "SAMPLE_TOTAL", 40)
    rows = [(i, "abc", f"l{i % 10}") for i in range(400)] + [(1000 + i, "abc", f"rare{i}") for i in range(10)]
    model = train_text_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    counts = np.exp(model.above) * module.SMOOTH - module.SMOOTH  # per label: each of its triples once a document
    assert len(model.languages) == 20 and counts.max() == pytest.approx(2)
    assert all(counts[model.language == i].sum() == pytest.approx(3 if name.startswith("rare") else 6) for i, name in enumerate(model.languages))


def plain_posterior(rows, model):
    """The fused posterior in plain loops: rows of (text, declared, address, host)."""
    size, index = len(model.languages), {x: i for i, x in enumerate(model.languages)}
    scores = [model.scores([text]) for text, *_ in rows]
    votes = [int(s[0].argmax()) if n[0] else None for s, n in scores]

    def domain(host):
        return ".".join(host.split(".")[-2:]) if "." in host else ""

    def suffix(host):
        return host.split(".")[-1]

    def says(column, stated):
        counts = [[0.5 + 4.5 * (i == j) for j in range(size)] for i in range(size)]
        for row, vote in zip(rows, votes, strict=True):
            if vote is not None and row[column] in index:
                counts[index[row[column]]][vote] += 1
        return [math.log(counts[index[stated]][j] / sum(counts[i][j] for i in range(size))) if stated in index else 0.0 for j in range(size)]

    found = []
    for at, (_, declared, address, host) in enumerate(rows):
        prior = [1 / size] * size
        for same in (lambda h: True, lambda h: suffix(h) == suffix(host), lambda h: domain(h) == domain(host), lambda h: h == host):
            others = [sum(votes[k] == i for k in range(len(rows)) if k != at and same(rows[k][3])) for i in range(size)]
            prior = [(n + 20 * p) / (sum(others) + 20) for n, p in zip(others, prior, strict=True)]
        text = module.TEXT_WEIGHT * (scores[at][0][0] - scores[at][0][0].max()) if votes[at] is not None else [0.0] * size
        log = [text[i] + math.log(prior[i]) + a + b for i, a, b in zip(range(size), says(1, declared), says(2, address), strict=True)]
        best = max(range(size), key=lambda i: (log[i], -i))
        found.append((model.languages[best], 1 / sum(math.exp(x - log[best]) for x in log)))
    return found


def test_prior_and_posterior_equal_plain_loops(spark):
    rng = random.Random(12)
    words = WORDS | {"it": "il la che di e un non per una sono con mi".split(), "nl": "de het een van ik te dat die in je niet zijn".split()}
    labelled = [(i, " ".join(rng.choice(words[lang]) for _ in range(20)), lang) for i, lang in enumerate(list(words) * 30)]
    model = train_text_model(spark.createDataFrame(labelled, "doc_id long, text string, lang string"))
    hosts = ["a.one.example.org", "b.one.example.org", "two.example.it", "localhost", ""]
    rows = []
    for _ in range(150):
        lang, host = rng.choice(list(words)), rng.choice(hosts[:3] * 4 + hosts)
        text = " ".join(rng.choice(words[lang]) for _ in range(rng.choice([0, 1, 2, 30])))
        rows.append((text, rng.choice([lang, lang, "en", "xx", None]), rng.choice([lang, None, None, "fr"]), host))
    evidence = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "_id long, _text string, _declared string, _address string, _host string")
    got = {r.i: r for r in identify(evidence, model, "i").collect()}
    for i, (language, confidence) in enumerate(plain_posterior(rows, model)):
        assert got[i].language == language and got[i].confidence == pytest.approx(confidence, rel=1e-9), rows[i]


def test_many_labels_cost_no_more_plan(spark):
    rows = [(i, f"word{'abcdefghijklmnopqrst'[i % 20]}{'uvwxyzabcd'[i // 20 % 10]} text", f"l{i % 200}") for i in range(800)]
    docs = spark.createDataFrame([(*r, "src") for r in rows], "doc_id long, text string, lang string, source string")
    model = train_text_model(docs)
    assert len(model.languages) == 200 and len(model.above) < 200 * 60
    decided = identify(document_evidence(docs), model, "doc_id").where("accepted")
    assert decided.where("language = declared_language").count() > 700


def test_held_out_accuracy(spark):
    import os

    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("driver tables not present")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = train_text_model(docs.where("doc_id % 2 = 0"))
    held = docs.where("doc_id % 2 = 1")
    right = identify(document_evidence(held.withColumn("lang", held["lang"].substr(9, 1)).withColumn("source", held["source"])), model, "doc_id")
    joined = right.join(held.select("doc_id", "lang"), "doc_id").selectExpr("avg(cast(language = lang as int))", "avg(cast(accepted as int))").first()
    assert joined[0] > 0.97 and joined[1] > 0.99
