import random
import re

import numpy as np

from seasonframe.llm.pii import Field, count_evidence, field_from_counts, find_personal_data, pass_messages, redact, rule_spans

RNG = random.Random(2)
PIECES = ["a.b@c.de", "x@y", "@", "a@b.c@d.e.f", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112",
          "+49 (170) 123-4567", "+1", "+12345678", "++4912345678901", "é", "\n", " ", "  ", "-", ".", "7", "00", "word", "00000000000000000001.1.1.1"]


def by_the_contract(text):
    def luhn(found):
        digits = [int(c) for c in found if c.isdigit()][::-1]
        return 13 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0

    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", luhn),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= sum(c in "0123456789" for c in s) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, (rule, fine) in enumerate(rules) for m in re.finditer(rule, text) if fine(m.group())]


def test_rules_equal_the_plain_patterns():
    for _ in range(3000):
        text = "".join(RNG.choice(PIECES) for _ in range(RNG.randint(0, 12)))
        assert rule_spans(text) == by_the_contract(text), text


def test_very_long_runs_take_linear_time():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "@" * 500_000, "+" * 500_000, "1." * 500_000, "a@" * 200_000):
        rule_spans(text)


def test_messages_give_exact_marginals_on_a_tree():
    rng = np.random.default_rng(3)
    local, tables = rng.normal(size=(4, 3)), rng.normal(size=(3, 3, 3))
    ends = np.array([[0, 1], [1, 2], [1, 3]])
    total = np.zeros((3, 3, 3, 3))
    for x in np.ndindex(3, 3, 3, 3):
        total[x] = np.exp(sum(local[i, x[i]] for i in range(4)) + sum(tables[e, x[a], x[b]] for e, (a, b) in enumerate(ends)))
    total /= total.sum()
    got = pass_messages(local, ends, tables)
    for i in range(4):
        assert np.allclose(got[i], total.sum(axis=tuple(j for j in range(4) if j != i)), atol=1e-3)


def plain_field():
    return field_from_counts({("shape", "12 digits/4"): 50, ("shape", "12 digits/0"): 5, ("shape", "letters/1"): 50, ("skip", "same"): 100})


def found(docs, **options):
    return {r.doc_id: [(s.kind, s.start, s.end, s.by_rule) for s in r.spans] for r in find_personal_data(docs, **options).collect()}


def test_distant_repetitions_take_the_label_of_the_rule(documents):
    far = "word " * 3000
    phone, bare = "+49 170 1234567", "49 170 1234567"
    rows = [
        (1, f"call {phone} now {far} or {bare} later"), (2, f"only {bare} here"), (3, None), (4, ""), (5, f"{phone} but 99 888 7776665"),
        (6, f"me@host.org {far} me (at) host (dot) org"), (None, phone), (7, "x" * 300_000),
    ]
    got = found(documents(rows), field=plain_field())
    text = dict(rows)[1]
    at = text.rindex(bare)
    assert got[1] == [("phone", 5, 20, True), ("phone", at, at + len(bare), False)]
    assert got[2] == [] and got[3] == [] and got[4] == [] and got[7] == []
    assert got[5] == [("phone", 0, 15, True)]
    assert [s[0] for s in got[6]] == ["email", "email"] and not got[6][1][3]
    assert got[None] == [("phone", 0, 15, True)]


def test_a_spoken_address_ends_with_its_sentence(documents):
    spoken = "jane (at) corp (dot) com"
    rows = [(1, f"Write to {spoken}. Really. Or to {spoken}. Or {spoken}"), (2, f"jane@corp.com or {spoken}. Really"), (3, "joe[at]mail.example.org. Next"), (4, "look (at) this. It (dot) ends")]
    docs = documents([*rows, (5, "plain words"), (6, None)])
    for options in ({}, {"field": plain_field()}):
        got = found(docs, **options)
        texts = {i: [t[a:b] for _, a, b, _ in got[i]] for i, t in rows}
        assert texts == {1: [spoken] * 3, 2: ["jane@corp.com", spoken], 3: ["joe[at]mail.example.org"], 4: []}
        assert got[5] == got[6] == []
    out = {r.doc_id: r.text for r in redact(docs, field=plain_field()).collect()}
    assert out[1] == "Write to [EMAIL]. Really. Or to [EMAIL]. Or [EMAIL]"
    assert out[2] == "[EMAIL] or [EMAIL]. Really" and out[3] == "[EMAIL]. Next"


def test_lone_numbers_are_doubted_by_what_the_sample_shows():
    plain, twinned = (count_evidence(t) for t in ("call 49 170 1234567 now", "call +49 170 1234567 or 49 170 1234567 now"))
    alone, both = (field_from_counts({k: 40 * n for k, n in c.items()}) for c in (plain, twinned))
    assert alone.doubt > 3 and both.doubt < 0
    assert alone.evidence("49 170 1234567").argmax() == 0


def test_trained_weights_keep_rules_and_leave_clean_texts(documents):
    rows = [(i, f"name {i} wrote to u{i}@host.org from 10.0.0.{i % 250} and +49 170 12345{i:02d}") for i in range(60)]
    rows += [(100 + i, f"the year 1999 and chapter {i}.2.3, order 12345678 of {i}") for i in range(60)]
    got = found(documents(rows), sample_docs=50)
    for i, text in rows:
        base = [(("email", "ip", "card", "phone")[k], a, b, True) for k, a, b in by_the_contract(text)]
        assert [s for s in got[i] if s[3]] == base
    assert all(got[100 + i] == [] for i in range(60))
    assert find_personal_data(documents([])).collect() == []


def test_redaction_keeps_columns_and_other_text(documents):
    rows = [(1, "é me@host.org, 1.2.3.4!"), (2, None), (3, "clean"), (4, "a+4912345678@b.de")]
    docs = documents(rows)
    out = redact(docs, field=plain_field())
    assert out.schema == docs.schema
    assert {r.doc_id: r.text for r in out.collect()} == {1: "é [EMAIL], [IP]!", 2: None, 3: "clean", 4: "[EMAIL]"}


def test_field_is_small():
    assert isinstance(plain_field(), Field) and 2 <= plain_field().skip <= 6
