import random

from seasonframe.llm.quotes import link_quotes, reply_ordered

SCHEMA = "conv_id long, turn long, role string, text string, depth string, parent_turn int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def collected(spark, rows):
    return sorted((tuple(r)[:9] for r in reply_ordered(table(spark, rows)).collect()), key=repr)


def level(line):
    stripped = line.lstrip(" \t")
    if len(line) - len(stripped) > 3 or not stripped.startswith(">"):
        return 0
    marks = line[: len(line) - len(line.lstrip(" \t>"))]
    return marks.count(">")


def plain(text):
    return " ".join(text.split()).lower()


def brute(rows):
    """The same by plain loops over all messages; keys are unique here."""
    said = {}
    for conv, turn, _, text in sorted(rows, key=lambda r: r[1]):
        lines = ["" if level(x) else x for x in text.split("\n")]
        for paragraph in "\n".join(lines).replace("\r", "").split("\n\n"):
            for part in paragraph.split("\n\n"):
                if plain(part):
                    said.setdefault((conv, plain(part)), turn)
    info = {}
    for conv, turn, _, text in rows:
        passages, before = [], None
        for line in text.split("\n"):
            depth, content = level(line), line.lstrip(" \t>") if level(line) else line
            if depth and plain(content):
                if before == depth:
                    passages[-1][1].append(content)
                else:
                    passages.append((depth, [content]))
                before = depth
            else:
                before = None
        links = [(d, i, said.get((conv, plain(" ".join(c))))) for i, (d, c) in enumerate(passages)]
        links = [(d, i, s if s is not None and s < turn else None) for d, i, s in links]
        good = sorted(x for x in links if x[2] is not None)
        info[conv, turn] = (good[0][2] if good else None, len(links), len(good))
    out = []
    for conv, turn, role, text in rows:
        parent, n, linked = info[conv, turn]
        at, depth = turn, 0
        while info[conv, at][0] is not None:
            at, depth = info[conv, at][0], depth + 1
        own = "\n".join(x for x in text.split("\n") if not level(x)).strip()
        out.append((conv, turn, role, own, parent, at, depth, n, linked))
    return sorted(out, key=repr)


def test_random_threads_equal_plain_loops(spark):
    rng = random.Random(4)
    rows = []
    for conv in range(6):
        bodies = []
        for turn in range(25):
            lines = []
            for _ in range(rng.randint(0, 3)):
                quoted = rng.choice(bodies) if bodies and rng.random() < 0.8 else f"never said {rng.random()}"
                lines += [rng.choice([">", "> ", " >", "> > ", ">>"]) + quoted.upper(), ""]
            body = f"message {conv if rng.random() < 0.7 else 0} {turn} says {rng.randint(0, 20)}"
            bodies.append(body)
            rows.append((conv, turn, rng.choice(["user", "assistant"]), "\n".join([*lines, body])))
    assert collected(spark, rows) == brute(rows)


def test_long_reply_chains(spark):
    rows = [(1, t, "user", f"> point {t - 1}\npoint {t}" if t else "point 0") for t in range(70)]
    assert {r[1]: (r[5], r[6]) for r in collected(spark, rows)} == {t: (0, t) for t in range(70)}


def test_odd_rows_have_defined_results(spark):
    rows = [
        (1, 0, "user", "Hello there\n\nSecond part\nof it"), (1, 1, None, "Ann wrote:\n> second PART of  it\nYes"), (1, 1, None, "Ann wrote:\n> second PART of  it\nYes"),
        (1, 2, "user", None), (1, 3, "user", ""), (None, 4, "user", "> Hello there"), (1, None, "user", "> Hello there\nx"), (2, 5, "user", "> Hello there"),
        (1, 6, "user", ">" * 5000 + " deep"), (1, 7, "user", "\n".join(["> Hello there"] * 2000 + ["end " * 20000])),
    ]
    got = reply_ordered(table(spark, rows)).collect()
    assert len(got) == len(rows)
    by_turn = {(r.conv_id, r.turn): r for r in got}
    assert by_turn[1, 1].text == "Yes" and by_turn[1, 1].parent_turn == 0 and by_turn[1, 1].chat_line == "user: Yes" and by_turn[1, 1].n_quotes == 1
    assert by_turn[1, 2].text == by_turn[1, 3].text == ""
    assert all(by_turn[k].parent_turn is None for k in [(None, 4), (1, None), (2, 5), (1, 6)])
    assert by_turn[1, 7].n_quotes == 1 and by_turn[1, 7].n_linked == 0  # one quoted paragraph of 2000 lines, never said so
    assert reply_ordered(table(spark, [])).collect() == []


def test_links_name_the_first_turn_that_says_it(spark):
    rows = [(1, 3, "u", "same"), (1, 5, "u", "same"), (1, 6, "u", "> Same"), (1, 2, "u", "> same")]
    assert {(r.turn, r.source_turn) for r in link_quotes(table(spark, rows)).collect()} == {(6, 3), (2, None)}


def test_parts_of_a_paragraph_link(spark):
    cases = [
        (["Line A\nLine B", "> Line B\nyes"], [0]),
        (["One is here. Two is\nthere! Three?", "> two is there!\nyes"], [0]),  # a sentence over two lines
        (["First point. Second point.", "> First point.\nyes\n> Second point.\nno"], [0, 0]),  # inline replies
        (["Part one\n\nPart two. More", "> Part one\n> Part two.\nyes"], [0]),  # two paragraphs, the second cut short
        (["a b c. d e f. g h.", "> d e\n> f. g\n> h.\nyes"], [0]),  # lines broken elsewhere
        (["Sure.", "Sure. Thanks.", "> Thanks.\n> Sure.\nno", "Thanks. Oh. Sure.", "> Thanks.\n> Sure.\nyes"], [None, 3]),  # in order
        (["a\nb.", "> a\n> a b.\nno"], [None]),  # lines that overlap are not said twice
        (["x y\nz", "z", "> z\nyes", "> y\nno"], [1, None]),  # a paragraph first, and no piece of a line
        (["> later\nno", "now and\nlater", "> later\nyes"], [None, 1]),
    ]
    rows = [(conv, turn, "user", text) for conv, (texts, _) in enumerate(cases) for turn, text in enumerate(texts)]
    links = sorted(link_quotes(table(spark, rows)).collect(), key=lambda r: (r.conv, r.turn, r.place))
    assert [[r.source_turn for r in links if r.conv == conv] for conv in range(len(cases))] == [want for _, want in cases]
    assert [r[4:7] for r in collected(spark, rows[:2])] == [(None, 0, 0), (0, 0, 1)]


def holds(run, text):
    """Whether the text has the run's lines as lines in order."""
    at = iter(x for x in (plain(x) for x in text.split("\n")) if x)
    return all(any(x == y for y in at) for x in run)


def test_random_lines_equal_plain_loops(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for conv in range(4):
        bodies = []
        for turn in range(20):
            quoted = [x for x in rng.choice(bodies).split("\n") if x and rng.random() < 0.6] if bodies else []
            if rng.random() < 0.2:
                rng.shuffle(quoted)
            body = "\n".join(rng.choice(["", "w one", "w two", "w three", "w four", f"w {turn}"]) for _ in range(rng.randint(1, 6)))
            rows.append((conv, turn, "user", "\n".join(["> " + x.upper() for x in quoted] + ["", body])))
            if quoted:
                paragraphs = [[plain(p) for p in b.split("\n\n")] for b in bodies]
                whole = [t for t, p in enumerate(paragraphs) if plain(" ".join(quoted)) in p]
                parts = [t for t, b in enumerate(bodies) if holds([plain(x) for x in quoted], b)]
                want[conv, turn] = (whole + parts + [None])[0]
            bodies.append(body)
    assert {(r.conv, r.turn): r.source_turn for r in link_quotes(table(spark, rows)).collect()} == want
    assert any(x is None for x in want.values())


def test_one_hot_conversation_and_passage(spark):
    rows = [(1, t, "user", "> first\nfirst" if t else "first") for t in range(400)]
    got = collected(spark, rows)
    assert all(r[4] == 0 and r[6] == 1 for r in got if r[1]) and len(got) == 400


def test_no_python_in_the_plan(spark):
    plan = reply_ordered(table(spark, [(1, 0, "u", "x")]))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
