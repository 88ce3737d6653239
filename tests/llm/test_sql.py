"""The registered queries that SQL can express, on the driver's tables and on tables made to test them."""

import os

import duckdb
import pytest

from seasonframe.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def compared(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        path = f"{folder}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    relation = con.sql(SQL[name])
    found = QUERIES[name](spark, str(folder))
    columns = sorted(found.columns)
    assert sorted(relation.columns) == columns
    got = sorted((tuple(r) for r in found.select(columns).collect()), key=repr)
    want = sorted(map(tuple, relation.select(", ".join(f'"{c}"' for c in columns)).fetchall()), key=repr)
    assert got == want
    return got


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(SQL))
def test_on_the_driver_tables(spark, name):
    assert compared(spark, SF_DIR, name)


def test_quotes_on_made_threads(spark, tmp_path):
    rows = [(1, 0, "user", "Hello there\n\nSecond para\nof it"), (1, 1, None, "> hello   THERE\n\nHi!"), (1, 2, "user", "Ann wrote:\n> > Hello there\n>\n> Hi!\nGreat"),
            (1, 3, "user", ""), (1, 4, "user", ">nothing\n>unknown\n> > great\nok"), (1, 5, "user", None), (None, 1, "u", "> x"), (1, None, "u", "y"),
            (2, 0, "user", "> Hello there"), (1, 6, "user", "> second para of it\n\nbye"), (1, 6, "user", "> second para of it\n\nbye")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = compared(spark, tmp_path, "op4_chat_formatting")
    assert sum(r[2] > 0 for r in got) == 5  # column depth


def test_partial_quotes_on_made_threads(spark, tmp_path):
    import random

    rng = random.Random(21)
    rows = []
    for conv in range(5):
        bodies = []
        for turn in range(24):
            quoted = []
            if bodies:
                source = [x for x in rng.choice(bodies).split("\n") if x]
                way = rng.randrange(4)
                if way == 0:
                    quoted = [x for x in source if rng.random() < 0.6]
                elif way == 1:
                    quoted = [s + "." for s in " ".join(source).split(".") if s.strip() and rng.random() < 0.5]
                elif way == 2:
                    words = " ".join(source).split()
                    quoted = [" ".join(words[i : i + 4]) for i in range(0, len(words), 4)]
                elif source:
                    quoted = rng.sample(source, len(source))
            body = "\n".join(rng.choice(["", "One is. Two is!", "Ok.", "Thanks.", "A b c d. E f", "no end", f"turn {turn} says. So"]) for _ in range(rng.randint(1, 5)))
            bodies.append(body)
            rows.append((conv, turn, "user", "\n".join(["> " + x.strip().upper() for x in quoted] + ["", body])))
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = compared(spark, tmp_path, "op4_chat_formatting")
    linked, quotes = (sum(r[i] for r in got) for i in (3, 4))  # columns n_linked and n_quotes
    assert 40 < linked < quotes


def test_near_vectors_on_made_clusters(spark, tmp_path):
    import numpy as np

    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 32))
    rows = [(i, (centres[i % 8] + 0.1 * rng.normal(size=32)).astype(np.float32).tolist(), i % 2) for i in range(80)]
    rows += [(100, rows[0][1], 0), (101, [0.0] * 32, 0), (102, [0.0] * 32, 0), (103, None, 0), (104, rows[0][1], None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = compared(spark, tmp_path, "op3_embedding_near_dedup")
    assert any(r[2] > 2 for r in got)
