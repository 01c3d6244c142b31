import duckdb
import pandas as pd
import random

from textloom.llm import quotes

COLUMNS = ["conv_id", "turn", "role", "text_unquoted", "n_quoted", "n_linked", "parent_turn", "root_turn", "depth", "reply_order"]


def same_as_sql(spark, rows):
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, quotes.link_quotations(df).select(COLUMNS).collect()), key=repr)
    db = duckdb.connect()
    db.register("conversations", frame)
    want = sorted(db.sql(f"SELECT {', '.join(COLUMNS)} FROM ({quotes.SQL})").fetchall(), key=repr)
    assert got == want
    return {(r[0], r[1]): r for r in got}


def test_threads(spark):
    rows = [
        (1, 0, "user", "First  Passage\nwrapped here\n\nsecond"),
        (1, 1, "assistant", "> first passage wrapped\n> HERE\n\nAnswer one"),
        (1, 2, "user", "> > First passage wrapped here\n> Answer one\nanswer two\n> second"),
        (1, 3, "user", ">> answer one\nno link at level 1"),
        (1, 4, "user", "> nothing like it"),
        (2, 0, "user", "> First passage wrapped here"),
        (None, 1, "user", "> second"),
        (1, None, "user", "x"),
        (1, 9, None, None),
        (1, 10, "user", ""),
        (1, 2, "user", "a row of the same turn\n> second"),
    ]
    got = same_as_sql(spark, rows)
    assert got[1, 1][3:] == ("Answer one", 1, 1, 0, 0, 1, 1)
    assert got[1, 3][6:9] == (1, 0, 2) and got[1, 4][6:] == (None, 4, 0, 0) and got[2, 0][6:] == (None, 0, 0, 0)


def test_random_against_sql(spark):
    rng = random.Random(9)
    rows, said = [], {}
    for c in range(12):
        for t in range(rng.randint(1, 40)):
            lines = []
            for _ in range(rng.randint(0, 5)):
                earlier = said.get(c, ["x"])
                lines.append(rng.choice(["", ">", "> ", ">> ", "> > ", " >"]) + rng.choice(earlier + ["a b", "C", " ", "tail\t"]))
            said.setdefault(c, ["x"]).append(rng.choice(lines + ["y"]).lstrip("> "))
            rows.append((c, t * 700, "user", "\n".join(lines)))
    same_as_sql(spark, rows + rows[:5])


def test_deep_chain(spark):
    rows = [(7, 0, "u", "p0")] + [(7, t, "u", f"> p{t - 1}\np{t}") for t in range(1, 70)]
    got = same_as_sql(spark, rows)
    assert got[7, 69][6:] == (68, 0, 69, 69)


def test_reply_order_is_depth_first(spark):
    parent = {1: 0, 2: 0, 3: 1, 4: 2, 1100: 0, 1101: 1, 2500: 3, 2501: 1100}
    rows = [(3, 0, "u", "p0")] + [(3, t, "u", f"> p{p}\np{t}") for t, p in parent.items()]
    got = same_as_sql(spark, rows)
    assert [t for _, t in sorted(got, key=lambda k: got[k][9])] == [0, 1, 3, 2500, 1101, 2, 4, 1100, 2501]


def test_no_rows(spark):
    assert quotes.link_quotations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_plan_has_no_python(spark, sf):
    plan = quotes.query(spark, sf)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
