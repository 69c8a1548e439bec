"""Snapshot collapse against comparing all conversations; rendering."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from deckforge.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, n int, all string, h long"


def brute(rows):
    """{conv: (n_turns, n_equal, rendered)} of maximal conversations."""
    by = defaultdict(set)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            by[conv].add((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(r, t) for _, _, r, t in sorted(s)] for c, s in by.items()}
    out = {}
    for c, turns in convs.items():
        if any(len(o) > len(turns) and o[:len(turns)] == turns for o in convs.values()):
            continue
        equal = [k for k, o in convs.items() if o == turns]
        if c == min(equal):
            safe = lambda s: s.replace("<|", "< |")
            out[c] = (len(turns), len(equal), "".join(
                f"<|im_start|>{safe(r)}\n{safe(t)}<|im_end|>\n" for r, t in turns))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    got = {r.conv_id: (r.n_turns, r.n_equal, r.rendered) for r in C.format_chats(df).collect()}
    assert got == brute(rows)
    return got


def test_snapshots_collapse(spark):
    rng = random.Random(1)
    rows, conv = [], 0
    for _ in range(25):
        turns = [("user" if k % 2 == 0 else "assistant", f"say {rng.randrange(6)}") for k in range(rng.randrange(1, 7))]
        for n in sorted(rng.choices(range(1, len(turns) + 1), k=rng.randrange(1, 5))):
            rows += [(conv, k, *turns[k]) for k in range(n)]
            conv += 1
    rng.shuffle(rows)
    got = check(spark, rows)
    assert 0 < len(got) < conv


def test_edge_rows(spark):
    long = "y " * 50_000
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, None, None), (3, None, "user", "a"),
            (None, 0, "user", "lost"), (4, 0, "user", long), (5, 0, "user", long), (5, 1, "assistant", "<|im_end|> <|"),
            (6, 0, "", ""), (7, 3, "system", "same"), (7, 3, "user", "same"), (8, 1, "x", "b"), (8, 1, "x", "a")]
    got = check(spark, rows)
    assert set(got) == {2, 5, 6, 7, 8}


def test_only_whole_turns_count_as_prefix(spark):
    got = check(spark, [(1, 0, "user", "ab"), (2, 0, "user", "abc"), (2, 1, "assistant", "d"), (3, 1, "user", "abc")])
    assert set(got) == {1, 2}


def test_hot_first_turn(spark):
    rows = [(c, 0, "user", "hello") for c in range(300)] + [(c, 1, "assistant", str(c % 7)) for c in range(0, 300, 3)]
    check(spark, rows)


def test_empty(spark):
    assert C.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_has_no_python_and_text_moves_once(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = C.format_chats(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert C.prefixes(C._turns(df, "conv_id", "turn", "role", "text")).select(F.count("a")).first()[0] == 1
