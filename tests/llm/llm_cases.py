"""Rows that every operator must take: nulls in any column, empty and very long texts, repeats, clashing names."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, row long, kept boolean, "
          "key string, size long, label string, quality string, language string, mix string, edits string, "
          "_hash long, _mix_id string, _host string, _n long")
EXTRA = (7, 8, True, "k", 9, "l", "q", "g", "m", "e", 5, "x", "y", 6)


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edge_rows() -> list[tuple]:
    rng = random.Random(4)
    long = words(rng, 30_000, 5000)
    base = words(rng, 80)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, None, None, None), (4, "", "en", "b"),
        (5, " \n\t ", "en", "b"), (None, base + " end", "en", None), (None, None, None, None), (6, long, "de", "c"),
        (7, "one", "de", "c"), (8, "one two", "de", "c"), (9, "x" * 50_000, None, "d"), (10, "loop it " * 200, "en", "d"),
        (11, "12 34 -- !!", "en", "e"), (12, base.upper(), "en", "e"), (13, "é ñ 日本語 \U0001f600\n\n\r\n  z", "de", "e"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), *EXTRA) for i, t, lang, s in rows]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
