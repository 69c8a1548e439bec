"""Sketches: recovered differences against sets, next documents, edge rows."""

import hashlib
import random
from collections import Counter

from llm_cases import edge_docs, edge_rows, no_docs
from pyspark.sql import functions as F

from deckforge.llm import fingerprints as P


def brute_elements(text):
    md = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    return {md(p) if n == 1 else md(f"{md(p)}:{n}") for p, n in Counter((text or "").split("\n")).items()}


def test_elements(spark):
    texts = [None, "", "a", "a\na", "a\nb\na\n\n\n", "b\na\na\n\n\n"]
    out = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", P.elements(F.col("t")).alias("e")).collect()
    for r in out:
        assert set(r.e) == brute_elements(texts[r.i]) and len(r.e) == len(set(r.e))


def test_differences_of_all_sizes_are_recovered(spark):
    rng = random.Random(2)
    rows = []
    for k, (common, a, b) in enumerate([(0, 0, 0), (5, 0, 0), (5, 1, 0), (40, 10, 12), (0, 60, 0), (300, 200, 150),
                                        (0, 2500, 30), (2000, 3, 2)]):
        draw = lambda n: [rng.randrange(1 << 60) for _ in range(n)]
        c = draw(common)
        rows.append((k, c + draw(a), c + draw(b)))
    got = {r.k: r for r in P.differences(spark.createDataFrame(rows, "k int, a array<long>, b array<long>"), ["k"])
           .collect()}
    assert len(got) == len(rows)
    for k, a, b in rows:
        assert sorted(got[k].only_a) == sorted(set(a) - set(b)) and sorted(got[k].only_b) == sorted(set(b) - set(a))


def test_elements_that_share_all_splitting_bits(spark):
    a = [(i << 58) | 5 for i in range(2)]  # equal in the bits that place and split
    rows = [(1, a + [9], [9]), (2, list(range(100, 400)), [])]
    got = {r.k: r for r in P.differences(spark.createDataFrame(rows, "k int, a array<long>, b array<long>"), ["k"])
           .collect()}
    assert sorted(got[1].only_a) == a and len(got[2].only_a) == 300


def brute(rows):
    """Per row: the next text by id, nulls last as one id, the least text among equals."""
    order = sorted({(i is None, i or 0) for i, *_ in rows})
    out = []
    for i, text, *_ in rows:
        key = order[(order.index((i is None, i or 0)) + 1) % len(order)]
        text = text or ""
        half = len(text) // 2
        half_next = max(len(t or "") for j, t, *_ in rows if (j is None, j or 0) == (i is None, i or 0)) // 2
        options = [(t or "") for j, t, *_ in rows if (j is None, j or 0) == key]
        nxt = min(options, key=lambda t: (t[:half_next].encode(), t.encode()))
        edited = text[:len(text) - half] + nxt[:half]
        like = lambda x, y: len(x & y) / len(x | y)
        own = brute_elements(text)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    round(like(own, brute_elements(edited)), 9), round(like(own, brute_elements(nxt)), 9)))
    return sorted(out, key=str)


def test_edge_rows_match_brute_force(spark):
    got = P.fingerprints(edge_docs(spark)).collect()
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9))
                   for r in got], key=str) == brute(edge_rows())


def test_equal_texts_have_equal_fingerprints(spark):
    rng = random.Random(0)
    lines = [f"line {rng.random()}" for _ in range(30)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines)), (3, "\n".join(lines[:-1])), (4, lines[0])]
    out = {r.doc_id: r for r in P.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].fingerprint == out[2].fingerprint != out[3].fingerprint
    assert out[1].near_next == 1.0 and abs(out[2].near_next - 29 / 30) < 1e-9
    assert out[4].edited_fingerprint != out[4].fingerprint


def test_one_document_and_none(spark):
    one = P.fingerprints(spark.createDataFrame([(5, "a\nb")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert P.fingerprints(no_docs(spark)).count() == 0


def test_plan_has_no_python(spark):
    plan = P.with_next(edge_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
