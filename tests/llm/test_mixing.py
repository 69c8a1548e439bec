"""Targets against water filling by exact fractions, rates against the entropy optimum, rounding."""

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from llm_cases import edge_docs, edge_rows, no_docs, words

from deckforge.llm import mixing as M


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        if not free:
            return {s: Fraction(3 * sizes[s]) for s in order}
        rest = Fraction(total - sum(3 * sizes[s] for s in capped), sum(weight[s] for s in free))
        over = {s for s in free if weight[s] * rest > 3 * sizes[s]}
        if not over:
            return {s: Fraction(3 * sizes[s]) if s in capped else weight[s] * rest for s in order}
        capped |= over


def collect(df):
    return [(r.doc_id, r.source, r.mix) for r in df.collect()]


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_taken_words(spark, seed):
    rng = random.Random(seed)
    sources = [None, "a", "B", "ä", "z", "", "hot"]
    rows = []
    for i in range(400):
        s = "hot" if rng.random() < 0.3 else rng.choice(sources[:3 + seed])
        rows.append((i, words(rng, max(1, int(rng.lognormvariate(3, 1)))), s))
    rows += [(1000 + k, words(rng, 2), "tiny") for k in range(2)]
    out = collect(M.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for _, s, m in out:
        assert 0 <= m.copies <= 3 and m.taken == m.copies * m["size"]
        sizes[s] += m["size"]
        taken[s] += m.taken
        target[s] = m.target
    want = brute_targets(sizes)
    for s in sizes:
        assert math.isclose(target[s], float(want[s]), rel_tol=1e-12)
        assert all(m.source_size == sizes[s] for _, x, m in out if x == s)
        assert abs(taken[s] - target[s]) <= max(4, 0.01 * target[s]), (s, taken[s], target[s])
    assert math.isclose(sum(target.values()), sum(sizes.values()), rel_tol=1e-9)


@pytest.mark.parametrize("sizes", [
    {"a": 429_496_730, "b": 1}, {"a": 500_000_000, "b": 600_000_000, None: 7, "c": 1_040_000_000},
    {"a": 2_147_483_647}, {"a": 3_000_000_000, "b": 100_000_000, "c": 400_000_000, "d": 5_000_000_000}])
def test_targets_of_more_words_than_an_int_times_a_weight(spark, sizes):
    rows = [(s, n - n // 2) for s, n in sizes.items()] + [(s, n // 2) for s, n in sizes.items()]
    got = {r.source: r.target for r in M.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    for s in sizes:
        assert math.isclose(got[s], float(want[s]), rel_tol=1e-12)


def test_long_texts_are_mixed_as_short_ones(spark, monkeypatch):
    """All sizes times 2 ** 18: a billion words, taken in the same copies (doubles are scaled without rounding)."""
    rng = random.Random(11)
    rows = [(i, words(rng, rng.randrange(1, 40)), rng.choice("aaabcd")) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    short, words_in = collect(M.mix(docs)), M.words_in
    assert 2 ** 31 // 5 < sum(m["size"] for _, _, m in short) * 2 ** 18 < 2 ** 31
    monkeypatch.setattr(M, "words_in", lambda text: words_in(text) * 2 ** 18)
    assert Counter(r.doc_id for r in M.mixed(docs).collect()) == Counter({i: m.copies for i, _, m in short if m.copies})


def test_rates_are_the_entropy_optimum(spark):
    """At the optimum, log rates below the cap are one multiplier times size."""
    rng = random.Random(3)
    rows = [(i, words(rng, rng.choice([5, 10, 20, 40])), "a" if i % 3 else "b") for i in range(300)]
    out = collect(M.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    for s in "ab":
        by = defaultdict(list)
        for _, x, m in out:
            if x == s:
                by[m["size"]].append(m.copies)
        rates = {n: sum(c) / len(c) for n, c in by.items()}
        logs = [math.log(r) / n for n, r in rates.items() if 0.1 < r < 2.9]
        assert max(logs) - min(logs) < 0.08


def test_edge_rows(spark):
    docs = edge_docs(spark)
    out = M.mix(docs)
    assert out.columns == [c for c in docs.columns if c != "mix"] + ["mix"]
    rows = out.collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        assert r.mix["size"] == len((r.text or "").replace("\U0001f600", "x").split())
        if not r.mix["size"]:
            assert (r.mix.copies, r.mix.taken) == (1, 0)
    same = [r.mix.copies for r in rows if r.doc_id == 2]
    assert same[0] == same[1]


def test_mixed_repeats_documents_as_often_as_taken(spark):
    docs = edge_docs(spark).where("doc_id != 2 and doc_id is not null")
    times = {r.doc_id: r.mix.copies for r in M.mix(docs).collect()}
    got = M.mixed(docs)
    assert got.columns == docs.columns
    seen = defaultdict(int)
    for r in got.collect():
        seen[r.doc_id] += 1
    assert dict(seen) == {k: v for k, v in times.items() if v}


def test_reruns_agree_on_another_partitioning(spark):
    rng = random.Random(8)
    rows = [(i, words(rng, rng.randrange(1, 30)), rng.choice("abc")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    a, b = ({r.doc_id: r.mix.copies for r in M.mix(d).collect()} for d in (docs, docs.repartition(7, "text")))
    assert a == b


def test_one_size_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 5)
    rows = [(i, "same size here", "ab"[i % 2]) for i in range(200)]
    out = collect(M.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    for s in "ab":
        taken = sum(m.taken for _, x, m in out if x == s)
        assert abs(taken - next(m.target for _, x, m in out if x == s)) <= 3


def test_empty_and_wordless(spark):
    assert M.mix(no_docs(spark)).count() == 0
    wordless = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(m.taken, m.target) for _, _, m in collect(M.mix(wordless))] == [(0, 0.0)] * 2
