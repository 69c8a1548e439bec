"""Decontamination against comparing every window with every place of every text."""

import random
import re
from hashlib import sha256

import numpy as np
import pytest
from llm_cases import edge_docs, no_docs, words
from pyspark.sql import functions as F

from deckforge.llm import decontaminate as D


def words_of(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def longest_common(doc, item):
    """Words of the longest sequence in both."""
    best, row = 0, [0] * (len(doc) + 1)
    for w in item:
        row = [0] + [row[i] + 1 if x == w else 0 for i, x in enumerate(doc)]
        best = max(best, *row)
    return best


def brute(doc, items, window=10):
    w, hit, found = words_of(doc), set(), set()
    for item_id, text in items:
        t = words_of(text)
        n = min(window, len(t))
        grams = {tuple(t[i:i + n]) for i in range(len(t) - n + 1)} if t else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                if item_id is not None:
                    found.add(str(item_id))
    return len(w), hit, sorted(found)


def check(spark, docs, items, **options):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    scanned = D.scan(d, b, **options)
    for r in scanned.collect():
        n, hit, found = brute(docs[r.doc_id], items)
        got = {i for s in r.benchmark.spans for i in range(s.start, s.end)}
        assert (r.benchmark.n_words, r.benchmark.n_hit, got, r.benchmark["items"]) == (n, len(hit), hit, found), r.doc_id
    best = {r["item"]: r for r in D.longest_matches(scanned).collect()}
    for item_id in {i for i, _ in items if i is not None}:
        texts = [words_of(t) for i, t in items if i == item_id]
        most = max((longest_common(words_of(x), t) for x in docs for t in texts if brute(x, [(0, " ".join(t))])[1]),
                   default=0)
        r = best.get(str(item_id))
        assert (r.words if r else 0) == most, item_id
        if r:  # the place named does hold these words
            there = words_of(docs[r.doc_id])[r.start:r.start + r.words]
            assert any(t[r.item_start:r.item_start + r.words] == there for t in texts)
    kept = {r.doc_id for r in D.decontaminate(d, b, **options).collect()}
    assert kept == {i for i, x in enumerate(docs) if not brute(x, items)[1]}


def cases(rng, vocabulary):
    items = [(i, words(rng, rng.choice([1, 3, 9, 10, 11, 25, 60]), vocabulary)) for i in range(14)]
    items += [(None, words(rng, 12, vocabulary)), (14, items[5][1]), (14, "Second, text! " + items[6][1]), (15, None),
              (16, " .,; "), (17, items[3][1] + " " + items[4][1])]
    docs = [None, "", "...", words(rng, 5, vocabulary)]
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            t = rng.choice(items)[1] or ""
            w = t.split()
            a = rng.randrange(len(w) + 1)
            parts += [words(rng, rng.randrange(30), vocabulary), " ".join(w[a:] if rng.random() < 0.5 else w).upper()]
        docs.append(rng.choice([" ", "\n-- ", "/"]).join(parts))
    return docs + docs[-3:], items


@pytest.mark.parametrize("vocabulary, options", [
    (400, {}), (3, {}), (400, {"shard_bytes": 1}), (60, {"test_bytes": 500}),
    (10**6, {"shard_bytes": 700, "test_bytes": 250})])
def test_matches_brute_force(spark, vocabulary, options):
    docs, items = cases(random.Random(vocabulary), vocabulary)
    check(spark, docs, items, **options)


def test_repeated_words_and_long_items(spark):
    """Items and texts of one word over and over, and a long item of which texts hold long parts."""
    long = words(random.Random(1), 300, 50)
    docs = ["the " * 57, "the " * 9, long + " x " + long[100:900], "a " + " ".join(long.split()[40:220]) + " b"] * 3
    check(spark, docs, [(1, "the " * 10), (2, "The the, the"), (3, "the " * 40), (4, long), (5, "z")])


def test_suffix_array_sorts_all_suffixes():
    rng = np.random.default_rng(3)
    for top, n in ((2, 400), (6, 900), (5000, 500)):
        ids = np.append(rng.integers(0, top, n) * (rng.random(n) < 0.95), np.zeros(64, np.int64)).astype(np.int64)
        at, _ = D.suffix_array(ids, D.Packing(top), 10**6)
        suffixes = []
        for p in at:
            end = p + int(np.flatnonzero(ids[p:] == 0)[0])
            suffixes.append(tuple(ids[p:end]))
        assert suffixes == sorted(suffixes) and sorted(at) == list(np.flatnonzero(ids))


def test_edge_rows(spark):
    docs = edge_docs(spark)
    items = spark.createDataFrame([(1, "loop it loop it loop it loop it loop it", 3), (None, None, 3), (2, "日本語 x", 3)],
                                  "item_id long, text string, benchmark long")
    out = D.scan(docs, items)
    assert out.columns == [*docs.columns, "benchmark"]
    for r in out.collect():
        assert (r.benchmark.n_words, r.benchmark.n_hit) == (len(words_of(r.text)), 400 if r.doc_id == 10 else 0)
    assert D.scan(docs.withColumn("BENCHMARK", F.lit(1)), items).columns == [*docs.columns, "benchmark"]
    assert D.scan(no_docs(spark), items).collect() == []
    assert D.decontaminate(docs, items.limit(0)).count() == docs.count()
    assert D.decontaminate(docs, items).columns == docs.columns


def test_very_long_text(spark):
    rng = random.Random(8)
    item = words(rng, 30, 5000)
    text = words(rng, 60_000, 5000) + " " + item + " " + words(rng, 60_000, 5000)
    r = D.scan(spark.createDataFrame([(text,)], "text string"),
               spark.createDataFrame([(1, item)], "item_id long, text string")).collect()[0].benchmark
    assert r.n_hit == 30 and [tuple(s) for s in r.spans] == [(60_000, 60_030)] and r.longest[0].words >= 30


def test_query(spark):
    from deckforge.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op12_benchmark_decontamination"](spark, sf).collect()
    assert len(got) == len(texts) and any(r.contaminated for r in got)
    for r in got:
        n, hit, found = brute(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, len(hit), len(found), bool(hit))
        assert r.items_sha256 == sha256(",".join(found).encode()).hexdigest()
