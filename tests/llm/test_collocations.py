"""Collocations against counting every phrase of every text."""

import random
import re
from collections import Counter

import pytest
from llm_cases import edge_docs, no_docs
from pyspark.sql import functions as F

from deckforge.llm import collocations as C

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, max_words=3, min_count=10, covered=50, top=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for n in range(1, max_words + 1):
                for i in range(len(w) - n + 1):
                    counts[lang, tuple(w[i:i + n])] += 1
    out = []
    for lang in totals:
        found = {p: a for (x, p), a in counts.items() if x == lang and len(p) > 1 and a >= min_count}
        hidden = {p[i:j] for p, f in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and 100 * f >= covered * found[p[i:j]]}
        scored = []
        for p, a in found.items():
            if p not in hidden:
                s, k = min((10**6 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def made(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def texts(rng, n, vocabulary=30):
    fixed = ["new york city", "as soon as possible", "é à ü", "The the the", "a\x1cb c d"]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(1, 60)):
            parts.append(rng.choice(fixed) if rng.random() < 0.2 else f"w{int(rng.paretovariate(0.6)) % vocabulary}")
            parts.append(rng.choice([" "] * 8 + ["\t", ", ", ".", "\n", "\r\n", "!", "\x0b"]))
        out.append((rng.choice(["en", "en", "de", None, "und", ""]), "".join(parts)))
    return out + [("en", None), (None, ""), ("xx", " . , "), ("fr", "once only")]


@pytest.mark.parametrize("options", [
    {}, {"min_count": 2, "top": 40}, {"burst": 3, "entries": 50, "block": 60}, {"vocabulary": 5, "block": 40, "burst": 2},
    {"max_words": 5, "min_count": 3, "covered_percent": 80}, {"max_words": 2, "entries": 1}])
def test_matches_plain_counts(spark, options):
    rows = texts(random.Random(6), 400)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    want = {k.replace("covered_percent", "covered"): v for k, v in options.items()
            if k in ("max_words", "min_count", "covered_percent", "top")}
    assert made(C.collocations(df, **options)) == brute(rows, **want)


def test_phrases_across_blocks_of_a_long_text(spark):
    rng = random.Random(2)
    rows = [("en", " ".join(f"w{rng.randrange(12)}" for _ in range(40_000)))]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert made(C.collocations(df, block=1000, entries=100)) == brute(rows)


def test_score_is_exact(spark):
    big = [(10**14 + 7, 10**14 + 9, 10**14 + 8), (999_999_999_999_999,) * 3, (10, 10**14, 10**14), (3, 7, 9),
           (10**12 - 1, 10**12, 10**12 - 1)]
    df = spark.createDataFrame(big, "a long, l long, r long")
    got = [r[0] for r in df.select(C.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()]
    assert got == [10**6 * a * a // (left * right) for a, left, right in big]


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """With few bits every phrase passes."""
    rows = texts(random.Random(3), 300, 200)
    df = spark.createDataFrame(rows, "lang string, text string")
    want = brute(rows)
    assert made(C.collocations(df)) == want
    full = lambda phrases, length: phrases.sparkSession.sparkContext.broadcast(
        C.np.full(C.FILTER_BITS // 64, 2**64 - 1, C.np.uint64))
    monkeypatch.setattr(C, "frequent_filter", full)
    assert made(C.collocations(df)) == want


def test_trie_bursts_at_prefixes_and_keeps_counts():
    rng = random.Random(1)
    trie, plain = C.Trie(3, 20, 4), Counter()
    for _ in range(30):
        keys = [rng.choice([5, 5, rng.randrange(1, 40)]) << 40 | rng.randrange(1, 9) << 20 | rng.randrange(1, 9)
                for _ in range(60)]
        trie.add(C.np.array(keys))
        plain.update(keys)
    assert sum(trie.boxes, Counter()) == plain and trie.size == len(plain)
    assert all(len(b) <= 4 for b in trie.boxes) and len(trie.borders) == len(trie.boxes)
    for lo, hi, box in zip(trie.borders, [*trie.borders[1:], 1 << 62], trie.boxes):
        assert all(lo <= k < hi for k in box)
    gone = trie.leave(trie.size // 2)
    assert trie.size <= len(plain) // 2 + 1 and sum(gone, sum(trie.boxes, Counter())) == plain


def test_edge_rows(spark):
    docs = edge_docs(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert made(C.collocations(docs)) == brute(rows)
    assert made(C.collocations(no_docs(spark))) == []
    assert made(C.collocations(docs.where("text IS NULL"))) == []


def test_query(spark):
    from deckforge.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op11_phrase_collocations"](spark, sf)
    assert dict(got.dtypes) == {c: "string" if c in ("lang", "phrase") else "bigint" for c in COLUMNS}
    assert made(got) == brute(rows)
