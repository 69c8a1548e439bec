"""Near-duplicate components against all pairs, on texts with chains, copies and blocks."""

import random

import numpy as np
import pytest
from llm_cases import edge_docs, edge_rows, no_docs, words

from deckforge.llm import neardup as N
from deckforge.llm.components import components


def shingles(text, width):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*(w[k:] for k in range(width))))


def brute(rows, width=3, percent=85):
    sets = [shingles(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if a and 100 * n >= percent * (len(a) + len(sets[j]) - n):
                up[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((doc_id, len(sets[i]), least, doc_id is not None and doc_id == least))
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()], key=str)


def variants(rng, n_bases, copies, edits):
    rows, i = [], 0
    for _ in range(n_bases):
        base = words(rng, rng.randrange(20, 120)).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(edits)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            rows.append((i, " ".join(w)))
            i += 1
            if rng.random() < 0.3:  # a copy of a copy: chains
                base = w
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_components_match_all_pairs(spark, width, percent):
    rows = variants(random.Random(width), 12, 12, 5)
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=width, percent=percent)
    assert result(got) == brute(rows, width, percent)


def test_families_of_several_blocks(spark):
    rows = variants(random.Random(9), 2, 60, 9)
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block_members=7)
    assert result(got) == brute(rows)


def test_common_passage_links_nothing(spark):
    rng = random.Random(3)
    passage = words(rng, 60)
    rows = [(i, words(rng, 30, 10**6) + " " + passage + " " + words(rng, 30, 10**6)) for i in range(40)]
    assert result(N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_edge_rows(spark):
    got = N.near_duplicates(edge_docs(spark))
    assert result(got) == brute([(r[0], r[1]) for r in edge_rows()])


def test_one_row_of_each_component_stays(spark):
    rows = [(i, t) for i, t in variants(random.Random(1), 6, 6, 3)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, label string")
    kept = N.deduplicated(docs.unionByName(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c, _ in brute(rows)})


def test_deduplicated_edge_rows(spark):
    docs = edge_docs(spark)
    kept = N.deduplicated(docs).collect()
    ids = [r.doc_id for r in kept]
    # 2 repeats 1, 12 differs in case alone, the unnumbered near copy goes too; rows without shingles all stay
    assert sorted(str(i) for i in ids) == sorted(str(i) for i in [1, 3, 4, 5, None, 6, 7, 8, 9, 10, 11, 13])
    assert N.deduplicated(no_docs(spark)).count() == 0


def test_empty_table(spark):
    assert N.near_duplicates(no_docs(spark)).count() == 0


def test_matches_needed_bounds_the_miss():
    from math import comb
    for percent in (80, 85):
        m = N.matches_needed(percent, 48)
        p = percent / 100
        assert sum(comb(48, i) * p**i * (1 - p) ** (48 - i) for i in range(m)) < N.MISS


def test_link_counts_collisions_exactly():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(25)]
    forest = N._Forest(25)
    N.link(sets, 60, forest, np.arange(25), np.arange(25))
    up = list(range(25))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(25):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 60 * (len(sets[i]) + len(sets[j]) - n):
                up[root(i)] = root(j)
    groups = lambda of: sorted(map(sorted, {k: [i for i in range(25) if of(i) == k] for k in map(of, range(25))}.values()))
    assert groups(forest.root) == groups(root)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 200), (300, 299), (299, 300)]
    got = {r.u: r.v for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(1, 41)} | {k: 100 for k in range(101, 130)} | {300: 299}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_a_template_family_reads_no_texts_across_blocks(spark):
    """Pages that share a template below the similarity: one family of many blocks, whose texts are compared
    within their blocks only, so text rows grow in proportion."""
    from pyspark.sql import functions as F
    rng = random.Random(12)
    template = words(rng, 60, 10**6)
    matches = N.matches_needed(85, N.COORDINATES)
    for n in (120, 240):
        rows = [(i, template + " " + words(rng, 60, 10**6)) for i in range(n)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        sketched = N.sketches(docs, "doc_id", "text", 3, N.COORDINATES)
        family = N.families(sketched, 8)  # fewer matches asked for: all are one family
        named = family.withColumns({"block": F.pmod(F.xxhash64("cid"), F.lit(6)).cast("int"), "label": F.col("cid"),
                                    "outside": F.lit(True)})
        assert family.groupBy("hub").count().agg(F.max("count")).first()[0] > n / 2
        assert N.colliding(named, sketched, matches).count() == 0
        near = [(n + i, t.rsplit(" ", 1)[0]) for i, t in rows[:3]]  # and three that are near copies
        docs = docs.unionByName(spark.createDataFrame(near, docs.schema))
        sketched = N.sketches(docs, "doc_id", "text", 3, N.COORDINATES)
        named = N.families(sketched, 8).withColumns({
            "block": F.pmod(F.col("cid"), F.lit(6)).cast("int"), "label": F.col("cid"), "outside": F.lit(True)})
        found = N.colliding(named, sketched, matches).select("cid").distinct().join(
            sketched, F.col("cid") == F.col("row")).select("id").collect()
        assert {r.id for r in found} <= {0, 1, 2, n, n + 1, n + 2}
    got = N.near_duplicates(docs, block_members=20)
    assert result(got) == brute(rows + near)
