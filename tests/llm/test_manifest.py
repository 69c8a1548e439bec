"""Manifest against a plain tree built from sorted rows."""

import random
import zlib
from hashlib import sha256

import pytest
from llm_cases import edge_docs, no_docs
from pyspark.sql import functions as F

from deckforge.llm import manifest as M


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(r, text=...):
    text = r["text"] if text is ... else text
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """The root and each node's siblings from its level to the root."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            first = i - i % 3
            proofs[k].append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + 3])))
        at = [i // 3 for i in at]
        nodes = [H(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return (nodes or [None])[0], proofs


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs = {s: tree([x[2] for x in sorted(groups[s])]) for s in sources}
    root, tops = tree([subs[s][0] for s in sources])
    out = []
    for s, top in zip(sources, tops):
        for (has, doc_id, h), proof in zip(sorted(groups[s]), subs[s][1]):
            out.append((doc_id if has else None, s, h, subs[s][0], root, tuple(proof + top)))
    return sorted(out, key=repr)


def made(df):
    return sorted(((r.doc_id, r.source, r.leaf, r.subroot, r.root, tuple(map(tuple, r.proof)))
                   for r in df.collect()), key=repr)


def random_rows(rng, n, ids, sources):
    rows = [dict(doc_id=ids(rng, i), source=rng.choice(sources), lang=rng.choice(["en", None, "é"]),
                 n_chars=rng.choice([None, i]), text=rng.choice([None, "", f"a\n{i}", "日本"])) for i in range(n)]
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("ids, sources", [
    (lambda rng, i: i, ["hot"] * 9 + ["a", None, "", "é", "z"]),  # dense, several rows of 729 nodes
    (lambda rng, i: rng.randrange(-2**63, 2**63), ["a", "b"]),  # the whole range of ids: seven directory levels
    (lambda rng, i: rng.choice([None, 7, 7, 8, -1, 64, 2**40 + i]), ["a", None]),  # many rows of one id
])
def test_matches_a_plain_tree(spark, ids, sources):
    rows = random_rows(random.Random(1), 2600, ids, sources)
    assert made(M.manifest(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 729, 730])
def test_sizes_at_the_borders_of_levels(spark, n):
    rows = [dict(doc_id=3 * i - 50, source="s", lang="en", n_chars=1, text="t") for i in range(n)]
    assert made(M.manifest(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_two_rounds_for_one_of_the_sources(spark, monkeypatch):
    """Sources of one to four rounds side by side."""
    monkeypatch.setattr(M, "ROUND_LEVELS", 2)
    monkeypatch.setattr(M, "SPAN", 9)
    rng = random.Random(2)
    rows = [dict(doc_id=rng.randrange(10**6), source=s, lang=None, n_chars=None, text=str(i))
            for s, n in (("a", 1), ("b", 9), ("c", 10), ("d", 82), (None, 800)) for i in range(n)]
    assert made(M.manifest(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_edge_rows_and_folding(spark):
    docs = edge_docs(spark)
    rows = [r.asDict() for r in docs.collect()]
    assert made(M.manifest(docs)) == brute(rows)
    again = M.manifest(docs, M.leaf(text=F.lit("x"))).select(
        "root", M.fold(F.col("leaf"), F.col("proof")).alias("same"), M.fold(F.col("other"), F.col("proof")).alias("not"))
    assert all(r.root == r.same != r["not"] for r in again.collect())
    assert M.manifest(no_docs(spark)).collect() == []


def test_verify_names_changed_rows(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, f"text {i}") for i in range(20)], SCHEMA)
    m = M.manifest(docs)
    assert M.verify(m, docs).count() == 0
    other = docs.where("doc_id <> 4").withColumn("text", F.when(F.col("doc_id") == 9, "new").otherwise(F.col("text")))
    got = sorted((r.doc_id, r.found) for r in M.verify(m, other).collect())
    assert got == [(4, -1), (9, -1), (9, 1)]


def test_query(spark):
    from deckforge.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {r[0]: r for r in brute(rows)}
    by_id = {r["doc_id"]: r for r in rows}
    got = QUERIES["op13_merkle_manifest"](spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        _, _, h, sub, root, proof = want[r.doc_id]
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == (h, sub, root, H(*[a + b for a, b in proof]))
        text = by_id[r.doc_id]["text"]
        if zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
            text = text.replace("\n", "")
        node = leaf(by_id[r.doc_id], text)
        for a, b in proof:
            node = H(a, node, b)
        assert r.folded_root == node and r.verified == (node == root)
