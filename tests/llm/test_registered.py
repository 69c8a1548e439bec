"""Registered queries against their SQL, and the pipeline against a plain version."""

import os
import sys
from collections import Counter

import duckdb
import pytest
from llm_cases import edge_docs, edge_rows, no_docs
from test_bpe import LIBRARY
from test_neardup import brute as brute_components

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def entry():
    import __spark_entry__
    return __spark_entry__


def test_one_query_for_each_operator(entry):
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op1_quality_rules", "op3_document_fingerprints", "op4_near_duplicates",
                                  "op6_url_filter", "op7_license_scan", "op9_chat_format", "op11_phrase_collocations",
                                  "op12_benchmark_decontamination", "op13_merkle_manifest"])
def test_query_matches_sql(spark, entry, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    got = entry.queries()[name](spark, SF001)
    want = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    tidy = lambda v: round(v, 9) if isinstance(v, float) else v
    a = Counter(tuple(tidy(v) for v in r) for r in got.select(*columns).collect())
    b = Counter(tuple(tidy(v) for v in r) for r in want.fetchall())
    assert a == b


def test_language_query(spark, entry):
    rows = entry.queries()["op2_language_id"](spark, SF001).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(langs) and 0.1 < len(held) / len(rows) < 0.4
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)


def test_token_queries(spark, entry):
    import hashlib
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in entry.queries()["op8_byte_bpe"](spark, SF001).collect():
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    for r in entry.queries()["op5_edited_token_counts"](spark, SF001).collect():
        t = texts[r.doc_id]
        n = len(t)
        e = t[:n // 2] + " newly revised " + t[n // 2:]
        e = e[:n // 4] + e[n // 4 + 16:]
        at = min(3 * n // 4, len(e))
        e = e[:at] + t[:24] + e[at + 8:]
        assert (r.n_tokens, r.n_edited_tokens) == (len(LIBRARY.encode_ordinary(t)), len(LIBRARY.encode_ordinary(e)))
        assert r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()


def test_mix_query(spark, entry):
    rows = entry.queries()["op10_source_mix"](spark, SF001).collect()
    assert len(rows) == 200 and all(r.taken <= 3 * r["size"] for r in rows)
    assert abs(sum(r.taken for r in rows) / sum(r["size"] for r in rows) - 1) < 0.02


def test_stages_on_edge_rows(spark):
    import corpus_pipeline as P
    docs = edge_docs(spark)
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs, SF001).columns == docs.columns, name
        assert stage(spark, no_docs(spark), SF001).count() == 0
    kept = Counter(r.doc_id for r in P.quality(spark, docs, SF001).collect())
    assert kept == Counter({1: 1, 2: 2, 6: 1, 12: 1, None: 1})
    languages = Counter(r.doc_id for r in P.languages(spark, docs, SF001).collect())
    assert languages == Counter(r[0] for r in edge_rows() if any(c.isalpha() for c in r[1] or ""))
    out = P.tokens(spark, docs, SF001).collect()
    assert len(out) == len(edge_rows()) and all(r.round_trip for r in out)


def test_pipeline_against_each_stage_alone(spark):
    """What each stage of a run kept follows from its own input by a plain version."""
    import corpus_pipeline as P
    from test_repetition import brute as repeats
    from deckforge.llm import repetition
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("doc_id < 60")
    rows = {r.doc_id: r for r in docs.collect()}

    def passes(text):
        n, repeated, covered, longest = repeats(text.encode(), repetition.MIN_REPEAT)
        return not (n < 50 or 100 * repeated > 50 * n or longest > repetition.MAX_REPEAT
                    or 100 * len(covered) > repetition.MAX_COVERED_PERCENT * n)

    first = P.quality(spark, docs, SF001)
    assert {r.doc_id for r in first.collect()} == {i for i, r in rows.items() if passes(r.text)}
    second = P.languages(spark, first, SF001)
    assert second.count() == first.count()  # all have one language
    third = P.near_dedup(spark, second, SF001)
    parts = brute_components([(r.doc_id, r.text) for r in second.collect()], P.DEDUP_SHINGLE_WORDS, P.DEDUP_PERCENT)
    assert sorted(r.doc_id for r in third.collect()) == sorted({c for _, _, c, _ in parts})
    fourth = P.mix(spark, third, SF001)
    words_in = lambda df: sum(len(r.text.split()) for r in df.collect())
    assert abs(words_in(fourth) / words_in(third) - 1) < 0.05
    fifth = P.tokens(spark, fourth, SF001).collect()
    assert Counter(r.doc_id for r in fifth) == Counter(r.doc_id for r in fourth.collect())
    assert all(r.round_trip and r.ids == LIBRARY.encode_ordinary(rows[r.doc_id].text) for r in fifth)


def plain_repeats(text):
    """``brute`` of the repetition tests, comparing only positions with the same next three words."""
    w, at = text.encode().split(), {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered, longest = set(), 0
    for places in at.values():
        for x, i in enumerate(places):
            for j in places[x + 1:]:
                k = 3
                while j + k < len(w) and w[i + k] == w[j + k]:
                    k += 1
                longest = max(longest, k)
                if k >= 15:
                    covered |= set(range(i, i + k)) | set(range(j, j + k))
    repeated = {p + k for places in at.values() if len(places) > 1 for p in places for k in range(3)}
    return len(w), len(repeated), len(covered), longest


def test_run_against_a_plain_version(spark):
    """The rows of ``run`` over a whole small table, from plain versions of all five stages: which documents
    are left after the first three, how often the mix may and must take them, and their ids."""
    import corpus_pipeline as P
    from deckforge.llm import mixing, repetition
    from test_mixing import brute_targets
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    assert repetition.MIN_REPEAT == 15

    def passes(text):
        n, repeated, covered, longest = plain_repeats(text)
        return not (n < 50 or 100 * repeated > 50 * n or longest > repetition.MAX_REPEAT
                    or 100 * covered > repetition.MAX_COVERED_PERCENT * n)

    def in_a_language(text):
        has = [any(c.isalpha() for c in w) for w in text.split()]
        return any(has) and sum(has) >= P.MIN_LETTERED * len(has)

    left = [i for i, r in docs.items() if passes(r.text) and in_a_language(r.text)]
    assert 0 < len(left) < len(docs)
    parts = brute_components([(i, docs[i].text) for i in left], P.DEDUP_SHINGLE_WORDS, P.DEDUP_PERCENT)
    unique = sorted({c for _, _, c, _ in parts})
    assert len(unique) < len(left)
    out = P.run(spark, SF001)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "round_trip"]
    rows = out.collect()
    taken = Counter(r.doc_id for r in rows)
    assert set(taken) <= set(unique) and max(taken.values()) <= mixing.MAX_COPIES
    size = {i: len(docs[i].text.encode().split()) for i in unique}
    by_source = {}
    for i in unique:
        by_source.setdefault(docs[i].source, []).append(i)
    want = brute_targets({x: sum(size[i] for i in ids) for x, ids in by_source.items()})
    for x, ids in by_source.items():
        got = sum(size[i] * taken[i] for i in ids)
        assert abs(got - want[x]) <= max(size[i] for i in ids) / 2 + 1, (x, got, float(want[x]))
    for r in rows:
        d = docs[r.doc_id]
        assert (r.lang, r.source, r.ids, r.n_tokens, r.round_trip) == (
            d.lang, d.source, LIBRARY.encode_ordinary(d.text), len(r.ids), True)
    assert Counter(r.doc_id for r in P.run(spark, SF001).collect()) == taken  # a rerun takes the same copies


def test_languages_of_any_kind_stay(spark):
    """Clean text mixed of languages, or in a script that no labelled document has, is no junk."""
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    by = {r.lang: r.text for r in docs.where("n_chars > 800").collect()}
    mixed = "\n".join(t[:600] for _, t in sorted(by.items()))
    cases = {1000: mixed, 1001: "Αυτό είναι ένα απλό κείμενο στα ελληνικά. " * 20, 1002: "これは日本語の文章です。" * 20,
             1003: "0101 -- 22 ## 33 == 44 " * 40, 1004: "x 1 2 3 4 5 6 7 8 9 " * 30, 1005: ""}
    more = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in cases.items()], docs.schema)
    kept = {r.doc_id for r in P.languages(spark, docs.unionByName(more), SF001).collect()}
    assert {i for i in cases if i in kept} == {1000, 1001, 1002}
