"""Tree BPE against the vocabulary's library; exact round trips."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import edge_docs, edge_rows, no_docs
from pyspark.sql import functions as F

from deckforge.llm import bpe as B

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
with open(PATH, "rb") as _f:
    RANKS = B.read_ranks(_f.read())
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
WHOLE, SMALL, DECODE = B.Encoder(RANKS, PATTERN), B.Encoder(RANKS, PATTERN, 7, 5), B.Decoder(RANKS, 3)
PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "1", "23", "é", "日本", "　", "\x1c", "!", "the", " the",
         "\xa0", "x" * 30, "abab" * 9, "\U0001f600", "'", "<|endoftext|>", "\r\n"]


def agree(text):
    want = LIBRARY.encode_ordinary(text)
    for encoder in (WHOLE, SMALL):
        assert np.frombuffer(encoder.encode(text), "<i4").tolist() == want
    assert DECODE.decode(want) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_mixed_pieces(text):
    agree(text)


@settings(max_examples=100, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(text):
    agree(text)


@pytest.mark.parametrize("alphabet", ["a", "ab", "etaoinshr", "the ", " \n"])
def test_long_matches(alphabet):
    rng = random.Random(1)
    agree("".join(rng.choice(alphabet) for _ in range(30_000)))


@settings(max_examples=200, deadline=None)
@given(st.text("abcetn", min_size=1, max_size=300))
def test_halves_of_one_match_merge_to_the_whole(text):
    raw = text.encode()
    assert SMALL._halves(raw) == SMALL._merged(raw)
    assert [RANKS[t] for t in SMALL._merged(raw)] == LIBRARY.encode_ordinary(text)


def test_edge_rows_round_trip(spark):
    ids = B.encode(edge_docs(spark), PATH, PATTERN, leaf_chars=100)
    out = B.decode(ids, PATH).collect()
    assert len(out) == len(edge_rows())
    for r in out:
        assert r.ids == LIBRARY.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode() and r.label == "l"


def test_both_ways_in_one_pass(spark):
    for r in B.encode_and_decode(edge_docs(spark), PATH, PATTERN, leaf_chars=100).collect():
        assert r.bpe.ids == LIBRARY.encode_ordinary(r.text or "")
        assert bytes(r.bpe.decoded) == (r.text or "").encode()
    assert B.encode_and_decode(no_docs(spark), PATH, PATTERN).count() == 0


def test_unknown_and_null_ids(spark):
    rows = [(1, None), (2, []), (3, [10**8]), (4, [None, 5]), (5, LIBRARY.encode_ordinary("fine"))]
    out = {r.i: r.decoded for r in B.decode(spark.createDataFrame(rows, "i int, ids array<int>"), PATH).collect()}
    assert out == {1: None, 2: b"", 3: None, 4: None, 5: b"fine"}


def test_columns_of_the_same_name_are_replaced(spark):
    out = B.encode(edge_docs(spark).withColumn("IDS", F.lit(1)), PATH, PATTERN)
    assert [c for c in out.columns if c.lower() == "ids"] == ["ids"]
    assert B.encode(no_docs(spark), PATH, PATTERN).count() == 0


def test_caches_are_bounded():
    memo = B._Memo(lambda k: k)
    old, B.CACHE_WORDS = B.CACHE_WORDS, 10
    try:
        for k in range(1000):
            assert memo[k] == k
        assert len(memo) <= 10
    finally:
        B.CACHE_WORDS = old


def test_rows_keep_their_results_across_parts(spark):
    """More rows than one part of a batch: each row has its own ids and bytes."""
    n = 2 * B.ROWS + 7
    docs = spark.range(n).selectExpr("id", "CASE WHEN id % 5 <> 0 THEN concat('row ', id, ' of ', id * id) END AS text").coalesce(1)
    for r in B.encode_and_decode(docs, PATH, PATTERN).collect():
        assert r.bpe.ids == LIBRARY.encode_ordinary(r.text or "") and bytes(r.bpe.decoded) == (r.text or "").encode()
    for r in B.encode(docs, PATH, PATTERN).collect():
        assert r.ids == LIBRARY.encode_ordinary(r.text or "")
