"""Language ID: Viterbi against a plain one, spans of mixed text, held-out accuracy, edge rows."""

import random

import numpy as np
import pytest
from llm_cases import edge_docs, edge_rows, no_docs
from pyspark.sql import functions as F

from deckforge.llm import language as L

SF001 = "/root/testdata/sf0.001"
SYLLABLES = {"aa": ["ka", "lo", "mi", "ra"], "bb": ["sch", "ung", "der", "ich"], "ру": ["про", "ста", "ние", "ко"]}


def sentence(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(i, sentence(lang, 60, rng), lang) for i, lang in enumerate(list(SYLLABLES) * 12)]
    return L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))


def plain_viterbi(score, penalty):
    worth, back = score[0].copy(), []
    for row in score[1:]:
        top = int(worth.argmax())
        change = worth[top] - np.float32(penalty)
        back.append([top if change > w else i for i, w in enumerate(worth)])
        worth = np.maximum(worth, change) + row
    path = [int(worth.argmax())]
    for came in reversed(back):
        path.append(came[path[-1]])
    return path[::-1]


def test_viterbi_in_step_matches_one_by_one():
    rng = np.random.default_rng(0)
    for _ in range(40):
        lengths = rng.integers(0, 30, 7)
        score = rng.normal(0, 3, (lengths.sum(), 4)).astype(np.float32)
        path, at = L.viterbi(score, lengths, 4.0), 0
        for n in lengths:
            if n:
                assert path[at:at + n].tolist() == plain_viterbi(score[at:at + n], 4.0)
            at += n


def test_viterbi_finds_the_best_of_all_sequences():
    from itertools import product
    rng = np.random.default_rng(3)
    score = rng.normal(0, 2, (7, 3)).astype(np.float32)
    worth = lambda p: sum(score[t, x] for t, x in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))
    best = max(product(range(3), repeat=7), key=worth)
    assert L.viterbi(score, np.array([7]), 1.5).tolist() == list(best)


def test_spans_of_mixed_text(spark, model):
    rng = random.Random(2)
    text = sentence("aa", 30, rng) + " " + sentence("ру", 20, rng) + " 123 -- " + sentence("bb", 25, rng)
    out = L.label(spark.createDataFrame([(text,)], "text string"), model).first().language
    assert [(s.lang, s.start) for s in out.spans] == [("aa", 0), ("ру", 30), ("bb", 52)] or [
        s.lang for s in out.spans] == ["aa", "ру", "bb"]
    assert out.lang == "aa" and abs(out.score - 30 / 75) < 0.05 and out.n_words == 77


def test_script_narrows_the_candidates(model):
    score, tells = L.word_scores(model, ["простание".encode(), b"123", "日本".encode()])
    assert tells.tolist() == [True, False, False]
    assert score[0].argmax() == model.langs.index("ру") and (np.delete(score[0], model.langs.index("ру")) == -50).all()
    assert not score[1:].any()


def test_edge_rows(spark):
    out = L.identify(edge_docs(spark)).collect()
    assert len(out) == len(edge_rows()) and {r.label for r in out} == {"l"}
    for r in out:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.language.lang == "und") == (not lettered), r.text
        assert 0 <= r.language.score <= 1
        assert lettered or (r.language.score == 0 and r.language.spans == [])


def test_nothing_learned_and_empty(spark):
    unlabelled = edge_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.language.lang for r in L.identify(unlabelled).collect()} == {"und"}
    assert L.identify(no_docs(spark)).count() == 0


def test_held_out_rows_are_not_learned_from(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("abc def").alias("text"))
    docs = docs.withColumn("lang", F.when(L.held_out(), "secret").otherwise("open"))
    assert {r.language.lang for r in L.identify(docs).select("language").distinct().collect()} == {"open"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = L.identify(docs).where(L.held_out()).select("lang", "language.lang").collect()
    assert sum(a == b for a, b in out) >= 0.97 * len(out)


def test_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    a, b = (L.identify(docs).select("doc_id", "language").orderBy("doc_id").collect() for _ in range(2))
    assert a == b


def test_letters_far_into_a_text_are_learned(spark):
    """Whole texts are learned from, not their beginnings."""
    rng = random.Random(5)
    rows = [(i, " 12 34 " * 4000 + sentence(lang, 40, rng), lang) for i, lang in enumerate(["aa", "bb"] * 15)]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    tests = spark.createDataFrame([(sentence(lang, 30, rng), lang) for lang in ["aa", "bb"] * 10], "text string, lang string")
    assert all(r.lang == r.language.lang for r in L.label(tests, model).collect())


def test_words_are_cut_where_the_script_changes():
    assert L.pieces("plain-word9") == ["plain-word9"] and L.pieces("naïve") == ["naïve"] and L.pieces("") == [""]
    assert L.pieces("A中文字") == ["A", "中文字"] and L.pieces("(про)abc!") == ["(про)", "abc!"]
    assert L.pieces("一二三四五六七") == ["一二三四", "五六七"] and L.pieces("漢字かな") == ["漢字", "かな"]
    assert L.pieces("½中") == ["½中"] and L.pieces("日本1語") == ["日本1語"]


def test_text_without_spaces(spark):
    """A paragraph in another script that opens with a Latin letter, and spans inside text without spaces."""
    rng = random.Random(6)
    han = lambda n: "".join(rng.choice("的一是不了人我在有他这为之大来以个中上们") for _ in range(n))
    kana = lambda n: "".join(rng.choice("かなさたはまやらわがざだばぱ") for _ in range(n))
    rows = [(i, t, lang) for i, (t, lang) in enumerate(
        [(sentence("aa", 40, rng), "aa") for _ in range(10)] + [(han(200) + "。", "zh") for _ in range(10)]
        + [(kana(200), "ja") for _ in range(10)])]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    texts = ["A" + han(300), sentence("aa", 12, rng) + han(40) + sentence("aa", 12, rng), han(60) + kana(80)]
    out = [r.language for r in L.label(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()]
    assert out[0].lang == "zh" and out[0].score > 0.9
    assert [s.lang for s in out[1].spans] == ["aa", "zh", "aa"] and [s.lang for s in out[2].spans] == ["zh", "ja"]
    assert out[2].lang == "ja" and out[2].n_words == 35 and out[2].lettered == 1


def plain_rows(word):
    """The table rows of a word's 1- to 4-grams, one by one."""
    text, out = b" " + word + b" ", []
    for k in range(L.ORDERS):
        for i in range(len(word) + 1):
            if i + k + 1 <= len(text) and (k, i) != (0, 0):
                code = 0
                for b in text[i:i + k + 1]:
                    code = (code + b + 1) * 0x9E3779B1 % 2**32
                out.append(k * L.BUCKETS + (code ^ code >> 15) % L.BUCKETS)
    return out


def test_query_matches_a_plain_version(spark):
    """Training, scores and Viterbi of every document, word by word."""
    from deckforge.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF001}/documents.parquet").withColumn("held", L.held_out()).collect()
    cells, sizes = {}, {}
    for r in docs:
        if not r.held:
            sizes[r.lang] = sizes.get(r.lang, 0) + 1
            counts = cells.setdefault(r.lang, np.zeros(L.ORDERS * L.BUCKETS))
            for w in r.text.lower().split():
                if any(c.isalpha() for c in w):
                    np.add.at(counts, plain_rows(w.encode()), 1)
    langs = sorted(sizes)
    assert max(sizes.values()) <= L.TRAIN_DOCS  # all of them are learned from
    table = np.zeros((len(langs), L.ORDERS * L.BUCKETS))
    for i, lang in enumerate(langs):
        for k in range(L.ORDERS):
            part = cells[lang][k * L.BUCKETS:(k + 1) * L.BUCKETS] + 0.5
            table[i, k * L.BUCKETS:(k + 1) * L.BUCKETS] = np.log(part / part.sum())
    known = {}

    def scores(word):
        if word not in known:
            s = table[:, plain_rows(word.encode())].sum(axis=1) / L.ORDERS
            known[word] = np.maximum(s - s.max(), -50) if any(c.isalpha() for c in word) else np.zeros(len(langs))
        return known[word]

    got = {r.doc_id: r for r in QUERIES["op2_language_id"](spark, SF001).collect()}
    for r in docs:
        words = r.text.lower().split()
        path = plain_viterbi(np.array([scores(w) for w in words], np.float32), L.SWITCH_PENALTY) if words else []
        votes = [0] * len(langs)
        for w, x in zip(words, path):
            votes[x] += any(c.isalpha() for c in w)
        g = got[r.doc_id]
        if sum(votes):
            assert (g.lang_pred, g.held_out) == (langs[votes.index(max(votes))], r.held), r.doc_id
            assert abs(g.score - max(votes) / sum(votes)) < 1e-9
        else:
            assert g.lang_pred == "und"


def test_very_long_text(spark, model):
    rng = random.Random(7)
    text = sentence("aa", 60_000, rng) + " " + sentence("bb", 100_000, rng)
    out = L.label(spark.createDataFrame([(text,)], "text string"), model).first().language
    assert out.lang == "bb" and [s.lang for s in out.spans] == ["aa", "bb"] and out.n_words == 160_000
