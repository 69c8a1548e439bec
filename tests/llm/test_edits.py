"""Edit trees against encoding the edited text anew."""

import random

import public_tokenizers
from llm_cases import edge_docs, no_docs
from pyspark.sql import functions as F
from test_bpe import LIBRARY, PATH, PATTERN, WHOLE

from deckforge.llm import edits as E

PARTS = ["a", "b", " ", " ", " ", "  ", "\n", "the", "'s", "12", "é", "日本", "\x1c", "?!", "word", "x" * 9]


def text_of(rng, n):
    return "".join(rng.choice(PARTS) for _ in range(rng.randrange(n + 1)))


def apply(text, start, length, new):
    start = min(max(start, 0), len(text))
    return text[:start] + new + text[start + max(length, 0):]


def test_random_edits():
    rng = random.Random(5)
    for _ in range(600):
        text = text_of(rng, 60)
        tree = E.EditTree(text, WHOLE, rng.choice([1, 4, 16, 200]))
        for _ in range(rng.randrange(8)):
            start, length = rng.randint(-2, len(text) + 2), rng.randrange(rng.choice([1, 4, 21]))
            new = text_of(rng, rng.choice([0, 3, 40]))
            text = apply(text, start, length, new)
            tree.edit(start, length, new)
            assert tree.text == text and tree.chars[1] == len(text)
            assert tree.n_tokens == len(LIBRARY.encode_ordinary(text)), (text, tree.parts)


def test_an_edit_re_encodes_its_region_only():
    rng = random.Random(1)
    text = " ".join(rng.choice(["some", "words", "here"]) for _ in range(40_000))
    tree = E.EditTree(text, WHOLE)
    for k in range(10):
        tree.edit(len(text) * k // 10, 3, "zz")
    assert tree.reencoded < 10 * 4 * E.SEGMENT_CHARS
    assert tree.n_tokens == len(LIBRARY.encode_ordinary(tree.text))


def test_edge_rows_and_edit_values(spark):
    edits = spark.createDataFrame([
        (1, 2, 0, 4, "second"), (1, 1, 5, 0, " first "), (1, None, None, None, None), (3, 1, 9, 9, "into nothing"),
        (6, 1, 100_000, 50, ""), (6, 2, -5, 3, "<|endoftext|>"), (9, 1, 25_000, 1, " "), (None, 1, 0, 0, "lost"),
        (99, 1, 0, 0, "nowhere")], "doc_id long, seq long, start long, length long, replacement string")
    docs = E.attach_edits(edge_docs(spark), edits)
    assert docs.count() == edge_docs(spark).count()
    for r in E.count_edited(docs, PATH, PATTERN).collect():
        text = r.text or ""
        todo = sorted((e.seq is not None, e.seq or 0, e.start or 0, e.length or 0, e.replacement or "")
                      for e in r.edits or [])
        for _, _, start, length, new in todo:
            text = apply(text, start, length, new)
        c = r.counts
        assert c.text == text and c.n_edited_chars == len(text)
        assert c.n_tokens == len(LIBRARY.encode_ordinary(r.text or ""))
        assert c.n_edited_tokens == len(LIBRARY.encode_ordinary(text))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, seq long, start long, length long, replacement string")
    docs = E.attach_edits(no_docs(spark), none)
    assert E.count_edited(docs, PATH, PATTERN).count() == 0
    same = E.count_edited(E.attach_edits(edge_docs(spark), none), PATH, PATTERN)
    assert same.where(F.col("counts.n_tokens") != F.col("counts.n_edited_tokens")).count() == 0


def test_vocabulary_is_a_parameter():
    assert public_tokenizers.path("byte_bpe_50k.tiktoken") == PATH


def test_stored_trees_are_edited_again(spark, tmp_path):
    """A table of trees, read back: later edits encode only what they touch, and counts stay those of the text."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["some", "words", "here", "日本"]) for _ in range(n)) for n in (0, 1, 3000, 40_000)] + [None, "x" * 9000]
    docs = spark.createDataFrame([(i, t, [(1, 50, 4, "new ")]) for i, t in enumerate(texts)],
                                 f"doc_id long, text string, edits {E.EDITS}")
    E.token_trees(docs, PATH, PATTERN).select("doc_id", "tree").write.parquet(f"{tmp_path}/0")
    now = {i: t or "" for i, t in enumerate(texts)}
    for k in range(3):
        edits = {i: (rng.randrange(len(t) + 1), rng.randrange(30), text_of(rng, 6)) for i, t in now.items()}
        table = spark.createDataFrame([(i, 1, *e) for i, e in edits.items()],
                                      "doc_id long, seq long, start long, length long, replacement string")
        trees = E.attach_edits(spark.read.parquet(f"{tmp_path}/{k}"), table)
        E.apply_edits(trees, PATH, PATTERN).select("doc_id", "edited.*").write.parquet(f"{tmp_path}/{k + 1}")
        for r in spark.read.parquet(f"{tmp_path}/{k + 1}").collect():
            before, now[r.doc_id] = now[r.doc_id], apply(now[r.doc_id], *edits[r.doc_id])
            assert "".join(s.text for s in r.tree) == now[r.doc_id] and r.n_edited_chars == len(now[r.doc_id])
            assert r.n_tokens == len(LIBRARY.encode_ordinary(before))
            assert r.n_edited_tokens == sum(s.n_tokens for s in r.tree) == len(LIBRARY.encode_ordinary(now[r.doc_id]))
            if r.doc_id == 3:
                assert r.n_reencoded < 4 * E.SEGMENT_CHARS < len(before) / 20


def test_kept_trees_encode_nothing():
    class Refuses:
        def encode(self, text):
            raise AssertionError("nothing is to be encoded")

    tree = E.EditTree("some words " * 500, WHOLE)
    stored = [{"text": t, "n_tokens": n} for t, n in tree.stored()]
    again = E.EditTree.kept(stored, Refuses())
    assert (again.text, again.n_tokens, again.stored()) == (tree.text, tree.n_tokens, tree.stored())
    assert E.EditTree.kept(None, Refuses()).n_tokens == 0
