"""Edit-aware token counts: a segment tree over each document, re-encoded only where it is edited.

A document is cut into segments of about ``SEGMENT_CHARS`` at spaces between two characters that
aren't white space; tokens on one side of such a cut don't depend on the other (see ``bpe``). A
segment tree sums characters and tokens. An edit finds the segments it touches by descending the
character sums, adds a neighbour where the edit touches the characters that make the border a cut,
re-encodes that region alone and updates the sums above it. Edits of a document are applied in
order; positions are code points of the text as the earlier edits left it.

The tree is kept: ``token_trees`` encodes texts once and returns their segments with their token counts as a
column, ``apply_edits`` takes such a column with edits and returns the trees as edited, encoding no other segment than
those touched, so a table of trees can be stored and edited again and again.

Documents stay in their row with their edits (``attach_edits`` joins a table of edits by id); there
is no other shuffle, and memory is that of one text. A text without a possible cut is one segment.

Defined results: a null text is empty; null or no edits leave the text; a null replacement is
empty, null start or length count as 0; positions beyond the text are its end, negative ones its
start; edits with equal numbers are applied in order of start, length and replacement; repeated
rows are counted each; an empty table gives an empty table, and a null or empty tree is an empty text's. A column of the input named like the output column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import _CUT, Encoder, _shared, read_ranks
from .common import struct_array, with_fresh

SEGMENT_CHARS = 1024
#: A segment that edits have made this many times larger is cut again.
GROWN = 8

EDITS = "array<struct<seq:bigint,start:bigint,length:bigint,replacement:string>>"
TREE = "array<struct<text:string,n_tokens:int>>"
RESULT = f"struct<tree:{TREE},n_tokens:bigint,n_edited_tokens:bigint,n_edited_chars:bigint,n_reencoded:bigint>"
_SEGMENT = pa.struct([("text", pa.string()), ("n_tokens", pa.int32())])


def segments(text: str, size: int) -> list[str]:
    """The text cut at the first possible place after each ``size`` characters; later segments begin
    with the space of their cut."""
    out, at = [], 0
    while (cut := _CUT.search(text, at + size)) is not None:
        out.append(text[at:cut.start()])
        at = cut.start()
    out.append(text[at:])
    return out


class EditTree:
    """Segments in slots 0..n-1 of a binary tree whose nodes sum (characters, tokens)."""

    def __init__(self, text: str, encoder: Encoder, size: int = SEGMENT_CHARS) -> None:
        self.encoder, self.size, self.reencoded = encoder, size, 0
        parts = segments(text, size)
        self._build(parts, [self._count(p) for p in parts])

    @classmethod
    def kept(cls, stored: list[dict] | None, encoder: Encoder, size: int = SEGMENT_CHARS) -> EditTree:
        """The tree of stored segments; nothing is encoded. Null or no segments: an empty text's tree."""
        tree = cls.__new__(cls)
        tree.encoder, tree.size, tree.reencoded = encoder, size, 0
        stored = stored or [{"text": "", "n_tokens": 0}]
        tree._build([s["text"] for s in stored], [s["n_tokens"] for s in stored])
        return tree

    def stored(self) -> list[tuple[str, int]]:
        """The segments that hold text, with their tokens (one empty segment for an empty text)."""
        held = [(p, self.tokens[self.width + i]) for i, p in enumerate(self.parts) if p]
        return held or [("", 0)]

    def _count(self, text: str) -> int:
        return len(self.encoder.encode(text)) // 4

    def _build(self, parts: list[str], tokens: list[int]) -> None:
        self.parts = parts
        self.width = 1 << max(len(parts) - 1, 0).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (part, n) in enumerate(zip(parts, tokens, strict=True)):
            self.chars[self.width + i], self.tokens[self.width + i] = len(part), n
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _set(self, slot: int, text: str, tokens: int) -> None:
        self.parts[slot] = text
        i = self.width + slot
        self.chars[i], self.tokens[i] = len(text), tokens
        while i := i // 2:
            self._sum(i)

    def _find(self, at: int) -> tuple[int, int]:
        """The slot that holds position ``at`` (the last used one at the end), and the position within it."""
        i = 1
        while i < self.width:
            i *= 2
            if at >= self.chars[i] and self.chars[i + 1]:
                at -= self.chars[i]
                i += 1
        return i - self.width, at

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.parts)

    def _near(self, slot: int, step: int) -> int | None:
        slot += step
        while 0 <= slot < len(self.parts):
            if self.parts[slot]:
                return slot
            slot += step
        return None

    def edit(self, start: int, length: int, replacement: str) -> None:
        total = self.chars[1]
        start = min(max(start, 0), total)
        length = min(max(length, 0), total - start)
        first, offset = self._find(start)
        last, _ = self._find(max(start, start + length - 1))
        before = start - offset
        # the cut at a border is made by the character before it, its space and the one after
        if offset <= 2 and (near := self._near(first, -1)) is not None:
            first, before = near, before - len(self.parts[near])
        end = before + sum(len(self.parts[k]) for k in range(first, last + 1))
        while end - (start + length) <= 2 and (near := self._near(last, 1)) is not None:
            last, end = near, end + len(self.parts[near])
        region = "".join(self.parts[first:last + 1])
        region = region[:start - before] + replacement + region[start + length - before:]
        # an edit may leave a border that is none: the region then takes in its neighbours
        while (near := self._near(first, -1)) is not None and not self._borders(self.parts[near], region):
            region, first = self.parts[near] + region, near
        while (near := self._near(last, 1)) is not None and not self._borders(region, self.parts[near]):
            region, last = region + self.parts[near], near
        for slot in range(first + 1, last + 1):
            if self.parts[slot]:
                self._set(slot, "", 0)
        self.reencoded += len(region)
        self._set(first, region, self._count(region) if region else 0)
        if len(region) > GROWN * self.size:
            self._recut(first)

    @staticmethod
    def _borders(left: str, right: str) -> bool:
        return len(right) > 1 and right[0] == " " and not right[1].isspace() and left != "" and not left[-1].isspace()

    def _recut(self, slot: int) -> None:
        """Cuts a grown segment again; the other segments keep their counts."""
        parts, tokens = [], []
        for i, part in enumerate(self.parts):
            more = segments(part, self.size) if i == slot else [part] if part else []
            parts += more
            tokens += [self._count(p) for p in more] if i == slot else [self.tokens[self.width + i]] * len(more)
        self._build(parts or [""], tokens or [0])


def attach_edits(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id", out_col: str = "edits") -> DataFrame:
    """``docs`` with their rows of ``edits`` (id, seq, start, length, replacement) as an array column;
    null where there are none. Edits are gathered per document, which is the unit they apply to."""
    per = edits.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_edits_of")).agg(
        F.collect_list(F.struct("seq", "start", "length", "replacement")).cast(EDITS).alias("_edits"))
    joined = docs.drop(*[c for c in docs.columns if c.lower() == out_col.lower()]).join(
        per, F.col(id_col) == F.col("_edits_of"), "left")
    return joined.withColumn(out_col, F.col("_edits")).drop("_edits_of", "_edits")


def _edited(tree: EditTree, changes: list[dict | None] | None) -> tuple[int, int, int, int]:
    """Applies a row's edits in order. Tokens before and after, characters after, characters re-encoded."""
    n = tree.n_tokens
    order = [(e["seq"] is not None, e["seq"] or 0, e["start"] or 0, e["length"] or 0, e["replacement"] or "")
             for e in changes or [] if e is not None]
    for _, _, start, length, replacement in sorted(order):
        tree.edit(start, length, replacement)
    return n, tree.n_tokens, tree.chars[1], tree.reencoded


def _trees(rows: list[list[tuple[str, int]]]) -> pa.ListArray:
    flat = [x for row in rows for x in row]
    kind = pa.StructArray.from_arrays([pa.array([t for t, _ in flat], pa.string()), pa.array([n for _, n in flat], pa.int32())],
                                      fields=list(_SEGMENT))
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), kind)


def token_trees(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out_col: str = "tree",
                size: int = SEGMENT_CHARS) -> DataFrame:
    """``docs`` with each text's segments and their token counts as a column."""
    vocabulary = _shared(docs, path)

    @F.arrow_udf(TREE)
    def build(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(read_ranks(vocabulary.value), pattern)
        for texts in batches:
            yield _trees([EditTree(t.as_py() or "", encoder, size).stored() for t in texts])

    return with_fresh(docs, out_col, build(F.col(text_col)))


def apply_edits(docs: DataFrame, path: str, pattern: str, tree_col: str = "tree", edits_col: str = "edits",
                out_col: str = "edited", size: int = SEGMENT_CHARS) -> DataFrame:
    """``docs`` with a struct column: the tree after the edits, tokens before and after them, characters after
    them, and characters re-encoded for them."""
    vocabulary = _shared(docs, path)

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        encoder = Encoder(read_ranks(vocabulary.value), pattern)
        for trees, edits in batches:
            rows, stored = [], []
            for kept, changes in zip(trees, edits, strict=True):
                tree = EditTree.kept(kept.as_py(), encoder, size)
                rows.append(_edited(tree, changes.as_py()))
                stored.append(tree.stored())
            counts = zip(*rows, strict=True) if rows else ((),) * 4
            yield struct_array({"tree": _trees(stored)} | dict(zip(
                ("n_tokens", "n_edited_tokens", "n_edited_chars", "n_reencoded"),
                [pa.array(np.array(x, np.int64)) for x in counts], strict=True)))

    return with_fresh(docs, out_col, run(F.col(tree_col).cast(TREE), F.col(edits_col).cast(EDITS)))


def tree_text(tree: Column) -> Column:
    """The text of a tree."""
    return F.array_join(F.transform(tree, lambda s: s["text"]), "")


def count_edited(docs: DataFrame, path: str, pattern: str, text_col: str = "text", edits_col: str = "edits",
                 out_col: str = "counts", size: int = SEGMENT_CHARS) -> DataFrame:
    """``docs`` with a struct column: tokens before and after the edits, characters after them, characters
    re-encoded for the edits, and the edited text. For trees that aren't kept: each is built and edited in one worker, so
    it doesn't travel to a second one."""
    vocabulary = _shared(docs, path)

    @F.arrow_udf("struct<n_tokens:bigint,n_edited_tokens:bigint,n_edited_chars:bigint,n_reencoded:bigint,text:string>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        encoder = Encoder(read_ranks(vocabulary.value), pattern)
        for texts, edits in batches:
            rows, out = [], []
            for text, changes in zip(texts, edits, strict=True):
                tree = EditTree(text.as_py() or "", encoder, size)
                rows.append(_edited(tree, changes.as_py()))
                out.append(tree.text)
            counts = zip(*rows, strict=True) if rows else ((),) * 4
            yield struct_array(dict(zip(("n_tokens", "n_edited_tokens", "n_edited_chars", "n_reencoded"),
                                        [pa.array(np.array(x, np.int64)) for x in counts], strict=True)) | {
                "text": pa.array(out, pa.string())})

    return with_fresh(docs, out_col, run(F.col(text_col), F.col(edits_col).cast(EDITS)))
