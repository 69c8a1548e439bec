"""Byte-level BPE as a tree reduction over a text's halves; decoding joins bytes up the same tree.

A text is split in halves until ``LEAF_CHARS``. A space between two characters that aren't white
space always begins a match of the pattern, whatever else the text holds: matches contain a space
only as their first character or within a run of white space, and no lookahead passes it. At such
a cut, tokens on one side don't depend on the other. A node of the tree is therefore (text before
its first cut, ids between its cuts, text after its last cut), or a text without a cut. Joining
two nodes re-encodes only the window from the left one's last cut to the right one's first, which
grows up the tree until it has cuts on both sides; ids outside the window are final.

A match longer than ``LEAF_BYTES`` is itself encoded in halves. Merges by rank give a sequence in
which every two neighbouring tokens, encoded alone, give themselves again; and any such sequence
of a text's bytes is the one that merging gives. So two halves are joined by re-encoding a window
of tokens around the seam, doubled until both of its edges are such neighbours.

Texts stay in their row, so there is no shuffle. The vocabulary (a file of bounded size, its path a
parameter) is read on the driver and broadcast. Caches of encoded words are emptied at
``CACHE_WORDS`` entries.

Defined results: a null text has no ids, as an empty one; null ids decode to null, as does a list
holding a null or an id outside the vocabulary. Texts of any length are encoded whole, rows one by one,
so repeated rows and null ids need no rule; an empty table gives an empty table. A column of the input
named like the output column is replaced.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_array, struct_array, with_fresh

LEAF_CHARS = 8192
LEAF_BYTES = 48
CACHE_WORDS = 200_000
#: Rows whose ids are held as they are encoded; then they are packed.
ROWS = 500

#: A space where texts can always be cut.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: White space other than the space and the newline.
_RARE = re.compile(r"[^\S \n]")


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """A file of lines "base64 of the token's bytes, its rank"."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines()) if token}


class _Memo(dict):
    """Results of ``make``, emptied when they get too many."""

    def __init__(self, make) -> None:
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[key] = self.make(key)
        return value


class Encoder:
    """Ids are handled as bytes of little-endian 32-bit numbers: joining them is copying."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = LEAF_CHARS,
                 leaf_bytes: int = LEAF_BYTES) -> None:
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.leaf_chars, self.leaf_bytes = leaf_chars, leaf_bytes
        self.leaf = tiktoken.Encoding("leaf", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.after_space = _Memo(lambda word: self.window(" " + word))
        self.neighbours = _Memo(lambda pair: self._merged(pair[0] + pair[1]) == [*pair])

    # one match of the pattern

    def _merged(self, text: bytes) -> list[bytes]:
        """Merging the adjacent pair of the lowest rank, the first of equals, until no pair has a rank."""
        ranks = self.ranks
        if text in ranks:
            return [text]
        end = list(range(1, len(text) + 1))  # where the part that starts here ends; 0: no part starts here
        before = list(range(-1, len(text) - 1))
        waiting = [(r, i, i + 2) for i in range(len(text) - 1) if (r := ranks.get(text[i:i + 2])) is not None]
        heapify(waiting)
        while waiting:
            _, i, to = heappop(waiting)
            mid = end[i]
            if not mid or mid >= len(text) or end[mid] != to:
                continue  # one of its parts has been merged since
            end[i], end[mid] = to, 0
            if to < len(text):
                before[to] = i
                if (r := ranks.get(text[i:end[to]])) is not None:
                    heappush(waiting, (r, i, end[to]))
            if (p := before[i]) >= 0 and (r := ranks.get(text[p:to])) is not None:
                heappush(waiting, (r, p, to))
        return [text[i:e] for i, e in enumerate(end) if e]

    def _halves(self, text: bytes) -> list[bytes]:
        if len(text) <= self.leaf_bytes:
            return self._merged(text)
        mid = len(text) // 2
        return self._seam(self._halves(text[:mid]), self._halves(text[mid:]))

    def _seam(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        if self.neighbours[left[-1], right[0]]:
            return left + right
        k = 2
        while True:
            inside = self._merged(b"".join(left[-k:] + right[:k]))
            before, after = left[:-k], right[k:]
            if (not before or self.neighbours[before[-1], inside[0]]) and (
                    not after or self.neighbours[inside[-1], after[0]]):
                return before + inside + after
            k *= 2

    def _piece(self, piece: str) -> bytes:
        return np.array([self.ranks[t] for t in self._halves(piece.encode())], "<i4").tobytes()

    # texts

    def window(self, text: str) -> bytes:
        """Ids of a text between two cuts. Those of ordinary length are leaves, which the vocabulary's
        library encodes; longer ones are matched here, and long matches go through the tree."""
        if len(text) <= self.leaf_bytes:
            return np.array(self.leaf(text), "<i4").tobytes()
        return b"".join([np.array(self.leaf(p), "<i4").tobytes() if len(p) <= self.leaf_bytes else self._piece(p)
                         for p in self.find(text)])

    def _cut(self, text: str) -> list[str]:
        """The text's parts between its cuts; all but the first are without their first space."""
        if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or _RARE.search(text):
            return _CUT.split(text)
        return text.split(" ")

    def _node(self, text: str) -> tuple[str, bytes | None, str]:
        """(head, ids, tail); ids is None for a text without a cut, which is then the head."""
        if len(text) > self.leaf_chars:
            mid = len(text) // 2
            return self._join(self._node(text[:mid]), self._node(text[mid:]))
        parts = self._cut(text)
        if len(parts) == 1:
            return text, None, ""
        return parts[0], b"".join(map(self.after_space.__getitem__, parts[1:-1])), " " + parts[-1]

    def _between(self, text: str) -> tuple[str, bytes | None]:
        """A window's part before its first cut, and the ids after it (None without a cut)."""
        first, *rest = self._cut(text)
        return first, b"".join(map(self.after_space.__getitem__, rest)) if rest else None

    def _join(self, left: tuple[str, bytes | None, str], right: tuple[str, bytes | None, str]
              ) -> tuple[str, bytes | None, str]:
        head, ids, tail = left
        if ids is None and right[1] is None:
            parts = self._cut(head + right[0])
            if len(parts) == 1:
                return head + right[0], None, ""
            return parts[0], b"".join(map(self.after_space.__getitem__, parts[1:-1])), " " + parts[-1]
        if ids is None:
            head, more = self._between(head + right[0])
            return head, (more or b"") + right[1], right[2]
        if right[1] is None:
            parts = self._cut(tail[1:] + right[0])  # the tail's own space is a cut
            return head, ids + b"".join(map(self.after_space.__getitem__, parts[:-1])), " " + parts[-1]
        middle = self._cut(tail[1:] + right[0])
        return head, ids + b"".join(map(self.after_space.__getitem__, middle)) + right[1], right[2]

    def encode(self, text: str) -> bytes:
        head, ids, tail = self._node(text)
        return self.window(head) + (ids or b"") + self.window(tail)


class Decoder:
    def __init__(self, ranks: dict[bytes, int], leaf_ids: int = LEAF_CHARS) -> None:
        self.token = {rank: token for token, rank in ranks.items()}
        self.leaf_ids = leaf_ids

    def decode(self, ids: list[int]) -> bytes | None:
        if len(ids) <= self.leaf_ids:
            try:
                return b"".join(map(self.token.__getitem__, ids))
            except KeyError:
                return None
        mid = len(ids) // 2
        left, right = self.decode(ids[:mid]), self.decode(ids[mid:])
        return None if left is None or right is None else left + right


def _shared(docs: DataFrame, path: str):
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out_col: str = "ids",
           leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``docs`` with the text's ids, array<int>. path: a local file of ranks that the driver reads."""
    vocabulary = _shared(docs, path)

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(read_ranks(vocabulary.value), pattern, leaf_chars)
        for batch in batches:
            for at in range(0, len(batch), ROWS):  # results leave in parts, so a batch's aren't held at once
                rows = [encoder.encode(t.as_py() or "") for t in batch[at:at + ROWS]]
                yield list_array(np.frombuffer(b"".join(rows), "<i4"), np.fromiter(map(len, rows), np.int64) // 4,
                                 pa.int32())

    return with_fresh(docs, out_col, run(F.col(text_col)))


def encode_and_decode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out_col: str = "bpe",
                      leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``docs`` with a struct column: the text's ids and the bytes they decode to, in one worker for
    each task, so the ids don't travel to a second one."""
    vocabulary = _shared(docs, path)

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks = read_ranks(vocabulary.value)
        encoder, decoder = Encoder(ranks, pattern, leaf_chars), Decoder(ranks, leaf_chars)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                rows = [encoder.encode(t.as_py() or "") for t in batch[at:at + ROWS]]
                ids = list_array(np.frombuffer(b"".join(rows), "<i4"), np.fromiter(map(len, rows), np.int64) // 4,
                                 pa.int32())
                back = [decoder.decode(np.frombuffer(r, "<i4").tolist()) for r in rows]
                yield struct_array({"ids": ids, "decoded": pa.array(back, pa.binary())})
            pa.default_memory_pool().release_unused()  # also what earlier work of this process has left

    return with_fresh(docs, out_col, run(F.col(text_col)))


def decode(docs: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded",
           leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``docs`` with the bytes that the ids stand for."""
    vocabulary = _shared(docs, path)

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(read_ranks(vocabulary.value), leaf_chars)
        for batch in batches:
            yield pa.array([None if ids is None else decoder.decode(ids.tolist()) for ids in (
                None if not x.is_valid else x.values.to_numpy(zero_copy_only=False) for x in batch)], pa.binary())

    return with_fresh(docs, out_col, run(F.col(ids_col)))
