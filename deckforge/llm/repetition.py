"""Quality rules: repeated word sequences of a text by suffix array and longest common prefixes.

The suffixes of every text that share their first three words with another suffix of the same
text are sorted by doubling the compared length (3, 6, 12, ... words), many texts at once; the
groups of equal windows of each length are kept and give the longest common prefix (LCP) of
neighbouring suffixes. The deepest LCP interval around a suffix is its longest repeat. Every
repeated substring lies within one of these, so the union of their spans is the union of the
spans of all maximal repeats. A text is rejected if repeats of ``min_repeat`` words or more
cover too much of it or if one repeat is too long.

Texts stay in their row: there is no shuffle, and the working memory is that of one block of
texts (or of one very long text).

Defined results: a null text is an empty text (all counts 0, base rules failed, not kept);
rows are judged one by one, so ties, repeated rows and null ids need no rule; a column of the
input named like the output column is replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, CONTINUATION, blocks, concat, struct_array, utf8, with_fresh

#: Repeats of fewer words don't count as repetition.
MIN_REPEAT = 15
#: A text is rejected if repeats cover more than this share of its words ...
MAX_COVERED_PERCENT = 20
#: ... or if one repeat is longer than this many words.
MAX_REPEAT = 100
SYMBOLS = b"#*$%&|<>"
BLOCK_BYTES = 1 << 20

RESULT = ("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
          "covered_words:bigint,longest_repeat:bigint,spans:array<struct<start:int,end:int>>>")
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _sorted_groups(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the pairs (high, low), and for each place the place where its run of equal pairs starts."""
    order = np.lexsort((low, high))
    h, lo = high[order], low[order]
    new = np.ones(len(order), bool)
    new[1:] = (h[1:] != h[:-1]) | (lo[1:] != lo[:-1])
    return order, np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))


def _tied(start: np.ndarray) -> np.ndarray:
    """Which places belong to a run of two or more."""
    same = np.zeros(len(start) + 1, bool)
    same[1:-1] = start[1:] == start[:-1]
    return same[1:] | same[:-1]


def suffix_ranks(words: np.ndarray, last: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sorts the suffixes of many texts by doubling.

    words: the texts' word numbers one after the other; last: for each position the end of its
    text (so it also tells texts apart). Level k ranks positions by text and their next 3 * 2**k
    words; equal windows have equal ranks. A suffix that ends sooner sorts first and is never
    tied. Returned: the levels, the positions tied at level 0, and those in suffix order."""
    n = len(words)
    where = np.arange(n)
    pad = np.full(2, -1)

    def ahead(k: int) -> np.ndarray:
        return np.where(where + k < last, np.append(words, pad)[k:n + k], -1) + 1

    base = int(words.max(initial=0)) + 2
    order, start = _sorted_groups(last * base + ahead(0), ahead(1) * base + ahead(2))
    rank = np.empty(n, np.int32)
    rank[order] = start
    tied = order[_tied(start)]
    first, levels, width = tied, [rank], 3
    while len(tied):
        old = levels[-1]
        rank = old.copy()
        at = tied + width
        follow = np.where(at < last[tied], old[np.minimum(at, n - 1)], -1)
        order, start = _sorted_groups(old[tied], follow)
        tied = tied[order]
        # a run's rank: that of the group it was part of, plus its place in that group
        group = old[tied]
        opens = np.ones(len(group), bool)
        opens[1:] = group[1:] != group[:-1]
        head = np.maximum.accumulate(np.where(opens, np.arange(len(group)), 0))
        rank[tied] = group + start - head
        tied = tied[_tied(start)]
        levels.append(rank)
        width *= 2
    return levels, first, first[np.argsort(levels[-1][first])]


def common_prefixes(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, words: np.ndarray,
                    last: np.ndarray) -> np.ndarray:
    """How many words the suffixes at a and b (of one text) share at their beginning."""
    lcp = np.zeros(len(a), np.int64)
    end = len(words) - 1
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        inside = (x < last[a]) & (y < last[b])
        lcp += (inside & (levels[k][np.minimum(x, end)] == levels[k][np.minimum(y, end)])) * (3 << k)
    going = np.ones(len(a), bool)
    for _ in range(2):  # fewer than three words are left
        x, y = a + lcp, b + lcp
        going &= (x < last[a]) & (y < last[b])
        going &= words[np.minimum(x, end)] == words[np.minimum(y, end)]
        lcp += going
    return lcp


def _block(texts: list[bytes | None], min_repeat: int) -> pa.StructArray:
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    flat: list[int] = []
    n_words = np.zeros(len(texts), np.int64)
    chars, symbols, lines = (np.zeros(len(texts), np.int64) for _ in range(3))
    for i, raw in enumerate(texts):
        text = raw or b""
        found = text.split()
        n_words[i] = len(found)
        flat.extend(map(number.__getitem__, found))
        chars[i] = len(text.translate(None, ASCII_SPACE + CONTINUATION))
        symbols[i] = len(text) - len(text.translate(None, SYMBOLS))
        seen: set[bytes] = set()
        for line in text.split(b"\n"):
            if line.strip():
                lines[i] += line in seen
                seen.add(line)
    words = np.array(flat, np.int64)
    ends = np.cumsum(n_words)
    last = np.repeat(ends, n_words)
    owner = np.repeat(np.arange(len(texts)), n_words)
    levels, first, order = suffix_ranks(words, last)
    repeated = np.zeros(len(words) + 3, bool)
    for k in range(3):
        repeated[first + k] = True
    longest_at = np.zeros(len(words), np.int64)  # the depth of the deepest LCP interval of each suffix
    if len(order) > 1:
        a, b = order[:-1], order[1:]
        near = np.flatnonzero(levels[0][a] == levels[0][b])
        a, b = a[near], b[near]
        lcp = common_prefixes(levels, a, b, words, last)
        np.maximum.at(longest_at, a, lcp)
        np.maximum.at(longest_at, b, lcp)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, owner, longest_at)
    # union of the spans: a word is covered if a span that begins at or before it reaches past it
    starts = np.flatnonzero(longest_at >= min_repeat)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + longest_at[starts], -1)
    covered = np.cumsum(change[:-1]) > 0
    opens = covered.copy()
    opens[1:] &= ~covered[:-1] | (owner[1:] != owner[:-1])
    closes = covered.copy()
    closes[:-1] &= ~covered[1:] | (owner[1:] != owner[:-1])
    lo, hi = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    offset = (ends - n_words)[owner[lo]]
    spans = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(np.bincount(owner[lo], minlength=len(texts))))), pa.int32()),
        pa.StructArray.from_arrays([pa.array(lo - offset, pa.int32()), pa.array(hi - offset, pa.int32())],
                                   fields=list(_SPAN)))
    of = lambda mask: np.bincount(owner, weights=mask, minlength=len(texts)).astype(np.int64)
    return struct_array({
        "n_words": pa.array(n_words), "word_chars": pa.array(chars), "n_symbols": pa.array(symbols),
        "n_dup_lines": pa.array(lines), "n_repeat_words": pa.array(of(repeated[:len(words)])),
        "covered_words": pa.array(of(covered)), "longest_repeat": pa.array(longest), "spans": spans})


def repetition(docs: DataFrame, text_col: str = "text", out_col: str = "repetition",
               min_repeat: int = MIN_REPEAT) -> DataFrame:
    """``docs`` with a struct column: the base counts of the text, words covered by repeats of
    ``min_repeat`` (3 at least) words or more, the longest repeat in words, and the covered spans
    as word positions. A repeat of fewer than three words counts as 0 in ``longest_repeat``."""
    if min_repeat < 3:
        raise ValueError("repeats are searched from three words on")

    @F.arrow_udf(RESULT)
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield concat((_block(run, min_repeat) for run in blocks(batch, BLOCK_BYTES)),
                         pa.struct([]))

    return with_fresh(docs, out_col, measure(utf8(text_col)))


def quality_rules(docs: DataFrame, text_col: str = "text", out_col: str = "quality",
                  min_repeat: int = MIN_REPEAT, max_covered_percent: int = MAX_COVERED_PERCENT,
                  max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``repetition`` plus the verdicts: ``base_failed`` (fewer than 50 words, or over half of
    them in repeated three-word windows), ``long_repeat`` (a repeat over ``max_repeat`` words) and
    ``kept`` (neither, and covered words within ``max_covered_percent`` of all)."""
    q = F.col(out_col)
    base = (q.n_words < 50) | (100 * q.n_repeat_words > 50 * q.n_words)
    long = q.longest_repeat > max_repeat
    kept = ~base & ~long & (100 * q.covered_words <= max_covered_percent * q.n_words)
    measured = repetition(docs, text_col, out_col, min_repeat)
    return measured.withColumn(out_col, q.withField("base_failed", base).withField("long_repeat", long)
                               .withField("kept", kept))
