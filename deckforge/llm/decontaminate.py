"""Benchmark decontamination: suffix arrays of the training texts, searched for every test suffix.

The training texts of a task are cut into shards of whole texts. A shard's suffix array holds the
positions of all words that some test item uses (a suffix that starts with another word matches nothing),
sorted by doubling the compared length up to the longest item. Every test suffix is binary-searched in
it: first its window (``WINDOW_WORDS`` words, or all of a shorter item), whose range holds every
verbatim occurrence; then, within that range, its longest match and where it is. Words inside an occurrence are
hit, and a document with a hit is affected.

Texts stay in their rows and shards in their task: nothing is shuffled. Test items are cut into blocks of
about ``TEST_BYTES``; each block is sent to the tasks and searched in every shard, so neither a task nor the driver
ever holds more of the benchmark than one block. A shard's memory is that of ``SHARD_BYTES`` of text, or of one
longer text.

Defined results: a null text or one without words has no words and no hits; a test item without words
matches nothing; test rows that share an item_id are one item, and a null item_id makes words hit
but names no item; rows of ``docs`` are judged one by one, so repeated rows and null ids need no rule; a column
named like the output column is replaced; without documents or items nothing is affected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import blocks, concat, fresh_name, struct_array, utf8, with_fresh

WINDOW_WORDS = 10
SHARD_BYTES = 8 << 20
TEST_BYTES = 16 << 20
#: Blocks searched in one pass over the texts.
CHAINED = 4

RESULT = ("struct<n_words:bigint,n_hit:bigint,spans:array<struct<start:int,end:int>>,items:array<string>,"
          "longest:array<struct<item:string,item_start:int,start:int,words:int>>>")
_END, _PAD = np.zeros(1, np.int64), np.zeros(64, np.int64)
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_LONGEST = pa.struct([("item", pa.string()), ("item_start", pa.int32()), ("start", pa.int32()), ("words", pa.int32())])

# Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z: digits, letters a-z, all beyond ASCII.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers lo[k] .. hi[k] - 1 of all k one after the other, and the k of each."""
    n = hi - lo
    k = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - lo, n), k


class Packing:
    """Runs of words as one number each, so that numbers sort as the runs do. Word 0 ends texts and stands for all
    words that no item has."""

    def __init__(self, n_words: int):
        self.bits = max(1, int(n_words).bit_length())
        self.per = 62 // self.bits

    def pack(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The ``per`` words from each position on (``ids`` ends with enough zeros)."""
        key = ids[at]
        for k in range(1, self.per):
            key = key << self.bits | ids[at + k]
        return key

    def clip(self, key: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least key that begins with the first ``words`` words of key, and the least beyond all of these."""
        drop = self.bits * (self.per - words)
        low = key >> drop << drop
        return low, low + (np.int64(1) << drop)

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words two keys share at their beginning."""
        x, n = a ^ b, np.zeros(len(a), np.int64)
        for k in range(1, self.per + 1):
            n += (x >> self.bits * (self.per - k)) == 0
        return n


def suffix_array(ids: np.ndarray, packing: Packing, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of words other than 0, sorted by the words from there on (``depth`` of them at least, or up to
    the first 0), and the packed first words of each."""
    at = np.flatnonzero(ids)
    keys = packing.pack(ids, at)
    order = np.argsort(keys, kind="stable")
    at, keys = at[order], keys[order]
    n, width = len(at), packing.per
    if not n or width >= depth:
        return at, keys
    new = np.ones(n, bool)
    new[1:] = keys[1:] != keys[:-1]
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    # words up to the next 0: a group whose shared words end there can't be told apart, nor need it be
    zeros = np.append(np.flatnonzero(ids == 0), len(ids))
    room = zeros[np.searchsorted(zeros, at)] - at
    rank = np.zeros(len(ids) + 1, np.int64)
    open_ = np.arange(n)
    while width < depth:
        rank[at] = group + 1
        same = np.zeros(len(open_) + 1, bool)
        same[1:-1] = group[open_[1:]] == group[open_[:-1]]
        open_ = open_[(same[1:] | same[:-1]) & (room[open_] >= width)]
        if not len(open_):
            break
        follow = rank[np.minimum(at[open_] + width, len(ids))]
        order = np.lexsort((follow, group[open_]))
        places, follow, old = open_, follow[order], group[open_]  # groups are runs of places
        at[places], room[places] = at[open_[order]], room[open_[order]]
        head = np.ones(len(places), bool)
        head[1:] = (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])
        group[places] = np.maximum.accumulate(np.where(head, places, 0))
        width *= 2
    return at, keys


@dataclass
class ItemSuffixes:
    """One block of the benchmark, ready for the search."""

    items: list[str]
    vocabulary: dict[bytes, int]
    ids: np.ndarray  # words of all items one after the other, each item closed by a 0
    at: np.ndarray  # suffixes that a whole window fits into
    width: np.ndarray  # words of that window
    room: np.ndarray  # words up to the item's end
    start: np.ndarray  # word of the item
    item: np.ndarray  # -1: no id
    window: np.ndarray  # number of the window among different ones
    of_window: np.ndarray  # one suffix of each window
    windows: np.ndarray  # the windows of each item (without repeats), by window ...
    window_items: np.ndarray  # ... and the item

    @classmethod
    def build(cls, rows: list[tuple[str | None, bytes]], window_words: int) -> ItemSuffixes:
        names = sorted({i for i, _ in rows if i is not None})
        number = {name: k for k, name in enumerate(names)}
        vocabulary: dict[bytes, int] = {}
        ids, parts = [], []
        for item, text in rows:
            words = words_of(text)
            if words:
                width = min(window_words, len(words))
                start = np.arange(len(words) - width + 1)
                parts.append((start + len(ids), np.full(len(start), width), len(words) - start, start,
                              np.full(len(start), number.get(item, -1))))
                ids += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words] + [0]
        at, width, room, start, item = (np.concatenate(c).astype(np.int64) for c in zip(*parts)) if parts else (
            np.zeros(0, np.int64),) * 5
        all_ids = np.append(np.array(ids, np.int64), np.zeros(64 + window_words, np.int64))
        grams = all_ids[at[:, None] + np.arange(window_words)]
        grams = np.where(np.arange(window_words) < width[:, None], grams, -1)
        _, first, window = np.unique(grams, axis=0, return_index=True, return_inverse=True)
        window, named = window.reshape(-1), item >= 0
        pairs = np.unique(np.stack([window[named], item[named]]), axis=1)
        return cls(names, vocabulary, all_ids, at, width, room, start, item, window, first, pairs[0], pairs[1])


def _bound(sa: np.ndarray, ids: np.ndarray, packing: Packing, lo: np.ndarray, hi: np.ndarray, skip: np.ndarray,
           want: np.ndarray) -> np.ndarray:
    """In each range lo .. hi of suffixes that share their first ``skip`` words: the first one whose next words
    are ``want`` or more."""
    lo, hi = lo.copy(), hi.copy()
    while len(on := np.flatnonzero(lo < hi)):
        mid = (lo[on] + hi[on]) >> 1
        less = packing.pack(ids, sa[mid] + skip[on]) < want[on]
        lo[on[less]] = mid[less] + 1
        hi[on[~less]] = mid[~less]
    return lo


def _ranges(sa: np.ndarray, keys: np.ndarray, ids: np.ndarray, packing: Packing, tests: ItemSuffixes,
            which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the suffixes that begin with each test suffix's window are in the suffix array."""
    at, width = tests.at[which], tests.width[which]
    low, high = packing.clip(packing.pack(tests.ids, at), np.minimum(width, packing.per))
    lo, hi = np.searchsorted(keys, low), np.searchsorted(keys, high)
    done = packing.per
    while len(left := np.flatnonzero((lo < hi) & (width > done))):
        skip = np.full(len(left), done)
        low, high = packing.clip(packing.pack(tests.ids, at[left] + done), np.minimum(width[left] - done, packing.per))
        first = _bound(sa, ids, packing, lo[left], hi[left], skip, low)
        hi[left] = _bound(sa, ids, packing, first, hi[left], skip, high)
        lo[left] = first
        done += packing.per
    return lo, hi


def _longest(sa: np.ndarray, ids: np.ndarray, packing: Packing, tests: ItemSuffixes, which: np.ndarray,
             lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each test suffix with occurrences of its window (lo .. hi): words of its longest match, and its position."""
    lo, hi, length = lo.copy(), hi.copy(), tests.width[which].copy()
    where = sa[lo].copy()
    left = np.flatnonzero(length < tests.room[which])
    while len(left):
        take = np.minimum(tests.room[which[left]] - length[left], packing.per)
        key = packing.pack(tests.ids, tests.at[which[left]] + length[left])
        low, high = packing.clip(key, take)
        first = _bound(sa, ids, packing, lo[left], hi[left], length[left], low)
        last = _bound(sa, ids, packing, first, hi[left], length[left], high)
        on = first < last
        more = left[on]
        length[more] += take[on]
        where[more], lo[more], hi[more] = sa[first[on]], first[on], last[on]
        ends = left[~on]  # the better neighbour of the place where the suffix would be
        if len(ends):
            low, take, first = low[~on], take[~on], first[~on]

            def shared(near: np.ndarray, inside: np.ndarray) -> np.ndarray:
                n = np.zeros(len(ends), np.int64)
                ahead = packing.pack(ids, sa[near[inside]] + length[ends[inside]])
                n[inside] = np.minimum(packing.shared(ahead, low[inside]), take[inside])
                return n

            before, after = shared(first - 1, first > lo[ends]), shared(first, first < hi[ends])
            best, near = np.maximum(before, after), np.where(before >= after, first - 1, first)
            where[ends[best > 0]] = sa[near[best > 0]]
            length[ends] += best
        left = more[length[more] < tests.room[which[more]]]
    return length, where


def _search(texts: list[bytes | None], tests: ItemSuffixes, earlier: list[dict]) -> pa.StructArray:
    """The result of one shard; earlier: what other blocks of the benchmark found in these texts, if any."""
    get, parts, counts = tests.vocabulary.get, [], []
    for text in texts:
        words = words_of(text or b"")
        counts.append(len(words))
        parts += (np.fromiter(map(get, words, repeat(0)), np.int64, len(words)), _END)
    counts, ids = np.array(counts, np.int64), np.concatenate([*parts, _PAD])
    begin = np.cumsum(counts + 1) - counts - 1
    packing = Packing(len(tests.vocabulary))
    sa, keys = suffix_array(ids, packing, int(tests.room.max(initial=0)))
    lo, hi = _ranges(sa, keys, ids, packing, tests, tests.of_window)
    place, window = _spread(lo, hi)
    at = sa[place]
    owner = np.searchsorted(begin, at, "right") - 1
    end = at + tests.width[tests.of_window[window]]
    for d, e in enumerate(earlier):
        at = np.append(at, [begin[d] + s["start"] for s in e["spans"]]).astype(np.int64)
        end = np.append(end, [begin[d] + s["end"] for s in e["spans"]]).astype(np.int64)
    size = len(ids) + 1
    hit = np.cumsum(np.bincount(at, minlength=size) - np.bincount(end, minlength=size)) > 0
    before = np.concatenate(([0], np.cumsum(hit)))
    edge = np.diff(np.concatenate(([0], hit.astype(np.int8))))
    opens, closes = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(begin, opens, "right") - 1
    spans = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(texts))))), pa.int32()),
        pa.StructArray.from_arrays([pa.array(opens - begin[doc], pa.int32()), pa.array(closes - begin[doc], pa.int32())],
                                   fields=list(_SPAN)))
    # the items of the windows that a text has
    items = [set(e["items"]) for e in earlier] or [set() for _ in texts]
    pairs = np.unique(owner * max(1, len(lo)) + window)
    owner, window = np.divmod(pairs, max(1, len(lo)))
    first, last = np.searchsorted(tests.windows, window), np.searchsorted(tests.windows, window, "right")
    place, pair = _spread(first, last)
    for d, i in zip(owner[pair].tolist(), tests.window_items[place].tolist()):
        items[d].add(tests.items[i])
    # each item's longest match in the shard, at the text that has it
    longest = [list(e["longest"]) for e in earlier] or [[] for _ in texts]
    which = np.flatnonzero((lo < hi)[tests.window] & (tests.item >= 0))
    length, where = _longest(sa, ids, packing, tests, which, lo[tests.window[which]], hi[tests.window[which]])
    order = np.lexsort((tests.start[which], -length, tests.item[which]))
    _, best = np.unique(tests.item[which][order], return_index=True)
    for k in order[best].tolist():
        d = int(np.searchsorted(begin, where[k], "right")) - 1
        longest[d].append({"item": tests.items[tests.item[which[k]]], "item_start": int(tests.start[which[k]]),
                           "start": int(where[k] - begin[d]), "words": int(length[k])})
    return struct_array({
        "n_words": pa.array(counts), "n_hit": pa.array(before[begin + counts] - before[begin]), "spans": spans,
        "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
        "longest": pa.array(longest, pa.list_(_LONGEST))})


def _item_blocks(benchmark: DataFrame, max_bytes: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The benchmark's different rows in blocks of about ``max_bytes`` of text, one at a time."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), utf8("text").alias("text")).where(
        F.col("text").isNotNull()).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // max_bytes))
    for b in range(n):
        yield [(r.item, bytes(r.text)) for r in rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).collect()]


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", out_col: str = "benchmark",
         window_words: int = WINDOW_WORDS, shard_bytes: int = SHARD_BYTES, test_bytes: int = TEST_BYTES) -> DataFrame:
    """``docs`` with a struct column: words of the text, words hit, the hit spans (word positions), the
    item_ids (as strings, sorted) with an occurring window, and the longest match of those items whose longest
    match within a shard is in this text. benchmark: ``item_id``, ``text``."""
    out = docs
    for number, rows in enumerate(_item_blocks(benchmark, test_bytes)):
        sent = docs.sparkSession.sparkContext.broadcast(vars(ItemSuffixes.build(rows, window_words)))

        def search(batches: Iterator, sent=sent) -> Iterator[pa.Array]:
            tests = ItemSuffixes(**sent.value)
            for batch in batches:
                texts, found = batch if isinstance(batch, tuple) else (batch, None)
                done, parts = 0, []
                for run in blocks(texts, shard_bytes):
                    earlier = found.slice(done, len(run)).to_pylist() if found is not None else []
                    parts.append(_search(run, tests, earlier))
                    done += len(run)
                yield concat(parts, pa.struct([]))

        if number:
            if number % CHAINED == 0:  # a chain of many searches is too long a plan
                out = materialize(out, "benchmark-blocks")
            out = out.withColumn(out_col, F.arrow_udf(_kind(search, 2), RESULT)(utf8(text_col), F.col(out_col)))
        else:
            out = with_fresh(out, out_col, F.arrow_udf(_kind(search, 1), RESULT)(utf8(text_col)))
    return out


def _kind(search, n: int):
    """The function with the type hints that tell Spark how its columns come."""
    if n == 1:
        def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            yield from search(batches)
        return one

    def two(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        yield from search(batches)
    return two


def contaminated(out_col: str = "benchmark") -> Column:
    return F.col(out_col).n_hit > 0


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a hit."""
    name = fresh_name(docs, "_benchmark")
    return scan(docs, benchmark, out_col=name, **options).where(~contaminated(name)).drop(name)


def longest_matches(scanned: DataFrame, out_col: str = "benchmark", id_col: str = "doc_id") -> DataFrame:
    """Of each item with an occurring window, the longest verbatim match over all shards: ``item``, ``words``,
    ``item_start`` and one place that has it (``id_col``, ``start``). ``scanned``: from ``scan``."""
    each = scanned.select(F.col(id_col), F.inline(F.col(out_col).longest))
    best = each.groupBy("item").agg(F.max_by(F.struct("words", "item_start", id_col, "start"), F.struct(
        "words", -F.col("item_start"), -F.col(id_col), -F.col("start"))).alias("m"))
    return best.select("item", "m.*")
