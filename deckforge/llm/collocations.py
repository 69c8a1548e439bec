"""Phrase collocation mining: phrases counted in tries of burstable hash containers.

Each task numbers the words it meets and counts phrases of one length and language in a shallow trie of word
numbers. A container (a hash table) holds the phrases between two borders, at first all of them. One that
outgrows ``BURST`` bursts into two: between two first words while it has several, else between two second
words, and so on, so frequent first words get subtrees of their own and rare ones share a container. When the tries
hold more than ``ENTRIES`` phrases, the largest subtrees leave, each as a run in the order of its keys, until
half is left; the rest goes on counting. Runs are dealt by prefix (language and first two words) and merged there.

Words and pairs are counted in one pass. A longer phrase can only reach ``min_count`` if the phrases without
its first and without its last word do, so later passes count one length each and skip phrases whose
parts aren't in a Bloom filter of the frequent ones. The filter has a fixed size (``FILTER_BITS``) and no
false negatives: where it fills up, more phrases are counted and dropped after the merge, and results stay the same.

Defined results: a null text is an empty text; a null language is ``und``; ASCII letters are lower-cased; a
language without words or without candidates has no rows; equal scores and counts rank by the phrase's bytes;
repeated rows count as often as they occur; an empty table gives an empty table. Only the two named columns are read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import utf8

MAX_WORDS = 3
MIN_COUNT = 10
#: A candidate goes if a longer one around it has at least this share of its occurrences.
COVERED_PERCENT = 50
TOP = 2000
#: Phrases of one container, of all tries of a task, and words a task numbers before it starts anew.
BURST = 1 << 15
ENTRIES = 1 << 19
VOCABULARY = 1 << 19
#: Text that is cut into words at a time.
BLOCK_BYTES = 1 << 20
#: Bits of the filter of frequent phrases (16 MB), and bits set by one phrase.
FILTER_BITS = 1 << 27
_PROBES = 4
#: 64-bit cells of the filter that travel as one row.
_PAGE = 512
#: Each language's phrases are ranked in so many parts first, so the last ranking has ``top`` of each at most.
_RANKED_PARTS = 32

_SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes(32 if b == 9 else 10 if b in _SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_CUT = b"\xff"  # stands for a separator; no UTF-8 text has it
_SPACE = re.compile(rb"[ \n]")
_COUNTS = "lang string, phrase string, n bigint"


class Numbers(dict):
    """Numbers of words in the order they come; 0 is the separator."""

    def __init__(self) -> None:
        super().__init__({_CUT: 0})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class Trie:
    """Counts of phrases of ``length`` words. A phrase's key is its word numbers, ``bits`` each; the borders
    between containers are prefixes of keys, filled up with zeros."""

    def __init__(self, length: int, bits: int, burst: int) -> None:
        self.length, self.bits, self.limit = length, bits, burst
        self.borders: list[int] = [0]
        self.boxes: list[Counter] = [Counter()]
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        keys = np.sort(keys)
        cuts = [0, *np.searchsorted(keys, self.borders[1:]).tolist(), len(keys)]
        full = []
        for box, lo, hi in zip(self.boxes, cuts, cuts[1:]):
            if lo < hi:
                self.size -= len(box)
                box.update(keys[lo:hi].tolist())
                self.size += len(box)
                if len(box) > self.limit:
                    full.append(box)
        for box in full:
            self._burst(box)

    def _burst(self, box: Counter) -> None:
        """Two containers for one, until each is small enough (or one phrase)."""
        todo = [sorted(box)]
        while todo:
            keys = todo.pop()
            if len(keys) <= self.limit:
                continue
            for level in range(1, self.length + 1):  # the first word in which its phrases differ
                drop = self.bits * (self.length - level)
                if keys[0] >> drop != keys[-1] >> drop:
                    break
            border = keys[len(keys) // 2] >> drop << drop
            if border <= keys[0]:  # the middle is still the first prefix: cut after it
                border = ((keys[0] >> drop) + 1) << drop
            at = bisect_right(self.borders, keys[0])
            whole = self.boxes[at - 1]
            left, right = Counter(), Counter()
            for key, n in whole.items():
                (left if key < border else right)[key] = n
            self.boxes[at - 1:at] = [left, right]
            self.borders.insert(at, border)
            todo += [sorted(left), sorted(right)]

    def leave(self, at_most: int) -> list[Counter]:
        """Takes out the largest subtrees until ``at_most`` phrases are left."""
        out = []
        for i in sorted(range(len(self.boxes)), key=lambda i: -len(self.boxes[i])):
            if self.size <= at_most:
                break
            out.append(self.boxes[i])
            self.size -= len(self.boxes[i])
            self.boxes[i] = Counter()
        return out


def _word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def _phrase_hashes(seed: int, words: list[np.ndarray]) -> np.ndarray:
    """Hashes of many phrases from those of their words, one array for each place."""
    h = np.full(len(words[0]), seed, np.uint64)
    for w in words:
        h = (h ^ w) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


def _probes(h: np.ndarray) -> Iterator[np.ndarray]:
    """The bits of the filter that phrases set."""
    step = (h >> np.uint64(29)) | np.uint64(1)
    for k in range(_PROBES):
        yield (h + np.uint64(k) * step) & np.uint64(FILTER_BITS - 1)


class Counting:
    """The tries of one task."""

    def __init__(self, lengths: tuple[int, ...], kept: np.ndarray | None, entries: int, vocabulary: int, burst: int,
                 block: int):
        self.lengths, self.kept, self.entries, self.burst = lengths, kept, entries, burst
        self.bits = min(31, 62 // max(lengths))
        # a block adds a word for two of its bytes at most, so numbers always fit into their bits
        self.block = min(block, 1 << self.bits - 1)
        self.vocabulary = min(vocabulary, 1 << self.bits - 1)
        self.runs: list[pa.RecordBatch] = []
        self._anew()
        self.words: Counter = Counter()

    def _anew(self) -> None:
        self.numbers, self.hashes = Numbers(), np.zeros(1, np.uint64)
        self.tries: dict[tuple[str, int], Trie] = {}

    def feed(self, lang: str, text: bytes) -> None:
        """Counts the phrases of ``text`` (pieces of several texts are separated), a block at a time."""
        text = text.translate(_TABLE)
        carry, done = np.zeros(0, np.int64), 0
        while done < len(text):
            end = len(text)
            if end - done > self.block:
                space = _SPACE.search(text, done + self.block)
                end = space.start() if space else end
            words = text[done:end].replace(b"\n", b" \xff ").split()
            ids = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
            self.words[lang] += int(np.count_nonzero(ids))
            ids = np.concatenate((carry, ids))
            self._count(lang, ids, len(carry))
            carry = ids[max(0, len(ids) - max(self.lengths) + 1):]
            done = end
            if len(self.numbers) > self.vocabulary:
                kept_words = {n: w for w, n in self.numbers.items()} if len(carry) else {}
                self.spill(0)
                self._anew()
                carry = np.array([self.numbers[kept_words[i]] for i in carry.tolist()], np.int64)
            elif sum(t.size for t in self.tries.values()) > self.entries:
                self.spill(self.entries // 2)

    def _frequent(self, lang: str, ids: np.ndarray, length: int) -> np.ndarray:
        """Which positions may start a frequent phrase of ``length`` words, by the filter."""
        new = list(self.numbers)[len(self.hashes):]
        if new:
            self.hashes = np.append(self.hashes, np.array([_word_hash(w) for w in new], np.uint64))
        n = len(ids) - length + 1
        each = self.hashes[ids]
        h = _phrase_hashes(_word_hash(lang.encode()), [each[k:n + k] for k in range(length)])
        ok = np.ones(n, bool)
        for bit in _probes(h):
            ok &= (self.kept[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)) == 1
        return ok

    def _count(self, lang: str, ids: np.ndarray, carried: int) -> None:
        inside = ids != 0
        for length in self.lengths:
            n = len(ids) - length + 1
            if n <= 0:
                continue
            ok = np.arange(n) + length > carried  # with a word that wasn't there before
            for k in range(length):
                ok &= inside[k:n + k]
            if self.kept is not None:
                part = self._frequent(lang, ids, length - 1)
                ok &= part[:n] & part[1:n + 1]
            starts = np.flatnonzero(ok)
            if len(starts):
                key = ids[starts]
                for k in range(1, length):
                    key = key << self.bits | ids[starts + k]
                trie = self.tries.get((lang, length))
                if trie is None:
                    trie = self.tries[lang, length] = Trie(length, self.bits, self.burst)
                trie.add(key)

    def spill(self, at_most: int) -> None:
        """Turns the largest subtrees into runs until ``at_most`` phrases are left in all."""
        total = sum(t.size for t in self.tries.values())
        if not total:
            return
        names = pa.array(list(self.numbers)[1:], pa.binary()).cast(pa.string())
        mask = (1 << self.bits) - 1
        for (lang, length), trie in self.tries.items():
            for box in trie.leave(trie.size * at_most // total):
                keys = np.fromiter(box.keys(), np.int64, len(box))
                counts = np.fromiter(box.values(), np.int64, len(box))
                run = np.argsort(keys)
                keys = keys[run]
                parts = [names.take(pa.array((keys >> self.bits * (length - 1 - k) & mask) - 1)) for k in range(length)]
                self.runs.append(_run(lang, parts, counts[run]))

    def close(self) -> None:
        self.spill(0)
        for lang, n in self.words.items():  # the empty phrase: all words of the language
            if n and 1 in self.lengths:
                self.runs.append(_run(lang, [pa.array([""])], np.array([n])))


def _run(lang: str, parts: list[pa.Array], counts: np.ndarray) -> pa.RecordBatch:
    phrase = pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]
    return pa.RecordBatch.from_arrays([pa.repeat(lang, len(phrase)), phrase, pa.array(counts)],
                                      names=["lang", "phrase", "n"])


def count_phrases(texts: DataFrame, lengths: tuple[int, ...], min_count: int, kept=None, entries: int = ENTRIES,
                  vocabulary: int = VOCABULARY, burst: int = BURST, block: int = BLOCK_BYTES) -> DataFrame:
    """texts: ``lang``, ``text`` (binary). ``lang``, ``phrase``, ``n`` of the phrases of these lengths that occur
    ``min_count`` times or more, and with length 1 the empty phrase with the number of all words. kept: a
    broadcast filter; phrases whose parts it lacks are left out."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = Counting(lengths, None if kept is None else kept.value, entries, vocabulary, burst, block)
        waiting, held = defaultdict(list), 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                if text.is_valid:
                    waiting[lang.as_py()].append(text.as_py())
                    held += len(waiting[lang.as_py()][-1])
                if held > block:
                    for name, some in waiting.items():
                        counting.feed(name, b"\n".join(some))
                    waiting, held = defaultdict(list), 0
                    yield from counting.runs
                    counting.runs = []
        for name, some in waiting.items():
            counting.feed(name, b"\n".join(some))
        counting.close()
        yield from counting.runs

    found, prefix, keys = texts.mapInArrow(runs, _COUNTS), ["lang", "phrase"], ["lang", "phrase"]
    if max(lengths) > 2:
        found, prefix = found.withColumn("head", F.substring_index("phrase", " ", 2)), ["lang", "head"]
        keys = ["lang", "head", "phrase"]
    merged = found.repartition(*prefix).groupBy(*keys).agg(F.sum("n").alias("n"))
    return merged.where((F.col("n") >= min_count) | (F.col("phrase") == "")).select("lang", "phrase", "n")


def _page_bytes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The cells of a page of the filter, each at its place."""
    for pages in batches:
        out = []
        for cells in pages:
            flat, page = cells.values, np.zeros(_PAGE, np.int64)
            page[flat.field("cell").to_numpy() % _PAGE] = flat.field("bits").to_numpy()
            out.append(page.tobytes())
        yield pa.array(out, pa.binary())


def frequent_filter(phrases: DataFrame, length: int):
    """A broadcast Bloom filter of the phrases of ``length`` words: ``FILTER_BITS`` bits, whatever their number."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [p.split(" ") for p in batch.column(1).to_pylist()]
            words = [np.array([_word_hash(p[k].encode()) for p in split], np.uint64) for k in range(length)]
            seeds = np.array([_word_hash(x.encode()) for x in batch.column(0).to_pylist()], np.uint64)
            if not len(seeds):
                continue
            bits = np.unique(np.concatenate(list(_probes(_phrase_hashes(seeds, words)))))
            cell, first = np.unique(bits >> np.uint64(6), return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (bits & np.uint64(63)), first)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64)), pa.array(value.view(np.int64))],
                                             names=["cell", "bits"])

    some = phrases.where(F.size(F.split("phrase", " ")) == length).select("lang", "phrase")
    cell = some.mapInArrow(cells, "cell bigint, bits bigint").groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    page = F.expr(f"cell div {_PAGE}").alias("page")
    pages = cell.groupBy(page).agg(F.collect_list(F.struct("cell", "bits")).alias("cells"))  # _PAGE cells at most
    kept = np.zeros(FILTER_BITS // 64, np.uint64)  # the filter's own size is all that reaches the driver
    for r in pages.select("page", F.arrow_udf(_page_bytes, "binary")("cells").alias("bits")).toLocalIterator():
        kept[r.page * _PAGE:(r.page + 1) * _PAGE] = np.frombuffer(r.bits, np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(kept)


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1,000,000 * a * a / (left * right)), exact for counts below 10**15."""
    wide = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * wide(a) * wide(a), wide(left) * wide(right))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT, covered_percent: int = COVERED_PERCENT, top: int = TOP,
                 **memory) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``max_words`` words with ``min_count`` occurrences or more that no
    longer one covers: ``lang``, ``rank``, ``phrase``, ``a`` (its occurrences), ``l`` and ``r`` (those of the two parts of its
    lowest-scoring cut), ``n`` (all words of the language), ``score``."""
    if not 2 <= max_words <= 8 or min_count < 1:
        raise ValueError("phrases have two to eight words and occur")
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), utf8(text_col).alias("text"))
    counts = materialize(count_phrases(texts, (1, 2), min_count, **memory), "phrases2")
    for length in range(3, max_words + 1):
        longer = count_phrases(texts, (length,), min_count, frequent_filter(counts, length - 1), **memory)
        counts = counts.unionByName(materialize(longer, f"phrases{length}"))
    totals = counts.where("phrase = ''").select("lang", F.col("n").alias("n"))
    counts = counts.where("phrase <> ''").select("lang", "phrase", F.col("n").alias("f"))
    words = F.split("phrase", " ")
    candidates = counts.withColumn("words", words).where(F.size("words") > 1)

    # the lowest-scoring cut; every part is as frequent as the phrase, so it has been counted
    part = lambda at, n: F.array_join(F.slice("words", at, n), " ")
    cuts = candidates.select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(
        F.sequence(F.lit(1), F.size("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.size("words")).alias("right"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(
        counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(
        score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("cut"))

    # candidates inside a longer one that has enough of their occurrences
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.size("words") - n + 1), lambda at: F.array_join(F.slice("words", at, n), " "))))
    around = candidates.where(F.size("words") > 2).select("lang", "f", F.explode(spans).alias("phrase")).groupBy(
        "lang", "phrase").agg(F.max("f").alias("around"))
    free = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (100 * F.col("around") < covered_percent * F.col("a")))

    ranked = free.select("lang", "phrase", "a", "cut.*", F.pmod(F.xxhash64("phrase"), F.lit(_RANKED_PARTS)).alias("part"))
    for keys in (["lang", "part"], ["lang"]):
        best = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = ranked.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r",
                                              "n", "score")
