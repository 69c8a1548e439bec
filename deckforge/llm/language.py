"""Language ID of mixed text: script ranges, scores of words, Viterbi over the words of a text.

Words are what stands between white space, cut where the script of the letters changes; scripts written
without spaces are cut into pieces of ``PIECE_LETTERS`` letters, so each word has one script.
``fit`` counts the byte 1- to 4-grams of the words of labelled texts, hashed to a fixed number of
buckets, and the scripts in which each language is written. A word's script leaves the languages
that use this script; among these the word's score for a language is the log-likelihood of its
n-grams. ``label`` finds the cheapest sequence of languages over the words of a text, where each
change of language costs ``switch_penalty``, and joins words of one language into spans.

Training reads a bounded sample of rows (``train_docs`` texts of each language, about), each text whole; counts
are added up in the task. The model has ``orders * buckets`` numbers for each language, the
only data sent to the driver and to every task. Labelling covers every text whole, in its row,
without a shuffle. The texts of a block walk through Viterbi in step, longest first.

Defined results: a null text or one without a letter is ``und`` with score 0 and no spans; a
text with letters of no learned language's script gets the most frequent learned language, with
score 0; ties go to the language that sorts first; without a labelled text nothing is learned
and every text is ``und``. Texts of any length are labelled whole, rows one by one, so repeated rows and null ids
need no rule; an empty table gives an empty table. A column of the input named like the output column is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, concat, fresh_name, struct_array, utf8, with_fresh

ORDERS = 4
BUCKETS = 1 << 14
TRAIN_DOCS = 500
#: Letters of a word in a script without spaces.
PIECE_LETTERS = 4
#: Natural-log units that a change of language costs.
SWITCH_PENALTY = 12.0
#: A language uses a script that holds at least this share of its words.
SCRIPT_SHARE = 0.02
UNDETERMINED = "und"
BLOCK_BYTES = 3 << 20
#: Text that is counted at a time in training.
COUNT_BYTES = 1 << 20

# First code point of Unicode block ranges and the script they belong to.
SCRIPT_STARTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0D00, "malayalam"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1380, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"),
]
_SPACE = re.compile(rb"[ \t-\r]")
_STARTS = [s for s, _ in SCRIPT_STARTS]
SCRIPTS = sorted({name for _, name in SCRIPT_STARTS})

#: Scripts written without spaces between words ("other" has several).
UNSPACED = {SCRIPTS.index(x) for x in ("han", "kana", "thai", "other")}

RESULT = ("struct<lang:string,score:double,lettered:double,n_words:bigint,"
          "spans:array<struct<lang:string,start:int,end:int>>>")
_SPAN = pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


@dataclass(frozen=True)
class LanguageModel:
    """langs: sorted; table: log-probabilities by (order * buckets + bucket, language), a last row
    of zeros; uses: by (script, language); usual: number of the most frequent language."""
    langs: tuple[str, ...]
    table: np.ndarray
    uses: np.ndarray
    usual: int
    orders: int
    buckets: int


def _script(letter: str) -> int:
    return SCRIPTS.index(SCRIPT_STARTS[bisect_right(_STARTS, ord(letter)) - 1][1])


def script_of(word: str) -> int:
    """Number of the script of the word's first letter, -1 if it has none."""
    return next((_script(ch) for ch in word if ch.isalpha()), -1)


def pieces(run: str) -> list[str]:
    """What stands between white space as words of one script each; other characters go with the letter before."""
    if not run or max(run) < "\u0370":
        return [run]
    cuts, script, letters = [0], -1, 0
    for i, ch in enumerate(run):
        if ch.isalpha():
            now = _script(ch)
            if script >= 0 and (now != script or now in UNSPACED and letters == PIECE_LETTERS):
                cuts.append(i)
                letters = 0
            script, letters = now, letters + 1
    return [run[a:b] for a, b in zip(cuts, [*cuts[1:], len(run)])]


def _starts(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins in the joined words (at the blank before it), and its bytes."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.concatenate(([0], np.cumsum(lengths + 1)[:-1])), lengths


def _grams(words: list[bytes], orders: int, buckets: int) -> Iterator[np.ndarray]:
    """For each order the table row of the n-gram at each byte of the joined words (with a blank
    around each word); the row past the end for n-grams that would leave the word."""
    text = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    starts, lengths = _starts(words)
    end = np.repeat((starts + lengths + 2).astype(np.int32), lengths + 1)  # the blank after a word may be taken in
    end -= np.arange(len(end), dtype=np.int32)
    code = np.zeros(len(text), np.uint32)
    for k in range(orders):
        code[:len(text) - k] += text[k:]
        code += np.uint32(1)
        code *= np.uint32(0x9E3779B1)
        row = ((code[:len(end)] ^ (code[:len(end)] >> np.uint32(15))) % np.uint32(buckets)).astype(np.int32)
        row += k * buckets
        row[end < k + 1] = orders * buckets
        if k == 0:
            row[starts] = orders * buckets  # the blank alone says nothing
        yield row


def _cut(text: bytes, size: int) -> Iterator[bytes]:
    """The text in parts of about ``size`` bytes, cut at white space."""
    done = 0
    while done < len(text):
        space = _SPACE.search(text, done + size)
        end = space.start() if space else len(text)
        yield text[done:end]
        done = end


def _counts(texts: list[bytes], orders: int, buckets: int) -> tuple[np.ndarray, np.ndarray, int]:
    words = [w for t in texts for run in t.decode("utf-8", "ignore").lower().split() for w in pieces(run)
             if any(map(str.isalpha, w))]
    grams = np.zeros(orders * buckets + 1, np.int64)
    scripts = np.zeros(len(SCRIPTS), np.int64)
    if words:
        for row in _grams([w.encode() for w in words], orders, buckets):
            grams += np.bincount(row, minlength=len(grams))
        scripts += np.bincount(np.fromiter(map(script_of, words), np.int64), minlength=len(SCRIPTS))
    return grams[:-1], scripts, len(words)


def fit(docs: DataFrame, usable: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        train_docs: int = TRAIN_DOCS, orders: int = ORDERS,
        buckets: int = BUCKETS) -> LanguageModel | None:
    """A model of the languages in ``lang_col`` of the rows where ``usable`` holds.

    Sampling is by a hash of the id and a share of ``train_docs`` to the language's rows, so no
    language is gathered in one task and reruns take the same texts. None if there are no rows."""
    rows = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(F.col(lang_col)).agg(F.count(F.lit(1))).collect()}
    if not sizes:
        return None
    langs = tuple(sorted(sizes))
    chance = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, train_docs / n))])
    # xxhash64 of a null is its seed: rows without an id are all taken or all left
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.where(draw < chance[F.col(lang_col)]).select(
        F.col(lang_col).alias("lang"), utf8(text_col).alias("text"))
    number = {k: i for i, k in enumerate(langs)}

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                t = total.setdefault(lang, list(_counts([], orders, buckets)))
                for part in _cut(text.as_py(), COUNT_BYTES):
                    grams, scripts, n = _counts([part], orders, buckets)
                    t[0], t[1], t[2] = t[0] + grams, t[1] + scripts, t[2] + n
        for lang, (grams, scripts, n) in total.items():
            both = np.concatenate((grams, scripts, [n]))
            cell = np.flatnonzero(both)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([number[lang]] * len(cell), pa.int32()),
                                              "cell": pa.array(cell, pa.int32()), "n": pa.array(both[cell])})

    cells = (sample.mapInArrow(tally, "lang int, cell int, n bigint").groupBy("lang", "cell")
             .agg(F.sum("n").alias("n")).toPandas())
    seen = np.zeros((len(langs), orders * buckets + len(SCRIPTS) + 1))
    seen[cells["lang"].to_numpy(int), cells["cell"].to_numpy(int)] = cells["n"].to_numpy(float)
    grams, scripts, words = seen[:, :orders * buckets], seen[:, orders * buckets:-1], seen[:, -1:]
    table = np.zeros((orders * buckets + 1, len(langs)), np.float32)
    for k in range(orders):
        part = grams[:, k * buckets:(k + 1) * buckets] + 0.5
        table[k * buckets:(k + 1) * buckets] = np.log(part / part.sum(axis=1, keepdims=True)).T
    uses = (scripts >= SCRIPT_SHARE * np.maximum(words, 1)) & (scripts > 0)
    usual = max(range(len(langs)), key=lambda i: (sizes[langs[i]], -i))
    return LanguageModel(langs, table, uses.T, usual, orders, buckets)


def word_scores(model: LanguageModel, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each word: the score of each language (the best is 0; all 0 if the word says nothing),
    and whether the word has a letter of a script that a language uses."""
    texts = [w.decode("utf-8", "replace").lower() for w in words]
    scripts = np.fromiter(map(script_of, texts), np.int64, len(texts))
    encoded = [t.encode() for t in texts]
    starts, _ = _starts(encoded)
    score = np.zeros((len(words), len(model.langs)), np.float32)
    for row in _grams(encoded, model.orders, model.buckets):
        score += np.add.reduceat(model.table[row], starts, axis=0)
    score /= model.orders
    candidates = model.uses[np.maximum(scripts, 0)] & (scripts >= 0)[:, None]
    tells = candidates.any(axis=1)
    score = np.where(candidates, score, -np.inf)
    best = np.max(score, axis=1, keepdims=True, initial=-1e30)
    # a language that doesn't use the script stays possible at a high price, so that one foreign
    # word can't forbid a language
    score = np.where(candidates, np.maximum(score - best, -50.0), -50.0)
    score[~tells] = 0
    return score.astype(np.float32), tells


def viterbi(score: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word. score: (words, languages), texts one after the other;
    a sequence's worth is the sum of its scores less ``penalty`` for each change. Ties go to
    staying, then to the first language."""
    n, langs = score.shape
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begin, length = begin[order], lengths[order]
    # how many texts reach step t: texts are sorted by length
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(steps), side="left")
    came = np.empty((n, langs), np.int8 if langs < 128 else np.int32)  # the language before
    stay = np.arange(langs)
    worth = score[begin[:active[0]]].copy() if steps else score[:0]
    final = np.zeros((len(length), langs), np.float32)
    for t in range(1, steps):
        m = active[t]
        if m < len(worth):
            final[m:len(worth)] = worth[m:]
            worth = worth[:m]
        at = begin[:m] + t
        top = worth.argmax(axis=1)
        most = worth.max(axis=1, keepdims=True) - penalty
        changes = most > worth
        came[at] = np.where(changes, top[:, None], stay)
        worth = np.maximum(worth, most) + score[at]
    final[:len(worth)] = worth
    path = np.zeros(n, np.int32)
    now = final.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        m = active[t]
        at = begin[:m] + t
        path[at] = now[:m]
        if t:
            now[:m] = came[at, now[:m]]
    return path


def _into_pieces(runs: np.ndarray, lengths: np.ndarray, distinct: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Runs between white space (their numbers, and how many each text has) as words of one script each."""
    cut = [[w] if w.isascii() else [p.encode() for p in pieces(w.decode("utf-8", "replace"))] for w in distinct]
    if all(len(p) == 1 for p in cut):
        return runs, lengths, distinct
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    flat = np.array([number[p] for ps in cut for p in ps], np.int32)
    parts = np.fromiter(map(len, cut), np.int64, len(cut))
    first, each = np.cumsum(parts) - parts, parts[runs]
    ends = np.cumsum(each)
    words = flat[np.repeat(first[runs] - (ends - each), each) + np.arange(ends[-1])]
    bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(lengths)))]
    return words, np.diff(bounds), list(number)


def _label(model: LanguageModel, texts: list[bytes | None], penalty: float) -> pa.StructArray:
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    flat: list[int] = []
    lengths = np.zeros(len(texts), np.int64)
    for i, raw in enumerate(texts):
        found = (raw or b"").split()
        lengths[i] = len(found)
        flat.extend(map(number.__getitem__, found))
    words = np.array(flat, np.int32)
    del flat
    words, lengths, distinct = _into_pieces(words, lengths, list(number))
    langs = np.array([*model.langs, UNDETERMINED], object)
    k, rows = len(model.langs), len(texts)
    owner = np.repeat(np.arange(rows, dtype=np.int32), lengths)
    if len(words):
        by_word, tells = word_scores(model, distinct)
        letters = np.fromiter((any(map(str.isalpha, w.decode("utf-8", "replace"))) for w in distinct), bool,
                               len(distinct))
        path = viterbi(by_word[words], lengths, penalty)
        told, has = tells[words], letters[words]
    else:
        path, told, has = words, words.astype(bool), words.astype(bool)
    votes = np.bincount(owner[told] * k + path[told], minlength=rows * k).reshape(rows, k)
    counted, any_letter = votes.sum(axis=1), np.bincount(owner[has], minlength=rows) > 0
    best = np.where(counted > 0, votes.argmax(axis=1), np.where(any_letter, model.usual, k))
    score = np.where(counted > 0, votes.max(axis=1, initial=0) / np.maximum(counted, 1), 0.0)
    lettered = np.bincount(owner[has], minlength=rows) / np.maximum(lengths, 1)
    new = np.ones(len(words), bool)
    new[1:] = (path[1:] != path[:-1]) | (owner[1:] != owner[:-1])
    new &= any_letter[owner]
    lo = np.flatnonzero(new)
    ends = np.cumsum(lengths)
    hi = np.minimum(np.append(lo[1:], len(words))[:len(lo)], ends[owner[lo]])
    offset = (ends - lengths)[owner[lo]]
    spans = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(np.bincount(owner[lo], minlength=rows)))), pa.int32()),
        pa.StructArray.from_arrays([pa.array(langs[path[lo]], pa.string()), pa.array(lo - offset, pa.int32()),
                                    pa.array(hi - offset, pa.int32())], fields=list(_SPAN)))
    return struct_array({"lang": pa.array(langs[best], pa.string()), "score": pa.array(score, pa.float64()),
                         "lettered": pa.array(lettered, pa.float64()), "n_words": pa.array(lengths), "spans": spans})


def label(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", out_col: str = "language",
          switch_penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``docs`` with a struct column: the text's language, the share of its telling words that
    have it, the share of words with a letter, the number of words, and the spans of words by language."""
    if model is None:
        n_words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
        return with_fresh(docs, out_col, F.struct(
            F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"), F.lit(0.0).alias("lettered"), n_words.alias("n_words"),
            F.array().cast("array<struct<lang:string,start:int,end:int>>").alias("spans")))
    # as plain values: workers need not be able to import this module to read a broadcast
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = LanguageModel(*shared.value)
        for batch in batches:
            yield concat((_label(known, part, switch_penalty) for part in blocks(batch, BLOCK_BYTES)),
                         pa.struct([]))

    return with_fresh(docs, out_col, run(utf8(text_col)))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the row is kept out of training; a row without an id isn't held out (nor learned from)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
             out_col: str = "language", switch_penalty: float = SWITCH_PENALTY) -> DataFrame:
    """Learns from the rows not held out and labels all rows."""
    keep = fresh_name(docs, "_held_out")
    model = fit(docs.withColumn(keep, held_out(id_col)), ~F.col(keep) & F.col(id_col).isNotNull(), text_col,
                lang_col, id_col)
    return label(docs, model, text_col, out_col, switch_penalty)
