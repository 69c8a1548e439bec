"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, JVM-side only.

A text's paragraphs are its lines; an element is the 60-bit digest of a paragraph and, if it
occurs more than once, of how often. The sketch has three sub-tables of ``CELLS`` cells; an element
is added to one cell of each: the cell counts its elements and XORs their digests and checks.
Subtracting two sketches cell by cell leaves the elements that differ; a cell holding just one of
them (count +1 or -1 and a check that fits) gives it away, it is taken out of its other cells, and
so on until all cells are empty. If some aren't, the difference was too large for the sketch: both
element sets are split in four by further digest bits and sketched again, which is a sketch of four
times the cells, and so on for the parts that still fail. A row therefore never holds more than a
text's own elements, and work is linear in them.

Defined results: a null text is an empty text, which has one (empty) paragraph; texts with equal
paragraphs (equal texts, therefore) have equal sketches, as have texts whose paragraphs are merely
in another order; an empty table gives an empty table. Rows are sketched one by one; for repeated
ids in ``with_next`` see there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import sorted_parts

#: Cells of each of the three sub-tables: four digest bits choose one.
CELLS = 16
TABLES = 3
#: Rounds of peeling; each takes out all elements that stand alone.
ROUNDS = 16
#: Digest bits used by cells, by one split, and in all.
_CELL_BITS, _SPLIT_BITS, _BITS = 12, 2, 60


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _number(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def _check(element: Column) -> Column:
    return _number(element.cast("string"), 8)


def elements(text: Column) -> Column:
    """The text's distinct paragraph digests, array<bigint>."""
    digests = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: _number(p, 15))

    def runs(s: Column) -> Column:
        starts = F.filter(F.transform(s, lambda d, i: F.when((i > 0) & (F.get(s, i - 1) == d), F.lit(-1))
                                      .otherwise(i)), lambda i: i >= 0)
        return _let(starts, lambda at: F.transform(at, lambda i, k: _let(
            F.coalesce(F.get(at, k + 1), F.size(s)) - i, lambda n: F.when(n == 1, F.get(s, i)).otherwise(
                _number(F.concat_ws(":", F.get(s, i).cast("string"), n.cast("string")), 15)))))

    return _let(F.sort_array(digests), runs)


def _place(element: Column, cell: Column) -> Column:
    """Whether the element belongs to the cell (see ``_cells``)."""
    return F.call_function("shiftright", element, cell.shift).bitwiseAND(F.lit(CELLS - 1).cast("bigint")) == cell.slot


def _xor(values: Column, of: Callable[[Column], Column]) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, v: a.bitwiseXOR(of(v)))


def _cells() -> Column:
    """A constant: for each cell where in an element its bits begin, and their value."""
    return F.array(*[F.struct(F.lit(4 * table).alias("shift"), F.lit(slot).cast("bigint").alias("slot"))
                     for table in range(TABLES) for slot in range(CELLS)])


def sketch(items: Column) -> Column:
    """array<struct<n,x,c>> of all cells: count, XOR of the elements, XOR of their checks."""
    checked = F.transform(items, lambda e: F.struct(e.alias("e"), _check(e).alias("c")))
    return _let(checked, lambda all_: F.transform(_cells(), lambda k: _let(
        F.filter(all_, lambda v: _place(v.e, k)), lambda here: F.struct(
            F.size(here).cast("bigint").alias("n"), _xor(here, lambda v: v.e).alias("x"),
            _xor(here, lambda v: v.c).alias("c")))))


def text_form(cells: Column) -> Column:
    """The sketch as a string: n:x:c of each cell."""
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(
        ":", c.n.cast("string"), c.x.cast("string"), c.c.cast("string"))), ",")


def _peel(difference: Column) -> Column:
    """struct<cells, a, b>: what is left of the cells, and the elements found on either side."""
    none = F.array().cast("array<bigint>")
    start = F.struct(difference.alias("cells"), none.alias("a"), none.alias("b"))

    def take(state: Column, alone: Column) -> Column:
        cells = F.zip_with(state.cells, _cells(), lambda c, k: _let(
            F.filter(alone, lambda v: _place(v.x, k)), lambda gone: F.struct(
                F.aggregate(gone, c.n, lambda n, v: n - v.n).alias("n"),
                c.x.bitwiseXOR(_xor(gone, lambda v: v.x)).alias("x"),
                c.c.bitwiseXOR(_xor(gone, lambda v: v.c)).alias("c"))))
        return F.struct(cells.alias("cells"),
                        F.concat(state.a, F.transform(F.filter(alone, lambda v: v.n == 1), lambda v: v.x)).alias("a"),
                        F.concat(state.b, F.transform(F.filter(alone, lambda v: v.n == -1), lambda v: v.x)).alias("b"))

    def turn(state: Column, _: Column) -> Column:
        alone = F.array_distinct(F.filter(state.cells, lambda c: (F.abs(c.n) == 1) & (_check(c.x) == c.c)))
        return _let(alone, lambda found: F.when(F.size(found) == 0, state).otherwise(take(state, found)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _decoded(a: Column, b: Column) -> Column:
    """struct<ok, a, b>: the elements of a and b alone, from the difference of their sketches."""
    difference = F.zip_with(sketch(a), sketch(b), lambda x, y: F.struct(
        (x.n - y.n).alias("n"), x.x.bitwiseXOR(y.x).alias("x"), x.c.bitwiseXOR(y.c).alias("c")))
    return _let(_peel(difference), lambda s: F.struct(
        F.forall(s.cells, lambda c: (c.n == 0) & (c.x == 0) & (c.c == 0)).alias("ok"), s.a.alias("a"), s.b.alias("b")))


def differences(pairs: DataFrame, keys: list[str], a: str = "a", b: str = "b") -> DataFrame:
    """pairs: ``keys`` (unique, not null) and two columns of elements. Returns the keys and
    ``only_a``, ``only_b``: the recovered elements of one side alone.

    Parts whose sketches fail are split and sketched again; only these are written again. Should
    parts with no more bits to split by be left, they are compared element by element."""
    at = [F.col(k) for k in keys]
    open_, found, level = pairs.select(*at, F.col(a).alias("a"), F.col(b).alias("b")), [], 0
    while True:
        tried = open_.select(*at, "a", "b", _decoded(F.col("a"), F.col("b")).alias("d"))
        # what failed keeps its elements, what succeeded its result
        tried = materialize(tried.select(*at, F.col("d.ok").alias("ok"), *[
            F.when(F.col("d.ok"), F.col(f"d.{c}")).otherwise(F.col(c)).alias(c) for c in "ab"]), "peeled")
        found.append(tried.where("ok").select(*at, "a", "b"))
        failed = tried.where("not ok")
        if failed.limit(1).count() == 0:
            break
        shift = _CELL_BITS + _SPLIT_BITS * level
        level += 1
        if shift + _SPLIT_BITS > _BITS:
            found.append(failed.select(*at, F.array_except("a", "b").alias("a"), F.array_except("b", "a").alias("b")))
            break
        part = lambda c, q: F.filter(c, lambda e: F.shiftright(e, shift).bitwiseAND(
            F.lit((1 << _SPLIT_BITS) - 1).cast("bigint")) == q)
        open_ = failed.select(*at, "a", "b", F.explode(F.sequence(F.lit(0), F.lit((1 << _SPLIT_BITS) - 1))).alias(
            "q")).select(*at, part(F.col("a"), F.col("q")).alias("a"), part(F.col("b"), F.col("q")).alias("b"))
        open_ = open_.where("size(a) + size(b) > 0")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy(*at).agg(F.flatten(F.collect_list("a")).alias("only_a"),
                                  F.flatten(F.collect_list("b")).alias("only_b"))


def likeness(n_a: Column, only_a: Column, only_b: Column) -> Column:
    """Jaccard similarity of two element sets: common elements by all elements."""
    return (n_a - only_a) / (n_a + only_b)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, text, next_text, next_elements): each document with the next one's first characters
    (as many as half the document has) and its elements.

    The next document has the next larger id; after the last comes the first. Rows without an id
    come last, as one id. Rows that share an id have the same next document, and of several next
    documents the one of the least text is taken. Ids are ordered by a range partitioning of the
    ids alone; texts move by id once, and once more as far as they are the next one's beginning."""
    rows = docs.select(F.col(id_col).isNull().alias("none"), F.coalesce(F.col(id_col), F.lit(0)).cast("bigint")
                       .alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = rows.groupBy("none", "id").agg(F.max(F.char_length("text")).alias("longest"))
    order = [F.col("none"), F.col("id")]
    parts = sorted_parts(ids, order, "part", "order")
    me = F.struct("none", "id")
    firsts = parts.groupBy("part").agg(F.min(me).alias("first"))
    after = firsts.select("part", F.coalesce(F.lead("first").over(Window.orderBy("part")),
                                             F.min("first").over(Window.partitionBy())).alias("after"))
    follow = F.coalesce(F.lead(me).over(Window.partitionBy("part").orderBy(*order)), F.col("after"))
    links = parts.join(after, "part").select(F.col("none").alias("to_none"), F.col("id").alias("to_id"), "longest",
                                             follow.alias("next"))
    links = links.select("to_none", "to_id", "longest", F.col("next.none").alias("none"), F.col("next.id").alias("id"))
    text = F.col("text")
    sent = rows.join(links, ["none", "id"]).select(
        "to_none", "to_id", F.substring(text, F.lit(1), F.floor(F.col("longest") / 2).cast("int")).alias("next_text"),
        elements(text).alias("next_elements"))
    least = sent.groupBy(F.col("to_none").alias("none"), F.col("to_id").alias("id")).agg(
        F.min(F.struct("next_text", "next_elements")).alias("s"))
    return rows.join(least, ["none", "id"]).select(F.when(~F.col("none"), F.col("id")).alias("id"), "text", "s.*")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and the
    numbers of paragraphs that the edited text lost and gained."""
    pairs = with_next(docs, id_col, text_col)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = pairs.select("id", "text", edited.alias("edited"), "next_elements").select(
        "id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256)
        .alias("edited_sha256"), elements(F.col("text")).alias("own"), elements(F.col("edited")).alias("new"),
        F.col("next_elements").alias("next"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "elements")
    both = rows.select("row", "own", F.explode(F.array(
        F.struct(F.lit("edited").alias("to"), F.col("new").alias("other")),
        F.struct(F.lit("next").alias("to"), F.col("next").alias("other")))).alias("p"))
    lost = differences(both.select("row", F.col("p.to").alias("to"), F.col("own").alias("a"), F.col("p.other")
                                   .alias("b")), ["row", "to"])
    counts = lost.groupBy("row").agg(*[F.max(F.when(F.col("to") == to, F.size(side))).alias(f"{to}_{side}")
                                       for to in ("edited", "next") for side in ("only_a", "only_b")])
    near = lambda to: likeness(F.size("own"), F.col(f"{to}_only_a"), F.col(f"{to}_only_b"))
    return rows.join(counts, "row").select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", text_form(sketch(F.col("own"))).alias("fingerprint"),
        text_form(sketch(F.col("new"))).alias("edited_fingerprint"), near("edited").alias("near_edited"),
        near("next").alias("near_next"), F.col("edited_only_a").cast("bigint").alias("lost"),
        F.col("edited_only_b").cast("bigint").alias("gained"))
