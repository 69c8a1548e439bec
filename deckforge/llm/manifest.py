"""Merkle dataset manifest: leaf coordinates by bitmap rank, levels reduced in keyed slot arrays.

A leaf is the digest of one document; the leaves of a source ascend by doc_id, every ``ARITY``
neighbours become their digest until one node, the source's subroot, remains, and the subroots in
source order make the root in the same way.

Nothing is sorted to find a leaf's place. Each source's doc_ids are OR-ed into 64-bit words (only
words with a bit are kept), and counts of words are summed over 512 neighbours at a time into as
many directory levels as the range of ids needs. A leaf's place is the count before its word plus
the bits below its own in the word. Ids that several rows have (rows without an id among them) make
a word hold more rows than bits; just the rows of such words are put in order, by leaf digest.

``SPAN`` = 3**6 neighbouring nodes go to one row, each into the slot of its place, and are reduced by up
to six levels there; the rows' results are the nodes of the next round, so 10**10 leaves of one source
take four rounds. A leaf's proof is built on the way down: its own siblings within the row,
then those of the row's node. Keys are (source, word) and (source, row): no task holds a whole source.

Defined results: a null field is written ``-`` (so a null text and an empty one differ); rows
without a doc_id come first in their source; among rows with one doc_id the smaller leaf digest comes
first, and equal rows take neighbouring places; a null source is a source of its own, before all
others; a lone leaf is its source's subroot and a lone subroot the root, with an empty proof; an empty
table gives an empty manifest. Only the five named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import number_in_order

ARITY = 3
#: Levels reduced within one row, and the nodes of a row.
ROUND_LEVELS = 6
SPAN = ARITY ** ROUND_LEVELS
#: Directory entries that are summed into one of the next level: 2**9.
_FAN_BITS = 9
_WORD_BITS = 6
#: The word of rows without an id: below that of the least bigint.
_NO_ID = -(1 << 57) - 1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PROOF = "array<struct<left:string,right:string>>"
_NODES = f"array<struct<slot:int,doc_id:bigint,hash:string,other:string,proof:{_PROOF}>>"


def field(col: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    value = col.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value), F.lit(":"), value))


def leaf(**replaced: Column) -> Column:
    """The leaf digest of a row of ``documents``, with some columns replaced by other values."""
    return F.sha2(F.concat(*[field(replaced.get(c, F.col(c))) for c in FIELDS]), 256)


def fold(leaf_hash: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf_hash, lambda node, s: F.sha2(F.concat(s.left, node, s.right), 256))


def _running(keys: list[str], order: str) -> Column:
    """Sum of ``n`` over the rows before this one."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(w), F.lit(0))


def _ranks(words: DataFrame) -> DataFrame:
    """words: ``g``, ``w``, ``bits``, ``n``. The same with ``before``: rows of the ``g`` in lesser words."""
    lo, hi = words.where(F.col("w") != _NO_ID).agg(F.min("w"), F.max("w")).first()
    lo, hi, top = lo or 0, hi or 0, 1
    while (hi >> _FAN_BITS * top) - (lo >> _FAN_BITS * top) >= 1 << _FAN_BITS:
        top += 1
    directory = [words.select("g", F.col("w").alias("k"), "n")]
    for _ in range(top):
        directory.append(directory[-1].groupBy("g", F.shiftright("k", _FAN_BITS).alias("k")).agg(F.sum("n").alias("n")))
    # the top level has about 512 entries a source, each lower one 512 under an entry
    before = directory[top].select("g", "k", _running(["g"], "k").alias("before"))
    for level in reversed(directory[:top]):
        inner = level.withColumn("up", F.shiftright("k", _FAN_BITS)).withColumn("inner", _running(["g", "up"], "k"))
        before = inner.join(before.withColumnRenamed("k", "up"), ["g", "up"]).select(
            "g", "k", (F.col("before") + F.col("inner")).alias("before"))
    return words.join(before.withColumnRenamed("k", "w"), ["g", "w"])


def _places(keyed: DataFrame) -> DataFrame:
    """keyed: ``g``, ``w`` (the word of the id), ``bit`` (0 to 63), ``hash`` and others. With ``place``, the
    row's 0-based place in ``g``."""
    words = materialize(keyed.groupBy("g", "w").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.count(F.lit(1)).alias("n")), "manifest-words")
    ranks = materialize(_ranks(words), "manifest-ranks")
    found = keyed.join(ranks, ["g", "w"])
    below = F.expr("bit_count(bits & ~shiftleft(-1L, bit))")
    columns = [*keyed.columns, "place"]
    placed = found.where("n = bit_count(bits)").withColumn("place", F.col("before") + below).select(*columns)
    if not ranks.where("n > bit_count(bits)").head(1):
        return placed
    # ids of several rows: the rows of their words in order, counted from the word's first
    several = number_in_order(found.where("n > bit_count(bits)"), [F.col(c) for c in ("g", "w", "bit", "hash")],
                              "at", "manifest-several")
    first = several.groupBy("g", "w").agg(F.min("at").alias("first"))
    several = several.join(first, ["g", "w"]).withColumn("place", F.col("before") + F.col("at") - F.col("first"))
    return placed.unionByName(several.select(*columns))


def _digest(run: list[str]) -> str:
    return sha256("".join(run).encode()).hexdigest()


def _levels(hashes: list[str], n: int) -> list[list[str]]:
    """The nodes and the ``n`` levels above them."""
    out = [hashes]
    for _ in range(n):
        now = out[-1]
        out.append([_digest(now[i:i + ARITY]) for i in range(0, len(now), ARITY)])
    return out


def _slots(row: list[dict]) -> list[dict]:
    """The nodes of a row, each in the slot of its place."""
    slots: list = [None] * len(row)
    for node in row:
        slots[node["slot"]] = node
    return slots


def _siblings(levels: list[list[str]], slot: int) -> list[dict]:
    """What stands left and right of a node and of its ancestors, up to the last level but one."""
    out = []
    for level in levels[:-1]:
        first = slot - slot % ARITY
        out.append({"left": "".join(level[first:slot]), "right": "".join(level[slot + 1:first + ARITY])})
        slot //= ARITY
    return out


def _tops(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The one node that the nodes of a row become."""
    for rows, takes in batches:
        yield pa.array([_levels([x["hash"] for x in _slots(row.as_py())], take.as_py())[-1][0]
                        for row, take in zip(rows, takes)], pa.string())


def _proofs(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Each node of a row with its siblings up to the root: those within the row, then the row's own."""
    side = pa.struct([("left", pa.string()), ("right", pa.string())])
    kind = pa.list_(pa.struct([("slot", pa.int32()), ("doc_id", pa.int64()), ("hash", pa.string()),
                               ("other", pa.string()), ("proof", pa.list_(side))]))
    for rows, takes, proofs in batches:
        for row, take, above in zip(rows, takes, proofs):  # one row at a time: proofs are long
            nodes, above = _slots(row.as_py()), above.as_py()
            levels = _levels([x["hash"] for x in nodes], take.as_py())
            yield pa.array([[x | {"proof": _siblings(levels, i) + above} for i, x in enumerate(nodes)]], kind)


def _tree(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """nodes: ``g``, ``place``, ``doc_id``, ``hash``, ``other``. The root of each ``g`` (``g``, ``hash``), and from
    the leaves up each round's rows: ``g``, ``row``, ``nodes``, ``take`` (levels reduced in the row), ``left``."""
    node = F.struct((F.col("place") % SPAN).cast("int").alias("slot"), "doc_id", "hash", "other")
    # the least number of levels that make one node of a group's
    powers = F.array(*[F.lit(ARITY ** d).cast("bigint") for d in range(39)])
    rounds, tops, now, levels, most = [], [], nodes, None, 0
    while True:
        rows = materialize(now.groupBy("g", F.expr(f"place div {SPAN}").alias("row")).agg(
            F.collect_list(node).alias("nodes")), "manifest-rows")  # SPAN nodes at most, as places differ
        if levels is None:
            levels = materialize(rows.groupBy("g").agg(F.sum(F.size("nodes")).alias("n")).select(
                "g", F.size(F.filter(powers, lambda p: p < F.col("n"))).alias("levels")), "manifest-levels")
            most = levels.agg(F.max("levels")).first()[0] or 0
        done = ROUND_LEVELS * len(rounds)
        left = F.greatest(F.col("levels") - done - ROUND_LEVELS, F.lit(0))
        rows = rows.join(levels, "g").select("g", "row", "nodes", left.alias("left"),
                                             F.least(F.col("levels") - done, F.lit(ROUND_LEVELS)).alias("take"))
        rounds.append(rows)
        tops.append(materialize(rows.select("g", F.col("row").alias("place"), "left", F.arrow_udf(_tops, "string")(
            "nodes", "take").alias("hash")), "manifest-tops"))
        if most <= done + ROUND_LEVELS:
            break
        now = tops[-1].where(F.col("left") > 0).withColumns({
            "doc_id": F.lit(None).cast("bigint"), "other": F.lit(None).cast("string")})
    roots = tops[0].where(F.col("left") == 0)
    for t in tops[1:]:
        roots = roots.unionByName(t.where(F.col("left") == 0))
    return roots.select("g", "hash"), rounds


def _descend(rounds: list[DataFrame], roots: DataFrame) -> DataFrame:
    """roots: ``g``, ``proof`` (of its root) and others. The nodes of the lowest round with their proofs."""
    others = [c for c in roots.columns if c not in ("g", "proof")]
    proved = F.arrow_udf(_proofs, _NODES)("nodes", "take", "proof")
    above = roots.withColumn("row", F.lit(0).cast("bigint"))
    for k in range(len(rounds) - 1, -1, -1):
        ended = roots.withColumn("row", F.lit(0).cast("bigint")).join(
            rounds[k].where((F.col("left") == 0) & (F.col("row") == 0)).select("g"), "g", "left_semi")
        # rows of groups that end in this round hang on their root, others on the nodes of the next
        here = ended if k == len(rounds) - 1 else above.unionByName(ended)
        nodes = rounds[k].join(here, ["g", "row"]).select("g", "row", *others, F.inline(proved))
        above = nodes.select("g", (F.col("row") * SPAN + F.col("slot")).alias("row"), "proof", *others)
    return nodes


def manifest(docs: DataFrame, other: Column | None = None) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``source``, ``leaf``, ``subroot`` (of its source), ``root``, ``proof``
    (from the leaf to the root, the siblings left and right of its node on each level) and ``other``, a
    string computed from the row (null unless given). ``fold`` leads from a leaf and a proof to the root."""
    leaves = docs.select(
        F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source")).alias("g"),
        F.coalesce(F.shiftright("doc_id", _WORD_BITS), F.lit(_NO_ID)).alias("w"),
        F.coalesce(F.col("doc_id").bitwiseAND(63), F.lit(0)).cast("int").alias("bit"),
        "doc_id", leaf().alias("hash"), (F.lit(None) if other is None else other).cast("string").alias("other"))
    subroots, rounds = _tree(_places(leaves))
    sources = number_in_order(subroots, [F.col("g")], "place", "manifest-sources").select(
        F.lit("").alias("g"), "place", F.lit(None).cast("bigint").alias("doc_id"), "hash", F.col("g").alias("other"))
    roots, upper = _tree(sources)
    proved = materialize(_descend(upper, roots.select("g", F.col("hash").alias("root"), F.array().cast(_PROOF).alias("proof"))).select(
        F.col("other").alias("g"), F.col("hash").alias("subroot"), "root", "proof"), "manifest-subroots")
    return _descend(rounds, proved).select(
        "doc_id", F.when(F.col("g") == "", F.lit(None)).otherwise(F.substring("g", 2, 2**31 - 1)).alias("source"),
        F.col("hash").alias("leaf"), "subroot", "root", "proof", "other")


def verify(made: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose leaf isn't in the manifest ``made`` of the same table, and manifest rows whose
    leaf ``docs`` lacks: ``doc_id``, ``leaf``, ``found`` (rows more in ``docs``; negative if fewer)."""
    now = docs.select("doc_id", leaf().alias("leaf"), F.lit(1).alias("d"))
    before = made.select("doc_id", "leaf", F.lit(-1).alias("d"))
    return now.unionByName(before).groupBy("doc_id", "leaf").agg(F.sum("d").alias("found")).where("found <> 0")
