"""Near-duplicates: an inverted join of MinHash signature coordinates, confirmed on full sets.

1. Every text's set of distinct word shingles gives a digest and ``COORDINATES`` minima. Texts
   with equal sets form a class; only one row of each class goes on.
2. Classes are posted under each (coordinate, minimum). A posting list of one entry can't link
   anything, so a class with fewer other postings than must match has no partner and goes.
3. Postings are sorted from the rarest list to the most frequent. Two classes that agree in m
   coordinates share one of the first (postings - m + 1) of either: only these prefixes are
   merged, and the long lists of common passages are skipped.
4. Each prefix list names its smallest member as hub; the classes under a hub are a family. Two
   classes that share a prefix list are in one family, so families hold every candidate pair but
   are linear in size: no pair is written out.
5. A family is cut into blocks of bounded size, each with the hub. A task reads the texts of a
   block, merges the shingle lists by counting collisions, and joins what reaches the similarity
   on the full sets until all members are in one component or have been compared with all others.
6. In families of several blocks, members that aren't in the family's largest component are then
   compared with the other blocks: coordinate collisions are counted on the signatures, and the texts of
   members that reach the number of matches with another component are compared as in step 5. So a family of pages
   that merely share a template reads no text here. Members within one component need no comparison.

A pair at the similarity exactly misses step 3 with a probability below ``MISS`` (binomial over
the coordinates); pairs of greater similarity less often. All links found are exact up to
collisions of 64-bit shingle hashes.

Work grows linearly but for step 6, which counts collisions of (members outside the largest component) times
(members) in bounded blocks, for families beyond one block only; texts move there only of pairs that collide enough.

Defined results: a null or blank text has an empty set and is linked with nothing; repeated rows
and rows sharing an id are separate members of their class; a row without id is linked like any
other but never names a component (a component without any id gets a null). Columns other than id
and text are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import blocks, concat, fresh_name, list_array, struct_array, utf8
from .components import components

SHINGLE_WORDS = 3
SIMILARITY_PERCENT = 85
COORDINATES = 48
#: The coordinates that must agree are as many as leave a pair at the similarity unseen this rarely.
MISS = 1e-7
#: A block holds about so many members, and about so many shingles.
BLOCK_MEMBERS = 400
BLOCK_SHINGLES = 400_000
BLOCK_BYTES = 1 << 20
_LOW = np.uint64(63)  # the coordinate's number is kept in a minimum's low bits


def matches_needed(percent: int, coordinates: int) -> int:
    """The most coordinates that a pair at the similarity fails to share with a probability below ``MISS``."""
    p, tail = percent / 100, 0.0
    for m in range(coordinates):
        tail += comb(coordinates, m) * p**m * (1 - p) ** (coordinates - m)
        if tail >= MISS:
            return max(m, 1)
    return coordinates


def _odd(seed: int, n: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(defaultdict):
    """Word numbers of a block and, later, their hashes."""

    def __init__(self) -> None:
        super().__init__(count().__next__)


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes. A to Z count as lower case; a text of
    fewer words than ``width`` has one shingle, its whole sequence; a text without words has none."""
    number = _WordHashes()
    flat: list[int] = []
    sizes: list[int] = []
    for t in texts:
        found = (t or b"").lower().split()
        sizes.append(len(found))
        flat.extend(map(number.__getitem__, found))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
    words = hashes[np.array(flat, np.int64)]
    factors = _odd(width, width)
    mixed = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        mixed += words[k:k + len(mixed)] * factors[k]
    mixed ^= mixed >> np.uint64(29)
    out, at = [], 0
    for n in sizes:
        if n >= width:
            out.append(np.unique(mixed[at:at + n - width + 1]))
        elif n:
            short = (words[at:at + n] * factors[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(np.array([short ^ np.uint64(0x5851F42D4C957F2D)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def minima(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """The signature: for each coordinate its least hash, the coordinate's number in the low bits."""
    factors, masks = _odd(1, coordinates), _odd(2, coordinates)
    least = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), 1 << 14):
        part = (shingles[lo:lo + (1 << 14)] ^ masks[:, None]) * factors[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (least & ~_LOW) | np.arange(coordinates, dtype=np.uint64)


def _sketch(texts: list[bytes | None], width: int, coordinates: int) -> pa.StructArray:
    sets = shingle_sets(texts, width)
    keys = [minima(s, coordinates) if len(s) else np.zeros(0, np.uint64) for s in sets]
    sizes = np.fromiter(map(len, keys), np.int64, len(keys))
    flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    return struct_array({
        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
        "digest": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
        "keys": list_array(flat.view(np.int64), sizes, pa.int64())})


class _Forest:
    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        up = self.up
        while (up[up] != up).any():
            up = up[up]
        self.up = up
        return up


def link(sets: list[np.ndarray], percent: int, forest: _Forest, ask: np.ndarray, among: np.ndarray) -> None:
    """Joins in ``forest`` the sets whose intersection is at least ``percent`` of their union: each of
    ``ask`` against all of ``among``, as far as they aren't in one component yet."""
    owner = np.repeat(among, [len(sets[i]) for i in among])
    values = np.concatenate([sets[i] for i in among]) if len(among) else np.zeros(0, np.uint64)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    sizes = np.array([len(s) for s in sets])
    left = np.ones(len(sets), bool)
    within = len(ask) == len(among) and (ask == among).all()
    while True:
        roots = forest.roots()
        todo = ask[left[ask]]
        if within and len(todo):
            # members of the largest component need no turn if all others have had theirs
            todo = todo[roots[todo] != np.bincount(roots[among]).argmax()]
        if not len(todo):
            return
        i = int(todo[0])
        left[i] = False
        if (roots[among] == roots[i]).all():
            continue
        lo, hi = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
        some = hi > lo
        lo, hi = lo[some], hi[some]
        lengths = hi - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
        shared = np.bincount(owner[at], minlength=len(sets))
        linked = (shared > 0) & (100 * shared >= percent * (sizes[i] + sizes - shared)) & (roots != roots[i])
        for j in np.flatnonzero(linked):
            forest.join(i, int(j))


def _members(table: pa.Table, width: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """A group's classes once each, ascending, with their sets and whether they ask."""
    ids = table["cid"].to_numpy()
    asks = table["asks"].to_numpy(zero_copy_only=False)
    once, first, back = np.unique(ids, return_index=True, return_inverse=True)
    ask = np.zeros(len(once), bool)
    np.logical_or.at(ask, back, asks)
    texts = table["text"].take(pa.array(first)).to_pylist()
    return once, shingle_sets(texts, width), ask


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, coordinates: int) -> DataFrame:
    """Per row: a number, the id, a hash of the text by which it is found again, and the sketch; written."""
    @F.arrow_udf("struct<n_shingles:bigint,digest:binary,keys:array<bigint>>")
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield concat((_sketch(run, width, coordinates) for run in blocks(batch, BLOCK_BYTES)), pa.struct([]))

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                       sketch(utf8(text_col)).alias("s"))
    return materialize(rows.select(F.monotonically_increasing_id().alias("row"), "id", "text_hash", "s.*"), "sketches")


def families(rows: DataFrame, matches: int) -> DataFrame:
    """rows: the sketches. Returns (hub, cid, size) of all families, hubs included; written."""
    classes = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("row").alias("cid"))
    first = rows.join(classes.select("cid"), F.col("row") == F.col("cid"), "left_semi")
    postings = first.select(F.col("row").alias("cid"), F.explode("keys").alias("key"))
    shared = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several = (postings.join(shared, "key").groupBy("cid").agg(F.collect_list(F.struct("n", "key")).alias("p"))
               .where(F.size("p") >= matches))  # a signature's length at most
    prefix = several.select("cid", F.explode(F.expr(f"slice(sort_array(p), 1, size(p) - {matches} + 1)")).alias("e"))
    prefix = prefix.select("cid", F.col("e.key").alias("key"))
    prefix = materialize(prefix, "prefixes")
    hubs = prefix.groupBy("key").agg(F.min("cid").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return materialize(prefix.join(hubs.select("key", "hub"), "key").select("hub", "cid").distinct(), "families")


def class_texts(classes: DataFrame, rows: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cid, text) of the given classes, found by id and text hash; written, so that texts move by id once."""
    known = rows.select(F.col("row").alias("cid"), "id", "text_hash").join(classes, "cid")
    texts = docs.select(F.col(id_col).alias("id_"), F.xxhash64(text_col).alias("hash_"), utf8(text_col).alias("text"))
    found = known.join(texts, F.col("id").eqNullSafe(F.col("id_")) & (F.col("text_hash") == F.col("hash_")))
    return materialize(found.select("cid", "text").dropDuplicates(["cid"]), "class_texts")


def colliding(named: DataFrame, rows: DataFrame, matches: int) -> DataFrame:
    """named: members of families of several blocks (hub, block, cid, label, outside); rows: the sketches. For each
    two blocks of a family, (hub, from_block, block, cid, label, asks) of the members outside the largest component
    in one (they ask) and of those in the other that agree in ``matches`` coordinates with a member of another
    component there. Collisions are counted on signatures, whose coordinates stand in one order; members without a
    partner go, so texts are only read of those that may be linked."""
    asked = named.where("outside").select("hub", F.col("block").alias("from_block")).distinct()
    others = named.join(asked, "hub").where((F.col("block") != F.col("from_block")) & (
        ~F.col("outside") | (F.col("block") > F.col("from_block")))).select(
        "hub", "from_block", "block", "cid", "label", F.lit(False).alias("asks"))
    askers = named.where("outside").select("hub", F.col("block").alias("from_block"), "cid", "label").join(
        others.select("hub", "from_block", "block").distinct(), ["hub", "from_block"]).select(
        "hub", "from_block", "block", "cid", "label", F.lit(True).alias("asks"))
    signed = others.unionByName(askers).join(rows.select(F.col("row").alias("cid"), "keys"), "cid")
    kind = pa.schema([("hub", pa.int64()), ("from_block", pa.int32()), ("block", pa.int32()), ("cid", pa.int64()),
                      ("label", pa.int64()), ("asks", pa.bool_())])

    def collide(table: pa.Table) -> pa.Table:
        keys = np.stack(table["keys"].to_numpy())
        asks, label = table["asks"].to_numpy(zero_copy_only=False), table["label"].to_numpy()
        a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
        found = np.zeros(len(keys), bool)
        for part in np.array_split(a, max(1, len(a) // 64)):
            hits = np.zeros((len(part), len(b)), np.int16)
            for k in range(keys.shape[1]):
                hits += keys[part, k][:, None] == keys[b, k]
            near = (hits >= matches) & (label[part][:, None] != label[b])
            found[part] |= near.any(axis=1)
            found[b] |= near.any(axis=0)
        return table.select(kind.names).filter(pa.array(found)).cast(kind)

    return signed.groupBy("hub", "from_block", "block").applyInArrow(
        collide, "hub bigint, from_block int, block int, cid bigint, label bigint, asks boolean")


def _membership(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, coordinates: int,
                block_members: int, block_shingles: int) -> DataFrame:
    """One row for each row of ``docs``: row, id, text_hash, n_shingles and the label of its component."""
    rows = sketches(docs, id_col, text_col, width, coordinates)
    family = families(rows, matches_needed(percent, coordinates))
    weights = rows.select(F.col("row").alias("cid"), "n_shingles")
    sized = family.join(weights, "cid")
    cuts = sized.groupBy("hub").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w")).where("n > 1")
    cuts = cuts.select("hub", F.greatest(F.ceil(F.col("n") / block_members),
                                         F.ceil(F.col("w") / block_shingles)).cast("int").alias("blocks"))
    placed = family.join(cuts, "hub").select(
        "hub", "cid", "blocks", F.pmod(F.xxhash64("cid", F.lit("block")), F.col("blocks")).cast("int").alias("block"))
    # the hub is a member of every block
    spread = placed.where("hub != cid").select("hub", "block", "cid").unionByName(
        placed.where("hub = cid").select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                                         "cid"))

    def compare(table: pa.Table) -> pa.Table:
        ids, sets, ask = _members(table, width)
        forest = _Forest(len(ids))
        every = np.arange(len(ids))
        link(sets, percent, forest, every, every)
        return pa.table({"u": ids, "v": ids[forest.roots()]})

    texts = class_texts(placed.select("cid").distinct(), rows, docs, id_col, text_col)
    edges = spread.withColumn("asks", F.lit(True)).join(texts, "cid").groupBy("hub", "block").applyInArrow(
        compare, "u bigint, v bigint")
    labels = components(edges)

    # families of several blocks: members outside the largest component against the other blocks
    large = placed.where("blocks > 1")
    named = large.join(labels.select(F.col("u").alias("cid"), F.col("v").alias("label")), "cid", "left")
    named = materialize(named.withColumn("label", F.coalesce("label", "cid")), "large_families")
    most = named.groupBy("hub", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("hub").agg(
        F.max(F.struct("n", "label")).alias("most"))
    named = named.join(most, "hub").withColumn("outside", F.col("label") != F.col("most.label")).drop("most")
    def across(table: pa.Table) -> pa.Table:
        ids, sets, ask = _members(table, width)
        labels = dict(zip(table["cid"].to_pylist(), table["label"].to_pylist(), strict=True))
        label = np.array([labels[i] for i in ids.tolist()])
        forest = _Forest(len(ids))
        _, first, back = np.unique(label, return_index=True, return_inverse=True)
        forest.up = first[back]
        link(sets, percent, forest, np.flatnonzero(ask), np.flatnonzero(~ask))
        return pa.table({"u": label, "v": label[forest.roots()]})

    if named.where("outside").limit(1).count():
        near = materialize(colliding(named, rows, matches_needed(percent, coordinates)), "colliding")
        bridges = near.join(texts, "cid").groupBy("hub", "from_block", "block").applyInArrow(across, "u bigint, v bigint")
        labels = components(labels.unionByName(bridges))

    classes = rows.groupBy("digest").agg(F.min("row").alias("cid")).where(F.col("digest").isNotNull())
    named_classes = classes.join(labels.select(F.col("u").alias("cid"), "v"), "cid", "left").select(
        "digest", F.coalesce("v", "cid").alias("label"))
    member = rows.select("row", "id", "text_hash", "n_shingles", "digest").join(named_classes, "digest", "left")
    return member.withColumn("label", F.coalesce("label", "row")).drop("digest")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
                    percent: int = SIMILARITY_PERCENT, coordinates: int = COORDINATES,
                    block_members: int = BLOCK_MEMBERS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row for each row of ``docs``: the id, ``n_shingles``, ``component_id`` (the least id
    reachable over links) and ``kept`` (whether that is its own id)."""
    member = _membership(docs, id_col, text_col, width, percent, coordinates, block_members, block_shingles)
    least = member.groupBy("label").agg(F.min("id").alias("component_id"))
    return member.join(least, "label").select(
        F.col("id").alias(id_col), "n_shingles", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
                 percent: int = SIMILARITY_PERCENT, coordinates: int = COORDINATES) -> DataFrame:
    """One row of ``docs`` for each component: that of the least id (rows without an id come last)."""
    member = _membership(docs, id_col, text_col, width, percent, coordinates, BLOCK_MEMBERS, BLOCK_SHINGLES)
    first = member.groupBy("label").agg(F.min(F.struct(F.col("id").isNull(), "id", "row", "text_hash")).alias("f"))
    # rows of a component that share id and text are one another's copies: one stays; empty texts are components
    # of their own and all stay, so equal ones are counted
    chosen = first.select(F.col("f.id").alias("chosen_id"), F.col("f.text_hash").alias("chosen_hash")).groupBy(
        "chosen_id", "chosen_hash").agg(F.count(F.lit(1)).alias("times"))
    text_hash = fresh_name(docs, "_hash")
    names = {c: fresh_name(docs, c) for c in chosen.columns}
    chosen = chosen.withColumnsRenamed(names)
    found = docs.withColumn(text_hash, F.xxhash64(text_col)).join(
        chosen, F.col(id_col).eqNullSafe(F.col(names["chosen_id"])) & (
            F.col(text_hash) == F.col(names["chosen_hash"])))
    several = F.col(names["times"]) > 1
    once = found.where(~several).dropDuplicates([names["chosen_id"], names["chosen_hash"]])
    return once.unionByName(found.where(several)).select(*[F.col(f"`{c}`") for c in docs.columns])
