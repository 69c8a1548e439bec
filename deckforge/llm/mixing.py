"""Mixing sources to target weights by entropy balancing.

Each source's target is its share of all words by weight, at most ``MAX_COPIES`` times its own
words, the excess shared again among the others. Rates of documents are those closest (in
Kullback-Leibler divergence) to one copy each that meet the targets: the dual of this problem is
convex with one multiplier for each source, and a document's rate is exp(multiplier * size / mean
size), at most ``MAX_COPIES``. Newton steps, kept within a bracket, solve the dual: one grouped sum
each over a histogram of (source, size), so the texts are read once and a source with a third of
all rows is pre-aggregated. Rates are then rounded to copies: in each source from the largest size
to the smallest, a size's copies carry over what the larger ones left, so a source ends within
half of its smallest sizes of its target where its documents allow it. Copies of a size are dealt
evenly over its documents in an order by blocks of a hash of the id.

Defined results: a null text has size 0; documents of size 0 get one copy (of nothing); a null
source is a source of its own, sorted last; a source without words has target 0; rows that share
id, source and size get the same number of copies (rows without an id count as sharing it); an
empty table gives an empty table; texts of any length are counted whole; columns of the input named like the output
column (or like a working column) are replaced (or kept). Reruns give the same copies: multipliers are
rounded before they are used, as sums of doubles depend on the order of rows in their last digits. A source's
sizes are rounded to copies in one group, which has a row for each different size, not for each document.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import fresh_name, number_in_order, with_fresh, words_in

MAX_COPIES = 3
WEIGHTS = (5, 2, 1)
#: Newton steps end when every source's expected words are this close to its target.
TOLERANCE = 1e-7
MAX_STEPS = 60
#: Digits of a multiplier that are used.
MULTIPLIER_DIGITS = 9
STEPS_A_JOB = 3
#: Documents of one source and size are numbered in blocks of about this many.
BLOCK_ROWS = 10_000


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """sizes: (source, size) rows. Returns (source, source_size, n, target) for each source.

    Every turn caps at least one source; a turn is one sum over the sources, whose two numbers
    alone reach the driver."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    order = [F.col("source").isNull(), F.col("source")]
    placed = number_in_order(per, order, "place", "sources")
    cycle = F.array(*[F.lit(w).cast("bigint") for w in weights])  # times a number of words: beyond an int
    table = materialize(placed.withColumn("weight", F.element_at(cycle, (F.pmod("place", F.lit(len(weights))) + 1)
                                                                 .cast("int"))).drop("place"), "source_weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    limit = max_copies * F.col("source_size")
    free, capped_words, free_weight = F.lit(True), 0, None
    while True:
        words, weight = table.where(~free).agg(F.sum(limit)).first()[0] or 0, table.where(free).agg(
            F.sum("weight")).first()[0] or 0
        if (words, weight) == (capped_words, free_weight):
            break
        capped_words, free_weight = words, weight
        # whole numbers on both sides: limit < weight * rest / free_weight
        free = F.col("weight") * F.lit(total - words) <= limit * F.lit(max(weight, 1))
        if not weight:
            break
    share = (F.col("weight") * F.lit(total - capped_words)).cast("double") / F.lit(float(max(free_weight or 0, 1)))
    return table.select("source", "source_size", "n", F.when(free, share).otherwise(limit.cast("double"))
                        .alias("target"))


def _tilt(hist: DataFrame, goals: DataFrame, max_copies: int) -> DataFrame:
    """(key, lam) for each source: the multiplier at which its expected words meet its target."""
    cap = float(max_copies)
    # any multiplier beyond the bracket's ends gives too many or too few words
    state = materialize(hist.groupBy("key").agg(F.sum("rows").alias("n"), F.min(F.when(F.col("size") > 0, F.col(
        "size"))).alias("least")).join(goals, "key").where((F.col("source_size") > 0) & (F.col("target") > 0)).select(
            "key", (F.col("source_size") / F.col("n")).alias("mean"), (F.col("target") / F.col("source_size") *
                                                                       F.col("n")).alias("goal"),
            F.lit(0.0).alias("lam"), (-F.col("n") / (math.e * (F.col("target") / F.col("source_size") *
                                                              F.col("n"))) - 1.0).alias("lo"),
            (F.lit(math.log(cap)) * F.col("source_size") / F.col("n") / F.col("least")).alias("hi"),
            (F.col("target") >= cap * F.col("source_size")).alias("full"), F.lit(math.inf).alias("off")), "tilt")
    steps = 0
    while steps < MAX_STEPS:
        for _ in range(STEPS_A_JOB):
            u = F.col("size") / F.col("mean")
            rate = F.least(F.exp(F.least(F.col("lam") * u, F.lit(math.log(cap) + 1.0))), F.lit(cap))
            moved = hist.join(state, "key").groupBy("key").agg(
                F.sum(F.col("rows") * u * rate).alias("got"),
                F.sum(F.when(rate < cap, F.col("rows") * u * u * rate).otherwise(0.0)).alias("slope"))
            state = state.join(moved, "key")
            over = F.col("got") > F.col("goal")
            lo, hi = F.when(over, F.col("lo")).otherwise(F.col("lam")), F.when(over, F.col("lam")).otherwise(
                F.col("hi"))
            newton = F.col("lam") - F.try_divide(F.col("got") - F.col("goal"), F.col("slope"))
            inside = F.coalesce((newton > lo) & (newton < hi), F.lit(False))
            state = state.select("key", "mean", "goal", F.when(inside, newton).otherwise((lo + hi) / 2).alias("lam"),
                                 lo.alias("lo"), hi.alias("hi"), "full",
                                 (F.abs(F.col("got") - F.col("goal")) / F.col("goal")).alias("off"))
            steps += 1
        state = materialize(state, "tilt")
        worst = state.where("not full").agg(F.max("off")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    return state


def _round(max_copies: int):
    def carry(pdf: pd.DataFrame) -> pd.DataFrame:
        """One source's sizes, the largest first: copies of each, with what the larger ones left over."""
        pdf = pdf.sort_values(["weight", "size"], ascending=False, kind="stable")
        left, out = 0.0, []
        for weight, units, rate in zip(pdf["weight"], pdf["units"], pdf["rate"], strict=True):
            if weight == 0:
                out.append(int(units))
                continue
            wish = units * rate + left / weight
            copies = min(max(math.floor(wish + 0.5), 0), max_copies * int(units))
            left = (wish - copies) * weight
            out.append(copies)
        return pdf[["key", "size", "same", "units"]].assign(copies=out)
    return carry


def copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
           weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """For each distinct (id, source, size): ``id``, ``key`` (of the source), ``size``, ``same`` (rows that
    share them), ``copies`` (of each such row), ``source_size`` and ``target``."""
    narrow = materialize(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                     words_in(text_col).alias("size")), "sizes")
    goals = materialize(targets(narrow.select("source", "size"), weights, max_copies)
                        .select(_key(F.col("source")).alias("key"), "source_size", "target"), "targets")
    units = narrow.select("id", _key(F.col("source")).alias("key"), "size").groupBy("id", "key", "size").agg(
        F.count(F.lit(1)).alias("same"))
    hist = materialize(units.groupBy("key", "size", "same").agg(F.count(F.lit(1)).alias("units")).withColumn(
        "rows", F.col("units") * F.col("same")), "histogram")
    tilt = _tilt(hist, goals, max_copies)
    lam = F.round("lam", MULTIPLIER_DIGITS)
    rate = F.when(F.col("full"), F.lit(float(max_copies))).when(F.col("lam").isNull(), F.lit(1.0)).otherwise(
        F.least(F.exp(F.least(lam * F.col("size") / F.col("mean"), F.lit(math.log(max_copies) + 1.0))),
                F.lit(float(max_copies))))
    rated = hist.join(tilt.select("key", "mean", "lam", "full"), "key", "left").select(
        "key", "size", "same", (F.col("size") * F.col("same")).alias("weight"), "units", rate.alias("rate"))
    # a source's group holds one row for each of its sizes, however many documents it has
    rounded = rated.groupBy("key").applyInPandas(
        _round(max_copies), "key string, size bigint, same bigint, units bigint, copies bigint")
    rounded = materialize(rounded, "rounded")
    cls = ["key", "size", "same"]
    dealt = units.join(rounded, cls).withColumn("block", F.pmod(F.xxhash64("id", F.lit("mix")), F.ceil(
        F.col("units") / BLOCK_ROWS)))
    dealt = materialize(dealt, "units")
    blocks = dealt.groupBy(*cls, "block").agg(F.count(F.lit(1)).alias("in_block"))
    ahead = blocks.select(*cls, "block", F.coalesce(F.sum("in_block").over(
        Window.partitionBy(*cls).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    place = F.col("ahead") + F.row_number().over(Window.partitionBy(*cls, "block").orderBy(
        F.xxhash64("id", F.lit("order")), "id"))
    numbered = dealt.join(ahead, [*cls, "block"]).withColumn("place", place)
    # place * copies / units in whole numbers: the first places of a size share its copies evenly
    upto = F.expr("(place * copies) div units - ((place - 1) * copies) div units")
    return numbered.withColumn("copies", upto).join(goals, "key").select(
        "id", "key", "size", "same", "copies", "source_size", "target")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        out_col: str = "mix", weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``docs`` with a struct column: size, source_size, target, copies and taken (words)."""
    names = [fresh_name(docs, x) for x in ("_mix_id", "_mix_key", "_mix_size", "_mix")]
    same_id, same_key, same_size, said = names
    dealt = copies(docs, id_col, source_col, text_col, weights, max_copies).select(
        F.col("id").alias(same_id), F.col("key").alias(same_key), F.col("size").alias(same_size),
        F.struct("size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
        .alias(said))
    rows = docs.drop(*[c for c in docs.columns if c.lower() == out_col.lower()])
    joined = rows.join(dealt, rows[id_col].eqNullSafe(F.col(same_id)) & (_key(rows[source_col]) == F.col(same_key))
                       & (words_in(rows[text_col]) == F.col(same_size)))
    return with_fresh(joined, out_col, F.col(said)).drop(*names)


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: every document as often as it was taken, with the columns of ``docs``."""
    name = fresh_name(docs, "_mix_of")
    taken = mix(docs, id_col, source_col, text_col, name)
    return taken.withColumn(name, F.explode(F.expr(f"array_repeat(0, cast({name}.copies as int))"))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
