"""Chat formatting after collapsing cumulative snapshots, JVM-side only.

Logs often hold a conversation several times, each snapshot some turns longer. Every turn gets two
hashes of its position, role and text; their running XOR is the hash of the turn prefix up to it.
A conversation whose whole hash is the prefix hash of a longer one is anti-joined away, and of
equal conversations the least id stays. What stays is rendered.

Only hashes move until the maximal conversations are known; the prefixes and the whole hashes are
pre-aggregated, so a first turn or a conversation that a third of the log shares is one row in the
joins. Texts move once, by conversation, and only those of maximal conversations are gathered: one
conversation is one row of the result by definition.

Defined results: turns are ordered by turn (nulls first), role and hash of the text; a turn logged
twice counts once; null role and text are empty; rows without a conversation id belong to no
conversation and are left out; an empty table gives an empty table; columns other than these four
are not read. Markers within texts are broken up so that a text can't end its turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Markers of the rendered form.
TURN_START, TURN_END, MARKER, BROKEN_MARKER = "<|im_start|>", "<|im_end|>", "<|", "< |"


def _turns(log: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    return log.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.xxhash64(role, text).alias("h"), F.xxhash64(F.lit("again"), text, role).alias("h2"), text.alias("text"))


def prefixes(turns: DataFrame) -> DataFrame:
    """Rows (conv, n, place, a, b): the hashes of each turn prefix of a conversation of n turns. The two come from
    hashes of the texts that don't depend on each other."""
    # gathered are hashes, not texts
    per = turns.groupBy("conv").agg(F.sort_array(F.collect_set(F.struct("turn", "role", "h", "h2"))).alias("all"))
    each = per.select("conv", F.size("all").alias("n"), F.posexplode("all").alias("place", "t"))
    here = [F.col("place"), F.col("t.role")]
    upto = Window.partitionBy("conv").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return each.select("conv", "n", (F.col("place") + 1).alias("place"),
                       F.bit_xor(F.xxhash64(F.lit("a"), *here, F.col("t.h"))).over(upto).alias("a"),
                       F.bit_xor(F.xxhash64(F.lit("b"), *here, F.col("t.h2"))).over(upto).alias("b"))


def maximal(log: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv, n_turns, n_equal) of the conversations that are no proper prefix of another, equal ones
    once (n_equal: how many there were)."""
    every = prefixes(_turns(log, id_col, turn_col, role_col, text_col))
    whole = every.where("place = n").groupBy("n", "a", "b").agg(F.min("conv").alias("conv"),
                                                               F.count(F.lit(1)).alias("n_equal"))
    proper = every.where("place < n").select(F.col("place").alias("n"), "a", "b").distinct()
    return whole.join(proper, ["n", "a", "b"], "left_anti").select(
        "conv", F.col("n").cast("bigint").alias("n_turns"), "n_equal")


def render(turns: Column) -> Column:
    """turns: array of structs with role and text."""
    safe = lambda c: F.replace(c, F.lit(MARKER), F.lit(BROKEN_MARKER))
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(TURN_START), safe(t.role), F.lit("\n"), safe(t.text), F.lit(TURN_END + "\n"))), "")


def format_chats(log: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(id, n_turns, n_equal, rendered) of the maximal conversations."""
    keep = maximal(log, id_col, turn_col, role_col, text_col)
    turns = _turns(log, id_col, turn_col, role_col, text_col).join(keep, "conv")
    per = turns.groupBy("conv", "n_turns", "n_equal").agg(
        F.sort_array(F.collect_set(F.struct("turn", "role", "h", "text"))).alias("all"))
    return per.select(F.col("conv").alias(id_col), "n_turns", "n_equal", render(F.col("all")).alias("rendered"))
