"""G1 run summary per deck (W2 progress lives in numbering.with_progress)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNTS = ["n_items", "n_accepted", "n_rejected", "n_unanswered", "n_call_errors", "n_audio_jobs", "n_note_items"]


def stage_counts(stage: DataFrame, key: str = "deck_id", **counts: Column) -> DataFrame:
    """Counters of one stage: per deck all of ``COUNTS``, those named as the sum of a column over the stage's rows and
    the rest 0. Counters of several stages (or of parts of one) are merged by adding them up."""
    sums = stage.groupBy(F.col(key).alias("_deck")).agg(*[F.sum(c.cast("bigint")).alias(n) for n, c in counts.items()])
    return sums.select("_deck", *[F.col(n) if n in counts else F.lit(0).cast("bigint").alias(n) for n in COUNTS])


def run_summary(configs: DataFrame, counters: list[DataFrame], bad_side_files: DataFrame | None = None,
                key: str = "deck_id") -> DataFrame:
    """One row per configured deck, including decks with nothing to show: ``valid``, the counts, and
    ``side_file`` (why a deck was dropped for a side file; NULL if it wasn't).

    ``counters`` are the ``stage_counts`` of the stages, made where each stage was written: one small row per deck
    and stage is all that is read here."""
    every = counters[0]
    for c in counters[1:]:
        every = every.unionByName(c)
    per_deck = every.groupBy("_deck").agg(*[F.sum(c).alias(c) for c in COUNTS])
    out = configs.select(key, F.col("valid").cast("string").alias("valid")).join(
        per_deck, F.col(key) == F.col("_deck"), "left")
    if bad_side_files is not None:
        out = out.join(bad_side_files.select(F.col(key).alias("_bad"), "side_file"), F.col(key) == F.col("_bad"), "left")
    else:
        out = out.withColumn("side_file", F.lit(None).cast("string"))
    return out.select(key, "valid", "side_file", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                                                   for c in COUNTS])
