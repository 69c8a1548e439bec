"""A2 audio-job manifest (N2 + I3), G3 ordered gather of produced files, J5 attach."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import media_id, media_name_sql, with_slug
from ..functions.text import strip_sql
from .notes import explode_examples
from .numbering import ordered_gather

KEYS = ["deck_id", "line_no"]


def audio_jobs(cards: DataFrame, keys: list[str] = KEYS, card: str = "card",
               audio_col: str = "generate_audio") -> DataFrame:
    """A2: one job per example sentence of every card whose deck has audio on:
    ``(keys..., example_no, text, file_name, media_id, audio_model, audio_voice, error)``.

    The file name is derived from the content, so identical sentences of
    identical cards share one file; ``media_id`` also holds the model and the
    voice, so decks with other voices have files of their own. ``error`` is ``blank_audio_text`` for a blank
    sentence (F3); such jobs are kept as data and skipped by ``synthesize``."""
    on = cards.filter(F.coalesce(F.col(audio_col), F.lit(True))) if audio_col in cards.columns else cards
    extra = ["audio_model", "audio_voice"]
    for c in extra:
        on = on.withColumn(c, F.coalesce(F.col(c) if c in on.columns else F.lit(None), F.lit("")))
    named = with_slug(on.select(*keys, card, *extra), F.col(f"{card}.source"), "_slug")
    ex = explode_examples(named, [*keys, *extra, "_slug"], card)
    name = media_name_sql("_slug", f"{card}.source", f"{card}.target_core", "example_no", "target")
    return ex.select(*keys, "example_no", F.expr(strip_sql("target")).alias("text"),
                     F.expr(name).alias("file_name"), *extra) \
        .withColumn("media_id", media_id(*[F.col(c) for c in ("file_name", *extra)])) \
        .withColumn("error", F.when(F.col("text") == "", F.lit("blank_audio_text")))


def audio_job_count(card: str = "card", audio_col: str = "generate_audio") -> Column:
    """How many rows ``audio_jobs`` makes of a card."""
    return F.when(F.coalesce(F.col(audio_col), F.lit(True)), F.size(F.coalesce(
        F.transform(f"{card}.examples", lambda _: F.lit(1)), F.array().cast("array<int>")))).otherwise(0)


def attach_audio(cards: DataFrame, jobs: DataFrame, media: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """G3 + J5: ``audio_files`` = the produced files of each card, in example
    order; a card without produced files (audio off, or every job failed) gets
    an empty array, never NULL. ``media`` is ``(media_id, error)``; a file
    counts when its synthesis has no error."""
    produced = media.filter(F.col("error").isNull()).select("media_id").distinct()
    done = jobs.filter(F.col("error").isNull()).join(produced, "media_id", "left_semi")
    gathered = ordered_gather(done, keys, "example_no", "file_name", "audio_files")
    return (cards.join(gathered, keys, "left")
            .withColumn("audio_files", F.coalesce("audio_files", F.array().cast("array<string>"))))
