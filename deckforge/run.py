"""The whole deck build as one Spark job graph (the reference's full run, for
many decks at once).

items + deck settings (+ side files)
  -> V1 settings, S2 side files, F1/W1 items, F2 empty sources
  -> R1/R2 requests                                [materialized]
  -> G7 generate (caller's function)               [each wave appended to out_dir/responses]
  -> S3/V2 validate, J4 match, F5-F7 normalize     [materialized]
  -> A2 audio jobs, G8 synthesize (caller's fn)    [each wave appended to out_dir/media]
  -> G3/J5 attach audio, T1-T8 render, S4 decks, G1 summary, S6 names, quality report

A rerun asks again only for requests without a valid card (new, changed, failed
or rejected ones) and for media that the table doesn't hold.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .operators.audio import attach_audio, audio_job_count, audio_jobs
from .operators.calls import call_errors, generate, open_results, synthesize
from .operators.cards import match_responses, normalize_cards
from .operators.clean import active_lines, empty_sources, require_active_sources
from .operators.config import validate_configs, with_deck_tags
from .operators.notes import note_item_count, render_notes
from .operators.prompts import build_requests, system_prompts
from .operators.quality import quality_report
from .operators.sinks import deck_table, resolve_output_names, upsert_decks, write_decks
from .operators.summary import run_summary, stage_counts
from .operators.validate import reject_rows, validate_cards
from .schemas import GENERATE_OUT, SYNTH_OUT
from .session import materialize
from .sources.side_files import OK, read_side_files


@dataclass
class DeckRun:
    summary: DataFrame
    configs: DataFrame
    side_files: DataFrame
    empty_sources: DataFrame
    rejects: DataFrame
    call_errors: DataFrame
    unanswered: DataFrame
    decks: DataFrame
    quality: DataFrame
    notes_path: str
    notes_version: int
    media_path: str


def _counters(stage: DataFrame, **counts: Column) -> DataFrame:
    """The stage's counters, written beside it."""
    return materialize(stage_counts(stage, **counts), "counters")


def deck_cards(matched: DataFrame, decks: DataFrame, instructions: DataFrame | None) -> DataFrame:
    """F5-F7 over the valid answers of requests (``match_responses``), with their deck's flags.
    instructions: ``deck_id``, ``customization``."""
    flags = decks.select("deck_id", "minimal_cards", "generate_audio", "audio_model", "audio_voice")
    if instructions is not None:
        flags = flags.join(instructions.select("deck_id", "customization"), "deck_id", "left")
    else:
        flags = flags.withColumn("customization", F.lit(None).cast("array<string>"))
    return normalize_cards(matched.filter("valid").join(flags, "deck_id")).select(
        "deck_id", "line_no", "item", "card", "minimal_cards", "generate_audio", "audio_model", "audio_voice")


def deck_notes(cards: DataFrame, decks: DataFrame, jobs: DataFrame, available: DataFrame) -> DataFrame:
    """The notes of cards, with those of their audio files that are ``available``."""
    tags = with_deck_tags(decks).select("deck_id", "tags")
    return render_notes(attach_audio(cards, jobs, available).join(tags, "deck_id"), ["deck_id", "line_no"])


def run_decks(lines: DataFrame, raw_configs: DataFrame, make_card_fn, make_speech_fn, out_dir: str,
              max_parallel: int = 5, existing_outputs: DataFrame | None = None,
              read_side: bool = True, strict_sources: bool = False, update: bool = False,
              side_base_uri: str | None = None) -> DeckRun:
    """Build every deck. ``lines`` is ``(deck_id, pos, raw)``; ``raw_configs``
    holds string settings per deck (see ``schemas.RAW_CONFIG``). ``update``
    keeps the notes of the current deck table that this run doesn't make
    (``upsert_decks``); ``side_base_uri`` is the folder of relative side files."""
    spark = lines.sparkSession
    checked = materialize(validate_configs(raw_configs), "configs")  # small; read by many branches
    decks = checked.filter("valid")

    # Side files named by each deck's settings.
    if read_side:
        manifest = decks.select("deck_id", "minimal_cards", F.expr(
            "stack(2, 'customization', customization_path, 'blacklist', blacklist_path) AS (kind, path)"))
        side = materialize(read_side_files(manifest, minimal_col="minimal_cards", base_uri=side_base_uri), "side")
        bad = side.filter(F.col("found") & (F.col("outcome") != OK)).groupBy("deck_id").agg(
            F.min(F.concat_ws(": ", "kind", "outcome")).alias("side_file"))
        instr = side.groupBy("deck_id").agg(
            F.max(F.when(F.col("kind") == "customization", F.col("lines"))).alias("customization"),
            F.max(F.when(F.col("kind") == "blacklist", F.col("lines"))).alias("blacklist"))
        decks = decks.join(bad, "deck_id", "left_anti")
    else:
        side = spark.createDataFrame([], "deck_id long, kind string, path string")
        bad = spark.createDataFrame([], "deck_id long, side_file string")
        instr = None

    # Active items, numbered per deck.
    items = materialize(active_lines(lines, ["deck_id"]), "items")  # numbered once; counted, dealt out and asked for
    counters = [_counters(items, n_items=F.lit(1))]
    empty = empty_sources(lines, ["deck_id"], expected=decks.select("deck_id"))
    if strict_sources:  # stop before any paid call, like the single-deck tool
        require_active_sources(empty)

    # R1 / R2, then G7 with the caller's function.
    prompts = materialize(system_prompts(decks, instr), "prompts")  # one small row per deck, used twice
    requests = materialize(build_requests(items, prompts), "requests")
    # Request ids hash everything a call depends on, so valid cards kept from an
    # earlier run are reused; what was refused or malformed is asked again.
    responses_path = os.path.join(out_dir, "responses")
    earlier = open_results(spark, responses_path, GENERATE_OUT)
    done = validate_cards(earlier).filter("valid").select("request_id").distinct()
    tries = earlier.groupBy("request_id").agg((F.max("attempt") + 1).alias("attempt"))
    todo = requests.join(tries, "request_id", "left").withColumn("attempt", F.coalesce("attempt", F.lit(1)))
    responses = generate(todo, make_card_fn, max_parallel, prompts=prompts, done=done, out_path=responses_path)

    # A valid answer goes before one that isn't, then the earliest attempt.
    received = validate_cards(responses.filter("error IS NULL").select("request_id", "attempt", "body"))
    matched, unanswered = match_responses(requests, received, order_col="attempt")
    checked_cards, unanswered = materialize(matched, "checked"), materialize(unanswered, "unanswered")
    failed = materialize(call_errors(responses, unanswered), "call-errors")
    valid = F.col("valid").cast("int")
    counters += [_counters(checked_cards, n_accepted=valid, n_rejected=1 - valid),
                 _counters(unanswered, n_unanswered=F.lit(1)), _counters(failed, n_call_errors=F.lit(1))]
    cards = materialize(deck_cards(checked_cards, decks, instr), "cards")
    counters.append(_counters(cards, n_audio_jobs=audio_job_count(), n_note_items=note_item_count()))

    # A2, G8, S5. Media are keyed by sentence, model and voice: what the media
    # table holds is not synthesized again, a changed voice is.
    jobs = audio_jobs(cards)
    media_path = os.path.join(out_dir, "media")
    held = open_results(spark, media_path, SYNTH_OUT).select("media_id", "error")
    available = synthesize(jobs, make_speech_fn, max_parallel, done=held, out_path=media_path).select(
        "media_id", "error")

    # G3/J5, I5, T1-T8, S4.
    notes = deck_notes(cards, decks, jobs, available)
    notes_path = os.path.join(out_dir, "decks")
    notes_version = upsert_decks(notes, notes_path)[0] if update else write_decks(notes, notes_path)

    # G1 + S6.
    existing = existing_outputs if existing_outputs is not None else spark.createDataFrame([], "path string")
    names = resolve_output_names(decks, existing).select("deck_id", "output_name")
    summary = run_summary(checked, counters, bad)
    summary = summary.join(names, "deck_id", "left")

    # Content findings (lazy; computed only when used).
    blacklist = (instr.select("deck_id", F.explode(F.coalesce("blacklist", F.array().cast("array<string>")))
                              .alias("entry")) if instr is not None else None)
    quality = quality_report(cards, decks.select("deck_id", "cefr_level"), blacklist)
    return DeckRun(summary=summary, configs=checked, side_files=side, empty_sources=empty,
                   rejects=reject_rows(checked_cards), call_errors=failed, unanswered=unanswered,
                   decks=deck_table(checked, names), quality=quality, notes_path=notes_path,
                   notes_version=notes_version, media_path=media_path)
