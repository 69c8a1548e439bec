"""Registered queries: each takes (spark, sf_dir) and returns a flat DataFrame.

Every query reads the driver's tables through the fixture views and runs over
them whole. Arrays are joined to strings at the end so results compare
independently of array formatting.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import note_key, stable_int_id, with_slug
from ..functions.text import capitalize_sentences
from ..operators.clean import active_lines, empty_sources, split_item
from ..operators.config import config_errors, validate_configs, with_deck_tags
from ..operators.notes import flatten_notes, render_notes
from ..session import ensure_checkpoint_dir, materialize
from ..sources.lines import active_text_lines, read_split_lines
from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# Decks in a cached block: about 10 MB of settings.
DECKS_PER_BLOCK = 50_000


def checked_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated deck settings: one small row per deck, cached because most
    queries branch from it several times (and it runs the casefold UDF).

    A cached block is checked and read whole by one task, and without a shuffle
    it is as large as the input's row group, so decks are dealt out first."""
    raw = fx.v_config(spark, sf_dir)
    blocks = -(-fx.table(spark, sf_dir, "customer").count() // DECKS_PER_BLOCK)
    return validate_configs(raw.repartition(blocks) if blocks > 1 else raw).cache()


def valid_decks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_configs(spark, sf_dir).filter("valid")


# --- lines -> items -------------------------------------------------------------

@query("active_lines")
def q_active_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active lines of every source, numbered without gaps."""
    return active_lines(fx.v_lines(spark, sf_dir), ["source_id"]).select("source_id", "line_no", "item")


@query("doc_lines")
def q_doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 F1 W1 inside each whole document text (``splitlines`` semantics)."""
    docs = fx.table(spark, sf_dir, "documents")
    return active_text_lines(docs, ["doc_id"], "text")


@query("file_lines")
def q_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 F1 W1 of text files that are read in splits: the document texts, 500 to a file, written one after the other."""
    docs = fx.table(spark, sf_dir, "documents").select(F.expr("doc_id div 500").alias("file"), "doc_id", "text")
    folder = os.path.join(ensure_checkpoint_dir(spark), f"text-{uuid.uuid4().hex}")
    docs.repartition("file").sortWithinPartitions("file", "doc_id").drop("doc_id").write.partitionBy("file").text(folder)
    lines = active_lines(read_split_lines(spark, folder), ["path"])
    return lines.select(F.regexp_extract("path", "file=([0-9]+)/", 1).cast("bigint").alias("file"), "line_no", "item")


@query("empty_sources")
def q_empty_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sources without a single active line."""
    return empty_sources(fx.v_lines(spark, sf_dir), ["source_id"])


@query("split_items")
def q_split_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + F4 over the item lines: core concept and optional vocabulary."""
    items = active_lines(fx.v_items(spark, sf_dir), ["deck_id"])
    return split_item(items).select(
        "deck_id", "line_no", "core",
        F.array_join("optional_vocab", "|").alias("optional_vocab"),
        F.size("optional_vocab").cast("bigint").alias("n_optional"))


# --- configs ---------------------------------------------------------------------

@query("valid_configs")
def q_valid_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 + V1w: normalised settings of the valid decks and their defaulted fields."""
    return valid_decks(spark, sf_dir).select(
        "deck_id", "origin_language", "target_language", "notes_language", "cefr_level",
        "reasoning_effort", "text_model", "deck_name", "output_path",
        F.col("minimal_cards").cast("string").alias("minimal_cards"),
        F.col("generate_audio").cast("string").alias("generate_audio"),
        F.col("overwrite_output").cast("string").alias("overwrite_output"),
        F.array_join("defaulted", ",").alias("defaulted"))


@query("config_errors")
def q_config_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 + V3: one row per (deck, field, error code), echoing the bad value."""
    return config_errors(checked_configs(spark, sf_dir))


@query("tags")
def q_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 + I5: the two namespaced tags of each valid deck."""
    t = with_deck_tags(valid_decks(spark, sf_dir))
    return t.select("deck_id", F.col("tags")[0].alias("lang_tag"), F.col("tags")[1].alias("level_tag"))


# --- identity and text -----------------------------------------------------------

@query("stable_ids")
def q_stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + I2: integer ids of items and decks, and note keys, for every item line."""
    items = split_item(active_lines(fx.v_items(spark, sf_dir), ["deck_id"]))
    return items.select(
        "deck_id", "line_no",
        stable_int_id(F.col("item"), "item:").alias("item_int_id"),
        stable_int_id(F.col("deck_id").cast("string"), "deck:").alias("deck_int_id"),
        note_key(F.col("item"), F.col("core"), F.upper("core")).alias("note_guid"))


@query("capitalized")
def q_capitalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 over every whole document text."""
    docs = fx.table(spark, sf_dir, "documents")
    return docs.select("doc_id", capitalize_sentences("text").alias("text"))


# --- cards -> notes --------------------------------------------------------------

def cards_with_decks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture cards joined (J1) to their valid deck's flags and tags."""
    decks = with_deck_tags(valid_decks(spark, sf_dir)).select(
        "deck_id", "minimal_cards", "generate_audio", "tags")
    return fx.v_cards(spark, sf_dir).join(decks, "deck_id")


@query("note_items")
def q_note_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every note item of every card, in rendering order."""
    return flatten_notes(fx.v_cards(spark, sf_dir), ["deck_id", "line_no"])


@query("render_notes")
def q_render_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1-T8 with I2-I5 and in-row audio names: the note fields of every card
    of a valid deck."""
    from ..functions.identity import media_name_sql
    cards = with_slug(cards_with_decks(spark, sf_dir), F.col("card.source"), "_slug")
    files = ("transform(card.examples, (e_, i_) -> "
             + media_name_sql("_slug", "card.source", "card.target_core", "i_ + 1", "e_.target") + ")")
    cards = cards.withColumn("audio_files", F.when(F.col("generate_audio"), F.expr(files)))
    notes = render_notes(cards, ["deck_id", "line_no"])
    return notes.select("deck_id", "line_no", "note_guid", "front_text", "back_text", "back_audio",
                        F.array_join("tags", " ").alias("tags"))


# --- side lines -> instructions -> prompts -> requests ------------------------------

def gathered_side_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.instructions import gather_lines
    return gather_lines(fx.v_side_lines(spark, sf_dir))


def instructions_by_deck(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.instructions import deck_instructions
    return deck_instructions(gathered_side_lines(spark, sf_dir))


@query("instructions")
def q_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per valid deck and side-file kind, the active lines in order,
    byte size, status text and warnings."""
    from ..operators.instructions import KINDS, side_file_warnings, status_text
    decks = valid_decks(spark, sf_dir).select(
        "deck_id", "minimal_cards", F.explode(F.array(*[F.lit(k) for k in KINDS])).alias("kind"))
    g = gathered_side_lines(spark, sf_dir)
    j = decks.join(g, ["deck_id", "kind"], "left")
    found = F.coalesce(F.col("found"), F.lit(False))
    return j.select(
        "deck_id", "kind", F.coalesce("n_bytes", F.lit(0)).cast("bigint").alias("n_bytes"),
        F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"),
        F.array_join(F.coalesce("lines", F.array().cast("array<string>")), "\n").alias("lines"),
        status_text(found, F.col("lines")).alias("status"),
        F.array_join(side_file_warnings(F.col("kind"), found, F.col("lines"), F.col("minimal_cards")),
                     ",").alias("warnings"))


def deck_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.prompts import system_prompts
    instr = instructions_by_deck(spark, sf_dir)
    decks = valid_decks(spark, sf_dir).join(
        instr.filter("side_too_large").select("deck_id"), "deck_id", "left_anti")
    return system_prompts(decks, instr)


def item_requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from ..operators.prompts import build_requests
    prompts = deck_prompts(spark, sf_dir)
    items = materialize(active_lines(fx.v_items(spark, sf_dir), ["deck_id"]), "items")
    return build_requests(items, prompts), prompts


@query("requests")
def q_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per active item of a valid deck; the prompt is
    compared by hash and length."""
    reqs, _ = item_requests(spark, sf_dir)
    return reqs.select("deck_id", "line_no", "request_id", F.col("prompt_id").alias("prompt_sha256"),
                       "prompt_chars", "user_content", "model", "reasoning_effort")


# --- responses -> cards ----------------------------------------------------------------

def checked_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.validate import validate_cards
    return validate_cards(fx.received(fx.v_responses(spark, sf_dir)))


@query("accepted_cards")
def q_accepted_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 V2 V2x: cleaned cards of every response that passed strict validation."""
    c = F.col("card")
    return checked_responses(spark, sf_dir).filter("valid").select(
        "request_id", c["source"].alias("source"), c["target_core"].alias("target_core"),
        c["origin_core"].alias("origin_core"),
        F.array_join(F.transform(c["examples"], lambda e: F.concat_ws(" = ", e["target"], e["origin"])),
                     " | ").alias("examples"),
        F.array_join(F.transform(c["word_family"], lambda i: i["term"]), " | ").alias("word_family"),
        F.array_join(F.transform(c["related_vocab"], lambda i: i["term"]), " | ").alias("related_vocab"),
        F.array_join(F.transform(F.concat(c["word_family"], c["related_vocab"]),
                                 lambda i: F.coalesce(i["nuance"], F.lit("~"))), " | ").alias("nuances"),
        F.array_join(F.transform(c["custom_sections"], lambda s: F.concat(
            s["title"], F.lit(": "), F.array_join(F.transform(s["items"], lambda i: i["term"]), ", "))),
            " | ").alias("custom_sections"))


@query("rejects_by_reason")
def q_rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: error counts per code over every response."""
    from ..operators.validate import rejects_by_reason
    return rejects_by_reason(checked_responses(spark, sf_dir))


@query("reject_details")
def q_reject_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 V2x V3: every rejected response with the path, code and offending value of each error."""
    from ..operators.validate import reject_rows
    return reject_rows(checked_responses(spark, sf_dir))


def card_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests the fixture responses answer: one per conversation card;
    the requested item differs in case from the source the response echoes."""
    cards = fx.v_cards(spark, sf_dir)
    return cards.select(F.col("conv_id").alias("request_id"), "deck_id", "line_no",
                        F.concat(F.lit("Item "), F.col("conv_id").cast("string")).alias("item"))


def answered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """J4 over the fixture's answers, some requests answered several times."""
    from ..operators.cards import match_responses
    from ..operators.validate import validate_cards
    checked = validate_cards(fx.repeated_responses(fx.received(fx.v_responses(spark, sf_dir))))
    return match_responses(card_requests(spark, sf_dir), checked, order_col="attempt")


@query("normalized_cards")
def q_normalized_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each request's best response (valid first, then the earliest), normalised by the
    deck's minimal flag and customization."""
    from ..operators.cards import normalize_cards
    matched, _ = answered(spark, sf_dir)
    decks = valid_decks(spark, sf_dir).select("deck_id", "minimal_cards").join(
        instructions_by_deck(spark, sf_dir).select("deck_id", "customization"), "deck_id", "left")
    cards = matched.filter("valid").join(decks, "deck_id")
    c = F.col("card")
    return normalize_cards(cards).select(
        "request_id", "deck_id", "line_no", c["source"].alias("source"), c["target_core"].alias("target_core"),
        F.size(c["examples"]).cast("bigint").alias("n_examples"),
        F.size(c["word_family"]).cast("bigint").alias("n_family"),
        F.size(c["related_vocab"]).cast("bigint").alias("n_related"),
        F.size(c["custom_sections"]).cast("bigint").alias("n_custom"))


@query("unanswered_requests")
def q_unanswered_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests without any response."""
    _, missing = answered(spark, sf_dir)
    return missing.select("request_id", "deck_id", "line_no")


# --- audio -------------------------------------------------------------------------------

def audio_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    decks = valid_decks(spark, sf_dir).select(
        "deck_id", "generate_audio", "audio_model",
        F.when(F.col("deck_id") % 2 == 0, F.lit("nova")).otherwise(F.col("audio_voice")).alias("audio_voice"))
    return fx.v_cards(spark, sf_dir).join(decks, "deck_id")


@query("audio_manifest")
def q_audio_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One speech job per example sentence of every card of a deck
    with audio on, with its content-derived file name."""
    from ..operators.audio import audio_jobs
    return audio_jobs(audio_cards(spark, sf_dir)).select(
        "deck_id", "line_no", "example_no", "text", "file_name", "media_id", "audio_model", "audio_voice")


def stub_media(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    from ..operators.audio import audio_jobs
    from ..operators.calls import synthesize
    from .stubs import stub_speech_fn
    cards = audio_cards(spark, sf_dir)
    jobs = audio_jobs(cards)
    return cards, jobs, synthesize(jobs, stub_speech_fn, max_parallel=5)


@query("synthesize_stub")
def q_synthesize_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G8 with a deterministic speech stub: one file per distinct sentence, model and voice."""
    _, _, media = stub_media(spark, sf_dir)
    return media.select("media_id", "file_name", "audio_voice", F.octet_length("content").cast("bigint").alias("n_bytes"), "error")


@query("audio_gather")
def q_audio_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 J5 (after G8): every card of a valid deck with its produced audio
    files in example order, and the rendered sound field."""
    from ..operators.audio import attach_audio
    from ..operators.notes import sound_refs_sql
    cards, jobs, media = stub_media(spark, sf_dir)
    out = attach_audio(cards.select("deck_id", "line_no"), jobs, media)
    return out.select("deck_id", "line_no", F.size("audio_files").cast("bigint").alias("n_files"),
                      F.expr(sound_refs_sql("audio_files")).alias("back_audio"))


@query("generate_stub")
def q_generate_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G7 with a deterministic card stub over every request of every valid deck,
    then S3/V2 on the bodies."""
    from ..operators.calls import generate
    from .stubs import stub_card_fn
    from ..operators.validate import validate_cards
    reqs, prompts = item_requests(spark, sf_dir)
    reqs = materialize(reqs, "requests")
    bodies = generate(reqs, stub_card_fn, max_parallel=5, prompts=prompts, rows_per_task=20_000)
    checked = validate_cards(bodies)
    return checked.join(reqs.select("request_id", "deck_id", "line_no"), "request_id").select(
        "request_id", "deck_id", "line_no", F.col("valid").cast("string").alias("valid"),
        F.size("errors").cast("bigint").alias("n_errors"))


# --- sinks: output names, upsert plan ----------------------------------------------------

@query("output_names")
def q_output_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The output name each valid deck writes to, avoiding existing names
    and other decks' requests unless the deck overwrites."""
    from ..operators.sinks import resolve_output_names
    return resolve_output_names(valid_decks(spark, sf_dir), fx.v_existing_outputs(spark, sf_dir))


def current_and_old_notes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Rendered notes (with every line_no % 10 = 1 note submitted twice) and an
    older deck table: keys of line_no % 4 = 0 differ, back text of
    line_no % 3 = 0 differs, and keys of line_no % 6 = 1 occur twice."""
    notes = q_render_notes(spark, sf_dir).cache()  # both sides of the comparison derive from it
    current = notes.unionByName(notes.filter(F.col("line_no") % 10 == 1)
                                .withColumn("line_no", F.col("line_no") + 100000))
    old = notes.select(
        "deck_id",
        F.when(F.col("line_no") % 4 == 0, F.sha2(F.concat("note_guid", F.lit("-old")), 256))
        .otherwise(F.col("note_guid")).alias("note_guid"),
        "front_text",
        F.when(F.col("line_no") % 3 == 0, F.concat("back_text", F.lit(" (old)")))
        .otherwise(F.col("back_text")).alias("back_text"),
        "back_audio", "tags", "line_no")
    old = old.unionByName(old.filter(F.col("line_no") % 6 == 1).withColumns({
        "line_no": F.col("line_no") + 200000, "back_text": F.lit("a later line of the same key")}))
    return current, old


@query("deck_upsert")
def q_deck_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New / changed / unchanged / duplicate for every rendered note."""
    from ..operators.sinks import plan_upsert
    current, old = current_and_old_notes(spark, sf_dir)
    return plan_upsert(current, old)


def _written(notes: DataFrame, spark: SparkSession) -> str:
    """A folder of its own in the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), f"decks-{uuid.uuid4().hex}")


@query("written_decks")
def q_written_decks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered notes written, then upserted with a second run's notes, read back."""
    from ..operators.sinks import read_decks, upsert_decks
    current, old = current_and_old_notes(spark, sf_dir)
    base = _written(old, spark)
    upsert_decks(old, base)
    upsert_decks(current, base)
    return read_decks(spark, base).select("deck_id", "line_no", "note_guid", "front_text", "back_text")


@query("written_media")
def q_written_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Produced media appended twice; the second time nothing is new."""
    from ..operators.sinks import write_media
    _, _, media = stub_media(spark, sf_dir)
    path = _written(media, spark)
    write_media(media, path)
    write_media(media, path)
    return spark.read.parquet(path).select("media_id", "file_name", F.sha2("content", 256).alias("content_sha256"))


@query("deck_table")
def q_deck_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable deck and model ids, name, tags and output of every valid deck."""
    from ..operators.sinks import deck_table, resolve_output_names
    names = resolve_output_names(valid_decks(spark, sf_dir), fx.v_existing_outputs(spark, sf_dir))
    return deck_table(checked_configs(spark, sf_dir), names).withColumn("tags", F.array_join("tags", " "))


@query("blank_items")
def q_blank_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lines that are blank after stripping, reported instead of requested."""
    from ..operators.prompts import blank_items
    lines = fx.v_lines(spark, sf_dir).select("source_id", "pos", F.col("raw").alias("item"))
    return blank_items(lines, ("source_id", "pos"))


@query("ordered_items")
def q_ordered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: items in input order, with the item before each (which only that order tells)."""
    from ..operators.numbering import in_input_order
    items = active_lines(fx.v_items(spark, sf_dir), ["deck_id"])
    previous = items.select("deck_id", (F.col("line_no") + 1).alias("line_no"), F.col("item").alias("previous"))
    return in_input_order(items.select("deck_id", "line_no", "item").join(previous, ["deck_id", "line_no"], "left"),
                          global_sort=True)


# --- quality ---------------------------------------------------------------------------

def quality_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    decks = valid_decks(spark, sf_dir).select("deck_id", "cefr_level", "minimal_cards")
    return fx.v_cards(spark, sf_dir).join(decks, "deck_id")


@query("level_length")
def q_level_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words per example sentence against the deck level's range."""
    from ..operators.quality import level_length
    out = level_length(quality_cards(spark, sf_dir), valid_decks(spark, sf_dir).select("deck_id", "cefr_level"))
    return out.withColumn("in_range", F.col("in_range").cast("string"))


@query("content_rules")
def q_content_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Core concept missing from a sentence, markup, default note
    sections outside 3-6 items, nuances over 10 words."""
    from ..operators.quality import content_rules
    return content_rules(quality_cards(spark, sf_dir))


@query("repeated_terms")
def q_repeated_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Note terms used twice in a card or equal to its core concept."""
    from ..operators.quality import repeated_terms
    return repeated_terms(quality_cards(spark, sf_dir))


@query("blacklist_hits")
def q_blacklist_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blacklisted words and phrases found in sentences and note items."""
    from ..operators.quality import blacklist_hits
    bl = instructions_by_deck(spark, sf_dir).select(
        "deck_id", F.explode(F.coalesce("blacklist", F.array().cast("array<string>"))).alias("entry"))
    return blacklist_hits(quality_cards(spark, sf_dir), bl)


# --- summary and progress ---------------------------------------------------------------

def failed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.calls import call_errors
    return call_errors(fx.v_responses(spark, sf_dir), card_requests(spark, sf_dir))


@query("call_errors")
def q_call_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests whose latest call failed, with the kind of failure."""
    return failed_calls(spark, sf_dir)


@query("run_summary")
def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: per configured deck, items, accepted / rejected / unanswered
    responses, failed calls, audio jobs, note items, and why a side file dropped it."""
    from ..operators.audio import audio_job_count
    from ..operators.clean import active_items
    from ..operators.notes import note_item_count
    from ..operators.summary import run_summary, stage_counts
    matched, missing = answered(spark, sf_dir)
    valid = F.col("valid").cast("int")
    counters = [stage_counts(active_items(fx.v_items(spark, sf_dir), ["deck_id"]), n_items=F.lit(1)),
                stage_counts(matched, n_accepted=valid, n_rejected=1 - valid),
                stage_counts(missing, n_unanswered=F.lit(1)),
                stage_counts(failed_calls(spark, sf_dir), n_call_errors=F.lit(1)),
                stage_counts(audio_cards(spark, sf_dir), n_audio_jobs=audio_job_count()),
                stage_counts(fx.v_cards(spark, sf_dir), n_note_items=note_item_count())]
    bad = gathered_side_lines(spark, sf_dir).filter("too_large").groupBy("deck_id").agg(
        F.min(F.concat("kind", F.lit(": too_large"))).alias("side_file"))
    return run_summary(checked_configs(spark, sf_dir), counters, bad)


@query("progress")
def q_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position and total of every speech job within its deck, in card
    then sentence order (``i/total``)."""
    from ..operators.audio import audio_jobs
    from ..operators.numbering import with_progress
    jobs = audio_jobs(audio_cards(spark, sf_dir)).select("deck_id", "line_no", "example_no")
    return with_progress(jobs, ["deck_id"], ["line_no", "example_no"]).select(
        "deck_id", "line_no", "example_no", "position", F.col("total").cast("bigint").alias("total"), "progress")


@query("quality_report")
def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1-C5 G5 J6 together: one row per finding."""
    from ..operators.quality import quality_report
    cards = quality_cards(spark, sf_dir)
    bl = instructions_by_deck(spark, sf_dir).select(
        "deck_id", F.explode(F.coalesce("blacklist", F.array().cast("array<string>"))).alias("entry"))
    return quality_report(cards, valid_decks(spark, sf_dir).select("deck_id", "cefr_level"), bl)
