"""Streaming ingest of item files and model responses, up to the deck table.

Every text operator is stateless, so the batch operators run unchanged on each
micro-batch. Line numbering happens inside each whole-text row (no window), and
response validation is a per-row expression; the only cross-batch concerns are
idempotence, handled by writing each micro-batch under its batch id (a retried
batch overwrites its own output, never appends twice), and, for the deck table, which
requests have their note already: the table's commit names the last batch it took in.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.audio import audio_jobs
from ..operators.calls import open_results
from ..operators.cards import match_responses
from ..operators.sinks import upsert_decks
from ..operators.validate import validate_cards
from ..run import deck_cards, deck_notes
from ..schemas import GENERATE_OUT, SYNTH_OUT
from ..session import materialize
from ..sources.lines import active_text_lines

#: Responses as ``generate`` writes them; what a record leaves out is null.
RESPONSE_SCHEMA = GENERATE_OUT


def _batch_writer(out_dir: str, prepare):
    def write(batch: DataFrame, batch_id: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(os.path.join(out_dir, f"batch={batch_id}"))
    return write


def stream_items(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """New item files -> ``(path, line_no, item)``: S1 + F1 + W1 per file."""
    files = (spark.readStream.format("text").option("wholetext", "true").load(source_dir)
             .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))
    items = active_text_lines(files, ["path"], "text")
    writer = items.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        _batch_writer(out_dir, lambda b: b))
    return _started(writer, available_now)


def _started(writer, available_now: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_responses(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str,
                     requests: DataFrame | None = None, available_now: bool = True) -> StreamingQuery:
    """New JSON-lines response files (``RESPONSE_SCHEMA``) -> validated rows
    ``(request_id, attempt, valid, errors, card)``, joined (stream-static) to the request
    table when given. Failed calls (``error``) carry no answer and are left out."""
    raw = spark.readStream.schema(RESPONSE_SCHEMA).json(source_dir)

    def prepare(batch: DataFrame) -> DataFrame:
        checked = validate_cards(batch.where("error IS NULL")).select("request_id", "attempt", "valid", "errors", "card")
        return checked.join(requests, "request_id") if requests is not None else checked

    return _started(raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        _batch_writer(out_dir, prepare)), available_now)


def take_in(batch: DataFrame, batch_id: int, requests: DataFrame, decks: DataFrame, out_dir: str,
            instructions: DataFrame | None = None, stream: str = "responses") -> int:
    """J4 and J7 of one batch of responses; returns the deck table's version.

    A request that a batch before this one answered with a valid card keeps that note; otherwise the batch's best
    answer (``best_responses``) becomes its note. What each batch answered is written under its number, and the
    table's commit names the batch, so a batch that comes again, whole or after dying half-way, changes nothing."""
    spark = batch.sparkSession
    answered = os.path.join(out_dir, "answered")
    before = open_results(spark, answered, "request_id string, batch bigint").where(F.col("batch") < batch_id)
    received = validate_cards(batch.where("error IS NULL").select("request_id", "attempt", "body"))
    open_requests = requests.join(before.select("request_id"), "request_id", "left_anti")
    matched, _ = match_responses(open_requests, received.where("valid"), order_col="attempt")
    matched = materialize(matched, "answers")
    matched.select("request_id").write.mode("overwrite").parquet(os.path.join(answered, f"batch={batch_id}"))
    cards = materialize(deck_cards(matched, decks, instructions), "cards")
    media = open_results(spark, os.path.join(out_dir, "media"), SYNTH_OUT).select("media_id", "error")
    notes = deck_notes(cards, decks, audio_jobs(cards), media)
    return upsert_decks(notes, os.path.join(out_dir, "decks"), batch=(stream, batch_id))[0]


def stream_decks(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str, requests: DataFrame,
                 decks: DataFrame, instructions: DataFrame | None = None, stream: str = "responses",
                 available_now: bool = True) -> StreamingQuery:
    """New JSON-lines response files (``RESPONSE_SCHEMA``) -> notes in the deck table under ``out_dir/decks``
    (``take_in``). Notes name the audio files that ``out_dir/media`` holds when their batch comes. One table may take
    in several streams: each needs a name of its own, kept with its checkpoint."""
    raw = spark.readStream.schema(RESPONSE_SCHEMA).json(source_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        take_in(batch, batch_id, requests, decks, out_dir, instructions, stream)

    return _started(raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), available_now)
