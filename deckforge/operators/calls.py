"""Bounded-parallel external calls with caller-supplied functions.

``max_parallel`` partitions, one task each, calls made one after another in a
task: at most ``max_parallel`` calls are in flight at any time, however many
executors the cluster has (the reference's thread-pool limit). The function is
created once per task by ``make_fn`` (one client per task, not per row).
Speculative tasks would make calls twice, so they are refused.

Failures are data (``code`` and ``error``) unless ``strict=True``. The work is
written once without its payloads and runs in waves of ``max_parallel`` tasks with
``rows_per_task`` calls at most. A task's answers become a file of the result table
(``out_path``) the moment the task ends, not when its wave does, so a lost executor or
a run that dies repeats only the calls of tasks that were still going. The table
exists, empty, before the first call; the next run's ``done=`` finds all that was
answered, also where no wave ended. A task that dies while its file is being published
may leave its answers twice; readers take one (J4 the best, media by their id).
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import GENERATE_OUT, SYNTH_OUT
from ..session import ensure_checkpoint_dir, materialize, path_exists

TextFn = Callable[[str], str]
AudioFn = Callable[[str, str, str], bytes]

# --- fixed values: HTTP statuses of failed calls and their codes ----------------
CODE_BY_STATUS = {400: "bad_request", 401: "authentication", 403: "authentication", 404: "unknown_model",
                  429: "rate_limit"}
OTHER_CODE = "other"
# --------------------------------------------------------------------------------


def error_code(exc: Exception) -> str:
    """The kind of a failed call, from the status its exception carries (``status_code`` or ``status``)."""
    status = getattr(exc, "status_code", getattr(exc, "status", None))
    return CODE_BY_STATUS.get(status, OTHER_CODE)


def _check_call(df: DataFrame, max_parallel: int) -> None:
    if max_parallel < 1:
        raise ValueError("max_parallel must be at least 1")
    conf = df.sparkSession.sparkContext.getConf()
    if conf.get("spark.speculation", "false").lower() == "true":
        raise ValueError("spark.speculation would repeat paid calls; turn it off")


def skip_done(todo: DataFrame, done: DataFrame | None, key: str) -> DataFrame:
    """Work not yet present (without error) in an earlier result table."""
    if done is None:
        return todo
    if "error" in done.columns:
        done = done.filter(F.col("error").isNull())
    return todo.join(done.select(key), key, "left_anti")


DEFAULT_ROWS_PER_TASK = 1_000
DEFAULT_BROADCAST_BYTES = 256 << 20
# Publishes a task's files when the task ends (version 1 waits for the whole job).
_TASK_COMMITS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def open_results(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A result table, which may be missing, empty or left by a run that died: what it holds so far."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _in_waves(todo: DataFrame, key: str, max_parallel: int, rows_per_task: int, schema: StructType,
              call: Callable[[DataFrame], DataFrame], name: str, out_path: str | None) -> DataFrame:
    """Run ``call`` (applied to a ``max_parallel``-partitioned slice) wave by
    wave, each task appending to the result table, and return that table."""
    spark = todo.sparkSession
    target = out_path or os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    todo = materialize(todo, f"{name}-todo")  # computed once, also for the count
    waves = math.ceil(todo.count() / (max_parallel * rows_per_task))
    spark.createDataFrame([], schema).write.mode("append").parquet(target)  # there before the first call
    if waves > 1:  # one folder a wave, so that each job opens its own rows only
        staged = os.path.join(ensure_checkpoint_dir(spark), f"{name}-waves-{uuid.uuid4().hex}")
        todo.withColumn("_wave", F.pmod(F.xxhash64(key), F.lit(waves))).repartition("_wave").write.partitionBy(
            "_wave").parquet(staged)
    for w in range(waves):
        folder = f"{staged}/_wave={w}" if waves > 1 else None
        if folder and not path_exists(spark, folder):
            continue  # no key fell into it
        part = spark.read.schema(todo.schema).parquet(folder) if folder else todo
        call(part.repartition(max_parallel, key)).write.mode("append").options(**_TASK_COMMITS).parquet(target)
    return spark.read.schema(schema).parquet(target)


def generate(requests: DataFrame, make_fn: Callable[[], TextFn], max_parallel: int = 5,
             key: str = "request_id", payload_col: str = "payload", strict: bool = False,
             done: DataFrame | None = None, prompts: DataFrame | None = None,
             max_prompt_bytes: int = DEFAULT_BROADCAST_BYTES,
             rows_per_task: int = DEFAULT_ROWS_PER_TASK, out_path: str | None = None) -> DataFrame:
    """``(request_id, attempt, body, code, error)`` per request; ``make_fn()``
    returns a function from the JSON payload to the JSON response body. Rows
    are appended to ``out_path`` (else to a new table) and that table is
    returned; requests in ``done`` are left out. ``attempt`` is the request's
    column of that name, else 1.

    With ``prompts`` (one row per deck), ``requests`` is the R2 table without
    payloads: it is shuffled into ``max_parallel`` partitions first and the
    payload is built after the shuffle from a broadcast of the prompt table,
    whose total size is measured first, so the prompt text never travels once
    per request. Past ``max_prompt_bytes`` the payloads are joined first (a
    shuffle join) and then shuffled into the call slots."""
    _check_call(requests, max_parallel)
    todo = skip_done(requests, done, key)
    if "attempt" not in todo.columns:
        todo = todo.withColumn("attempt", F.lit(1))
    todo = todo.withColumn("attempt", F.col("attempt").cast("bigint"))
    ready = [key, "attempt", payload_col]

    def with_payload(parted: DataFrame) -> DataFrame:
        return parted

    if prompts is None:
        todo = todo.select(*ready)
    else:
        from .prompts import PAYLOAD_SQL
        side = prompts.select("deck_id", "prompt_id", "system_prompt")
        # Bounded in bytes (a prompt carries up to 16 KiB of side-file lines), not in rows.
        n_bytes = side.agg(F.coalesce(F.sum(F.octet_length("system_prompt") + 64), F.lit(0))).first()[0]
        if n_bytes <= max_prompt_bytes:
            todo = todo.select(key, "attempt", "deck_id", "prompt_id", "user_content", "model", "reasoning_effort")

            def with_payload(parted: DataFrame) -> DataFrame:
                return (parted.join(F.broadcast(side), ["deck_id", "prompt_id"])
                        .select(key, "attempt", F.expr(PAYLOAD_SQL).alias(payload_col)))
        else:
            todo = (todo.join(side, ["deck_id", "prompt_id"])  # a shuffle join: no hint past the bound
                    .select(key, "attempt", F.expr(PAYLOAD_SQL).alias(payload_col)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = make_fn()
        for pdf in batches:
            out = []
            for request, attempt, payload in zip(pdf[key], pdf["attempt"], pdf[payload_col]):
                try:
                    out.append((str(request), attempt, fn(payload), None, None))
                except Exception as exc:  # noqa: BLE001 - a failed call is a row
                    if strict:
                        raise
                    out.append((str(request), attempt, None, error_code(exc), f"{type(exc).__name__}: {exc}"))
            yield pd.DataFrame(out, columns=GENERATE_OUT.names)

    def call(parted: DataFrame) -> DataFrame:
        return with_payload(parted).mapInPandas(run, GENERATE_OUT)

    return _in_waves(todo, key, max_parallel, rows_per_task, GENERATE_OUT, call, "responses", out_path)


def synthesize(jobs: DataFrame, make_fn: Callable[[], AudioFn], max_parallel: int = 5,
               strict: bool = False, done: DataFrame | None = None,
               rows_per_task: int = DEFAULT_ROWS_PER_TASK, out_path: str | None = None) -> DataFrame:
    """``(media_id, file_name, audio_model, audio_voice, content, code, error)``,
    one row per ``media_id`` (a file in one model's voice); jobs flagged with an
    error (blank text) are not sent, nor are media in ``done``. ``make_fn()``
    returns a function ``(text, model, voice) -> bytes``."""
    _check_call(jobs, max_parallel)
    # repeated jobs go before they are counted and dealt out, combined map-side
    wanted = jobs.filter(F.col("error").isNull()).groupBy("media_id").agg(
        *[F.first(c).alias(c) for c in ("file_name", "text", "audio_model", "audio_voice")])
    todo = skip_done(wanted, done, "media_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = make_fn()
        for pdf in batches:
            out = []
            for media_id, name, text, model, voice in zip(pdf["media_id"], pdf["file_name"], pdf["text"],
                                                          pdf["audio_model"], pdf["audio_voice"]):
                try:
                    out.append((media_id, name, model, voice, fn(text, model, voice), None, None))
                except Exception as exc:  # noqa: BLE001 - a failed call is a row
                    if strict:
                        raise
                    out.append((media_id, name, model, voice, None, error_code(exc), f"{type(exc).__name__}: {exc}"))
            yield pd.DataFrame(out, columns=SYNTH_OUT.names)

    def call(parted: DataFrame) -> DataFrame:
        return parted.mapInPandas(run, SYNTH_OUT)

    return _in_waves(todo, "media_id", max_parallel, rows_per_task, SYNTH_OUT, call, "media", out_path)


def call_errors(responses: DataFrame, requests: DataFrame, key: str = "request_id") -> DataFrame:
    """``(request_id, deck_id, line_no, code, message)`` of the requests whose latest call failed."""
    latest = responses.groupBy(key).agg(F.max(F.struct("attempt", "code", "error")).alias("l"))
    failed = latest.filter(F.col("l.error").isNotNull()).select(
        key, F.col("l.code").alias("code"), F.col("l.error").alias("message"))
    return requests.select(key, "deck_id", "line_no").join(failed, key)
