import pytest
from pyspark.sql import functions as F

from factories import card_json, validated_cards


def test_audio_jobs_and_gather(spark):
    from deckforge.operators.audio import attach_audio, audio_jobs
    from deckforge.operators.calls import synthesize
    from deckforge.plans.stubs import stub_speech_fn
    cards = validated_cards(spark, [card_json(), card_json(source="oven")]).withColumn(
        "generate_audio", F.expr("line_no = 1"))
    jobs = audio_jobs(cards)
    assert jobs.count() == 2  # audio only for line 1, one job per example
    names = [r.file_name for r in jobs.orderBy("example_no").collect()]
    assert names[0].startswith("deckforge-bread-1-") and names[1].startswith("deckforge-bread-2-")
    media = synthesize(jobs, stub_speech_fn, max_parallel=2)
    assert media.filter("error IS NULL").count() == 2
    out = {r.line_no: r.audio_files for r in attach_audio(cards.select("deck_id", "line_no"), jobs, media).collect()}
    assert out == {1: names, 2: []}


def test_generate_errors_are_rows_and_strict_raises(spark):
    from deckforge.operators.calls import generate

    def make():
        def fn(payload):
            if "bad" in payload:
                raise RuntimeError("boom")
            return payload.upper()
        return fn

    reqs = spark.createDataFrame([("1", "ok"), ("2", "bad")], "request_id string, payload string")
    out = {r.request_id: (r.body, r.error) for r in generate(reqs, make, max_parallel=2).collect()}
    assert out["1"] == ("OK", None) and out["2"][0] is None and "boom" in out["2"][1]
    with pytest.raises(Exception):
        generate(reqs, make, max_parallel=2, strict=True)
    with pytest.raises(ValueError):
        generate(reqs, make, max_parallel=0)
    again = generate(reqs, make, max_parallel=1, done=generate(reqs, make, max_parallel=1))
    assert [r.request_id for r in again.collect()] == ["2"]


def test_calls_run_in_waves(spark):
    from pyspark.sql import functions as F

    from deckforge.operators.calls import generate, synthesize
    from deckforge.plans.stubs import stub_speech_fn

    def make():
        return lambda payload: payload[::-1]

    reqs = spark.range(23).select(F.col("id").cast("string").alias("request_id"),
                                  F.concat(F.lit("p"), F.col("id").cast("string")).alias("payload"))
    out = generate(reqs, make, max_parallel=2, rows_per_task=3)  # 4 waves
    got = {r.request_id: r.body for r in out.collect()}
    assert len(got) == 23
    assert all(got[str(i)] == f"p{i}"[::-1] for i in range(23))
    jobs = spark.range(10).select((F.col("id") % 4).cast("string").alias("media_id"), F.lit("f").alias("file_name"),
                                  F.lit("hello").alias("text"), F.lit("m").alias("audio_model"),
                                  F.lit("v").alias("audio_voice"), F.lit(None).cast("string").alias("error"))
    media = synthesize(jobs, stub_speech_fn, max_parallel=2, rows_per_task=1)
    assert sorted(r.media_id for r in media.collect()) == ["0", "1", "2", "3"]


def test_each_voice_has_its_own_files(spark):
    from deckforge.operators.audio import attach_audio, audio_jobs
    from deckforge.operators.calls import synthesize

    def make():
        return lambda text, model, voice: f"{voice}: {text}".encode()

    cards = validated_cards(spark, [card_json(), card_json()]).withColumns({
        "deck_id": F.col("line_no"), "audio_voice": F.expr("CASE line_no WHEN 1 THEN 'alloy' ELSE 'nova' END")})
    jobs = audio_jobs(cards)
    media = synthesize(jobs, make, max_parallel=2)
    got = media.collect()
    assert len(got) == 4 and {bytes(r.content).decode().split(":")[0] for r in got} == {"alloy", "nova"}
    assert len({r.file_name for r in got}) == 2  # the name is the sentence's
    assert all(len(r.audio_files) == 2 for r in attach_audio(cards, jobs, media).collect())
    again = synthesize(audio_jobs(cards.withColumn("audio_voice", F.lit("echo"))), make, done=media)
    assert again.count() == 2  # one deck text, a new voice


def test_a_run_that_dies_keeps_its_finished_waves(spark, tmpdir_path):
    import os

    from deckforge.operators.calls import generate
    reqs = spark.range(40).select(F.col("id").cast("string").alias("request_id"), F.lit("p").alias("payload"))
    out, called = os.path.join(tmpdir_path, "answers"), os.path.join(tmpdir_path, "called")
    os.mkdir(called)

    def make(dies):
        def fn(payload):
            n = len(os.listdir(called))
            if dies and n >= 12:
                raise MemoryError("gone")
            open(os.path.join(called, os.urandom(8).hex()), "w").close()
            return "{}"
        return lambda: fn

    with pytest.raises(Exception):
        generate(reqs, make(True), max_parallel=1, rows_per_task=8, strict=True, out_path=out)
    kept = spark.read.parquet(out)
    before = kept.count()
    assert 0 < before <= 12
    generate(reqs, make(False), max_parallel=1, rows_per_task=8, done=kept, out_path=out)
    rows = spark.read.parquet(out)
    assert rows.count() == rows.select("request_id").distinct().count() == 40
    # only calls of the wave that died are made again
    assert len(os.listdir(called)) == 40 + (12 - before)


def test_a_task_that_ended_is_kept_when_its_wave_dies(spark, tmpdir_path):
    """Of two tasks one is done when the other dies: its answers are there, and not asked for again."""
    import os
    import time

    from deckforge.operators.calls import generate, open_results
    from deckforge.schemas import GENERATE_OUT
    reqs = spark.range(60).select(F.col("id").cast("string").alias("request_id"), F.col("id").cast("string").alias("payload"))
    out, called = os.path.join(tmpdir_path, "answers"), os.path.join(tmpdir_path, "called")
    os.mkdir(called)

    def first():
        try:
            os.mkdir(os.path.join(tmpdir_path, "first"))
            return True
        except FileExistsError:
            return False

    def make(dies):
        mine = []

        def fn(payload):
            if dies and not mine and not first():  # the second task to start: waits, then dies
                for _ in range(300):
                    if [f for f in os.listdir(out) if f.endswith(".parquet") and os.path.getsize(os.path.join(out, f)) > 1500]:
                        break
                    time.sleep(0.1)
                raise MemoryError("gone")
            mine.append(payload)
            open(os.path.join(called, f"{payload}-{os.urandom(4).hex()}"), "w").close()
            return "{}"
        return lambda: fn

    def factory():
        return make(True)()

    with pytest.raises(Exception):
        generate(reqs, factory, max_parallel=2, rows_per_task=30, strict=True, out_path=out)
    kept = open_results(spark, out, GENERATE_OUT).select("request_id")
    assert sorted(r.request_id for r in kept.collect()) == sorted(f.split("-")[0] for f in os.listdir(called))
    assert 10 < kept.count() < 50
    generate(reqs, make(False), max_parallel=2, rows_per_task=30, done=kept, out_path=out)
    asked = [f.split("-")[0] for f in os.listdir(called)]
    assert len(asked) == len(set(asked)) == 60


def test_failed_calls_have_a_kind(spark):
    from deckforge.operators.calls import call_errors, generate

    def make():
        def fn(payload):
            if payload == "fine":
                return "{}"
            error = RuntimeError("no")
            error.status_code = int(payload)
            raise error
        return fn

    rows = [("a", 1, 1, "401"), ("b", 1, 2, "404"), ("c", 2, 1, "500"), ("d", 2, 2, "fine")]
    reqs = spark.createDataFrame(rows, "request_id string, deck_id long, line_no long, payload string")
    got = call_errors(generate(reqs, make, max_parallel=2), reqs).collect()
    assert {r.request_id: r.code for r in got} == {"a": "authentication", "b": "unknown_model", "c": "other"}
    assert all("no" in r.message for r in got)


def test_generate_prompt_join_falls_back_past_the_byte_bound(spark):
    import json

    from deckforge.operators.calls import generate
    prompts = spark.createDataFrame([(1, "p1", "system text")], "deck_id long, prompt_id string, system_prompt string")
    reqs = spark.createDataFrame([("a", 1, "p1", "Line: x", "m", None)],
                                 "request_id string, deck_id long, prompt_id string, user_content string, "
                                 "model string, reasoning_effort string")

    def make():
        return lambda payload: json.loads(payload)["messages"][0]["content"]

    for bound in (1 << 20, 0):  # broadcast path, then the shuffle-join path
        out = generate(reqs, make, max_parallel=1, prompts=prompts, max_prompt_bytes=bound).collect()
        assert [(r.request_id, r.body) for r in out] == [("a", "system text")]


def test_call_stages_accept_empty_input(spark):
    from deckforge.operators.calls import generate, synthesize
    from deckforge.plans.stubs import stub_speech_fn
    reqs = spark.createDataFrame([], "request_id string, payload string")
    assert generate(reqs, lambda: (lambda p: p), max_parallel=3).count() == 0
    jobs = spark.createDataFrame([], "media_id string, file_name string, text string, audio_model string, "
                                     "audio_voice string, error string")
    assert synthesize(jobs, stub_speech_fn, max_parallel=3).count() == 0
