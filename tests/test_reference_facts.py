"""Further behaviour facts, one test per rule (written afresh)."""

import random
import time

from pyspark.sql import functions as F

from helpers import rows
from factories import card_json, validated_cards
from test_cards_prompts import _deck, _prompt


def test_input_order_survives_scrambled_completion(spark):
    from deckforge.operators.calls import generate

    def make():
        def fn(payload):
            time.sleep(random.random() / 50)
            return payload.upper()
        return fn

    reqs = spark.createDataFrame([(str(i), f"item {i}", i) for i in range(30)],
                                 "request_id string, payload string, line_no long")
    out = generate(reqs.select("request_id", "payload"), make, max_parallel=4)
    joined = reqs.join(out, "request_id").orderBy("line_no")
    assert [r.body for r in joined.collect()] == [f"ITEM {i}" for i in range(30)]


def test_rules_and_words_to_avoid_are_bulleted_in_order(spark):
    p = _prompt(spark, ["Zeta before", "Alpha after"], None)
    assert "- Zeta before\n- Alpha after" in p and "AVOID" not in p
    p = _prompt(spark, None, ["chose", "truc"])
    assert p.endswith("- chose\n- truc") and "RULES" not in p


def test_prompt_states_level_and_languages(spark):
    b1, a2 = _prompt(spark, cefr_level="B1"), _prompt(spark)
    assert "6 to 12 words" in b1 and "the way people talk" in b1
    assert "basics only" in a2 and "bare text" in a2
    assert "term, example: French" in a2 and "translation: English" in a2 and "in Spanish" in a2


def test_side_file_paths_default_without_warnings(spark):
    r = _deck(spark).first()
    assert r.customization_path == "customization.txt" and r.blacklist_path == "blacklist.txt"
    assert "customization_path" not in r.defaulted and "blacklist_path" not in r.defaulted


def test_blank_audio_text_is_rejected_not_sent(spark):
    from deckforge.operators.audio import audio_jobs
    from deckforge.operators.calls import synthesize
    from deckforge.plans.stubs import stub_speech_fn
    cards = validated_cards(spark, [card_json()])
    cards = cards.withColumn("card", F.col("card").withField(
        "examples", F.array(F.struct(F.lit("  ").alias("target"), F.lit("x").alias("origin")),
                            F.col("card.examples")[1])))
    jobs = audio_jobs(cards)
    assert sorted(rows(jobs, "example_no", "error")) == [(1, "blank_audio_text"), (2, None)]
    media = synthesize(jobs, stub_speech_fn, max_parallel=1)
    assert media.count() == 1


def test_minimal_warning_only_with_customization_lines(spark):
    from deckforge.operators.instructions import side_file_warnings
    df = spark.createDataFrame([("customization", False, None, True), ("customization", True, ["x"], True),
                                ("customization", True, ["x"], False), ("blacklist", True, ["x"], True)],
                               "kind string, found boolean, lines array<string>, minimal boolean")
    got = [r[0] for r in df.select(side_file_warnings(F.col("kind"), F.col("found"), F.col("lines"),
                                                      F.col("minimal"))).collect()]
    assert got == [["not_found"], ["ignored_minimal"], [], []]
