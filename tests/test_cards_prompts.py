import json

from pyspark.sql import functions as F

from factories import card_json


def test_match_and_normalize(spark):
    from deckforge.operators.cards import match_responses, normalize_cards
    from deckforge.operators.validate import validate_cards
    reqs = spark.createDataFrame([("a", 1, "bake"), ("b", 2, "peel"), ("c", 3, "stir")],
                                 "request_id string, line_no long, item string")
    body = card_json(custom_sections=[{"title": "T", "items": [{"term": "a", "translation": "b", "example": "c"}]}])
    resp = spark.createDataFrame([("a", body), ("a", body), ("b", body)], "request_id string, body string")
    matched, missing = match_responses(reqs, validate_cards(resp))
    assert [r.request_id for r in missing.collect()] == ["c"]
    assert matched.count() == 2
    cards = matched.withColumns({
        "minimal_cards": F.expr("request_id = 'b'"),
        "customization": F.expr("CASE WHEN request_id = 'a' THEN array() ELSE array('x') END")})
    out = {r.request_id: r.card for r in normalize_cards(cards).collect()}
    assert out["a"].source == "bake" and out["a"].custom_sections == [] and len(out["a"].word_family) == 2
    assert out["b"].source == "peel" and out["b"].word_family == [] and out["b"].related_vocab == []
    assert out["b"].custom_sections == []


def test_a_valid_answer_goes_first(spark):
    from deckforge.operators.cards import match_responses
    from deckforge.operators.validate import validate_cards
    good, other = card_json(), card_json(target_core="hogaza")
    answers = [("a", 1, "null"), ("a", 2, good), ("a", 3, "[]"), ("b", 2, good), ("b", 1, other), ("c", 1, "null"),
               ("c", 2, "{"), ("d", 1, good), ("d", 1, good)]
    resp = validate_cards(spark.createDataFrame(answers, "request_id string, attempt long, body string"))
    reqs = spark.createDataFrame([(x,) for x in "abcde"], "request_id string")
    matched, missing = match_responses(reqs, resp, order_col="attempt")
    got = {r.request_id: r.card and r.card.target_core for r in matched.collect()}
    assert got == {"a": "pan", "b": "hogaza", "c": None, "d": "pan"} and matched.count() == 4
    assert [r.request_id for r in missing.collect()] == ["e"]


def _deck(spark, **kw):
    from deckforge.operators.config import validate_configs
    from deckforge.schemas import RAW_CONFIG
    row = {f.name: None for f in RAW_CONFIG.fields}
    row.update(deck_id=1, origin_language="Spanish", target_language="French", notes_language="English",
               cefr_level="A2")
    row.update(kw)
    return validate_configs(spark.createDataFrame([tuple(row[f.name] for f in RAW_CONFIG.fields)], RAW_CONFIG))


def _prompt(spark, customization=None, blacklist=None, **kw):
    from deckforge.operators.prompts import system_prompts
    instr = spark.createDataFrame([(1, customization, blacklist)],
                                  "deck_id long, customization array<string>, blacklist array<string>")
    return system_prompts(_deck(spark, **kw), instr).first().system_prompt


def test_blocks_follow_each_other(spark):
    sheet = _prompt(spark, ["IPA beside each core"], ["chose"])
    blocks = [b.split("\n")[0] for b in sheet.split("\n\n")]
    assert blocks == ["TASK", "LEARNER", "LINE", "FIELDS", "THE LEARNER'S RULES", "AVOID"]
    assert sheet.endswith("- chose") and "\n- IPA beside each core\n" in sheet
    assert "Reads Spanish and English. Level A2." in sheet and "French, 5 to 9 words" in sheet


def test_minimal_sheet_has_no_entries_and_no_rules(spark):
    sheet = _prompt(spark, ["IPA beside each core"], ["chose"], minimal_cards="true", cefr_level="c1")
    assert "word_family" not in sheet and "IPA" not in sheet and "- chose" in sheet
    assert "7 to 15 words" in sheet and "educated native" in sheet
    plain = _prompt(spark, origin_language="English")
    assert "Reads English. Level" in plain and "AVOID" not in plain and "RULES" not in plain


def test_a_line_elsewhere_changes_no_request(spark):
    from deckforge.operators.prompts import build_requests, system_prompts
    prompts = system_prompts(_deck(spark))
    ids = lambda lines: {(r.item, r.request_id) for r in build_requests(spark.createDataFrame(
        [(1, n + 1, x) for n, x in enumerate(lines)], "deck_id long, line_no long, item string"), prompts).collect()}
    before, after = ids(["moon", "tide", "moon"]), ids(["salt", "moon", "tide", "moon"])
    assert len(before) == 3 and before < after and len(after) == 4


def test_requests_and_payload(spark):
    from deckforge.operators.prompts import build_requests, request_payloads, system_prompts
    prompts = system_prompts(_deck(spark))
    items = spark.createDataFrame([(1, 1, " lantern (glass, wick) "), (1, 2, "moth"), (2, 1, "stray")],
                                  "deck_id long, line_no long, item string")
    reqs = build_requests(items, prompts)
    assert reqs.count() == 2
    r = {x.line_no: x for x in reqs.collect()}
    assert r[1].user_content == "Line: lantern (glass, wick)" and r[1].request_id != r[2].request_id
    payload = json.loads(request_payloads(reqs, prompts).filter("line_no = 1").first().payload)
    assert payload["model"] == "gpt-4.1-mini" and "reasoning_effort" not in payload
    assert [m["role"] for m in payload["messages"]] == ["system", "user"]
    assert "lantern" not in payload["messages"][0]["content"]
    prompts2 = system_prompts(_deck(spark, reasoning_effort="high"))
    p2 = json.loads(request_payloads(build_requests(items, prompts2), prompts2).first().payload)
    assert p2["reasoning_effort"] == "high"


def test_only_repeated_items_are_numbered(spark):
    """Occurrences follow line order in each deck, and rows that are alone need no numbering."""
    from collections import Counter

    from deckforge.operators.prompts import _occurrences
    lines = [(d, n, t) for d in (1, 2) for n, t in enumerate(["same"] * 400 + [f"item {i}" for i in range(500)] + ["b", "a", "b"], 1)]
    df = spark.createDataFrame(lines, "deck_id long, line_no long, item string").repartition(5)
    got = sorted((r.deck_id, r.line_no, r._occurrence) for r in _occurrences(df, "deck_id", "line_no", "item").collect())
    seen, want = Counter(), []
    for d, n, t in lines:
        seen[d, t] += 1
        want.append((d, n, seen[d, t]))
    assert got == sorted(want)
