import json

import pytest

from factories import card_dict, card_json, validated_cards


def _one(spark, body):
    r = validated_cards(spark, [body]).first()
    return r, sorted((e.path, e.code) for e in r.errors)


def test_representative_card_accepted(spark):
    r, errs = _one(spark, card_json())
    assert r.valid and errs == []
    assert r.card.word_family[1].nuance is None and r.card.custom_sections == []


def test_text_is_stripped_and_blank_nuance_is_null(spark):
    wf = [{"term": " la masa ", "translation": "dough", "nuance": "  ", "example": "x"},
          {"term": "miga", "translation": "crumb", "nuance": "  fem.  ", "example": "y"}]
    r, _ = _one(spark, card_json(source="  run ", word_family=wf))
    assert r.valid and r.card.source == "run"
    assert r.card.word_family[0].term == "la masa" and r.card.word_family[0].nuance is None
    assert r.card.word_family[1].nuance == "fem."


def test_missing_note_lists_default_to_empty(spark):
    d = card_dict()
    del d["word_family"], d["related_vocab"]
    r, errs = _one(spark, json.dumps(d))
    assert r.valid and r.card.word_family == [] and r.card.related_vocab == []


@pytest.mark.parametrize("change,expected", [
    ({"examples": [{"target": " ", "origin": "x"}, {"target": "a", "origin": "b"}]}, ("examples[0].target", "blank")),
    ({"examples": [{"target": "a", "origin": "b"}]}, ("examples", "too_few")),
    ({"examples": [{"target": "a", "origin": "b"}] * 4}, ("examples", "too_many")),
    ({"word_family": [{"term": "a", "translation": "b", "example": "  "}]}, ("word_family[0].example", "blank")),
    ({"word_family": [{"term": "a", "translation": "b", "example": "c"}] * 7}, ("word_family", "too_many")),
    ({"related_vocab": [{"term": "a", "translation": "b", "example": "c"}] * 9}, ("related_vocab", "too_many")),
    ({"custom_sections": [{"title": " ", "items": [{"term": "a", "translation": "b", "example": "c"}]}]},
     ("custom_sections[0].title", "blank")),
    ({"custom_sections": [{"title": "t", "items": []}]}, ("custom_sections[0].items", "too_few")),
    ({"custom_sections": [{"title": "t", "items": [{"term": "a", "translation": "b", "example": "c"}] * 9}]},
     ("custom_sections[0].items", "too_many")),
    ({"custom_sections": [{"title": "t", "items": [{"term": " ", "translation": "b", "example": "c"}]}]},
     ("custom_sections[0].items[0].term", "blank")),
    ({"custom_sections": [{"title": "t", "items": [{"term": "a", "translation": "b", "example": "c"}]}] * 7},
     ("custom_sections", "too_many")),
    ({"extra": 1}, ("extra", "unknown_key")),
    ({"examples": [{"target": "a", "origin": "b", "x": 1}, {"target": "a", "origin": "b"}]},
     ("examples[0].x", "unknown_key")),
    ({"source": 5}, ("source", "wrong_type")),
    ({"source": None}, ("source", "missing")),
    ({"word_family": None}, ("word_family", "wrong_type")),
    ({"examples": "a, b"}, ("examples", "wrong_type")),
])
def test_rejections(spark, change, expected):
    r, errs = _one(spark, card_json(**change))
    assert not r.valid and r.card is None
    assert expected in errs


@pytest.mark.parametrize("body,code", [("null", "refusal"), ('{"source":', "malformed_json"),
                                       ("[1, 2]", "not_object"), (None, "malformed_json")])
def test_body_level_errors(spark, body, code):
    r, errs = _one(spark, body)
    assert errs == [("$", code)]


def test_rejects_by_reason(spark):
    from deckforge.operators.validate import rejects_by_reason, validate_cards
    df = spark.createDataFrame([("1", "null"), ("2", "null"), ("3", card_json(extra=1, more=2)), ("4", card_json())],
                               "request_id string, body string")
    got = {r.code: (r.n_errors, r.n_cards) for r in rejects_by_reason(validate_cards(df)).collect()}
    assert got == {"refusal": (2, 2), "unknown_key": (2, 1)}


def test_rejects_name_the_offending_value(spark):
    from deckforge.operators.validate import reject_rows, validate_cards
    bodies = [card_json(extra=1), card_json(**{"odd key.[0]": {"a": [1, "é"]}}), card_json(target_core=5),
              card_json(examples=[{"target": "  ", "origin": "o"}, {"target": "t", "origin": True, "was": [2]}]),
              card_json(word_family=[{"term": "a", "translation": "b", "example": "c"},
                                     {"term": {"x": None}, "translation": "b", "example": None, "nuance": 7}]),
              card_json(examples=[]), card_json(related_vocab="none"), "null", "[1, 2]", '{"source":', None]
    df = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "request_id string, body string")
    got = {(r.request_id, r.path, r.code): r.value for r in reject_rows(validate_cards(df)).collect()}
    assert got == {
        ("0", "extra", "unknown_key"): "1", ("1", "odd key.[0]", "unknown_key"): '{"a":[1,"é"]}',
        ("2", "target_core", "wrong_type"): "5", ("3", "examples[0].target", "blank"): "  ",
        ("3", "examples[1].origin", "wrong_type"): "true", ("3", "examples[1].was", "unknown_key"): "[2]",
        ("4", "word_family[1].term", "wrong_type"): '{"x":null}', ("4", "word_family[1].example", "missing"): None,
        ("4", "word_family[1].nuance", "wrong_type"): "7", ("5", "examples", "too_few"): "[]",
        ("6", "related_vocab", "wrong_type"): "none", ("7", "$", "refusal"): "null", ("8", "$", "not_object"): "[1, 2]",
        ("9", "$", "malformed_json"): '{"source":', ("10", "$", "malformed_json"): None}
