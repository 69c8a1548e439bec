"""A plain card about baking: two sentences, one relative with a nuance and one without, one neighbour."""

from __future__ import annotations

import json


def entry(term: str, translation: str, example: str, nuance: str | None = None) -> dict:
    return {"term": term, "translation": translation, "nuance": nuance, "example": example}


def card_dict(**changes) -> dict:
    sentences = [("El pan sale dorado.", "The bread comes out golden."),
                 ("Compra pan para la cena, por favor.", "Buy bread for dinner, please.")]
    card = {"source": "bread", "target_core": "pan", "origin_core": "bread",
            "examples": [{"target": t, "origin": o} for t, o in sentences],
            "word_family": [entry("panadero", "baker", "El panadero madruga.", "a trade"),
                            entry("panecillo", "roll", "Quiero un panecillo.")],
            "related_vocab": [entry("harina", "flour", "Falta harina.")]}
    return card | changes


def card_json(**changes) -> str:
    return json.dumps(card_dict(**changes))


def validated_cards(spark, bodies: list[str]):
    """Validated cards (deck_id 1, line_no 1..n) from JSON bodies."""
    from deckforge.operators.validate import validate_cards
    rows = [(str(n), body) for n, body in enumerate(bodies, 1)]
    checked = validate_cards(spark.createDataFrame(rows, "request_id string, body string"))
    return checked.selectExpr("1L AS deck_id", "CAST(request_id AS BIGINT) AS line_no", "card", "valid", "errors")
