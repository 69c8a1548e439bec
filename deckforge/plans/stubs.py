"""Deterministic stand-ins for the model and speech functions (tests and
registered stub queries; no network client is shipped)."""

from __future__ import annotations

import json


def stub_card_fn() -> "callable":
    """A card generator that answers every payload with a valid card built
    from its user turn (the item becomes source, core and sentences)."""

    def answer(payload: str) -> str:
        req = json.loads(payload)
        item = req["messages"][-1]["content"].split(": ", 1)[-1]
        core = item.split("(")[0].strip() or item
        return json.dumps({
            "source": item, "target_core": core, "origin_core": core,
            "examples": [{"target": f"{core} one.", "origin": f"{core} uno."},
                         {"target": f"{core} two.", "origin": f"{core} dos."}],
            "word_family": [{"term": core, "translation": core, "nuance": None, "example": f"{core} three."}],
        })

    return answer


def stub_speech_fn() -> "callable":
    """A speech function that returns the UTF-8 bytes of the text."""

    def speak(text: str, model: str, voice: str) -> bytes:
        if not text.strip():
            raise ValueError("nothing to say")
        return text.encode("utf-8")

    return speak
