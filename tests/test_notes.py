"""Rendered fields, from the rules: escaping, capitals, section order, what is left out when empty."""

import pytest
from factories import card_json, entry, validated_cards
from pyspark.sql import functions as F

STYLE = '<span style="color: #39ff14; font-style: italic;">'


def render(spark, minimal=False, audio=None, **changes):
    from deckforge.operators.notes import render_notes
    cards = validated_cards(spark, [card_json(**changes)]).withColumn("minimal_cards", F.lit(minimal))
    if audio:
        cards = cards.withColumn("audio_files", F.array(*map(F.lit, audio)))
    return render_notes(cards, ["deck_id", "line_no"]).first()


def test_each_side_is_the_core_and_its_sentences(spark):
    note = render(spark, minimal=True)
    assert note.front_text.split("<br><br>") == ["<b>Bread</b>", "The bread comes out golden.",
                                                 "Buy bread for dinner, please."]
    assert note.back_text.split("<br><br>") == ["<b>Pan</b>", "El pan sale dorado.",
                                                "Compra pan para la cena, por favor."]


def test_entries_stand_under_their_section(spark):
    head, *entries = render(spark, related_vocab=[]).back_text.split("<b>Word family</b><br>")[1].split("<u>")
    assert head == "" and len(entries) == 2
    assert entries[0] == f'Panadero</u>: baker (<i>a trade</i>)<br>{STYLE}"El panadero madruga."</span><br>'
    assert entries[1] == f'Panecillo</u>: roll<br>{STYLE}"Quiero un panecillo."</span>'


@pytest.mark.parametrize("field", ["term", "translation", "nuance", "example"])
def test_entry_text_is_escaped(spark, field):
    odd = entry("a", "b", "c", "d") | {field: "R&D <x>"}
    back = render(spark, word_family=[odd]).back_text
    assert "R&amp;D &lt;x&gt;" in back and "<x>" not in back


@pytest.mark.parametrize("lists, titles", [
    ({"word_family": [], "related_vocab": []}, []),
    ({"related_vocab": []}, ["Word family"]),
    ({"word_family": []}, ["Related vocab"]),
    ({"custom_sections": [{"title": "Saying & so on", "items": [entry("t", "u", "v")]}]},
     ["Word family", "Related vocab", "Saying &amp; so on"]),
])
def test_sections_in_order_and_none_when_empty(spark, lists, titles):
    back = render(spark, **lists).back_text
    parts = back.split("<b>--- NOTES ---</b>")
    assert len(parts) == 1 + bool(titles)
    at = [parts[-1].find(f"<b>{t}</b>") for t in titles]
    assert at == sorted(at) and -1 not in at
    assert ("Word family" in back) == ("Word family" in titles)


def test_lines_start_with_capitals_and_colons_stay(spark):
    back = render(spark, examples=[{"target": "¡pan! otro.", "origin": "bread! more."}] * 2,
                  word_family=[entry("ñora", "pepper: dried", "¿ñora o pimiento?")]).back_text
    assert "¡Pan! Otro." in back and "<u>Ñora</u>: pepper: dried<br>" in back and '"¿Ñora o pimiento?"' in back


def test_audio_refers_to_files_in_order(spark):
    assert render(spark, audio=["b.mp3", "a.mp3"]).back_audio == "[sound:b.mp3] [sound:a.mp3]"
    assert render(spark).back_audio == ""


def test_entries_are_numbered_within_sections(spark):
    from deckforge.operators.notes import flatten_notes
    cards = validated_cards(spark, [card_json(custom_sections=[{"title": "X", "items": [entry("z", "y", "w")]}])])
    got = {(r.section_no, r.item_no): r.term for r in flatten_notes(cards, ["deck_id", "line_no"]).collect()}
    assert got == {(1, 1): "panadero", (1, 2): "panecillo", (2, 1): "harina", (3, 1): "z"}
