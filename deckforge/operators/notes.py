"""Cards -> notes: N1 note-item flattening, N2 example fan-out, T1-T8 rendering.

Rendering is one projection of native string/array expressions over the card
struct (``transform`` / ``array_join`` / ``concat_ws``), built as SQL text and
evaluated row by row with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import note_key_sql
from ..functions.text import capitalize_sql, escape_sql, sql_lit

# --- fixed values: note HTML ---------------------------------------------------
SECTION_BREAK = "<br><br>"
LINE_BREAK = "<br>"
NOTES_HEADER = "<b>--- NOTES ---</b>"
WORD_FAMILY_TITLE = "Word family"
RELATED_VOCAB_TITLE = "Related vocab"
NOTE_EXAMPLE_STYLE = "color: #39ff14; font-style: italic;"
# ------------------------------------------------------------------------------

NOTE_ITEM_TYPE = "struct<term:string,translation:string,nuance:string,example:string>"
SECTIONS_TYPE = f"array<struct<section_no:int,title:string,items:array<{NOTE_ITEM_TYPE}>>>"


def note_sections_sql(card: str = "card") -> str:
    """Ordered sections: word family, related vocab, then each custom section,
    as ``struct(section_no, title, items)``; sections without items dropped."""
    fixed = (f"array(named_struct('section_no', 1, 'title', {sql_lit(WORD_FAMILY_TITLE)}, "
             f"'items', {card}.word_family), "
             f"named_struct('section_no', 2, 'title', {sql_lit(RELATED_VOCAB_TITLE)}, "
             f"'items', {card}.related_vocab))")
    custom = (f"coalesce(transform({card}.custom_sections, (cs_, ci_) -> named_struct("
              f"'section_no', ci_ + 3, 'title', cs_.title, 'items', cs_.items)), cast(array() as {SECTIONS_TYPE}))")
    return f"filter(concat({fixed}, {custom}), sx_ -> coalesce(size(sx_.items), 0) > 0)"


def flatten_notes(cards: DataFrame, keys: list[str], card: str = "card") -> DataFrame:
    """One row per note item, in rendering order:
    ``(keys..., section_no, title, item_no, term, translation, nuance, example)``."""
    sec = cards.select(*keys, F.explode(F.expr(note_sections_sql(card))).alias("s"))
    return sec.select(*keys, F.col("s.section_no").cast("bigint").alias("section_no"),
                      F.col("s.title").alias("title"),
                      F.posexplode("s.items").alias("pos", "it")) \
        .select(*keys, "section_no", "title", (F.col("pos") + 1).cast("bigint").alias("item_no"),
                F.col("it.term").alias("term"), F.col("it.translation").alias("translation"),
                F.col("it.nuance").alias("nuance"), F.col("it.example").alias("example"))


def note_item_count(card: str = "card") -> Column:
    """How many rows ``flatten_notes`` makes of a card."""
    return F.expr(f"coalesce(aggregate({note_sections_sql(card)}, 0L, (ni_, ns_) -> ni_ + coalesce(size(ns_.items), 0)), 0L)")


def explode_examples(cards: DataFrame, keys: list[str], card: str = "card") -> DataFrame:
    """One row per example sentence, ``example_no`` 1-based in card order."""
    return (cards.select(*keys, F.col(card), F.posexplode(f"{card}.examples").alias("pos", "ex"))
            .select(*keys, card, (F.col("pos") + 1).cast("bigint").alias("example_no"),
                    F.col("ex.target").alias("target"), F.col("ex.origin").alias("origin")))


def _bold(x: str) -> str:
    return f"concat('<b>', {escape_sql(x)}, '</b>')"


def note_item_html_sql(it: str) -> str:
    """Underlined term, ``: translation``, optional italic nuance, then the
    styled, quoted example on the next line."""
    nuance = (f"CASE WHEN {it}.nuance IS NOT NULL AND {it}.nuance != '' "
              f"THEN concat(' (<i>', {escape_sql(it + '.nuance')}, '</i>)') ELSE '' END")
    return (f"concat('<u>', {escape_sql(capitalize_sql(it + '.term'))}, '</u>: ', "
            f"{escape_sql(it + '.translation')}, {nuance}, {sql_lit(LINE_BREAK)}, "
            f"{sql_lit('<span style=\"' + NOTE_EXAMPLE_STYLE + '\">\"')}, "
            f"{escape_sql(capitalize_sql(it + '.example'))}, {sql_lit('\"</span>')})")


def notes_html_sql(card: str = "card") -> str:
    """T5: header, then each non-empty section (bold title, items one per line);
    NULL when the card has no note items."""
    rendered = (f"transform({note_sections_sql(card)}, sr_ -> concat({_bold('sr_.title')}, "
                f"{sql_lit(LINE_BREAK)}, array_join(transform(sr_.items, ni_ -> {note_item_html_sql('ni_')}), "
                f"{sql_lit(LINE_BREAK)})))")
    return (f"CASE WHEN size({note_sections_sql(card)}) > 0 THEN concat({sql_lit(NOTES_HEADER + LINE_BREAK)}, "
            f"array_join({rendered}, {sql_lit(SECTION_BREAK)})) END")


def front_text_sql(card: str = "card") -> str:
    """Bold origin core, then each origin sentence."""
    return (f"array_join(concat(array({_bold(capitalize_sql(card + '.origin_core'))}), "
            f"transform({card}.examples, ex_ -> {escape_sql(capitalize_sql('ex_.origin'))})), "
            f"{sql_lit(SECTION_BREAK)})")


def back_text_sql(card: str = "card", minimal: str | None = None) -> str:
    """T4: bold target core, each target sentence, then the notes block unless
    minimal or empty (``concat_ws`` skips the NULL)."""
    notes = notes_html_sql(card)
    if minimal is not None:
        notes = f"CASE WHEN NOT coalesce({minimal}, false) THEN {notes} END"
    sentences = f"transform({card}.examples, ex_ -> {escape_sql(capitalize_sql('ex_.target'))})"
    return (f"concat_ws({sql_lit(SECTION_BREAK)}, {_bold(capitalize_sql(card + '.target_core'))}, "
            f"{sentences}, {notes})")


def sound_refs_sql(files: str) -> str:
    """``[sound:a.mp3] [sound:b.mp3]``; empty text when there are no files."""
    return (f"array_join(transform(coalesce({files}, cast(array() as array<string>)), "
            f"f_ -> concat('[sound:', f_, ']')), ' ')")


def render_notes(cards: DataFrame, keys: list[str], card: str = "card",
                 minimal_col: str = "minimal_cards", files_col: str = "audio_files",
                 tags_col: str | None = "tags", version: str | None = None) -> DataFrame:
    """``(keys..., note_guid, front_text, back_text, back_audio, tags)``.

    ``cards`` carries the deck's ``minimal_cards`` flag, the gathered audio file
    names and the deck tags (already joined: J1/J5/I5)."""
    guid = (note_key_sql(f"{card}.source", f"{card}.origin_core", f"{card}.target_core") if version is None
            else note_key_sql(f"{card}.source", f"{card}.origin_core", f"{card}.target_core", version))
    minimal = minimal_col if minimal_col in cards.columns else None
    files = files_col if files_col in cards.columns else "cast(null as array<string>)"
    cols = [*keys, F.expr(guid).alias("note_guid"), F.expr(front_text_sql(card)).alias("front_text"),
            F.expr(back_text_sql(card, minimal)).alias("back_text"),
            F.expr(sound_refs_sql(files)).alias("back_audio")]
    if tags_col and tags_col in cards.columns:
        cols.append(F.col(tags_col).alias("tags"))
    return cards.select(*cols)
