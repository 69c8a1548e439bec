"""Content-rule checks on cards (reports, never rejections):

C1 sentence length vs the level's range, C2 core concept in every sentence,
C3 no markup, C4 3-6 items per default note section, C5 short nuances,
G5 repeated note terms, J6 blacklist hits.

Each rule is an array expression over the card (at most 3 sentences and 62 note
items); the functions explode one of them, ``quality_report`` all of them at
once. The only joins bring a deck's level and blacklist to its cards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import sql_lit, word_count_sql, word_tokens_sql
from .config import attach_level

# --- fixed values ----------------------------------------------------------------
DEFAULT_SECTION_MIN, DEFAULT_SECTION_MAX = 3, 6
NUANCE_MAX_WORDS = 10
# HTML tags or markdown markers: <x or </, **, __, backticks, heading #, [text](
MARKUP_PATTERN = r"<[A-Za-z/]|\*\*|__|`|^#{1,6} |\[[^\]]*\]\("
# ----------------------------------------------------------------------------------

_LOC = "struct<location:string,text:string>"


def _items_texts(arr: str, name: str, fields: tuple[str, ...]) -> str:
    """One (location, text) per field of each note item of ``arr``."""
    entries = ", ".join(
        f"named_struct('location', concat('{name}[', CAST(qi_ AS STRING), '].{f}'), 'text', qw_.{f})"
        for f in fields)
    return f"flatten(transform({arr}, (qw_, qi_) -> array({entries})))"


def card_texts_sql(card: str = "card", note_fields: tuple[str, ...] = ("term", "example"),
                   with_cores: bool = False, with_origin: bool = False) -> str:
    """Array of (location, text) over a card's sentences and note items."""
    parts = []
    if with_cores:
        parts.append(f"array(named_struct('location', 'target_core', 'text', {card}.target_core), "
                     f"named_struct('location', 'origin_core', 'text', {card}.origin_core))")
    parts.append(f"transform({card}.examples, (qe_, qi_) -> named_struct('location', "
                 f"concat('examples[', CAST(qi_ AS STRING), '].target'), 'text', qe_.target))")
    if with_origin:
        parts.append(f"transform({card}.examples, (qe_, qi_) -> named_struct('location', "
                     f"concat('examples[', CAST(qi_ AS STRING), '].origin'), 'text', qe_.origin))")
    parts.append(_items_texts(f"{card}.word_family", "word_family", note_fields))
    parts.append(_items_texts(f"{card}.related_vocab", "related_vocab", note_fields))
    per_item = ", ".join(
        f"named_struct('location', concat('custom_sections[', CAST(qk_ AS STRING), "
        f"'].items[', CAST(qi_ AS STRING), '].{f}'), 'text', qw_.{f})" for f in note_fields)
    custom = (f"flatten(transform({card}.custom_sections, (qs_, qk_) -> "
              f"flatten(transform(qs_.items, (qw_, qi_) -> array({per_item})))))")
    parts.append(custom)
    if with_cores:
        parts.append(f"transform({card}.custom_sections, (qs_, qk_) -> named_struct('location', "
                     f"concat('custom_sections[', CAST(qk_ AS STRING), '].title'), 'text', qs_.title))")
    return "concat(" + ", ".join(f"coalesce({p}, cast(array() as array<{_LOC}>))" for p in parts) + ")"


def level_length(cards: DataFrame, decks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Words per example sentence against the deck level's range
    ``(keys..., example_no, n_words, min_words, max_words, in_range)``."""
    keys = keys or ["deck_id", "line_no"]
    lv = attach_level(decks.select("deck_id", "cefr_level")).select("deck_id", "min_words", "max_words")
    ex = cards.join(lv, "deck_id").select(*keys, "min_words", "max_words",
                                          F.posexplode("card.examples").alias("pos", "e"))
    n = F.expr(word_count_sql("e.target"))
    return ex.select(*keys, (F.col("pos") + 1).cast("bigint").alias("example_no"),
                     n.cast("bigint").alias("n_words"), "min_words", "max_words",
                     ((n >= F.col("min_words")) & (n <= F.col("max_words"))).alias("in_range"))


def _rules_sql(minimal: str) -> str:
    """Array of (rule, location)."""
    core_missing = ("transform(filter(transform(card.examples, (ce_, ci_) -> named_struct('i', ci_, 'ok', "
                    "contains(lower(ce_.target), lower(card.target_core)))), cf_ -> NOT cf_.ok), "
                    "cf_ -> named_struct('rule', 'core_missing', 'location', "
                    "concat('examples[', CAST(cf_.i AS STRING), '].target')))")
    all_texts = card_texts_sql("card", ("term", "translation", "nuance", "example"), True, True)
    markup = (f"transform(filter({all_texts}, mt_ -> mt_.text RLIKE {sql_lit(MARKUP_PATTERN)}), "
              f"mt_ -> named_struct('rule', 'markup', 'location', mt_.location))")
    sizes = (f"filter(array("
             + ", ".join(f"CASE WHEN NOT {minimal} AND (size(card.{s}) < {DEFAULT_SECTION_MIN} OR "
                         f"size(card.{s}) > {DEFAULT_SECTION_MAX}) THEN named_struct('rule', 'section_size', "
                         f"'location', '{s}') END" for s in ("word_family", "related_vocab"))
             + "), sz_ -> sz_ IS NOT NULL)")
    nuances = card_texts_sql("card", ("nuance",))
    long_nuance = (f"transform(filter({nuances}, nt_ -> nt_.location NOT LIKE 'examples%' AND "
                   f"nt_.text IS NOT NULL AND {word_count_sql('nt_.text')} > {NUANCE_MAX_WORDS}), "
                   f"nt_ -> named_struct('rule', 'long_nuance', 'location', nt_.location))")
    return f"concat({core_missing}, {markup}, {sizes}, {long_nuance})"


def _minimal(cards: DataFrame, minimal_col: str) -> str:
    return f"coalesce({minimal_col}, false)" if minimal_col in cards.columns else "false"


def content_rules(cards: DataFrame, minimal_col: str = "minimal_cards",
                  keys: list[str] | None = None) -> DataFrame:
    """``(keys..., rule, location)``, one row per finding."""
    keys = keys or ["deck_id", "line_no"]
    found = F.explode(F.expr(_rules_sql(_minimal(cards, minimal_col))))
    return cards.select(*keys, found.alias("f")).select(*keys, "f.rule", "f.location")


def _terms_sql() -> str:
    """Array of (term, rule)."""
    terms = ("transform(filter(" + card_texts_sql("card", ("term",)) +
             ", rt_ -> rt_.location NOT LIKE 'examples%'), rt_ -> lower(rt_.text))")
    return (f"concat(transform(filter(array_distinct({terms}), ru_ -> size(filter({terms}, rv_ -> rv_ = ru_)) > 1), "
            f"ru_ -> named_struct('term', ru_, 'rule', 'repeated')), "
            f"transform(filter(array_distinct({terms}), ru_ -> ru_ = lower(card.target_core)), "
            f"ru_ -> named_struct('term', ru_, 'rule', 'is_core')))")


def repeated_terms(cards: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``(keys..., term, rule)``: a note term (lower-cased) used by more than
    one note item of the card (``repeated``), or equal to the core concept
    (``is_core``). Computed inside each card row."""
    keys = keys or ["deck_id", "line_no"]
    return cards.select(*keys, F.explode(F.expr(_terms_sql())).alias("f")).select(*keys, "f.term", "f.rule")


def _deck_lists(blacklist: DataFrame) -> DataFrame:
    """``(deck_id, _listed, _firsts)``: a deck's entries with their words (a side file's lines, 8 KiB at most), and
    the different first words of them."""
    entries = blacklist.select("deck_id", "entry", F.expr(word_tokens_sql("entry")).alias("tok")).filter(
        F.size("tok") > 0)
    return entries.groupBy("deck_id").agg(F.collect_list(F.struct("entry", "tok")).alias("_listed"),
                                          F.collect_set(F.col("tok")[0]).alias("_firsts"))


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` standing for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _hits_sql() -> str:
    """Array of (location, position, entry) of ``_listed`` in the card's texts. One hashed intersection of
    the card's words with the first words of the entries leaves the entries that can occur at all; only these are
    looked for, and only where their first word is."""
    places = ("filter(sequence(0, size(tx_.tok) - size(en_.tok)), at_ -> tx_.tok[at_] = en_.tok[0] "
              "AND slice(tx_.tok, at_ + 1, size(en_.tok)) = en_.tok)")
    in_text = (f"flatten(transform(filter(may_, en_ -> size(en_.tok) <= size(tx_.tok)), en_ -> transform({places}, "
               "at_ -> named_struct('location', tx_.location, 'position', CAST(at_ AS BIGINT), 'entry', en_.entry))))")
    words = (f"transform({card_texts_sql('card')}, tw_ -> named_struct('location', tw_.location, 'tok', "
             f"coalesce({word_tokens_sql('tw_.text')}, CAST(array() AS array<string>))))")
    may = "filter(_listed, en_ -> array_contains(fw_, en_.tok[0]))"
    return _let("td_", words, _let("fw_", "array_intersect(flatten(td_.tok), _firsts)", _let(
        "may_", may, f"flatten(transform(td_, tx_ -> {in_text}))")))


def blacklist_hits(cards: DataFrame, blacklist: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``(keys..., location, position, entry)`` for every place where a
    deck's blacklist entry occurs, as a whole-word sequence (case-insensitive),
    in a sentence or note item (terms and examples; not the core concept).

    ``blacklist`` is ``(deck_id, entry)``; a deck's entries go to its cards as one
    array and are matched in the row: one join by deck, no shuffle of words."""
    keys = keys or ["deck_id", "line_no"]
    return cards.join(_deck_lists(blacklist), "deck_id").select(*keys, F.explode(F.expr(_hits_sql())).alias(
        "h")).select(*keys, "h.location", "h.position", "h.entry")


def quality_report(cards: DataFrame, decks: DataFrame, blacklist: DataFrame | None = None,
                   keys: list[str] | None = None) -> DataFrame:
    """All content findings in one table: ``(keys..., rule, location, detail)``.

    Rules: ``sentence_length`` (C1, detail = word count, only outside the
    level's range), ``core_missing`` / ``markup`` / ``section_size`` /
    ``long_nuance`` (C2-C5), ``repeated_term`` / ``term_is_core`` (G5, detail =
    term) and ``blacklisted`` (J6, detail = entry). Reports only; no card is
    rejected here."""
    keys = keys or ["deck_id", "line_no"]
    lv = attach_level(decks.select("deck_id", "cefr_level")).select("deck_id", "min_words", "max_words")
    rows = cards.select(*keys, "card", F.expr(_minimal(cards, "minimal_cards")).alias("_minimal")).join(
        lv, "deck_id", "left")
    null, finding = "CAST(NULL AS STRING)", "named_struct('rule', {}, 'location', {}, 'detail', {})"
    length = (f"transform(filter(transform(card.examples, (le_, li_) -> named_struct('i', li_, 'n', "
              f"{word_count_sql('le_.target')})), lf_ -> NOT lf_.n BETWEEN min_words AND max_words), lf_ -> "
              + finding.format("'sentence_length'", "concat('examples[', CAST(lf_.i AS STRING), '].target')",
                               "CAST(lf_.n AS STRING)") + ")")
    arrays = [length,
              f"transform({_rules_sql('_minimal')}, fr_ -> {finding.format('fr_.rule', 'fr_.location', null)})",
              f"transform({_terms_sql()}, ft_ -> " + finding.format(
                  "CASE ft_.rule WHEN 'repeated' THEN 'repeated_term' ELSE 'term_is_core' END", null, "ft_.term") + ")"]
    if blacklist is not None:
        rows = rows.join(_deck_lists(blacklist), "deck_id", "left")
        hits = f"coalesce({_hits_sql()}, array())"
        arrays.append(f"transform({hits}, fh_ -> {finding.format(repr('blacklisted'), 'fh_.location', 'fh_.entry')})")
    return rows.select(*keys, F.explode(F.expr(f"concat({', '.join(arrays)})")).alias("f")).select(
        *keys, "f.rule", "f.location", "f.detail")
