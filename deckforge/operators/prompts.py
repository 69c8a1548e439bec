"""R1 system prompt per deck, N3 section concatenation, J1 items x deck, R2 request table.

The prompt depends only on the deck, so it is built once per deck (a small
table) and referenced from each request by ``prompt_id``; the large request
table never carries a copy of the prompt per row.

Templates are sequences of literal text and ``Field`` references so the same
text renders as a Spark column here and as SQL for the oracle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import casefold
from ..functions.text import py_strip
from .config import attach_level
from .numbering import number_rows


@dataclass(frozen=True)
class Field:
    name: str


Template = tuple[str | Field, ...]

T, O, N, L = Field("target_language"), Field("origin_language"), Field("notes_language"), Field("cefr_level")
LO, HI = Field("min_words"), Field("max_words")

# The prompt is a sheet of named blocks around the card's fields. Only the rules it states (level
# ranges, 2-3 sentences, 3-6 entries, precedence of the learner's rules, plain text) are given.
TASK: Template = (
    "TASK\nMake one ", T, " study card from the line you are sent. Reply with that card object and nothing else. "
    "Its strings are bare text: layout is added later, so leave out markup and enclosing quotes.",)
LEARNER_ONE: Template = ("LEARNER\nReads ", O, ". Level ", L, ".")
LEARNER_TWO: Template = ("LEARNER\nReads ", O, " and ", N, ". Level ", L, ".")
LINE: Template = (
    "LINE\nIt opens with the headword, which may be several words. Anything after it, usually in brackets, is spare "
    "vocabulary: take from it what helps a sentence and forget the rest.",)
HEADWORD: Template = (
    "target_core = the headword as a ", T, " dictionary lists it\n"
    "origin_core = its equivalent in ", O)
STYLES = {
    1: "basics only: common words, short main clauses, now and then a question or a negation",
    2: "the way people talk: idioms, mixed tenses and persons, another scene in each sentence",
    3: "an educated native's: precise and idiomatic words, complex syntax, another scene in each sentence",
}
SENTENCES: Template = (
    "examples = 2 or 3 pairs\n"
    "  target: ", T, ", ", LO, " to ", HI, " words, with the headword in it\n"
    "  origin: what target says, in ", O, "\n"
    "  style: ", Field("style"))
ENTRIES: Template = (
    "word_family = 3 to 6 words of the headword's root, itself excluded\n"
    "related_vocab = 3 to 6 words near it in meaning, or opposite\n"
    "  term, example: ", T, " (the example fits level ", L, ")\n"
    "  translation: ", N, "\n"
    "  nuance: ", N, ", ten words at most; null where none is needed\n"
    "Stop below 3 rather than invent an entry. List no term twice. Further sections only if a rule below asks.",)
FIELDS_HEADER = "FIELDS\n"
RULES_HEADER = ("THE LEARNER'S RULES\nThey replace whatever they contradict above. Two things stay: which language a "
                "field is in, and the fields themselves.\n")
AVOID_HEADER = "AVOID\nWords to leave out of sentences and entries wherever another will do:\n"
BLOCK_JOIN = "\n\n"
FIELD_JOIN = "\n"
USER_TURN_PREFIX = "Line: "


def render(template: Template) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.col(p.name).cast("string") for p in template])


def bullet_lines(lines: Column) -> Column:
    return F.array_join(F.transform(lines, lambda x: F.concat(F.lit("- "), x)), "\n")


def system_prompts(configs: DataFrame, instructions: DataFrame | None = None, key: str = "deck_id") -> DataFrame:
    """R1 + N3 + J2: one ``system_prompt`` per deck.

    ``configs`` are validated decks; ``instructions`` holds ``customization``
    and ``blacklist`` arrays per deck. Blocks: task, learner, line, fields (no
    entries when minimal), the learner's rules (only with lines and not
    minimal), words to avoid (kept in minimal mode). Absent blocks are NULL, so
    ``concat_ws`` leaves no gap."""
    df = attach_level(configs)
    if instructions is not None:
        df = df.join(instructions.select(key, "customization", "blacklist"), key, "left")
    else:
        df = df.withColumns({"customization": F.lit(None).cast("array<string>"),
                             "blacklist": F.lit(None).cast("array<string>")})
    minimal = F.coalesce(F.col("minimal_cards"), F.lit(False))
    same = (F.col("notes_same_as_origin") if "notes_same_as_origin" in df.columns
            else casefold(F.col("origin_language")) == casefold(F.col("notes_language")))
    style = F.when(F.col("tier") == 1, F.lit(STYLES[1])).when(F.col("tier") == 2, F.lit(STYLES[2])).otherwise(
        F.lit(STYLES[3]))
    df = df.withColumn("style", style)
    fields = F.concat(F.lit(FIELDS_HEADER), F.concat_ws(
        FIELD_JOIN, render(HEADWORD), render(SENTENCES), F.when(~minimal, render(ENTRIES))))
    rules, avoid = (F.coalesce(F.col(c), F.array().cast("array<string>")) for c in ("customization", "blacklist"))
    prompt = F.concat_ws(
        BLOCK_JOIN, render(TASK), F.when(same, render(LEARNER_ONE)).otherwise(render(LEARNER_TWO)), render(LINE),
        fields, F.when(~minimal & (F.size(rules) > 0), F.concat(F.lit(RULES_HEADER), bullet_lines(rules))),
        F.when(F.size(avoid) > 0, F.concat(F.lit(AVOID_HEADER), bullet_lines(avoid))))
    return df.select(key, prompt.alias("system_prompt"), "text_model", "reasoning_effort",
                     "minimal_cards", "customization", "blacklist") \
        .withColumn("prompt_id", F.sha2("system_prompt", 256))


def attach_config(items: DataFrame, decks: DataFrame, key: str = "deck_id") -> DataFrame:
    """Every item joined to its deck's settings snapshot (inner: items of
    rejected decks get no request). No hint: Spark picks the join by size."""
    return items.join(decks, key)


def _occurrences(items: DataFrame, key: str, line_col: str, item_col: str) -> DataFrame:
    """Which occurrence of its text in its deck each item is, as ``_occurrence``. Texts are counted by hash, and only
    hashes of several rows are kept; rows without one of these are first occurrences where they are, and
    just the others are dealt out and numbered."""
    hashed = items.withColumn("_text", F.xxhash64(key, item_col))
    several = hashed.groupBy("_text").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_text")
    once = hashed.join(several, "_text", "left_anti").withColumn("_occurrence", F.lit(1).cast("bigint"))
    again = number_rows(hashed.join(several, "_text", "left_semi"), [key, item_col], line_col, "_occurrence")
    return once.unionByName(again).drop("_text")


def build_requests(items: DataFrame, prompts: DataFrame, key: str = "deck_id",
                   line_col: str = "line_no", item_col: str = "item") -> DataFrame:
    """R2: ``(deck_id, line_no, item, request_id, prompt_id, prompt_chars,
    user_content, model, reasoning_effort)``. Items are stripped; a blank item never becomes a
    request (F3, see ``blank_items``). ``request_id`` hashes everything the call depends on and, for
    an item that a deck repeats, which occurrence it is: a line put in or taken out elsewhere in the
    deck changes no other request. The prompt text stays in ``prompts`` (one row per deck)."""
    deck_side = prompts.select(key, "prompt_id", F.length("system_prompt").cast("bigint").alias("prompt_chars"),
                               F.col("text_model").alias("model"), "reasoning_effort")
    cleaned = items.select(key, line_col, py_strip(item_col).alias(item_col)).filter(F.col(item_col) != "")
    joined = attach_config(_occurrences(cleaned, key, line_col, item_col), deck_side, key)
    user = F.concat(F.lit(USER_TURN_PREFIX), F.col(item_col))
    rid = F.sha2(F.concat_ws("\u001f", F.col(key).cast("string"), F.col("_occurrence").cast("string"),
                             F.col("model"), F.coalesce(F.col("reasoning_effort"), F.lit("")),
                             F.col("prompt_id"), user), 256)
    return joined.select(key, line_col, item_col, rid.alias("request_id"), "prompt_id", "prompt_chars",
                         user.alias("user_content"), "model", "reasoning_effort")


PAYLOAD_SQL = ("to_json(named_struct('model', model, 'messages', array("
               "named_struct('role', 'system', 'content', system_prompt), "
               "named_struct('role', 'user', 'content', user_content)), 'reasoning_effort', reasoning_effort))")


def request_payloads(requests: DataFrame, prompts: DataFrame, key: str = "deck_id") -> DataFrame:
    """The chat payload per request, built just before the call: messages
    ``[system, user]`` and ``reasoning_effort`` omitted when NULL (``to_json``
    drops NULL fields)."""
    p = prompts.select(key, "prompt_id", "system_prompt")
    joined = requests.join(p, [key, "prompt_id"])
    return joined.select("request_id", key, "line_no", F.expr(PAYLOAD_SQL).alias("payload"))


def blank_items(items: DataFrame, keys: tuple[str, ...] = ("deck_id", "line_no"), item_col: str = "item") -> DataFrame:
    """items that are blank after stripping, reported with ``blank_item``."""
    return (items.filter(py_strip(item_col) == "")
            .select(*keys, F.lit("blank_item").alias("code")))
