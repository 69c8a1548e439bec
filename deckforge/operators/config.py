"""V1 deck-config validation and defaulting, V1w defaulted-field warnings,
J2 level lookup, I5 deck tags.

One row per deck; the table is small, so this is the one place where the
casefold UDF runs (language collision checks need Unicode case folding).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import ascii_slug, casefold, deck_tags, with_slug
from ..functions.text import sql_lit, strip_sql
from ..schemas import RAW_CONFIG_FIELDS

# --- fixed values ---------------------------------------------------------------
CEFR_LEVELS = ["A1", "A2", "B1", "B2", "C1", "C2"]
REASONING_EFFORTS = ["none", "minimal", "low", "medium", "high", "xhigh", "max"]
BOOL_TRUE = ["true", "1", "yes", "on", "t", "y"]
BOOL_FALSE = ["false", "0", "no", "off", "f", "n"]
DEFAULTS = {
    "text_model": "gpt-4.1-mini",
    "audio_model": "gpt-4o-mini-tts",
    "audio_voice": "alloy",
    "input_path": "items.txt",
    "output_path": "deck.apkg",
    "customization_path": "customization.txt",
    "blacklist_path": "blacklist.txt",
}
BOOL_DEFAULTS = {"generate_audio": True, "minimal_cards": False, "overwrite_output": False}
# Fields that produce a "left at its default" warning (never toggles or side-file paths).
WARN_IF_DEFAULTED = ["text_model", "audio_model", "audio_voice", "deck_name", "input_path", "output_path"]
# Level -> words per example sentence (min, max) and guidance tier.
LEVELS = [
    ("A1", 5, 9, 1), ("A2", 5, 9, 1),
    ("B1", 6, 12, 2), ("B2", 6, 12, 2),
    ("C1", 7, 15, 3), ("C2", 7, 15, 3),
]
# --------------------------------------------------------------------------------

DEFAULT_DECK_NAME = "Deckforge Deck"
LANGUAGE_FIELDS = ["origin_language", "target_language", "notes_language"]


def _q(values: list[str]) -> str:
    return ", ".join(sql_lit(v) for v in values)


def _unset(c: str) -> str:
    """Unset = NULL or exactly empty (as an empty environment value)."""
    return f"({c} IS NULL OR {c} = '')"


def _err(field: str, code: str, value: str | None = None) -> str:
    v = f"CAST({value} AS STRING)" if value else "CAST(NULL AS STRING)"
    return f"named_struct('field', '{field}', 'code', '{code}', 'value', {v})"


def _field_errors_sql() -> str:
    checks = []
    for f in LANGUAGE_FIELDS:
        checks.append(f"CASE WHEN {_unset(f)} THEN {_err(f, 'missing')} END")
        checks.append(f"CASE WHEN NOT {_unset(f)} AND {strip_sql(f)} = '' THEN {_err(f, 'blank', f)} END")
    level = f"upper({strip_sql('cefr_level')})"
    checks.append(f"CASE WHEN {_unset('cefr_level')} THEN {_err('cefr_level', 'missing')} END")
    checks.append(f"CASE WHEN NOT {_unset('cefr_level')} AND {level} NOT IN ({_q(CEFR_LEVELS)}) "
                  f"THEN {_err('cefr_level', 'invalid', 'cefr_level')} END")
    effort = f"lower({strip_sql('reasoning_effort')})"
    checks.append(f"CASE WHEN NOT {_unset('reasoning_effort')} AND {effort} != '' AND {effort} NOT IN "
                  f"({_q(REASONING_EFFORTS)}) THEN {_err('reasoning_effort', 'invalid', 'reasoning_effort')} END")
    for f in BOOL_DEFAULTS:
        checks.append(f"CASE WHEN NOT {_unset(f)} AND lower({f}) NOT IN ({_q(BOOL_TRUE + BOOL_FALSE)}) "
                      f"THEN {_err(f, 'invalid', f)} END")
    return f"filter(array({', '.join(checks)}), e_ -> e_ IS NOT NULL)"


def _normalised_sql() -> list[str]:
    level = f"upper({strip_sql('cefr_level')})"
    effort = f"lower({strip_sql('reasoning_effort')})"
    cols = [f"CASE WHEN NOT {_unset(f)} THEN {strip_sql(f)} END AS {f}" for f in LANGUAGE_FIELDS]
    cols.append(f"CASE WHEN NOT {_unset('cefr_level')} THEN {level} END AS cefr_level")
    cols.append(f"CASE WHEN NOT {_unset('reasoning_effort')} AND {effort} != '' THEN {effort} END "
                f"AS reasoning_effort")
    cols.append(f"CASE WHEN {_unset('deck_name')} THEN {sql_lit(DEFAULT_DECK_NAME)} ELSE deck_name END AS deck_name")
    cols += [f"CASE WHEN {_unset(f)} THEN {sql_lit(v)} ELSE {f} END AS {f}" for f, v in DEFAULTS.items()]
    cols += [f"CASE WHEN {_unset(f)} THEN {str(v).lower()} ELSE lower({f}) IN ({_q(BOOL_TRUE)}) END AS {f}"
             for f, v in BOOL_DEFAULTS.items()]
    warn = ", ".join(f"CASE WHEN {_unset(f)} THEN '{f}' END" for f in WARN_IF_DEFAULTED)
    cols.append(f"filter(array({warn}), w_ -> w_ IS NOT NULL) AS defaulted")
    cols.append(f"{_field_errors_sql()} AS _field_errors")
    return cols


def _with_all_fields(df: DataFrame) -> DataFrame:
    missing = {f: F.lit(None).cast("string") for f in RAW_CONFIG_FIELDS if f not in df.columns}
    return df.withColumns(missing) if missing else df


_ERRORS_TYPE = "array<struct<field:string,code:string,value:string>>"


def validate_configs(raw: DataFrame, key: str = "deck_id") -> DataFrame:
    """V1 + V1w over a table of raw (string) deck settings.

    Returns every deck with normalised settings, ``errors`` (ARRAY<STRUCT<field,
    code, value>>; the value is echoed unless the field was missing),
    ``defaulted`` (ARRAY<STRING>), ``notes_same_as_origin`` (case-folded) and
    ``valid``. Field checks come first; the
    language-collision check (Unicode case folding) runs only when every field
    is valid."""
    df = _with_all_fields(raw).selectExpr(key, *_normalised_sql())
    folded = df.select("*", *[casefold(F.col(f)).alias(f"_cf_{f}") for f in LANGUAGE_FIELDS])
    collision = (
        "CASE WHEN size(_field_errors) = 0 AND _cf_target_language = _cf_origin_language "
        f"THEN array({_err('target_language', 'same_as_origin')}) "
        "WHEN size(_field_errors) = 0 AND _cf_target_language = _cf_notes_language "
        f"THEN array({_err('target_language', 'same_as_notes')}) "
        f"ELSE CAST(array() AS {_ERRORS_TYPE}) END")
    out = folded.withColumn("errors", F.expr(f"concat(_field_errors, {collision})")).withColumn(
        "notes_same_as_origin", F.expr("_cf_origin_language = _cf_notes_language"))
    return (out.drop("_field_errors", *[f"_cf_{f}" for f in LANGUAGE_FIELDS])
            .withColumn("valid", F.expr("size(errors) = 0")))


def config_errors(checked: DataFrame, key: str = "deck_id") -> DataFrame:
    """V3 for configs: one row per (deck, error)."""
    return checked.select(key, F.explode("errors").alias("e")).select(
        key, F.col("e.field").alias("field"), F.col("e.code").alias("code"), F.col("e.value").alias("value"))


def levels(spark: SparkSession) -> DataFrame:
    """J2 lookup table (6 rows): level -> min/max words per sentence, tier."""
    return spark.createDataFrame(LEVELS, "cefr_level string, min_words int, max_words int, tier int")


def attach_level(configs: DataFrame) -> DataFrame:
    """Add sentence-length range and tier; the 6-row table is broadcast
    (its size is fixed)."""
    return configs.join(F.broadcast(levels(configs.sparkSession)), "cefr_level", "left")


def with_deck_tags(configs: DataFrame) -> DataFrame:
    """I4 + I5: ``tags = [lang::<slug(target)>, level::<slug(level)>]`` per deck; levels are the six of V1."""
    named = with_slug(configs, F.col("target_language"), "_target_slug")
    return named.withColumn("tags", deck_tags(F.col("_target_slug"), ascii_slug(F.col("cefr_level")))).drop("_target_slug")
