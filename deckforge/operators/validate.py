"""S3 response ingest, V2/V2x strict card validation, V3 reject roll-up.

A response body is parsed once into a VARIANT. Every object is read as
``map<string, variant>`` so unknown keys are visible (``map_keys``) and every
leaf's JSON type is checked with ``schema_of_variant`` (``from_json`` would read
the number 5 as the string "5"). All checks are higher-order functions over
the nested arrays: no explode, no shuffle, no Python.

Error codes: ``malformed_json``, ``refusal`` (body is JSON null), ``not_object``,
``unknown_key``, ``missing``, ``wrong_type``, ``blank``, ``too_few``, ``too_many``.
One bad nested value rejects the whole card.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import sql_lit, strip_sql
from ..schemas import (CUSTOM_SECTIONS_MAX, EXAMPLES_MAX, EXAMPLES_MIN, RELATED_VOCAB_MAX,
                       SECTION_ITEMS_MAX, SECTION_ITEMS_MIN, WORD_FAMILY_MAX)

ROOT_KEYS = ["source", "target_core", "origin_core", "examples", "word_family", "related_vocab",
             "custom_sections"]
EXAMPLE_KEYS = ["target", "origin"]
NOTE_ITEM_KEYS = ["term", "translation", "nuance", "example"]
SECTION_KEYS = ["title", "items"]

ERROR_TYPE = "array<struct<path:string,code:string>>"
EMPTY_ERRORS = f"cast(array() as {ERROR_TYPE})"
NOTE_ITEM_TYPE = "struct<term:string,translation:string,nuance:string,example:string>"
SECTIONS_TYPE = f"array<struct<title:string,items:array<{NOTE_ITEM_TYPE}>>>"


def _entry(path: str, code: str) -> str:
    """An error entry; ``code`` is a SQL expression that is NULL when all is well."""
    return f"named_struct('path', {path}, 'code', {code})"


def _keep(entries: list[str]) -> str:
    return f"filter(array({', '.join(entries)}), z_ -> z_.code IS NOT NULL)"


def _is_null(x: str) -> str:
    return f"({x} IS NULL OR is_variant_null({x}))"


def _text(x: str) -> str:
    return strip_sql(f"try_variant_get({x}, '$', 'string')")


def _objs(x: str) -> str:
    """The value as an array of JSON objects (each a map<string, variant>), or NULL."""
    return f"try_variant_get({x}, '$', 'array<map<string,variant>>')"


def _text_entry(x: str, path: str, required: bool = True) -> str:
    """One short-circuiting check per text leaf: the JSON type is read once."""
    if required:
        code = (f"CASE WHEN {_is_null(x)} THEN 'missing' "
                f"WHEN schema_of_variant({x}) != 'STRING' THEN 'wrong_type' "
                f"WHEN {_text(x)} = '' THEN 'blank' END")
    else:
        code = f"CASE WHEN NOT {_is_null(x)} AND schema_of_variant({x}) != 'STRING' THEN 'wrong_type' END"
    return _entry(path, code)


def _list_entry(x: str, arr: str, path: str, required: bool, lo: int | None, hi: int) -> str:
    """One check per list field whose object-array form is ``arr``."""
    when_absent = "'missing'" if required else "NULL"
    when_null = "'missing'" if required else "'wrong_type'"
    code = (f"CASE WHEN {x} IS NULL THEN {when_absent} "
            f"WHEN is_variant_null({x}) THEN {when_null} "
            f"WHEN {arr} IS NULL THEN 'wrong_type' "
            f"WHEN size({arr}) > {hi} THEN 'too_many' "
            + (f"WHEN size({arr}) < {lo} THEN 'too_few' " if lo else "") + "END")
    return _entry(path, code)


def _unknown(obj: str, allowed: list[str], prefix: str) -> str:
    keys = ", ".join(sql_lit(k) for k in allowed)
    entry = _entry(f"concat({prefix}, uk_)", "'unknown_key'")
    return (f"coalesce(transform(array_except(map_keys({obj}), array({keys})), uk_ -> {entry}), "
            f"{EMPTY_ERRORS})")


def _item_errors(it: str, prefix: str) -> str:
    entries = [_text_entry(_f(it, "term"), _sub(prefix, "term")),
               _text_entry(_f(it, "translation"), _sub(prefix, "translation")),
               _text_entry(_f(it, "nuance"), _sub(prefix, "nuance"), required=False),
               _text_entry(_f(it, "example"), _sub(prefix, "example"))]
    return f"concat({_unknown(it, NOTE_ITEM_KEYS, prefix)}, {_keep(entries)})"


def _each(arr: str, var: str, idx: str, body: str) -> str:
    return f"coalesce(flatten(transform({arr}, ({var}, {idx}) -> {body})), {EMPTY_ERRORS})"


def _idx_path(name: str, idx: str) -> str:
    return f"concat('{name}[', cast({idx} as string), '].')"


def _f(var: str, key: str) -> str:
    """``var['key']``: one field of a JSON object read as map<string, variant>."""
    return f"{var}['{key}']"


def _sub(prefix: str, name: str) -> str:
    return f"concat({prefix}, '{name}')"


def errors_sql() -> str:
    """All errors of a staged row (``_v``, ``_root``, ``_ex``, ``_wf``, ``_rv``, ``_cs``)."""
    top = _keep([_entry("'$'", "CASE WHEN _v IS NULL THEN 'malformed_json' "
                               "WHEN is_variant_null(_v) THEN 'refusal' "
                               "WHEN _root IS NULL THEN 'not_object' END")])
    own = [_text_entry(_f("_root", name), f"'{name}'") for name in ["source", "target_core", "origin_core"]]
    own += [_list_entry(_f("_root", "examples"), "_ex", "'examples'", True, EXAMPLES_MIN, EXAMPLES_MAX),
            _list_entry(_f("_root", "word_family"), "_wf", "'word_family'", False, None, WORD_FAMILY_MAX),
            _list_entry(_f("_root", "related_vocab"), "_rv", "'related_vocab'", False, None, RELATED_VOCAB_MAX),
            _list_entry(_f("_root", "custom_sections"), "_cs", "'custom_sections'", False, None,
                        CUSTOM_SECTIONS_MAX)]
    root = (f"CASE WHEN _root IS NOT NULL THEN concat({_unknown('_root', ROOT_KEYS, "''")}, {_keep(own)}) "
            f"ELSE {EMPTY_ERRORS} END")

    ex_pre = _idx_path("examples", "ix_")
    example = (f"concat({_unknown('ex_', EXAMPLE_KEYS, ex_pre)}, {_keep([
        _text_entry(_f('ex_', 'target'), _sub(ex_pre, 'target')),
        _text_entry(_f('ex_', 'origin'), _sub(ex_pre, 'origin'))])})")

    sec_pre = _idx_path("custom_sections", "sx_")
    sec_items = _objs(_f("cs_", "items"))
    sec_checks = [_text_entry(_f("cs_", "title"), _sub(sec_pre, "title")),
                  _list_entry(_f("cs_", "items"), sec_items, _sub(sec_pre, "items"), True,
                              SECTION_ITEMS_MIN, SECTION_ITEMS_MAX)]
    item_pre = f"concat({sec_pre}, {_idx_path('items', 'sj_')})"
    section = (f"concat({_unknown('cs_', SECTION_KEYS, sec_pre)}, {_keep(sec_checks)}, "
               f"{_each(sec_items, 'si_', 'sj_', _item_errors('si_', item_pre))})")
    return "concat(" + ", ".join([
        top,
        root,
        _each("_ex", "ex_", "ix_", example),
        _each("_wf", "wi_", "wj_", _item_errors("wi_", _idx_path("word_family", "wj_"))),
        _each("_rv", "ri_", "rj_", _item_errors("ri_", _idx_path("related_vocab", "rj_"))),
        _each("_cs", "cs_", "sx_", section),
    ]) + ")"


def _note_items_sql(arr: str, var: str) -> str:
    fields = ", ".join([
        f"'term', {_text(_f(var, 'term'))}",
        f"'translation', {_text(_f(var, 'translation'))}",
        f"'nuance', nullif({_text(_f(var, 'nuance'))}, '')",
        f"'example', {_text(_f(var, 'example'))}"])
    return (f"coalesce(transform({arr}, {var} -> named_struct({fields})), "
            f"cast(array() as array<{NOTE_ITEM_TYPE}>))")


def card_sql() -> str:
    """The cleaned card of a staged row: text stripped, blank nuance -> NULL,
    missing note lists -> []."""
    example = f"named_struct('target', {_text(_f('ex_', 'target'))}, 'origin', {_text(_f('ex_', 'origin'))})"
    section = (f"named_struct('title', {_text(_f('cs_', 'title'))}, "
               f"'items', {_note_items_sql(_objs(_f('cs_', 'items')), 'si_')})")
    return ("named_struct(" + ", ".join([
        f"'source', {_text(_f('_root', 'source'))}",
        f"'target_core', {_text(_f('_root', 'target_core'))}",
        f"'origin_core', {_text(_f('_root', 'origin_core'))}",
        f"'examples', transform(_ex, ex_ -> {example})",
        f"'word_family', {_note_items_sql('_wf', 'wi_')}",
        f"'related_vocab', {_note_items_sql('_rv', 'ri_')}",
        f"'custom_sections', coalesce(transform(_cs, cs_ -> {section}), cast(array() as {SECTIONS_TYPE}))",
    ]) + ")")


_ERRORS_SQL = errors_sql()
_CARD_SQL = card_sql()


def validate_cards(df: DataFrame, body_col: str = "body") -> DataFrame:
    """Add ``errors`` (ARRAY<STRUCT<path, code>>), ``valid`` and the cleaned
    ``card`` (NULL for rejected rows). The body is parsed once; each list is
    converted once into staged columns that the checks share."""
    staged = df.withColumns({"_v": F.try_parse_json(F.col(body_col))})
    staged = staged.withColumn("_root", F.expr("try_variant_get(_v, '$', 'map<string,variant>')"))
    staged = staged.withColumns({
        "_ex": F.expr(_objs("_root['examples']")), "_wf": F.expr(_objs("_root['word_family']")),
        "_rv": F.expr(_objs("_root['related_vocab']")), "_cs": F.expr(_objs("_root['custom_sections']"))})
    checked = staged.withColumn("errors", F.expr(_ERRORS_SQL)).withColumn("valid", F.expr("size(errors) = 0"))
    return (checked.withColumn("card", F.expr(f"CASE WHEN valid THEN {_CARD_SQL} END"))
            .drop("_v", "_root", "_ex", "_wf", "_rv", "_cs"))


def rejects_by_reason(checked: DataFrame, key: str = "request_id") -> DataFrame:
    """V3: per error code, how many errors and how many cards."""
    return (checked.select(key, F.explode("errors").alias("e"))
            .groupBy(F.col("e.code").alias("code"))
            .agg(F.count(F.lit(1)).alias("n_errors"), F.count_distinct(key).alias("n_cards")))


# An error's path as a path that ``get_json_object`` follows: its last key quoted, as unknown keys may hold anything.
_PARENTS = r"^((?:[a-z_]+\[[0-9]+\]\.)*)"
_VALUE = (f"CASE e.path WHEN '$' THEN {{body}} ELSE get_json_object({{body}}, concat('$', "
          f"regexp_replace(concat('.', regexp_extract(e.path, {sql_lit(_PARENTS)}, 1)), '[.]$', ''), "
          f"'[', char(39), regexp_replace(e.path, {sql_lit(_PARENTS)}, ''), char(39), ']')) END")


def reject_rows(checked: DataFrame, key: str = "request_id", body_col: str = "body") -> DataFrame:
    """Rejected responses kept as data: one row per (response, error), with the offending ``value``: the text at the
    error's path, other values as JSON, the whole body for an error of the body itself, NULL for what is missing."""
    errors = checked.filter(~F.col("valid")).select(key, body_col, F.explode("errors").alias("e"))
    return errors.select(key, F.col("e.path").alias("path"), F.col("e.code").alias("code"),
                         F.expr(_VALUE.format(body=body_col)).alias("value"))
