"""DuckDB oracle SQL for the registered queries (same column names and values)."""

from __future__ import annotations

from ..functions.identity import DEFAULT_MEDIA_PREFIX, DEFAULT_NOTE_KEY_VERSION
from ..operators.config import (BOOL_FALSE, BOOL_TRUE, CEFR_LEVELS, DEFAULT_DECK_NAME, DEFAULTS,
                                REASONING_EFFORTS, WARN_IF_DEFAULTED)
from ..operators.notes import NOTE_EXAMPLE_STYLE, NOTES_HEADER
from .oracle_views import active, capitalize, escape, strip, tokens, with_views, word_count

ORACLES: dict[str, str] = {}


def _q(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def lp(*parts: str) -> str:
    """Length-prefixed concatenation (see identity.length_prefixed)."""
    out = []
    for p in parts:
        out.append(f"coalesce(CAST(length({p}) AS VARCHAR), '-1'), ':', coalesce({p}, '')")
    return "concat(" + ", ".join(out) + ")"


def int_id(x: str, namespace: str) -> str:
    return f"CAST(('0x' || substr(sha1('{namespace}' || {x}), 1, 15)) AS BIGINT)"


def slug(x: str) -> str:
    """Exact for the fixture's ASCII / letter-only inputs (no NFKC, no casefold)."""
    return f"trim(regexp_replace(lower({strip(x)}), '[^\\p{{L}}\\p{{N}}]+', '-', 'g'), '-')"


# --- active lines / items ----------------------------------------------------------

ACTIVE_ITEMS = f"""
items_act AS (
  SELECT deck_id, pos, item, row_number() OVER (PARTITION BY deck_id ORDER BY pos) AS line_no
  FROM (SELECT deck_id, pos, {strip('raw')} AS item FROM v_items) t WHERE {active('item')}
),
items_split AS (
  SELECT *, CASE WHEN before = '' THEN item ELSE before END AS core,
    CASE WHEN contains(item, '(') THEN list_filter(list_transform(
           string_split(regexp_extract(item, '\\(([^)]*)', 1), ','), lambda v: {strip('v')}), lambda v: v <> '')
         ELSE [] END AS optional_vocab
  FROM (SELECT *, {strip("regexp_extract(item, '^([^(]*)', 1)")} AS before FROM items_act) s
)"""

ORACLES["active_lines"] = with_views(["v_lines"]) + f"""
SELECT source_id, row_number() OVER (PARTITION BY source_id ORDER BY pos) AS line_no, item
FROM (SELECT source_id, pos, {strip('raw')} AS item FROM v_lines) t WHERE {active('item')}
"""

_LINE_BREAKS = "'\\r\\n|[\\n-\\r\\x{1c}-\\x{1e}\\x{85}\\x{2028}\\x{2029}]'"
ORACLES["doc_lines"] = f"""
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS line_no, item
FROM (SELECT doc_id, pos, {strip('raw')} AS item
      FROM (SELECT doc_id, unnest(range(len(regexp_split_to_array(text, {_LINE_BREAKS})))) AS pos,
                   unnest(regexp_split_to_array(text, {_LINE_BREAKS})) AS raw FROM documents) d) t
WHERE {active('item')}
"""

ORACLES["file_lines"] = f"""
SELECT file, CAST(row_number() OVER (PARTITION BY file ORDER BY doc_id, pos) AS BIGINT) AS line_no, item
FROM (SELECT doc_id // 500 AS file, doc_id, pos, {strip('raw')} AS item
      FROM (SELECT doc_id, unnest(range(len(regexp_split_to_array(text, {_LINE_BREAKS})))) AS pos,
                   unnest(regexp_split_to_array(text, {_LINE_BREAKS})) AS raw FROM documents) d) t
WHERE {active('item')}
"""

ORACLES["empty_sources"] = with_views(["v_lines"]) + f"""
SELECT source_id FROM v_lines GROUP BY source_id
HAVING count(*) FILTER (WHERE {active(strip('raw'))}) = 0
"""

ORACLES["split_items"] = with_views(["v_items"], [ACTIVE_ITEMS]) + """
SELECT deck_id, line_no, core, array_to_string(optional_vocab, '|') AS optional_vocab,
       CAST(len(optional_vocab) AS BIGINT) AS n_optional
FROM items_split
"""

# --- configs -----------------------------------------------------------------------


def _unset(c: str) -> str:
    return f"({c} IS NULL OR {c} = '')"


def _err(field: str, code: str, value: str = "CAST(NULL AS VARCHAR)") -> str:
    return f"{{'field': '{field}', 'code': '{code}', 'value': CAST({value} AS VARCHAR)}}"


def _checked_config_cte() -> str:
    checks = []
    for f in ["origin_language", "target_language", "notes_language"]:
        checks.append(f"CASE WHEN {_unset(f)} THEN {_err(f, 'missing')} END")
        checks.append(f"CASE WHEN NOT {_unset(f)} AND {strip(f)} = '' THEN {_err(f, 'blank', f)} END")
    lvl = f"upper({strip('cefr_level')})"
    checks.append(f"CASE WHEN {_unset('cefr_level')} THEN {_err('cefr_level', 'missing')} END")
    checks.append(f"CASE WHEN NOT {_unset('cefr_level')} AND {lvl} NOT IN ({_q(CEFR_LEVELS)}) "
                  f"THEN {_err('cefr_level', 'invalid', 'cefr_level')} END")
    eff = f"lower({strip('reasoning_effort')})"
    checks.append(f"CASE WHEN NOT {_unset('reasoning_effort')} AND {eff} <> '' AND {eff} NOT IN "
                  f"({_q(REASONING_EFFORTS)}) THEN {_err('reasoning_effort', 'invalid', 'reasoning_effort')} END")
    for f in ["generate_audio", "minimal_cards", "overwrite_output"]:
        checks.append(f"CASE WHEN NOT {_unset(f)} AND lower({f}) NOT IN ({_q(BOOL_TRUE + BOOL_FALSE)}) "
                      f"THEN {_err(f, 'invalid', f)} END")
    fe = "list_filter([" + ",\n      ".join(checks) + "], lambda x: x IS NOT NULL)"
    tgt, org, nts = (f"lower({strip(c)})" for c in ["target_language", "origin_language", "notes_language"])
    bools = {"generate_audio": "true", "minimal_cards": "false", "overwrite_output": "false"}
    bool_cols = ",\n    ".join(
        f"CASE WHEN {_unset(f)} THEN {d} ELSE lower({f}) IN ({_q(BOOL_TRUE)}) END AS {f}_b"
        for f, d in bools.items())
    warn = "list_filter([" + ", ".join(f"CASE WHEN {_unset(f)} THEN '{f}' END" for f in WARN_IF_DEFAULTED) \
        + "], lambda x: x IS NOT NULL)"
    return f"""
cfg_raw AS (
  SELECT *, CAST(NULL AS VARCHAR) AS audio_model, CAST(NULL AS VARCHAR) AS audio_voice,
         CAST(NULL AS VARCHAR) AS input_path FROM v_config
),
cfg_fe AS (SELECT *, {fe} AS fe FROM cfg_raw),
cfg_checked AS (
  SELECT deck_id,
    {strip('origin_language')} AS origin_n, {strip('target_language')} AS target_n,
    {strip('notes_language')} AS notes_n, {lvl} AS level_n,
    CASE WHEN {_unset('reasoning_effort')} OR {eff} = '' THEN NULL ELSE {eff} END AS effort_n,
    CASE WHEN {_unset('text_model')} THEN '{DEFAULTS['text_model']}' ELSE text_model END AS text_model_n,
    CASE WHEN {_unset('deck_name')} THEN '{DEFAULT_DECK_NAME}' ELSE deck_name END AS deck_name_n,
    CASE WHEN {_unset('output_path')} THEN '{DEFAULTS['output_path']}' ELSE output_path END AS output_path_n,
    {bool_cols},
    {warn} AS defaulted,
    list_concat(fe, CASE WHEN len(fe) = 0 AND {tgt} = {org} THEN [{_err('target_language', 'same_as_origin')}]
                         WHEN len(fe) = 0 AND {tgt} = {nts} THEN [{_err('target_language', 'same_as_notes')}]
                         ELSE [] END) AS errors
  FROM cfg_fe
),
cfg_valid AS (SELECT * FROM cfg_checked WHERE len(errors) = 0)"""


CHECKED_CONFIG = _checked_config_cte()

ORACLES["valid_configs"] = with_views(["v_config"], [CHECKED_CONFIG]) + """
SELECT deck_id, origin_n AS origin_language, target_n AS target_language, notes_n AS notes_language,
  level_n AS cefr_level, effort_n AS reasoning_effort, text_model_n AS text_model, deck_name_n AS deck_name,
  output_path_n AS output_path, CAST(minimal_cards_b AS VARCHAR) AS minimal_cards,
  CAST(generate_audio_b AS VARCHAR) AS generate_audio, CAST(overwrite_output_b AS VARCHAR) AS overwrite_output,
  array_to_string(defaulted, ',') AS defaulted
FROM cfg_valid
"""

ORACLES["config_errors"] = with_views(["v_config"], [CHECKED_CONFIG]) + """
SELECT deck_id, e.field AS field, e.code AS code, e.value AS value
FROM (SELECT deck_id, unnest(errors) AS e FROM cfg_checked) t
"""

ORACLES["tags"] = with_views(["v_config"], [CHECKED_CONFIG]) + f"""
SELECT deck_id, 'lang::' || {slug('target_n')} AS lang_tag, 'level::' || {slug('level_n')} AS level_tag
FROM cfg_valid
"""

# --- identity and text -----------------------------------------------------------

ORACLES["stable_ids"] = with_views(["v_items"], [ACTIVE_ITEMS]) + f"""
SELECT deck_id, line_no, {int_id('item', 'item:')} AS item_int_id,
  {int_id('CAST(deck_id AS VARCHAR)', 'deck:')} AS deck_int_id,
  sha256({lp(f"'{DEFAULT_NOTE_KEY_VERSION}'", 'item', 'core', 'upper(core)')}) AS note_guid
FROM items_split
"""

ORACLES["capitalized"] = f"SELECT doc_id, {capitalize('text')} AS text FROM documents"

# --- cards -> notes ----------------------------------------------------------------

ORACLES["note_items"] = with_views(["v_cards"]) + """
, secs AS (
  SELECT deck_id, line_no, 1 AS section_no, 'Word family' AS title, card.word_family AS items FROM v_cards
  UNION ALL SELECT deck_id, line_no, 2, 'Related vocab', card.related_vocab FROM v_cards
  UNION ALL SELECT deck_id, line_no, section_no, s.title, s.items FROM (
    SELECT deck_id, line_no, unnest(range(len(card.custom_sections))) + 3 AS section_no,
           unnest(card.custom_sections) AS s FROM v_cards) c
), its AS (
  SELECT deck_id, line_no, section_no, title, unnest(range(len(items))) + 1 AS item_no,
         unnest(items) AS it FROM secs WHERE len(items) > 0
)
SELECT deck_id, line_no, CAST(section_no AS BIGINT) AS section_no, title, CAST(item_no AS BIGINT) AS item_no,
       it.term AS term, it.translation AS translation, it.nuance AS nuance, it.example AS example
FROM its
"""


def _bold(x: str) -> str:
    return f"'<b>' || {escape(x)} || '</b>'"


def _item_html(it: str) -> str:
    return (f"'<u>' || {escape(capitalize(it + '.term'))} || '</u>: ' || {escape(it + '.translation')} || "
            f"CASE WHEN {it}.nuance IS NOT NULL AND {it}.nuance <> '' THEN ' (<i>' || {escape(it + '.nuance')} "
            f"|| '</i>)' ELSE '' END || '<br>' || '<span style=\"{NOTE_EXAMPLE_STYLE}\">\"' || "
            f"{escape(capitalize(it + '.example'))} || '\"</span>'")


def _notes_html(card: str) -> str:
    secs = (f"list_filter(list_concat([{{'title': 'Word family', 'items': {card}.word_family}}, "
            f"{{'title': 'Related vocab', 'items': {card}.related_vocab}}], "
            f"list_transform({card}.custom_sections, lambda cs: {{'title': cs.title, 'items': cs.items}})), "
            f"lambda sx: len(sx.items) > 0)")
    rendered = (f"list_transform({secs}, lambda sx: {_bold('sx.title')} || '<br>' || "
                f"array_to_string(list_transform(sx.items, lambda it: {_item_html('it')}), '<br>'))")
    return f"CASE WHEN len({secs}) > 0 THEN '{NOTES_HEADER}<br>' || array_to_string({rendered}, '<br><br>') END"


def _media_files(card: str) -> str:
    name = (f"'{DEFAULT_MEDIA_PREFIX}-' || substr({slug(card + '.source')}, 1, 40) || '-' || CAST(i AS VARCHAR) "
            f"|| '-' || substr(sha1(concat_ws(chr(10), {card}.source, {card}.target_core, CAST(i AS VARCHAR), "
            f"e.target)), 1, 16) || '.mp3'")
    return f"list_transform({card}.examples, lambda e, i: {name})"


ORACLES["render_notes"] = with_views(["v_cards", "v_config"], [CHECKED_CONFIG]) + f"""
SELECT c.deck_id, c.line_no,
  sha256({lp(f"'{DEFAULT_NOTE_KEY_VERSION}'", 'c.card.source', 'c.card.origin_core', 'c.card.target_core')}) AS note_guid,
  array_to_string(list_concat([{_bold(capitalize('c.card.origin_core'))}],
      list_transform(c.card.examples, lambda e: {escape(capitalize('e.origin'))})), '<br><br>') AS front_text,
  concat_ws('<br><br>', {_bold(capitalize('c.card.target_core'))},
      array_to_string(list_transform(c.card.examples, lambda e: {escape(capitalize('e.target'))}), '<br><br>'),
      CASE WHEN NOT d.minimal_cards_b THEN {_notes_html('c.card')} END) AS back_text,
  CASE WHEN d.generate_audio_b THEN array_to_string(list_transform({_media_files('c.card')},
      lambda f: '[sound:' || f || ']'), ' ') ELSE '' END AS back_audio,
  'lang::' || {slug('d.target_n')} || ' level::' || {slug('d.level_n')} AS tags
FROM v_cards c JOIN cfg_valid d ON c.deck_id = d.deck_id
"""


# --- strict card validation (DuckDB JSON functions) ---------------------------------

def _e(path: str, code: str) -> str:
    return f"{{'path': {path}, 'code': '{code}'}}"


def _keep(checks: list[str]) -> str:
    return "list_filter([" + ", ".join(checks) + "], lambda x: x IS NOT NULL)"


def _jtext(j: str, field: str) -> str:
    return strip(f"({j} ->> '$.{field}')")


def _text_checks(j: str, field: str, path: str, required: bool = True) -> list[str]:
    t = f"json_type({j}, '$.{field}')"
    out = [f"CASE WHEN {t} IS NOT NULL AND {t} <> 'NULL' AND {t} <> 'VARCHAR' THEN {_e(path, 'wrong_type')} END"]
    if required:
        out.append(f"CASE WHEN {t} IS NULL OR {t} = 'NULL' THEN {_e(path, 'missing')} END")
        out.append(f"CASE WHEN {t} = 'VARCHAR' AND {_jtext(j, field)} = '' THEN {_e(path, 'blank')} END")
    return out


def _elems(j: str, field: str) -> str:
    """The field as a list of JSON objects, NULL unless it is an array of objects."""
    t = f"json_type({j}, '$.{field}')"
    lst = f"json_extract({j}, '$.{field}[*]')"
    return (f"CASE WHEN {t} = 'ARRAY' AND len(list_filter({lst}, lambda q: json_type(q) <> 'OBJECT')) = 0 "
            f"THEN {lst} END")


def _list_checks(j: str, field: str, path: str, required: bool, lo: int | None, hi: int) -> list[str]:
    t = f"json_type({j}, '$.{field}')"
    el = _elems(j, field)
    out = [f"CASE WHEN {t} IS NOT NULL AND {t} <> 'NULL' AND ({el}) IS NULL THEN {_e(path, 'wrong_type')} END",
           f"CASE WHEN {t} = 'NULL' THEN {_e(path, 'missing' if required else 'wrong_type')} END",
           f"CASE WHEN len({el}) > {hi} THEN {_e(path, 'too_many')} END"]
    if required:
        out.append(f"CASE WHEN {t} IS NULL THEN {_e(path, 'missing')} END")
    if lo:
        out.append(f"CASE WHEN len({el}) < {lo} THEN {_e(path, 'too_few')} END")
    return out


def _unknown(j: str, allowed: list[str], prefix: str) -> str:
    return (f"list_transform(list_filter(json_keys({j}), lambda k: NOT list_contains([{_q(allowed)}], k)), "
            f"lambda k: {{'path': {prefix} || k, 'code': 'unknown_key'}})")


def _item_errors(it: str, prefix: str) -> str:
    checks = (_text_checks(it, "term", f"{prefix} || 'term'") + _text_checks(it, "translation", f"{prefix} || 'translation'")
              + _text_checks(it, "nuance", f"{prefix} || 'nuance'", False)
              + _text_checks(it, "example", f"{prefix} || 'example'"))
    return f"flatten([{_unknown(it, ['term', 'translation', 'nuance', 'example'], prefix)}, {_keep(checks)}])"


def _items_errors(j: str, field: str) -> str:
    return (f"coalesce(flatten(list_transform({_elems(j, field)}, lambda it, i: "
            f"{_item_errors('it', f"'{field}[' || CAST(i - 1 AS VARCHAR) || '].'")})), [])")


def _section_errors() -> str:
    pre = "'custom_sections[' || CAST(i - 1 AS VARCHAR) || '].'"
    own = _keep(_text_checks("s", "title", f"{pre} || 'title'") + [
        c.replace("'items'", f"{pre} || 'items'") for c in _list_checks("s", "items", "'items'", True, 1, 8)])
    nested = (f"coalesce(flatten(list_transform({_elems('s', 'items')}, lambda it, jj: "
              f"{_item_errors('it', f"{pre} || 'items[' || CAST(jj - 1 AS VARCHAR) || '].'")})), [])")
    return (f"coalesce(flatten(list_transform({_elems('jb', 'custom_sections')}, lambda s, i: "
            f"flatten([{_unknown('s', ['title', 'items'], pre)}, {own}, {nested}]))), [])")


def _example_errors() -> str:
    pre = "'examples[' || CAST(i - 1 AS VARCHAR) || '].'"
    checks = _text_checks("e", "target", f"{pre} || 'target'") + _text_checks("e", "origin", f"{pre} || 'origin'")
    return (f"coalesce(flatten(list_transform({_elems('jb', 'examples')}, lambda e, i: "
            f"flatten([{_unknown('e', ['target', 'origin'], pre)}, {_keep(checks)}]))), [])")


ROOT_PATH = "'$'"


def checked_responses_cte(src: str) -> str:
    """``resp_checked``: every row of ``src`` (with a ``body``) plus ``errors``."""
    top = _keep([
        f"CASE WHEN body IS NULL OR NOT json_valid(body) THEN {_e(ROOT_PATH, 'malformed_json')} END",
        f"CASE WHEN json_type(jb) = 'NULL' THEN {_e(ROOT_PATH, 'refusal')} END",
        f"CASE WHEN json_type(jb) NOT IN ('NULL', 'OBJECT') "
        f"THEN {_e(ROOT_PATH, 'not_object')} END"])
    root = []
    for f in ["source", "target_core", "origin_core"]:
        root += _text_checks("jb", f, f"'{f}'")
    root += _list_checks("jb", "examples", "'examples'", True, 2, 3)
    root += _list_checks("jb", "word_family", "'word_family'", False, None, 6)
    root += _list_checks("jb", "related_vocab", "'related_vocab'", False, None, 8)
    root += _list_checks("jb", "custom_sections", "'custom_sections'", False, None, 6)
    root_keys = ["source", "target_core", "origin_core", "examples", "word_family", "related_vocab",
                 "custom_sections"]
    unknown = _unknown("jb", root_keys, "''")
    obj = (f"flatten([{unknown}, {_keep(root)}, {_example_errors()}, "
           f"{_items_errors('jb', 'word_family')}, {_items_errors('jb', 'related_vocab')}, {_section_errors()}])")
    return f"""
resp_pre0 AS (SELECT *, CASE WHEN json_valid(body) THEN body END AS jb FROM {src}),
resp_pre AS (SELECT *, {top} AS top_errors, coalesce(json_type(jb) = 'OBJECT', false) AS is_obj FROM resp_pre0),
resp_checked AS (
  SELECT *, CASE WHEN is_obj THEN flatten([top_errors, {obj}]) ELSE top_errors END AS errors
  FROM resp_pre
)"""


def _terms(field: str) -> str:
    return (f"coalesce(array_to_string(list_transform({_elems('jb', field)}, "
            f"lambda it: {_jtext('it', 'term')}), ' | '), '')")


ACCEPTED_FIELDS = f"""
  {_jtext('jb', 'source')} AS source, {_jtext('jb', 'target_core')} AS target_core,
  {_jtext('jb', 'origin_core')} AS origin_core,
  array_to_string(list_transform({_elems('jb', 'examples')}, lambda e:
      concat_ws(' = ', {_jtext('e', 'target')}, {_jtext('e', 'origin')})), ' | ') AS examples,
  {_terms('word_family')} AS word_family, {_terms('related_vocab')} AS related_vocab,
  array_to_string(list_transform(list_concat(coalesce({_elems('jb', 'word_family')}, []),
                                             coalesce({_elems('jb', 'related_vocab')}, [])),
      lambda it: coalesce(nullif({_jtext('it', 'nuance')}, ''), '~')), ' | ') AS nuances,
  coalesce(array_to_string(list_transform({_elems('jb', 'custom_sections')}, lambda s:
      {_jtext('s', 'title')} || ': ' || array_to_string(list_transform({_elems('s', 'items')},
      lambda it: {_jtext('it', 'term')}), ', ')), ' | '), '') AS custom_sections"""

ORACLES["accepted_cards"] = with_views(["v_received"], [checked_responses_cte("v_received")]) + f"""
SELECT request_id, {ACCEPTED_FIELDS}
FROM resp_checked WHERE len(errors) = 0
"""

ORACLES["rejects_by_reason"] = with_views(["v_received"], [checked_responses_cte("v_received")]) + """
SELECT e.code AS code, count(*) AS n_errors, count(DISTINCT request_id) AS n_cards
FROM (SELECT request_id, unnest(errors) AS e FROM resp_checked) t GROUP BY e.code
"""

ORACLES["reject_details"] = with_views(["v_received"], [checked_responses_cte("v_received")]) + r"""
SELECT request_id, e.path AS path, e.code AS code, CASE WHEN e.path = '$' THEN body ELSE json_extract_string(body,
    '$.' || regexp_extract(e.path, '^((?:[a-z_]+\[[0-9]+\]\.)*)', 1) || '"'
    || regexp_replace(e.path, '^((?:[a-z_]+\[[0-9]+\]\.)*)', '') || '"') END AS value
FROM (SELECT request_id, body, unnest(errors) AS e FROM resp_checked WHERE len(errors) > 0) t
"""

SIDE_GATHER = f"""
side_sizes AS (
  SELECT deck_id, kind, CAST(sum(octet_length(encode(raw)) + 1) AS BIGINT) AS n_bytes
  FROM v_side_lines GROUP BY deck_id, kind
),
side_active AS (
  SELECT deck_id, kind, pos, {strip('raw')} AS line FROM v_side_lines
),
side_gathered AS (
  SELECT s.deck_id, s.kind, s.n_bytes, s.n_bytes > 8192 AS too_large,
         CASE WHEN s.n_bytes > 8192 THEN [] ELSE coalesce(
           (SELECT list(a.line ORDER BY a.pos) FROM side_active a
            WHERE a.deck_id = s.deck_id AND a.kind = s.kind AND {active('a.line')}), []) END AS lines
  FROM side_sizes s
),
deck_instr AS (
  SELECT deck_id,
    max(CASE WHEN kind = 'customization' THEN lines END) AS customization,
    max(CASE WHEN kind = 'blacklist' THEN lines END) AS blacklist,
    bool_or(too_large) AS side_too_large
  FROM side_gathered GROUP BY deck_id
)"""

# Every answer is validated; a request's best is a valid one if there is any, then the earliest.
ANSWERED = [
    """card_req AS (SELECT conv_id AS request_id, deck_id, line_no, 'Item ' || CAST(conv_id AS VARCHAR) AS item
                 FROM v_cards)""",
    """resp_all AS (SELECT request_id, 2 AS attempt, body FROM v_received
                 UNION ALL SELECT request_id, 3, body FROM v_received WHERE request_id % 23 = 0
                 UNION ALL SELECT request_id, 1, 'null' FROM v_received WHERE request_id % 29 = 1
                 UNION ALL SELECT request_id, 1, '[]' FROM v_received WHERE request_id % 31 = 2
                 UNION ALL SELECT request_id, 1, replace(body, '"target_core":"', '"target_core":"alt ')
                           FROM v_received WHERE request_id % 37 = 3)""",
    checked_responses_cte("resp_all"),
    """matched AS (SELECT r.deck_id, r.line_no, r.item, o.* FROM card_req r JOIN (
                   SELECT *, row_number() OVER (PARTITION BY request_id
                     ORDER BY CASE WHEN len(errors) = 0 THEN 0 ELSE 1 END, attempt) AS nth FROM resp_checked) o
                 ON r.request_id = o.request_id AND o.nth = 1)"""]

ORACLES["normalized_cards"] = with_views(["v_received", "v_config", "v_side_lines"],
                                         [CHECKED_CONFIG, SIDE_GATHER, *ANSWERED]) + f"""
SELECT m.request_id, m.deck_id, m.line_no, m.item AS source, {_jtext('jb', 'target_core')} AS target_core,
  CAST(len({_elems('jb', 'examples')}) AS BIGINT) AS n_examples,
  CAST(CASE WHEN d.minimal_cards_b THEN 0 ELSE coalesce(len({_elems('jb', 'word_family')}), 0) END AS BIGINT) AS n_family,
  CAST(CASE WHEN d.minimal_cards_b THEN 0 ELSE coalesce(len({_elems('jb', 'related_vocab')}), 0) END AS BIGINT) AS n_related,
  CAST(CASE WHEN d.minimal_cards_b OR coalesce(len(i.customization), 0) = 0 THEN 0
            ELSE coalesce(len({_elems('jb', 'custom_sections')}), 0) END AS BIGINT) AS n_custom
FROM matched m JOIN cfg_valid d ON m.deck_id = d.deck_id
LEFT JOIN deck_instr i ON m.deck_id = i.deck_id
WHERE len(m.errors) = 0
"""

ORACLES["unanswered_requests"] = with_views(["v_received"]) + """
SELECT conv_id AS request_id, deck_id, line_no FROM v_cards
WHERE conv_id NOT IN (SELECT request_id FROM v_received)
"""

ORACLES["instructions"] = with_views(["v_config", "v_side_lines"], [CHECKED_CONFIG, SIDE_GATHER]) + f"""
SELECT d.deck_id, k.kind, coalesce(g.n_bytes, 0) AS n_bytes, CAST(coalesce(len(g.lines), 0) AS BIGINT) AS n_lines,
  array_to_string(coalesce(g.lines, []), chr(10)) AS lines,
  CASE WHEN g.deck_id IS NULL THEN 'not found'
       ELSE CAST(len(g.lines) AS VARCHAR) || ' active ' || CASE WHEN len(g.lines) = 1 THEN 'line' ELSE 'lines' END
  END AS status,
  array_to_string(list_filter([
      CASE WHEN g.deck_id IS NULL THEN 'not_found' END,
      CASE WHEN g.deck_id IS NOT NULL AND len(g.lines) = 0 THEN 'no_active_lines' END,
      CASE WHEN k.kind = 'customization' AND d.minimal_cards_b AND coalesce(len(g.lines), 0) > 0
           THEN 'ignored_minimal' END], lambda x: x IS NOT NULL), ',') AS warnings
FROM cfg_valid d CROSS JOIN (VALUES ('customization'), ('blacklist')) k(kind)
LEFT JOIN side_gathered g ON g.deck_id = d.deck_id AND g.kind = k.kind
"""


# --- audio ---------------------------------------------------------------------------

AUDIO_JOBS = f"""
audio_cards AS (
  SELECT c.deck_id, c.line_no, c.card, d.generate_audio_b,
         'gpt-4o-mini-tts' AS audio_model, CASE WHEN c.deck_id % 2 = 0 THEN 'nova' ELSE 'alloy' END AS audio_voice
  FROM v_cards c JOIN cfg_valid d ON c.deck_id = d.deck_id
),
audio_jobs AS (
  SELECT *, sha256({lp('file_name', 'audio_model', 'audio_voice')}) AS media_id FROM (
  SELECT deck_id, line_no, CAST(i AS BIGINT) AS example_no, {strip('e.target')} AS text,
    '{DEFAULT_MEDIA_PREFIX}-' || substr({slug('card.source')}, 1, 40) || '-' || CAST(i AS VARCHAR) || '-' ||
    substr(sha1(concat_ws(chr(10), card.source, card.target_core, CAST(i AS VARCHAR), e.target)), 1, 16)
    || '.mp3' AS file_name, audio_model, audio_voice
  FROM (SELECT *, unnest(range(1, len(card.examples) + 1)) AS i, unnest(card.examples) AS e
        FROM audio_cards WHERE generate_audio_b) t) j
)"""

ORACLES["audio_manifest"] = with_views(["v_cards", "v_config"], [CHECKED_CONFIG, AUDIO_JOBS]) + """
SELECT deck_id, line_no, example_no, text, file_name, media_id, audio_model, audio_voice FROM audio_jobs
"""

# The stub's audio is the text's UTF-8 bytes.
ORACLES["synthesize_stub"] = with_views(["v_cards", "v_config"], [CHECKED_CONFIG, AUDIO_JOBS]) + """
SELECT DISTINCT media_id, file_name, audio_voice, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes,
  CAST(NULL AS VARCHAR) AS error FROM audio_jobs WHERE text <> ''
"""

ORACLES["written_media"] = with_views(["v_cards", "v_config"], [CHECKED_CONFIG, AUDIO_JOBS]) + """
SELECT DISTINCT media_id, file_name, sha256(text) AS content_sha256 FROM audio_jobs WHERE text <> ''
"""

ORACLES["audio_gather"] = with_views(["v_cards", "v_config"], [CHECKED_CONFIG, AUDIO_JOBS]) + """
SELECT c.deck_id, c.line_no, CAST(coalesce(len(g.files), 0) AS BIGINT) AS n_files,
  coalesce(array_to_string(list_transform(g.files, lambda f: '[sound:' || f || ']'), ' '), '') AS back_audio
FROM audio_cards c LEFT JOIN (
  SELECT deck_id, line_no, list(file_name ORDER BY example_no) AS files FROM audio_jobs
  WHERE text <> '' GROUP BY deck_id, line_no) g ON c.deck_id = g.deck_id AND c.line_no = g.line_no
"""


# --- sinks -----------------------------------------------------------------------------

_SPLIT = r"^(.*[^/])(\.[^./]+)$"


def _cand(p: str, n: str) -> str:
    stem = f"CASE WHEN regexp_matches({p}, '{_SPLIT}') THEN regexp_extract({p}, '{_SPLIT}', 1) ELSE {p} END"
    suf = f"CASE WHEN regexp_matches({p}, '{_SPLIT}') THEN regexp_extract({p}, '{_SPLIT}', 2) ELSE '' END"
    return f"CASE WHEN {n} = 0 THEN {p} ELSE {stem} || '_' || CAST({n} AS VARCHAR) || {suf} END"


# Brute force: every candidate name of a path compared as text with every
# blocking name; m + |blocking names| candidates always suffice.
ORACLES["output_names"] = with_views(["v_config", "v_existing_outputs"], [CHECKED_CONFIG, f"""
req AS (SELECT deck_id, output_path_n AS requested, overwrite_output_b AS ow FROM cfg_valid),
hard AS (SELECT path AS name FROM v_existing_outputs UNION SELECT requested FROM req WHERE ow),
soft AS (SELECT requested AS name FROM req WHERE NOT ow),
movers AS (SELECT deck_id, requested, row_number() OVER (PARTITION BY requested ORDER BY deck_id) AS k
           FROM req WHERE NOT ow),
grp AS (SELECT requested, count(*) AS m FROM movers GROUP BY requested),
cand AS (SELECT g.requested, n, {_cand('g.requested', 'n')} AS name
         FROM grp g, range(0, g.m + (SELECT count(*) FROM hard) + (SELECT count(*) FROM soft)) r(n)),
free AS (SELECT requested, n, name, row_number() OVER (PARTITION BY requested ORDER BY n) AS k FROM cand c
         WHERE name NOT IN (SELECT name FROM hard)
           AND NOT (n > 0 AND name IN (SELECT name FROM soft)))"""]) + """
SELECT m.deck_id, m.requested, f.name AS output_name FROM movers m JOIN free f
  ON m.requested = f.requested AND m.k = f.k
UNION ALL
SELECT deck_id, requested, requested AS output_name FROM req WHERE ow
"""

OUTPUT_NAMES = ORACLES["output_names"]

ORACLES["deck_table"] = with_views(["v_config"], [CHECKED_CONFIG]) + f"""
SELECT d.deck_id, {int_id('deck_name_n', 'deckforge-deck:')} AS deck_int_id,
  {int_id("'Deckforge Card'", 'deckforge-model:')} AS model_int_id, deck_name_n AS deck_name,
  'lang::' || {slug('target_n')} || ' level::' || {slug('level_n')} AS tags, o.output_name
FROM cfg_valid d JOIN ({OUTPUT_NAMES}) o ON o.deck_id = d.deck_id
"""

ORACLES["blank_items"] = with_views(["v_lines"]) + f"""
SELECT source_id, pos, 'blank_item' AS code FROM v_lines WHERE {strip('raw')} = ''
"""

ORACLES["ordered_items"] = with_views(["v_items"], [ACTIVE_ITEMS]) + """
SELECT deck_id, line_no, item, lag(item) OVER (PARTITION BY deck_id ORDER BY line_no) AS previous FROM items_act
"""

_RENDER = ORACLES["render_notes"]

_UPSERT = f"""
WITH rn AS ({_RENDER}),
cur AS (SELECT * FROM rn UNION ALL SELECT deck_id, line_no + 100000 AS line_no, note_guid, front_text, back_text,
               back_audio, tags FROM rn WHERE line_no % 10 = 1),
old0 AS (SELECT deck_id, CASE WHEN line_no % 4 = 0 THEN sha256(note_guid || '-old') ELSE note_guid END AS note_guid,
               front_text, CASE WHEN line_no % 3 = 0 THEN back_text || ' (old)' ELSE back_text END AS back_text,
               back_audio, tags, line_no FROM rn),
old_all AS (SELECT * FROM old0 UNION ALL SELECT deck_id, note_guid, front_text, 'a later line of the same key',
                   back_audio, tags, line_no + 200000 FROM old0 WHERE line_no % 6 = 1),
old AS (SELECT * FROM old_all QUALIFY row_number() OVER (PARTITION BY deck_id, note_guid ORDER BY line_no) = 1),
firsts AS (SELECT deck_id, note_guid, min(line_no) AS first_line FROM cur GROUP BY deck_id, note_guid)"""

ORACLES["deck_upsert"] = _UPSERT + """
SELECT c.deck_id, c.line_no, c.note_guid,
  CASE WHEN c.line_no > f.first_line THEN 'duplicate'
       WHEN o.note_guid IS NULL THEN 'new'
       WHEN o.front_text IS NOT DISTINCT FROM c.front_text AND o.back_text IS NOT DISTINCT FROM c.back_text
            AND o.back_audio IS NOT DISTINCT FROM c.back_audio AND o.tags IS NOT DISTINCT FROM c.tags
       THEN 'unchanged' ELSE 'changed' END AS change
FROM cur c JOIN firsts f ON c.deck_id = f.deck_id AND c.note_guid = f.note_guid
LEFT JOIN old o ON c.deck_id = o.deck_id AND c.note_guid = o.note_guid
"""

ORACLES["written_decks"] = _UPSERT + """
SELECT c.deck_id, c.line_no, c.note_guid, c.front_text, c.back_text
FROM cur c JOIN firsts f ON c.deck_id = f.deck_id AND c.note_guid = f.note_guid AND c.line_no = f.first_line
UNION ALL
SELECT o.deck_id, o.line_no, o.note_guid, o.front_text, o.back_text FROM old o
WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.deck_id = o.deck_id AND c.note_guid = o.note_guid)
"""


# --- quality ---------------------------------------------------------------------------

QUALITY_CARDS = """
qcards AS (SELECT c.deck_id, c.line_no, c.card, d.level_n, d.minimal_cards_b
           FROM v_cards c JOIN cfg_valid d ON c.deck_id = d.deck_id)"""

ORACLES["level_length"] = with_views(["v_cards", "v_config"], [CHECKED_CONFIG, QUALITY_CARDS]) + f"""
, lv AS (SELECT * FROM (VALUES ('A1', 5, 9), ('A2', 5, 9), ('B1', 6, 12), ('B2', 6, 12), ('C1', 7, 15),
                               ('C2', 7, 15)) t(level_n, min_words, max_words)),
ex AS (SELECT deck_id, line_no, level_n, unnest(range(1, len(card.examples) + 1)) AS example_no,
              unnest(card.examples) AS e FROM qcards)
SELECT deck_id, line_no, CAST(example_no AS BIGINT) AS example_no,
  CAST({word_count('e.target')} AS BIGINT) AS n_words, min_words, max_words,
  CAST({word_count('e.target')} BETWEEN min_words AND max_words AS VARCHAR) AS in_range
FROM ex JOIN lv USING (level_n)
"""


def _note_texts(alias: str, fields: list[str]) -> str:
    """UNION ALL rows (deck_id, line_no, location, text) over note items."""
    parts = []
    for name in ["word_family", "related_vocab"]:
        for f in fields:
            parts.append(f"SELECT deck_id, line_no, '{name}[' || CAST(i - 1 AS VARCHAR) || '].{f}' AS location, "
                         f"it.{f} AS text FROM (SELECT deck_id, line_no, unnest(range(1, len(card.{name}) + 1)) AS i, "
                         f"unnest(card.{name}) AS it FROM {alias}) t")
    for f in fields:
        parts.append(f"SELECT deck_id, line_no, 'custom_sections[' || CAST(si - 1 AS VARCHAR) || '].items[' || "
                     f"CAST(i - 1 AS VARCHAR) || '].{f}' AS location, it.{f} AS text FROM ("
                     f"SELECT deck_id, line_no, si, unnest(range(1, len(s.items) + 1)) AS i, unnest(s.items) AS it "
                     f"FROM (SELECT deck_id, line_no, unnest(range(1, len(card.custom_sections) + 1)) AS si, "
                     f"unnest(card.custom_sections) AS s FROM {alias}) a) b")
    return "\nUNION ALL ".join(parts)


def _example_texts(alias: str, field: str = "target") -> str:
    return (f"SELECT deck_id, line_no, 'examples[' || CAST(i - 1 AS VARCHAR) || '].{field}' AS location, "
            f"e.{field} AS text FROM (SELECT deck_id, line_no, unnest(range(1, len(card.examples) + 1)) AS i, "
            f"unnest(card.examples) AS e FROM {alias}) t")


_MARKUP = r"<[A-Za-z/]|\*\*|__|`|^#{1,6} |\[[^\]]*\]\("

ORACLES["content_rules"] = with_views(["v_cards", "v_config"], [CHECKED_CONFIG, QUALITY_CARDS]) + f"""
, all_texts AS (
  SELECT deck_id, line_no, 'target_core' AS location, card.target_core AS text FROM qcards
  UNION ALL SELECT deck_id, line_no, 'origin_core', card.origin_core FROM qcards
  UNION ALL {_example_texts('qcards', 'target')}
  UNION ALL {_example_texts('qcards', 'origin')}
  UNION ALL {_note_texts('qcards', ['term', 'translation', 'nuance', 'example'])}
  UNION ALL SELECT deck_id, line_no, 'custom_sections[' || CAST(si - 1 AS VARCHAR) || '].title', s.title FROM (
    SELECT deck_id, line_no, unnest(range(1, len(card.custom_sections) + 1)) AS si,
           unnest(card.custom_sections) AS s FROM qcards) c
)
SELECT deck_id, line_no, 'core_missing' AS rule, location FROM ({_example_texts('qcards', 'target')}) x
  JOIN qcards q USING (deck_id, line_no)
  WHERE NOT contains(lower(x.text), lower(q.card.target_core))
UNION ALL
SELECT deck_id, line_no, 'markup', location FROM all_texts WHERE regexp_matches(text, '{_MARKUP}')
UNION ALL
SELECT deck_id, line_no, 'section_size', s FROM (
  SELECT deck_id, line_no, 'word_family' AS s, len(card.word_family) AS n, minimal_cards_b FROM qcards
  UNION ALL SELECT deck_id, line_no, 'related_vocab', len(card.related_vocab), minimal_cards_b FROM qcards) z
  WHERE NOT minimal_cards_b AND (n < 3 OR n > 6)
UNION ALL
SELECT deck_id, line_no, 'long_nuance', location FROM ({_note_texts('qcards', ['nuance'])}) y
  WHERE text IS NOT NULL AND {word_count('text')} > 10
"""

ORACLES["repeated_terms"] = with_views(["v_cards", "v_config"], [CHECKED_CONFIG, QUALITY_CARDS]) + f"""
, terms AS (SELECT deck_id, line_no, lower(text) AS term FROM ({_note_texts('qcards', ['term'])}) t)
SELECT deck_id, line_no, term, 'repeated' AS rule FROM terms GROUP BY deck_id, line_no, term HAVING count(*) > 1
UNION ALL
SELECT DISTINCT t.deck_id, t.line_no, t.term, 'is_core' FROM terms t JOIN qcards q USING (deck_id, line_no)
WHERE t.term = lower(q.card.target_core)
"""

ORACLES["blacklist_hits"] = with_views(["v_cards", "v_config", "v_side_lines"],
                                       [CHECKED_CONFIG, QUALITY_CARDS, SIDE_GATHER]) + f"""
, entries AS (SELECT deck_id, entry, {tokens('entry')} AS etok
              FROM (SELECT deck_id, unnest(coalesce(blacklist, [])) AS entry FROM deck_instr) b),
texts AS (
  {_example_texts('qcards', 'target')}
  UNION ALL {_note_texts('qcards', ['term', 'example'])}
),
pairs AS (SELECT t.deck_id, t.line_no, t.location, {tokens('t.text')} AS tok, e.entry, e.etok
          FROM texts t JOIN entries e ON t.deck_id = e.deck_id WHERE len(e.etok) > 0)
SELECT deck_id, line_no, location, CAST(pos AS BIGINT) AS position, entry FROM (
  SELECT *, unnest(list_filter(range(0, len(tok) - len(etok) + 1),
                               lambda p: tok[p + 1:p + len(etok)] = etok)) AS pos FROM pairs) z
"""


# --- summary and progress ------------------------------------------------------------------

ORACLES["call_errors"] = with_views(["v_cards", "v_responses"]) + """
SELECT c.conv_id AS request_id, c.deck_id, c.line_no, 'other' AS code, r.error AS message
FROM v_cards c JOIN v_responses r ON r.request_id = c.conv_id WHERE r.error IS NOT NULL
"""

ORACLES["run_summary"] = with_views(["v_items", "v_cards", "v_responses", "v_received", "v_config", "v_side_lines"], [
    CHECKED_CONFIG, ACTIVE_ITEMS, AUDIO_JOBS,
    SIDE_GATHER, *ANSWERED]) + f"""
, notes AS (SELECT deck_id, len(card.word_family) + len(card.related_vocab) +
                   coalesce(list_sum(list_transform(card.custom_sections, lambda s: len(s.items))), 0) AS n
            FROM v_cards)
SELECT c.deck_id, CAST(len(c.errors) = 0 AS VARCHAR) AS valid,
  CAST(coalesce((SELECT count(*) FROM items_act i WHERE i.deck_id = c.deck_id), 0) AS BIGINT) AS n_items,
  CAST(coalesce((SELECT count(*) FROM matched r WHERE r.deck_id = c.deck_id AND len(r.errors) = 0), 0)
       AS BIGINT) AS n_accepted,
  CAST(coalesce((SELECT count(*) FROM matched r WHERE r.deck_id = c.deck_id AND len(r.errors) > 0), 0)
       AS BIGINT) AS n_rejected,
  CAST(coalesce((SELECT count(*) FROM card_req q WHERE q.deck_id = c.deck_id
                 AND q.request_id NOT IN (SELECT request_id FROM v_received)), 0) AS BIGINT) AS n_unanswered,
  CAST(coalesce((SELECT count(*) FROM v_cards q JOIN v_responses r ON r.request_id = q.conv_id
                 WHERE q.deck_id = c.deck_id AND r.error IS NOT NULL), 0) AS BIGINT) AS n_call_errors,
  (SELECT min(g.kind || ': too_large') FROM side_gathered g WHERE g.deck_id = c.deck_id AND g.too_large) AS side_file,
  CAST(coalesce((SELECT count(*) FROM audio_jobs j WHERE j.deck_id = c.deck_id), 0) AS BIGINT) AS n_audio_jobs,
  CAST(coalesce((SELECT sum(n) FROM notes x WHERE x.deck_id = c.deck_id), 0) AS BIGINT) AS n_note_items
FROM cfg_checked c
"""

ORACLES["progress"] = with_views(["v_cards", "v_config"], [CHECKED_CONFIG, AUDIO_JOBS]) + """
SELECT deck_id, line_no, example_no, position, total, CAST(position AS VARCHAR) || '/' || CAST(total AS VARCHAR)
  AS progress
FROM (SELECT deck_id, line_no, example_no,
             row_number() OVER (PARTITION BY deck_id ORDER BY line_no, example_no) AS position,
             count(*) OVER (PARTITION BY deck_id) AS total FROM audio_jobs) t
"""


# --- requests: the full system prompt rebuilt from the same template constants --------------

def _render_duck(template, cols: dict[str, str]) -> str:
    out = []
    for part in template:
        if isinstance(part, str):
            out.append("'" + part.replace("'", "''") + "'")
        else:
            out.append(f"CAST({cols[part.name]} AS VARCHAR)")
    return "concat(" + ", ".join(out) + ")"


def _requests_sql() -> str:
    from ..operators import prompts as P
    cols = {"target_language": "target_n", "origin_language": "origin_n", "notes_language": "notes_n",
            "cefr_level": "level_n", "min_words": "min_words", "max_words": "max_words", "style": "style"}
    r = lambda t: _render_duck(t, cols)

    def lit(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    style = "CASE tier " + " ".join(f"WHEN {k} THEN {lit(v)}" for k, v in P.STYLES.items()) + " END"
    bullets = "array_to_string(list_transform({x}, lambda l: '- ' || l), chr(10))"
    rules = (f"CASE WHEN NOT minimal_cards_b AND len(coalesce(customization, [])) > 0 THEN "
             f"{lit(P.RULES_HEADER)} || {bullets.format(x='customization')} END")
    avoid = (f"CASE WHEN len(coalesce(blacklist, [])) > 0 THEN "
             f"{lit(P.AVOID_HEADER)} || {bullets.format(x='blacklist')} END")
    fields = (f"{lit(P.FIELDS_HEADER)} || concat_ws({lit(P.FIELD_JOIN)}, {r(P.HEADWORD)}, {r(P.SENTENCES)}, "
              f"CASE WHEN NOT minimal_cards_b THEN {r(P.ENTRIES)} END)")
    learner = f"CASE WHEN lower(origin_n) = lower(notes_n) THEN {r(P.LEARNER_ONE)} ELSE {r(P.LEARNER_TWO)} END"
    prompt = f"concat_ws({lit(P.BLOCK_JOIN)}, {r(P.TASK)}, {learner}, {r(P.LINE)}, {fields}, {rules}, {avoid})"
    return with_views(["v_items", "v_config", "v_side_lines"], [CHECKED_CONFIG, ACTIVE_ITEMS, SIDE_GATHER, f"""
lv AS (SELECT * FROM (VALUES ('A1', 5, 9, 1), ('A2', 5, 9, 1), ('B1', 6, 12, 2), ('B2', 6, 12, 2),
                             ('C1', 7, 15, 3), ('C2', 7, 15, 3)) t(level_n, min_words, max_words, tier)),
pdecks AS (SELECT d.*, i.customization, i.blacklist, lv.min_words, lv.max_words, lv.tier
           FROM cfg_valid d JOIN lv USING (level_n) LEFT JOIN deck_instr i ON d.deck_id = i.deck_id
           WHERE NOT coalesce(i.side_too_large, false)),
prompts AS (SELECT deck_id, text_model_n AS model, effort_n AS reasoning_effort, sha256(sp) AS prompt_id,
                   CAST(length(sp) AS BIGINT) AS prompt_chars
            FROM (SELECT *, {prompt} AS sp FROM (SELECT *, {style} AS style FROM pdecks) g) s)"""]) + """
SELECT i.deck_id, i.line_no,
  sha256(concat_ws(chr(31), CAST(i.deck_id AS VARCHAR),
                   CAST(row_number() OVER (PARTITION BY i.deck_id, i.item ORDER BY i.line_no) AS VARCHAR), p.model,
                   coalesce(p.reasoning_effort, ''), p.prompt_id, 'Line: ' || i.item)) AS request_id,
  p.prompt_id AS prompt_sha256, p.prompt_chars, 'Line: ' || i.item AS user_content, p.model,
  p.reasoning_effort
FROM items_act i JOIN prompts p ON i.deck_id = p.deck_id
"""


ORACLES["requests"] = _requests_sql()

# The stub answers every request with a valid card.
ORACLES["generate_stub"] = f"""
SELECT request_id, deck_id, line_no, 'true' AS valid, CAST(0 AS BIGINT) AS n_errors FROM ({ORACLES["requests"]}) r
"""


ORACLES["quality_report"] = f"""
SELECT deck_id, line_no, 'sentence_length' AS rule,
       'examples[' || CAST(example_no - 1 AS VARCHAR) || '].target' AS location,
       CAST(n_words AS VARCHAR) AS detail
FROM ({ORACLES["level_length"]}) a WHERE in_range = 'false'
UNION ALL
SELECT deck_id, line_no, rule, location, CAST(NULL AS VARCHAR) FROM ({ORACLES["content_rules"]}) b
UNION ALL
SELECT deck_id, line_no, CASE WHEN rule = 'repeated' THEN 'repeated_term' ELSE 'term_is_core' END,
       CAST(NULL AS VARCHAR), term FROM ({ORACLES["repeated_terms"]}) c
UNION ALL
SELECT deck_id, line_no, 'blacklisted', location, entry FROM ({ORACLES["blacklist_hits"]}) d
"""
