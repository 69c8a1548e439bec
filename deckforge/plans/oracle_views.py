"""DuckDB twins of the fixture views and of the text expressions.

These strings build the oracle SQL only; nothing in the library runs DuckDB.
"""

from __future__ import annotations

from ..functions.text import PY_WHITESPACE

# Python's whitespace set as a DuckDB string expression.
WS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def active(item: str) -> str:
    return f"({item} <> '' AND NOT starts_with({item}, '#'))"


def escape(x: str) -> str:
    return (f"replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), "
            f"'>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')")


def capitalize(x: str) -> str:
    """Upper-case the first letter of each sentence chunk (see text.capitalize_sentences)."""
    chunk = (f"regexp_extract(c, '^([^\\p{{L}}]*)', 1) || "
             f"upper(regexp_extract(c, '^[^\\p{{L}}]*(\\p{{L}}?)', 1)) || "
             f"substring(c, length(regexp_extract(c, '^([^\\p{{L}}]*\\p{{L}}?)', 1)) + 1)")
    return (f"array_to_string(list_transform(regexp_extract_all({strip(x)}, '[^.!?]*[.!?]?'), "
            f"lambda c: {chunk}), '')")


def word_count(x: str) -> str:
    return (f"len(list_filter(regexp_split_to_array({strip(x)}, "
            f"'[\\t-\\r\\x{{1c}}-\\x{{20}}\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}"
            f"\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+'), lambda t: t <> ''))")


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


V_LINES = """
v_lines AS (
  SELECT source_id, pos,
    CASE WHEN source_id % 50 = 0 THEN concat('# ', raw0)
         WHEN pos % 7 = 3 THEN concat('  # ', raw0)
         WHEN pos % 5 = 2 THEN '   '
         ELSE raw0 END AS raw
  FROM (SELECT doc_id AS source_id,
               unnest(range(len(string_split(text, chr(10))))) AS pos,
               unnest(string_split(text, chr(10))) AS raw0
        FROM documents) d
)"""

V_ITEMS = """
v_items AS (
  SELECT CASE WHEN p_partkey % 3 = 0 THEN 14 ELSE p_partkey % (SELECT greatest(25, count(*) // 10) FROM customer) END
           AS deck_id, p_partkey AS pos,
         CASE WHEN p_partkey % 4 = 0 THEN p_name
              ELSE concat(p_name, ' (', p_type, ', ', p_brand, ')') END AS raw
  FROM part
)"""

V_CONFIG = """
v_config AS (
  SELECT CAST(c_custkey AS BIGINT) AS deck_id, r_name AS origin_language, n_name AS target_language,
    CASE WHEN c_custkey % 6 = 5 THEN concat(' ', lower(n_name), ' ')
         WHEN c_custkey % 9 = 4 THEN '  ' ELSE lower(r_name) END AS notes_language,
    CASE c_custkey % 7 WHEN 0 THEN 'a1' WHEN 1 THEN ' A2 ' WHEN 2 THEN 'b1' WHEN 3 THEN 'B2'
         WHEN 4 THEN 'c1' WHEN 5 THEN 'C2' ELSE 'Z9' END AS cefr_level,
    CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN ' HIGH ' ELSE 'turbo' END AS reasoning_effort,
    CASE c_custkey % 3 WHEN 0 THEN 'on' WHEN 1 THEN 'N' ELSE NULL END AS minimal_cards,
    concat('deck', c_custkey % 8, '.out') AS output_path,
    CASE c_custkey % 10 WHEN 1 THEN 'yes' WHEN 2 THEN 'maybe' ELSE NULL END AS overwrite_output,
    CASE c_custkey % 4 WHEN 3 THEN 'off' ELSE NULL END AS generate_audio,
    CASE c_custkey % 5 WHEN 0 THEN NULL ELSE concat('Deck ', c_name) END AS deck_name,
    CASE c_custkey % 6 WHEN 1 THEN '' ELSE NULL END AS text_model
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

V_EXISTING_OUTPUTS = """
v_existing_outputs AS (
  SELECT concat('deck', r_regionkey, '.out') AS path FROM region
  UNION ALL
  SELECT concat('deck', r_regionkey, '_', 1 + r_regionkey % 2, '.out') AS path FROM region
)"""

V_SIDE_LINES = """
v_side_lines AS (
  SELECT item_id % (SELECT greatest(25, count(*) // 10) FROM customer) AS deck_id,
    CASE WHEN item_id % 3 = 0 THEN 'customization' ELSE 'blacklist' END AS kind,
    item_id * 1000 + lpos AS pos,
    CASE WHEN item_id % 3 = 0 THEN line
         WHEN lpos % 2 = 0 THEN split_part(line, ' ', 1)
         ELSE concat(split_part(line, ' ', 1), ' ', split_part(line, ' ', 2)) END AS raw
  FROM (SELECT item_id, unnest(range(len(string_split(text, chr(10))))) AS lpos,
               unnest(string_split(text, chr(10))) AS line FROM benchmark) b
  UNION ALL
  SELECT 21, 'customization', 1000000000 + item_id, repeat(replace(text, chr(10), ' '), 20) FROM benchmark
  UNION ALL
  SELECT conv_id % (SELECT greatest(25, count(*) // 10) FROM customer), 'blacklist', 2000000000 + conv_id,
         split_part(text, ' ', 1) FROM conversations WHERE turn = 1 AND conv_id % 4 = 0
)"""

V_PAIRS = """
v_pairs AS (
  SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k,
         text AS origin, nxt AS target
  FROM (SELECT conv_id, turn, role, text,
               lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt,
               lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nrole
        FROM conversations) t
  WHERE role = 'user' AND nrole = 'assistant'
)"""

V_NOTES = """
v_notes AS (
  SELECT conv_id, k,
    CASE WHEN conv_id % 5 = 0 AND k = 1 THEN 3 WHEN k % 2 = 1 THEN 1 ELSE 2 END AS section_no,
    split_part(target, ' ', 1) AS term, split_part(origin, ' ', 1) AS translation,
    CASE WHEN k % 2 = 0 THEN NULL ELSE split_part(origin, ' ', 2) END AS nuance,
    target AS example
  FROM v_pairs
)"""

_NOTE = "{'term': term, 'translation': translation, 'nuance': nuance, 'example': example}"

V_CARDS = f"""
v_cards AS (
  SELECT p.conv_id, p.conv_id % (SELECT greatest(25, count(*) // 10) FROM customer) AS deck_id, p.conv_id AS line_no,
    {{'source': concat('item ', p.conv_id), 'target_core': tc, 'origin_core': oc, 'examples': ex,
      'word_family': coalesce(wf, []), 'related_vocab': coalesce(rv, []),
      'custom_sections': CASE WHEN cs IS NULL OR len(cs) = 0 THEN []
                              ELSE [{{'title': 'Extra <notes>', 'items': cs}}] END}} AS card
  FROM (SELECT conv_id, max(CASE WHEN k = 1 THEN split_part(target, ' ', 1) END) AS tc,
               max(CASE WHEN k = 1 THEN split_part(origin, ' ', 1) END) AS oc,
               list({{'target': target, 'origin': origin}} ORDER BY k) AS ex
        FROM v_pairs GROUP BY conv_id) p
  LEFT JOIN (SELECT conv_id,
               list({_NOTE} ORDER BY k) FILTER (WHERE section_no = 1) AS wf,
               list({_NOTE} ORDER BY k) FILTER (WHERE section_no = 2) AS rv,
               list({_NOTE} ORDER BY k) FILTER (WHERE section_no = 3) AS cs
             FROM v_notes GROUP BY conv_id) n ON p.conv_id = n.conv_id
)"""

V_RESPONSES = """
v_responses AS (
  SELECT conv_id AS request_id,
    CASE WHEN conv_id % 19 = 0 THEN NULL
         WHEN conv_id % 11 = 0 THEN '{"source":'
         WHEN conv_id % 13 = 0 THEN 'null'
         WHEN conv_id % 7 = 0 THEN concat('{"extra":1,', substring(CAST(to_json(card) AS VARCHAR), 2))
         WHEN conv_id % 17 = 0 THEN replace(CAST(to_json(card) AS VARCHAR), '"target":"', '"target":" ","was":"')
         ELSE CAST(to_json(card) AS VARCHAR) END AS body,
    CASE WHEN conv_id % 19 = 0 THEN 'timeout' END AS error
  FROM v_cards
)"""

V_RECEIVED = """
v_received AS (SELECT request_id, body FROM v_responses WHERE error IS NULL)"""

VIEWS = {
    "v_lines": (V_LINES, []),
    "v_items": (V_ITEMS, []),
    "v_config": (V_CONFIG, []),
    "v_existing_outputs": (V_EXISTING_OUTPUTS, []),
    "v_side_lines": (V_SIDE_LINES, []),
    "v_pairs": (V_PAIRS, []),
    "v_notes": (V_NOTES, ["v_pairs"]),
    "v_cards": (V_CARDS, ["v_pairs", "v_notes"]),
    "v_responses": (V_RESPONSES, ["v_cards"]),
    "v_received": (V_RECEIVED, ["v_responses"]),
}


def with_views(names: list[str], extra: list[str] | None = None) -> str:
    """A ``WITH`` clause holding the named views (and their dependencies) in
    dependency order, followed by ``extra`` CTE bodies."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in VIEWS[n][1]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [VIEWS[n][0].strip() for n in order] + [e.strip() for e in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n"
