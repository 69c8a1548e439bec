"""Deterministic fixture views over the driver's tables (Spark side).

Each view is Spark SQL over the parquet tables (passed to ``spark.sql`` as
DataFrame arguments) and has a DuckDB twin in ``plans/oracle_views.py``;
FIXTURES.md documents both. Damage (comments, blanks, bad settings, broken
responses) is seeded from ids so both engines produce the same rows; no view
drops rows to save time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def v_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, pos, raw): every line of every document, with seeded
    comment lines, indented comments and blank lines."""
    return spark.sql("""
        SELECT source_id, CAST(pos AS BIGINT) AS pos,
          CASE WHEN source_id % 50 = 0 THEN concat('# ', raw0)
               WHEN pos % 7 = 3 THEN concat('  # ', raw0)
               WHEN pos % 5 = 2 THEN '   '
               ELSE raw0 END AS raw
        FROM (SELECT doc_id AS source_id, posexplode(split(text, '\\n')) AS (pos, raw0) FROM {documents})
    """, documents=table(spark, sf_dir, "documents"))


# Decks that hold items, cards and side files: a tenth of all, so keys grow with the data. Every third
# item is in one hot deck, and one deck's customization is above the side-file limit at every scale.
N_DECKS = "(SELECT greatest(25, count(*) div 10) FROM {customer})"
HOT_DECK, LARGE_SIDE_DECK = 14, 21


def v_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(deck_id, pos, raw): one input line per part; names repeat."""
    return spark.sql(f"""
        SELECT CAST(CASE WHEN p_partkey % 3 = 0 THEN {HOT_DECK} ELSE p_partkey % {N_DECKS} END AS BIGINT) AS deck_id,
               CAST(p_partkey AS BIGINT) AS pos,
               CASE WHEN p_partkey % 4 = 0 THEN p_name
                    ELSE concat(p_name, ' (', p_type, ', ', p_brand, ')') END AS raw
        FROM {{part}}
    """, part=table(spark, sf_dir, "part"), customer=table(spark, sf_dir, "customer"))


def v_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw deck configuration (strings) per customer, languages from the
    customer's nation and region, with seeded invalid settings."""
    return spark.sql("""
        SELECT CAST(c_custkey AS BIGINT) AS deck_id, r_name AS origin_language, n_name AS target_language,
          CASE WHEN c_custkey % 6 = 5 THEN concat(' ', lower(n_name), ' ')
               WHEN c_custkey % 9 = 4 THEN '  ' ELSE lower(r_name) END AS notes_language,
          CASE c_custkey % 7 WHEN 0 THEN 'a1' WHEN 1 THEN ' A2 ' WHEN 2 THEN 'b1' WHEN 3 THEN 'B2'
               WHEN 4 THEN 'c1' WHEN 5 THEN 'C2' ELSE 'Z9' END AS cefr_level,
          CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN ' HIGH ' ELSE 'turbo' END
            AS reasoning_effort,
          CASE c_custkey % 3 WHEN 0 THEN 'on' WHEN 1 THEN 'N' ELSE NULL END AS minimal_cards,
          concat('deck', CAST(c_custkey % 8 AS STRING), '.out') AS output_path,
          CASE c_custkey % 10 WHEN 1 THEN 'yes' WHEN 2 THEN 'maybe' ELSE NULL END AS overwrite_output,
          CASE c_custkey % 4 WHEN 3 THEN 'off' ELSE NULL END AS generate_audio,
          CASE c_custkey % 5 WHEN 0 THEN NULL ELSE concat('Deck ', c_name) END AS deck_name,
          CASE c_custkey % 6 WHEN 1 THEN '' ELSE NULL END AS text_model
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
    """, customer=table(spark, sf_dir, "customer"), nation=table(spark, sf_dir, "nation"),
        region=table(spark, sf_dir, "region"))


def v_existing_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path): output names already taken: deck<r>.out for every region, plus
    deck<r>_1.out for even regions and deck<r>_2.out for odd ones (a gap)."""
    return spark.sql("""
        SELECT concat('deck', CAST(r_regionkey AS STRING), '.out') AS path FROM {region}
        UNION ALL
        SELECT concat('deck', CAST(r_regionkey AS STRING), '_', CAST(1 + r_regionkey % 2 AS STRING), '.out')
        FROM {region}
    """, region=table(spark, sf_dir, "region"))


def v_side_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(deck_id, kind, pos, raw): side-file lines per deck from ``benchmark``
    passages: every third passage is customization text; the others give
    blacklist entries (a first word, or a first two-word phrase). Every fourth
    conversation's first answer gives its deck a blacklisted word of its own."""
    return spark.sql(f"""
        SELECT CAST(item_id % {N_DECKS} AS BIGINT) AS deck_id,
          CASE WHEN item_id % 3 = 0 THEN 'customization' ELSE 'blacklist' END AS kind,
          CAST(item_id * 1000 + lpos AS BIGINT) AS pos,
          CASE WHEN item_id % 3 = 0 THEN line
               WHEN lpos % 2 = 0 THEN split_part(line, ' ', 1)
               ELSE concat(split_part(line, ' ', 1), ' ', split_part(line, ' ', 2)) END AS raw
        FROM (SELECT item_id, posexplode(split(text, '\\n')) AS (lpos, line) FROM {{benchmark}})
        UNION ALL
        SELECT CAST({LARGE_SIDE_DECK} + item_id % 1 AS BIGINT), 'customization', CAST(1000000000 + item_id AS BIGINT),
               repeat(replace(text, '\\n', ' '), 20)
        FROM {{benchmark}}
        UNION ALL
        SELECT CAST(conv_id % {N_DECKS} AS BIGINT), 'blacklist', CAST(2000000000 + conv_id AS BIGINT),
               split_part(text, ' ', 1)
        FROM {{conversations}} WHERE turn = 1 AND conv_id % 4 = 0
    """, benchmark=table(spark, sf_dir, "benchmark"), customer=table(spark, sf_dir, "customer"),
        conversations=table(spark, sf_dir, "conversations"))


def v_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, k, origin, target): user turn + the assistant turn after it."""
    return spark.sql("""
        SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS k,
               text AS origin, nxt AS target
        FROM (SELECT conv_id, turn, role, text,
                     lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt,
                     lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nrole
              FROM {conversations})
        WHERE role = 'user' AND nrole = 'assistant'
    """, conversations=table(spark, sf_dir, "conversations"))


def v_notes(pairs: DataFrame) -> DataFrame:
    """(conv_id, k, section_no, term, translation, nuance, example)."""
    return pairs.sparkSession.sql("""
        SELECT conv_id, k,
          CASE WHEN conv_id % 5 = 0 AND k = 1 THEN 3 WHEN k % 2 = 1 THEN 1 ELSE 2 END AS section_no,
          split_part(target, ' ', 1) AS term, split_part(origin, ' ', 1) AS translation,
          CASE WHEN k % 2 = 0 THEN NULL ELSE split_part(origin, ' ', 2) END AS nuance,
          target AS example
        FROM {pairs}
    """, pairs=pairs)


_NOTES_OF = """transform(array_sort(collect_list(struct(k, term, translation, nuance, example))
                  FILTER (WHERE section_no = {s})),
                  x -> named_struct('term', x.term, 'translation', x.translation,
                                    'nuance', x.nuance, 'example', x.example))"""
_ITEMS = "array<struct<term:string,translation:string,nuance:string,example:string>>"


def v_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, deck_id, line_no, card): one card per conversation."""
    pairs = v_pairs(spark, sf_dir)
    notes = v_notes(pairs)
    wf, rv, cs = (_NOTES_OF.replace("{s}", str(s)) for s in (1, 2, 3))
    return spark.sql(f"""
        SELECT p.conv_id, CAST(p.conv_id % {N_DECKS} AS BIGINT) AS deck_id, CAST(p.conv_id AS BIGINT) AS line_no,
          named_struct(
            'source', concat('item ', CAST(p.conv_id AS STRING)), 'target_core', tc, 'origin_core', oc,
            'examples', ex,
            'word_family', coalesce(wf, CAST(array() AS {_ITEMS})),
            'related_vocab', coalesce(rv, CAST(array() AS {_ITEMS})),
            'custom_sections', CASE WHEN cs IS NULL OR size(cs) = 0
                                    THEN CAST(array() AS array<struct<title:string,items:{_ITEMS}>>)
                                    ELSE array(named_struct('title', 'Extra <notes>', 'items', cs)) END) AS card
        FROM (SELECT conv_id,
                     max(CASE WHEN k = 1 THEN split_part(target, ' ', 1) END) AS tc,
                     max(CASE WHEN k = 1 THEN split_part(origin, ' ', 1) END) AS oc,
                     transform(array_sort(collect_list(struct(k, target, origin))),
                               x -> named_struct('target', x.target, 'origin', x.origin)) AS ex
              FROM {{pairs}} GROUP BY conv_id) p
        LEFT JOIN (SELECT conv_id, {wf.replace('{', '{{').replace('}', '}}')} AS wf,
                          {rv.replace('{', '{{').replace('}', '}}')} AS rv,
                          {cs.replace('{', '{{').replace('}', '}}')} AS cs
                   FROM {{notes}} GROUP BY conv_id) n ON p.conv_id = n.conv_id
    """, pairs=pairs, notes=notes, customer=table(spark, sf_dir, "customer"))


def v_responses(spark: SparkSession, sf_dir: str, cards: DataFrame | None = None) -> DataFrame:
    """(request_id, body, error): one call result per card, as G7 writes them:
    conv_id % 19 = 0 failed (no body, an error); the other bodies are the card
    as JSON with seeded damage."""
    cards = cards if cards is not None else v_cards(spark, sf_dir)
    return spark.sql("""
        SELECT conv_id AS request_id,
          CASE WHEN conv_id % 19 = 0 THEN NULL
               WHEN conv_id % 11 = 0 THEN '{{"source":'
               WHEN conv_id % 13 = 0 THEN 'null'
               WHEN conv_id % 7 = 0 THEN concat('{{"extra":1,', substring(to_json(card), 2))
               WHEN conv_id % 17 = 0 THEN replace(to_json(card), '"target":"', '"target":" ","was":"')
               ELSE to_json(card) END AS body,
          CASE WHEN conv_id % 19 = 0 THEN 'timeout' END AS error,
          CAST(2 AS BIGINT) AS attempt, CASE WHEN conv_id % 19 = 0 THEN 'other' END AS code
        FROM {cards}
    """, cards=cards)


def received(responses: DataFrame) -> DataFrame:
    """The responses whose call succeeded: ``(request_id, attempt, body)``."""
    return responses.filter("error IS NULL").select("request_id", "attempt", "body")


def repeated_responses(received_: DataFrame) -> DataFrame:
    """The received responses and further answers to some requests: the same body again, a refusal or an
    empty list before it, another valid card before it."""
    return received_.sparkSession.sql("""
        SELECT request_id, attempt, body FROM {r}
        UNION ALL SELECT request_id, 3L, body FROM {r} WHERE request_id % 23 = 0
        UNION ALL SELECT request_id, 1L, 'null' FROM {r} WHERE request_id % 29 = 1
        UNION ALL SELECT request_id, 1L, '[]' FROM {r} WHERE request_id % 31 = 2
        UNION ALL SELECT request_id, 1L, replace(body, '"target_core":"', '"target_core":"alt ') FROM {r}
                  WHERE request_id % 37 = 3
    """, r=received_)
