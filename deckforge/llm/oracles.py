"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from collections import Counter

from . import licenses, repetition

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
w AS (SELECT k, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
g AS (SELECT k, w, i,
        string_agg(w, ' ') OVER (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS g3,
        string_agg(w, ' ') OVER (PARTITION BY k ORDER BY i
          ROWS BETWEEN CURRENT ROW AND {repetition.MIN_REPEAT - 1} FOLLOWING) AS gm,
        md5(string_agg(w, ' ') OVER (PARTITION BY k ORDER BY i
          ROWS BETWEEN CURRENT ROW AND {repetition.MAX_REPEAT} FOLLOWING)) AS gx,
        count(*) OVER (PARTITION BY k) - i AS after FROM w),
f AS (SELECT k, i,
        after >= 2 AND count(*) OVER (PARTITION BY k, after >= 2, g3) > 1 AS r3,
        after >= {repetition.MIN_REPEAT - 1}
          AND count(*) OVER (PARTITION BY k, after >= {repetition.MIN_REPEAT - 1}, gm) > 1 AS rm,
        after >= {repetition.MAX_REPEAT}
          AND count(*) OVER (PARTITION BY k, after >= {repetition.MAX_REPEAT}, gx) > 1 AS rx FROM g),
c AS (SELECT k, i, rx,
        bool_or(r3) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS in3,
        bool_or(rm) OVER (PARTITION BY k ORDER BY i
          ROWS BETWEEN {repetition.MIN_REPEAT - 1} PRECEDING AND CURRENT ROW) AS inm FROM f),
a AS (SELECT k, count(*) FILTER (in3) AS n_repeat_words, count(*) FILTER (inm) AS covered_words,
        bool_or(rx) AS long_repeat FROM c GROUP BY k),
l AS (SELECT k, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT k, count(*) - count(DISTINCT line) AS dup FROM l
          WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY k),
s AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(covered_words, 0) AS BIGINT) AS covered_words,
        coalesce(long_repeat, false) AS long_repeat
      FROM d LEFT JOIN a USING (k) LEFT JOIN lines USING (k))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT long_repeat
    AND 100 * covered_words <= {repetition.MAX_COVERED_PERCENT} * n_words AS kept
FROM s
"""

_NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i, len(ws) AS n FROM d),
g AS (SELECT doc_id, n, i, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i
        ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS shingle FROM w),
s AS (SELECT DISTINCT doc_id, shingle FROM g WHERE i + 2 <= n OR (n < 3 AND i = 1)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b
           ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * c >= 85 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS r FROM documents
          UNION SELECT reach.doc_id, edge.b FROM reach JOIN edge ON edge.a = reach.r)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
LEFT JOIN n USING (doc_id)
"""

_FINGERPRINTS = """
WITH t AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
o AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first(text) OVER (ORDER BY doc_id)) AS nxt FROM t),
e AS (SELECT *, left(text, length(text) - length(text) // 2) || left(nxt, length(text) // 2) AS edited FROM o),
p AS (SELECT k, 'own' AS side, unnest(string_split(text, chr(10))) AS p FROM e
      UNION ALL SELECT k, 'edited', unnest(string_split(edited, chr(10))) FROM e
      UNION ALL SELECT k, 'next', unnest(string_split(nxt, chr(10))) FROM e),
d AS (SELECT k, side, CAST('0x' || substr(md5(p), 1, 15) AS BIGINT) AS d, count(*) AS n FROM p GROUP BY ALL),
el AS (SELECT k, side, CASE WHEN n = 1 THEN d ELSE CAST('0x' || substr(md5(d || ':' || n), 1, 15) AS BIGINT) END AS x
       FROM d),
cell AS (SELECT k, side, 16 * j + ((x >> (4 * j)) & 15) AS c, count(*) AS n, bit_xor(x) AS x,
           bit_xor(CAST('0x' || substr(md5(CAST(x AS VARCHAR)), 1, 8) AS BIGINT)) AS h
         FROM el, (SELECT unnest([0, 1, 2]) AS j) GROUP BY 1, 2, 3),
f AS (SELECT ks.k, ks.side, string_agg(coalesce(n, 0) || ':' || coalesce(x, 0) || ':' || coalesce(h, 0), ',' ORDER BY i) AS f
      FROM (SELECT k, 'own' AS side FROM t UNION ALL SELECT k, 'edited' FROM t) ks
      CROSS JOIN (SELECT unnest(generate_series(0, 47)) AS i) cells
      LEFT JOIN cell ON cell.k = ks.k AND cell.side = ks.side AND cell.c = i GROUP BY 1, 2),
sizes AS (SELECT k, count(*) FILTER (side = 'own') AS own, count(*) FILTER (side = 'edited') AS edited,
            count(*) FILTER (side = 'next') AS nxt FROM el GROUP BY k),
common AS (SELECT a.k, count(*) FILTER (b.side = 'edited') AS edited, count(*) FILTER (b.side = 'next') AS nxt
           FROM el a JOIN el b ON a.k = b.k AND a.x = b.x AND a.side = 'own' AND b.side <> 'own' GROUP BY 1)
SELECT e.doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(e.edited) AS edited_sha256, f.f AS fingerprint,
  g.f AS edited_fingerprint,
  coalesce(c.edited, 0) / CAST(s.own + s.edited - coalesce(c.edited, 0) AS DOUBLE) AS near_edited,
  coalesce(c.nxt, 0) / CAST(s.own + s.nxt - coalesce(c.nxt, 0) AS DOUBLE) AS near_next,
  s.own - coalesce(c.edited, 0) AS lost, s.edited - coalesce(c.edited, 0) AS gained
FROM e JOIN sizes s USING (k) LEFT JOIN common c USING (k)
JOIN f ON f.k = e.k AND f.side = 'own' JOIN f g ON g.k = e.k AND g.side = 'edited'
"""

_URL_FILTER = r"""
WITH c AS (SELECT page_id, DATE '2020-01-01' + CAST(((page_id * 7919) % 1461 + 1461) % 1461 AS INTEGER) AS fetched,
  nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '') AS host
  FROM pages),
p AS (SELECT DISTINCT host, string_split(host, '.') AS parts FROM c WHERE host IS NOT NULL),
up AS (SELECT host AS child, i AS depth, array_to_string(parts[i:], '.') AS name
       FROM p, unnest(generate_series(1, len(parts))) AS g(i)),
names AS (SELECT DISTINCT name, md5(name) AS m FROM up WHERE depth <= 2),
changes AS (SELECT name, CASE WHEN CAST('0x' || substr(m, 25 + j, 1) AS INT) < 12 THEN 'block' ELSE 'allow' END AS list,
    CAST('0x' || substr(m, 20 + j, 1) AS INT) < 9 AS added,
    DATE '2020-01-01' + CAST('0x' || substr(m, 1 + 4 * j, 4) AS INT) % 1461 AS day
  FROM names, unnest([0, 1, 2, 3]) AS g(j) WHERE CAST('0x' || substr(m, 30, 1) AS INT) < 8),
once AS (SELECT name, list, day, bool_or(added) AS added FROM changes GROUP BY ALL),
iv AS (SELECT *, lead(day) OVER (PARTITION BY name, list ORDER BY day) AS until FROM once),
hit AS (SELECT page_id, depth, iv.list, iv.name,
    row_number() OVER (PARTITION BY page_id ORDER BY depth, iv.list) AS place, count(*) OVER (PARTITION BY page_id) AS n
  FROM c JOIN up ON up.child = c.host JOIN iv ON iv.name = up.name AND iv.added AND iv.day <= c.fetched
    AND (iv.until IS NULL OR c.fetched < iv.until))
SELECT c.page_id, c.fetched, c.host, coalesce(hit.list = 'block', false) AS blocked, hit.list, hit.name AS domain,
  CAST(coalesce(hit.n, 0) AS INTEGER) AS n_valid
FROM c LEFT JOIN hit ON hit.page_id = c.page_id AND hit.place = 1
"""


def _license_sql() -> str:
    """Statements and inheritance, with a formula of its own; the given texts hold no whole license and no header."""
    own, n_own = licenses._as_files()
    told = [(i, name, licenses.telling(text), Counter(licenses._in_words(text)))
            for i, (name, text) in enumerate(licenses.statements())]
    terms = sorted({t for *_, c in told for t in c})
    variants = ", ".join(f"'{v}'" for v in licenses.VARIANTS)
    return rf"""
WITH v(term, own) AS (VALUES {", ".join(f"('{t}', {own[t]})" for t in terms)}),
st(i, license, told, term, n) AS (VALUES {", ".join(f"({i}, '{name}', '{x}', '{t}', {n})" for i, name, x, c in told
                                                    for t, n in c.items())}),
f AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, concat_ws('/', source,
    CASE WHEN (doc_id // 20) % 11 <> 0 THEN concat('a', (doc_id // 20) % 7, '/b', doc_id // 2000) END,
    CASE WHEN (doc_id // 20) % 3 = 0 THEN 'LICENSE' ELSE concat('f', doc_id, '.txt') END) AS path FROM documents),
d AS (SELECT *, regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, regexp_extract(path, '([^/]*)$', 1) AS name FROM f),
seen AS (SELECT k, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS term FROM d),
idf AS (SELECT term, round(ln((1 + {n_own} + (SELECT count(*) FROM d)) / (1 + any_value(own) + count(k))) + 1, 6) AS w
        FROM v LEFT JOIN seen USING (term) GROUP BY term),
sw AS (SELECT i, license, told, term, w * (1 + ln(n)) AS w FROM st JOIN idf USING (term)),
norms AS (SELECT i, sqrt(sum(w * w)) AS norm FROM sw GROUP BY i),
l AS (SELECT k, row_number() OVER () AS line_no, line FROM (SELECT k, unnest(string_split(lower(text), chr(10))) AS line FROM d)
      WHERE contains(line, 'licen')),
w AS (SELECT line_no, unnest(regexp_extract_all(regexp_replace(line, '\bv(?:er)?\.? ?([0-9])', 'version \1', 'g'), '[a-z0-9]+'))
        AS term FROM l),
tf AS (SELECT line_no, term, count(*) AS n FROM w WHERE NOT regexp_full_match(term, '[0-9]+') GROUP BY ALL),
num AS (SELECT line_no, string_agg(x, ' ' ORDER BY x) AS told FROM (SELECT DISTINCT line_no, regexp_replace(x, '(\.0)+$', '') AS x
        FROM (SELECT line_no, unnest(regexp_extract_all(line, '[0-9]+(?:\.[0-9]+)*')) AS x FROM l)
        WHERE length(string_split(x, '.')[1]) <= 2) GROUP BY line_no),
var AS (SELECT line_no, string_agg(term, ' ' ORDER BY term) AS told FROM tf WHERE term IN ({variants}) GROUP BY line_no),
told AS (SELECT line_no, k, concat_ws(' ', num.told, '|', var.told) AS told
         FROM l LEFT JOIN num USING (line_no) LEFT JOIN var USING (line_no)),
lw AS (SELECT line_no, term, coalesce(w, 1.0) * (1 + ln(n)) AS w FROM tf LEFT JOIN idf USING (term)),
size AS (SELECT line_no, sqrt(sum(w * w)) AS norm FROM lw GROUP BY line_no),
best AS (SELECT k, license, round(sum(lw.w * sw.w) / any_value(size.norm * norms.norm), 6) AS score
         FROM told JOIN lw USING (line_no) JOIN size USING (line_no) JOIN sw ON sw.told = told.told AND sw.term = lw.term
         JOIN norms USING (i) GROUP BY k, line_no, i, license),
own AS (SELECT k, license AS own, score FROM best WHERE score >= {licenses.MIN_COSINE}
        QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, license) = 1),
given AS (SELECT folder, own, score FROM d JOIN own USING (k) WHERE name = 'LICENSE'
          QUALIFY row_number() OVER (PARTITION BY folder ORDER BY score DESC, own) = 1),
near AS (SELECT x.folder, g.folder AS at, g.own FROM (SELECT DISTINCT folder FROM d) x JOIN given g
         ON x.folder = g.folder OR g.folder = '' OR starts_with(x.folder, g.folder || '/')
         QUALIFY row_number() OVER (PARTITION BY x.folder ORDER BY length(g.folder) DESC) = 1)
SELECT d.doc_id, path, own.own, coalesce(own.score, 0.0) AS score, coalesce(own.own, near.own) AS holds,
  CASE WHEN own.own IS NULL THEN near.at END AS inherited_from
FROM d LEFT JOIN own USING (k) LEFT JOIN near ON near.folder = d.folder
"""


_CHAT = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           WHERE conv_id IS NOT NULL),
p AS (SELECT conv_id, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n,
        md5(string_agg(role || chr(1) || text, chr(2)) OVER w) AS h FROM t
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
whole AS (SELECT n, h, min(conv_id) AS conv_id, count(*) AS n_equal FROM p WHERE place = n GROUP BY n, h),
keep AS (SELECT * FROM whole WHERE NOT EXISTS (
  SELECT 1 FROM p WHERE p.place < p.n AND p.place = whole.n AND p.h = whole.h)),
r AS (SELECT conv_id, string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |')
        || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS rendered FROM t GROUP BY conv_id)
SELECT conv_id, n AS n_turns, n_equal, CAST(length(rendered) AS BIGINT) AS n_chars, sha256(rendered) AS rendered_sha256
FROM keep JOIN r USING (conv_id)
"""

_COLLOCATIONS = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, 'und') AS lang,
    regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]', chr(10), 'g') AS text FROM documents),
p AS (SELECT k, lang, unnest(string_split(text, chr(10))) AS piece, generate_subscripts(string_split(text, chr(10)), 1) AS j
      FROM d),
s AS (SELECT k, lang, j, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
w AS (SELECT k, lang, j, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM s),
g AS MATERIALIZED (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3
      FROM w WINDOW o AS (PARTITION BY k, j ORDER BY i)),
total AS (SELECT lang, count(*) AS n FROM g GROUP BY lang),
f1 AS (SELECT lang, w1 AS ph, count(*) AS f FROM g GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, w1 || ' ' || w2 AS ph, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, w1 || ' ' || w2 || ' ' || w3 AS ph, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL
       HAVING count(*) >= 10),
f AS MATERIALIZED (SELECT lang, ph, f FROM f1 UNION ALL SELECT lang, ph, f FROM f2 UNION ALL SELECT lang, ph, f FROM f3),
c AS MATERIALIZED (SELECT lang, ph AS phrase, f AS a, 1 AS k, w1 AS lp, w2 AS rp FROM f2
      UNION ALL SELECT lang, ph, f, 1, w1, w2 || ' ' || w3 FROM f3 UNION ALL SELECT lang, ph, f, 2, w1 || ' ' || w2, w3 FROM f3),
cut AS (SELECT c.lang, phrase, a, k, x.f AS l, y.f AS r,
    (CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.ph = lp JOIN f y ON y.lang = c.lang AND y.ph = rp),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, phrase, max(f) AS around FROM (
    SELECT lang, w1 || ' ' || w2 AS phrase, f FROM f3 UNION ALL SELECT lang, w2 || ' ' || w3, f FROM f3) GROUP BY ALL),
free AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE around IS NULL OR 100 * around < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
  CAST(score AS BIGINT) AS score
FROM free JOIN total USING (lang) QUALIFY rank <= 2000
"""

_DECONTAMINATION = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM documents),
b AS (SELECT row_number() OVER () AS k, item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') AS gram FROM (
    SELECT *, unnest(generate_series(1, len(ws) - size + 1)) AS i FROM (
      SELECT *, least(10, len(ws)) AS size FROM b WHERE len(ws) > 0))),
place AS (SELECT k, n, i, size, array_to_string(ws[i:i + size - 1], ' ') AS gram FROM (
    SELECT k, ws, len(ws) AS n, unnest(generate_series(1, len(ws))) AS i FROM d), (SELECT DISTINCT size FROM win)
    WHERE i + size - 1 <= n),
occ AS (SELECT k, i, place.size, item_id FROM place JOIN win ON win.gram = place.gram AND win.size = place.size),
hit AS (SELECT k, count(DISTINCT j) AS n_hit FROM (
    SELECT k, unnest(generate_series(i, i + size - 1)) AS j FROM (SELECT DISTINCT k, i, size FROM occ)) GROUP BY k),
items AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
    SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM occ WHERE item_id IS NOT NULL) GROUP BY k)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (k) LEFT JOIN items USING (k)
"""


def _manifest_sql(levels: int = 14) -> str:
    """Levels one by one; 14 of them hold 3**14 rows of one source and as many sources."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    own = "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
    cut = own.replace("text", "cut")
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda c: ascii(c)::BIGINT)), lambda x, c: list_reduce([xor(x, c), 0, 0, 0, 0, 0, 0, 0, 0], "
           "lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295)")
    parts = [f"""d AS (SELECT *, CASE WHEN ({crc}) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut
      FROM documents),
leaves AS (SELECT row_number() OVER () AS k, doc_id, coalesce('=' || source, '') AS g, {own} AS leaf, {cut} AS tampered FROM d),
c0 AS MATERIALIZED (SELECT k, doc_id, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
    leaf, tampered AS fold, '' AS proof FROM leaves),
s0 AS MATERIALIZED (SELECT g, p, leaf AS h FROM c0)"""]

    def climb(s: str, c: str, base: str) -> list[str]:
        """The levels above the nodes s0 and, step by step, what leads up from the leaves c0."""
        out = []
        for i in range(levels):
            run = "OVER (PARTITION BY g, p // 3 ORDER BY p ROWS BETWEEN"
            out.append(f"""{s}n{i} AS MATERIALIZED (SELECT g, p, h, count(*) OVER (PARTITION BY g) AS n,
    coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
    coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM {s}{i}),
{s}{i + 1} AS MATERIALIZED (SELECT g, p // 3 AS p, CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h
    FROM {s}n{i} GROUP BY g, p // 3),
{c}{i + 1} AS MATERIALIZED (SELECT c.* EXCLUDE (p, fold, proof), c.p // 3 AS p, proof || a || b AS proof,
    CASE WHEN n = 1 THEN fold ELSE sha256(a || fold || b) END AS fold FROM {c}{i} c JOIN {s}n{i} s ON s.g = c.g AND s.p = c.p)""")
        return out

    parts += climb("s", "c", "leaves")
    parts.append(f"""subroots AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS p FROM s{levels}),
t0 AS (SELECT '' AS g, p, subroot AS h FROM subroots),
u0 AS (SELECT k, doc_id, leaf, subroot, '' AS g, s.p, fold, proof FROM c{levels} c JOIN subroots s ON s.g = c.g)""")
    parts += climb("t", "u", "subroots")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = h AS verified
FROM u{levels} JOIN t{levels} ON true
"""

ORACLES: dict[str, str] = {
    "op1_quality_rules": _QUALITY,
    "op3_document_fingerprints": _FINGERPRINTS,
    "op4_near_duplicates": _NEAR_DUPLICATES,
    "op6_url_filter": _URL_FILTER,
    "op7_license_scan": _license_sql(),
    "op9_chat_format": _CHAT,
    "op11_phrase_collocations": _COLLOCATIONS,
    "op12_benchmark_decontamination": _DECONTAMINATION,
    "op13_merkle_manifest": _manifest_sql(),
}
