"""Text column expressions: Python-exact stripping, line splitting,
sentence capitalisation, HTML escaping and word counts.

Each function has a ``*_sql`` form that takes and returns a Spark SQL
expression string, so large nested expressions (validation, rendering) are
built as one string and handed to ``F.expr`` in a single call, and a Column
form for direct use. Everything stays JVM-side inside whole-stage codegen.
"""

from __future__ import annotations

import sys
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Python's ``str.strip()`` whitespace set (every code point with isspace()):
# U+0009-U+000D, U+001C-U+001F, U+0020, U+0085, U+00A0, U+1680,
# U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a Java / RE2 character class.
PY_WHITESPACE_CLASS = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# Python's ``str.splitlines()`` boundaries: \r\n, then any single one of
# U+000A-U+000D, U+001C-U+001E, U+0085, U+2028, U+2029.
LINE_BREAK_PATTERN = r"\r\n|[\n-\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
# Sentence chunks for capitalisation: text up to and including . ! or ?
SENTENCE_CHUNK_PATTERN = r"[^.!?]*[.!?]?"
# HTML escaping of & < > " ' (ampersand first).
HTML_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))
# ----------------------------------------------------------------------------


def sql_lit(s: str) -> str:
    """A Spark SQL string literal for ``s``: backslash, quote and every
    non-ASCII or control character escaped as a unicode escape."""
    out = []
    for ch in s:
        if ch == "\\":
            out.append("\\\\")
        elif ch == "'":
            out.append("\\'")
        elif ord(ch) < 0x20 or ord(ch) > 0x7E:
            out.append(("\\u%04x" if ord(ch) < 0x10000 else "\\U%08x") % ord(ch))
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


WS_LIT = sql_lit(PY_WHITESPACE)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- SQL-string builders --------------------------------------------------------

def strip_sql(x: str) -> str:
    return f"btrim({x}, {WS_LIT})"


def escape_sql(x: str) -> str:
    out = x
    for raw, entity in HTML_ESCAPES:
        out = f"replace({out}, {sql_lit(raw)}, {sql_lit(entity)})"
    return out


@cache
def _letters_class() -> str:
    """A regex class of all characters with ``str.isalpha()``, as ranges; the JVM's own letters are those of another
    Unicode version."""
    points = [c for c in range(sys.maxunicode + 1) if chr(c).isalpha()]
    starts = [c for c, before in zip(points, [-2, *points]) if c != before + 1]
    ends = [c for c, after in zip(points, [*points[1:], -2]) if after != c + 1]
    return "".join(r"\x{%x}-\x{%x}" % pair if pair[0] != pair[1] else r"\x{%x}" % pair[0] for pair in zip(starts, ends))


@cache
def _upper_sql(x: str) -> str:
    """``str.upper()`` of one character beyond ASCII: a table of single characters and one of the longer results."""
    pairs = [(chr(c), chr(c).upper()) for c in range(128, sys.maxunicode + 1) if chr(c).upper() != chr(c)]
    single = [(a, b) for a, b in pairs if len(b) == 1]
    longer = [(a, b) for a, b in pairs if len(b) > 1]
    table = ", ".join(f"{sql_lit(a)}, {sql_lit(b)}" for a, b in longer)
    return (f"CASE WHEN instr({sql_lit(''.join(a for a, _ in longer))}, {x}) > 0 THEN element_at(map({table}), {x}) "
            f"ELSE translate({x}, {sql_lit(''.join(a for a, _ in single))}, {sql_lit(''.join(b for _, b in single))}) END")


def capitalize_sql(x: str) -> str:
    """Strip, then upper-case the first letter of the text and the first letter
    after each ``.``, ``!`` or ``?``. Non-letters (digits, spaces, ``¿``) do not
    use up the slot, so ``3 dogs`` becomes ``3 Dogs``. Letters and capitals are Python's; the tables for them
    are only looked into where the first letter isn't ASCII."""
    ascii_lead = f"length(regexp_extract(ck_, {sql_lit(r'^([\x00-@\[-`{-\x7f]*)')}, 1))"
    exact_lead = f"length(regexp_extract(ck_, {sql_lit('^([^' + _letters_class() + ']*)')}, 1))"
    lead = f"CASE WHEN substr(ck_, al_ + 1, 1) <= {sql_lit(chr(127))} THEN al_ ELSE {exact_lead} END"
    head = f"CASE WHEN hd_ <= {sql_lit(chr(127))} THEN upper(hd_) ELSE {_upper_sql('hd_')} END"
    chunk = (f"transform(array(transform(array({ascii_lead}), al_ -> {lead})[0]), ld_ -> concat(substr(ck_, 1, ld_), "
             f"transform(array(substr(ck_, ld_ + 1, 1)), hd_ -> {head})[0], substr(ck_, ld_ + 2)))[0]")
    return (f"array_join(transform(regexp_extract_all({strip_sql(x)}, {sql_lit(SENTENCE_CHUNK_PATTERN)}, 0), "
            f"ck_ -> {chunk}), '')")


def word_count_sql(x: str) -> str:
    """``len(x.split())``."""
    return (f"size(filter(split({strip_sql(x)}, {sql_lit(PY_WHITESPACE_CLASS + '+')}), "
            f"wc_ -> wc_ != ''))")


def word_tokens_sql(x: str) -> str:
    """Lower-cased letter/digit tokens, for word and phrase matching."""
    return "filter(split(lower(" + x + "), " + sql_lit(r"[^\p{L}\p{N}]+") + "), tk_ -> tk_ != '')"


# --- Column forms ---------------------------------------------------------------

def py_strip(col: Column | str) -> Column:
    """``str.strip()`` with Python's whitespace set (Spark's trim strips only U+0020)."""
    return F.btrim(_c(col), F.lit(PY_WHITESPACE))


def is_blank(col: Column | str) -> Column:
    return py_strip(col) == F.lit("")


def split_lines(col: Column | str) -> Column:
    """Split like ``str.splitlines()``; a trailing terminator leaves one empty
    element, which the active-line filter drops."""
    return F.split(_c(col), LINE_BREAK_PATTERN)


def is_active_line(stripped: Column) -> Column:
    """An already stripped line is active if it is non-empty and not a ``#`` comment."""
    return (stripped != F.lit("")) & ~stripped.startswith("#")


def escape_html(expr: str) -> Column:
    return F.expr(escape_sql(expr))


def capitalize_sentences(expr: str) -> Column:
    """Column form of ``capitalize_sql`` for a column name or SQL expression."""
    return F.expr(capitalize_sql(expr))


def word_count(expr: str) -> Column:
    return F.expr(word_count_sql(expr))


def word_tokens(expr: str) -> Column:
    return F.expr(word_tokens_sql(expr))
