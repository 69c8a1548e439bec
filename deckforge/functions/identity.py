"""Stable identifiers: integer ids, note keys, media file names, slugs, tags.

Only ``slug`` and ``casefold`` run in Python (Arrow-batched pandas UDFs): Spark has neither NFKC
normalisation nor Unicode case folding. ``with_slug`` calls the first for different non-ASCII values only.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# --- fixed values -----------------------------------------------------------
# Integer ids: the first 15 hex digits of SHA-1 (60 bits, always < 2**63).
INT_ID_HEX_DIGITS = 15
# Slug fallback when nothing alphanumeric is left: "tag-" + 8 hex digits of SHA-1.
SLUG_FALLBACK_PREFIX = "tag-"
SLUG_FALLBACK_HEX_DIGITS = 8
# Media names: slug of the source cut to 40 characters, 16 hex digits of SHA-1.
MEDIA_SLUG_CHARS = 40
MEDIA_HASH_HEX_DIGITS = 16
DEFAULT_MEDIA_EXTENSION = ".mp3"
# Tag namespaces.
LANG_TAG_PREFIX = "lang::"
LEVEL_TAG_PREFIX = "level::"
# ----------------------------------------------------------------------------

DEFAULT_MEDIA_PREFIX = "deckforge"
DEFAULT_NOTE_KEY_VERSION = "deck-note-v1"

# A run of characters that are not ``str.isalnum()`` (``\w`` minus ``_``).
_NON_ALNUM_RUN = re.compile(r"[\W_]+")


def _slug_one(value: str) -> str:
    folded = unicodedata.normalize("NFKC", value.strip()).casefold()
    out = _NON_ALNUM_RUN.sub("-", folded).strip("-")
    if out:
        return out
    digest = hashlib.sha1(value.encode("utf-8")).hexdigest()
    return SLUG_FALLBACK_PREFIX + digest[:SLUG_FALLBACK_HEX_DIGITS]


@F.pandas_udf(StringType())
def slug(values: pd.Series) -> pd.Series:
    """Unicode slug: strip, NFKC, casefold, non-alphanumeric runs -> ``-``,
    trim ``-``; symbol-only text falls back to ``tag-<sha1[:8]>`` of the raw value."""
    return values.map(_slug_one, na_action="ignore")


def ascii_slug(value: Column) -> Column:
    """``slug`` of ASCII text, JVM-side."""
    out = F.regexp_replace(F.lower(value), "^[^a-z0-9]+|[^a-z0-9]+$", "")
    digest = F.substring(F.sha1(value.cast("binary")), 1, SLUG_FALLBACK_HEX_DIGITS)
    return F.when(out == "", F.concat(F.lit(SLUG_FALLBACK_PREFIX), digest)).otherwise(
        F.regexp_replace(out, "[^a-z0-9]+", "-"))


def with_slug(df: DataFrame, value: Column, out_col: str) -> DataFrame:
    """``df`` with the slug of ``value``. ASCII values are slugged in their row; of the others each different
    one goes to Python once and is joined back."""
    plain = value.rlike(r"\A[\x00-\x7F]*\z")
    native = df.where(value.isNull() | plain).withColumn(out_col, ascii_slug(value))
    other = df.where(~plain).withColumn("_slugged", value)
    named = other.select("_slugged").distinct().withColumn(out_col, slug(F.col("_slugged")))
    return native.unionByName(other.join(named, "_slugged").drop("_slugged"))


@F.pandas_udf(StringType())
def casefold(values: pd.Series) -> pd.Series:
    """``str.strip().casefold()`` (Spark's ``lower`` misses ß, ſ, µ and others)."""
    return values.map(lambda v: v.strip().casefold(), na_action="ignore")


def stable_int_id(value: Column, namespace: str = "") -> Column:
    """Stable positive BIGINT id: first 15 hex digits of SHA-1 of ``namespace + value``."""
    hexed = F.sha1(F.concat(F.lit(namespace), value))
    return F.conv(F.substring(hexed, 1, INT_ID_HEX_DIGITS), 16, 10).cast("bigint")


def length_prefixed(*parts: Column) -> Column:
    """Unambiguous concatenation ``len:text`` of each part (NULL parts become ``-1:``)."""
    pieces = []
    for p in parts:
        pieces.append(F.coalesce(F.length(p).cast("string"), F.lit("-1")))
        pieces.append(F.lit(":"))
        pieces.append(F.coalesce(p, F.lit("")))
    return F.concat(*pieces)


def note_key(source: Column, origin_core: Column, target_core: Column,
             version: str = DEFAULT_NOTE_KEY_VERSION) -> Column:
    """Stable note key: same (version, source, origin_core, target_core) -> same key."""
    return F.sha2(length_prefixed(F.lit(version), source, origin_core, target_core), 256)


def media_name(source_slug: Column, source: Column, target_core: Column,
               example_no: Column, example_target: Column,
               prefix: str = DEFAULT_MEDIA_PREFIX,
               extension: str = DEFAULT_MEDIA_EXTENSION) -> Column:
    """Content-derived media file name for one example sentence.

    ``<prefix>-<slug(source)[:40]>-<n>-<sha1(source\\ntarget_core\\nn\\ntarget)[:16]><ext>``;
    the 40-character cut is not re-trimmed, so it may end in ``-``.
    """
    n = example_no.cast("string")
    digest = F.substring(F.sha1(F.concat_ws("\n", source, target_core, n, example_target)),
                         1, MEDIA_HASH_HEX_DIGITS)
    return F.concat(F.lit(prefix + "-"), F.substring(source_slug, 1, MEDIA_SLUG_CHARS),
                    F.lit("-"), n, F.lit("-"), digest, F.lit(extension))


def media_id(file_name: Column, model: Column, voice: Column) -> Column:
    """Key of a produced file: the same sentence in another model's voice is another file."""
    return F.sha2(length_prefixed(file_name, model, voice), 256)


def deck_tags(target_slug: Column, level_slug: Column) -> Column:
    """The two namespaced tags every note of a deck carries."""
    return F.array(F.concat(F.lit(LANG_TAG_PREFIX), target_slug),
                   F.concat(F.lit(LEVEL_TAG_PREFIX), level_slug))


# --- SQL-string forms (for large expressions built in one F.expr call) ----------

def _q(s: str) -> str:
    from .text import sql_lit
    return sql_lit(s)


def length_prefixed_sql(*parts: str) -> str:
    pieces = []
    for p in parts:
        pieces.append(f"coalesce(cast(length({p}) as string), '-1'), ':', coalesce({p}, '')")
    return "concat(" + ", ".join(pieces) + ")"


def note_key_sql(source: str, origin_core: str, target_core: str,
                 version: str = DEFAULT_NOTE_KEY_VERSION) -> str:
    return f"sha2({length_prefixed_sql(_q(version), source, origin_core, target_core)}, 256)"


def media_name_sql(source_slug: str, source: str, target_core: str, example_no: str,
                   example_target: str, prefix: str = DEFAULT_MEDIA_PREFIX,
                   extension: str = DEFAULT_MEDIA_EXTENSION) -> str:
    n = f"cast({example_no} as string)"
    digest = (f"substr(sha1(concat_ws(char(10), {source}, {target_core}, {n}, {example_target})), "
              f"1, {MEDIA_HASH_HEX_DIGITS})")
    return (f"concat({_q(prefix + '-')}, substr({source_slug}, 1, {MEDIA_SLUG_CHARS}), '-', {n}, '-', "
            f"{digest}, {_q(extension)})")
