"""G2 ordered gather of side-file lines, G4 active-line counts, F8 status and warnings.

Side-file content is bounded (8,192 bytes per file). The bound is checked with
a partial aggregate *before* any line is collected, so no oversized group is
ever gathered into one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_active_line, py_strip
from ..schemas import SIDE_FILE_MAX_BYTES
from .numbering import ordered_gather

KINDS = ["customization", "blacklist"]


def gather_lines(raw_lines: DataFrame, keys: Sequence[str] = ("deck_id", "kind"),
                 pos_col: str = "pos", raw_col: str = "raw",
                 max_bytes: int = SIDE_FILE_MAX_BYTES) -> DataFrame:
    """G2 + G4 over raw side-file lines ``(keys..., pos, raw)``:
    ``(keys..., n_bytes, found, too_large, lines ARRAY<STRING>, n_lines)``.

    Sizes (UTF-8 bytes plus one newline per line) come from a partial
    aggregate first; only groups within ``max_bytes`` have their active lines
    (stripped, non-blank, not ``#``) gathered in ``pos`` order."""
    keys = list(keys)
    sizes = raw_lines.groupBy(*keys).agg(
        F.sum(F.octet_length(raw_col) + 1).cast("bigint").alias("n_bytes"))
    small = sizes.filter(F.col("n_bytes") <= max_bytes).select(*keys)
    active = (raw_lines.join(small, keys, "left_semi")
              .select(*keys, pos_col, py_strip(raw_col).alias("_line"))
              .filter(is_active_line(F.col("_line"))))
    gathered = ordered_gather(active, keys, pos_col, "_line", "lines")
    return (sizes.join(gathered, keys, "left")
            .withColumn("found", F.lit(True))
            .withColumn("too_large", F.col("n_bytes") > max_bytes)
            .withColumn("lines", F.coalesce("lines", F.array().cast("array<string>")))
            .withColumn("n_lines", F.size("lines").cast("bigint")))


def deck_instructions(gathered: DataFrame, key: str = "deck_id") -> DataFrame:
    """One row per deck: ``customization`` and ``blacklist`` arrays (NULL when the
    deck has no such content) and whether either was too large."""
    aggs = []
    for k in KINDS:
        aggs.append(F.max(F.when(F.col("kind") == k, F.col("lines"))).alias(k))
    aggs.append(F.max(F.col("too_large").cast("int")).cast("boolean").alias("side_too_large"))
    return gathered.groupBy(key).agg(*aggs)


def status_text(found: Column, lines: Column) -> Column:
    """F8 status: ``not found`` / ``N active line`` / ``N active lines``."""
    n = F.size(F.coalesce(lines, F.array().cast("array<string>")))
    unit = F.when(n == 1, F.lit("line")).otherwise(F.lit("lines"))
    return F.when(~found, F.lit("not found")).otherwise(F.concat(n.cast("string"), F.lit(" active "), unit))


def side_file_warnings(kind: Column, found: Column, lines: Column, minimal: Column) -> Column:
    """F8 warnings: missing file, no active content, or customization ignored
    because the deck is minimal (only when it has lines)."""
    n = F.size(F.coalesce(lines, F.array().cast("array<string>")))
    return F.filter(F.array(
        F.when(~found, F.lit("not_found")),
        F.when(found & (n == 0), F.lit("no_active_lines")),
        F.when((kind == F.lit("customization")) & F.coalesce(minimal, F.lit(False)) & (n > 0),
               F.lit("ignored_minimal")),
    ), lambda w: w.isNotNull())
