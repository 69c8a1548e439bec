"""F1 active-line filter, W1 numbering, F2 empty-source guard, F4 item split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_active_line, py_strip
from .numbering import DEFAULT_BUCKET_WIDTH, number_rows


def active_lines(lines: DataFrame, keys: Sequence[str], pos_col: str = "pos",
                 raw_col: str = "raw", out_col: str = "line_no",
                 bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Strip each line, drop blanks and ``#`` comments (also indented ones), keep
    duplicates, and number the survivors 1.. per source in ``pos`` order, so
    dropped lines leave no gaps. A ``#`` later in a line is data."""
    return number_rows(active_items(lines, keys, pos_col, raw_col), keys, pos_col, out_col, bucket_width)


def active_items(lines: DataFrame, keys: Sequence[str], pos_col: str = "pos", raw_col: str = "raw") -> DataFrame:
    """F1 alone: ``(keys..., pos, item)`` of the active lines, not numbered (enough to count them)."""
    return (lines.select(*keys, pos_col, py_strip(raw_col).alias("item"))
            .filter(is_active_line(F.col("item"))))


def empty_sources(lines: DataFrame, keys: Sequence[str], raw_col: str = "raw",
                  expected: DataFrame | None = None) -> DataFrame:
    """sources with no active line.

    Lines are first reduced to one row per source by a partial aggregate (a hot
    source is combined map-side). With ``expected`` (a table of source keys)
    the answer is an anti join against the sources that have an active line, so
    a source with no lines at all is reported too."""
    keys = list(keys)
    active = is_active_line(py_strip(raw_col))
    per_source = lines.groupBy(*keys).agg(F.count_if(active).alias("_n_active"))
    if expected is not None:
        present = per_source.filter(F.col("_n_active") > 0).select(*keys)
        return expected.select(*keys).distinct().join(present, keys, "left_anti")
    return per_source.filter(F.col("_n_active") == 0).drop("_n_active")


def split_item(df: DataFrame, item_col: str = "item") -> DataFrame:
    """``core (a, b, c)`` -> ``core`` and ``optional_vocab = [a, b, c]``.

    Only the documented parenthesised form is split; a line without ``(`` has
    no optional vocabulary. A missing ``)`` runs to the end of the line."""
    item = F.col(item_col)
    before = py_strip(F.regexp_extract(item, r"^([^(]*)", 1))
    inside = F.regexp_extract(item, r"\(([^)]*)", 1)
    has_paren = item.contains("(")
    vocab = F.filter(F.transform(F.split(inside, ","), py_strip), lambda v: v != F.lit(""))
    return df.withColumns({
        "core": F.when(before == F.lit(""), py_strip(item)).otherwise(before),
        "optional_vocab": F.when(has_paren, vocab).otherwise(F.array().cast("array<string>")),
    })


def require_active_sources(empty: DataFrame, keys: Sequence[str] = ("deck_id",), show: int = 10) -> None:
    """F2 strict mode: fail when any source has no active line (the result of
    ``empty_sources``), giving their number and naming up to ``show`` of them.
    Only these few rows and the number reach the driver."""
    found = empty.select(*keys).limit(show).collect()
    if found:
        names = ", ".join("/".join(str(v) for v in r) for r in found)
        total = empty.count()
        raise ValueError(f"{total} source{'s' if total > 1 else ''} without an active line, among them: {names}")
