"""Skew-safe row numbering and progress columns.

``row_number().over(Window.partitionBy(key))`` sends a whole key to one task;
when one deck holds a third of all rows that task holds a third of the data.
``number_rows`` numbers in two passes instead:

1. rows are cut into buckets of at most ``bucket_width`` consecutive order
   values, and each (key, bucket) is counted (a partial aggregate, so a hot key
   is combined map-side);
2. a running sum over the small bucket-count table gives each bucket its offset;
3. each row's number is its offset plus ``row_number()`` inside its bucket, so
   no window ever sees more than one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_WIDTH = 1 << 16


def number_rows(df: DataFrame, keys: Sequence[str], order_col: str | Sequence[str], out_col: str,
                bucket_width: int = DEFAULT_BUCKET_WIDTH, total_col: str | None = None) -> DataFrame:
    """1-based number of each row within ``keys``, ordered by ``order_col``
    (one column, or several: buckets follow the first, which must be integral;
    the full order must be unique within a key). Identical to ``row_number``
    ordered ascending with NULLs first; NULL keys form their own group.

    Buckets are ranges of ``bucket_width`` order values, so the count table has
    about (rows / occupancy) rows; positions that are roughly dense (line
    positions, generated keys) keep it small. For very sparse positions pass a
    larger ``bucket_width``. ``total_col``: also the number of rows of the key, from the same counts."""
    keys = list(keys)
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    bucket = "_nr_bucket"
    # Keys encoded so that a plain equality matches NULL with NULL: the join and the window then
    # ask for the same partitioning, and the rows are shuffled once.
    coded = {f"_nr_k{i}": F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit(""))
             for i, k in enumerate(keys)}
    # NULL order values sort first, so they get the lowest bucket.
    place = F.expr(f"(`{order[0]}` - pmod(`{order[0]}`, {bucket_width})) div {bucket_width}")
    tagged = df.withColumns(coded | {bucket: F.coalesce(place, F.lit(-(1 << 62)).cast("bigint"))})
    on = [*coded, bucket]
    counts = tagged.groupBy(*on).agg(F.count(F.lit(1)).alias("_nr_n"))
    before = Window.partitionBy(*coded).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    total = [F.sum("_nr_n").over(Window.partitionBy(*coded)).alias(total_col)] if total_col else []
    offsets = counts.select(*on, F.coalesce(F.sum("_nr_n").over(before), F.lit(0)).alias("_nr_off"), *total)
    inside = Window.partitionBy(*on).orderBy(*order)
    return (tagged.join(offsets, on)
            .withColumn(out_col, (F.col("_nr_off") + F.row_number().over(inside)).cast("bigint"))
            .drop(*on, "_nr_off"))


def with_progress(df: DataFrame, keys: Sequence[str], order_col: str | Sequence[str],
                  position_col: str = "position", total_col: str = "total",
                  bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """``position`` (1-based) and ``total`` within ``keys``, plus a
    ``progress`` text ``i/total``. The total is that of the bucket counts, so numbers and
    totals take one join and the input is read twice, for the counts and for the rows."""
    numbered = number_rows(df, keys, order_col, position_col, bucket_width, total_col)
    return numbered.withColumn("progress", F.concat_ws("/", F.col(position_col).cast("string"),
                                                       F.col(total_col).cast("string")))


def ordered_gather(df: DataFrame, keys: Sequence[str], order_col: str | Column,
                   value_col: str, out_col: str) -> DataFrame:
    """Gather ``value_col`` into one array per ``keys`` in ``order_col`` order
    (``collect_list`` alone is unordered after a shuffle). Only for groups whose
    size is bounded by construction (side-file lines, a card's examples)."""
    order = F.col(order_col) if isinstance(order_col, str) else order_col
    pairs = F.collect_list(F.struct(order.alias("o"), F.col(value_col).alias("v")))
    return df.groupBy(*keys).agg(F.transform(F.array_sort(pairs), lambda x: x["v"]).alias(out_col))


def in_input_order(df: DataFrame, keys: Sequence[str] = ("deck_id", "line_no"), global_sort: bool = False) -> DataFrame:
    """O1: order by the carried position columns, never by row arrival.
    ``global_sort`` range-partitions for a totally ordered result; otherwise each
    partition is sorted (what a partitioned sink needs)."""
    return df.orderBy(*keys) if global_sort else df.sortWithinPartitions(*keys)
