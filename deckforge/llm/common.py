"""Small helpers shared by the operators: replacing columns, Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: ASCII white space: words are runs of other characters, ``[^\x20\x09-\x0D]+``.
ASCII_SPACE = b" \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: UTF-8 continuation bytes: a text has as many code points as other bytes.
CONTINUATION = bytes(range(0x80, 0xC0))


def with_fresh(df: DataFrame, name: str, col: Column) -> DataFrame:
    """``df`` with column ``name`` set to ``col``; columns of that name in any case go first."""
    return df.drop(*[c for c in df.columns if c.lower() == name.lower()]).withColumn(name, col)


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name starting with ``stem`` that ``df`` doesn't have."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def utf8(col: str | Column) -> Column:
    """The text as bytes (null: null); Python splits bytes faster than strings."""
    return (F.col(col) if isinstance(col, str) else col).cast("binary")


def blocks(values: pa.Array, max_bytes: int) -> Iterator[list[bytes | None]]:
    """The batch's values in runs of about ``max_bytes`` (one value at least), so that the
    working memory of a block doesn't depend on the batch size."""
    run: list[bytes | None] = []
    held = 0
    for v in values:
        b = v.as_py()
        if run and held + len(b or b"") > max_bytes:
            yield run
            run, held = [], 0
        run.append(b)
        held += len(b or b"")
    if run:
        yield run


def struct_array(columns: dict[str, pa.Array]) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(columns.values()), list(columns))


def concat(parts: Iterable[pa.Array], kind: pa.DataType) -> pa.Array:
    parts = list(parts)
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def list_array(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """``flat`` cut into lists of the given lengths."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def words_in(col: str | Column) -> Column:
    """Number of words of a text (null: 0), JVM-side."""
    text = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def sorted_parts(df: DataFrame, order: list[Column], part: str, name: str) -> DataFrame:
    """``df`` range-partitioned by ``order``, with the number of the partition in ``part``: rows of a
    lower number sort first. Written to the shared folder, as a recomputed range may cut elsewhere."""
    from ..session import materialize
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(dealt.withColumn(part, F.spark_partition_id()), name)


def number_in_order(df: DataFrame, order: list[Column], out: str, name: str) -> DataFrame:
    """``df`` with 0-based positions in ``order``, without a window over all rows: positions within
    range partitions, plus a running sum of one count for each partition."""
    part, before, size = fresh_name(df, "_part"), fresh_name(df, "_before"), fresh_name(df, "_size")
    parts = sorted_parts(df, order, part, name)
    counts = parts.groupBy(part).agg(F.count(F.lit(1)).alias(size))
    offsets = counts.select(part, F.coalesce(F.sum(size).over(
        Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    inside = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return parts.join(offsets, part).withColumn(out, F.col(before) + inside - 1).drop(part, before)
