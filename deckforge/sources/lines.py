"""S1 line source: text (a column or whole files) -> numbered raw lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import is_active_line, py_strip, split_lines
from ..session import materialize


def read_lines(df: DataFrame, keys: Sequence[str], text_col: str) -> DataFrame:
    """One row per line of ``text_col``: ``(keys..., pos, raw)``, ``pos`` 0-based.

    Lines split like Python's ``splitlines``. Order is the ``pos`` column,
    never row position."""
    return df.select(*keys, F.posexplode(split_lines(text_col)).alias("pos", "raw"))


def read_line_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Whole text files -> ``(path, text)``. ``wholetext`` keeps each file in one
    row, the only way to keep reliable line order for a file."""
    return (spark.read.text(paths, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def read_split_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Text files of any size -> ``(path, pos, raw)``, as ``read_lines`` numbers whole files, with each file read in
    splits of ``spark.sql.files.maxPartitionBytes`` by as many tasks.

    A split's first position is the number of lines in the splits before it, from one small count table. Within a
    split, rows keep the order they were read in. Spark ends lines at ``\\n``, ``\\r`` and ``\\r\\n``; where a split
    also has Python's other line breaks, its rows are dealt out by split and summed up, else a row's
    position is plain arithmetic. (A byte order mark at a file's start isn't part of its first line.)"""
    read = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"), "value")
    rows = materialize(read.withColumn("n", F.size(split_lines("value"))), "split-lines")  # one reading: ids must agree
    splits = rows.groupBy("path", "split").agg(F.sum("n").alias("lines"), F.count(F.lit(1)).alias("rows"),
                                               F.min("id").alias("first"))
    earlier = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("before", F.coalesce(F.sum("lines").over(earlier), F.lit(0)))
    placed = rows.join(splits, ["path", "split"])
    plain = placed.where("lines = rows").select("path", (F.col("before") + F.col("id") - F.col("first")).alias("pos"),
                                                F.col("value").alias("raw"))
    above = Window.partitionBy("path", "split").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("before") + F.coalesce(F.sum("n").over(above), F.lit(0))
    broken = placed.where("lines > rows").withColumn("at", first).select(
        "path", "at", F.posexplode(split_lines("value")).alias("sub", "raw"))
    return plain.unionByName(broken.select("path", (F.col("at") + F.col("sub")).alias("pos"), "raw"))


def active_text_lines(df: DataFrame, keys: Sequence[str], text_col: str) -> DataFrame:
    """S1 + F1 + W1 inside each row: ``(keys..., line_no, item)``.

    The text is split, stripped and filtered as an array, then exploded with its
    position, so numbering needs no window and no shuffle (also works on a stream)."""
    stripped = F.transform(split_lines(text_col), py_strip)
    active = F.filter(stripped, is_active_line)
    return (df.select(*keys, F.posexplode(active).alias("pos", "item"))
            .select(*keys, (F.col("pos") + 1).cast("bigint").alias("line_no"), "item"))
