"""S2 bounded side-file source + J3 manifest <-> file join + F8 status.

All access goes through Spark's own file systems, so any URI that ``spark.read`` opens works. The
manifest's distinct paths pass the driver in chunks of ``PATHS_PER_CHUNK``: what each path is (missing, a
folder, its size, whether it may be read) is asked of its file system, and the regular files within the
limit are read by the executors with ``binaryFile``, so contents don't pass the driver and larger files are
never opened. ``binaryFile`` leaves out zero-byte files (known from their size) and names that start with
``_`` or ``.``; the latter alone are read by the probe, up to the limit. UTF-8 validation, line splitting and
filtering are Spark expressions.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from ..functions.text import is_active_line, py_strip, split_lines
from ..operators.instructions import side_file_warnings, status_text
from ..schemas import SIDE_FILE_MAX_BYTES
from ..session import ensure_checkpoint_dir

PATHS_PER_CHUNK = 10_000
#: Paths asked for at once; each is a round trip to its store.
PROBES_AT_ONCE = 32

# --- fixed values: side-file outcomes ------------------------------------------
OK, NOT_FOUND, TOO_LARGE, NOT_UTF8, UNREADABLE = "ok", "not_found", "too_large", "not_utf8", "unreadable"
# -------------------------------------------------------------------------------

PROBE = StructType([
    StructField("path", StringType()), StructField("found", BooleanType()),
    StructField("n_bytes", LongType()), StructField("uri", StringType()),
    StructField("content", BinaryType()), StructField("error", StringType()),
])
_ABSOLUTE = re.compile("[A-Za-z][A-Za-z0-9+.-]*:/|/")
_GLOB = re.compile(r"([\\{}\[\]*?,])")


def _probe(spark: SparkSession, path: str, max_bytes: int) -> tuple:
    """What the file system of ``path`` says: ``(path, found, n_bytes, uri, content, error)``."""
    hadoop = spark._jvm.org.apache.hadoop
    if not _ABSOLUTE.match(path):
        return path, True, None, None, None, f"{UNREADABLE}: a relative path without base_uri"
    try:
        at = hadoop.fs.Path(path)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        status = fs.getFileStatus(at)
        if not status.isFile():
            return path, True, None, None, None, f"{UNREADABLE}: not a regular file"
        fs.access(at, hadoop.fs.permission.FsAction.READ)
        size, uri, content = status.getLen(), status.getPath().toString(), None
        if status.getPath().getName()[0] in "._" and 0 < size <= max_bytes:
            stream = fs.open(at)
            try:
                content = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size))
            finally:
                stream.close()
        return path, True, size, uri, content, None
    except Py4JJavaError as error:
        cause = error.java_exception
        kind = cause.getClass().getSimpleName()
        if kind == "FileNotFoundException":
            return path, False, None, None, None, None
        return path, True, None, None, None, f"{UNREADABLE}: {kind}: {cause.getMessage()}"


def probe_files(paths: DataFrame, max_bytes: int, chunk: int = PATHS_PER_CHUNK) -> DataFrame:
    """paths: distinct ``path``. ``(path, found, n_bytes, uri, content, error)`` of each, ``content`` of regular
    files of up to ``max_bytes``, written to the shared folder chunk by chunk."""
    spark = paths.sparkSession
    target = os.path.join(ensure_checkpoint_dir(spark), f"side-files-{uuid.uuid4().hex}")
    spark.createDataFrame([], PROBE).write.parquet(target)
    todo: Iterator = (r.path for r in paths.where("path IS NOT NULL").toLocalIterator())
    with ThreadPoolExecutor(PROBES_AT_ONCE) as pool:
        while some := list(islice(todo, chunk)):
            probed = list(pool.map(lambda p: _probe(spark, p, max_bytes), some))
            table = spark.createDataFrame(probed, PROBE)
            wanted = sorted({uri for _, _, size, uri, content, _ in probed if uri and content is None and 0 < size <= max_bytes})
            if wanted:
                read = spark.read.format("binaryFile").option("ignoreMissingFiles", "true").load(
                    [_GLOB.sub(r"\\\1", uri) for uri in wanted]).select(F.col("path").alias("uri"), F.col("content").alias("read"))
                table = table.join(read, "uri", "left").withColumn("content", F.coalesce("content", "read"))
            gone = (F.col("n_bytes").between(1, max_bytes)) & F.col("content").isNull()
            table.select("path", "found", "n_bytes", "uri", "content", F.when(gone, F.lit(f"{UNREADABLE}: can't be opened"))
                         .otherwise(F.col("error")).alias("error")).write.mode("append").parquet(target)
    return spark.read.schema(PROBE).parquet(target)


def read_side_files(manifest: DataFrame, keys: Sequence[str] = ("deck_id", "kind"), path_col: str = "path",
                    max_bytes: int = SIDE_FILE_MAX_BYTES, minimal_col: str | None = None,
                    base_uri: str | None = None, paths_per_chunk: int = PATHS_PER_CHUNK) -> DataFrame:
    """Paths are absolute URIs or absolute paths; a relative path is taken from ``base_uri`` (a folder
    that every executor reaches), without which it is ``unreadable``: each executor has a working
    folder of its own.

    Returns ``(keys..., path, found, n_bytes, lines, status, outcome, warnings)`` per
    manifest row. ``outcome`` is ok / not_found / too_large / not_utf8 /
    unreadable; ``lines`` holds the active lines in file order (empty unless ok)."""
    keys = list(keys)
    raw = F.col(path_col)
    absolute = raw.rlike(f"^({_ABSOLUTE.pattern})")
    uri = F.when(absolute, raw).otherwise(F.concat(F.lit(base_uri.rstrip("/") + "/"), raw) if base_uri else raw)
    manifest = manifest.withColumn("_uri", uri)
    probed = probe_files(manifest.select(F.col("_uri").alias("path")).distinct(), max_bytes, paths_per_chunk)
    probed = probed.withColumn("content", F.when(F.col("n_bytes") == 0, F.lit("").cast("binary")).otherwise(F.col("content")))
    text = F.col("content").cast("string")
    outcome = (F.when(F.col("error").isNotNull(), F.lit(UNREADABLE))
               .when(~F.col("found"), F.lit(NOT_FOUND))
               .when(F.col("n_bytes") > max_bytes, F.lit(TOO_LARGE))
               .when(~F.is_valid_utf8(text), F.lit(NOT_UTF8))
               .otherwise(F.lit(OK)))
    lines = F.filter(F.transform(split_lines(text), py_strip), is_active_line)
    files = probed.select("path", "found", "n_bytes", "error", outcome.alias("outcome"),
                          F.when(outcome == OK, lines).otherwise(F.array().cast("array<string>")).alias("lines"))
    extra = [minimal_col] if minimal_col else []
    files = files.withColumnRenamed("path", "_uri")
    joined = manifest.select(*keys, F.col(path_col).alias("path"), "_uri", *extra).join(files, "_uri", "left")
    minimal = F.col(minimal_col) if minimal_col else F.lit(False)
    found = F.coalesce(F.col("found"), F.lit(False))
    return joined.select(
        *keys, "path", found.alias("found"), "n_bytes", "lines",
        status_text(found, F.col("lines")).alias("status"),
        F.coalesce(F.col("outcome"), F.lit(NOT_FOUND)).alias("outcome"), "error",
        side_file_warnings(F.col("kind") if "kind" in keys else F.lit(""), found, F.col("lines"), minimal)
        .alias("warnings"))
