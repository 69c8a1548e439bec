"""The deck table's commits: numbered files, each naming all data files of one version with their key ranges.

Commit ``n`` is made by create-if-absent: it is written under another name and renamed (on a local disk: linked) to its
number, which fails where the number is taken. So a commit is there whole or not at all, two writers can't make the same one, and
no order of clocks or committer marker matters. The list is as long as the table has files (one for each
``NOTES_PER_FILE`` notes); the data itself never passes the driver.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMITS = "_commits"
DATA = "data"


class CommitConflict(RuntimeError):
    """Another writer has made a version since this one read the table."""


@dataclass(frozen=True)
class DataFile:
    """A data file under the table's folder; ``low`` and ``high`` bound its deck_ids (None: it has no deck_id)."""

    path: str
    rows: int
    low: int | None
    high: int | None
    nulls: int = 0


@dataclass(frozen=True)
class Commit:
    version: int
    files: tuple[DataFile, ...]
    schema: str
    fmt: str = "parquet"
    #: the last batch taken in from each stream
    batches: dict[str, int] = field(default_factory=dict)


def _hadoop(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, base: str) -> list[int]:
    """The numbers of the commits made so far, in order."""
    path, fs = _hadoop(spark, os.path.join(base, COMMITS))
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _commit_path(base: str, version: int) -> str:
    return os.path.join(base, COMMITS, f"{version:020d}.json")


def read_commit(spark: SparkSession, base: str, version: int | None = None) -> Commit | None:
    """A version's commit, the latest by default; None for a table without any."""
    if version is None:
        version = max(versions(spark, base), default=None)
        if version is None:
            return None
    text = "\n".join(r.value for r in spark.read.text(_commit_path(base, version), wholetext=True).collect())
    raw = json.loads(text)
    return Commit(raw["version"], tuple(DataFile(**f) for f in raw["files"]), raw["schema"], raw["fmt"], raw["batches"])


def make_commit(spark: SparkSession, base: str, commit: Commit) -> None:
    """Creates the commit's file, or raises ``CommitConflict`` where its number is taken."""
    jvm = spark._jvm
    target, fs = _hadoop(spark, _commit_path(base, commit.version))
    content = json.dumps(asdict(commit)).encode()
    taken = f"version {commit.version} of {base} was made by another writer"
    if fs.getUri().getScheme() == "file":  # its rename replaces a file that came between check and rename; a link can't
        path = target.toUri().getPath()
        draft = os.path.join(os.path.dirname(path), f".{uuid.uuid4().hex}")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(draft, "xb") as out:
            out.write(content)
        try:
            os.link(draft, path)
        except FileExistsError as error:
            raise CommitConflict(taken) from error
        finally:
            os.unlink(draft)
        return
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(content))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, target, keep)  # without OVERWRITE it fails where the target exists
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if fs.exists(target):
            raise CommitConflict(taken) from error
        raise


def read_files(spark: SparkSession, base: str, commit: Commit, files: list[DataFile] | None = None) -> DataFrame:
    """The rows of a commit (or of some of its files)."""
    schema = StructType.fromJson(json.loads(commit.schema))
    paths = [os.path.join(base, f.path) for f in (commit.files if files is None else files)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(commit.fmt).load(paths)


def write_files(df: DataFrame, base: str, fmt: str) -> list[DataFile]:
    """Writes ``df`` (as partitioned and sorted as it comes) under a new folder of the table and returns its files with
    their ranges of ``deck_id``. Nothing refers to them until a commit does."""
    spark, folder = df.sparkSession, f"{DATA}/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").format(fmt).save(os.path.join(base, folder))
    ids = spark.read.schema(df.schema).format(fmt).load(os.path.join(base, folder)).select(
        "deck_id", F.col("_metadata.file_name").alias("file"))
    stats = ids.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min("deck_id").alias("low"), F.max("deck_id").alias(
        "high"), F.count_if(F.col("deck_id").isNull()).alias("nulls"))
    return [DataFile(f"{folder}/{r.file}", r.rows, r.low, r.high, r.nulls) for r in stats.orderBy("file").collect()]
