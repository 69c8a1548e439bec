"""S4 deck sink, S5 media sink, S6/W3 collision-free output names, J7 upsert plan and apply, deck table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import stable_int_id
from ..functions.text import sql_lit
from ..session import materialize, path_exists
from .commits import (DATA, Commit, CommitConflict, DataFile, make_commit, read_commit, read_files, versions,
                      write_files)
from .config import with_deck_tags
from .numbering import number_rows

# Namespaces of the integer ids, and the name of the note model.
DECK_NAMESPACE, MODEL_NAMESPACE, MODEL_NAME = "deckforge-deck:", "deckforge-model:", "Deckforge Card"

# A file of the deck table holds about so many notes: a large deck is written by
# as many tasks as it needs, small decks share a file.
NOTES_PER_FILE = 100_000
# Candidate numbers are made in runs of this many, so no array grows with the
# decks that ask for one path.
CANDIDATE_RUN = 10_000

# --- fixed values: output-name candidates ----------------------------------------
# "<stem>_<n><suffix>" for n = 1, 2, ...; the suffix is the last ".xxx" of the
# file name when something precedes it.
NAME_SPLIT = r"^(.*[^/])(\.[^./]+)$"
NUMBERED_STEM = r"^(.+)_([1-9][0-9]*)$"
# ---------------------------------------------------------------------------------


_SPLIT = sql_lit(NAME_SPLIT)
_NUMBERED = sql_lit(NUMBERED_STEM)


def _stem(col: str) -> str:
    return f"CASE WHEN {col} RLIKE {_SPLIT} THEN regexp_extract({col}, {_SPLIT}, 1) ELSE {col} END"


def _suffix(col: str) -> str:
    return f"CASE WHEN {col} RLIKE {_SPLIT} THEN regexp_extract({col}, {_SPLIT}, 2) ELSE '' END"


def candidate_name(path: str, n: str) -> str:
    """SQL: the n-th candidate for ``path`` (n = 0 is the path itself)."""
    return f"CASE WHEN {n} = 0 THEN {path} ELSE concat({_stem(path)}, '_', CAST({n} AS STRING), {_suffix(path)}) END"


def resolve_output_names(configs: DataFrame, existing: DataFrame, key: str = "deck_id",
                         path_col: str = "output_path", overwrite_col: str = "overwrite_output") -> DataFrame:
    """S6 + W3: ``(deck_id, requested, output_name)``.

    Overwriting decks keep their path. Every other deck gets the first free
    name of ``path, stem_1.suffix, stem_2.suffix, ...``, where a name is taken if
    it exists, is the path of an overwriting deck, or is another deck's
    requested path; several decks asking for the same path take consecutive free
    names in ``deck_id`` order. Candidates per path are bounded by
    requesters + names blocking that path, so the search is exact and finite."""
    req = configs.select(key, F.col(path_col).alias("requested"),
                         F.coalesce(F.col(overwrite_col), F.lit(False)).alias("_ow"))
    movers = req.filter(~F.col("_ow"))
    # Names that block: existing files and paths kept by overwriting decks block
    # every candidate including n = 0; requested paths block only other paths.
    names = (req.select(F.col("requested").alias("name"), F.col("_ow").alias("_hard"))
             .unionByName(existing.select(F.col("path").alias("name"), F.lit(True).alias("_hard"))))
    parsed = names.selectExpr("name", "_hard", f"{_stem('name')} AS _st", f"{_suffix('name')} AS _sf")
    blocked = parsed.selectExpr(
        f"CASE WHEN _st RLIKE {_NUMBERED} THEN array(named_struct("
        f"'requested', concat(regexp_extract(_st, {_NUMBERED}, 1), _sf), "
        f"'n', CAST(regexp_extract(_st, {_NUMBERED}, 2) AS BIGINT))) ELSE array() END AS _a",
        "CASE WHEN _hard THEN array(named_struct('requested', name, 'n', CAST(0 AS BIGINT))) ELSE array() END AS _b",
    ).select(F.explode(F.concat("_a", "_b")).alias("x")).select("x.requested", "x.n").distinct()
    per_path = movers.groupBy("requested").agg(F.count(F.lit(1)).alias("_m")).join(
        blocked.groupBy("requested").agg(F.count(F.lit(1)).alias("_t")), "requested", "left")
    # numbers 0 .. requesters + taken - 1: first the starts of runs, dealt out, then each run
    starts = per_path.select("requested", (F.col("_m") + F.coalesce("_t", F.lit(0))).alias("_n")).select(
        "requested", "_n", F.explode(F.expr(f"sequence(0L, (_n - 1) div {CANDIDATE_RUN})")).alias("_run"))
    cands = starts.repartition("requested", "_run").select("requested", F.explode(F.expr(
        f"sequence(_run * {CANDIDATE_RUN}, least((_run + 1) * {CANDIDATE_RUN}, _n) - 1)")).alias("n"))
    free = cands.join(blocked, ["requested", "n"], "left_anti")
    chosen = number_rows(movers, ["requested"], key, "_k").join(
        number_rows(free, ["requested"], "n", "_k"), ["requested", "_k"]).select(
        key, "requested", F.expr(candidate_name("requested", "n")).alias("output_name"))
    kept = req.filter(F.col("_ow")).select(key, "requested", F.col("requested").alias("output_name"))
    return chosen.unionByName(kept)


def plan_upsert(notes: DataFrame, existing: DataFrame, keys: tuple[str, ...] = ("deck_id",),
                fields: tuple[str, ...] = ("front_text", "back_text", "back_audio", "tags")) -> DataFrame:
    """Mark each new note ``new`` / ``changed`` / ``unchanged`` against an
    existing deck table, or ``duplicate`` when an earlier line of the same deck
    has the same note key. Only the first line of a key is compared, on both
    sides, so there is exactly one row per new note.

    The first line per key comes from a grouped minimum (combined map-side),
    never from a window over a possibly hot key."""
    keys = list(keys)
    k = [*keys, "note_guid"]

    def digest(df: DataFrame) -> DataFrame:
        parts = [F.coalesce(F.col(f).cast("string"), F.lit("\u0000")) for f in fields]
        return df.withColumn("_h", F.sha2(F.concat_ws("\u001f", *parts), 256))

    first = notes.groupBy(*k).agg(F.min("line_no").alias("_first"))
    old = digest(existing).groupBy(*k).agg(F.min(F.struct("line_no", "_h")).alias("_o")).select(
        *k, F.col("_o._h").alias("_old_h"))
    marked = digest(notes).join(first, k).join(old, k, "left")
    change = (F.when(F.col("line_no") > F.col("_first"), F.lit("duplicate"))
              .when(F.col("_old_h").isNull(), F.lit("new"))
              .when(F.col("_old_h") == F.col("_h"), F.lit("unchanged"))
              .otherwise(F.lit("changed")))
    return marked.select(*keys, "line_no", "note_guid", change.alias("change"))


def _spread(notes: DataFrame, notes_per_file: int) -> DataFrame:
    """``notes`` dealt to files of about ``notes_per_file``, each ordered by ``deck_id`` and ``line_no``: a
    deck's rows are salted by as many files as its own count asks for, and smaller decks are dealt by ranges of ids, so
    a million small decks make few files and a deck is in few of them."""
    sizes = notes.groupBy("deck_id").agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    files = max(1, -(-total // notes_per_file))
    salt = F.pmod(F.xxhash64("line_no"), F.ceil(F.col("_n") / notes_per_file))
    spread = notes.join(sizes, notes["deck_id"].eqNullSafe(sizes["deck_id"])).drop(sizes["deck_id"])
    return (spread.withColumn("_s", F.when(F.col("_n") < notes_per_file, F.lit(0)).otherwise(salt))
            .repartitionByRange(files, "deck_id", "_s").sortWithinPartitions("deck_id", "line_no").drop("_n", "_s"))


def write_decks(notes: DataFrame, base_path: str, notes_per_file: int = NOTES_PER_FILE, fmt: str = "parquet") -> int:
    """Make ``notes`` the next version of the deck table under ``base_path`` and return its number. The
    files are complete before the commit that names them, so a crash at any point leaves the version before in
    use; a version made meanwhile by another writer is a ``CommitConflict``.

    Readers of one deck skip the other files by their ``deck_id`` statistics. ``fmt`` is any file format Spark
    writes."""
    spark = notes.sparkSession
    notes = materialize(notes, "notes")  # counted, sampled for ranges and written
    before = read_commit(spark, base_path)
    files = write_files(_spread(notes, notes_per_file), base_path, fmt)
    commit = Commit(before.version + 1 if before else 1, tuple(files), notes.schema.json(), fmt,
                    before.batches if before else {})
    make_commit(spark, base_path, commit)
    return commit.version


def has_decks(spark: SparkSession, base_path: str) -> bool:
    """Whether the deck table has a version."""
    return bool(versions(spark, base_path))


def read_decks(spark: SparkSession, base_path: str, version: int | None = None) -> DataFrame:
    """A version of the deck table, the latest by default."""
    commit = read_commit(spark, base_path, version)
    if commit is None:
        raise ValueError(f"no deck table at {base_path}")
    return read_files(spark, base_path, commit)


def _touched(spark: SparkSession, base_path: str, commit: Commit, keys: DataFrame) -> list[DataFile]:
    """The data files that hold a note of ``keys`` (``deck_id``, ``note_guid``)."""
    lo, hi, nulls = keys.agg(F.min("deck_id"), F.max("deck_id"), F.count_if(F.col("deck_id").isNull())).first()
    near = [f for f in commit.files if (nulls and f.nulls) or (lo is not None and f.low is not None
                                                               and f.low <= hi and lo <= f.high)]
    if not near:
        return []
    old = read_files(spark, base_path, commit, near).select("deck_id", "note_guid", F.concat_ws(
        "/", F.lit(DATA), F.element_at(F.split("_metadata.file_path", "/"), -2), "_metadata.file_name").alias("_file"))
    held = {r._file for r in old.join(keys, _same_note(old, keys), "left_semi").select("_file").distinct().collect()}
    return [f for f in near if f.path in held]


def _same_note(a: DataFrame, b: DataFrame):
    return a["deck_id"].eqNullSafe(b["deck_id"]) & a["note_guid"].eqNullSafe(b["note_guid"])


def upsert_decks(notes: DataFrame, base_path: str, notes_per_file: int = NOTES_PER_FILE, tries: int = 5,
                 batch: tuple[str, int] | None = None) -> tuple[int, DataFrame]:
    """J7 applied: the next version holds the notes of the current one whose (deck_id, note_guid) is not in
    ``notes``, plus the first line of every key in ``notes`` (new and changed notes replace, duplicates are
    dropped, on the first write too). Only files that hold a replaced note are written anew. Returns the
    version and the plan (``plan_upsert``).

    Where another writer commits first, the upsert is planned again on the new version, up to ``tries`` times;
    then it is a ``CommitConflict``. A current version that can't be read is an error. ``batch`` is the name of a
    stream and the number of its batch: a batch (or an earlier one) that the table has taken in changes nothing."""
    spark = notes.sparkSession
    notes = materialize(notes, "notes")
    keys = notes.select("deck_id", "note_guid").distinct()
    for left in range(tries - 1, -1, -1):
        commit = read_commit(spark, base_path)
        plan = plan_upsert(notes, read_files(spark, base_path, commit) if commit else notes.limit(0))
        if commit and batch and commit.batches.get(batch[0], -1) >= batch[1]:
            return commit.version, plan
        first = notes.groupBy("deck_id", "note_guid").agg(F.min("line_no").alias("line_no"))
        fresh = notes.join(first, _same_note(notes, first) & (notes["line_no"] == first["line_no"]), "left_semi")
        gone: list[DataFile] = []
        if commit:
            gone = _touched(spark, base_path, commit, keys)
            old = read_files(spark, base_path, commit, gone)
            fresh = old.join(keys, _same_note(old, keys), "left_anti").unionByName(fresh, allowMissingColumns=True)
        files = write_files(_spread(fresh, notes_per_file), base_path, commit.fmt if commit else "parquet")
        kept = [f for f in commit.files if f not in gone] if commit else []
        try:
            made = Commit(commit.version + 1 if commit else 1, (*kept, *files), fresh.schema.json(),
                          commit.fmt if commit else "parquet", (commit.batches if commit else {}) | dict([batch] if batch else []))
            make_commit(spark, base_path, made)
            return made.version, plan
        except CommitConflict:
            if not left:
                raise


def write_media(media: DataFrame, path: str) -> None:
    """Append produced media to the media table (``media_id`` and the other columns of
    ``synthesize`` but its errors); ids already present are skipped. Only ids are compared: the
    audio itself is written from where it is."""
    spark = media.sparkSession
    produced = media.filter(F.col("error").isNull()).drop("code", "error")
    if path_exists(spark, path):
        have = spark.read.parquet(path).select("media_id")
        new = produced.select("media_id").join(have, "media_id", "left_anti")
        produced = produced.join(new, "media_id", "left_semi")
    produced.write.mode("append").parquet(path)


def deck_table(configs: DataFrame, names: DataFrame, key: str = "deck_id") -> DataFrame:
    """Per valid deck what an importer needs: stable integer ids of the deck and of its note model,
    the deck's name, its tags and the name of its output (``resolve_output_names``)."""
    tagged = with_deck_tags(configs.filter("valid"))
    return tagged.select(key, stable_int_id(F.col("deck_name"), DECK_NAMESPACE).alias("deck_int_id"),
                         stable_int_id(F.lit(MODEL_NAME), MODEL_NAMESPACE).alias("model_int_id"), "deck_name",
                         "tags").join(names.select(key, "output_name"), key)
