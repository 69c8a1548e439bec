"""URL filters: an as-of join of captures with dated list entries, JVM-side only.

Dated changes of lists (a host is added to or removed from a list) become validity intervals by a
window over each list and host, and those of all lists a timeline of the host: pieces of time that don't
overlap, each with the list that decides and the number of lists that hold. Rows of ``BLOCK_PIECES``
consecutive pieces name the time they span, so a host with any number of changes is many rows of bounded size.

A capture is judged by the timelines of its host and of the host's parent domains at the time it was fetched. Each
different (host, time) of the captures is looked up once: it meets, for each domain, the one row that spans
its time, and in it the one piece. Captures are then joined once, on host and time, which spreads a host with a
third of all captures by its times; AQE splits what is left, and nothing is multiplied.

Of the valid entries the longest host decides; at one host an allow list beats a block list.

Defined results: a null or hostless URL, or a null time, matches nothing; hosts are compared in
lower case, without user and port; of several changes at one time to one list and host, adding
wins; an interval holds from its start to before its end; removing what was never added does
nothing; changes with a null anywhere are left out; repeated captures are judged each; without
entries nothing is blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_name, with_fresh

BLOCK, ALLOW = "block", "allow"
ADD = "add"
#: Pieces of a timeline in one row.
BLOCK_PIECES = 64


def host_of(url: Column) -> Column:
    """The URL's host in lower case; null if it has none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)),
                    F.lit(""))


def domains(host: Column) -> Column:
    """The host and its parent domains, the longest first."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(
        F.slice(parts, i, F.size(parts)), "."))


def intervals(changes: DataFrame) -> DataFrame:
    """changes: (list, host, action, at). Returns (list, host, since, until) of the times an entry holds."""
    once = changes.dropna(subset=["list", "host", "action", "at"]).groupBy(
        "list", F.lower("host").alias("host"), "at").agg(F.max(F.col("action") == ADD).alias("added"))
    ahead = Window.partitionBy("list", "host").orderBy("at")
    return once.withColumn("until", F.lead("at").over(ahead)).where("added").select(
        "list", "host", F.col("at").alias("since"), "until")


def timelines(changes: DataFrame) -> DataFrame:
    """The pieces of each host's timeline in which a list holds: ``host``, ``since``, ``until`` (null: open),
    ``list`` (the deciding one) and ``n`` (lists that hold). Work grows with a host's changes times its lists."""
    once = intervals(changes)
    edges = once.select("host", F.col("since").alias("at")).unionByName(
        once.where("until IS NOT NULL").select("host", F.col("until").alias("at"))).distinct()
    # each list's state at each time at which any list of the host changes
    turns = once.select("host", "list", F.col("since").alias("at"), F.lit(True).alias("on")).unionByName(
        once.where("until IS NOT NULL").select("host", "list", F.col("until").alias("at"), F.lit(False).alias("on")))
    turns = turns.groupBy("host", "list", "at").agg(F.max("on").alias("on"))  # one interval may begin as another ends
    grid = edges.join(once.select("host", "list").distinct(), "host").join(turns, ["host", "list", "at"], "left")
    so_far = Window.partitionBy("host", "list").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    held = grid.withColumn("on", F.last("on", ignorenulls=True).over(so_far)).groupBy("host", "at").agg(
        F.min(F.when(F.col("on"), F.col("list"))).alias("list"), F.count_if("on").alias("n"))
    ordered = Window.partitionBy("host").orderBy("at")
    before = F.struct(F.lag("list").over(ordered).alias("list"), F.lag("n", 1, 0).over(ordered).alias("n"))
    changed = held.withColumn("before", before).where(~F.struct("list", "n").eqNullSafe(F.col("before")))
    return changed.withColumn("until", F.lead("at").over(ordered)).where("n > 0").select(
        "host", F.col("at").alias("since"), "until", "list", "n")


def timeline_blocks(pieces: DataFrame) -> DataFrame:
    """Timelines in rows of up to ``BLOCK_PIECES`` neighbouring pieces: ``host``, ``low``, ``high`` (null: open), ``pieces``."""
    place = F.row_number().over(Window.partitionBy("host").orderBy("since")) - 1
    block = pieces.withColumn("block", F.floor(place / BLOCK_PIECES))
    rows = block.groupBy("host", "block").agg(F.min("since").alias("low"), F.max(F.struct("since", "until")).alias("last"),
                                              F.collect_list(F.struct("since", "until", "list", "n")).alias("pieces"))
    return rows.select("host", "low", F.col("last.until").alias("high"), "pieces")


def judge(captures: DataFrame, changes: DataFrame, url_col: str = "url", time_col: str = "fetched",
          out_col: str = "verdict") -> DataFrame:
    """``captures`` with a struct column: host, blocked, the deciding list and domain (null: none), and
    the number of entries valid for the host at the time."""
    key, of, when, said = (fresh_name(captures, x) for x in ("_host", "_of", "_when", "_said"))
    tagged = captures.withColumn(key, host_of(F.col(url_col)))
    asked = tagged.where(F.col(key).isNotNull() & F.col(time_col).isNotNull()).select(
        F.col(key).alias("of"), F.col(time_col).alias("t")).distinct()
    reach = asked.select("of", "t", F.posexplode(domains(F.col("of"))).alias("depth", "domain"))
    rows = timeline_blocks(timelines(changes))
    t = F.col("t")
    during = lambda low, high: (low <= t) & (high.isNull() | (t < high))
    met = reach.join(rows, (F.col("domain") == F.col("host")) & during(F.col("low"), F.col("high")))
    piece = F.get(F.filter("pieces", lambda p: during(p.since, p.until)), F.lit(0))
    found = met.select("of", "t", "depth", "domain", piece.alias("p")).where("p IS NOT NULL").groupBy("of", "t").agg(
        F.min(F.struct("depth", F.col("p.list").alias("list"), "domain")).alias("first"), F.sum("p.n").alias("n"))
    joined = tagged.join(found.select(F.col("of").alias(of), F.col("t").alias(when), F.struct("first", "n").alias(said)),
                         (F.col(key) == F.col(of)) & (F.col(time_col) == F.col(when)), "left")
    first = F.col(f"{said}.first")
    verdict = F.struct(F.col(key).alias("host"), F.coalesce(first["list"] == BLOCK, F.lit(False)).alias("blocked"),
                       first["list"].alias("list"), first["domain"].alias("domain"),
                       F.coalesce(F.col(f"{said}.n"), F.lit(0)).cast("int").alias("n_valid"))
    return with_fresh(joined, out_col, verdict).drop(key, of, when, said)
