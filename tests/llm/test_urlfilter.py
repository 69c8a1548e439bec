"""The as-of list join against judging each capture by all changes."""

import datetime as dt
import random

import pytest

from deckforge.llm import urlfilter as U

DAY = dt.date(2020, 1, 1)
CAPTURES = "page_id long, url string, fetched date, host string, of string, depth int, list string, verdict string"
CHANGES = "list string, host string, action string, at date"


def host_of(url):
    if url is None or "://" not in url or not url.split("://")[0].replace("+", "").isalnum():
        return None
    rest = url.split("://", 1)[1]
    for stop in "/?#":
        rest = rest.split(stop)[0]
    host = rest.rsplit("@", 1)[-1].split(":")[0].lower()
    return host or None


def brute(captures, changes):
    out = []
    for page, url, at in captures:
        host, valid = host_of(url), []
        if host and at:
            parts = host.split(".")
            for depth in range(len(parts)):
                name = ".".join(parts[depth:])
                for which in sorted({c[0] for c in changes if None not in c}):
                    past = [(c[3], c[2] == "add") for c in changes if None not in c and c[0] == which and
                            c[1].lower() == name and c[3] <= at]
                    if past and max(past)[1]:
                        valid.append((depth, which, name))
        first = min(valid) if valid else (None, None, None)
        out.append((page, host, first[1] == "block", first[1], first[2], len(valid)))
    return sorted(out, key=str)


def result(spark, captures, changes):
    c = spark.createDataFrame([(*r, "h", "o", 1, "l", "v") for r in captures], CAPTURES)
    got = U.judge(c, spark.createDataFrame(changes, CHANGES)).collect()
    return sorted([(r.page_id, r.verdict.host, r.verdict.blocked, r.verdict.list, r.verdict.domain, r.verdict.n_valid)
                   for r in got], key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_lists(spark, seed):
    rng = random.Random(seed)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "com", "c.net"]
    changes = [(rng.choice(["block", "allow"]), rng.choice(hosts), rng.choice(["add", "remove"]),
                DAY + dt.timedelta(rng.randrange(30))) for _ in range(60)]
    captures = [(i, f"https://{rng.choice(hosts)}/p{i}", DAY + dt.timedelta(rng.randrange(32))) for i in range(150)]
    assert result(spark, captures, changes) == brute(captures, changes)


def test_edge_rows(spark):
    day = lambda n: DAY + dt.timedelta(n)
    changes = [("block", "Bad.com", "add", day(3)), ("block", "bad.com", "remove", day(5)), ("block", "bad.com", "add", day(5)),
               ("allow", "ok.bad.com", "add", day(4)), ("block", "ok.bad.com", "add", day(4)), (None, "x", "add", day(1)),
               ("block", None, "add", day(1)), ("block", "x.org", "remove", day(1)), ("block", "gone.org", "add", None),
               ("block", "bad.com", "add", day(3))]
    urls = [None, "", "bad.com", "http://", "HTTP://BAD.COM:80/x", "https://u:p@ok.bad.com?q", "ftp://notbad.com",
            "https://deep.er.bad.com#top", "http://x.org", "http://" + "a." * 200 + "bad.com/" + "z" * 20_000]
    captures = [(i, u, day(d)) for i, u in enumerate(urls) for d in (2, 3, 5)] + [
        (None, "http://bad.com", day(9)), (7, "http://bad.com", None), (7, "http://bad.com", None)]
    got = result(spark, captures, changes)
    assert got == brute(captures, changes)
    assert any(r[2] for r in got)


def test_empty_tables(spark):
    assert result(spark, [], [("block", "a", "add", DAY)]) == []
    captures = [(1, "http://a.b", DAY)]
    assert result(spark, captures, []) == [(1, "a.b", False, None, None, 0)]


def test_plan_multiplies_no_capture(spark):
    c = spark.createDataFrame([(1, "http://a.b", DAY)], "page_id long, url string, fetched date")
    plan = U.judge(c, spark.createDataFrame([("block", "a.b", "add", DAY)], CHANGES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_timelines_are_pieces_of_different_verdicts(spark):
    day = lambda n: DAY + dt.timedelta(n)
    changes = [("block", "a.b", "add", day(1)), ("allow", "a.b", "add", day(3)), ("block", "a.b", "remove", day(5)),
               ("block", "a.b", "add", day(5)), ("allow", "a.b", "remove", day(7)), ("block", "a.b", "remove", day(9)),
               ("allow", "a.b", "add", day(12)), ("x", "c", "add", day(2)), ("x", "c", "add", day(4))]
    got = U.timelines(spark.createDataFrame(changes, CHANGES)).orderBy("host", "since").collect()
    assert [(r.host, r.since, r.until, r["list"], r.n) for r in got] == [
        ("a.b", day(1), day(3), "block", 1), ("a.b", day(3), day(7), "allow", 2), ("a.b", day(7), day(9), "block", 1),
        ("a.b", day(12), None, "allow", 1), ("c", day(2), None, "x", 1)]


def test_a_host_with_a_long_history(spark):
    """100,000 changes of one parent domain: rows of bounded size, and the right piece for each capture."""
    n = 100_000
    start = dt.datetime(2020, 1, 1)
    changes = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'allow' ELSE 'block' END AS list", "'co.uk' AS host",
        "CASE WHEN (id div 3) % 2 = 0 THEN 'add' ELSE 'remove' END AS action",
        "timestamp'2020-01-01' + make_interval(0, 0, 0, 0, 0, cast(id AS int), 0) AS at")
    blocks = U.timeline_blocks(U.timelines(changes))
    assert blocks.selectExpr("max(size(pieces))").first()[0] <= U.BLOCK_PIECES and blocks.count() > 300
    rng = random.Random(1)
    minutes = [rng.randrange(-5, n + 50) for _ in range(300)]
    captures = spark.createDataFrame([(i, f"http://w{i % 7}.shop.co.uk/{i}", start + dt.timedelta(minutes=m, seconds=30))
                                      for i, m in enumerate(minutes)], "page_id long, url string, fetched timestamp")

    def state(m, residues):  # the last change of the list at or before minute m
        past = [i for i in range(max(0, m - 6), min(m, n - 1) + 1) if i % 3 in residues] if m < n + 50 else []
        if m >= n:
            past = [i for i in range(n - 6, n) if i % 3 in residues]
        return bool(past) and (past[-1] // 3) % 2 == 0
    for r in U.judge(captures, changes).collect():
        m = minutes[r.page_id]
        allow, block = state(m, (0,)), state(m, (1, 2))
        v = r.verdict
        want = ("allow" if allow else "block") if allow or block else None
        assert (v["list"], v.n_valid, v.blocked) == (want, allow + block, want == "block"), (m, v)


def test_clashing_columns_and_no_captures(spark):
    names = "page_id long, url string, fetched date, host string, t long, depth int, pieces string, p int, n int, first int, verdict int"
    rows = [(1, "http://a.b", DAY, "h", 1, 1, "x", 1, 1, 1, 1)]
    changes = spark.createDataFrame([("block", "a.b", "add", DAY)], CHANGES)
    out = U.judge(spark.createDataFrame(rows, names), changes)
    r = out.first()
    assert out.columns == names.replace(" long", "").replace(" string", "").replace(" date", "").replace(" int", "").split(", ")
    assert r.verdict.blocked and (r.host, r.t, r.n, r["first"]) == ("h", 1, 1, 1)
    assert U.judge(spark.createDataFrame([], names), changes).collect() == []
