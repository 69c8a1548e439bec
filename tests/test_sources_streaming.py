import json
import os

from helpers import rows


def test_side_files(spark, tmpdir_path):
    from deckforge.sources.side_files import read_side_files
    d = tmpdir_path
    files = {"ok.txt": b"\t first rule \n\n#one\n   # two\nsecond # rule\n",
             "one.txt": b"alone\n", "limit.txt": b"x" * 8192, "big.txt": b"x" * 8193, "bad.txt": b"\xff\xfe",
             "comments.txt": b"# only\n", "empty.txt": b""}
    for name, data in files.items():
        with open(os.path.join(d, name), "wb") as fh:
            fh.write(data)
    os.mkdir(os.path.join(d, "adir"))
    names = list(files) + ["adir", "missing.txt"]
    manifest = spark.createDataFrame([(1, "customization", os.path.join(d, n)) for n in names],
                                     "deck_id long, kind string, path string")
    got = {os.path.basename(r.path): r for r in read_side_files(manifest).collect()}
    assert got["ok.txt"].lines == ["first rule", "second # rule"]
    assert got["ok.txt"].status == "2 active lines" and got["one.txt"].status == "1 active line"
    assert got["limit.txt"].outcome == "ok" and got["big.txt"].outcome == "too_large"
    assert got["big.txt"].n_bytes == 8193
    with open(os.path.join(d, "huge.txt"), "wb") as fh:
        fh.write(b"x" * 50_000)
    odd = [(1, "customization", p) for p in ("relative.txt", "ok.txt", "nosuch://x/y", os.path.join(d, "huge.txt"))]
    odd = spark.createDataFrame(odd, "deck_id long, kind string, path string")
    alone = {r.path: r for r in read_side_files(odd).collect()}
    assert {alone[p].outcome for p in ("relative.txt", "ok.txt", "nosuch://x/y")} == {"unreadable"}
    assert alone[os.path.join(d, "huge.txt")].n_bytes == 50_000
    based = {r.path: r.outcome for r in read_side_files(odd, base_uri="file://" + d).collect()}
    assert based["ok.txt"] == "ok" and based["relative.txt"] == "not_found"
    assert got["bad.txt"].outcome == "not_utf8" and got["adir"].outcome == "unreadable"
    assert got["missing.txt"].outcome == "not_found" and got["missing.txt"].status == "not found"
    assert got["missing.txt"].warnings == ["not_found"]
    for n in ("comments.txt", "empty.txt"):
        assert got[n].found and got[n].lines == [] and got[n].warnings == ["no_active_lines"]


def test_side_files_of_any_store_and_name(spark, tmpdir_path):
    """A scheme that only Hadoop knows, names with glob characters, hidden names, several chunks of paths."""
    from deckforge.sources.side_files import read_side_files
    names = ["plain.txt", "a b[1].txt", "x{y,z}*?.txt", ".hidden", "_under", "é.txt", "%41.txt", "zero", ".zero", "_big"]
    for name in names:
        data = b"" if "zero" in name else b"x" * 9000 if "big" in name else f"line of {name}\n".encode()
        with open(os.path.join(tmpdir_path, name), "wb") as fh:
            fh.write(data)
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.decks.link./in", "file://" + tmpdir_path)
    for base in (tmpdir_path, "viewfs://decks/in"):
        paths = [(i % 3, "blacklist", f"{base}/{n}") for i, n in enumerate([*names, "gone", ".gone"] * 2)]
        manifest = spark.createDataFrame(paths, "deck_id long, kind string, path string")
        got = read_side_files(manifest, paths_per_chunk=4).collect()
        assert len(got) == 24
        for r in got:
            name = r.path.rsplit("/", 1)[1]
            want = ("not_found", []) if "gone" in name else ("too_large", []) if "big" in name else (
                "ok", [] if "zero" in name else [f"line of {name}"])
            assert (r.outcome, r.lines) == want, r


def test_side_files_without_a_path(spark):
    from deckforge.sources.side_files import read_side_files
    manifest = spark.createDataFrame([(1, "blacklist", None)], "deck_id long, kind string, path string")
    assert [(r.found, r.outcome) for r in read_side_files(manifest).collect()] == [(False, "not_found")]


def test_stream_items_and_responses(spark, tmpdir_path):
    from deckforge.streaming.ingest import stream_items, stream_responses
    from factories import card_json
    src = os.path.join(tmpdir_path, "items")
    os.mkdir(src)
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("moon\n\n# later\nhigh tide\n")
    out = os.path.join(tmpdir_path, "out")
    q = stream_items(spark, src, out, os.path.join(tmpdir_path, "ck1"))
    q.awaitTermination(120)
    assert sorted(rows(spark.read.parquet(out), "line_no", "item")) == [(1, "moon"), (2, "high tide")]
    rsrc = os.path.join(tmpdir_path, "resp")
    os.mkdir(rsrc)
    with open(os.path.join(rsrc, "r.json"), "w") as fh:
        for rid, body in [("1", card_json()), ("2", "null")]:
            fh.write(json.dumps({"request_id": rid, "body": body}) + "\n")
    rout = os.path.join(tmpdir_path, "rout")
    q2 = stream_responses(spark, rsrc, rout, os.path.join(tmpdir_path, "ck2"))
    q2.awaitTermination(120)
    assert sorted(rows(spark.read.parquet(rout), "request_id", "valid")) == [("1", True), ("2", False)]


def test_read_line_files_and_responses(spark, tmpdir_path):
    from deckforge.sources.lines import active_text_lines, read_line_files
    from deckforge.sources.responses import read_responses
    from factories import card_json
    d = os.path.join(tmpdir_path, "items")
    os.mkdir(d)
    for name, text in [("a.txt", "moon\r\n\n# later\n  high tide  \n"), ("b.txt", "# nothing\n")]:
        with open(os.path.join(d, name), "w", newline="") as fh:
            fh.write(text)
    files = read_line_files(spark, d)
    got = sorted((os.path.basename(p), n, i) for p, n, i in rows(active_text_lines(files, ["path"], "text")))
    assert got == [("a.txt", 1, "moon"), ("a.txt", 2, "high tide")]
    rpath = os.path.join(tmpdir_path, "resp.json")
    with open(rpath, "w") as fh:
        for rid, body in [("1", card_json()), ("2", '{"source":')]:
            fh.write(json.dumps({"request_id": rid, "body": body}) + "\n")
    checked = {r.request_id: r.valid for r in read_responses(spark, rpath).collect()}
    assert checked == {"1": True, "2": False}


def test_stream_responses_joined_to_requests(spark, tmpdir_path):
    from deckforge.streaming.ingest import stream_responses
    from factories import card_json
    src = os.path.join(tmpdir_path, "resp")
    os.mkdir(src)
    with open(os.path.join(src, "r.json"), "w") as fh:
        for rid, body in [("a", card_json()), ("b", card_json(extra=1)), ("zz", card_json())]:
            fh.write(json.dumps({"request_id": rid, "body": body}) + "\n")
    reqs = spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], "request_id string, deck_id long, line_no long")
    out = os.path.join(tmpdir_path, "out")
    q = stream_responses(spark, src, out, os.path.join(tmpdir_path, "ck"), requests=reqs)
    q.awaitTermination(120)
    got = sorted(rows(spark.read.parquet(out), "request_id", "line_no", "valid"))
    assert got == [("a", 1, True), ("b", 2, False)]  # an answer nobody asked for is dropped


def _deck_stream(spark, folder):
    """Requests of one deck, its settings, and a function that streams files of responses into its table."""
    from deckforge.operators.config import validate_configs
    from deckforge.schemas import RAW_CONFIG
    from deckforge.streaming.ingest import stream_decks
    row = {f.name: None for f in RAW_CONFIG.fields}
    row.update(deck_id=1, origin_language="English", target_language="Spanish", notes_language="English", cefr_level="A2")
    decks = validate_configs(spark.createDataFrame([tuple(row[f.name] for f in RAW_CONFIG.fields)], RAW_CONFIG))
    requests = spark.createDataFrame([(f"r{n}", 1, n, item) for n, item in enumerate(["bread", "moon", "tide"], 1)],
                                     "request_id string, deck_id long, line_no long, item string")
    src, out = os.path.join(folder, "resp"), os.path.join(folder, "out")
    os.makedirs(src, exist_ok=True)

    def send(*responses):
        with open(os.path.join(src, f"{len(os.listdir(src))}.json"), "w") as fh:
            for r in responses:
                fh.write(json.dumps(r) + "\n")
        q = stream_decks(spark, src, out, os.path.join(folder, "ck"), requests, decks)
        q.awaitTermination(180)
        assert q.exception() is None
    return requests, decks, out, send


def test_streamed_answers_end_in_the_deck_table(spark, tmpdir_path):
    """A refusal, then a valid answer in a later batch: one note; later answers to the same request change nothing."""
    from deckforge.operators.commits import read_commit
    from deckforge.operators.sinks import read_decks
    from factories import card_json
    requests, decks, out, send = _deck_stream(spark, tmpdir_path)
    send({"request_id": "r1", "attempt": 1, "body": "null"},
         {"request_id": "r2", "attempt": 2, "body": card_json(target_core="luna")},
         {"request_id": "r2", "attempt": 1, "body": card_json(target_core="luna llena")},
         {"request_id": "r3", "attempt": 1, "code": "rate_limit", "error": "slow down"})
    table = os.path.join(out, "decks")
    assert [r.line_no for r in read_decks(spark, table).collect()] == [2]
    send({"request_id": "r1", "attempt": 2, "body": card_json()}, {"request_id": "nobody", "attempt": 1, "body": card_json()},
         {"request_id": "r2", "attempt": 3, "body": card_json(target_core="otra")})
    notes = read_decks(spark, table).orderBy("line_no").collect()
    assert [r.line_no for r in notes] == [1, 2] and "luna llena" in notes[1].back_text.lower()
    send({"request_id": "r3", "attempt": 2, "body": card_json()})
    assert read_decks(spark, table).count() == 3
    assert read_commit(spark, table).batches == {"responses": 2}


def test_a_replayed_batch_changes_nothing(spark, tmpdir_path, monkeypatch):
    import pytest

    from deckforge.operators import sinks
    from deckforge.schemas import GENERATE_OUT
    from deckforge.streaming.ingest import take_in
    from factories import card_json
    requests, decks, out, _ = _deck_stream(spark, tmpdir_path)
    batches = [spark.createDataFrame([(r, 1, card_json(), None, None)], GENERATE_OUT) for r in ("r1", "r2")]
    take = lambda n, batch: take_in(batch, n, requests, decks, out)
    assert [take(0, batches[0]), take(0, batches[0]), take(1, batches[1]), take(0, batches[0])] == [1, 1, 2, 2]

    def dies(*args):
        raise KeyboardInterrupt

    third = spark.createDataFrame([("r3", 1, card_json(), None, None)], GENERATE_OUT)
    monkeypatch.setattr(sinks, "make_commit", dies)
    with pytest.raises(KeyboardInterrupt):
        take(2, third)
    monkeypatch.undo()
    assert take(2, third) == 3  # its own answers of the first try don't count as earlier ones
    table = sinks.read_decks(spark, os.path.join(out, "decks"))
    assert sorted(r.line_no for r in table.collect()) == [1, 2, 3]


def test_files_larger_than_a_split(spark, tmpdir_path):
    """Positions and numbers as from whole files, whatever the splits, with all of Python's line breaks."""
    import random

    from deckforge.operators.clean import active_lines
    from deckforge.sources.lines import active_text_lines, read_line_files, read_split_lines
    rng = random.Random(5)
    breaks = ["\n"] * 12 + ["\r\n", "\r", "\n\n"]
    odd = ["\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029"]
    texts = {}
    for name, extra in (("plain.txt", []), ("odd.txt", odd), ("one.txt", []), ("empty.txt", []), ("blank.txt", [])):
        n = {"one.txt": 1, "empty.txt": 0}.get(name, 700)
        texts[name] = "".join(rng.choice(["", " ", "# no", "word é", "a longer line of words", "x # y"]) +
                              rng.choice(breaks + extra) for _ in range(n))
    texts["odd.txt"] += "y" * 3000 + "\u2028last without an end"
    texts["blank.txt"] = "\n \r\n#\n"
    folder = os.path.join(tmpdir_path, "items")
    os.mkdir(folder)
    for name, text in texts.items():
        with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as fh:
            fh.write(text)
    want = {(os.path.basename(r.path), r.line_no, r["item"])
            for r in active_text_lines(read_line_files(spark, folder), ["path"], "text").collect()}
    conf, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("700b", "128m"):
        spark.conf.set(conf, size)
        try:
            lines = read_split_lines(spark, folder)
            if size == "700b":
                assert spark.read.text(folder).rdd.getNumPartitions() > 10
            got = lines.collect()
            numbered = active_lines(lines, ["path"]).collect()
        finally:
            spark.conf.set(conf, before)
        for name, text in texts.items():
            mine = sorted((r.pos, r.raw) for r in got if os.path.basename(r.path) == name)
            assert [p for p, _ in mine] == list(range(len(mine)))
            python = text.splitlines()
            assert [t for _, t in mine][:len(python)] == python and not any(t for _, t in mine[len(python):]), name
        assert {(os.path.basename(r.path), r.line_no, r["item"]) for r in numbered} == want and len(numbered) == len(want)
