import os

from pyspark.sql import functions as F

from helpers import rows
from factories import card_json, entry, validated_cards


def _names(spark, decks, existing):
    from deckforge.operators.sinks import resolve_output_names
    cfg = spark.createDataFrame(decks, "deck_id long, output_path string, overwrite_output boolean")
    ex = spark.createDataFrame([(p,) for p in existing], "path string")
    return {r.deck_id: r.output_name for r in resolve_output_names(cfg, ex).collect()}


def test_output_names(spark):
    assert _names(spark, [(1, "deck.apkg", False)], []) == {1: "deck.apkg"}
    assert _names(spark, [(1, "deck.apkg", False)], ["deck.apkg"]) == {1: "deck_1.apkg"}
    assert _names(spark, [(1, "deck.apkg", False)], ["deck.apkg", "deck_1.apkg"]) == {1: "deck_2.apkg"}
    assert _names(spark, [(1, "deck.apkg", True)], ["deck.apkg"]) == {1: "deck.apkg"}
    got = _names(spark, [(1, "out/d.apkg", False), (2, "out/d.apkg", False), (3, "out/d_1.apkg", False),
                         (4, "x", False)], ["out/d.apkg", "x"])
    assert got == {1: "out/d_2.apkg", 2: "out/d_3.apkg", 3: "out/d_1.apkg", 4: "x_1"}


def test_plan_upsert(spark):
    from deckforge.operators.sinks import plan_upsert
    cols = "deck_id long, line_no long, note_guid string, front_text string, back_text string, " \
           "back_audio string, tags string"
    new = spark.createDataFrame([(1, 1, "g1", "f", "b", "", "t"), (1, 2, "g2", "f", "b2", "", "t"),
                                 (1, 3, "g3", "f", "b", "", "t"), (1, 4, "g1", "f", "b", "", "t")], cols)
    old = new.filter("line_no IN (1, 2)").withColumn(
        "back_text", F.when(F.col("note_guid") == "g2", F.lit("old")).otherwise(F.col("back_text")))
    old = old.unionByName(old.withColumns({"line_no": F.col("line_no") + 10, "back_text": F.lit("later")}))
    plan = rows(plan_upsert(new, old), "line_no", "change")
    got = dict(plan)
    assert len(plan) == 4  # keys repeated on both sides multiply nothing
    assert got == {1: "unchanged", 2: "changed", 3: "new", 4: "duplicate"}


def test_write_and_read_decks_and_media(spark, tmpdir_path):
    from deckforge.operators.sinks import read_decks, write_decks, write_media
    notes = spark.createDataFrame([(d, n, f"g{d}{n}") for d in (1, 2) for n in range(1, 6)],
                                  "deck_id long, line_no long, note_guid string")
    base = os.path.join(tmpdir_path, "decks")
    first = write_decks(notes, base)
    assert read_decks(spark, base).count() == 10
    second = write_decks(notes.filter("deck_id = 1"), base)
    assert first != second and read_decks(spark, base).count() == 5
    assert read_decks(spark, base, first).count() == 10  # old version untouched
    media = spark.createDataFrame([("m1", "a.mp3", b"1", None, None), ("m2", "a.mp3", b"2", None, None),
                                   ("m3", "b.mp3", None, "other", "err")],
                                  "media_id string, file_name string, content binary, code string, error string")
    path = os.path.join(tmpdir_path, "media")
    write_media(media, path)
    write_media(media, path)
    assert sorted(rows(spark.read.parquet(path), "media_id", "file_name")) == [("m1", "a.mp3"), ("m2", "a.mp3")]


COLS = "deck_id long, line_no long, note_guid string, front_text string, back_text string, back_audio string, tags string"


def _notes(spark, *keys, text="b"):
    """Notes (deck_id, line_no, note_guid) with the same texts."""
    return spark.createDataFrame([(*k, "f", text, "", "t") for k in keys], COLS)


def test_an_unreadable_version_stops_an_upsert(spark, tmpdir_path):
    import pytest

    from deckforge.operators.sinks import upsert_decks, write_decks
    base = os.path.join(tmpdir_path, "decks")
    write_decks(_notes(spark, (1, 1, "g1"), (1, 2, "g2")), base)
    with open(os.path.join(base, "_commits", f"{2:020d}.json"), "w") as fh:
        fh.write('{"version": 2')
    with pytest.raises(Exception):
        upsert_decks(_notes(spark, (1, 1, "g1")), base)
    assert len(os.listdir(os.path.join(base, "data"))) == 1  # nothing was written


def test_no_success_marker_and_no_clock(spark, tmpdir_path):
    """Versions are numbered, so neither the committer's marker nor the time matters."""
    from deckforge.operators.sinks import has_decks, read_decks, upsert_decks, write_decks
    base = os.path.join(tmpdir_path, "decks")
    marker = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark._jsc.hadoopConfiguration()
    conf.set(marker, "false")
    try:
        assert not has_decks(spark, base)
        assert write_decks(_notes(spark, (1, 1, "a"), (1, 2, "b")), base) == 1
        assert has_decks(spark, base)
        assert upsert_decks(_notes(spark, (1, 3, "c")), base)[0] == 2
    finally:
        conf.unset(marker)
    assert sorted(rows(read_decks(spark, base), "note_guid")) == [("a",), ("b",), ("c",)]
    assert sorted(rows(read_decks(spark, base, 1), "note_guid")) == [("a",), ("b",)]


def test_a_commit_that_never_came_leaves_the_table(spark, tmpdir_path, monkeypatch):
    from deckforge.operators import sinks
    base = os.path.join(tmpdir_path, "decks")
    sinks.write_decks(_notes(spark, (1, 1, "a")), base)

    def dies(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(sinks, "make_commit", dies)
    for write in (sinks.write_decks, sinks.upsert_decks):
        try:
            write(_notes(spark, (1, 1, "a"), text="lost"), base)
        except KeyboardInterrupt:
            pass
    monkeypatch.undo()
    assert rows(sinks.read_decks(spark, base), "note_guid", "back_text") == [("a", "b")]
    assert sinks.upsert_decks(_notes(spark, (1, 2, "z")), base)[0] == 2
    assert sinks.read_decks(spark, base).count() == 2


def test_two_writers_at_once(spark, tmpdir_path, monkeypatch):
    """A commit that another writer makes first is seen: an upsert is planned again, a whole write is an error."""
    import pytest

    from deckforge.operators import sinks
    from deckforge.operators.commits import CommitConflict
    base = os.path.join(tmpdir_path, "decks")
    sinks.write_decks(_notes(spark, (1, 1, "a")), base)
    make, raced = sinks.make_commit, []

    def overtaken(sp, path, commit):
        if len(raced) < 1:
            raced.append(commit.version)
            monkeypatch.setattr(sinks, "make_commit", make)
            sinks.upsert_decks(_notes(spark, (2, 1, "b"), (1, 2, "c")), base)
        make(sp, path, commit)

    monkeypatch.setattr(sinks, "make_commit", overtaken)
    version, plan = sinks.upsert_decks(_notes(spark, (2, 1, "b", ), (3, 1, "d"), text="mine"), base)
    assert version == 3 and dict(rows(plan, "note_guid", "change")) == {"b": "changed", "d": "new"}
    assert sorted(rows(sinks.read_decks(spark, base), "note_guid", "back_text")) == [
        ("a", "b"), ("b", "mine"), ("c", "b"), ("d", "mine")]
    for write, options in ((sinks.write_decks, {}), (sinks.upsert_decks, {"tries": 1})):
        raced.clear()
        monkeypatch.setattr(sinks, "make_commit", overtaken)
        with pytest.raises(CommitConflict):
            write(_notes(spark, (9, 1, "z")), base, **options)
        assert sinks.read_decks(spark, base).where("deck_id = 9").count() == 0


def test_writers_in_threads(spark, tmpdir_path):
    from concurrent.futures import ThreadPoolExecutor

    from deckforge.operators.sinks import read_decks, upsert_decks
    base = os.path.join(tmpdir_path, "decks")
    tables = [_notes(spark, (n, 1, f"g{n}"), (0, n, f"shared{n}")) for n in range(1, 5)]
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda t: upsert_decks(t, base, tries=20)[0], tables))
    assert sorted(made) == [1, 2, 3, 4] and read_decks(spark, base).count() == 8


def test_an_upsert_rewrites_only_the_files_of_its_notes(spark, tmpdir_path):
    from deckforge.operators.commits import read_commit
    from deckforge.operators.sinks import read_decks, upsert_decks, write_decks
    notes = spark.range(400).selectExpr("id div 10 AS deck_id", "id AS line_no", "concat('g', id) AS note_guid",
                                        "'f' AS front_text", "'b' AS back_text", "'' AS back_audio", "'t' AS tags")
    base = os.path.join(tmpdir_path, "decks")
    write_decks(notes, base, notes_per_file=40)
    before = set(read_commit(spark, base).files)
    assert len(before) >= 8
    upsert_decks(_notes(spark, (7, 70, "g70"), (7, 500, "new"), text="again"), base, notes_per_file=40)
    after = set(read_commit(spark, base).files)
    gone, made = before - after, after - before
    assert len(gone) == 1 and len(made) <= 2  # the one file that holds g70
    assert all(f.low <= 7 <= f.high for f in gone) and sum(f.rows for f in after) == 401
    upsert_decks(_notes(spark, (99, 1, "only new")), base)
    assert after - set(read_commit(spark, base).files) == set()  # nothing replaced, nothing rewritten
    assert read_decks(spark, base).count() == 402
    assert rows(read_decks(spark, base).where("note_guid = 'g70'"), "back_text") == [("again",)]


def test_a_batch_counts_once(spark, tmpdir_path):
    from deckforge.operators.sinks import read_decks, upsert_decks
    base = os.path.join(tmpdir_path, "decks")
    for number, text in ((0, "first"), (1, "second"), (1, "replayed"), (0, "late")):
        upsert_decks(_notes(spark, (1, 1, "a"), text=text), base, batch=("s", number))
    upsert_decks(_notes(spark, (1, 2, "b")), base, batch=("other", 0))
    assert sorted(rows(read_decks(spark, base), "note_guid", "back_text")) == [("a", "second"), ("b", "b")]


def test_notes_without_a_deck_or_key(spark, tmpdir_path):
    from deckforge.operators.sinks import read_decks, upsert_decks
    base = os.path.join(tmpdir_path, "decks")
    upsert_decks(_notes(spark, (None, 1, "a"), (1, 1, None)), base)
    upsert_decks(_notes(spark, (None, 1, "a"), (1, 1, None), text="again"), base)
    assert sorted(rows(read_decks(spark, base), "deck_id", "note_guid", "back_text"), key=str) == [
        (1, None, "again"), (None, "a", "again")]
    upsert_decks(_notes(spark), base)
    assert read_decks(spark, base).count() == 2


def test_files_follow_the_notes_not_the_decks(spark, tmpdir_path):
    from deckforge.operators.commits import read_commit
    from deckforge.operators.sinks import read_decks, write_decks
    hot = spark.range(900).selectExpr("0L AS deck_id", "id AS line_no")
    many = spark.range(300).selectExpr("id + 1 AS deck_id", "1L AS line_no")
    base = os.path.join(tmpdir_path, "decks")
    write_decks(hot.unionByName(many), base, notes_per_file=100)
    assert 4 <= len(read_commit(spark, base).files) <= 12
    assert read_decks(spark, base).count() == 1200
    sizes = read_decks(spark, base).filter("deck_id = 0").groupBy(F.input_file_name()).count().collect()
    assert len(sizes) > 3  # the hot deck isn't one task's


def test_names_for_many_decks_on_one_path(spark, monkeypatch):
    from deckforge.operators import sinks
    monkeypatch.setattr(sinks, "CANDIDATE_RUN", 7)
    got = _names(spark, [(i, "d.apkg", False) for i in range(40)], ["d.apkg", "d_3.apkg"])
    free = [n for n in range(1, 60) if n != 3][:40]
    assert got == {i: f"d_{n}.apkg" for i, n in enumerate(free)}


def test_deck_table(spark):
    from deckforge.operators.sinks import deck_table
    configs = spark.createDataFrame([(1, "Trip", "French", "A2", True), (2, "Trip", "Dutch", "B1", True),
                                     (3, "x", "y", "z", False)],
                                    "deck_id long, deck_name string, target_language string, cefr_level string, "
                                    "valid boolean")
    names = spark.createDataFrame([(1, "a"), (2, "b")], "deck_id long, output_name string")
    got = {r.deck_id: r for r in deck_table(configs, names).collect()}
    assert set(got) == {1, 2} and got[1].deck_int_id == got[2].deck_int_id != got[1].model_int_id
    assert got[2].tags == ["lang::dutch", "level::b1"] and got[2].output_name == "b"


def test_blacklist_hits(spark):
    from deckforge.operators.quality import blacklist_hits
    cards = validated_cards(spark, [card_json(), card_json(examples=[
        {"target": "Huele a pan, PAN y más pan.", "origin": "x"}, {"target": "Nada.", "origin": "y"}])])
    bl = spark.createDataFrame([(1, "pan"), (1, "El Pan sale"), (1, "pan y más"), (1, "!!"), (1, "más pan y"),
                                (2, "nada")], "deck_id long, entry string")
    got = rows(blacklist_hits(cards, bl), "line_no", "location", "position", "entry")
    ours = sorted(g for g in got if g[1].startswith("examples"))
    assert ours == [(1, "examples[0].target", 0, "El Pan sale"), (1, "examples[0].target", 1, "pan"),
                    (1, "examples[1].target", 1, "pan"), (2, "examples[0].target", 2, "pan"),
                    (2, "examples[0].target", 3, "pan"), (2, "examples[0].target", 3, "pan y más"),
                    (2, "examples[0].target", 6, "pan")]


def test_repeated_terms_and_content_rules(spark):
    from deckforge.operators.quality import content_rules, level_length, repeated_terms
    wordy = " ".join(["word"] * 11)
    card = card_json(word_family=[entry("Pan", "bread", "x"), entry("panal", "comb", "y")],
                     related_vocab=[entry("PANAL", "<b>comb</b>", "z", wordy)],
                     examples=[{"target": "Sin nada hoy.", "origin": "o"}, {"target": "Un pan de maíz dulce.", "origin": "o"}])
    cards = validated_cards(spark, [card]).withColumn("minimal_cards", F.lit(False))
    assert sorted(rows(repeated_terms(cards), "term", "rule")) == [("pan", "is_core"), ("panal", "repeated")]
    found = set(rows(content_rules(cards), "rule", "location"))
    assert found == {("core_missing", "examples[0].target"), ("markup", "related_vocab[0].translation"),
                     ("section_size", "word_family"), ("section_size", "related_vocab"),
                     ("long_nuance", "related_vocab[0].nuance")}
    decks = spark.createDataFrame([(1, "A2")], "deck_id long, cefr_level string")
    assert rows(level_length(cards, decks).orderBy("example_no"), "n_words", "in_range") == [(3, False), (5, True)]


def test_single_deck_read_skips_files_by_statistics(spark, tmpdir_path):
    from deckforge.operators.sinks import read_decks, write_decks
    notes = spark.range(600).selectExpr("id % 60 AS deck_id", "id AS line_no")
    base = os.path.join(tmpdir_path, "decks")
    write_decks(notes, base, notes_per_file=50)
    one = read_decks(spark, base).filter("deck_id = 2")
    assert "PushedFilters: [IsNotNull(deck_id), EqualTo(deck_id,2)]" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 10 and one.select(F.input_file_name()).distinct().count() == 1


def test_upsert_decks(spark, tmpdir_path):
    from deckforge.operators.sinks import read_decks, upsert_decks
    cols = "deck_id long, line_no long, note_guid string, front_text string, back_text string, " \
           "back_audio string, tags string"
    base = os.path.join(tmpdir_path, "decks")
    first = spark.createDataFrame([(1, 1, "a", "f", "b", "", "t"), (1, 2, "b", "f", "b", "", "t"),
                                   (2, 1, "c", "f", "b", "", "t")], cols)
    upsert_decks(first.unionByName(first.withColumn("line_no", F.col("line_no") + 50)), base)
    assert read_decks(spark, base).count() == 3  # repeated keys go on the first write too
    second = spark.createDataFrame([(1, 1, "a", "f", "NEW", "", "t"), (1, 3, "d", "f", "b", "", "t"),
                                    (1, 4, "d", "f", "b", "", "t")], cols)
    _, plan = upsert_decks(second, base)
    assert dict(rows(plan, "line_no", "change")) == {1: "changed", 3: "new", 4: "duplicate"}
    got = sorted(rows(read_decks(spark, base), "deck_id", "note_guid", "back_text"))
    assert got == [(1, "a", "NEW"), (1, "b", "b"), (1, "d", "b"), (2, "c", "b")]


def test_quality_report_combines_rules(spark):
    from deckforge.operators.quality import quality_report
    card = card_json(word_family=[entry("Pan", "bread", "x")],
                     examples=[{"target": "Sin nada hoy.", "origin": "o"}, {"target": "Un pan de maíz dulce.", "origin": "o"}])
    cards = validated_cards(spark, [card]).withColumn("minimal_cards", F.lit(False))
    decks = spark.createDataFrame([(1, "A2")], "deck_id long, cefr_level string")
    bl = spark.createDataFrame([(1, "nada")], "deck_id long, entry string")
    got = set(rows(quality_report(cards, decks, bl), "rule", "location", "detail"))
    assert ("sentence_length", "examples[0].target", "3") in got
    assert ("term_is_core", None, "pan") in got
    assert ("blacklisted", "examples[0].target", "nada") in got
    assert ("core_missing", "examples[0].target", None) in got


def test_write_decks_as_json(spark, tmpdir_path):
    from deckforge.operators.sinks import read_decks, write_decks
    notes = spark.createDataFrame([(1, 1, "g", "<b>x</b>")], "deck_id long, line_no long, note_guid string, "
                                                            "front_text string")
    base = os.path.join(tmpdir_path, "json_decks")
    write_decks(notes, base, fmt="json")
    back = read_decks(spark, base)
    assert rows(back, "deck_id", "line_no", "note_guid", "front_text") == [(1, 1, "g", "<b>x</b>")]
