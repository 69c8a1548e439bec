import os

from deckforge.operators.sinks import read_decks
from helpers import rows


def test_run_decks_end_to_end(spark, tmpdir_path):
    from deckforge.plans.stubs import stub_card_fn, stub_speech_fn
    from deckforge.run import run_decks
    from deckforge.schemas import RAW_CONFIG
    from deckforge.sources.lines import read_lines
    custom = os.path.join(tmpdir_path, "custom.txt")
    with open(custom, "w") as fh:
        fh.write("IPA beside each core\n# later\n")
    big = os.path.join(tmpdir_path, "big.txt")
    with open(big, "w") as fh:
        fh.write("x" * 9000)

    def cfg(deck_id, **kw):
        row = {f.name: None for f in RAW_CONFIG.fields}
        row.update(deck_id=deck_id, origin_language="Spanish", target_language="French",
                   notes_language="English", cefr_level="A2", customization_path=custom,
                   blacklist_path=os.path.join(tmpdir_path, "none.txt"))
        row.update(kw)
        return tuple(row[f.name] for f in RAW_CONFIG.fields)

    configs = spark.createDataFrame([cfg(1), cfg(2, generate_audio="off", minimal_cards="yes"),
                                     cfg(3, cefr_level="Z9"), cfg(4, customization_path=big), cfg(5)], RAW_CONFIG)
    texts = spark.createDataFrame([(1, "moon\n\n# not yet\nhigh tide\nmoon\n"), (2, "lune\n"), (3, "x\n"),
                                   (4, "y\n"), (5, "# nothing\n")], "deck_id long, text string")
    lines = read_lines(texts, ["deck_id"], "text")
    run = run_decks(lines, configs, stub_card_fn, stub_speech_fn, os.path.join(tmpdir_path, "out"),
                    max_parallel=2)
    s = {r.deck_id: r for r in run.summary.collect()}
    assert s[1].n_items == 3 and s[1].n_accepted == 3 and s[1].n_audio_jobs == 6
    assert s[2].n_accepted == 1 and s[2].n_audio_jobs == 0 and s[2].n_note_items == 0
    assert s[3].valid == "false" and s[3].n_accepted == 0
    assert s[4].n_accepted == 0 and s[4].side_file == "customization: too_large" and s[1].side_file is None
    assert {r.deck_id for r in run.decks.collect()} == {1, 2, 5}
    assert rows(run.empty_sources, "deck_id") == [(5,)]
    notes = read_decks(spark, run.notes_path)
    assert notes.count() == 4
    d1 = notes.filter("deck_id = 1").orderBy("line_no").collect()
    assert d1[0].note_guid == d1[2].note_guid  # same input line, same key
    assert d1[0].back_audio.startswith("[sound:deckforge-moon-1-")
    assert d1[0].tags == ["lang::french", "level::a2"]
    assert spark.read.parquet(run.media_path).count() == 4  # the repeated line shares files
    assert {r.kind: r.outcome for r in run.side_files.filter("deck_id = 1").collect()} == \
        {"customization": "ok", "blacklist": "not_found"}
    assert run.quality.columns == ["deck_id", "line_no", "rule", "location", "detail"]
    assert {r.rule for r in run.quality.collect()} >= {"sentence_length"}


def test_rerun_calls_only_for_missing_answers_and_media(spark, tmpdir_path):
    from deckforge.plans.stubs import stub_card_fn, stub_speech_fn
    from deckforge.run import run_decks
    from deckforge.schemas import RAW_CONFIG
    from deckforge.sources.lines import read_lines
    row = {f.name: None for f in RAW_CONFIG.fields}
    row.update(deck_id=1, origin_language="Spanish", target_language="French", notes_language="English",
               cefr_level="A2")
    configs = spark.createDataFrame([tuple(row[f.name] for f in RAW_CONFIG.fields)], RAW_CONFIG)
    lines = read_lines(spark.createDataFrame([(1, "moon\ntide\n")], "deck_id long, text string"), ["deck_id"], "text")
    out = os.path.join(tmpdir_path, "out")
    run_decks(lines, configs, stub_card_fn, stub_speech_fn, out, max_parallel=2, read_side=False)

    def no_speech():
        def fail(text, model, voice):
            raise RuntimeError("speech must not be called again")
        return fail

    def no_cards():
        def fail(payload):
            raise RuntimeError("the model must not be called again")
        return fail

    second = run_decks(lines, configs, no_cards, no_speech, out, max_parallel=2, read_side=False)
    assert {r.deck_id: r.n_accepted for r in second.summary.collect()} == {1: 2}
    notes = read_decks(spark, second.notes_path).orderBy("line_no").collect()
    assert all(n.back_audio.count("[sound:") == 2 for n in notes)
    assert spark.read.parquet(os.path.join(out, "media")).count() == 4


def test_rejected_and_failed_answers_are_asked_again(spark, tmpdir_path):
    from deckforge.plans.stubs import stub_card_fn, stub_speech_fn
    from deckforge.run import run_decks
    from deckforge.schemas import RAW_CONFIG
    from deckforge.sources.lines import read_lines
    row = {f.name: None for f in RAW_CONFIG.fields}
    row.update(deck_id=1, origin_language="Spanish", target_language="French", notes_language="English",
               cefr_level="A2", generate_audio="no")
    configs = spark.createDataFrame([tuple(row[f.name] for f in RAW_CONFIG.fields)], RAW_CONFIG)
    lines = read_lines(spark.createDataFrame([(1, "moon\ntide\nsalt\n")], "deck_id long, text string"),
                       ["deck_id"], "text")
    out = os.path.join(tmpdir_path, "out")

    def flaky():
        answer = stub_card_fn()

        def fn(payload):
            if "tide" in payload:
                return "null"
            if "salt" in payload:
                raise RuntimeError("down")
            return answer(payload)
        return fn

    first = run_decks(lines, configs, flaky, stub_speech_fn, out, read_side=False)
    s = first.summary.first()
    assert (s.n_accepted, s.n_rejected, s.n_unanswered, s.n_call_errors) == (1, 1, 1, 1)
    assert [(r.line_no, r.code) for r in first.call_errors.collect()] == [(3, "other")]
    asked = os.path.join(tmpdir_path, "asked")
    os.mkdir(asked)

    def counting():
        answer = stub_card_fn()

        def fn(payload):
            open(os.path.join(asked, os.urandom(8).hex()), "w").close()
            return answer(payload)
        return fn

    second = run_decks(lines, configs, counting, stub_speech_fn, out, read_side=False, update=True)
    s = second.summary.first()
    assert (s.n_accepted, s.n_rejected, s.n_unanswered, s.n_call_errors) == (3, 0, 0, 0)
    assert len(os.listdir(asked)) == 2
    assert read_decks(spark, second.notes_path).count() == 3


def test_a_run_after_a_first_wave_that_failed(spark, tmpdir_path):
    """A client that can't be made (a wrong key) stops the run; the next run with a good one simply goes on."""
    import pytest

    from deckforge.plans.stubs import stub_card_fn, stub_speech_fn
    from deckforge.run import run_decks
    from deckforge.schemas import RAW_CONFIG
    from deckforge.sources.lines import read_lines
    row = {f.name: None for f in RAW_CONFIG.fields}
    row.update(deck_id=1, origin_language="Spanish", target_language="French", notes_language="English",
               cefr_level="A2")
    configs = spark.createDataFrame([tuple(row[f.name] for f in RAW_CONFIG.fields)], RAW_CONFIG)
    lines = read_lines(spark.createDataFrame([(1, "moon\ntide\n")], "deck_id long, text string"), ["deck_id"], "text")
    out = os.path.join(tmpdir_path, "out")

    def no_key():
        raise PermissionError("wrong key")

    for cards, speech in ((no_key, stub_speech_fn), (no_key, stub_speech_fn), (stub_card_fn, no_key)):
        with pytest.raises(Exception, match="wrong key"):
            run_decks(lines, configs, cards, speech, out, max_parallel=2, read_side=False)
    run = run_decks(lines, configs, stub_card_fn, stub_speech_fn, out, max_parallel=2, read_side=False)
    assert run.summary.first().n_accepted == 2 and run.notes_version == 1
    assert read_decks(spark, run.notes_path).count() == 2
    assert spark.read.parquet(run.media_path).count() == 4
