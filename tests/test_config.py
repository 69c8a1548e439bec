from helpers import rows

BASE = dict(origin_language="Spanish", target_language="French", notes_language="English", cefr_level="A2")


def _check(spark, **changes):
    from deckforge.operators.config import validate_configs
    from deckforge.schemas import RAW_CONFIG
    row = {f.name: None for f in RAW_CONFIG.fields}
    row.update(BASE, deck_id=1)
    row.update(changes)
    df = spark.createDataFrame([tuple(row[f.name] for f in RAW_CONFIG.fields)], RAW_CONFIG)
    return validate_configs(df).first()


def _codes(r):
    return [(e.field, e.code) for e in r.errors]


def test_valid_defaults_and_warnings(spark):
    r = _check(spark)
    assert r.valid and r.text_model == "gpt-4.1-mini" and r.audio_voice == "alloy"
    assert r.generate_audio is True and r.minimal_cards is False and r.overwrite_output is False
    assert r.defaulted == ["text_model", "audio_model", "audio_voice", "deck_name", "input_path", "output_path"]
    r2 = _check(spark, text_model="gpt-x", deck_name="")
    assert "text_model" not in r2.defaulted and "deck_name" in r2.defaulted


def test_language_collisions(spark):
    assert _codes(_check(spark, target_language="  spanish  ")) == [("target_language", "same_as_origin")]
    assert _codes(_check(spark, target_language="ENGLISH")) == [("target_language", "same_as_notes")]
    assert _check(spark, origin_language="English", notes_language="English").valid
    assert _codes(_check(spark, target_language="STRASSE", origin_language="straße")) == \
        [("target_language", "same_as_origin")]


def test_levels_and_efforts(spark):
    assert _check(spark, cefr_level="c2").cefr_level == "C2"
    assert _check(spark, cefr_level=" b1 ").cefr_level == "B1"
    for bad in ["Z9", " d67 "]:
        r = _check(spark, cefr_level=bad)
        assert _codes(r) == [("cefr_level", "invalid")] and r.errors[0].value == bad
    assert _check(spark, reasoning_effort="HIGH").reasoning_effort == "high"
    assert _check(spark, reasoning_effort=" medium ").reasoning_effort == "medium"
    assert _check(spark, reasoning_effort="  ").reasoning_effort is None
    assert _codes(_check(spark, reasoning_effort="turbo")) == [("reasoning_effort", "invalid")]


def test_blank_missing_and_booleans(spark):
    r = _check(spark, target_language="   ")
    assert _codes(r) == [("target_language", "blank")] and r.errors[0].value == "   "
    r = _check(spark, target_language=None)
    assert _codes(r) == [("target_language", "missing")] and r.errors[0].value is None
    for v, want in [("on", True), ("OFF", False), ("y", True), ("0", False), ("Yes", True)]:
        assert _check(spark, minimal_cards=v).minimal_cards is want
    assert _codes(_check(spark, minimal_cards="maybe")) == [("minimal_cards", "invalid")]


def test_config_errors_rollup(spark):
    from deckforge.operators.config import config_errors, validate_configs
    from deckforge.plans.fixtures import v_config
    from helpers import SF01
    errs = config_errors(validate_configs(v_config(spark, SF01)))
    assert errs.count() > 0
    assert set(rows(errs.select("code").distinct(), "code")) <= {
        ("missing",), ("blank",), ("invalid",), ("same_as_origin",), ("same_as_notes",)}


def test_deck_settings_are_cached_in_even_blocks(spark, tmpdir_path):
    from pyspark.sql import functions as F
    from deckforge.operators.config import validate_configs
    from deckforge.plans import fixtures as fx
    from deckforge.plans.queries import checked_configs
    tables = {
        "customer": spark.range(120_001).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name",
                                                    "CAST(id % 2 AS INT) AS c_nationkey"),
        "nation": spark.range(2).selectExpr("CAST(id AS INT) AS n_nationkey", "concat('NATION ', id) AS n_name",
                                            "0 AS n_regionkey"),
        "region": spark.range(1).selectExpr("0 AS r_regionkey", "'ASIA' AS r_name"),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmpdir_path}/{name}.parquet")
    decks = checked_configs(spark, tmpdir_path)
    try:
        sizes = decks.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
        assert sizes[0] <= 50_000 and sizes[1] == 120_001
        plain = validate_configs(fx.v_config(spark, tmpdir_path).filter("deck_id % 50 = 7"))
        found = decks.filter("deck_id % 50 = 7").collect()
        key = lambda r: r.deck_id
        assert sorted(found, key=key) == sorted(plain.collect(), key=key)
    finally:
        decks.unpersist()
