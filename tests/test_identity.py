import hashlib

from pyspark.sql import functions as F


def test_stable_int_id_matches_python(spark):
    from deckforge.functions.identity import stable_int_id
    values = ["deck", "Spanish deck", "ünïcode", ""]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(stable_int_id(F.col("v"), "ns:")).collect()]
    assert got == [int(hashlib.sha1(("ns:" + v).encode()).hexdigest()[:15], 16) for v in values]
    assert all(0 <= g < 2 ** 63 for g in got)


SLUGS = {
    "\t Swiss -- German\u00a0(Bern) ": "swiss-german-bern", "ﬁnnish ½": "finnish-1-2", "GROẞ & klein": "gross-klein",
    "हिन्दी": "ह-न-द", "ภาษาไทย": "ภาษาไทย", "C1": "c1", "-x-": "x", "Ⅷ": "viii", "a_b": "a-b", "\x1cZulu\x1f": "zulu",
    "§§": "tag-" + hashlib.sha1("§§".encode()).hexdigest()[:8], "+-+": "tag-" + hashlib.sha1(b"+-+").hexdigest()[:8],
    " ": "tag-" + hashlib.sha1(b" ").hexdigest()[:8], "": "tag-" + hashlib.sha1(b"").hexdigest()[:8]}


def test_slugs_by_either_way(spark):
    """The Python function on every value, and the one that sends only different non-ASCII values to it."""
    from deckforge.functions.identity import _slug_one, slug, with_slug
    assert {v: _slug_one(v) for v in SLUGS} == SLUGS
    df = spark.createDataFrame([(v,) for v in [*SLUGS, None, *SLUGS]], "v string")
    assert [tuple(r) for r in df.select("v", slug(F.col("v"))).collect()] == [
        (v, SLUGS.get(v)) for v in [*SLUGS, None, *SLUGS]]
    got = with_slug(df, F.col("v"), "s")
    assert sorted(((r.v, r.s) for r in got.collect()), key=str) == sorted(
        ((v, SLUGS.get(v)) for v in [*SLUGS, None, *SLUGS]), key=str)


def test_ascii_slugs_match_python(spark):
    import random

    from deckforge.functions.identity import _slug_one, ascii_slug
    rng = random.Random(4)
    values = ["".join(chr(rng.randrange(128)) for _ in range(rng.randrange(9))) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert all(r.s == _slug_one(r.v) for r in df.select("v", ascii_slug(F.col("v")).alias("s")).collect())


def test_only_different_values_reach_python(spark):
    """The UDF's input is the distinct non-ASCII values."""
    from deckforge.functions.identity import with_slug
    df = spark.createDataFrame([("é",)] * 50 + [("plain",)] * 50 + [("ü",)] * 20, "v string")
    plan = with_slug(df, F.col("v"), "s")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("ArrowEvalPython"):]
    assert "Aggregate" in below.split("\n")[1] and plan.count("ArrowEvalPython") == 1


def test_deck_tags(spark):
    from deckforge.operators.config import with_deck_tags
    df = spark.createDataFrame([(1, "Swiss -- German", "B1"), (2, "ภาษาไทย", "C2")],
                               "deck_id long, target_language string, cefr_level string")
    got = {r.deck_id: r.tags for r in with_deck_tags(df).collect()}
    assert got == {1: ["lang::swiss-german", "level::b1"], 2: ["lang::ภาษาไทย", "level::c2"]}


def test_note_key_and_media_name(spark):
    from deckforge.functions.identity import media_name_sql, note_key_sql
    df = spark.createDataFrame([("run", "to run", "correr", "Corro cada mañana.")],
                               "source string, oc string, tc string, target string")
    r = df.select(
        F.expr(note_key_sql("source", "oc", "tc")).alias("k1"),
        F.expr(note_key_sql("source", "oc", "tc")).alias("k2"),
        F.expr(note_key_sql("source", "oc", "tc", "deck-note-v2")).alias("k3"),
        F.expr(media_name_sql("'run'", "source", "tc", "1", "target")).alias("m1"),
        F.expr(media_name_sql("'run'", "source", "tc", "2", "target")).alias("m2")).first()
    assert r.k1 == r.k2 and r.k1 != r.k3
    digest = hashlib.sha1("run\ncorrer\n1\nCorro cada mañana.".encode()).hexdigest()[:16]
    assert r.m1 == f"deckforge-run-1-{digest}.mp3"
    assert r.m2.startswith("deckforge-run-2-") and r.m2.endswith(".mp3")
