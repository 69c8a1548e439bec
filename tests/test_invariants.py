"""Invariants over the driver's smallest tables (sf0.001)."""

from pyspark.sql import functions as F

from helpers import SF001, rows


def test_accepted_plus_rejected_is_input(spark):
    from deckforge.plans import fixtures as fx
    from deckforge.operators.validate import validate_cards
    resp = fx.received(fx.v_responses(spark, SF001))
    checked = validate_cards(resp)
    assert checked.count() == resp.count()
    assert checked.filter("valid").count() + checked.filter("NOT valid").count() == resp.count()
    assert checked.filter("valid AND card IS NULL").count() == 0


def test_audio_jobs_count_and_gather_roundtrip(spark):
    from deckforge.operators.audio import audio_jobs
    from deckforge.operators.numbering import ordered_gather
    from deckforge.plans import fixtures as fx
    cards = fx.v_cards(spark, SF001)
    jobs = audio_jobs(cards)
    assert jobs.count() == cards.select(F.sum(F.size("card.examples"))).first()[0]
    back = ordered_gather(jobs, ["deck_id", "line_no"], "example_no", "text", "texts")
    want = cards.select("deck_id", "line_no", F.expr(
        "transform(card.examples, e -> btrim(e.target, ' '))").alias("texts"))
    assert sorted(rows(back)) == sorted(rows(want.filter(F.size("texts") > 0)))


def test_results_independent_of_partition_count(spark):
    import __spark_entry__ as entry
    qs = entry.queries()
    for name in ["active_lines", "output_names", "blacklist_hits", "deck_upsert"]:
        got = []
        for parts in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got.append(sorted(map(str, rows(qs[name](spark, SF001)))))
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert got[0] == got[1], name


def test_deck_side_joins_are_broadcast(spark):
    import __spark_entry__ as entry
    df = entry.queries()["render_notes"](spark, SF001)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    # the dictionary of slugs is no deck-level side: it grows with the different non-ASCII sources
    assert "BroadcastHashJoin" in plan and all("_slugged" in line for line in shuffled)


def test_results_independent_of_ansi_mode(spark):
    import __spark_entry__ as entry
    qs = entry.queries()
    names = ["accepted_cards", "reject_details", "render_notes", "valid_configs", "config_errors",
             "content_rules", "instructions", "output_names"]
    before = spark.conf.get("spark.sql.ansi.enabled")
    got = {}
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            spark.catalog.clearCache()
            got[mode] = {n: sorted(map(str, rows(qs[n](spark, SF001)))) for n in names}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
        spark.catalog.clearCache()
    for n in names:
        assert got["true"][n] == got["false"][n], n
