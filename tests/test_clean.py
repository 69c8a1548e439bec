import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import rows


def _lines(spark, texts):
    from deckforge.sources.lines import read_lines
    df = spark.createDataFrame(list(enumerate(texts)), "source_id long, text string")
    return read_lines(df, ["source_id"], "text")


def test_active_lines_filters_and_numbers(spark):
    from deckforge.operators.clean import active_lines
    texts = ["moon\n\n# later\nhigh tide\n", "\t one # two \n#\n   #three\n\n four", "again\nagain\n"]
    out = active_lines(_lines(spark, texts), ["source_id"]).orderBy("source_id", "line_no")
    assert rows(out, "source_id", "line_no", "item") == [
        (0, 1, "moon"), (0, 2, "high tide"), (1, 1, "one # two"), (1, 2, "four"), (2, 1, "again"), (2, 2, "again")]


def test_in_row_numbering_matches_table_path(spark):
    from deckforge.operators.clean import active_lines
    from deckforge.sources.lines import active_text_lines
    texts = ["x\r\ny\x1cz\n\n#c\n w ", " a b", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "source_id long, text string")
    a = sorted(rows(active_text_lines(df, ["source_id"], "text")))
    b = sorted(rows(active_lines(_lines(spark, texts), ["source_id"]).select("source_id", "line_no", "item")))
    assert a == b
    expected = [(i, n + 1, s.strip()) for i, t in enumerate(texts)
                for n, s in enumerate([x for x in t.splitlines() if x.strip() and not x.strip().startswith("#")])]
    assert a == sorted(expected)


def test_number_rows_equals_row_number_with_hot_key(spark):
    from deckforge.operators.numbering import number_rows
    random.seed(1)
    data = [(0 if random.random() < 0.4 else random.randint(1, 20), i * 3 + random.randint(0, 2))
            for i in range(3000)]
    df = spark.createDataFrame(data, "k long, pos long")
    ours = number_rows(df, ["k"], "pos", "n", bucket_width=64)
    ref = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("pos")))
    assert sorted(rows(ours, "k", "pos", "n")) == sorted(rows(ref, "k", "pos", "n"))


def test_number_rows_independent_of_partitions(spark):
    from deckforge.operators.numbering import number_rows
    df = spark.range(500).selectExpr("id % 3 AS k", "id AS pos")
    results = []
    for parts in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        results.append(sorted(rows(number_rows(df, ["k"], "pos", "n", bucket_width=7))))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_empty_sources(spark):
    from deckforge.operators.clean import empty_sources
    lines = _lines(spark, ["# only\n  \n", "x\n", "#a\n"])
    got = sorted(r[0] for r in empty_sources(lines, ["source_id"]).collect())
    assert got == [0, 2]
    expected = spark.createDataFrame([(0,), (1,), (2,), (9,)], "source_id long")
    got2 = sorted(r[0] for r in empty_sources(lines, ["source_id"], expected=expected).collect())
    assert got2 == [0, 2, 9]


def test_split_item(spark):
    from deckforge.operators.clean import split_item
    cases = {"lantern (glass, wick ,oil)": ("lantern", ["glass", "wick", "oil"]), "moth": ("moth", []),
             "por si acaso (¿y tú?)": ("por si acaso", ["¿y tú?"]), "(bare)": ("(bare)", ["bare"]),
             "open (one, ,two": ("open", ["one", "two"]), "void ()": ("void", [])}
    df = spark.createDataFrame([(c,) for c in cases], "item string")
    assert {r.item: (r.core, r.optional_vocab) for r in split_item(df).collect()} == cases


def test_number_rows_keeps_null_keys_and_positions(spark):
    from deckforge.operators.numbering import number_rows
    df = spark.createDataFrame([(None, 5), (None, None), (1, None), (1, 2), (1, 1)], "k long, pos long")
    ours = number_rows(df, ["k"], "pos", "n", bucket_width=4)
    ref = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("pos")))
    assert sorted(map(str, rows(ours, "k", "pos", "n"))) == sorted(map(str, rows(ref, "k", "pos", "n")))


def test_numbering_window_is_bucketed(spark):
    from deckforge.operators.clean import active_lines
    from deckforge.plans.fixtures import v_items
    from helpers import SF001
    df = active_lines(v_items(spark, SF001), ["deck_id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "row_number()" in plan and "_nr_bucket" in plan
    for line in plan.splitlines():
        if "row_number()" in line:
            assert "_nr_bucket" in line.split("windowspecdefinition(")[1].split(",")[1]


def test_hot_key_is_spread_over_partitions(spark):
    """One key with 40% of the rows: a plain window puts all of it in one task,
    number_rows spreads it over many."""
    from deckforge.operators.numbering import number_rows
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = 40000
        df = spark.range(n).selectExpr("CASE WHEN id % 5 < 2 THEN 0 ELSE id % 997 + 1 END AS k", "id AS pos")
        ours = number_rows(df, ["k"], "pos", "n", bucket_width=256)
        naive = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("pos")))

        def biggest_share(d):
            sizes = d.filter("k = 0 AND n > 0").groupBy(F.spark_partition_id().alias("p")).count().collect()
            return max(r["count"] for r in sizes) / (2 * n / 5)

        assert biggest_share(naive) == 1.0
        assert biggest_share(ours) < 0.3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_require_active_sources(spark):
    import pytest

    from deckforge.operators.clean import empty_sources, require_active_sources
    lines = _lines(spark, ["# only\n", "x\n"])
    with pytest.raises(ValueError, match="1 source"):
        require_active_sources(empty_sources(lines, ["source_id"]), ["source_id"])
    require_active_sources(empty_sources(_lines(spark, ["x\n"]), ["source_id"]), ["source_id"])


def test_with_progress_and_input_order(spark):
    from deckforge.operators.numbering import in_input_order, with_progress
    df = spark.createDataFrame([(1, 3, 1), (1, 1, 2), (1, 1, 1), (2, 5, 1), (None, 1, 1)],
                               "deck_id long, line_no long, example_no long")
    got = sorted(map(str, rows(with_progress(df, ["deck_id"], ["line_no", "example_no"]),
                               "deck_id", "line_no", "example_no", "progress")))
    assert got == sorted(map(str, [(1, 1, 1, "1/3"), (1, 1, 2, "2/3"), (1, 3, 1, "3/3"), (2, 5, 1, "1/1"),
                                   (None, 1, 1, "1/1")]))
    ordered = in_input_order(df.filter("deck_id IS NOT NULL").select("deck_id", "line_no", "example_no"),
                             ["deck_id", "line_no", "example_no"], global_sort=True)
    assert rows(ordered) == [(1, 1, 1), (1, 1, 2), (1, 3, 1), (2, 5, 1)]


def test_numbering_shuffles_the_rows_once(spark):
    """With broadcast off: the rows are exchanged once, for the join and the window alike."""
    from deckforge.operators.numbering import number_rows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(1000).selectExpr("id % 7 AS k", "id AS pos", "concat('text ', id) AS body")
        plan = number_rows(df, ["k"], "pos", "n")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    window = plan.index("row_number()")
    rows_side = plan[window:plan.index("body", plan.index("Exchange", window))]
    assert rows_side.count("Exchange hashpartitioning(_nr_k0") == 1
    assert plan.count("Exchange hashpartitioning") <= 4  # the rows, and three of the small count table
