import random

import pytest

from helpers import rows


def _one(spark, expr_col, value):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(expr_col.alias("y")).first()["y"]


@pytest.mark.parametrize("value,expected", [
    ("el perro", "El perro"), (" le chien", "Le chien"), ("¿que tal?", "¿Que tal?"), ("123", "123"),
    ("3 dogs. and cats! yes? no", "3 Dogs. And cats! Yes? No"), ("ß", "SS"), ("", ""),
])
def test_capitalize_sentences(spark, value, expected):
    from deckforge.functions.text import capitalize_sentences
    assert _one(spark, capitalize_sentences("x"), value) == expected


def _py_capitalize(value):
    out, cap = [], True
    for ch in value.strip():
        if ch.isalpha() and cap:
            out.append(ch.upper())
            cap = False
        else:
            if ch in ".!?":
                cap = True
            elif ch.isalpha():
                cap = False
            out.append(ch)
    return "".join(out)


def test_capitalize_matches_python_on_random_text(spark):
    from deckforge.functions.text import capitalize_sentences
    random.seed(7)
    alphabet = "ab éçß.!?¿ 1\n\t"
    values = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 20))) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(capitalize_sentences("x")).collect()]
    assert got == [_py_capitalize(v) for v in values]


def test_capitals_of_every_character(spark):
    """No difference from Python over all code points, at the start and after other characters."""
    import sys

    from deckforge.functions.text import capitalize_sentences
    points = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    forms = ["{}x", "1 {}\u0101. ¿{}y"]
    bad = []
    for form in forms:
        for at in range(0, len(points), 400_000):
            values = [(form.replace("{}", chr(c)),) for c in points[at:at + 400_000]]
            df = spark.createDataFrame(values, "x string").select("x", capitalize_sentences("x").alias("y"))
            bad += [(r.x, r.y) for r in df.collect() if r.y != _py_capitalize(r.x)]
    assert not bad, (len(bad), bad[:5])
    plan = spark.range(1).select(capitalize_sentences("string(id)"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_escape_html(spark):
    from deckforge.functions.text import escape_html
    assert _one(spark, escape_html("x"), "Use <le>, not la.") == "Use &lt;le&gt;, not la."
    assert _one(spark, escape_html("x"), "avoid & replace") == "avoid &amp; replace"
    assert _one(spark, escape_html("x"), "\"'") == "&quot;&#x27;"


def test_strip_and_splitlines_match_python(spark):
    from pyspark.sql import functions as F

    from deckforge.functions.text import py_strip, split_lines
    random.seed(3)
    alphabet = "ab \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0  　#"
    values = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = rows(df.select(py_strip("x").alias("s"), F.filter(split_lines("x"), lambda s: s != "").alias("l")))
    for v, (s, lines) in zip(values, got):
        assert s == v.strip()
        assert lines == [x for x in v.splitlines() if x != ""]


def test_word_count_matches_python(spark):
    from deckforge.functions.text import word_count
    values = ["  a b\tc ", "", "   ", "one", "x　y z"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    assert [r[0] for r in df.select(word_count("x")).collect()] == [len(v.split()) for v in values]
