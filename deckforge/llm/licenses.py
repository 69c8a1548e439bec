"""License scans: sparse TF-IDF cosine of statements, headers and license files to templates, inherited by directory,
JVM-side only.

A term's inverse document frequency is over all scanned files, counted for the terms of the templates (which count
as files too) in one pass that keeps each file's shared terms; other terms say nothing about licenses and weigh as a
term that every file has. Vectors hold 1 + the logarithm of term counts.

Lines that speak of a license ("licen...") are compared to the statements, those of each license in each version and
variant. Versions of a license differ in so little that a cosine can't tell them apart: the numbers of versions in
a line and the words that tell variants apart (``VARIANTS``) must be the statement's own, no more and no
fewer, so an unknown version and a negated statement give no license. Lines meet statements by an equality of these.

Full licenses and headers are templates of their own (``license_templates``): a text as a whole is compared to the full
licenses; its windows, which run across lines over the whole text, are compared to the headers and short licenses. A
window is as long as its template and the next one starts an eighth of that further on; around the best one, one
starts at each term. So a header is always met by a window that misses a sixteenth of it at most, and the exact one is
found from there. A window must have its template's version and none of the words of its other variants. Texts with
too few of a template's terms for ``MIN_COSINE``, whatever the rest, are not compared to it. An SPDX line's
license comes before any other, as declared.

A file's license is that of its best line, window or whole at ``MIN_COSINE`` or above. Files named as
license files give theirs to their directory; a file without a license of its own has that of its
nearest ancestor directory with one.

Files stay in their rows for the scan. Inheritance joins the distinct directories with the
directories of license files (by each ancestor path, as many as a path is deep); files are joined
once with their directory's answer, so a directory with a third of all files is split by AQE and
nothing is multiplied.

Defined results: a null text or path scans as empty (a null path is in the root directory); ties
go to the template whose name sorts first; of several license files in one directory the best
score, then the name that sorts first, counts; an empty table gives an empty table; whole texts are
scanned; repeated rows are scanned each. Columns named like the output column are replaced.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import license_templates
from .common import fresh_name, with_fresh

# Statements of well-known licenses, by SPDX name.
STATEMENTS = [
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Use of this source code is governed by a BSD 2-clause style license."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD 3-clause style license."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD style license."),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
    ("ISC", "Released under the ISC License."),
    ("MIT", "Released under the MIT License."),
    ("MPL-1.1", "This file is subject to the terms of the Mozilla Public License, v. 1.1."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, v. 2.0."),
]
_GNU_FAMILY = [("GPL", "2.0", "GNU General Public License", "GNU GPL"),
               ("GPL", "3.0", "GNU General Public License", "GNU GPL"),
               ("LGPL", "2.1", "GNU Lesser General Public License", "GNU LGPL"),
               ("LGPL", "3.0", "GNU Lesser General Public License", "GNU LGPL"),
               ("AGPL", "3.0", "GNU Affero General Public License", "GNU AGPL")]
_CC_FAMILY = [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
              ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
              ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]
#: Words that tell variants of a license apart, or a statement from its opposite.
VARIANTS = ("affero", "agpl", "alike", "commercial", "derivative", "derivatives", "derivs", "except", "lesser", "lgpl", "nc",
            "nd", "neither", "never", "no", "noderivatives", "noderivs", "non", "noncommercial", "nor", "not", "sa", "share",
            "sharealike", "without")
#: Variants that a header's window may only have if its template does.
HEADER_VARIANTS = ("affero", "lesser", "noncommercial", "noderivatives", "sharealike")


def statements() -> list[tuple[str, str]]:
    """All statements: the fixed ones, and each license, version and variant of two families, in full and short."""
    out = list(STATEMENTS)
    for name, version, full, short in _GNU_FAMILY:
        subject = "This library" if name == "LGPL" else "This work"
        out += [(f"{name}-{version}", f"{subject} is licensed under the {full}, version {version}."),
                (f"{name}-{version}", f"Licensed under the {short} version {version}.")]
    for code, terms in _CC_FAMILY:
        for version in ("3.0", "4.0"):
            out += [(f"CC-{code}-{version}", f"This work is licensed under a Creative Commons {terms} {version} International License."),
                    (f"CC-{code}-{version}", f"Licensed under CC {code} {version}.")]
    return out


TERM = "[a-z0-9]+"
MIN_COSINE = 0.75
#: A window of a header template's length starts at each of so many parts of it.
WINDOW_STEPS = 8
#: The share of a template's square in terms too light to look for.
LIGHT_SHARE = 0.15
#: A declared license: an SPDX identifier or expression, taken as it stands.
_SPDX_ID = r"(?!NONE\b|NOASSERTION\b)\(*[A-Za-z0-9](?:[A-Za-z0-9.\-]*[A-Za-z0-9])?\+?\)*"
SPDX = rf"(?i)SPDX-License-Identifier:[ \t]*({_SPDX_ID}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{_SPDX_ID})*)"
#: Names of files (in upper case) whose license holds for their directory.
LICENSE_FILES = r"^(LICEN[CS]E|COPYING|UNLICENSE)([.\-_](TXT|MD|RST|HTML|LESSER|LIB|MIT|APACHE|BSD))*$"


#: What a line that states a license speaks of.
_SPEAKS = "licen"
#: "v2", "v. 2" and "version 2" are one.
_SHORT_VERSION = r"\bv(?:er)?\.? ?([0-9])"
_NUMBER = r"[0-9]+(?:\.[0-9]+)*"


def _in_words(line: str) -> list[str]:
    """The line's terms but bare numbers."""
    return [t for t in re.findall(TERM, re.sub(_SHORT_VERSION, r"version \1", line.lower())) if not t.isdigit()]


def telling(line: str) -> str:
    """The versions and the variant words of a line, as one string."""
    versions = {re.sub(r"(\.0)+$", "", n) for n in re.findall(_NUMBER, line) if len(n.split(".")[0]) <= 2}
    return " ".join([*sorted(versions), "|", *sorted(set(_in_words(line)) & set(VARIANTS))])


@functools.cache
def vocabulary() -> tuple[str, ...]:
    """The terms of all templates and statements."""
    texts = [t for _, t in license_templates.wholes() + license_templates.windows()]
    return tuple(sorted({t for x in texts for t in re.findall(TERM, x.lower())} | {
        t for _, x in statements() for t in _in_words(x)}))


def _as_files() -> tuple[Counter, int]:
    """How many of the templates and statements have a term, and how many they are."""
    texts = [set(re.findall(TERM, t.lower())) for _, t in license_templates.wholes() + license_templates.windows()]
    texts += [set(_in_words(t)) for _, t in statements()]
    return Counter(t for ts in texts for t in ts), len(texts)


def inverse_frequencies(found: dict[str, int], n_files: int) -> dict[str, float]:
    """found: files that have a term. The inverse document frequency of each term of the vocabulary."""
    own, n = _as_files()
    return {t: round(math.log((1 + n + n_files) / (1 + own[t] + found.get(t, 0))) + 1, 6) for t in vocabulary()}


#: The weight of a term of no template: that of one which every file has.
OTHER = 1.0
#: Digests of texts near a template (100 bytes each) that are sent to all tasks; more are joined by shuffling.
BROADCAST_KEYS = 500_000
TEMPLATE_ROW = ("number int, license string, whole boolean, length int, least int, own array<bigint>, must array<bigint>, "
                "mustnt array<bigint>, weights array<double>, products array<double>")


def _template_rows(idf: dict[str, float]) -> list[tuple]:
    """The full-text and header templates as rows. Terms go by their place in the vocabulary, from 1; place 0 is any
    other term."""
    place = {t: i + 1 for i, t in enumerate(vocabulary())}
    weights = [OTHER, *(idf[t] for t in vocabulary())]
    rows = []
    for whole, templates in ((True, license_templates.wholes()), (False, license_templates.windows())):
        for name, text in templates:
            c = Counter(re.findall(TERM, text.lower()))
            v = {place[t]: (1 + math.log(n)) * weights[place[t]] for t, n in c.items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            products = [0.0] * len(weights)
            for i, x in v.items():
                products[i] = x * weights[i] / norm
            # a cosine's square is at most the share of the template's square in the shared terms; light terms,
            # such as "the", are taken as shared
            heavy, light = sorted(v, key=lambda i: (-v[i], i)), 0.0
            while light + v[heavy[-1]] ** 2 <= LIGHT_SHARE * norm**2:
                light += v[heavy.pop()] ** 2
            square, least = light, 0
            for i in heavy:
                if square >= (MIN_COSINE * norm) ** 2 - 1e-9:
                    break
                square, least = square + v[i] ** 2, least + 1
            version = re.sub(r"(\.0)+$", "", name.rpartition("-")[2]).split(".")
            must = [place[t] for t in {*version, *HEADER_VARIANTS} if t in c] if not whole else []
            mustnt = [place[t] for t in HEADER_VARIANTS if t not in c] if not whole else []
            rows.append((len(rows), name, whole, sum(c.values()), least, sorted(heavy), sorted(must), sorted(mustnt), weights,
                         products))
    return rows


def _counted(terms: Column) -> Column:
    """array<struct<t, n>>: the array's distinct values, sorted, and how often each is there."""
    def counted(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return F.transform(F.array(starts), lambda b: F.transform(b, lambda x, k: F.struct(
            F.get(s, x).alias("t"), (F.coalesce(F.get(b, k + 1), F.size(s)) - x).alias("n"))))[0]

    return F.transform(F.array(F.sort_array(terms)), counted)[0]


def _cosine(codes: Column) -> Column:
    """The cosine of the template and the terms with these codes."""
    def cosine(cs: Column) -> Column:
        place = lambda x: F.greatest(x.t, F.lit(0)).cast("int")
        count_ = lambda x: 1 + F.log(x.n.cast("double"))
        weight = lambda x: F.get(F.col("weights"), place(x)) * count_(x)
        square = F.aggregate(cs, F.lit(0.0), lambda s, x: s + weight(x) * weight(x))
        dot = F.aggregate(cs, F.lit(0.0), lambda s, x: s + F.get(F.col("products"), place(x)) * count_(x))
        return dot / F.sqrt(square)

    return F.transform(F.array(_counted(codes)), cosine)[0]


def _best_window(codes: Column) -> Column:
    """The greatest cosine of windows of the template's length."""
    length = F.col("length")
    step = F.greatest(F.floor(length / WINDOW_STEPS).cast("int"), F.lit(1))
    last = F.greatest(F.size(codes) - length, F.lit(0))
    told = lambda w: (F.size(F.array_intersect(F.col("must"), w)) == F.size("must")) & ~F.arrays_overlap(F.col("mustnt"), w)
    cosine = lambda i: F.transform(F.array(F.slice(codes, i + 1, length)), lambda w: F.when(
        told(w), _cosine(w)).otherwise(0.0))[0]
    starts = F.array_append(F.sequence(F.lit(0), last, step), last)
    first = F.array_max(F.transform(starts, lambda i: F.struct(cosine(i).alias("c"), i.alias("i"))))
    return F.transform(F.array(first.i), lambda i: F.array_max(F.transform(F.sequence(
        F.greatest(i - step, F.lit(0)), F.least(i + step, last)), cosine)))[0]


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({TERM})"), F.lit(1))


def shared_terms(text: Column) -> Column:
    """The different terms of the text that some template has."""
    return F.array_intersect(terms_of(text), F.split(F.lit(" ".join(vocabulary())), " "))


def near_templates(shared: Column, rows: list[tuple]) -> Column:
    """Whether the text has as many terms of some template as a cosine of ``MIN_COSINE`` needs."""
    own = sorted({(r[4], " ".join(vocabulary()[i - 1] for i in r[5])) for r in rows})
    near = [F.size(F.array_intersect(F.split(F.lit(ts), " "), shared)) >= n for n, ts in own]
    return (F.size(shared) >= min(n for n, _ in own)) & functools.reduce(lambda a, b: a | b, near)


def by_templates(texts: DataFrame, rows: list[tuple]) -> DataFrame:
    """texts: (key, text), one row a key. Returns (key, by) of those with a full-text or header template at
    ``MIN_COSINE`` or above, by: struct<minus, license>. The templates' rows come to the texts by number."""
    spark = texts.sparkSession
    places = F.broadcast(spark.createDataFrame([(t, i + 1) for i, t in enumerate(vocabulary())], "term string, place long"))
    said = texts.select("key", F.posexplode(terms_of(F.col("text"))).alias("pos", "term")).join(places, "term", "left")
    # negative: a term of no template, by its hash
    code = F.coalesce("place", F.xxhash64("term").bitwiseOR(F.lit(-2**63)))
    said = said.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("pos", code.alias("code")))).alias("said"))
    # as many tasks as there are cores: comparing is long work on few bytes, which AQE would put into few tasks
    said = said.select("key", F.col("said.code").alias("codes")).repartition(
        spark.sparkContext.defaultParallelism * 4, "key")
    said = said.select("*", F.array_distinct("codes").alias("known"),
                       F.explode(F.sequence(F.lit(0), F.lit(len(rows) - 1))).alias("number"))
    near = said.join(F.broadcast(spark.createDataFrame(rows, TEMPLATE_ROW, verifySchema=False)), "number").where(
        F.size(F.array_intersect("known", "own")) >= F.col("least"))
    cosine = F.when(F.col("whole"), _cosine(F.col("codes"))).otherwise(_best_window(F.col("codes")))
    rated = near.select("key", F.struct((-F.round(cosine, 6)).alias("minus"), "license").alias("by"))
    return rated.groupBy("key").agg(F.min("by").alias("by")).where(F.col("by.minus") <= -MIN_COSINE)


def declared(text: Column) -> Column:
    """The text's first SPDX line's license (null: none)."""
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), SPDX, 1), F.lit(""))


def _told(line: Column) -> Column:
    """``telling`` of a lower-case line."""
    long = lambda n: F.length(F.split(n, r"\.")[0]) <= 2
    numbers = F.transform(F.filter(F.regexp_extract_all(line, F.lit(f"({_NUMBER})"), F.lit(1)), long),
                          lambda n: F.regexp_replace(n, r"(\.0)+$", ""))
    variants = F.array_intersect(_words(line), F.array(*[F.lit(v) for v in VARIANTS]))
    return F.array_join(F.concat(F.array_sort(F.array_distinct(numbers)), F.array(F.lit("|")), F.array_sort(variants)), " ")


def _words(line: Column) -> Column:
    """``_in_words`` of a lower-case line."""
    terms = F.regexp_extract_all(F.regexp_replace(line, _SHORT_VERSION, "version $1"), F.lit(f"({TERM})"), F.lit(1))
    return F.filter(terms, lambda t: ~t.rlike("^[0-9]+$"))


def by_statements(texts: DataFrame, idf: dict[str, float]) -> DataFrame:
    """texts: (key, text), as many rows a key as there are. Returns (key, stated) of those with a line that states a
    license at ``MIN_COSINE`` or above, stated: struct<minus, license>, scores to six digits."""
    spark = texts.sparkSession
    rows = []
    for name, text in statements():
        v = {t: (1 + math.log(n)) * idf[t] for t, n in Counter(_in_words(text)).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        rows.append((name, telling(text), {t: x / norm for t, x in v.items()}))
    known = F.broadcast(spark.createDataFrame(rows, "license string, told string, vector map<string,double>"))
    weight = F.create_map(*[F.lit(x) for t in sorted({t for r in rows for t in r[2]}) for x in (t, idf[t])])
    lines = texts.where(F.lower("text").contains(_SPEAKS)).select("key", F.explode(F.filter(
        F.split(F.lower("text"), "\n"), lambda x: x.contains(_SPEAKS))).alias("line"))
    part = lambda x: F.coalesce(weight[x.t], F.lit(OTHER)) * (1 + F.log(x.n.cast("double")))
    said = lines.select("key", _told(F.col("line")).alias("told"), F.transform(
        _counted(_words(F.col("line"))), lambda x: F.struct(x.t.alias("t"), part(x).alias("w"))).alias("terms"))
    met = said.join(known, "told")
    square = F.aggregate("terms", F.lit(0.0), lambda s, x: s + x.w * x.w)
    dot = F.aggregate("terms", F.lit(0.0), lambda s, x: s + x.w * F.coalesce(F.try_element_at("vector", x.t), F.lit(0.0)))
    rated = met.select("key", F.struct((-F.round(dot / F.sqrt(square), 6)).alias("minus"), "license").alias("stated"))
    return rated.where(F.col("stated.minus") <= -MIN_COSINE).groupBy("key").agg(F.min("stated").alias("stated"))


def directory(path: Column) -> Column:
    """The path without its last part; the root directory is the empty string."""
    return F.regexp_extract(F.coalesce(path, F.lit("")), "^(.*)/[^/]*$", 1)


def ancestors(folder: Column) -> Column:
    """The directory and those above it up to the root, the nearest first."""
    parts = F.split(folder, "/")
    up = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(
        F.slice(parts, F.lit(1), n), "/"))
    return F.array_distinct(F.concat(up, F.array(F.lit(""))))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", out_col: str = "license") -> DataFrame:
    """``files`` with a struct column: own license and its score, the license that holds (own or
    inherited, null if none) and the directory it was inherited from (null if own or none)."""
    own, folder, of, near, key = (fresh_name(files, x) for x in ("_own", "_folder", "_of", "_near", "_key"))
    text = F.col(text_col)
    digest = F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)  # equal texts are compared once
    # one pass over the texts: the terms that they share with the templates, and what they declare
    read = materialize(files.select(
        digest.alias("key"), shared_terms(text).alias("shared"), declared(text).alias("spdx")), "license-terms")
    counts = read.select(F.explode("shared").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()
    idf = inverse_frequencies({r.t: r.n for r in counts}, read.count())  # at most as many terms as the vocabulary
    rows = _template_rows(idf)
    near_keys = read.where(near_templates(F.col("shared"), rows)).select("key").distinct()
    if near_keys.count() <= BROADCAST_KEYS:  # texts stay where they are; beyond it, a join by key
        near_keys = F.broadcast(near_keys)
    keyed = files.select(digest.alias("key"), text.alias("text"))
    texts = keyed.join(near_keys, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    found = by_templates(materialize(texts, "license-texts"), rows)
    said = by_statements(keyed, idf)
    best = F.least("stated", "by")
    judged = read.groupBy("key").agg(F.max("spdx").alias("spdx")).join(said, "key", "left").join(found, "key", "left")
    score, which = -best.getField("minus"), best.getField("license")
    verdicts = materialize(judged.select(F.col("key").alias(of), F.when(F.col("spdx").isNotNull(), F.struct(
        F.lit(1.0).alias("score"), F.col("spdx").alias("license"))).when(best.isNotNull(), F.struct(
            score.alias("score"), which.alias("license"))).alias(own)).where(F.col(own).isNotNull()), "license-verdicts")

    none = F.struct(F.lit(0.0).alias("score"), F.lit(None).cast("string").alias("license"))
    tagged = files.withColumns({key: digest, folder: directory(F.col(path_col))})
    tagged = tagged.join(verdicts, F.col(key) == F.col(of), "left").withColumn(own, F.coalesce(own, none)).drop(key, of)
    name = F.regexp_extract(F.coalesce(F.col(path_col), F.lit("")), "([^/]*)$", 1)
    licensed = files.where(F.upper(name).rlike(LICENSE_FILES)).select(directory(F.col(path_col)).alias("at"), digest.alias(of))
    given = licensed.join(verdicts, of).groupBy("at").agg(F.min(F.struct(
        (-F.col(f"{own}.score")).alias("minus"), F.col(f"{own}.license").alias("license"))).alias("g"))
    folders = files.select(directory(F.col(path_col)).alias(of)).distinct().select(
        of, F.posexplode(ancestors(F.col(of))).alias("steps", "at"))
    nearest = folders.join(given, "at").groupBy(of).agg(F.min(F.struct("steps", "at", "g.license")).alias(near))
    joined = tagged.join(nearest, F.col(folder) == F.col(of), "left")
    mine = F.col(f"{own}.license")
    said = F.struct(mine.alias("own"), F.col(f"{own}.score").alias("score"),
                    F.coalesce(mine, F.col(f"{near}.license")).alias("holds"),
                    F.when(mine.isNull(), F.col(f"{near}.at")).alias("inherited_from"))
    return with_fresh(joined, out_col, said).drop(own, folder, of, near)
