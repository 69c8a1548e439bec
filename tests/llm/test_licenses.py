"""License lines and inheritance against a plain version."""

import math
import random
import re
from collections import Counter

from llm_cases import words

from deckforge.llm import licenses as S

STATED = {t for _, x in S.statements() for t in S._in_words(x)}
SCHEMA = "path string, text string, license string, at string, of string, own string, near string, g string"


def weights(texts):
    files = [set(re.findall(S.TERM, (t or "").lower())) for t in texts]
    return S.inverse_frequencies(Counter(t for ts in files for t in ts), len(files))


def brute_best(text, idf):
    best = (0.0, None)
    for line in (text or "").lower().split("\n"):
        if "licen" not in line:
            continue
        v = {t: idf.get(t, S.OTHER) * (1 + math.log(n)) if t in STATED else S.OTHER * (1 + math.log(n))
             for t, n in Counter(S._in_words(line)).items()}
        for name, statement in S.statements():
            own = {t: idf[t] * (1 + math.log(n)) for t, n in Counter(S._in_words(statement)).items()}
            if S.telling(line) == S.telling(statement.lower()):
                size = math.sqrt(sum(x * x for x in v.values()) * sum(x * x for x in own.values()))
                c = round(sum(x * own.get(t, 0) for t, x in v.items()) / size, 6)
                if c >= S.MIN_COSINE and (-c, name) < (-best[0], best[1] or "~"):
                    best = (c, name)
    return best


def brute(files):
    split = [(p or "").rpartition("/") for p, _ in files]
    idf = weights([t for _, t in files])
    best = [brute_best(t, idf) for _, t in files]
    given = {}
    for (folder, _, name), (score, which) in zip(split, best, strict=True):
        if re.match(S.LICENSE_FILES, name.upper()) and which:
            given[folder] = min(given.get(folder, (0, "~")), (-score, which))
    out = []
    for (p, _), (folder, _, _), (score, which) in zip(files, split, best, strict=True):
        at, holds = None, which
        if not which:
            up = folder
            while True:
                if up in given:
                    at, holds = up, given[up][1]
                    break
                if not up:
                    break
                up = up.rpartition("/")[0]
        out.append((p, which, score, holds, at))
    return sorted(out, key=str)


def result(spark, files):
    df = spark.createDataFrame([(*f, "a", "b", "c", "d", "e", "f") for f in files], SCHEMA)
    out = S.scan(df)
    assert out.columns == [c for c in df.columns if c != "license"] + ["license"]
    return sorted([(r.path, r.license.own, r.license.score, r.license.holds, r.license.inherited_from)
                   for r in out.collect()], key=str)


def test_statements_and_variants(spark):
    rng = random.Random(1)
    stated = S.statements()
    texts = [t for _, t in stated] + [
        "// licensed under the apache license version 2.0", "Licensed under the BSD.", "the license of version",
        words(rng, 50) + "\n# Released under the MIT license\n" + words(rng, 50), "MIT", words(rng, 200)]
    files = [(f"d/f{i}", t) for i, t in enumerate(texts)]
    got = result(spark, files)
    assert got == brute(files)
    own = {p: o for p, o, *_ in got}
    n = len(stated)
    assert [own[f"d/f{i}"] for i in range(n)] == [name for name, _ in stated]
    assert [own[f"d/f{n + i}"] for i in range(6)] == ["Apache-2.0", None, None, "MIT", None, None]


#: Lines of versions and variants, and the license that each states (None: none that is known).
VERSIONS = {
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "Licensed under the GNU GPL v2.0": "GPL-2.0", "licensed under the GNU GPL ver 3": "GPL-3.0",
    "This library is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
    "This work is licensed under the GNU Affero General Public License, version 3.0": "AGPL-3.0",
    "This work is licensed under the GNU General Public License, version 1.": None,
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "CC-BY-NC-4.0",
    "This work is licensed under a Creative Commons Attribution 3.0 International License.": "CC-BY-3.0",
    "This work is licensed under a Creative Commons Attribution 2.5 International License.": None,
    "This work is licensed under a Creative Commons Attribution-Share Alike 4.0 International License.": None,
    "Licensed under CC BY 4.0.": "CC-BY-4.0", "Licensed under CC BY-SA 3.0": "CC-BY-SA-3.0",
    "Licensed under CC BY-NC-ND 4.0.": "CC-BY-NC-ND-4.0",
    "This file is subject to the terms of the Mozilla Public License, v. 1.1.": "MPL-1.1",
    "This file is subject to the terms of the Mozilla Public License, v. 1.0.": None,
    "Use of this source code is governed by a BSD 2-clause style license.": "BSD-2-Clause",
    "Not released under the MIT License.": None, "This is not licensed under the Apache License, Version 2.0.": None,
    "Licensed under the Apache License, Version 1.1.": "Apache-1.1", "Licensed under the Apache License, Version 1.0": None,
    "Copyright 2019 X. Released under the MIT License.": "MIT",
}


def test_versions_and_variants_are_told_apart(spark):
    files = [(f"d{i}/f", t) for i, t in enumerate(VERSIONS)]
    got = result(spark, files)
    assert got == brute(files)
    own = {p: o for p, o, *_ in got}
    assert {t: own[f"d{i}/f"] for i, t in enumerate(VERSIONS)} == VERSIONS


def test_nearest_ancestor(spark):
    of = dict(S.STATEMENTS)
    mit, mpl, apache = of["MIT"], of["MPL-2.0"], of["Apache-2.0"]
    files = [("LICENSE", mit), ("a/license.md", mpl), ("a/b/c/COPYING.LESSER", apache), ("a/b/x", "text"), ("a/b/c/d/e/x", ""),
             ("ab/x", None), ("a/x", mit), ("x", "t"), ("a/b/LICENSE", "no statement"), ("z/LICENSE", mit),
             ("z/Licence.txt", apache), ("z/y/w", "t"), (None, None), ("a//x", "t"), ("/LICENSE", mpl), ("/q/x", "t"),
             ("a/b/x", "text"), ("q/licenses.py", apache), ("q/x", "t")]
    got = result(spark, files)
    assert got == brute(files)


def test_no_license_file(spark):
    files = [("a/x", "t"), ("y", None), ("a/b", "z " * 40_000)]
    assert result(spark, files) == brute(files)
    assert result(spark, []) == []


def test_plan_is_native(spark):
    df = spark.createDataFrame([("a/x", "t")], "path string, text string")
    plan = S.scan(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
