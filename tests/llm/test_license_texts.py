"""Licenses of whole files, of headers across lines and of SPDX lines, in texts that the given data don't have."""

import random
import textwrap

from llm_cases import words

from deckforge.llm import license_templates as T
from deckforge.llm import licenses as S


def own(spark, texts):
    df = spark.createDataFrame([(i, f"d{i}/LICENSE", t) for i, t in enumerate(texts)], "i int, path string, text string")
    return {r.i: (r.license.own, r.license.score) for r in S.scan(df).collect()}


def comment(text, mark, width=70):
    return "\n".join(f"{mark} {line}" for line in textwrap.wrap(text, width))


def test_whole_licenses(spark):
    names = list(T.SHORT + T.LONG)
    texts = [f"Copyright (c) 2019 Some Body and others\n\n{T.full_text(n)}" for n in names]
    got = own(spark, texts)
    assert [got[i][0] for i in range(len(names))] == names and min(s for _, s in got.values()) > 0.95


def test_headers_anywhere(spark):
    rng = random.Random(3)
    cases = [(name, text, mark) for name, text in T.windows() for mark in ("#", " *")]
    texts = [f"{words(rng, rng.randrange(200))}\n{comment(t, mark, rng.randrange(40, 90))}\n{words(rng, 300)}"
             for _, t, mark in cases]
    got = own(spark, texts)
    assert [got[i][0] for i in range(len(cases))] == [name for name, _, _ in cases]


def test_changed_header_and_prose(spark):
    gpl = T.HEADERS[4][1].replace("This program", "Frobnicator").replace(
        "along with", "together with")
    cut = T.full_text("MIT").replace("AUTHORS OR COPYRIGHT HOLDERS", "FROBNICATOR TEAM")
    prose = "The license of the house was granted to any person, and the copy of it was not in use without permission. " * 30
    got = own(spark, [comment(gpl, "//"), cut, prose, "", None, words(random.Random(2), 5000)])
    assert [got[i][0] for i in range(6)] == ["GPL-3.0", "MIT", None, None, None, None]


def test_spdx_lines(spark):
    texts = ["// SPDX-License-Identifier: GPL-2.0-or-later\nint x;", "/* spdx-license-identifier: MIT */",
             "# SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause", "SPDX-License-Identifier: NOASSERTION",
             "SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note\n" + T.full_text("MIT"),
             "<!-- SPDX-License-Identifier: EPL-2.0 -->"]
    got = own(spark, texts)
    assert [got[i][0] for i in range(6)] == [
        "GPL-2.0-or-later", "MIT", "(MIT OR Apache-2.0) AND BSD-3-Clause", None,
        "GPL-2.0-only WITH Linux-syscall-note", "EPL-2.0"]


def test_header_of_another_version_is_not_taken(spark):
    """Headers that differ from a template in version or variant alone."""
    of = dict(T.HEADERS)
    texts = [of["CC-BY-4.0"].replace("4.0", "2.5"), of["GPL-3.0"].replace("version 3", "version 1"),
             of["MPL-2.0"].replace("2.0", "3.0"), of["CC-BY-4.0"], of["GPL-2.0"], of["LGPL-2.1"], of["AGPL-3.0"]]
    got = own(spark, texts)
    assert [got[i][0] for i in range(7)] == [None, None, None, "CC-BY-4.0", "GPL-2.0", "LGPL-2.1", "AGPL-3.0"]


def test_affero_text(spark):
    got = own(spark, [dict(T.wholes())["AGPL-3.0"], T.full_text("GPL-3.0")])
    assert [got[i][0] for i in range(2)] == ["AGPL-3.0", "GPL-3.0"]
