import math
import re
from collections import Counter

import pytest

from tapekeeper.llm import licenses

TEXT = {t.license: t.text for t in licenses.TEMPLATES if len(licenses.terms_of(t.text)) > 9}  # the longest notices come last


def brute_match(text, whole, least=licenses.LEAST):
    """(license, score) by comparing every passage with every template."""
    counts = [Counter(licenses.terms_of(t.text)) for t in licenses.TEMPLATES]
    df = Counter(w for c in counts for w in c)
    idf = lambda w: math.log((1 + len(counts)) / (1 + df[w])) + 1 if w in df else math.log(1 + len(counts)) + 1
    terms = licenses.terms_of(text.lower().replace("licence", "license"))
    found = []
    for template, c in zip(licenses.TEMPLATES, counts):
        length = sum(c.values())
        for at in range(len(terms) - length + 1):
            part = terms[at:at + length]
            if (template.title and not whole or part[0] not in c or not set(licenses.needed_terms(template.text)) <= set(part)
                    or set(part) & (set(licenses.NAMING) - set(c))):
                continue
            u = {w: n * idf(w) for w, n in Counter(part).items()}
            t = {w: n * idf(w) for w, n in c.items()}
            dot = sum(u.get(w, 0) * x for w, x in t.items())
            size = math.sqrt(sum(x * x for x in t.values()))
            score = dot / size / math.sqrt(sum(x * x for x in u.values()))
            if score >= least:
                found.append((-round(score * size, 9), template.license, -score))
    return (min(found)[1], -min(found)[2]) if found else None


FILES = [
    ("a/LICENSE", TEXT["MIT"]), ("a/b/x.py", "code\n# Licensed under the Apache License, Version 2.0.\nmore"),
    ("a/b/y.py", "no notice"), ("a/b/c/COPYING.txt", TEXT["GPL-3.0"].replace(" under", "\nunder")), ("a/b/c/d/z.py", ""),
    ("LICENSE-x", "nothing of the kind"), ("root.py", None), ("b//deep/f.py", "x"), ("/a/q.py", "SPDX-License-Identifier: MIT"),
    (None, "Released under the MIT License."), ("c/licence", "Released under the MIT License."), ("c/COPYING", "Licensed under CC BY-NC 4.0."),
    ("c/k/m.py", "license " * 20_000), ("c/k/n.py", "This work is licensed under a license\nReleased under the MIT License"),
]


def scan(spark, files):
    rows = spark.createDataFrame([(i, p, t, "d", "l") for i, (p, t) in enumerate(files)],
                                 "file_id long, path string, text string, dir string, license string").repartition(3)
    return {r.id: r for r in licenses.scan_licenses(rows).collect()}


def test_own_licences_against_brute_force(spark):
    found = scan(spark, FILES)
    assert len(found) == len(FILES)
    for i, (path, text) in enumerate(FILES):
        name = (path or "").rsplit("/", 1)[-1]
        expected = brute_match(text or "", bool(re.match(licenses.LICENCE_FILE, name)))
        assert found[i].own_license == (expected[0] if expected else None), path
        if expected:
            assert found[i].own_score == pytest.approx(expected[1])


def test_nearest_directory_wins(spark):
    found = scan(spark, FILES)
    of = {FILES[i][0]: (r.inherited_license, r.inherited_from, r.license) for i, r in found.items()}
    assert of["a/b/y.py"] == ("MIT", "a", "MIT")
    assert of["a/b/x.py"] == ("MIT", "a", "Apache-2.0")
    assert of["a/b/c/d/z.py"] == ("GPL-3.0", "a/b/c", "GPL-3.0")
    assert of["/a/q.py"][:2] == ("MIT", "a")
    assert of["root.py"] == of["b//deep/f.py"] == (None, None, None)
    assert of[None] == (None, None, "MIT")
    assert of["c/k/m.py"][:2] == ("CC-BY-NC-4.0", "c")  # equal scores: the first path, COPYING


def test_a_root_licence_covers_all(spark):
    found = scan(spark, [("LICENSE", "Released under the MIT License."), ("x/y/z.py", ""), ("w.py", "")])
    assert [(found[i].inherited_license, found[i].inherited_from) for i in (1, 2)] == [("MIT", "")] * 2


def test_empty_table_and_native_plan(spark):
    empty = spark.createDataFrame([], "file_id long, path string, text string")
    out = licenses.scan_licenses(empty)
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


GPL_HEADER = """#!/bin/sh
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
"""


def test_wrapped_headers_and_notices_inside_lines(spark):
    narrow = "\n".join(f" * {word}" for word in TEXT["Apache-2.0"].split())
    inside = "The text below is by the author. Released under the MIT License. Please read on for what it says of ships."
    far = "word " * 5000
    files = [("a.sh", GPL_HEADER), ("b.c", narrow), ("c.txt", inside), ("d.txt", far + inside + far), ("e.sh", far + GPL_HEADER),
             ("f.txt", "The book was released under the old name; the license of the shop was with the owner. " * 20)]
    found = scan(spark, files)
    assert [found[i].own_license for i in range(6)] == ["GPL-3.0", "Apache-2.0", "MIT", "MIT", "GPL-3.0", None]
    assert all(found[i].own_score == pytest.approx(1) for i in (1, 2, 3))


CASES = [
    ("# SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
    ("Licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    (GPL_HEADER.replace("version 3", "version 2"), "GPL-2.0"),
    (GPL_HEADER.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1"), "LGPL-2.1"),
    (GPL_HEADER.replace("GNU General", "GNU Lesser General"), "LGPL-3.0"),
    (GPL_HEADER.replace("GNU General", "GNU Affero General"), "AGPL-3.0"),
    (TEXT["MPL-1.1"], "MPL-1.1"), ("Licensed under the Mozilla Public Licence, Version 2.0", "MPL-2.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("Licensed under CC BY 3.0.", None), ("Licensed under the Apache License, Version 1.1.", None),
    ("Licensed under the GNU General Public License, version 1.", None),
    ("Copyright someone. " + TEXT["BSD-2-Clause"] + " This software is provided by the holders as is.", "BSD-2-Clause"),
    ("Copyright someone. " + TEXT["BSD-3-Clause"] + " This software is provided by the holders as is.", "BSD-3-Clause"),
    (TEXT["BSD-2-Clause"].split(" met:")[0], None),
    (TEXT["BSD-3-Clause"].replace("the copyright holder nor", "Any Firm Inc. nor"), "BSD-3-Clause"),
    (TEXT["ISC"], "ISC"), (TEXT["MIT"], "MIT"), (TEXT["Unlicense"], "Unlicense"),
    ("Er kam mit mit dem Hund und ging mit", None), ("mit", None), ("Die Lizenz (license) kam mit mit", None),
    ("license mit license mit", None), ("the mit license of the old town was a license to fish", None),
]


def test_licences_of_one_family_are_told_apart(spark):
    found = scan(spark, [(f"{i}.txt", text) for i, (text, _) in enumerate(CASES)])
    assert [(CASES[i][0], found[i].own_license) for i in range(len(CASES))] == CASES


def test_headings_count_in_licence_files_only(spark):
    texts = ["GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n" + "words of it " * 300, "Apache License\nVersion 2.0, January 2004\n" + "x " * 400,
             "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\nThis version of the GNU Lesser General Public License "
             "incorporates the terms and conditions of version 3 of the GNU General Public License", "MIT License\n\nCopyright"]
    found = scan(spark, [(f"{i}/{name}", text) for name in ("LICENSE", "x.py") for i, text in enumerate(texts)])
    assert [found[i].own_license for i in range(8)] == ["GPL-2.0", "Apache-2.0", "LGPL-3.0", "MIT"] + [None] * 4


def test_null_and_repeated_ids_keep_their_own_licence(spark):
    texts = ["Released under the MIT License.", "nothing", "Licensed under CC BY-NC 4.0."] * 40
    rows = spark.createDataFrame([(None if i % 2 else 7, f"{i}/x", t) for i, t in enumerate(texts)], "file_id long, path string, text string")
    found = {r.path: r.own_license for r in licenses.scan_licenses(rows.repartition(5)).collect()}
    assert [found[f"{i}/x"] for i in range(120)] == ["MIT", None, "CC-BY-NC-4.0"] * 40


def test_cheap_test_never_loses_a_match(spark):
    texts = [t.text for t in licenses.TEMPLATES] + [c for c, _ in CASES]
    rows = spark.createDataFrame([(i, f"{i}/LICENSE", t) for i, t in enumerate(texts)], "file_id long, path string, text string")
    found = {r.id: r.own_license for r in licenses.scan_licenses(rows).collect()}
    for i, text in enumerate(texts):
        expected = brute_match(text, True)
        assert found[i] == (expected[0] if expected else None), text
