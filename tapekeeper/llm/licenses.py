"""Licence scans: TF-IDF cosine of passages and licence files to templates, and inheritance along directories."""

import json
import math
import re
from collections import Counter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tapekeeper.llm.shared import SALTS, ascii_lower, plain, text_of, written


class Template(NamedTuple):
    license: str
    text: str
    title: bool = False    # a heading, which counts in licence files only


# Licences by the names that notices use. Those of one family differ in a word or a version only, so each is
# here for the others' sake too.
NAMES = [
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License v3.0"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-2.0", "GNU General Public License v2.0"),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("GPL-3.0", "GNU General Public License v3.0"),
    ("ISC", "ISC License"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1", "GNU Lesser General Public License v2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "GNU Lesser General Public License v3.0"),
    ("MIT", "MIT License"),
    ("MPL-1.1", "Mozilla Public License, version 1.1"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
]

# Short names of the licences for works, as notices use them.
SHORT = ["CC BY 4.0", "CC BY-NC 4.0", "CC BY-NC-SA 4.0", "CC BY-ND 4.0", "CC BY-SA 4.0"]

# Identifiers with the endings that the GNU licences have.
GNU = ["AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0"]

# What licences have written into the files they cover, and their own first words.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: Redistributions of source code must retain the above "
                     "copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form "
                     "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution. This software is provided by the "
                     "copyright holders and contributors as is"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: Redistributions of source code must retain the above "
                     "copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form "
                     "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution. Neither the name of the copyright "
                     "holder nor the names of its contributors may be used to endorse or promote products derived from this "
                     "software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not "
                "use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

# The notice of the GNU licences' programs, and the versions they name.
GNU_NOTICE = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published "
              "by the Free Software Foundation, either version {} of the License")
GNU_NOTICES = [("AGPL-3.0", "Affero General Public License", "3"), ("GPL-2.0", "General Public License", "2"),
               ("GPL-3.0", "General Public License", "3"), ("LGPL-2.1", "Lesser General Public License", "2.1"),
               ("LGPL-3.0", "Lesser General Public License", "3")]

# Headings of licence files beside the names.
TITLES = [
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
]

TEMPLATES = [
    *[Template(name, f"{verb} under the {words}.") for name, words in NAMES for verb in ("Licensed", "Released")],
    *[Template(name, f"This work is licensed under a {words}.") for name, words in NAMES if name.startswith("CC-")],
    *[Template(words.replace(" ", "-"), f"Licensed under {words}.") for words in SHORT],
    *[Template(name, f"SPDX-License-Identifier: {name}") for name in sorted({n for n, _ in NAMES} | {"Unlicense"})],
    *[Template(name, f"SPDX-License-Identifier: {name}-{end}") for name in GNU for end in ("only", "or-later")],
    *[Template(*notice) for notice in NOTICES],
    *[Template(name, GNU_NOTICE.format(words, version)) for name, words, version in GNU_NOTICES],
    *[Template(*title, True) for title in NAMES + TITLES],
]

# A term, the names of files that license their directory, and the spelling that counts as the other.
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([._-].*)?$"
SPELLING = ("licence", "license")

# Words that name a licence, so that a passage with one that its template lacks is about another licence.
NAMING = ("affero apache attribution attribution-noncommercial attribution-noncommercial-sharealike attribution-noderivatives "
          "attribution-sharealike bsd by-nc by-nc-sa by-nd by-sa commons endorse gnu isc lesser mozilla neither "
          "spdx-license-identifier unencumbered unlicense").split()

# Words that a passage must share with its template as it must share names and all that has a digit.
NEEDED = NAMING + "binary by cc disclaimer domain fee free license mit permission redistribution software".split()

# Least cosine to a template.
LEAST = 0.8


def terms_of(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def needed_terms(text: str) -> list[str]:
    """What no passage like ``text`` may lack: names, versions and the words that go with them."""
    return sorted({t for t in terms_of(text) if t in NEEDED or re.search("[0-9]", t)})


def gate_words(needs: list[tuple[str, ...]]) -> list[str]:
    """A few words so that whatever holds all of one of the lists holds one of them: each next one is in most lists left."""
    gates = []
    while needs:
        words = sorted({w for need in needs for w in need})
        gates.append(max(words, key=lambda w: sum(any(w in other for other in need) for need in needs)))
        needs = [need for need in needs if not any(gates[-1] in other for other in need)]
    return gates


def template_weights(templates=TEMPLATES) -> tuple[dict[str, float], float, list[dict[str, float]], list[float]]:
    """(idf per term, idf of any other term, unit-length weights and length per template); documents of the idf are the templates."""
    counts = [Counter(terms_of(t.text)) for t in templates]
    df = Counter(term for c in counts for term in c)
    idf = {term: math.log((1 + len(counts)) / (1 + n)) + 1 for term, n in df.items()}
    raw = [{term: n * idf[term] for term, n in c.items()} for c in counts]
    sizes = [math.sqrt(sum(x * x for x in of.values())) for of in raw]
    weights = [{term: x / size for term, x in of.items()} for of, size in zip(raw, sizes)]
    return idf, math.log(1 + len(counts)) + 1, weights, sizes


def _literal(value, kind: str) -> Column:
    """A nested constant, handed over as one text."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _strings(values) -> Column:
    return _literal(list(values), "array<string>")


def _of(table: Column, term: Column, other: float = 0.0) -> Column:
    return F.coalesce(F.try_element_at(table, term), F.lit(other))


def _once(value: Column) -> Column:
    """Exploding a list of one makes it a value: expressions over it would else compute it again each."""
    return F.explode(F.array(value))


def _known(templates) -> Column:
    """The templates as a list of structs."""
    _, _, weights, sizes = template_weights(templates)
    rows = [{"license": t.license, "title": t.title, "length": len(terms_of(t.text)), "size": size, "weights": of,
             "needed": needed_terms(t.text), "foreign": sorted(set(NAMING) - set(of))} for t, of, size in zip(templates, weights, sizes)]
    return _literal(rows, "array<struct<license: string, title: boolean, length: int, size: double, weights: map<string,double>, "
                          "needed: array<string>, foreign: array<string>>>")


def prepared(text: Column) -> Column:
    """The text as it is compared: A-Z lower-cased, one spelling."""
    return F.replace(ascii_lower(text), F.lit(SPELLING[0]), F.lit(SPELLING[1]))


def may_match(text: Column, whole: Column, templates=TEMPLATES) -> Column:
    """Whether a prepared text holds all that some template needs, somewhere: a cheap test that few texts pass."""
    needs = sorted({(tuple(needed_terms(t.text)), t.title) for t in templates})
    gate = F.lit(False)
    for word in gate_words([need for need, _ in needs]):
        gate = gate | F.contains(text, F.lit(word))
    words = sorted({w for need, _ in needs for w in need})
    found = F.filter(_strings(words), lambda word: F.contains(text, word))
    lists = _literal([{"needed": need, "title": title} for need, title in needs], "array<struct<needed: array<string>, title: boolean>>")
    return gate & F.aggregate(F.array(found), F.lit(False), lambda _, held: F.exists(
        lists, lambda n: (whole | ~n["title"]) & (F.size(F.array_except(n["needed"], held)) == 0)))


def match_templates(files: DataFrame, least: float = LEAST, templates=TEMPLATES) -> DataFrame:
    """(number, license, score) of rows (number, text, whole), the text prepared: the template that is found best in some passage.

    A passage is as many terms in a row as the template has, from any of its terms on; line ends, comment marks and
    what stands before or after do not matter. It must hold the template's names and versions, no name
    of another licence, and reach the cosine. Headings count in ``whole`` licence files only. Of several templates that
    match, the one of which most is there counts: the cosine times the template's length, so that a whole notice
    outweighs a part that others share with it. What is equal to nine places goes to the first licence by name, then the higher cosine.

    A text is cut into overlapping stretches, each holding every passage that starts in its first half, so a
    very long text is many small rows; a passage is scored in its row.
    """
    idf, other, _, _ = template_weights(templates)
    reach = max(len(terms_of(t.text)) for t in templates)
    texts = files.select("number", "whole", _once(F.regexp_extract_all("text", F.lit(f"({TERM})"), F.lit(1))).alias("all"))
    starts = F.sequence(F.lit(0), F.size("all") - 1, F.lit(reach))
    stretches = texts.filter(F.size("all") > 0).select("number", "whole", F.explode(
        F.transform(starts, lambda at: F.slice("all", at + 1, F.lit(2 * reach)))).alias("terms"))
    held = stretches.select("*", _once(F.array_distinct("terms")).alias("distinct"))
    fitting = F.filter(_known(templates), lambda t: (F.col("whole") | ~t["title"]) & (
        F.size(F.array_except(t["needed"], F.col("distinct"))) == 0))
    met = held.select("number", "terms", F.explode(fitting).alias("of"))
    first = F.sequence(F.lit(0), F.least(F.size("terms"), F.lit(reach)) - 1)
    first = F.filter(first, lambda at: (at + F.col("of.length") <= F.size("terms")) & (_of(F.col("of.weights"), F.get("terms", at)) > 0))
    passages = met.select("number", "of", F.explode(F.transform(first, lambda at: F.slice(
        "terms", at + 1, F.col("of.length")))).alias("terms"))
    passages = passages.select("*", _once(F.array_distinct("terms")).alias("distinct"))
    passages = passages.filter((F.size(F.array_except("of.needed", "distinct")) == 0) & ~F.arrays_overlap("of.foreign", "distinct"))
    value = lambda t: F.size(F.filter("terms", lambda x: x == t)) * _of(_literal(idf, "map<string,double>"), t, other)
    valued = passages.select("number", "of", _once(F.transform("distinct", lambda t: F.struct(
        t.alias("t"), value(t).alias("value")))).alias("terms"))
    dot = F.aggregate("terms", F.lit(0.0), lambda run, x: run + x["value"] * _of(F.col("of.weights"), x["t"]))
    length = F.sqrt(F.aggregate("terms", F.lit(0.0), lambda run, x: run + x["value"] * x["value"]))
    scored = valued.select("number", "of", (dot / length).alias("score")).filter(F.col("score") >= least)
    found = F.struct((-F.round(F.col("score") * F.col("of.size"), 9)).alias("below"), F.col("of.license").alias("license"),
                     (-F.round("score", 9)).alias("score"))
    best = scored.groupBy("number").agg(F.min(found).alias("best"))
    return best.select("number", "best.license", (-F.col("best.score")).alias("score"))


def scan_licenses(files: DataFrame, id_column: str = "file_id", path_column: str = "path", text_column: str = "text",
                  least: float = LEAST, templates=TEMPLATES) -> DataFrame:
    """(id, path, own_license, own_score, inherited_license, inherited_from, license) for every row.

    Files are looked at passage by passage; headings count in files named like a licence. A licence file's
    licence holds for its directory and all below, unless a nearer one does; of several in one
    directory the best score counts, then the first path, then the first licence by name. ``license`` is a file's own or else the
    inherited one. Runs of slashes count as one and a leading one not at all; null paths have no directory and
    inherit nothing; null texts are empty. Ids may be null or repeat: rows are told apart by a number they are written with.
    Directories are resolved once each, and files join them by directory and salt.
    """
    path = F.regexp_replace(F.regexp_replace(plain(path_column).cast("string"), "/+", "/"), "^/", "")
    rows = files.select(plain(id_column).alias("id"), path.alias("path"), prepared(text_of(text_column)).alias("text"))
    parts = F.split("path", "/")
    named = rows.withColumns({
        "dir": F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/"),
        "whole": F.coalesce(F.rlike(F.element_at(parts, -1), F.lit(LICENCE_FILE)), F.lit(False))})
    # Only texts that may match are written: the others are done with.
    numbered = written(named.select("id", "path", "dir", "whole", F.monotonically_increasing_id().alias("number"), F.when(
        may_match(F.col("text"), F.col("whole"), templates), F.col("text")).alias("text")), "files")
    own = written(match_templates(numbered.filter("text is not null").select("number", "text", "whole"), least, templates), "own")
    listed = numbered.drop("text").join(own.withColumnsRenamed({"license": "own_license", "score": "own_score"}), "number", "left")

    order = F.struct((-F.col("own_score")).alias("below"), "path", F.col("own_license").alias("inherited_license"))
    granted = listed.filter("whole and own_license is not null and dir is not null").groupBy(F.col("dir").alias("at")).agg(
        F.min(order).alias("best")).select("at", "best.inherited_license")
    steps = F.when(F.col("dir") == "", F.array()).otherwise(F.split("dir", "/"))
    upward = numbered.select("dir").filter("dir is not null").distinct().withColumn("steps", steps.cast("array<string>"))
    upward = upward.select("dir", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("steps")), lambda n: F.struct(
            n.alias("depth"), F.array_join(F.slice("steps", F.lit(1), n), "/").alias("at")))).alias("up"))
    above = upward.select("dir", "up.depth", "up.at").join(granted, "at")
    nearest = above.groupBy("dir").agg(F.max(F.struct("depth", F.col("at").alias("inherited_from"), "inherited_license")).alias("best"))
    resolved = nearest.select("dir", "best.inherited_from", "best.inherited_license")

    salted = listed.withColumn("salt", F.pmod(F.xxhash64("number"), F.lit(SALTS)))
    given = numbered.select("dir", F.pmod(F.xxhash64("number"), F.lit(SALTS)).alias("salt")).distinct().join(resolved, "dir")
    return salted.join(given, ["dir", "salt"], "left").select(
        "id", "path", "own_license", "own_score", "inherited_license", "inherited_from",
        F.coalesce("own_license", "inherited_license").alias("license"))
