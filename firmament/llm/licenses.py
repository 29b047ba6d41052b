"""License scans: TF-IDF cosine of notices to templates, and inheritance along directories.

Excerpts of a file are compared: every line and sentence with a cue word, every paragraph and
every block between blank lines with one, joined over its lines without comment marks, and the
whole text.  Templates are short notices, standard headers and whole license texts.  Both become
sparse vectors of words, weighted by term count and by how rare the word is among all excerpts of
the corpus; an excerpt carries the license of the template with the highest cosine from ``NEAR``
on.  An excerpt that stands word for word in the template of a longer match of its file says
nothing of its own: the GPL speaks of other licenses.  Identifiers after an SPDX tag count as they
stand, with score 1.  ``licenses`` has every license of a file; ``license`` is the best of them,
a mere reservation of rights last.  A file is a license file if its name says so or if an excerpt
of its license is at least ``MOSTLY`` of its words.  A file without a license of its own inherits
from the nearest directory above it, its own first, that has a license file (of several there,
the best, then the first path).  All of it is joins and groupings: words and directories are
grouped before they meet anything, and distinct directories, not files, are joined to their
ancestors.

Null and empty texts have no notice and can inherit.  A null path has no directory: such a file
neither gives nor inherits.  Ties between templates go to the first by name.  Repeated rows get
equal results.  Other columns are not read.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament.llm.common import keep

NEAR = 0.6
MOSTLY = 1 / 3

# Names of license files, words that mark a notice, and public license notices.
FILE_NAMES = ["license", "licence", "copying", "notice", "unlicense"]
CUES = r"(?i)\b(licen[cs]e[ds]?|licensing|copyright|copyleft|warranty|all rights reserved|public domain|hereby granted|redistribution and use)\b"
NOTICES = {
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License."],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "ISC": ["Released under the ISC License."],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
    ],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0."],
    "Proprietary": ["All rights reserved."],
}
RESERVED = "Proprietary"  # not taken where the file names a license
NAMES = {
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPL 3.0"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache 2.0 license"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0 Universal public domain dedication"],
    "GPL-2.0": ["GNU General Public License, version 2", "GPL 2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GPL 3.0"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPL 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPL 3.0"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "MPL 2.0"],
    "Unlicense": ["The Unlicense"],
}
NAMED = ["{}.", "This program is licensed under the {}.", "This file is released under the terms of the {}. See the LICENSE file for details."]
GNU = (
    "This {what} is free software{stop} you can redistribute it and/or modify it under the terms of the GNU {name} as published by "
    "the Free Software Foundation, either version {version} of the License, or (at your option) any later version. "
    "This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. "
    "You should have received a copy of the GNU {name} along with this {what}. If not, see <https://www.gnu.org/licenses/>."
)
HEADERS = {
    "AGPL-3.0": [GNU.format(what="program", stop=":", name="Affero General Public License", version="3")],
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL-2.0": [GNU.format(what="program", stop=";", name="General Public License", version="2")],
    "GPL-3.0": [GNU.format(what="program", stop=":", name="General Public License", version="3")],
    "LGPL-2.1": [GNU.format(what="library", stop=";", name="Lesser General Public License", version="2.1")],
    "LGPL-3.0": [GNU.format(what="library", stop=":", name="Lesser General Public License", version="3")],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
}
TEXTS = Path(__file__).parent / "license_texts"  # whole texts by license, read by the driver
SENTENCES = r"\n+|(?<=[.!?])\s+"
MARKS = r"(?m)^[ \t]*(?:/\*+|\*+/?|//+!?|#+|--+|;+|%+|<!--|\"\"\"|''\')?[ \t]*|[ \t]*(?:\*+/|-->)?[ \t]*\r?$"  # of comments, and blanks at the ends of lines
OWNERS = r"(?im)^([ \t]*(?:/?\*+|//+|#+|--+|;+)?[ \t]*)copyright\b[ \t]*(?:\(c\)|©)?[ \t]*[<\[\d][^\n]*?(?=all rights reserved|\r?$)"  # a line that names who has the rights
SPDX_ID = r"[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?"
SPDX = rf"SPDX-License-Identifier:[ \t]*(\(*{SPDX_ID}(?:[ \t)]*[ \t](?:AND|OR|WITH|and|or|with)[ \t]+\(*{SPDX_ID})*)"
WORDS = r"[^\p{L}\p{N}.]+|\.(?![\p{N}])"


def _terms(text):
    return F.filter(F.split(F.lower(text), WORDS), lambda w: w != "")


def templates() -> list[tuple[str, str]]:
    """License and text of every template: notices, names, headers, whole texts and the paragraphs that grant."""
    found = [(k, n) for group in (NOTICES, HEADERS) for k, own in group.items() for n in own]
    found += [(k, form.format(name)) for k, own in NAMES.items() for name in own for form in NAMED]
    for file in TEXTS.glob("*.txt"):
        whole = file.read_text(encoding="utf-8")
        found.append((file.stem, whole))
        if file.stem in ("ISC", "MIT", "Unlicense"):
            found += [(file.stem, p) for p in whole.split("\n\n") if re.match(r"Permission|This is free", p)]
    return sorted(found)


def _normal(text):
    return F.array_join(_terms(text), " ")


def _excerpts(text):
    """Normal forms of the parts of a text that hold a cue word, and of the whole, without tags and owners."""
    untagged = F.regexp_replace(F.regexp_replace(text, SPDX, ""), OWNERS, "$1")
    plain = F.regexp_replace(untagged, MARKS, "")
    blocks = F.transform(F.split(untagged, r"\n[ \t\r]*\n"), lambda b: F.regexp_replace(b, MARKS, ""))
    paragraphs = F.split(plain, r"\n\s*\n")
    sentences = F.flatten(F.transform(paragraphs, lambda p: F.split(F.regexp_replace(p, r"\s+", " "), r"(?<=[.!?])\s+")))
    parts = F.concat(F.split(untagged, SENTENCES), sentences, paragraphs, blocks, F.array(plain))
    return F.array_distinct(F.transform(F.filter(parts, lambda p: p.rlike(CUES)), _normal))


def _tagged(text):
    """Identifiers after SPDX tags, without exceptions and with the name of the version alone."""
    plain = F.transform(F.regexp_extract_all(text, F.lit(SPDX), 1), lambda e: F.regexp_replace(e, rf"(?i)\bwith\s+{SPDX_ID}", ""))
    ids = F.flatten(F.transform(plain, lambda e: F.split(e, r"[\s()]+(?:(?i:and|or)[\s()]+)*")))
    known = {k.lower(): k for k, _ in templates()}
    plain_id = F.transform(ids, lambda i: F.regexp_replace(F.regexp_replace(i, r"^\(+", ""), r"(?i)(-only|-or-later|\+)$", ""))
    names = F.create_map(*[F.lit(x) for pair in sorted(known.items()) for x in pair])
    return F.array_distinct(F.transform(F.filter(plain_id, lambda i: i != ""), lambda i: F.coalesce(F.element_at(names, F.lower(i)), i)))


def scan(files: DataFrame, doc_id: str = "doc_id", path: str = "path", text: str = "text", near: float = NEAR) -> DataFrame:
    """``doc_id, path, license, score, source, from_path, licenses``; source is header, file, inherited or null."""
    spark = files.sparkSession
    rows = files.select(F.col(doc_id).alias("doc_id"), F.col(path).alias("path"), F.col(text).alias("text"))
    noted = rows.filter(F.col("text").rlike(CUES)).select(
        "doc_id", "path", F.xxhash64("text").alias("content"), F.size(_terms(F.col("text"))).alias("words"),
        _excerpts(F.col("text")).alias("notices"), _tagged(F.col("text")).alias("tagged"),
    )
    noted = keep(noted, "license-notices")
    notices = noted.select(F.explode("notices").alias("notice")).groupBy("notice").agg(F.count("*").alias("times"))  # equal excerpts meet here
    known = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(templates())], "template int, license string, text string")
    known = known.select("template", "license", _normal(F.col("text")).alias("body"))
    term = F.explode(F.split("notice", " "))
    found = keep(notices.withColumn("id", F.monotonically_increasing_id()), "license-texts")
    counted = found.select("id", "times", term.alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"), F.first("times").alias("times"))
    in_templates = known.select("license", "template", F.explode(F.split("body", " ")).alias("term")).groupBy("license", "template", "term").agg(
        F.count("*").alias("tf")
    )
    total = F.lit(float((found.agg(F.sum("times").alias("n")).head()["n"] or 0) + len(templates())))
    held = counted.select("term", "times").unionByName(in_templates.select("term", F.lit(1).cast("bigint").alias("times")))
    rare = keep(held.groupBy("term").agg((F.log((total + 1) / (F.sum("times") + 1)) + 1).alias("idf")), "license-terms")
    weighted = counted.join(rare, "term").select("id", "term", (F.col("tf") * F.col("idf")).alias("weight")).repartition("id")
    wanted = in_templates.join(rare, "term").select("license", "template", "term", (F.col("tf") * F.col("idf")).alias("other"))
    wanted = keep(wanted, "license-templates")
    lengths = weighted.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("length"))
    wide = wanted.groupBy("license", "template").agg(F.sqrt(F.sum(F.col("other") ** 2)).alias("size"))
    dots = weighted.join(F.broadcast(wanted), "term").groupBy("id", "license", "template").agg(F.sum(F.col("weight") * F.col("other")).alias("dot"))
    near_ones = (
        dots.join(F.broadcast(wide), ["license", "template"]).join(lengths, "id")
        .select("id", "license", "template", F.least(F.lit(1.0), F.col("dot") / (F.col("length") * F.col("size"))).alias("score")).filter(F.col("score") >= near)
    )
    best = F.min(F.struct((-F.round("score", 9)).alias("lack"), F.col("license"), F.col("template"))).alias("best")
    tops = near_ones.groupBy("id").agg(best).join(found, "id").select(
        "notice", F.col("best.license").alias("license"), F.col("best.template").alias("template"), (-F.col("best.lack")).alias("score"),
        F.size(F.split("notice", " ")).alias("own"),
    )
    bodies = F.broadcast(known.select(F.col("template").alias("at"), "body"))
    padded = [F.concat(F.lit(" "), F.col(c), F.lit(" ")) for c in ("body", "notice")]
    tops = keep(
        tops.join(bodies, (F.length("body") > F.length("notice")) & F.contains(*padded), "left")
        .groupBy("notice", "license", "template", "score", "own").agg(F.collect_list("at").alias("inside")),
        "license-tops",
    )
    entry = F.struct("license", "score", "own", "template", "inside")
    matched = noted.select("doc_id", "path", "content", "words", F.explode(F.array_distinct("notices")).alias("notice")).join(tops, "notice")
    tags = noted.select("doc_id", "path", "content", "words", F.explode("tagged").alias("license")).select(
        "doc_id", "path", "content", "words", "license", F.lit(1.0).alias("score"), F.lit(4).alias("own"), F.lit(-1).alias("template"),
        F.array().cast("array<int>").alias("inside"),
    )
    hits = matched.drop("notice").unionByName(tags).groupBy("doc_id", "path", "content").agg(F.collect_set(entry).alias("hits"), F.max("words").alias("words"))
    apart = F.filter("hits", lambda h: ~F.exists("hits", lambda g: (g["own"] > h["own"]) & F.array_contains(h["inside"], g["template"])))
    each = hits.select("doc_id", "path", "content", "words", F.explode(apart).alias("hit")).groupBy("doc_id", "path", "content", "hit.license").agg(
        F.max("hit.score").alias("score"), F.max("hit.own").alias("own"), F.max("words").alias("words")
    )
    place = F.struct((F.col("license") == RESERVED).alias("reserved"), (-F.col("score")).alias("lack"), F.col("license"), F.col("own"))
    own = each.groupBy("doc_id", "path", "content").agg(F.sort_array(F.collect_list(place)).alias("all"), F.max("words").alias("words")).select(
        "doc_id", "path", "content", F.col("all")[0]["license"].alias("license"), (-F.col("all")[0]["lack"]).alias("score"),
        (F.col("all")[0]["own"] >= F.col("words") * F.lit(MOSTLY)).alias("mostly"),
        F.transform("all", lambda x: F.struct(x["license"].alias("license"), (-x["lack"]).alias("score"))).alias("licenses"),
    )
    own = keep(own, "license-own")
    name = F.lower(F.regexp_extract("path", r"([^/]*)$", 1))
    named = F.regexp_replace(name, r"\.[^.]*$", "").isin(FILE_NAMES)
    givers = own.filter(F.col("path").isNotNull() & (F.col("mostly") | named)).withColumn("dir", _above(F.col("path")))
    given = givers.groupBy("dir").agg(F.max("score").alias("top")).join(givers, "dir").filter(F.col("score") == F.col("top")).groupBy("dir").agg(
        F.min(F.struct("path", "license")).alias("from")
    )
    dirs = rows.filter(F.col("path").isNotNull()).select(_above(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    ancestors = dirs.select("dir", F.explode(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts)))).alias("depth")).select(
        "dir", "depth", F.array_join(F.slice(parts, 1, F.col("depth")), "/").alias("up")
    )
    nearest = ancestors.join(given.select(F.col("dir").alias("up"), "from"), "up").groupBy("dir").agg(F.max(F.struct("depth", "from")).alias("near"))
    inherited = nearest.select("dir", F.col("near.from.license").alias("given_license"), F.col("near.from.path").alias("given_path"))
    joined = (
        rows.select("doc_id", "path", F.xxhash64("text").alias("content"), _above(F.col("path")).alias("dir"))
        .join(own.select(F.col("doc_id").alias("id"), F.col("path").alias("at"), F.col("content").alias("is"), "license", "score", "mostly", "licenses"),
              F.col("doc_id").eqNullSafe(F.col("id")) & F.col("path").eqNullSafe(F.col("at")) & (F.col("content") == F.col("is")), "left")
        .join(inherited, "dir", "left")
    )
    has = F.col("license").isNotNull()
    return joined.select(
        "doc_id", "path", F.coalesce("license", "given_license").alias("license"), F.when(has, F.col("score")).alias("score"),
        F.when(has & (F.col("mostly") | F.coalesce(named, F.lit(False))), "file").when(has, "header")
        .when(F.col("given_license").isNotNull(), "inherited").alias("source"),
        F.when(has, F.col("path")).otherwise(F.col("given_path")).alias("from_path"),
        "licenses",
    )


def _above(path):
    """Directory of a path, '' at the top."""
    return F.regexp_replace(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), "^/+", "")
