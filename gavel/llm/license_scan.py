"""Licence scan: TF-IDF cosine of parts of files to templates, then inheritance from the nearest directory.

The units of a file are its lines, its runs of comment lines and of other
non-empty lines, its paragraphs (runs of non-empty lines of both sorts) and the
whole file; comment marks are no words.  Every unit is a sparse vector of term
frequency times inverse document frequency, where document frequencies of all
terms are counted over the whole corpus.  Templates are one-sentence notices, header notices
and full licence texts.  A unit's best template at ``THRESHOLD`` or more is a
declared licence, and the file's best unit decides.  A file of which the lines
of such units make up ``FILE_SHARE`` of the words is a licence file of its
directory.  A file that declares nothing takes the licence of the nearest
ancestor directory that has a licence file, found by an equi-join on directory
paths.

Defined cases: a null or empty text declares nothing; a null path has no
directory, so nothing is inherited; ties between templates go to the first
licence id in order, between licence files of a directory to the higher score,
then the first id; rows that share a path are judged each by their own text.
Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.llm.common import Scratch, text_key

THRESHOLD = 0.8
FILE_SHARE = 0.25

# Licence ids and the wording of their notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

#: Wording of notices over several lines, beside the full texts in ``licences/``.
HEADERS = [
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
     the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
     or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
     CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
     under the License."""),
    *((licence, f"""This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by
     the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This {what} is distributed in
     the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
     PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received a copy of the GNU {name} along with this {what}.
     If not, see https://www.gnu.org/licenses/.""") for licence, what, name in (
         ("GPL-3.0", "program", "General Public License"), ("LGPL-3.0", "library", "Lesser General Public License"))),
    ("LGPL-3.0", """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
     License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
     files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
     merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
     to do so, subject to the following conditions:"""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
     distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
]
#: Templates of so many terms count as long.
LONG = 100
_MARK = r"""^\s*(?:#|//|/\*|\*|--|;|%|<!--|\"{3}|'{3})"""


@cache
def full_texts() -> list[tuple[str, str]]:
    """(licence, text) of the notices over several lines and of the licences' full texts; read on the driver."""
    files = sorted((Path(__file__).parent / "licences").glob("*.txt"))
    return HEADERS + [(f.stem, f.read_text("ascii")) for f in files]


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OTHER = "".join(chr(c) for c in range(128) if not chr(c).isalnum() and c != 0x20)


def terms(text: Column) -> Column:
    """Words: A-Z lower-cased, cut at ASCII characters that are no letter or digit."""
    return F.array_remove(F.split(F.translate(text, _UPPER + _OTHER, _UPPER.lower() + " " * len(_OTHER)), " "), "")


def _vocabulary(templates) -> tuple[list[tuple[str, dict[str, int]]], list[str]]:
    bags = []
    for licence, text in templates:
        bag: dict[str, int] = {}
        for word in re.findall("[a-z0-9]+", text.lower()):
            bag[word] = bag.get(word, 0) + 1
        bags.append((licence, bag))
    return bags, sorted({w for _, bag in bags for w in bag})


def document_frequencies(files: DataFrame) -> DataFrame:
    """ls_term and ls_df, the number of files that hold it, of every term; the term "" is held by every file."""
    held = files.select(F.explode(F.concat(F.array(F.lit("")), F.array_distinct(terms(F.coalesce("text", F.lit("")))))).alias("ls_term"))
    return held.groupBy("ls_term").agg(F.count("*").alias("ls_df"))


def _literals(values: list) -> Column:
    return F.array(*map(F.lit, values))


def _bounds(bags, idf: dict[str, float], found: dict[str, int], share: float) -> tuple[list, list[str], list[str], int]:
    """Entries (term, template, licence, weight) of the templates' unit vectors, and what a unit must hold to match any.

    The cosine to a template is at most the length of the template's part on the unit's terms, whose square must
    be ``share`` at least.  So a unit holds one of a template's rarest terms that together have more than
    1 - ``share``, and as many terms as the heaviest need for ``share``: anchors of short and of long templates,
    and the number of terms of the latter.
    """
    entries, short, long, least = [], set(), set(), 1 << 30
    for k, (licence, bag) in enumerate(bags):
        norm = math.sqrt(sum((c * idf[w]) ** 2 for w, c in bag.items()))
        side = {w: c * idf[w] / norm for w, c in bag.items()}
        entries += [(w, k, licence, x) for w, x in side.items()]
        anchors, part = [], 0.0
        for w in sorted(side, key=lambda w: (found.get(w, 0), -side[w], w)):
            anchors.append(w)
            if (part := part + side[w] ** 2) > 1 - share:
                break
        need, part = 0, 0.0
        for x in sorted(side.values(), reverse=True):
            need += 1
            if (part := part + x * x) >= share:
                break
        if len(bag) < LONG:
            short.update(anchors)
        else:
            long.update(anchors)
            least = min(least, need)
    return entries, sorted(short), sorted(long), least


def _runs(classes: Column, n: Column) -> Column:
    """First and last line of the runs of one class, without those of class 0."""
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(classes, i) != F.get(classes, i - 1)))
    spans = F.transform(starts, lambda s, k: F.struct(s.alias("first"), (F.coalesce(F.get(starts, k + 1), n) - 1).alias("last")))
    return F.filter(spans, lambda r: F.get(classes, r["first"]) != 0)


def _units(files: DataFrame, keys: list[str], short: list[str], long: list[str], least: int) -> DataFrame:
    """Lines, comment and other runs, paragraphs and whole files that may match: ``keys``, first and last line, words.

    ``ls_sizes`` are the numbers of words of the unit's lines.
    """
    def may(words):
        return F.arrays_overlap(words, _literals(short)) | (
            F.arrays_overlap(words, _literals(long)) & (F.size(F.array_distinct(words)) >= least))

    def line(s):
        kind = F.when(s.rlike(r"^\s*$"), 0).when(s.rlike(_MARK), 1).otherwise(2)
        return F.struct(terms(s).alias("words"), kind.alias("kind"))

    # each stage goes through a generator, so nothing below computes it again
    text = F.coalesce("text", F.lit(""))
    held = files.where(may(terms(text)))
    lines = held.select(*keys, F.explode(F.array(F.transform(F.split(text, "\n"), line))).alias("l"))
    lines = lines.select(*keys, F.explode(F.array(F.struct(
        F.col("l.words").alias("words"), F.col("l.kind").alias("kind"), F.transform("l.kind", lambda k: F.least(k, F.lit(1))).alias("full"),
        F.transform("l.words", F.size).alias("sizes"), F.size("l").alias("n")))).alias("l"))
    n = F.col("l.n")
    lines = lines.select(*keys, "l", F.explode(F.array(F.struct(
        _runs(F.col("l.kind"), n).alias("runs"), _runs(F.col("l.full"), n).alias("paragraphs")))).alias("r"))
    single = F.transform(F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get("l.full", i) > 0),
                         lambda i: F.struct(i.alias("first"), i.alias("last")))
    whole = F.when(F.size("r.paragraphs") > 1, F.array(F.struct(
        F.element_at("r.paragraphs", 1)["first"].alias("first"), F.element_at("r.paragraphs", -1)["last"].alias("last"))))
    spans = F.array_distinct(F.concat(single, F.col("r.runs"), F.col("r.paragraphs"), F.coalesce(whole, F.slice(single, 1, 0))))

    def unit(span):
        at, many = span["first"] + 1, span["last"] - span["first"] + 1
        return F.struct(span["first"].alias("first"), span["last"].alias("last"), F.flatten(F.slice("l.words", at, many)).alias("words"),
                        F.slice("l.sizes", at, many).alias("sizes"))

    units = lines.select(*keys, F.explode(F.filter(F.transform(spans, unit), lambda u: may(u["words"]))).alias("u"))
    return units.select(*keys, F.col("u.first").alias("ls_first"), F.col("u.last").alias("ls_last"),
                        F.col("u.words").alias("ls_words"), F.col("u.sizes").alias("ls_sizes"))


def _renamed(df: DataFrame, columns: list[str]) -> tuple[DataFrame, Column]:
    """``df`` with other names for ``columns``, and the null-safe condition that joins it on them."""
    same = F.lit(True)
    for c in columns:
        same &= F.col(c).eqNullSafe(F.col(f"o_{c}"))
    return df.withColumnsRenamed({c: f"o_{c}" for c in columns}), same


def scored_units(files: DataFrame, keys: list[str], templates=TEMPLATES, threshold: float = THRESHOLD, texts=None) -> DataFrame:
    """``keys``, first and last line, words of each line, licence and score of every unit that matches a template."""
    spark, scratch = files.sparkSession, Scratch(files.sparkSession, "licences")
    bags, vocabulary = _vocabulary([*templates, *(full_texts() if texts is None else texts)])
    frequencies = scratch.keep(document_frequencies(files), "frequencies")
    # as many rows as the templates have terms
    words = F.broadcast(spark.createDataFrame([(w,) for w in ["", *vocabulary]], "ls_term string"))
    found = {r["ls_term"]: r["ls_df"] for r in frequencies.join(words, "ls_term").collect()}
    n = found.pop("", 0)
    idf = {w: math.log((n + 1) / (found.get(w, 0) + 1)) + 1 for w in vocabulary}
    share = (threshold - 1e-6) ** 2
    entries, short, long, least = _bounds(bags, idf, found, share)
    at = [*keys, "ls_first", "ls_last"]
    units = scratch.keep(_units(files, keys, short, long, least), "units")

    sides = F.broadcast(spark.createDataFrame(entries, "ls_term string, ls_template int, licence string, ls_side double"))
    near = (units.select(*at, F.explode(F.array_distinct("ls_words")).alias("ls_term")).join(sides, "ls_term")
            .groupBy(*at, "ls_template").agg(F.sum(F.col("ls_side") * F.col("ls_side")).alias("ls_part"))
            .where(F.col("ls_part") >= share).select(*at).distinct())
    near, same = _renamed(near, at)
    counted = (units.join(near, same, "left_semi").select(*at, F.explode("ls_words").alias("ls_term"))
               .groupBy(*at, "ls_term").agg(F.count("*").alias("ls_tf")))
    vector = counted.join(frequencies, "ls_term").withColumn(
        "ls_w", F.col("ls_tf") * (F.log(F.lit(n + 1.0) / (F.col("ls_df") + 1)) + 1))
    vector = scratch.keep(vector.select(*at, "ls_term", "ls_w"), "vectors")
    norms, same = _renamed(vector.groupBy(*at).agg(F.sqrt(F.sum(F.col("ls_w") * F.col("ls_w"))).alias("ls_norm")), at)
    dots = vector.join(sides, "ls_term").groupBy(*at, "ls_template", "licence").agg(F.sum(F.col("ls_w") * F.col("ls_side")).alias("ls_dot"))
    scored = dots.join(norms, same).withColumn("score", F.round(F.col("ls_dot") / F.col("ls_norm"), 9))
    best = scored.where(F.col("score") >= threshold).groupBy(*at).agg(
        F.min(F.struct((-F.col("score")).alias("minus"), "licence")).alias("ls_best"))
    best, same = _renamed(best, at)
    return units.join(best, same).select(*at, "ls_sizes", "ls_best.licence", (-F.col("ls_best.minus")).alias("score"))


def scan(files: DataFrame, keys: list[str], path: str, templates=TEMPLATES, threshold: float = THRESHOLD,
         file_share: float = FILE_SHARE, texts=None) -> DataFrame:
    """``keys``, licence, score, from_dir (null: declared in the file itself, or none) and is_licence_file of every row.

    ``keys`` identify a row and include its text hash or a unique id; ``path`` is a column of "/"-separated names.
    """
    found = scored_units(files, keys, templates, threshold, texts)
    # a line counts once, in however many units it matches
    lines = (found.select(*keys, "licence", "score", F.posexplode("ls_sizes").alias("ls_at", "ls_n"), "ls_first")
             .groupBy(*keys, (F.col("ls_first") + F.col("ls_at")).alias("ls_line"))
             .agg(F.min(F.struct((-F.col("score")).alias("minus"), "licence")).alias("best"), F.max("ls_n").alias("ls_n")))
    per_file = lines.groupBy(*keys).agg(F.min("best").alias("best"), F.sum("ls_n").alias("ls_matched"))
    per_file = per_file.select(*[F.col(k).alias(f"f_{k}") for k in keys], F.col("best.licence").alias("own"),
                               (-F.col("best.minus")).alias("own_score"), "ls_matched")
    same = [F.col(k).eqNullSafe(F.col(f"f_{k}")) for k in keys]
    rows = files.select(*keys, F.col(path).alias("ls_path"), F.size(terms(F.coalesce("text", F.lit("")))).alias("ls_total"))
    rows = rows.join(per_file, same, "left").drop(*(f"f_{k}" for k in keys))
    names = F.split("ls_path", "/")
    rows = rows.withColumn("ls_dirs", F.transform(F.sequence(F.lit(0), F.size(names) - 1), lambda i: F.array_join(F.slice(names, F.lit(1), i), "/")))
    rows = rows.withColumn("is_licence_file", F.coalesce(F.col("ls_matched") >= F.col("ls_total") * file_share, F.lit(False)))
    directories = (rows.where(F.col("is_licence_file") & F.col("ls_path").isNotNull())
                   .groupBy(F.element_at("ls_dirs", -1).alias("dir"))
                   .agg(F.min(F.struct((-F.col("own_score")).alias("minus"), F.col("own").alias("licence"))).alias("d"))
                   .select("dir", F.col("d.licence").alias("dir_licence")))
    # directories, not files, are joined to their ancestors: one row per directory and level
    used = rows.where(F.col("ls_path").isNotNull()).select(F.element_at("ls_dirs", -1).alias("ls_dir"), "ls_dirs").distinct()
    nearest = (used.select("ls_dir", F.posexplode("ls_dirs").alias("depth", "dir")).join(directories, "dir")
               .groupBy("ls_dir").agg(F.max(F.struct("depth", "dir", "dir_licence")).alias("near")))
    rows = rows.withColumn("ls_dir", F.element_at("ls_dirs", -1)).join(nearest, "ls_dir", "left")
    inherits = F.col("own").isNull()
    return rows.select(*keys, F.coalesce("own", "near.dir_licence").alias("licence"), F.col("own_score").alias("score"),
                       F.when(inherits, F.col("near.dir")).alias("from_dir"), "is_licence_file")


def query(docs: DataFrame) -> DataFrame:
    """doc_id, licence, score, from_dir and is_licence_file; a document's path is source/lang/doc_id."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.col("doc_id").cast("string"))
    files = docs.select("doc_id", text_key().alias("ls_key"), path.alias("ls_file"), "text")
    return scan(files, ["doc_id", "ls_key"], "ls_file").drop("ls_key").withColumn("score", F.coalesce("score", F.lit(0.0)))


def _sql() -> str:
    quoted = ", ".join("({}, '{}', '{}')".format(k, licence, text.replace("'", "''")) for k, (licence, text) in enumerate(TEMPLATES))
    cut = "regexp_extract_all(translate({}, '" + _UPPER + "', '" + _UPPER.lower() + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH t(tid, licence, body) AS (VALUES {quoted}),
tw AS (SELECT tid, licence, w, count(*) AS tf
       FROM (SELECT tid, licence, unnest({cut.format('body')}) AS w FROM t) GROUP BY ALL),
vocabulary AS (SELECT DISTINCT w FROM tw),
lines AS (SELECT doc_id, generate_subscripts(l, 1) AS line, unnest(l) AS body
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
lw AS (SELECT doc_id, line, w, count(*) AS tf
       FROM (SELECT doc_id, line, unnest({cut.format('body')}) AS w FROM lines) GROUP BY ALL),
total AS (SELECT count(*) AS n FROM documents),
df AS (SELECT w, count(DISTINCT doc_id) AS df FROM lw WHERE w IN (SELECT w FROM vocabulary) GROUP BY 1),
idf AS (SELECT v.w, ln((n + 1.0) / (coalesce(df, 0) + 1)) + 1 AS idf FROM total, vocabulary v LEFT JOIN df ON v.w = df.w),
tv AS (SELECT tid, licence, tw.w, tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY tid)) AS x FROM tw JOIN idf ON tw.w = idf.w),
lv AS (SELECT doc_id, line, lw.w, tf, tf * coalesce(idf, ln(n + 1.0) + 1) AS x FROM total, lw LEFT JOIN idf ON lw.w = idf.w),
norms AS (SELECT doc_id, line, sqrt(sum(x * x)) AS norm, sum(tf) AS n FROM lv GROUP BY 1, 2),
dots AS (SELECT doc_id, line, tid, licence, sum(lv.x * tv.x) AS dot FROM lv JOIN tv ON lv.w = tv.w GROUP BY ALL),
scored AS (SELECT d.doc_id, d.line, licence, round(dot / norm, 9) AS score, n
           FROM dots d JOIN norms o ON d.doc_id = o.doc_id AND d.line = o.line WHERE round(dot / norm, 9) >= {THRESHOLD}),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY score DESC, licence) = 1),
declared AS (SELECT doc_id, licence AS own, score, sum(n) OVER (PARTITION BY doc_id) AS matched FROM best
             QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence) = 1),
files AS (SELECT d.doc_id, coalesce(source, '') || '/' || coalesce(lang, '') AS dir, own, score,
                 coalesce(matched >= {FILE_SHARE} * len({cut.format('coalesce(text, chr(32))')}), false) AS is_licence_file
          FROM documents d LEFT JOIN declared c ON d.doc_id = c.doc_id),
dirs AS (SELECT dir, own AS licence FROM files WHERE is_licence_file
         QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, own) = 1)
SELECT doc_id, coalesce(own, dirs.licence) AS licence, coalesce(score, 0.0::DOUBLE) AS score,
       CASE WHEN own IS NULL THEN dirs.dir END AS from_dir, is_licence_file
FROM files LEFT JOIN dirs ON files.dir = dirs.dir"""


SQL = _sql()
