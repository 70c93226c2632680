"""Licences of files: TF-IDF cosine to templates, then inheritance from the nearest directory."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm.shared import table

# Usual notices by SPDX name. A name may have several.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
TERM = "[a-z0-9]+(?:[.][0-9]+)*"  # terms of lower-cased text
LEAST = 0.6  # cosine of a line that counts as a notice
FILE_SHARE = 0.25  # of a text's characters in notices, from which it is a licence file
FILE_NAMES = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.][^/]*)?$"


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _counted(lines: DataFrame, key: str) -> DataFrame:
    return lines.select(key, F.explode(_terms(F.col(key))).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def licence_lines(files: DataFrame, text: str) -> DataFrame:
    """Distinct lines that are notices: ``line``, ``licence`` and ``cosine``.

    Terms of templates weigh tf * (ln((1 + files) / (1 + files with the term)) + 1), counted
    over all files; other terms weigh tf. Lines are compared in sparse form: only with
    templates that share a term. Lines without a term of ``telling_terms`` are left out
    before, as none can reach ``LEAST``. Of equal cosines (to 9 digits) the first name wins.
    """
    spark = files.sparkSession
    templates = spark.createDataFrame(TEMPLATES, "licence string, line string")
    words = sorted({r[0] for r in templates.select(F.explode(_terms(F.col("line")))).distinct().collect()})
    vocabulary = F.array(*map(F.lit, words))  # set by the templates, not by the data
    counted = (
        files.select(F.explode(F.array_intersect(_terms(F.col(text)), vocabulary)).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n"))
    )
    every = files.count()
    seen = {r["term"]: r["n"] for r in counted.collect()}  # at most one row a template term
    weights = spark.createDataFrame([(w, seen.get(w, 0)) for w in words], "term string, n long").select(
        "term", (F.log((1 + F.lit(every)) / (1 + F.col("n"))) + 1).alias("idf")
    )
    lines = candidate_lines(files.select(F.col(text).alias("text")), telling_terms(seen, every)).distinct()
    terms = _counted(lines, "line").join(F.broadcast(weights), "term", "left")
    weighed = terms.select("line", "term", (F.col("tf") * F.coalesce("idf", F.lit(1.0))).alias("w"), F.col("idf").isNotNull().alias("known"))
    norms = weighed.groupBy("line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    template_terms = _counted(templates, "line").join(weights, "term").select(
        F.col("line").alias("template"), "term", (F.col("tf") * F.col("idf")).alias("tw")
    )
    template_norms = template_terms.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm"))
    names = templates.select(F.col("line").alias("template"), "licence")
    dots = (
        weighed.where("known").join(F.broadcast(template_terms), "term")
        .groupBy("line", "template").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    )
    scored = dots.join(norms, "line").join(F.broadcast(template_norms.join(names, "template")), "template").select(
        "line", "licence", F.round(F.col("dot") / F.col("norm") / F.col("tnorm"), 9).alias("cosine")
    )
    best = scored.groupBy("line").agg(
        F.max("cosine").alias("cosine"), F.min_by("licence", F.struct(-F.col("cosine"), F.col("licence"))).alias("licence")
    )
    return best.where(F.col("cosine") >= LEAST)


def telling_terms(seen: Mapping[str, int], files: int) -> list[str]:
    """Terms of templates of which every line with a cosine of ``LEAST`` has at least one.

    A line that shares only the terms D with a template has a cosine of at most the length of
    the template's vector on D over its whole length (Cauchy-Schwarz). So of every template
    the terms of most files are left out as long as that stays below ``LEAST``, with a margin
    far above rounding; whatever the weights are, nothing that reaches ``LEAST`` is lost.
    """
    kept = set()
    for _, line in TEMPLATES:
        counts = Counter(re.findall(TERM, line.lower()))
        square = {w: (tf * (math.log((1 + files) / (1 + seen.get(w, 0))) + 1)) ** 2 for w, tf in counts.items()}
        room = (LEAST - 1e-6) ** 2 * sum(square.values())
        for term in sorted(square, key=lambda w: (-seen.get(w, 0), w)):
            room -= square[term]
            if room <= 0:
                kept.add(term)
    return sorted(kept)


def candidate_lines(texts: DataFrame, words: list[str]) -> DataFrame:
    """Lines of whole texts that may have one of the words among their terms; no other is lost."""
    line = F.explode(F.split("text", "\n", -1)).alias("line")
    # A term also starts after a number with a point ("1.0mit") and, if it is one, may end before a letter.
    plain, numbers = ("|".join(re.escape(w) for w in words if ("." in w) == dotted) for dotted in (False, True))
    ends = [f"({plain})([^a-z0-9]|$)"] * bool(plain) + [f"({numbers})"] * bool(numbers)
    return texts.select(line).where(F.lower("line").rlike("(^|[^a-z0-9]|[.][0-9]+)(" + "|".join(ends) + ")"))


def directory(path: Column) -> Column:
    """Up to and without the last slash; empty for a file at the top."""
    return F.coalesce(F.regexp_extract(path, r"\A(?s:(.*))/", 1), F.lit(""))


def licences(files: DataFrame, path: str = "path", text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """Licence of every file: its own notice's, or that of its nearest directory with one.

    Returns every row's columns ``path``, ``licence``, ``cosine``, ``basis`` (``file`` or
    ``directory``, else null), ``licence_directory`` and those of ``carry``, whose names must be
    others. All lines of whole texts are looked at. Of several notices the one with the greatest cosine counts, then the first name.

    A file is a licence file if its name says so, or if notices fill ``FILE_SHARE`` of its
    text. It gives its directory a licence, for all files below that have none of their own
    and no nearer directory with one. Distinct directories are joined with their ancestors,
    never files with files; every directory has one licence (greatest cosine, then first name).

    Null or empty texts have no notice but inherit. Null paths inherit nothing. Rows that share
    a path are one file. Other columns are not read.
    """
    named = files.select(F.col(path).alias("path"), F.col(text).alias("text"), F.struct(F.lit(0), *carry).alias("_carried"))
    notices = licence_lines(named, "text")
    of_line = named.where("path IS NOT NULL AND text IS NOT NULL").select(
        "path", F.length("text").alias("size"), F.explode(F.split("text", "\n", -1)).alias("line")
    )
    # Notices are few and repeat: their distinct lines meet the lines of the files. Their hash is
    # one more key, so that a grouped side is shuffled for this join too and a notice that very
    # many files have can be split.
    line_mark = F.xxhash64("line")
    own = (
        of_line.withColumn("_mark", line_mark).join(notices.withColumn("_mark", line_mark), ["line", "_mark"])
        .groupBy("path")
        .agg(
            F.max("cosine").alias("cosine"),
            F.min_by("licence", F.struct(-F.col("cosine"), F.col("licence"))).alias("licence"),
            (F.sum(F.length("line")) / F.max("size")).alias("share"),
        )
    )
    name = F.regexp_extract("path", r"([^/]*)\z", 1)
    giving = (
        own.where((F.col("share") >= FILE_SHARE) | name.rlike(FILE_NAMES))
        .groupBy(directory(F.col("path")).alias("licence_directory"))
        .agg(
            F.max("cosine").alias("cosine"),
            F.min_by("licence", F.struct(-F.col("cosine"), F.col("licence"))).alias("licence"),
        )
    )
    folders = named.where("path IS NOT NULL").select(directory(F.col("path")).alias("folder")).distinct()
    above = folders.select(
        "folder",
        F.explode(F.expr("transform(sequence(0, size(split(folder, '/', -1))), n -> struct(n AS depth, "
                         "array_join(slice(split(folder, '/', -1), 1, n), '/') AS ancestor))")).alias("a"),
    ).select("folder", "a.depth", F.col("a.ancestor").alias("licence_directory"))
    inherited = (
        above.join(giving, "licence_directory")
        .groupBy("folder")
        .agg(F.max_by(F.struct("licence", "cosine", "licence_directory"), "depth").alias("given"))
    )
    found = named.select("path", directory(F.col("path")).alias("folder"), "_carried").join(
        own.select("path", F.col("licence").alias("own"), F.col("cosine").alias("own_cosine")), "path", "left"
    )
    # The hash is one more key, so that the side grouped by folder is shuffled for this join too
    # and a folder with very many files can be split.
    mark = F.xxhash64("folder")
    result = found.withColumn("_mark", mark).join(inherited.withColumn("_mark", mark), ["folder", "_mark"], "left")
    given = F.col("own").isNull() & F.col("path").isNotNull() & F.col("given").isNotNull()
    return result.select(
        "path",
        F.when(given, F.col("given.licence")).otherwise(F.col("own")).alias("licence"),
        F.when(given, F.col("given.cosine")).otherwise(F.col("own_cosine")).alias("cosine"),
        F.when(F.col("own").isNotNull(), "file").when(given, "directory").alias("basis"),
        F.when(given, F.col("given.licence_directory")).alias("licence_directory"),
        *[F.col(f"_carried.`{c}`").alias(c) for c in carry],
    )


# Documents have no paths of their own; source, language and id place them in directories, and
# one without an id nowhere.
DOCUMENT_PATH = (
    "if(doc_id IS NULL, NULL, concat_ws('/', coalesce(source, 'none'), coalesce(lang, 'none'), "
    "cast(doc_id div 64 AS string), concat(cast(doc_id AS string), '.txt')))"
)


def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Licences of all documents, each placed at source / language / shard / id."""
    return document_licences(table(spark, folder, "documents"))


def document_licences(docs: DataFrame) -> DataFrame:
    """Licences of documents, each placed by its source, language and id; without an id none."""
    placed = docs.select(F.expr(DOCUMENT_PATH).alias("path"), "text", F.col("doc_id").cast("long").alias("doc_id"))
    return licences(placed, carry=["doc_id"])


_ROWS = ", ".join(f"('{name}', '{line}')" for name, line in TEMPLATES)

OP6_SQL = rf"""
WITH templates(licence, line) AS (VALUES {_ROWS}),
files AS (
  SELECT coalesce(source, 'none') || '/' || coalesce(lang, 'none') || '/' || (doc_id // 64)
         || '/' || doc_id || '.txt' AS path, text, doc_id
  FROM documents
),
tt AS (
  SELECT line, term, count(*) AS tf
  FROM (SELECT line, unnest(regexp_extract_all(lower(line), '{TERM}')) AS term FROM templates) GROUP BY ALL
),
vocabulary AS (SELECT DISTINCT term FROM tt),
df AS (
  SELECT term, count(*) AS n
  FROM (SELECT DISTINCT path, term
        FROM (SELECT path, unnest(regexp_extract_all(lower(text), '{TERM}')) AS term FROM files)
        WHERE term IN (FROM vocabulary))
  GROUP BY term
),
weights AS (
  SELECT term, ln((1 + (SELECT count(*) FROM files)) / (1 + coalesce(n, 0))) + 1 AS idf
  FROM vocabulary LEFT JOIN df USING (term)
),
all_lines AS (SELECT path, length(text) AS size, unnest(string_split(text, chr(10))) AS line FROM files),
lt AS (
  SELECT line, term, count(*) AS tf
  FROM (SELECT line, unnest(regexp_extract_all(lower(line), '{TERM}')) AS term FROM (SELECT DISTINCT line FROM all_lines))
  GROUP BY ALL
),
candidates AS (
  SELECT DISTINCT line FROM lt WHERE term IN (FROM vocabulary)
),
lw AS (
  SELECT line, term, tf * coalesce(idf, 1) AS w, idf IS NOT NULL AS known
  FROM lt SEMI JOIN candidates USING (line) LEFT JOIN weights USING (term)
),
tw AS (SELECT line AS template, term, tf * idf AS tw FROM tt JOIN weights USING (term)),
scored AS (
  SELECT line, licence, round(dot / norm / tnorm, 9) AS cosine
  FROM (SELECT line, template, sum(w * tw) AS dot FROM lw JOIN tw USING (term) WHERE known GROUP BY ALL)
  JOIN (SELECT line, sqrt(sum(w * w)) AS norm FROM lw GROUP BY line) USING (line)
  JOIN (SELECT template, sqrt(sum(tw * tw)) AS tnorm FROM tw GROUP BY template) USING (template)
  JOIN (SELECT line AS template, licence FROM templates) USING (template)
),
notices AS (
  SELECT line, licence, cosine FROM scored WHERE cosine >= {LEAST}
  QUALIFY row_number() OVER (PARTITION BY line ORDER BY cosine DESC, licence) = 1
),
hits AS (SELECT path, size, line, licence, cosine FROM all_lines JOIN notices USING (line)),
own AS (
  SELECT path, first(licence ORDER BY cosine DESC, licence) AS licence, max(cosine) AS cosine,
         sum(length(line)) / max(size) AS share
  FROM hits GROUP BY path
),
giving AS (
  SELECT regexp_extract(path, '^(.*)/', 1) AS folder, first(licence ORDER BY cosine DESC, licence) AS licence,
         max(cosine) AS cosine
  FROM own WHERE share >= {FILE_SHARE} GROUP BY 1
),
inherited AS (
  SELECT f.folder, g.licence, g.cosine, g.folder AS licence_directory
  FROM (SELECT DISTINCT regexp_extract(path, '^(.*)/', 1) AS folder FROM files) f
  JOIN giving g ON f.folder = g.folder OR starts_with(f.folder, g.folder || '/')
  QUALIFY row_number() OVER (PARTITION BY f.folder ORDER BY length(g.folder) DESC) = 1
)
SELECT f.doc_id, f.path, coalesce(o.licence, i.licence) AS licence, coalesce(o.cosine, i.cosine) AS cosine,
       CASE WHEN o.licence IS NOT NULL THEN 'file' WHEN i.licence IS NOT NULL THEN 'directory' END AS basis,
       CASE WHEN o.licence IS NULL THEN i.licence_directory END AS licence_directory
FROM files f LEFT JOIN own o USING (path)
LEFT JOIN inherited i ON regexp_extract(f.path, '^(.*)/', 1) = i.folder
"""
