"""License scans in DataFrame operations only: TF-IDF cosine, then inheritance by paths.

Every line of every file, and every run of up to ``WRAPPED`` short lines, is compared with
licence statements, and every file as a whole with the texts in ``licence_texts``.  Document frequencies of the
statements' terms are counted over all files; a term outside them weighs as much as a term
no file has.  A line can only reach the threshold if it has one of the terms that carry a
statement's weight, so lines without any are left out before the products; the products
themselves are joins on terms.  A file's licence is that of its best line; a file without
one takes that of the nearest directory above it that has a licence file, found by joining
the directories above with those of licence files.

Defined cases: a null text is empty; a file with lines of several licences has the most
similar one, of equals the one that comes first in the alphabet; of several licence files
in a directory the most similar, then the first path counts; a null path inherits nothing;
repeated rows give repeated results; an empty table gives no rows; other columns are not
looked at.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import stored, table

LIMIT = 0.8
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|copyright|notice)[^/]*$"

# fixed values: statements by which files and texts name their licence
STATEMENTS = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
                   "in compliance with the License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the "
                "License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
                 "the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation, either version 3 of "
                 "the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of "
                 "the License, or (at your option) any later version."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    *((name.removesuffix("-only").removesuffix("-or-later"), "SPDX-License-Identifier: " + name) for name in (
        "0BSD", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.1", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause",
        "BSD-4-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-1.0", "EPL-2.0", "GPL-2.0",
        "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1", "LGPL-2.1-only",
        "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-1.1", "MPL-2.0", "Unlicense",
        "Zlib")),
)
# whole licences, without the lines that name an owner
TEXTS = tuple((path.stem, path.read_text("utf-8", "replace")) for path in sorted(Path(__file__).with_name("licence_texts").glob("*.txt")))
# a wrapped statement: so many lines at most, each of at most so many characters
WRAPPED, WIDTH = 8, 200


def terms(text: str) -> list[str]:
    return [t for t in re.split("[^a-z0-9]+", text.lower()) if t]


def _terms(column):
    return F.filter(F.split(F.lower(column), "[^a-z0-9]+"), lambda t: t != "")


def weigh(frequencies: dict[str, int], files: int, statements=STATEMENTS):
    """``idf`` of the statements' terms and of others (under None), and the statements as
    unit vectors."""
    vocabulary = sorted({t for _, s in statements for t in terms(s)})
    idf = {t: math.log((1 + files) / (1 + frequencies.get(t, 0))) + 1 for t in vocabulary}
    idf[None] = math.log(1 + files) + 1
    vectors = []
    for name, statement in statements:
        raw = {t: n * idf[t] for t, n in Counter(terms(statement)).items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        vectors.append((name, {t: w / norm for t, w in raw.items()}))
    return idf, vectors


def carriers(vectors, limit: float = LIMIT, idf=None) -> list[str]:
    """Terms of which a text must have one to reach the limit with any statement: without
    them the statement's remaining length is below it.  Heavy terms first, or rare ones
    if ``idf`` is given."""
    chosen: set[str] = set()
    for _, vector in vectors:
        for term, _ in sorted(vector.items(), key=lambda x: (-(idf[x[0]] if idf else x[1]), x[0])):
            if math.sqrt(sum(w * w for t, w in vector.items() if t not in chosen)) < limit:
                break
            chosen.add(term)
    return sorted(chosen)


def _pattern(needed: list[str]) -> str:
    return "(?i)(?<![a-z0-9])(" + "|".join(needed) + ")(?![a-z0-9])" if needed else "(?!)"


def _similar(units: DataFrame, idf, vectors, limit: float) -> DataFrame:
    """``file, best`` of the texts ``file, line, words``: the most similar statement of each file."""
    spark = units.sparkSession
    weights = spark.createDataFrame([(t, w) for t, w in idf.items() if t is not None], "term string, idf double")
    parts = spark.createDataFrame([(t, i, w) for i, (_, v) in enumerate(vectors) for t, w in v.items()],
                                  "term string, statement int, part double")
    names = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(vectors)], "statement int, licence string")
    counted = (units.select("file", "line", F.explode(_terms(F.col("words"))).alias("term"))
               .groupBy("file", "line", "term").count().join(F.broadcast(weights), "term", "left")
               .select("file", "line", "term", (F.col("count") * F.coalesce("idf", F.lit(idf[None]))).alias("weight")))
    counted = stored(counted, "terms")
    norms = counted.groupBy("file", "line").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    products = (counted.join(F.broadcast(parts), "term").groupBy("file", "line", "statement")
                .agg(F.sum(F.col("weight") * F.col("part")).alias("dot")))
    return (products.join(norms, ["file", "line"]).join(F.broadcast(names), "statement")
            .select("file", "licence", F.round(F.col("dot") / F.col("norm"), 9).alias("similarity"))
            .filter(F.col("similarity") >= limit)
            .groupBy("file").agg(F.min(F.struct((-F.col("similarity")).alias("far"), "licence")).alias("best")))


def _wrapped(files: DataFrame, pattern: str) -> DataFrame:
    """``file, line, words``: every run of 2 to ``WRAPPED`` short lines with one of the terms.
    Runs are numbered by their first line and length, from minus one downwards."""
    def runs(line, at):
        some = F.slice("lines", at + 1, WRAPPED)
        return F.when(F.array_join(some, " ").rlike(pattern), some)
    rows = (files.select("file", F.split("text", "\n").alias("lines"))
            .select("file", F.posexplode(F.transform("lines", runs)).alias("at", "some")).filter("some is not null")
            .select("file", "at", "some", F.explode(F.sequence(F.lit(2), F.lit(WRAPPED))).alias("n")).filter("size(some) >= n")
            .select("file", (-1 - F.col("at") * WRAPPED - F.col("n")).alias("line"), F.slice("some", 1, F.col("n")).alias("run"))
            .filter(F.forall("run", lambda x: F.length(x) <= WIDTH)))
    return rows.select("file", "line", F.array_join("run", " ").alias("words")).filter(F.col("words").rlike(pattern))


def matched(files: DataFrame, limit: float = LIMIT, statements=STATEMENTS, whole=TEXTS) -> DataFrame:
    """``file, licence, similarity`` of the files ``file, text`` with a line, or a run of
    short lines, that matches a statement, or that match a licence's text as a whole."""
    vocabulary = sorted({t for _, s in (*statements, *whole) for t in terms(s)})
    held = F.array(*map(F.lit, vocabulary))
    seen = files.select(F.explode(F.array_intersect(_terms(F.col("text")), held)).alias("term"))
    frequencies = {r["term"]: r["count"] for r in seen.groupBy("term").count().collect()}  # a row per term
    count = files.count()
    idf, vectors = weigh(frequencies, count, statements)
    pattern = _pattern([t for t in carriers(vectors, limit) if t in frequencies])  # others are in no file
    some = files.filter(F.col("text").rlike(pattern))
    lines = (some.select("file", F.posexplode(F.split("text", "\n")).alias("line", "words"))
             .filter(F.col("words").rlike(pattern)))
    found = _similar(lines.unionByName(_wrapped(some, pattern)), idf, vectors, limit)
    if whole:
        idf, vectors = weigh(frequencies, count, whole)
        needed = [t for t in carriers(vectors, limit, idf) if t in frequencies]
        if not needed:
            whole = ()
    if whole:
        some = files.filter(F.arrays_overlap(_terms(F.col("text")), F.array(*map(F.lit, needed))))
        bodies = some.select("file", F.lit(0).alias("line"), F.col("text").alias("words"))
        found = found.unionByName(_similar(bodies, idf, vectors, limit))
    return (found.groupBy("file").agg(F.min("best").alias("best"))
            .select("file", F.col("best.licence").alias("licence"), (-F.col("best.far")).alias("similarity")))


def _directory(path):
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def scan(files: DataFrame, limit: float = LIMIT, statements=STATEMENTS) -> DataFrame:
    """One row per row of ``doc_id, path, text``: ``licence``, ``origin`` (``own``,
    ``inherited`` or null), ``similarity``, and ``licence_path``, the file that says so."""
    rows = files.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("path").cast("string").alias("path"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                        F.xxhash64("path", "doc_id", F.col("text").cast("string")).alias("file"))
    found = stored(matched(rows.select("file", "text"), limit, statements), "licences")
    names = rows.select("doc_id", "path", "file", _directory(F.col("path")).alias("directory"))
    own = stored(names.join(found, "file", "left"), "files")
    givers = (own.filter(F.col("path").rlike(FILE_NAME) & F.col("licence").isNotNull()).groupBy("directory")
              .agg(F.min(F.struct((-F.col("similarity")).alias("far"), "path", "licence")).alias("g"))
              .select(F.col("directory").alias("above"), "g"))
    folders = own.filter("path is not null").select("directory").distinct()
    steps = F.split("directory", "/")
    above = folders.select("directory", F.explode(F.sequence(F.lit(0), F.size(steps))).alias("depth")).select(
        "directory", "depth", F.array_join(F.slice(F.split("directory", "/"), 1, F.col("depth")), "/").alias("above"))  # 0: the root
    nearest = stored(above.join(givers, "above").groupBy("directory")
                     .agg(F.max_by("g", "depth").alias("g")), "nearest")
    joined = own.join(nearest, "directory", "left")
    inherits = F.col("licence").isNull() & F.col("g").isNotNull()
    return joined.select(
        "doc_id", "path", F.coalesce("licence", "g.licence").alias("licence"),
        F.when(F.col("licence").isNotNull(), "own").when(inherits, "inherited").alias("origin"),
        F.coalesce("similarity", -F.col("g.far")).alias("similarity"),
        F.when(F.col("licence").isNotNull(), F.col("path")).when(inherits, F.col("g.path")).alias("licence_path"))


def placed(docs: DataFrame) -> DataFrame:
    """``documents`` as files: they have no paths of their own, so source, language and
    every 500 ids are directories, and a text of at most 60 words is a licence file of its
    language's directory."""
    short = F.size(F.split(F.trim(F.coalesce("text", F.lit(""))), "\\s+")) <= 60
    top = F.concat_ws("/", "source", "lang")
    return docs.select("doc_id", "text", F.when(
        short, F.concat(top, F.lit("/LICENSE."), F.col("doc_id"))).otherwise(
        F.concat(top, F.lit("/"), F.floor(F.col("doc_id") / 500), F.lit("/"), F.col("doc_id"), F.lit(".txt"))).alias("path"))


def licence_query(spark, sf_dir):
    """op2: licences of all ``documents``."""
    return scan(placed(table(spark, sf_dir, "documents")))
