"""License scans: TF-IDF cosine to templates, then inheritance from the nearest directory.

Passages are the lines and blocks (neighbouring comment lines, or lines up to an empty
one) of a file that speak of a license, wherever they stand in it, and the whole text of
licence files (by name). An SPDX identifier names its license itself. Terms are lower-cased words and
pairs of neighbouring words; a term's weight is its count times its inverse document
frequency over all passages and templates. A passage takes the template of
highest cosine from ``THRESHOLD`` on; a file takes its best passage. A file without a
license of its own inherits that of the licence file in the nearest directory above.

Templates are a fixed small set, so the terms joined with passages are bounded; the
ancestors of a path are as many as its parts. Every aggregate is partial first.

Defined cases: a null or empty text has no license of its own; a null path inherits
nothing; equal cosines give the first license by name; several licence files in one
directory give the best cosine, then the first name; rows that repeat are judged each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Tables

THRESHOLD = 0.45

_HEADER = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General "
           "Public License as published by the Free Software Foundation; either version {} of the License, or (at your "
           "option) any later version.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS "
        "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED.")
_NEITHER = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission. ")
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_CC = "This work is licensed under a Creative Commons Attribution-{} 4.0 International License."

#: Notices by license (fixed values).
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License.", "Licensed under the Apache License, Version 2.0."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", "Redistribution and use in source and binary forms, with "
                     "or without modification, are permitted provided that the following conditions are met."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Neither the name of the copyright holder nor the names "
                     "of its contributors may be used to endorse or promote products derived from this software."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 "
                  "International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-ShareAlike 4.0 International License."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "you can redistribute it and/or "
                "modify it under the terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License"],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a "
            "copy of this software and associated documentation files"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "0BSD": [_ISC + ". The software is provided as is and the author disclaims all warranties with regard to this software."],
    "AGPL-3.0": [_HEADER.format("Affero ", 3), "GNU Affero General Public License Version 3, 19 November 2007"],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0.", _CC.format("NonCommercial-NoDerivatives")],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.", _CC.format("NonCommercial-ShareAlike")],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", _CC.format("NoDerivatives")],
    "CC0-1.0": ["Licensed under CC0 1.0.", "Creative Commons CC0 1.0 Universal public domain dedication."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License "
                "v. 2.0 which is available at https://www.eclipse.org/legal/epl-2.0", "Eclipse Public License - v 2.0"],
    "ISC": ["Licensed under the ISC License.", _ISC + ", provided that the above copyright notice and this permission notice "
            "appear in all copies."],
    "LGPL-2.1": [_HEADER.format("Lesser ", 2.1), "GNU Lesser General Public License Version 2.1, February 1999"],
    "Zlib": ["Licensed under the zlib License.", "This software is provided as-is, without any express or implied warranty. In "
             "no event will the authors be held liable for any damages arising from the use of this software. Permission is "
             "granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
             "redistribute it freely"],
}
for _license, _more in {
        "GPL-2.0": [_HEADER.format("", 2), "GNU General Public License Version 2, June 1991"],
        "GPL-3.0": [_HEADER.format("", 3), "GNU General Public License Version 3, 29 June 2007"],
        "LGPL-3.0": [_HEADER.format("Lesser ", 3), "GNU Lesser General Public License Version 3, 29 June 2007"],
        "BSD-2-Clause": [_BSD.format("")], "BSD-3-Clause": [_BSD.format(_NEITHER)]}.items():
    TEMPLATES[_license] += _more

SPEAKS = r"(?i)licen[sc]|copyright|permission is hereby|redistribution and use|public domain|spdx|permission to use|permission is granted|CC0"
SPDX = r"SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9][A-Za-z0-9.+-]*(?: (?:OR|AND|WITH) [A-Za-z0-9][A-Za-z0-9.+-]*)*)"
COMMENT = r"[ \t]*(?:#|//|/?\*|--|;|%|<!--)"
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|unlicense)([._-].*)?$"


def _terms(text: str) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([a-z]+|[0-9]+(?:\.[0-9]+)*)"), F.lit(1))


def _weighted(passages: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, term, tf) of (keys, words)."""
    pairs = F.zip_with("words", F.slice("words", 2, F.size("words")), lambda a, b: F.concat(a, F.lit(" "), b))
    terms = F.concat("words", F.filter(pairs, lambda x: x.isNotNull()))
    return (passages.select(*keys, F.explode(terms).alias("term"))
            .groupBy(*keys, "term").agg(F.count("*").cast("double").alias("tf")))


def scan_licenses(files: DataFrame) -> DataFrame:
    """Rows (file_id, path, license, cosine, inherited, from_dir) for each row (file_id, path, text)."""
    spark = files.sparkSession
    tables = Tables(spark, "licenses")
    name = F.element_at(F.split("path", "/"), -1)
    rows = files.select("file_id", "path", "text").withColumns({
        "dir": F.when(F.col("path").contains("/"), F.regexp_extract("path", r"^(.*)/[^/]*$", 1)).otherwise(
            F.when(F.col("path").isNotNull(), F.lit(""))),
        "is_licence": F.coalesce(name.rlike(LICENCE_FILE), F.lit(False))})
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: x.rlike(SPEAKS))
    # comment lines and others are parted, and so are paragraphs: an empty line, or one of signs alone, ends a block
    parted = F.regexp_replace(F.coalesce("text", F.lit("")), rf"(?m)^({COMMENT}[^\n]*)\n(?!{COMMENT})", "$1\n\n")
    parted = F.regexp_replace(parted, rf"(?m)^((?!{COMMENT})[^\n]*)\n(?={COMMENT})", "$1\n\n")
    blocks = F.filter(F.split(parted, r"\n[^\nA-Za-z0-9]*\n", -1), lambda x: x.rlike(SPEAKS))
    lines = F.concat(lines, blocks)
    found = F.when(F.col("is_licence"), F.concat(lines, F.array(F.coalesce("text", F.lit(""))))).otherwise(lines)
    spoken = rows.select("file_id", "path", "dir", "is_licence", F.array_distinct(found).alias("lines"))
    passages = (spoken.where(F.size("lines") > 0).select("file_id", "path", "dir", "is_licence",
                                                        F.explode("lines").alias("line"))
                .withColumn("passage", F.xxhash64("line")))
    passages = tables.put(passages, "passages")

    texts = passages.groupBy("passage").agg(F.first("line").alias("line"), F.count("*").alias("n"))
    texts = tables.put(texts.select("passage", "n", _terms("line").alias("words")), "texts")
    own = tables.put(_weighted(texts, ["passage", "n"]), "terms")
    notices = spark.createDataFrame([(k, i, t) for k, ts in TEMPLATES.items() for i, t in enumerate(ts)],
                                    "license string, part int, line string")
    notices = _weighted(notices.select("license", "part", _terms("line").alias("words")), ["license", "part"])
    total = texts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + sum(map(len, TEMPLATES.values()))
    df = (own.select("term", "n").unionByName(notices.select("term", F.lit(1).alias("n")))
          .groupBy("term").agg(F.sum("n").alias("df")))
    idf = tables.put(df.select("term", (F.log(F.lit(total + 1.0) / (F.col("df") + 1)) + 1).alias("idf")), "idf")

    def unit(terms: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
        weighted = terms.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
        return weighted, weighted.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    left, left_norm = unit(own, ["passage"])
    right, right_norm = unit(notices, ["license", "part"])
    right = tables.put(right.join(right_norm, ["license", "part"]).select(
        "license", "part", "term", (F.col("w") / F.col("norm")).alias("v")), "templates")
    best = (left.select("passage", "term", "w").join(F.broadcast(right), "term")  # a fixed set of short notices
            .groupBy("passage", "license", "part").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
            .join(left_norm, "passage").withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 9))
            .where(F.col("cosine") >= THRESHOLD).groupBy("passage")
            .agg(F.min(F.struct((-F.col("cosine")).alias("far"), "license")).alias("best")))
    best = tables.put(best.select("passage", "best.license", (-F.col("best.far")).alias("cosine")), "best")
    judged = passages.join(best, "passage", "left").withColumn("spdx", F.regexp_extract("line", SPDX, 1))
    named = F.regexp_replace("spdx", r"(-only|-or-later|\+)(?= |$)", "")
    judged = judged.withColumns({"license": F.when(F.col("spdx") != "", named).otherwise(F.col("license")),
                                 "cosine": F.when(F.col("spdx") != "", 1.0).otherwise(F.col("cosine"))})
    judged = judged.where("license is not null").select("file_id", "path", "dir", "is_licence", "license", "cosine")
    judged = tables.put(judged, "judged")

    first = F.min(F.struct((-F.col("cosine")).alias("far"), "license"))
    named = tables.put(judged.where("file_id is not null").groupBy("file_id", F.coalesce("path", F.lit("")).alias("p"))
                       .agg(first.alias("own")), "own")
    of_dir = judged.where("is_licence").groupBy("dir").agg(first.alias("of_dir"))
    parts = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    above = (rows.where("dir is not null").select("dir").distinct().withColumn("parts", parts)
             .select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size("parts")), lambda k: F.struct(
                 k.alias("depth"), F.array_join(F.slice("parts", 1, k), "/").alias("above")))).alias("x"))
             .select("dir", "x.*"))
    nearest = (above.join(of_dir.withColumnRenamed("dir", "above"), "above").groupBy("dir")
               .agg(F.max_by(F.struct("of_dir", "above"), "depth").alias("near")))
    nearest = tables.put(nearest, "nearest")
    tables.drop("texts", "terms", "idf", "templates", "best", "judged", "passages")
    out = (rows.select("file_id", "path", "dir").withColumn("p", F.coalesce("path", F.lit("")))
           .join(named, ["file_id", "p"], "left").join(nearest, "dir", "left"))
    inherited = F.col("own").isNull() & F.col("near").isNotNull()
    return out.select(
        "file_id", "path", F.coalesce("own.license", "near.of_dir.license").alias("license"),
        F.coalesce(-F.col("own.far"), -F.col("near.of_dir.far")).alias("cosine"), inherited.alias("inherited"),
        F.when(inherited, F.col("near.above")).alias("from_dir"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files (file_id, path, text): source, then directories of 512 and 64 ids.

    Every 64th id is the licence file of its directory, every 512th of the one above.
    """
    at = F.col("doc_id").cast("long")
    wide, narrow = F.floor(at / 512).cast("string"), F.floor(at / 64).cast("string")
    source = F.coalesce("source", F.lit("unknown"))
    path = (F.when(at % 512 == 0, F.concat_ws("/", source, wide, F.lit("LICENSE")))
            .when(at % 64 == 0, F.concat_ws("/", source, wide, narrow, F.lit("LICENSE")))
            .otherwise(F.concat_ws("/", source, wide, narrow, F.concat(at.cast("string"), F.lit(".txt")))))
    return docs.select(at.alias("file_id"), F.when(at.isNotNull(), path).alias("path"), "text")
