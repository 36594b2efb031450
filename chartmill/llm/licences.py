"""Licence detection with DataFrame operations only: TF-IDF cosine to templates, then inheritance by path.

Every line of a whole text that speaks of a licence is a header; a file that is named like a licence
file, or consists mostly of such lines, is a licence file, and its whole text is compared too.  Distinct
passages are compared once each.  Terms are lower-case words; a term's weight is its count times its
inverse document frequency among the templates, and terms no template has count in a passage's length.

A file's own licence is its best passage.  A file without one inherits from the licence files of its
nearest ancestor directory: directories, not files, are joined with all their ancestors.

Null or empty text has no licence of its own.  A file without a path inherits nothing.  Equal scores go
to the alphabetically first template.  Rows with the same path and text get the same result each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chartmill.llm.base import shielded

LEAST_COSINE = 0.6
MOSTLY = 0.5

# Usual notices and headers of public licences.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met. Licensed under the BSD 3-Clause License.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0. This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright. CC0 1.0 Universal public domain dedication."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. ISC License."),
    ("Proprietary", "Copyright. All rights reserved. No part may be reproduced without the written permission of the copyright owner."),
]
SIGNS = r"(?i)licen[cs]e|copyright|all rights reserved|\bpermission\b.*\b(granted|copy)|redistribution and use|terms of the .*public"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)(\.[a-z]+)?$"


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def templates(spark: SparkSession) -> DataFrame:
    rows = [(k, name, text) for k, (name, text) in enumerate(TEMPLATES)]
    return spark.createDataFrame(rows, "template int, licence string, text string")


def _model(known: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """Unit weights of template terms, inverse frequencies of terms, and that of an unknown term."""
    n = len(TEMPLATES)
    terms = known.select("template", "licence", F.explode(_terms(F.col("text"))).alias("term"))
    counts = terms.groupBy("template", "licence", "term").agg(F.count(F.lit(1)).alias("tf"))
    idf = counts.groupBy("term").agg((F.log((1 + n) / (1 + F.count(F.lit(1)))) + 1).alias("idf"))
    weighted = counts.join(F.broadcast(idf), "term").withColumn("w", F.col("tf") * F.col("idf"))
    norms = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    unit = weighted.join(F.broadcast(norms), "template").select("template", "licence", "term", (F.col("w") / F.col("norm")).alias("w"))
    return unit, idf, F.log(F.lit(1.0 + n)) + 1


def classify(passages: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """passage, licence, score of the distinct passages whose best cosine reaches ``least``.

    The templates are a fixed short list, so their terms are broadcast.
    """
    unit, idf, unknown = _model(templates(passages.sparkSession))
    terms = passages.select("passage").distinct().select("passage", F.explode(_terms(F.col("passage"))).alias("term"))
    counts = terms.groupBy("passage", "term").agg(F.count(F.lit(1)).alias("tf"))
    weighted = counts.join(F.broadcast(idf), "term", "left").withColumn("v", F.col("tf") * F.coalesce("idf", unknown))
    norms = weighted.groupBy("passage").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    dots = weighted.select("passage", "term", "v").join(F.broadcast(unit), "term").groupBy("passage", "template", "licence").agg(F.sum(F.col("v") * F.col("w")).alias("dot"))
    scored = dots.join(norms, "passage").withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= least)
    return scored.groupBy("passage").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("best")).select(
        "passage", F.col("best.licence").alias("licence"), (-F.col("best.s")).alias("score")
    )


def directory(path: Column) -> Column:
    """The folder of a path, the empty string at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


@shielded("path", "text", adds=("licence", "score", "origin", "origin_dir"))
def detect(files: DataFrame, path: str = "path", text: str = "text", least: float = LEAST_COSINE) -> DataFrame:
    """Add licence, score, origin ("own", "inherited" or null) and origin_dir to ``files``.

    All other columns pass unchanged.
    """
    keyed = files.withColumn("_path", F.col(path)).withColumn("_body", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    spoken = keyed.where(F.col(text).rlike(SIGNS) | (F.col("_path").rlike(LICENCE_FILE) & (F.length(text) > 0)))
    lines = F.filter(F.split(F.col(text), r"[\r\n]+"), lambda line: line.rlike(SIGNS))
    said = F.aggregate(lines, F.lit(0), lambda total, line: total + F.length(line))
    named = F.coalesce(F.col("_path").rlike(LICENCE_FILE), F.lit(False))
    spoken = spoken.select("_path", "_body", F.col(text).alias("_text"), lines.alias("_lines"), named.alias("_named"), (said >= MOSTLY * F.length(text)).alias("_mostly"))
    # What a text says depends on the text alone, so each distinct one is looked at once.
    bodies = spoken.dropDuplicates(["_body", "_named"])
    whole = F.when(F.col("_named") | F.col("_mostly"), F.array("_text")).otherwise(F.array().cast("array<string>"))
    passages = bodies.select("_body", "_named", F.explode(F.concat("_lines", whole)).alias("passage"))
    own = passages.join(classify(passages, least), "passage").groupBy("_body", "_named").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("best"))
    own = own.select("_body", "_named", F.col("best.licence").alias("_own"), (-F.col("best.s")).alias("_score"))

    licence_files = spoken.where((F.col("_named") | F.col("_mostly")) & F.col("_path").isNotNull()).select(directory(F.col("_path")).alias("dir"), "_body", "_named").distinct()
    granted = licence_files.join(own, ["_body", "_named"]).groupBy("dir").agg(F.min(F.struct((-F.col("_score")).alias("s"), F.col("_own").alias("licence"))).alias("best"))
    folders = keyed.where(F.col("_path").isNotNull()).select(directory(F.col("_path")).alias("_dir")).distinct()
    parts = F.split("_dir", "/")
    depths = F.sequence(F.lit(0), F.when(F.col("_dir") == "", 0).otherwise(F.size(parts)))
    ancestors = folders.select("_dir", F.explode(depths).alias("depth")).withColumn("dir", F.array_join(F.slice(parts, 1, F.col("depth")), "/"))
    nearest = ancestors.join(granted, "dir").groupBy("_dir").agg(F.max(F.struct("depth", "dir", "best")).alias("near"))
    nearest = nearest.select("_dir", F.col("near.dir").alias("_from"), F.col("near.best.licence").alias("_theirs"), (-F.col("near.best.s")).alias("_their_score"))

    rows = keyed.withColumn("_named", named).withColumn("_dir", directory(F.col("_path")))
    rows = rows.join(own, ["_body", "_named"], "left").join(nearest, "_dir", "left")
    mine = F.col("_own").isNotNull()
    return rows.select(
        *[F.col(f"`{c}`") for c in files.columns],
        F.coalesce("_own", "_theirs").alias("licence"), F.when(mine, F.col("_score")).otherwise(F.col("_their_score")).alias("score"),
        F.when(mine, F.lit("own")).when(F.col("_theirs").isNotNull(), F.lit("inherited")).alias("origin"),
        F.when(mine, F.col("_dir")).otherwise(F.col("_from")).alias("origin_dir"),
    )
