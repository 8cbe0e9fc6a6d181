"""Licence scans by a trained paragraph classifier; DataFrame functions and Spark ML only.

A paragraph is a line with a word; neighbouring lines of at most ``WRAPPED`` characters are
also read together, as wrapped notices are, in windows of ``LINES`` lines that overlap by
half and end at blank and longer lines. Words and word pairs are hashed to a sparse vector;
a multinomial logistic regression with an L1 part gives the probability of each licence
family, of ``none`` (ordinary text) and of ``unknown`` (a licence of no known family). It is
trained here, on the families' templates with words left out, changed and added, on
sentences of unknown licences, and on a bounded sample of the corpus' own paragraphs.
Rows that were not trained on calibrate it: the temperature that makes the probabilities
fit, and below which probability a family is ``unknown``. A predicted family is then
confirmed by comparison with its templates; without that a line is ``unknown``, too, and a
window says nothing: it counts only for a confirmed family, whose lines are then not
``unknown`` any more. Windows without a word of licensing are not scored.
"""

from __future__ import annotations

import random

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestrel.llm.common import materialize

FEATURES = 1 << 13
WRAPPED, LINES = 120, 8
# Words without which no window is a notice.
LICENSING = ("licen[sc]e|licen[sc]ed|licen[sc]ing|copyright|copyleft|spdx|permission|permitted|redistribut\\w*|warranty|"
             "warranties|gnu|public domain|mozilla public|creative commons|conditions")
CONFIRMS = 0.6        # share of a template's words that confirms it
STRICT = 0.9          # least probability of a licence that no template confirms

# Notices of the licence families, and clauses of their texts that no other has.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: GPL-3.0-only",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/"],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
        "You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License.",
        "GNU LESSER GENERAL PUBLIC LICENSE",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
        "You should have received a copy of the GNU Lesser General Public License along with this library"],
    "agpl-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "GNU AFFERO GENERAL PUBLIC LICENSE",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "You should have received a copy of the GNU Affero General Public License along with this program"],
    "bsd": [
        "Distributed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0"],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal",
        "This work is dedicated to the public domain.",
        "SPDX-License-Identifier: CC0-1.0"],
}
UNKNOWN = [
    "All rights reserved. Unauthorized copying of this file is strictly prohibited.",
    "Licensed under the terms of the Example Community License, version 7.",
    "This software is proprietary and confidential and is provided under a licence agreement.",
    "Use of this content is governed by the publisher's licence terms.",
    "Released under our own source-available license.",
    "You may not copy, modify or distribute this work without the written permission of the copyright holder.",
    "SPDX-License-Identifier: LicenseRef-Custom",
]


def tokens(text: Column) -> Column:
    """Words (letters, digits and inner dots) in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*"), F.lit(0))


def grams(df: DataFrame) -> DataFrame:
    """Adds ``grams``: the distinct words and word pairs of the column ``words``."""
    pairs = F.expr("""transform(CASE WHEN size(words) < 2 THEN array() ELSE sequence(0, size(words) - 2) END,
                                i -> concat(words[i], ' ', words[i + 1]))""")
    return df.withColumn("grams", F.concat("words", pairs))


def training_rows(copies: int = 40, seed: int = 7) -> list[tuple[str, str, bool]]:
    """(text, family, held out for calibration): templates and altered copies of them."""
    rng, rows = random.Random(seed), []
    filler = "the of and in a to for with by on project file code work see notice package our this".split()
    for family, texts in [*TEMPLATES.items(), ("unknown", UNKNOWN)]:
        for text in texts:
            for i in range(copies):
                words = text.split()
                if i:
                    words = [w for w in words if len(words) < 6 or rng.random() > 0.06]
                    for _ in range(rng.randrange(10, 40) if i % 5 == 1 else rng.randrange(0, 4)):     # some amid other text
                        words.insert(rng.choice((0, len(words))), rng.choice(filler))
                rows.append((" ".join(words), family, i % 4 == 3))
    return rows


def train(spark: SparkSession, paragraphs: DataFrame, negatives: int):
    """(model, its labels in order, temperature, least probability of a family).
    ``paragraphs``: words, from which about ``negatives`` rows without a word of licensing
    are taken as ``none``, those whose hash is smallest."""
    labels = ["none", "unknown", *TEMPLATES]
    made = spark.createDataFrame(training_rows(), "text string, family string, spare boolean")
    made = made.select(tokens(F.col("text")).alias("words"), "family", "spare")
    n = paragraphs.count()
    spot = F.pmod(F.xxhash64("words"), F.lit(1_000_003)) / 1_000_003.0
    plain = (paragraphs.where(spot < min(1.0, negatives / max(1, n)))
             .where(~F.exists("words", lambda w: w.rlike("licen[sc]|copyright|spdx")))
             .select("words", F.lit("none").alias("family"), (F.pmod(F.xxhash64("words", F.lit(1)), F.lit(4)) == 0).alias("spare")))
    common = spark.createDataFrame([("the of and in a to",), ("",)], "text string").select(
        tokens(F.col("text")).alias("words"), F.lit("none").alias("family"), F.lit(False).alias("spare"))
    number = F.array_position(F.array(*map(F.lit, labels)), F.col("family")).cast("double") - 1
    rows = materialize(made.unionByName(plain).unionByName(common)
                       .select("words", number.alias("label"), "spare"), "licence-training").coalesce(2)
    rows = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True).transform(grams(rows))
    rows = rows.select("label", "spare", "features").cache()
    try:
        model = LogisticRegression(maxIter=25, regParam=1e-4, elasticNetParam=0.5, family="multinomial").fit(rows.where("NOT spare"))
    except Exception:
        rows.unpersist()
        raise
    spare = materialize(model.transform(rows.where("spare")).select("label", vector_to_array("rawPrediction").alias("z")),
                        "licence-spare")

    def softmax(t):
        top = F.array_max("z")
        e = F.transform("z", lambda v: F.exp((v - top) / t))
        return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, x: a + x))

    grid = [0.5, 1.0, 1.5, 2.0, 3.0]
    loss = spare.select(*[F.avg(-F.log(F.greatest(F.element_at(softmax(t), F.col("label").cast("int") + 1), F.lit(1e-12))))
                          .alias(str(i)) for i, t in enumerate(grid)]).first()
    temperature = min(zip((x if x is not None else 0.0 for x in loss), grid))[1]
    # the highest probability of a family that 99 % of other spare rows stay below
    family = F.array_max(F.slice(softmax(temperature), 3, len(TEMPLATES)))
    least = spare.where("label < 2").select(F.percentile_approx(family, 0.99)).first()[0]
    rows.unpersist()
    return model, labels, temperature, min(0.9, max(0.5, least or 0.5))


def windows(lines: Column) -> Column:
    """Array of (at, body): neighbouring short lines read together. A window begins at every
    ``LINES`` / 2-th line; blank and long lines part it."""
    short = F.transform(lines, lambda x: F.when(F.length(x) <= WRAPPED, x).otherwise(F.lit("")))
    starts = F.sequence(F.lit(0), F.greatest(F.size(lines) - 1, F.lit(0)), F.lit(LINES // 2))

    def one(i):
        block = F.array_join(F.transform(F.slice(short, i + 1, F.lit(LINES)),
                                         lambda x: F.when(x.rlike(r"[^\x20\x09-\x0D]"), x).otherwise(F.lit(""))), "\n")
        bodies = F.filter(F.split(block, "\n\n+"), lambda b: F.trim(b, F.lit("\n")).contains("\n")
                          & F.lower(b).rlike(rf"\b(?:{LICENSING})\b"))
        return F.transform(bodies, lambda b: F.struct(i.alias("at"), b.alias("body")))

    return F.flatten(F.transform(starts, one))


def scan(docs: DataFrame, negatives: int = 6000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_paragraphs (lines with a word), n_licensed (those that
    name a licence), licenses (all families found, in order, by comma; null for none), confidence (the
    greatest probability among them; null for none), n_wrapped (windows of lines that name one).

    Null, empty and blank texts have no paragraphs. Rows of one id and text are one
    document. Null ids come back null. Other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("t"),
                       F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1).alias("lines"))
    word = r"[^\x20\x09-\x0D]"
    alone = F.transform("lines", lambda x, i: F.struct(i.alias("at"), x.alias("body")))
    alone = F.transform(F.filter(alone, lambda x: x["body"].rlike(word)),
                        lambda x: F.struct(x["at"].alias("at"), x["body"].alias("body"), F.lit(False).alias("wrapped")))
    wrapped = F.transform(windows(F.col("lines")), lambda x: F.struct(x["at"].alias("at"), x["body"].alias("body"), F.lit(True).alias("wrapped")))
    units = rows.select("doc_id", "t", F.inline(F.concat(alone, wrapped))).select(
        "doc_id", "t", "at", "wrapped", tokens(F.col("body")).alias("words"))
    lines = rows.select(F.explode(F.filter("lines", lambda x: x.rlike(word))).alias("line"))
    model, labels, temperature, least = train(spark, lines.select(tokens(F.col("line")).alias("words")), negatives)

    hashed = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True).transform(grams(units))
    # only the raw scores are asked for; as a generator's output they are made once a
    # paragraph (a filter on them would else be pushed below and make them again)
    model = model.copy().setProbabilityCol("").setPredictionCol("")
    key = ["doc_id", "t", "at", "wrapped"]
    z = model.transform(hashed).select(*key, "words", F.explode(F.array(vector_to_array("rawPrediction"))).alias("z"))
    best = F.array_position("z", F.array_max("z")).cast("int")
    likely = z.where(best != 1).select(
        *key, "words", F.element_at(F.array(*map(F.lit, labels)), best).alias("family"),
        F.expr(f"1D / aggregate(z, 0D, (a, v) -> a + exp((v - array_max(z)) / {temperature}D))").alias("p"))
    templates = spark.createDataFrame([(f, t) for f, ts in TEMPLATES.items() for t in ts], "family string, text string")
    templates = (templates.select("family", F.array_distinct(tokens(F.col("text"))).alias("template"))
                 .groupBy("family").agg(F.collect_list("template").alias("templates")))
    # as many rows as there are families, whatever the corpus
    close = F.expr("coalesce(array_max(transform(templates, x -> size(array_intersect(x, words)) / size(x))), 0D)")
    sure = (F.col("p") >= least) & (close >= CONFIRMS)
    found = (likely.join(F.broadcast(templates), "family", "left")
             .select(*key, F.when(sure, F.col("family")).otherwise("unknown").alias("family"), "p",
                     (sure | (~F.col("wrapped") & (F.col("p") >= STRICT))).alias("is")).where("is").drop("is")
             .dropDuplicates([*key, "family"]))      # rows that repeat a document are that document
    # the hits of one document meet: lines that are unknown alone are known inside a window
    hits = found.groupBy("doc_id", "t").agg(F.collect_list(F.struct("at", "wrapped", "family", "p")).alias("hits"))
    over = F.filter("hits", lambda h: h["wrapped"])
    kept = F.filter("hits", lambda h: (h["family"] != "unknown") | ~F.exists(
        over, lambda w: (h["at"] >= w["at"]) & (h["at"] < w["at"] + LINES)))
    hits = hits.select(F.col("doc_id").alias("d"), "t", kept.alias("hits"))
    by_doc = materialize(hits.select(
        "d", "t", F.size(F.filter("hits", lambda h: ~h["wrapped"])).cast("long").alias("n"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["family"]))), ",").alias("licenses"),
        F.array_max(F.transform("hits", lambda h: h["p"])).alias("confidence"),
        F.size(F.array_distinct(F.transform(F.filter("hits", lambda h: h["wrapped"]), lambda h: h["at"]))).cast("long").alias("w")),
        "licences")
    every = rows.select("doc_id", "t", F.size(F.filter("lines", lambda x: x.rlike(word))).cast("long").alias("n_paragraphs"))
    out = every.join(by_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (every.t == by_doc.t), "left")
    return out.select("doc_id", "n_paragraphs", F.coalesce("n", F.lit(0)).alias("n_licensed"), "licenses", "confidence",
                      F.coalesce("w", F.lit(0)).alias("n_wrapped"))
