"""Licence scan: a trained paragraph classifier over sparse word n-grams, confirmed by template comparison.

Native: DataFrame functions and ``pyspark.ml`` only.

A paragraph is a line with a word. Features are the 1- to 3-word n-grams of the templates below that hold a
telling word: any but ``GRAMMAR``, digits and single letters, whatever the corpus has often. A multinomial
logistic regression with an L1 penalty is fitted on varied templates (words dropped, corpus words before or
after) against the class "unknown": sentences that only sound like licences and sampled corpus paragraphs,
without those that resemble a template.
A second regression on variations not used for the first turns the margin of the best family over "unknown"
into a calibrated probability, families and "unknown" weighing the same; the paragraph is unknown below
``CERTAIN``, and wherever "unknown" scores higher. A prediction is confirmed when the paragraph's words agree
with a template of the family in ``ALIKE`` of the smaller word set; only confirmed ones are notices.
``MIT`` counts as the licence's name in capitals or before "license", so the German word is none.

A paragraph is scored if it has a word of every n-gram that can speak for a family; without one its margin
is at most that of no n-gram at all, which is unknown. Paragraphs
are scored once per distinct wording, so a notice that a third of all documents carry is scored once. All
that is broadcast is bounded by the templates, the fit by ``SAMPLE_DOCS`` and ``SAMPLE_LINES``.

Edge cases: null and empty texts have no paragraphs; repeated rows give repeated results; an empty table
gives no rows (the model is then fitted on the templates alone); further columns are not read.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import stage

UNKNOWN = "unknown"
MIT = "mitlicence"
SAMPLE_DOCS = 400
SAMPLE_LINES = 3000
VARIATIONS = 12
CERTAIN = 0.5
ALIKE = 0.6

# Public licence notices by family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license. See LICENSE for details.",
        "This project is distributed under the terms of the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements.",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the 2-clause BSD license.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Released under the GNU GPL version 2 or later.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GPLv3.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "Released under the LGPL version 3.",
        "Licensed under the Lesser GPL.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "Released under the MPL 2.0.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
        "Text is available under the Creative Commons Attribution License.",
        "Content licensed under CC BY 3.0.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "Licensed under CC BY-NC-SA 4.0 for noncommercial use only.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
        "SPDX-License-Identifier: Unlicense",
        "This work is dedicated to the public domain.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright 2020 The Company. All rights reserved.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
        "No part of this publication may be reproduced without prior written permission of the publisher.",
    ],
}
#: Sentences with licence words that are no licences.
LOOKALIKES = [
    "She studied physics at MIT and later taught in the general public school.",
    "The Apache helicopter landed next to the version of the bridge.",
    "He renewed his driver license under the old rules.",
    "The GNU project was announced to the public.",
    "Human rights were reserved for another meeting.",
    "A copy of the general report was released under pressure.",
    "The commons committee thanked the creative staff for its attribution of the source.",
    "The Mozilla browser shows the file.",
    "This work is a version of the program.",
    "The public library has a software section and its own terms.",
    "The fishing license office is in compliance with the law.",
    "The domain of the function is public.",
]
#: Words of the templates that tell nothing by themselves.
GRAMMAR = set(
    "above all along and any are at be by can except for has have http https if in into is it its may more neither no nor not"
    " of one only or org shall should that the this to under was with without www you".split()
)
#: Words that only licences have: a corpus line with one is no safe negative.
NAMES = ["bsd", "cc0", "gpl", "gplv3", "lgpl", "mpl", "sharealike", "spdx", "unlicense"]


def wording(text: Column) -> Column:
    """Lower-cased words separated by single spaces; the name MIT becomes a word of its own."""
    named = F.lower(F.replace(text, F.lit("MIT"), F.lit(MIT)))
    for gap in (" ", "-"):
        named = F.replace(named, F.lit(f"mit{gap}licen"), F.lit(f"{MIT}{gap}licen"))
    return F.trim(F.regexp_replace(named, r"[^\p{L}\p{N}]+", " "))


def grams(words: Column) -> Column:
    """All n-grams of one to three words, with repeats."""
    n = F.size(words)

    def of(k: int) -> Column:
        starts = F.when(n >= k, F.sequence(F.lit(1), n - F.lit(k - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, k), " "))

    return F.concat(*[of(k) for k in (1, 2, 3)])


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, paragraph`` (line number from 0) and ``wording`` of every line with a word."""
    lines = docs.select(F.col(key).cast("long").alias("doc_id"), F.posexplode(F.split(F.col(text).cast("string"), "\n")).alias("paragraph", "line"))
    return lines.select("doc_id", F.col("paragraph").cast("long"), wording(F.col("line")).alias("wording")).where("wording <> ''")


def _listed(spark: SparkSession, items: list[tuple[str, str]]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(a).alias("family"), wording(F.lit(b)).alias("wording")) for a, b in items])
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.family", "r.wording")


class Model:
    """Weights of n-grams by class, with the calibration of the margin."""

    def __init__(self, families: list[str], weights: dict[str, list[float]], bias: list[float], telling: list[str], scale: tuple[float, float]):
        self.families, self.weights, self.bias, self.telling, self.scale = families, weights, bias, telling, scale


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 5) -> Model:
    spark = docs.sparkSession
    chosen = docs.select(F.col(key).alias("_key")).where("_key is not null").distinct().orderBy(F.xxhash64("_key"), "_key").limit(SAMPLE_DOCS)
    some = docs.join(F.broadcast(chosen), docs[key] == chosen["_key"], "left_semi")
    lines = paragraphs(some, key, text).select("wording").distinct().orderBy(F.xxhash64("wording"), "wording").limit(SAMPLE_LINES)
    lines = stage(lines, "licence-lines")
    templates = _listed(spark, [(f, t) for f, ts in TEMPLATES.items() for t in ts])

    known = [set(r["wording"].split()) for r in templates.collect()]
    telling = sorted(w for w in set().union(*known) - GRAMMAR if len(w) > 1 and not w.isdigit())
    marks = F.array(*map(F.lit, telling))

    # Variations of the templates against corpus lines that resemble none.
    word, last = F.split("wording", " "), F.lit(VARIATIONS - 1)
    dice = lambda *salt: F.pmod(F.xxhash64("wording", "variation", *salt, F.lit(seed)), F.lit(100))
    kept = lambda w, i: (F.col("variation") == 0) | (F.pmod(F.xxhash64("wording", "variation", i, F.lit(seed)), F.lit(100)) >= 8)
    varied = templates.withColumn("variation", F.explode(F.sequence(F.lit(0), last))).withColumn("words", F.filter(word, kept))
    fillers = lines.select(F.slice(word, 1, 12).alias("w")).orderBy(F.xxhash64("wording", F.lit(seed)), "wording").limit(64)
    pool = [r["w"] for r in fillers.collect()] or [["the", "of"]]
    pool_column = F.array(*[F.array(*map(F.lit, w)) for w in pool])
    filler = F.element_at(pool_column, (F.pmod(F.xxhash64("wording", "variation"), F.lit(len(pool))) + 1).cast("int"))
    varied = varied.select(
        "family",
        F.when(dice(F.lit(1)) < 25, F.concat(filler, "words")).when(dice(F.lit(1)) < 50, F.concat("words", filler)).otherwise(F.col("words")).alias("words"),
        (F.col("variation") % 4 == 3).alias("held"),
    )
    negatives = lines.where(~_resembles(F.array_distinct(word), known, marks)).select(F.lit(UNKNOWN).alias("family"), word.alias("words"), (F.pmod(F.xxhash64("wording"), F.lit(4)) == 3).alias("held"))
    alike = _listed(spark, [(UNKNOWN, t) for t in LOOKALIKES]).select("family", word.alias("words"), F.explode(F.array(F.lit(False), F.lit(True))).alias("held"))
    families = [*TEMPLATES, UNKNOWN]
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    rows = varied.union(negatives).union(alike).select(number.cast("double").alias("label"), grams(F.col("words")).alias("grams"), "held")
    rows = stage(rows.coalesce(1), "licence-rows")

    has_mark = F.arrays_overlap(F.split("g", " "), marks)
    vocabulary = sorted(r["g"] for r in templates.select(F.explode(grams(word)).alias("g")).distinct().where(has_mark).collect())
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features")
    share = rows.groupBy("label").agg((1 / F.count(F.lit(1))).alias("weight"))
    vectors = counter.transform(rows.join(F.broadcast(share), "label"))
    learner = LogisticRegression(weightCol="weight", regParam=5e-5, elasticNetParam=0.9, maxIter=100, family="multinomial", standardization=False)
    fitted = learner.fit(vectors.where("not held"))
    matrix, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    weights = {g: matrix[:, i].tolist() for i, g in enumerate(vocabulary) if matrix[:, i].any()}

    raw = vector_to_array("rawPrediction")
    margin = F.array_max(F.slice(raw, 1, len(TEMPLATES))) - F.element_at(raw, -1)
    tried = fitted.transform(vectors.where("held")).select(
        (F.col("label") < len(TEMPLATES)).cast("double").alias("label"),
        array_to_vector(F.array(margin)).alias("features"),
        F.when(F.col("label") < len(TEMPLATES), F.col("weight") / len(TEMPLATES)).otherwise(F.col("weight")).alias("weight"),
    )
    platt = LogisticRegression(regParam=1e-3, maxIter=50, weightCol="weight").fit(tried)
    scale = (float(platt.coefficients[0]), float(platt.intercept))
    return Model(families, weights, bias.tolist(), _needed(weights, bias.tolist(), set(telling), scale), scale)


def _resembles(words: Column, known: list[set[str]], marks: Column) -> Column:
    """Whether a line has a licence's name, or is part of a template, alike, or has half of its telling words (two at least)."""
    templates = F.array(*[F.array(*map(F.lit, sorted(t))) for t in known])

    def like(t: Column) -> Column:
        own, telling = F.size(F.array_intersect(words, t)), F.array_intersect(t, marks)
        shared = F.size(F.array_intersect(words, telling))
        part = (own == F.size(words)) & (own >= 2) & (shared >= 1)
        alike = (own >= ALIKE * F.least(F.size(words), F.size(t))) & (shared >= 3)
        return part | alike | ((shared >= 2) & (2 * shared >= F.size(telling)))

    return F.arrays_overlap(words, F.array(*map(F.lit, NAMES))) | F.exists(templates, like)


def _needed(weights: dict[str, list[float]], bias: list[float], telling: set[str], scale: tuple[float, float]) -> list[str]:
    """Words one of which every paragraph that is no "unknown" has.

    Only n-grams that some family weighs above "unknown" raise a margin; each is there only if its longest
    telling word is. If no n-gram at all would already be certain, every n-gram counts.
    """
    margin = max(bias[:-1]) - bias[-1]
    exact = margin <= 0 or (scale[0] > 0 and 1 / (1 + math.exp(-(scale[0] * margin + scale[1]))) < CERTAIN)
    raising = [g for g, w in weights.items() if not exact or max(w[:-1]) > w[-1]]
    return sorted({max(telling & set(g.split()), key=lambda w: (len(w), w)) for g in raising})


def scan(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", confirmed_only: bool = True) -> DataFrame:
    """``doc_id, paragraph, family, probability, similarity, confirmed`` for every paragraph that is a licence notice.

    ``confirmed_only=False`` adds predictions that no template confirms.
    """
    spark = docs.sparkSession
    words = F.split("wording", " ")
    telling = F.arrays_overlap(words, F.array(*map(F.lit, model.telling))) if model.telling else F.lit(False)
    candidates = stage(paragraphs(docs, key, text).where(telling), "licence-candidates")
    listed = F.array(*[F.struct(F.lit(g).alias("gram"), F.array(*map(F.lit, w)).alias("w")) for g, w in sorted(model.weights.items())])
    weights = spark.range(1).select(F.explode(listed).alias("r")).select("r.gram", "r.w")
    classes = range(len(model.families))
    distinct = candidates.select("wording").distinct()
    scored = (
        distinct.select("wording", F.explode(grams(words)).alias("gram"))
        .join(F.broadcast(weights), "gram")
        .groupBy("wording")
        .agg(*[F.sum(F.col("w")[i]).alias(f"s{i}") for i in classes])
    )
    logits = [F.col(f"s{i}") + F.lit(model.bias[i]) for i in classes]
    best = F.array_max(F.array(*[F.struct(v.alias("score"), F.lit(f).alias("family")) for v, f in zip(logits[:-1], model.families)]))
    certain = 1 / (1 + F.exp(-(F.lit(model.scale[0]) * (F.col("best.score") - logits[-1]) + F.lit(model.scale[1]))))
    named = scored.withColumn("best", best).where(F.col("best.score") > logits[-1])
    named = named.select("wording", "best.family", certain.alias("probability")).where(F.col("probability") >= CERTAIN)
    forms = F.create_map(
        *[x for f, ts in TEMPLATES.items() for x in (F.lit(f), F.array(*[F.array_distinct(F.split(wording(F.lit(t)), " ")) for t in ts]))]
    )
    own = F.array_distinct(words)
    agree = lambda t: F.size(F.array_intersect(own, t)) / F.least(F.size(own), F.size(t))
    named = named.withColumn("similarity", F.array_max(F.transform(F.element_at(forms, F.col("family")), agree)))
    named = named.withColumn("confirmed", F.col("similarity") >= ALIKE)
    if confirmed_only:
        named = named.where("confirmed")
    return candidates.join(named, "wording").select("doc_id", "paragraph", "family", "probability", "similarity", "confirmed")
