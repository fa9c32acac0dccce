"""Licence scan: a trained classifier of paragraphs, confirmed by template comparison.

Paragraphs are lines, and notices wrapped over several lines: lines are joined where the words on
either side of a line end follow each other in a template. Their word n-grams of one to three words go through a sparse multinomial
logistic regression whose classes are licence families and ``unknown``. Its features are
n-grams of the templates that hold an anchor, a template word that ordinary text hardly uses;
lines that resemble a template are not ordinary, and no template is without an anchor. A paragraph
without an anchor has no feature and is unknown without being scored. A family
is given where its calibrated probability reaches the threshold, and confirmed where the
paragraph holds enough of one of the family's templates.

Training is numpy on the templates and a bounded sample of lines. Scanning is DataFrame
operations only: equal paragraphs are scored once and the verdicts joined back, spread over
salts where they are too many to broadcast.

A joined paragraph is reported at its first line, if it is confirmed and none of its lines is for
its family; its unconfirmed lines of that family are then left out.

Defined results: null and empty texts have no paragraphs; rows without identifier are reported
with a null one, repeated rows each; ties between families go to the first in alphabetic order;
other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wirecount.llm.common import stored, text_of
from wirecount.operators.lookup import lookup_join

UNKNOWN = "unknown"
SIZES = (1, 2, 3)
#: Lines of ordinary text to learn from, and the longest text they are taken from.
SAMPLE, DRAWN = 2000, 4000
#: Forms made of each template, and the share of ordinary lines that may hold an anchor.
FORMS, COMMON = 24, 0.001
STEPS, RATE, SPARSE, HELD, CONFIRMED = 300, 2.0, 2e-4, 0.25, 0.6
#: A line is no ordinary text if so many of its trigrams, that share of them, or that share of a
#: template's trigrams are shared with a template.
LIKE, LIKE_SHARE = 3, 0.3

# Notices of licence families.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
        "ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0"),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission.",
        "Licensed under the BSD 3-Clause License.", "Released under the BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
        "Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC-BY-SA": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License.",
        "Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0"),
    "AGPL": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with "
        "this program.",
        "SPDX-License-Identifier: AGPL-3.0-only"),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-2.0-only"),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-or-later"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
        "Licensed under the ISC License.", "SPDX-License-Identifier: ISC"),
    "MIT": (
        "Released under the MIT License.", "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0"),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary.",
        "SPDX-License-Identifier: Unlicense"),
}
# Sentences near to licences that name none.
OTHERS = (
    "All rights reserved.", "Copyright 2020 by the authors. All rights reserved.",
    "The driving license was issued in the city.", "A license agreement must be signed first.",
    "You need written permission of the publisher to copy this work.",
    "See the license file for details.", "This version of the software is free for students.",
    "Use of this site is subject to the terms of service.", "The warranty covers two years.",
    "Creative people meet in the commons every week.", "Published by the foundation.",
    "Licensed under a proprietary license.", "The general public may visit on Sundays.",
    "Redistribution of land was the aim of the law.", "Distributed in the hope of peace.",
    "No part of this publication may be reproduced without prior written permission.",
)


def words_of(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def grams_of(words: list[str]) -> list[str]:
    return [" ".join(words[i:i + n]) for n in SIZES for i in range(len(words) - n + 1)]


def words_column(paragraph: Column) -> Column:
    return F.filter(F.split(F.lower(paragraph), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def grams_column(words: Column) -> Column:
    """All n-grams, with repeats; ``words`` must be a plain column."""
    parts = []
    for n in SIZES:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))
                        ).otherwise(F.array().cast("array<int>"))
        parts.append(F.transform(starts, _gram_at(words, n)))
    return F.concat(*parts)


def _gram_at(words: Column, n: int):
    return lambda i: F.array_join(F.slice(words, i, n), " ")


@dataclass
class Model:
    families: list[str]  # the classes but ``unknown``, which is the last
    anchors: list[str]
    weights: dict[str, list[float]]
    bias: list[float]
    temperature: float
    threshold: float


def _forms(text: str, prose: list[list[str]], rng) -> list[list[str]]:
    words, out = words_of(text), []
    for k in range(FORMS):
        form = [w for w in words if rng.random() > (0.0 if k < 4 else 0.08)] or words
        around = prose[int(rng.integers(len(prose)))] if prose and k % 3 == 2 else []
        cut = int(rng.integers(len(around) + 1)) if around else 0
        out.append(around[:cut][-12:] + form + around[cut:][:12])
    return out


def _trigrams(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(words, words[1:], words[2:]))


def _resembling():
    """Whether a line's words are those of a template or of a part of one."""
    each = [t for t in (_trigrams(words_of(x)) for texts in TEMPLATES.values() for x in texts) if t]
    every = set().union(*each)

    def resembles(words: list[str]) -> bool:
        own = _trigrams(words)
        shared = own & every
        return bool(shared) and (
            len(shared) >= LIKE or len(shared) >= LIKE_SHARE * len(own)
            or any(len(shared & t) >= LIKE_SHARE * len(t) for t in each))

    return resembles


def _anchors(held_by: dict[str, int], most: float) -> list[str]:
    """Template words that ordinary lines hardly hold; a template without one has its rarest."""
    found = set()
    for text in (t for texts in TEMPLATES.values() for t in texts):
        words = {w for w in words_of(text) if len(w) > 1}
        limit = max(most, min(held_by.get(w, 0) for w in words))
        found |= {w for w in words if held_by.get(w, 0) <= limit}
    return sorted(found)


def train(lines: list[str], seed: int = 13) -> Model:
    """Fit on the templates and a sample of ordinary lines."""
    rng = np.random.default_rng(seed)
    families = sorted(TEMPLATES)
    mentioned = re.compile(r"licen|copyright|spdx|warrant|public domain", re.I)
    resembles = _resembling()
    prose = [w for w in (words_of(x) for x in lines if not mentioned.search(x))
             if w and not resembles(w)]
    held_by: dict[str, int] = {}
    for words in prose:
        for w in set(words):
            held_by[w] = held_by.get(w, 0) + 1
    most = COMMON * max(1, len(prose))
    anchors = _anchors(held_by, most)
    known = set(anchors)
    vocabulary = sorted({g for texts in TEMPLATES.values() for t in texts
                         for g in grams_of(words_of(t)) if known & set(g.split())})
    number = {g: i for i, g in enumerate(vocabulary)}
    rows, goal = [], []
    for c, family in enumerate(families):
        for text in TEMPLATES[family]:
            forms = _forms(text, prose, rng)
            rows += forms
            goal += [c] * len(forms)
    for text in OTHERS:
        forms = _forms(text, prose, rng)
        rows += forms
        goal += [len(families)] * len(forms)
    plain = [prose[i] for i in rng.permutation(len(prose))[:400]]
    rows += plain
    goal += [len(families)] * len(plain)
    x = np.zeros((len(rows), len(vocabulary)), np.float32)
    for i, words in enumerate(rows):
        for g in grams_of(words):
            if g in number:
                x[i, number[g]] += 1
    goal = np.array(goal)
    order = rng.permutation(len(goal))
    held, learned = np.split(order, [int(len(order) * HELD)])
    weights = np.zeros((len(vocabulary), len(families) + 1), np.float32)
    bias = np.zeros(len(families) + 1, np.float32)
    truth = np.eye(len(families) + 1, dtype=np.float32)[goal[learned]]
    xl = x[learned]
    for _ in range(STEPS):
        error = (_softmax(xl @ weights + bias) - truth) / len(learned)
        weights -= RATE * (xl.T @ error)
        bias -= RATE * error.sum(axis=0)
        # Weights shrink towards zero and stay there: the model is sparse.
        weights = np.sign(weights) * np.maximum(np.abs(weights) - RATE * SPARSE, 0)
    logits, at = x[held] @ weights + bias, np.arange(len(held))
    grid = np.geomspace(0.1, 5, 30)
    loss = [-np.log(_softmax(logits / t)[at, goal[held]] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    shares = _softmax(logits / temperature)
    best = shares[:, :-1].max(axis=1)
    # The threshold with the fewest wrong verdicts on lines held back, unknown ones included.
    right = shares[:, :-1].argmax(axis=1) == goal[held]
    options = np.linspace(0.3, 0.9, 25)
    wrong = [((best >= t) & ~right).sum() + ((best < t) & right).sum() for t in options]
    kept = np.abs(weights).max(axis=1) > 0
    return Model(families, anchors,
                 {g: [round(float(v), 6) for v in weights[i]]
                  for g, i in number.items() if kept[i]},
                 [float(b) for b in bias], temperature, float(options[int(np.argmin(wrong))]))


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def sample(docs: DataFrame, key: str = "doc_id", text: str = "text") -> list[str]:
    """Lines of ordinary text: those of the first texts by the hash of their key.

    Only about twice the texts wanted pass the hash, so what tasks send to the driver does not
    grow with their number.
    """
    wanted, scale = SAMPLE // 4, 1 << 40
    order = F.pmod(F.xxhash64(key, F.lit(17)), F.lit(scale))
    fit = docs.where(F.length(text).between(1, DRAWN) & F.col(key).isNotNull())
    share = min(1.0, 2 * wanted / max(1, fit.count()))
    drawn = (fit.where(order <= int(share * scale))
             .select(order.alias("o"), F.col(text).alias("t"))
             .orderBy("o", "t").limit(wanted).collect())
    return [line for r in drawn for line in r["t"].split("\n")][:SAMPLE]


def _inline(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small frame out of a literal; its size is that of the templates."""
    return spark.range(1, numPartitions=1).select(
        F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def classify(paragraphs: DataFrame, model: Model) -> DataFrame:
    """``print, family, probability, similarity, confirmed`` of distinct paragraphs, given as
    ``print, words``, that hold an anchor."""
    spark, classes = paragraphs.sparkSession, len(model.families) + 1
    # A paragraph goes by its digest, so its n-grams do not carry it along.
    grams = paragraphs.select("print", F.explode(grams_column(F.col("words"))).alias("gram"))
    weights = _inline(spark, [{"gram": g, "w": w} for g, w in model.weights.items()],
                      "gram: string, w: array<double>")
    scored = grams.join(F.broadcast(weights), "gram").groupBy("print").agg(
        F.array(*(F.sum(F.col("w")[c]) for c in range(classes))).alias("sums"))
    powers = F.transform(F.arrays_zip("sums", F.array(*(F.lit(b) for b in model.bias)).alias("b")),
                         lambda z: (z["sums"] + z["b"]) / model.temperature)
    scored = scored.select("print", powers.alias("z"))
    shifted = scored.select("print", F.transform(
        "z", lambda v: F.exp(v - F.array_max("z"))).alias("e"))
    total = F.aggregate("e", F.lit(0.0), lambda a, v: a + v)
    known = F.slice("e", 1, classes - 1)
    best = shifted.select(
        "print", (F.array_max(known) / total).alias("probability"),
        F.element_at(F.array(*(F.lit(f) for f in model.families)),
                     F.array_position(known, F.array_max(known)).cast("int")).alias("guess"))
    best = best.withColumn("family", F.when(F.col("probability") >= model.threshold,
                                            F.col("guess")).otherwise(UNKNOWN)).drop("guess")
    # Template comparison: the share of a template's n-grams that the paragraph holds.
    parts, number = [], 0
    for family, texts in TEMPLATES.items():
        for text in texts:
            held = sorted(set(grams_of(words_of(text))))
            number += 1
            parts += [{"gram": g, "of": family, "template": number, "part": 1 / len(held)}
                      for g in held]
    templates = _inline(spark, parts, "gram: string, of: string, template: int, part: double")
    named = grams.distinct().join(best.where(F.col("family") != UNKNOWN), "print")
    likeness = (
        named.join(F.broadcast(templates), (named["gram"] == templates["gram"])
                   & (named["family"] == templates["of"]))
        .groupBy("print", "template").agg(F.sum("part").alias("held"))
        .groupBy("print").agg(F.max("held").alias("similarity")))
    similarity = F.coalesce("similarity", F.lit(0.0))
    return best.join(likeness, "print", "left").select(
        "print", "family", "probability", similarity.alias("similarity"),
        (similarity >= CONFIRMED).alias("confirmed"))


def _following() -> list[str]:
    """Word pairs that follow each other in a template, or with one word left out."""
    return sorted({f"{a} {b}" for texts in TEMPLATES.values() for t in texts
                   for words in [words_of(t)]
                   for a, b in [*zip(words, words[1:]), *zip(words, words[2:])]})


def scan(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, line, paragraph, family, probability, similarity, confirmed`` of every line that
    holds an anchor, and of joined lines; ``line`` counts from 0."""
    pairs = _following()
    texts = docs.select(F.col(key).alias("key"), F.split(text_of(text), "\n").alias("lines"))
    # The generator keeps the words one value, instead of a split repeated wherever they are used.
    worded = texts.withColumn("words", F.explode(F.array(F.transform("lines", words_column))))

    def starts(words, i):
        before = F.element_at("words", F.greatest(i, F.lit(1)))
        joins = F.concat_ws(" ", F.try_element_at(before, F.lit(-1)),
                            F.try_element_at(words, F.lit(1))).isin(pairs)
        return F.when((i == 0) | ~joins, i)

    first = F.filter(F.transform("words", starts), lambda i: i.isNotNull())
    cut = worded.withColumn("first", F.explode(F.array(first)))
    runs = cut.select("key", F.explode(F.transform("first", lambda a, j: F.struct(
        a.alias("start"),
        *(F.slice(c, a + 1, F.coalesce(F.try_element_at("first", j + 2), F.size("words")) - a)
          .alias(c) for c in ("lines", "words"))))).alias("run")).select("key", "run.*")
    known = F.array(*(F.lit(a) for a in model.anchors))
    # Few runs hold an anchor; kept in a table, the texts are read and split once.
    anchored = stored(runs.where(F.arrays_overlap(F.flatten("words"), known))
                      .withColumn("run", F.monotonically_increasing_id()))
    parts = anchored.select("key", "run", F.lit(False).alias("whole"), "start", F.posexplode(
        F.arrays_zip("lines", "words")).alias("at", "part")).select(
        "key", "run", "whole", (F.col("start") + F.col("at")).alias("line"),
        F.col("part.lines").alias("paragraph"), F.col("part.words").alias("words")).where(
        F.arrays_overlap("words", known))
    wholes = anchored.where(F.size("lines") > 1).select(
        "key", "run", F.lit(True).alias("whole"), F.col("start").alias("line"),
        F.array_join("lines", "\n").alias("paragraph"), F.flatten("words").alias("words"))
    units = stored(parts.unionByName(wholes).withColumn("print", F.sha2("paragraph", 256)))
    verdicts = classify(units.select("print", "words").distinct(), model)
    found = stored(lookup_join(units.drop("words"), verdicts, ["print"],
                               spread_by=["key", "line"]))
    # A run is a part of one text; only its verdicts meet.
    joined = found.where("whole AND confirmed").select("run", F.col("family").alias("of"))
    alone = found.where("NOT whole AND confirmed").select("run", F.col("family").alias("of"))
    reported = stored(joined.join(alone.distinct(), ["run", "of"], "left_anti"))
    lines = found.where("NOT whole").join(
        reported, (found["run"] == reported["run"]) & (found["family"] == reported["of"])
        & ~found["confirmed"], "left_anti")
    wanted = found.where("whole").join(reported.select("run"), "run", "left_semi")
    return lines.unionByName(wanted).select(
        F.col("key").alias(key), "line", "paragraph", "family", "probability", "similarity",
        "confirmed")
