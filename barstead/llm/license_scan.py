"""Operator 7 (native): licence scan by a trained paragraph classifier.

A paragraph is a line, or a run of neighbouring lines without a blank line between, since real
notices are wrapped. The lines inside a run have at most ``WIDEST`` words together, the longest
notice's, and of its first and last line as many count, so each notice lies whole in some run,
wherever it is wrapped and whatever stands around it. The features of a paragraph are word one- to
three-grams of the notices below (binary, sparse) that hold at least one anchor. Anchors are notice
words that are rare in the corpus: they stand in ``COMMON`` of its different lines at most, counted
over all lines of all texts that aren't parts of notices, repeated ones once (by mergeable sketches, 5% off), so that a notice
that a third of the texts hold keeps its anchors. A paragraph without an anchor has no feature by
this definition and is unknown; texts without one are left out early, which is no further choice.

A multinomial logistic regression (Spark ML, L2) gives each licence family and an unknown class a
probability. Training rows are the notices with words left out, cut short or embedded in corpus
words, against a bounded sample of different lines of the corpus and shuffled notices as the
unknown class. A part held back calibrates one temperature, so that probabilities mean what they
say. A predicted family counts only with ``CONFIDENT`` probability, and is confirmed by template
comparison: ``CONTAINED`` of the word three-grams of one of its notices stand in the paragraph.

Everything is DataFrame functions and Spark ML transformers; scoring needs no shuffle but the
final aggregate per document, whose rows are paragraphs with a predicted family only. Of these a
family counts, by their ends, those that share no line with one counted before; of two that end
together the shorter goes first. So a line that is predicted or confirmed alone always counts,
and the longer runs around it don't.

Bounds: the sample has ``SAMPLE_PARAGRAPHS`` different lines at most, picked by a bound on their
hash; the number of training rows is fixed by the notices. Prediction covers every line of every
text, and every run whose first and last line hold a notice word; without one, they add no feature
to the shorter run.

Defined results: ``n_paragraphs`` counts lines that aren't blank. A line without letters or digits
ends a run, as a blank one does. Notices of one family that share a line count once. Of families
with one probability the first in order of name is predicted. Null, empty and blank texts have no
paragraphs and no licence. A very long text is read whole, in one row. Repeated rows and null ids
get a row each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

# Usual notices of licence families, and paragraphs of their full texts.
NOTICES = {
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "Released under the AGPL v3 license.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is released under the Apache 2.0 license.",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD license.",
        "Use of this source code is governed by a BSD-style license",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "cc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 license.",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0",
        "Licensed under the Eclipse Public License 2.0.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Licensed under the GNU GPL v3 or later.",
        "Released under the GNU General Public License version 2.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the LGPL license.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This software is distributed under the terms of the MIT license.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "Licensed under the MIT License.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "reserved": [
        "All rights reserved.",
        "Copyright. All rights reserved.",
        "No part of this publication may be reproduced without the prior permission of the publisher. All rights reserved.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
}
#: What ``words`` finds in the notices, and the most in one of them.
NOTICE_WORDS = [re.findall("[a-z0-9]+", n.lower()) for texts in NOTICES.values() for n in texts]
WIDEST = max(map(len, NOTICE_WORDS))
KNOWN = sorted(set().union(*NOTICE_WORDS))
#: Notice words of some length: a line with fewer than three of them is no part of a notice.
CONTENT = [w for w in KNOWN if len(w) > 4]
PIECES = sorted({" ".join(n[i : i + 3]) for n in NOTICE_WORDS for i in range(len(n) - 2)})
UNKNOWN = "unknown"
SAMPLE_PARAGRAPHS = 4000
VARIANTS = 24
#: Share of the corpus's different lines above which a notice word is too common for an anchor.
COMMON = 0.002
CONFIDENT = 0.6
CONTAINED = 0.6
#: Strings that mark corpus lines that are no clean example of the unknown class.
MARKERS = ("license", "licence", "copyright", "rights reserved", "creative commons", "redistribut", "hereby granted", "public domain", "warrant")


def words(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(r"[a-z0-9À-ɏ]+"), F.lit(0))


def grams(w: Column, n: int) -> Column:
    """Runs of n words; none where there are fewer."""
    count = F.size(w) - (n - 1)
    at = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.transform(at, lambda i: F.array_join(F.slice(w, i, n), " "))


def grams_of(column: str) -> Column:
    return F.concat(column, grams(F.col(column), 2), grams(F.col(column), 3))


def with_grams(rows: DataFrame, paragraph: str = "paragraph") -> DataFrame:
    return rows.withColumn("words", words(F.col(paragraph))).withColumn("grams", grams_of("words"))


def paragraphs(docs: DataFrame) -> DataFrame:
    """A row per line that holds a word, beside the other columns of its document."""
    keep = [c for c in docs.columns if c != "text"]
    lines = F.filter(F.split("text", "\n"), lambda p: p.rlike(C.WORD))
    return docs.select(*keep, F.explode(lines).alias("paragraph"))


def runs(docs: DataFrame, anchors: list[str]) -> DataFrame:
    """A row per line and run of lines with an anchor: first, last, words, beside the other columns of its document.

    Each step is a column that the next one names more than once, and rows are left out by empty
    arrays: inlined or pushed down as a filter, an expression would run again for each element.
    """
    keep = [c for c in docs.columns if c != "text"]
    docs = docs.filter(F.exists(words(F.col("text")), lambda x: x.isin(anchors)))
    holds = lambda those: F.transform("_w", lambda w: F.exists(w, lambda x: x.isin(those)))
    rows = docs.withColumn("_w", F.transform(F.split("text", "\n"), words))
    rows = rows.withColumn("_size", F.transform("_w", F.size)).withColumn("_anchor", holds(anchors)).withColumn("_notice", holds(KNOWN))

    def last(i: Column) -> Column:
        """The last line of the longest run that line i begins: further lines, until one is empty or the lines inside are too wide."""
        more = F.slice("_size", i + 1, WIDEST + 2)
        state = lambda far, inside, on: F.struct(far.cast("int").alias("far"), inside.cast("int").alias("inside"), on.alias("on"))

        def step(a: Column, n: Column) -> Column:
            on = a["on"] & (n > 0) & (a["inside"] <= WIDEST)
            return state(a["far"] + on.cast("int"), a["inside"] + n, on)

        return F.aggregate(more, state(i, F.lit(0), F.lit(True)), step)["far"]

    def joined(i: Column, j: Column) -> Column:
        first, final = F.get("_w", i - 1), F.get("_w", j - 1)
        head = F.slice(first, F.greatest(F.size(first) - (WIDEST - 1), F.lit(1)), WIDEST)
        return F.when(i == j, first).otherwise(F.concat(head, F.flatten(F.slice("_w", i + 1, j - i - 1)), F.slice(final, 1, WIDEST)))

    def of(i: Column) -> Column:
        wide = lambda j: F.get("_notice", j - 1) & F.exists(F.slice("_anchor", i, j - i + 1), lambda x: x)
        return F.transform(F.filter(F.sequence(i, last(i)), wide), lambda j: F.struct(i.alias("first"), j.alias("last"), joined(i, j).alias("words")))

    begins = F.filter(F.sequence(F.lit(1), F.size("_w")), lambda i: F.get("_notice", i - 1))
    rows = rows.withColumn("_begins", F.when(F.array_contains("_anchor", True), begins))
    return rows.select(*keep, F.inline(F.flatten(F.transform("_begins", of))))


def notice_rows(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(f).alias("family"), F.lit(n).alias("notice")) for f, texts in sorted(NOTICES.items()) for n in texts]
    return spark.range(1).select(F.inline(F.array(*rows)))


def told_apart(lines: DataFrame) -> DataFrame:
    """Of (paragraph, u), lines without licence words, with ``held`` (their notice words) and ``part``: whether they are parts of notices.

    Lines of a wrapped notice may hold no marker, but a notice's three-gram. Each step is a column that the next one names more than once.
    """
    marked = F.lit(False)
    for m in MARKERS:
        marked |= F.contains(F.lower("paragraph"), F.lit(m))
    # a list of literals is one hash set for all rows, an array of literals one for each
    known = lambda those: lambda x: x.isin(those)
    lines = lines.filter(~marked).withColumn("w", words(F.col("paragraph"))).withColumn("held", F.array_distinct(F.filter("w", known(KNOWN))))
    part = F.when(F.size(F.filter("held", known(CONTENT))) > 2, F.arrays_overlap(grams(F.col("w"), 3), F.lit(PIECES))).otherwise(F.lit(False))
    return lines.select("paragraph", "u", "held", part.alias("part"))


def sampled(docs: DataFrame, sample: int = SAMPLE_PARAGRAPHS) -> DataFrame:
    """Up to ``sample`` different plain lines of the corpus, the same ones in each run."""
    lines = paragraphs(docs.select("text")).withColumn("u", F.xxhash64("paragraph"))
    size = lines.agg(F.approx_count_distinct("u")).first()[0]
    # a hash bound keeps about three times the lines wanted before any of them moves
    near = C.materialise(lines.filter(F.pmod("u", F.lit(2**52)) / float(2**52) < (3 * sample + 200) / max(size, 1)).distinct(), "near")
    near = C.materialise(told_apart(near), "told").filter("not part")
    return C.materialise(near.select("paragraph", "u").orderBy("u", "paragraph").limit(sample), "sample")


def vocabulary(docs: DataFrame, share: float = COMMON) -> tuple[list[str], list[str]]:
    """Anchors, and the grams of the notices that hold one. Both are bounded by the notices; the counts cover all plain lines."""
    lines = told_apart(paragraphs(docs.select("text")).withColumn("u", F.xxhash64("paragraph")))
    # the empty word stands for all lines
    seen = lines.select("u", F.explode(F.when(~F.col("part"), F.array_append("held", F.lit("")))).alias("w")).groupBy("w").agg(F.approx_count_distinct("u").alias("n")).collect()
    size = max((r.n for r in seen if not r.w), default=0)
    common = {r.w for r in seen if r.w and r.n > share * size}
    anchors = [w for w in KNOWN if w not in common] or KNOWN
    of = with_grams(notice_rows(docs.sparkSession), "notice").select(F.explode("grams").alias("g")).distinct().collect()
    return anchors, sorted({r.g for r in of if not common.issuperset(r.g.split(" "))} or {r.g for r in of})


def training_rows(spark: SparkSession, lines: DataFrame, variants: int = VARIANTS) -> DataFrame:
    """(family, paragraph): varied notices, sampled corpus paragraphs, scrambled notices. Reruns agree."""
    notices = notice_rows(spark)
    varied = notices.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(variants - 1)))).withColumn("w", F.split("notice", " "))
    chance = lambda i, salt: F.pmod(F.xxhash64("notice", "v", i, F.lit(salt)), F.lit(1000)) / 1000.0
    # variant 0 is the notice itself; the others lose some words, and part of them their end
    kept = F.filter("w", lambda x, i: (F.col("v") == 0) | ((chance(i, 1) > 0.12) & ((F.col("v") % 3 != 1) | (i < 0.75 * F.size("w")))))
    noise = lines.select(F.pmod("u", F.lit(997)).alias("slot"), F.slice(F.split("paragraph", " "), 1, 12).alias("around")).groupBy("slot").agg(F.min("around").alias("around"))
    known = varied.withColumn("slot", F.pmod(F.xxhash64("notice", "v"), F.lit(997))).join(noise, "slot", "left")
    body = F.when(F.col("v") % 4 == 2, F.concat(F.coalesce("around", F.expr("cast(array() as array<string>)")), kept)).otherwise(kept)
    known = known.select(F.col("family").alias("family"), F.array_join(body, " ").alias("paragraph"))
    mixed = F.array_sort(F.transform("w", lambda x, i: F.struct(chance(i, 2).alias("r"), x.alias("x"))))
    mixed = F.array_join(F.transform(mixed, lambda s: F.lower(s["x"])), " ")
    scrambled = varied.filter("v between 1 and 2").select(F.lit(UNKNOWN).alias("family"), mixed.alias("paragraph"))
    short = varied.filter("v between 3 and 4").select(F.lit(UNKNOWN).alias("family"), F.array_join(F.slice("w", 1, 2), " ").alias("paragraph"))
    return known.unionByName(lines.select(F.lit(UNKNOWN).alias("family"), "paragraph")).unionByName(scrambled).unionByName(short)


class Model:
    """Classes in order, anchors, gram counter, regression and temperature."""

    def __init__(self, classes: list[str], anchors: list[str], counter: CountVectorizerModel, regression: LogisticRegressionModel, temperature: float):
        self.classes, self.anchors, self.counter, self.regression, self.temperature = classes, anchors, counter, regression, temperature

    def confident(self, rows: DataFrame, least: float) -> DataFrame:
        """Rows with grams whose family is known with ``least`` or more, with family and probability.

        The bound is applied inside the generator: as a filter it would be pushed down and the
        whole score computed again for each mention.
        """
        keep = [c for c in rows.columns if c != "grams"]
        scored = self.regression.transform(self.counter.transform(rows))
        scored = scored.select(*keep, F.transform(vector_to_array("rawPrediction"), lambda z: z / self.temperature).alias("_z"))
        scored = scored.withColumn("_top", F.array_max("_z"))
        scored = scored.withColumn("_p", 1 / F.aggregate(F.transform("_z", lambda z: F.exp(z - F.col("_top"))), F.lit(0.0), lambda a, x: a + x))
        family = F.element_at(F.lit(self.classes), F.array_position("_z", F.col("_top")).cast("int"))
        one = F.filter(F.array(F.struct(family.alias("family"), F.col("_p").alias("probability"))), lambda x: (x["family"] != UNKNOWN) & (x["probability"] >= least))
        return scored.select(*keep, F.explode(one).alias("_s")).select(*keep, "_s.family", "_s.probability")


def train(docs: DataFrame) -> Model:
    spark, classes = docs.sparkSession, sorted([*NOTICES, UNKNOWN])
    lines = sampled(docs)
    anchors, known = vocabulary(docs)
    counter = CountVectorizerModel.from_vocabulary(known, inputCol="grams", outputCol="features", binary=True)
    rows = with_grams(training_rows(spark, lines)).withColumn("label", F.array_position(F.lit(classes), F.col("family")).cast("double") - 1)
    rows = C.materialise(rows.withColumn("weight", F.when(F.col("family") == UNKNOWN, 0.5).otherwise(1.0)).withColumn("part", F.pmod(F.xxhash64("paragraph"), F.lit(5))), "training").coalesce(1)
    rows = counter.transform(rows)
    fit = LogisticRegression(maxIter=40, regParam=0.001, weightCol="weight", probabilityCol="probability_", family="multinomial").fit(rows.filter("part != 0"))
    held = fit.transform(rows.filter("part = 0")).select("label", vector_to_array("rawPrediction").alias("z"))
    top, own = F.array_max("z"), F.element_at("z", (F.col("label") + 1).cast("int"))
    total = lambda t: F.aggregate(F.transform("z", lambda z: F.exp((z - top) / t)), F.lit(0.0), lambda a, x: a + x)
    loss = lambda t: F.avg(F.log(total(t)) - (own - top) / t)
    grid = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)
    losses = held.agg(*(loss(t).alias(f"t{i}") for i, t in enumerate(grid))).first()
    best = min(range(len(grid)), key=lambda i: (losses[i] if losses[i] is not None else 0.0, abs(grid[i] - 1)))
    return Model(classes, anchors, counter, fit, grid[best])


def templates(spark: SparkSession) -> DataFrame:
    """(family, list of the notices' distinct three-grams): one row per family."""
    w = notice_rows(spark).withColumn("words", words(F.col("notice")))
    return w.groupBy("family").agg(F.collect_list(F.array_distinct(grams(F.col("words"), 3))).alias("templates"))


def licence_paragraphs(docs: DataFrame, model: Model) -> DataFrame:
    """Lines and runs of lines with a confirmed or merely predicted family: doc columns, first, last, family, probability, contained."""
    rows = model.confident(runs(docs, model.anchors).withColumn("grams", grams_of("words")), CONFIDENT)
    rows = rows.join(F.broadcast(templates(docs.sparkSession)), "family")  # a row per family
    own = grams(F.col("words"), 3)
    shares = F.transform("templates", lambda t: F.size(F.array_intersect(t, F.col("own"))) / F.greatest(F.size(t), F.lit(1)))
    return rows.withColumn("own", F.array_distinct(own)).withColumn("contained", F.array_max(shares)).drop("templates", "own", "words")


def counted(found: Column) -> Column:
    """Of paragraphs in order of their ends, how many of each family share no line with one counted before, and their best probability."""
    state = lambda end, n, best: F.struct(end.alias("end"), n.cast("long").alias("n"), best.alias("best"))

    def step(a: Column, x: Column) -> Column:
        free = x["first"] > a["end"]
        return state(F.when(free, x["last"]).otherwise(a["end"]), a["n"] + free.cast("long"), F.when(free, F.greatest(a["best"], x["probability"])).otherwise(a["best"]))

    of = lambda family: F.filter(found, lambda x: x["family"] == family)
    per = [F.aggregate(of(f), state(F.lit(0), F.lit(0), F.lit(None).cast("double")), step) for f in sorted(NOTICES)]
    return F.struct(sum((p["n"] for p in per[1:]), per[0]["n"]).alias("n"), F.greatest(*(p["best"] for p in per)).alias("best"))


def license_scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row: doc_id, n_paragraphs, n_predicted, n_confirmed, families (confirmed, sorted), best_probability."""
    model = model or train(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("text_key"))
    count = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda p: p.rlike(C.WORD))).cast("long")
    found = licence_paragraphs(rows, model)
    # repeated rows put equal paragraphs under one key, a set holds each once
    one = F.struct("last", (-F.col("first")).alias("from"), "first", "family", "probability", (F.col("contained") >= CONTAINED).alias("good"))
    per = found.groupBy(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t")).agg(F.sort_array(F.collect_set(one)).alias("_all"))
    per = per.withColumn("_good", F.filter("_all", lambda x: x["good"])).withColumn("_predicted", counted(F.col("_all"))).withColumn("_confirmed", counted(F.col("_good")))
    families = F.array_join(F.sort_array(F.array_distinct(F.transform("_good", lambda x: x["family"]))), ",")
    counts = F.col("_predicted.n").alias("predicted"), F.col("_confirmed.n").alias("confirmed")
    per = per.select("_d", "_t", *counts, families.alias("families"), F.greatest("_predicted.best", "_confirmed.best").alias("best_probability"))
    base = rows.select("doc_id", "text_key", count.alias("n_paragraphs"))
    joined = base.join(per, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t")), "left")
    own = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    counts = own("predicted").alias("n_predicted"), own("confirmed").alias("n_confirmed")
    return joined.select("doc_id", "n_paragraphs", *counts, F.coalesce("families", F.lit("")).alias("families"), F.round("best_probability", 6).alias("best_probability"))


def op7_license_scan(spark, sf_dir):
    return license_scan(C.documents(spark, sf_dir))
