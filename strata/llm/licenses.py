"""Operator 9: licence scans by a trained paragraph classifier, in DataFrame functions and DataFrame ML only.

Every line is judged by itself first, so notices of one line that adjoin each
other or prose are told apart.  The lines between those found and between blank
lines (lines without a letter or digit, such as the frame of a comment) then form
paragraphs, joined without their comment marks, and a paragraph of several lines
is judged as a whole: a notice wrapped over lines is one.  A line or paragraph
that holds one of ``ANCHORS`` (every template does) goes through

* sparse counts of word 1- and 2-grams, over the n-grams of the templates;
* multinomial logistic regression over the families and the class unknown;
* a calibrated threshold: the family must be likelier than it is for all but
  ``FALSE_SHARE`` of unknown paragraphs that were kept out of the training, counted
  over all of them in ``STEPS`` steps;
* comparison with the family's templates, from both sides: the share of a
  template's n-grams that the paragraph has, the best template counts, at least
  ``CONFIRM``; and every word of a licence's name in the paragraph (the
  capitalised words before "License") is a word of the family's templates, so a
  licence of another name is not taken for a family that words its notice alike.

The model is fitted on the templates, on copies of them with words left out by
hash, and for the class unknown on every line and paragraph of the corpus that
holds an anchor, which are those that the scan judges: by a hash of its text one
half trains and the other sets the threshold.  However many they are, they weigh
``UNKNOWN_WEIGHT`` at most.  Those that a template explains, or that are a piece
of one (``EXPLAINED`` of the template's n-grams, or of their own), are no examples
of unknown.  Scanning covers whole texts.

Defined results: a wrapped notice gives one row with its first line's number and
``n_lines``, in place of its lines' rows; every other line with an anchor gives a
row of its own; null and empty texts have no paragraphs and so no rows; equal
paragraphs and repeated rows give a row each; an empty table gives no rows; a
tie of families goes to the first in the fixed order.
"""
from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.llm.common import cut

UNKNOWN = "unknown"
UNKNOWN_WEIGHT = 400.0  # of all unknown paragraphs together
ROW_WEIGHT = 0.2        # of one of them, while they are few
EXPLAINED = 0.5
FALSE_SHARE = 0.001
STEPS = 10_000
CONFIRM = 0.6
COPIES = 12
LEFT_OUT = 0.25

# Short notices of public licences, by family.
TEMPLATES = {
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0"),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Licensed under the BSD 3-Clause License.", "Released under the BSD License.", "SPDX-License-Identifier: BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    "Boost": (
        "Licensed under the Boost Software License, Version 1.0.", "Distributed under the Boost Software License, Version 1.0.", "SPDX-License-Identifier: BSL-1.0"),
    "CC-BY": (
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0 Universal.", "This work has been dedicated to the public domain.", "SPDX-License-Identifier: CC0-1.0"),
    "EPL": (
        "Licensed under the Eclipse Public License, Version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.", "SPDX-License-Identifier: EPL-2.0"),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.", "SPDX-License-Identifier: GPL-3.0-or-later"),
    "ISC": (
        "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later"),
    "MIT": (
        "Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0"),
    "Proprietary": (
        "All rights reserved.", "Copyright, all rights reserved.", "This software is proprietary and confidential.",
        "No part of this publication may be reproduced or distributed without the prior written permission of the copyright holder."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.", "Released under the Unlicense.", "SPDX-License-Identifier: Unlicense"),
}
FAMILIES = (UNKNOWN, *TEMPLATES)
ANCHORS = (r"licen[sc]|spdx|copyright|rights reserved|public domain|redistribut|creative commons|permission|confidential|\bcc[ -]?(?:by|0)\b|"
           r"\bgnu\b|apache\.org|mozilla|without warranty")
# capitalised words that end in "License": its name; words that may stand there in any notice
NAMED = r"((?:\p{Lu}[\p{L}\p{N}.+\x27-]*,? +){1,6})Licen[cs]e"
ANYWHERE = ("the", "this", "that", "a", "an", "your", "our", "such", "any", "see", "under", "of", "to", "and", "in", "by", "for", "software", "source", "code", "version", "v")


def grams(text: Column) -> Column:
    """1- and 2-grams of lower-cased words; digits become 0, so versions and years match."""
    tokens = F.filter(F.split(F.regexp_replace(F.lower(text), r"\d+(?:\.\d+)*", "0"), r"[^\p{L}0]+"), lambda w: w != "")
    pairs = F.zip_with(tokens, F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(tokens, F.slice(pairs, 1, F.greatest(F.size(tokens) - 1, F.lit(0))))


def templates(spark: SparkSession) -> DataFrame:
    """(family, label, text, grams) of every template."""
    rows = [F.struct(F.lit(family).alias("family"), F.lit(float(FAMILIES.index(family))).alias("label"), F.lit(text).alias("text"))
            for family, texts in TEMPLATES.items() for text in texts]
    return spark.range(1).select(F.inline(F.array(*rows))).withColumn("grams", grams(F.col("text")))


# an anchor of several words may be broken over lines, behind a comment mark
BROKEN = ANCHORS.replace("[ -]?", r"[^\p{L}\p{N}]*").replace(" ", r"[^\p{L}\p{N}]+")
MARKED = r"^\s*(?:/\*+|\*+/|<!--|//+|\*+|#+|--+|;+|%+|>+|\(\*|dnl\b|rem\b)?\s*|\s*(?:\*+/|-->|\*\))?\s*$"  # around a line


def anchored_texts(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The key columns, ``__text`` and ``__row`` of the texts that hold an anchor, be it broken over lines."""
    rows = df.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)], F.col(f"`{text}`").alias("__text"))
    return rows.filter(F.col("__text").rlike(rf"(?i)(?:{BROKEN})")).withColumn("__row", F.monotonically_increasing_id())


def single_lines(rows: DataFrame) -> DataFrame:
    """``paragraph`` (line number from 0), n_lines and ``body`` of every line with an anchor."""
    lines = rows.select(*[c for c in rows.columns if c != "__text"], F.posexplode(F.split("__text", "\n")).alias("paragraph", "body"))
    return lines.filter(F.col("body").rlike(rf"(?i)(?:{ANCHORS})")).withColumn("n_lines", F.lit(1))


def wrapped(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """``paragraph`` (its first line), n_lines and ``body`` of every run of two or more lines with an anchor, apart from the lines ``taken`` (__row, paragraph)."""
    gone = taken.groupBy("__row").agg(F.collect_set("paragraph").alias("__gone"))  # lines of one text
    rows = rows.join(gone, "__row", "left").withColumn("__gone", F.coalesce("__gone", F.array().cast("array<int>")))
    lines = F.transform(F.split("__text", "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("line")))
    kept = F.filter(lines, lambda x: x["line"].rlike(r"[\p{L}\p{N}]") & ~F.array_contains("__gone", x["i"]))
    keys = [c for c in rows.columns if c.startswith("__k")]
    apart = rows.select("__row", *keys, F.posexplode(kept).alias("__j", "__line"))
    apart = apart.groupBy("__row", (F.col("__line.i") - F.col("__j")).alias("__run")).agg(  # equal along consecutive lines
        *[F.first(k).alias(k) for k in keys], F.sort_array(F.collect_list("__line")).alias("__lines"))
    body = F.array_join(F.transform("__lines", lambda x: F.regexp_replace(x["line"], f"(?i){MARKED}", "")), " ")
    apart = apart.select("__row", *keys, F.col("__lines")[0]["i"].alias("paragraph"), F.size("__lines").alias("n_lines"), body.alias("body"))
    return apart.filter((F.col("n_lines") > 1) & F.col("body").rlike(rf"(?i)(?:{ANCHORS})"))


def unknown_paragraphs(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(o, grams) of every line and paragraph of ``rows`` with an anchor that no template explains; ``o`` is a hash of its text."""
    fixed = templates(spark).select("family", F.col("grams").alias("t_grams"))
    explained = (F.col("similarity") >= EXPLAINED) | (F.col("inside") >= EXPLAINED)

    def told(found: DataFrame) -> DataFrame:
        found = found.select("__row", "paragraph", F.xxhash64("body").alias("o"), grams(F.col("body")).alias("grams"))
        return compared(found.filter(F.size("grams") > 0), fixed).withColumn("explained", explained).drop("similarity", "inside")

    lines = cut(spark, told(single_lines(rows)), "licence-told-lines")
    paragraphs = told(wrapped(rows, lines.filter("explained").select("__row", "paragraph")))
    return lines.union(paragraphs).filter("NOT explained").select("o", "grams")


class Model:
    """Vectoriser, classifier and the calibrated threshold."""

    def __init__(self, vectoriser: CountVectorizerModel, classifier: LogisticRegressionModel, threshold: float):
        self.vectoriser, self.classifier, self.threshold = vectoriser, classifier, threshold

    def probabilities(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with grams) plus ``p``, the probabilities by FAMILIES."""
        found = self.classifier.transform(self.vectoriser.transform(rows))
        return found.withColumn("p", vector_to_array("probability")).drop("features", "rawPrediction", "probability", "prediction")


def fit(spark: SparkSession, df: DataFrame, text: str = "text") -> Model:
    return fit_rows(spark, cut(spark, anchored_texts(df, [], text), "licence-texts"))


def fit_rows(spark: SparkSession, rows: DataFrame) -> Model:
    """The model of all texts of ``rows``, made by ``anchored_texts``."""
    fixed = templates(spark)
    vocabulary = sorted({g for row in fixed.select("grams").collect() for g in row.grams})  # of the fixed templates
    copies = fixed.select("label", F.explode(F.sequence(F.lit(0), F.lit(COPIES))).alias("copy"), "grams")
    kept = F.filter("grams", lambda g: (F.col("copy") == 0) | (F.pmod(F.xxhash64(g, F.col("copy")), F.lit(1000)) >= int(1000 * LEFT_OUT)))
    known = copies.select("label", kept.alias("grams"), F.lit(1.0).alias("weight"))
    unknown = cut(spark, unknown_paragraphs(spark, rows), "licence-unknown")
    trains = unknown.filter("pmod(o, 2) = 0")
    weight = min(ROW_WEIGHT, UNKNOWN_WEIGHT / max(1, trains.count()))
    generic = spark.range(1).select(F.lit(0.0).alias("label"), F.array().cast("array<string>").alias("grams"), F.lit(1.0).alias("weight"))
    train = known.union(generic).union(trains.select(F.lit(0.0).alias("label"), "grams", F.lit(weight).alias("weight")))
    vectoriser = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", minTF=1.0)
    train = cut(spark, vectoriser.transform(train), "licence-training")
    classifier = LogisticRegression(family="multinomial", regParam=0.002, maxIter=60, weightCol="weight", labelCol="label").fit(train)
    model = Model(vectoriser, classifier, 0.5)
    model.threshold = threshold(model.probabilities(unknown.filter("pmod(o, 2) = 1")))
    return model


def threshold(held: DataFrame) -> float:
    """The least of 0.5 to 0.9, in STEPS of 1, that all but FALSE_SHARE of the unknown paragraphs ``held`` (p) stay under."""
    step = F.floor(F.array_max(F.slice("p", 2, len(FAMILIES) - 1)) * STEPS).alias("step")
    counts = {r.step: r.many for r in held.groupBy(step).agg(F.count(F.lit(1)).alias("many")).collect()}  # at most STEPS + 1 rows
    allowed, above, at = FALSE_SHARE * sum(counts.values()), 0, STEPS
    while at >= STEPS // 2 and above + counts.get(at, 0) <= allowed:
        above += counts.get(at, 0)
        at -= 1
    return min(0.9, max(0.5, (at + 1) / STEPS))


def compared(rows: DataFrame, table: DataFrame, on: str | None = None) -> DataFrame:
    """``rows`` plus similarity: the best share of a template's n-grams that the row has, of all templates or of those of family ``on``.

    Of all templates, also ``inside``: the best share of the row's n-grams that a template has.
    """
    per = table.groupBy("family").agg(F.collect_list("t_grams").alias("t")) if on else table.groupBy().agg(F.collect_list("t_grams").alias("t"))
    joined = rows.join(F.broadcast(per), on) if on else rows.join(F.broadcast(per))  # the fixed templates
    joined = joined.withColumn("__common", F.transform("t", lambda t: F.struct(
        F.size(F.array_intersect(t, F.col("grams"))).alias("n"), F.size(F.array_distinct(t)).alias("of"))))
    joined = joined.withColumn("similarity", F.array_max(F.transform("__common", lambda c: c["n"] / c["of"])))
    if not on:
        joined = joined.withColumn("inside", F.array_max("__common.n") / F.size(F.array_distinct("grams")))
    if on:  # words of licence names that the family does not use
        named = F.flatten(F.transform(F.regexp_extract_all("body", F.lit(NAMED), F.lit(1)), lambda x: F.split(F.lower(x), r"[^\p{L}]+")))
        known = F.concat(F.flatten("t"), F.array(*[F.lit(w) for w in ("", *ANYWHERE)]))
        joined = joined.withColumn("own_name", F.size(F.array_except(named, known)) == 0)
    return joined.drop("t", "__common")


def judged(spark: SparkSession, rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (with body) plus family, probability, similarity and confirmed."""
    found = model.probabilities(rows.withColumn("grams", grams(F.col("body"))))
    best = F.array_max(F.slice("p", 2, len(FAMILIES) - 1))
    found = found.withColumn("probability", best)
    name = F.element_at(F.array(*[F.lit(f) for f in FAMILIES[1:]]), F.array_position(F.slice("p", 2, len(FAMILIES) - 1), F.col("probability")).cast("int"))
    found = found.withColumn("family", name)
    found = compared(found, templates(spark).select("family", F.col("grams").alias("t_grams")), "family")
    likely = (F.col("probability") >= model.threshold) & (F.col("probability") > F.element_at("p", 1))
    found = found.withColumn("confirmed", likely & (F.col("similarity") >= CONFIRM) & F.col("own_name")).drop("own_name")
    return found.withColumn("family", F.when(F.col("confirmed"), F.col("family")).otherwise(F.lit(UNKNOWN))).drop("p", "grams")


def scan(spark: SparkSession, df: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", model: Model | None = None) -> DataFrame:
    """The key columns, paragraph, n_lines, family, probability, similarity, confirmed and body of each line or paragraph with an anchor.

    ``family`` is unknown where no family is likely enough; ``confirmed`` tells whether the templates agree.
    """
    rows = cut(spark, anchored_texts(df, list(keys), text), "licence-texts")  # row numbers are now data and cannot change
    model = model or fit_rows(spark, rows)
    lines = cut(spark, judged(spark, single_lines(rows), model), "licence-lines")
    notices = cut(spark, judged(spark, wrapped(rows, lines.filter("confirmed").select("__row", "paragraph")), model).filter("confirmed"), "licence-wrapped")
    inside = notices.select("__row", F.explode(F.sequence("paragraph", F.col("paragraph") + F.col("n_lines") - 1)).alias("paragraph"))
    found = lines.join(inside, ["__row", "paragraph"], "left_anti").unionByName(notices)
    return found.select(*[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)], "paragraph", "n_lines", "family", "probability", "similarity", "confirmed", "body")
