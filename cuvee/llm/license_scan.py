"""License scans: a paragraph classifier names the licence family, and a comparison with the family's notices confirms it.

A paragraph is a line of the text. Features are its words and pairs of words, as far as training has seen them; the model is a multinomial logistic
regression over the families and "unknown". The probabilities are calibrated on held-out paragraphs (one temperature), and a paragraph gets
a family only above a threshold that at most ``false_rate`` of the held-out unknown paragraphs pass. Built-in functions and
``pyspark.ml`` only; scanning is one pass without a shuffle.

Training rows: shortened and thinned variants of ``NOTICES``, and paragraphs of ``Settings.documents`` documents that share few word
pairs with any notice.

Cases: a null or empty text has no paragraphs with words; rows with null or repeated ids are each scanned; an empty table gives no rows (and
trains on the notices alone); other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuvee.functions.text import let
from cuvee.runtime import materialize

UNKNOWN = "unknown"
#: Short notices as they stand in texts. Fixed values.
NOTICES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is distributed under the Apache License 2.0.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
        "Licensed under the GNU GPL version 2 or later.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Distributed under the terms of the GNU Lesser General Public License.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Content is available under CC BY 3.0.",
    ],
    "cc-by-sa": [
        "This text is available under the Creative Commons Attribution-ShareAlike License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "public-domain": [
        "This work has been dedicated to the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright by the author. All rights reserved.",
        "No part of this publication may be reproduced without prior written permission of the publisher.",
    ],
}
FAMILIES = [UNKNOWN, *NOTICES]


@dataclass(frozen=True)
class Settings:
    #: Variants of each notice in training.
    variants: int = 40
    #: Documents whose paragraphs are training rows of the unknown class, at most.
    documents: int = 600
    #: N-grams the model knows at most.
    vocabulary: int = 6000
    penalty: float = 2e-4
    #: Share of unknown held-out paragraphs that may get a family.
    false_rate: float = 0.001
    #: Least share of the paragraph's or the notice's word pairs that they have in common.
    similarity: float = 0.5
    temperatures: tuple[float, ...] = (0.5, 0.7, 0.85, 1.0, 1.2, 1.5, 2.0, 3.0)


@dataclass(frozen=True)
class LicenseModel:
    terms: CountVectorizerModel
    regression: LogisticRegressionModel
    temperature: float
    threshold: float
    settings: Settings


def words(paragraph: Column) -> Column:
    return F.filter(F.split(F.lower(paragraph), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def pairs(w: Column) -> Column:
    """Two-word runs; the only word of a paragraph of one."""
    run = let(w, lambda x: F.transform(F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0))), lambda a, i: F.concat_ws(" ", a, F.get(x, i + 1))))
    return F.when(F.size(w) > 1, run).otherwise(w)


def grams(w: Column) -> Column:
    return let(w, lambda x: F.concat(x, pairs(x)))


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, paragraph, w) of the lines with words, numbered from 0 with all lines."""
    lines = docs.select(F.col(key).alias("key"), F.posexplode(F.split(F.col(text).cast("string"), "\n")).alias("paragraph", "line"))
    return _once(lines, ["key", "paragraph"], w=words(F.col("line"))).where(F.size("w") > 0)


def _once(rows: DataFrame, keep: list[str], **made: Column) -> DataFrame:
    """``rows`` with new columns that are worked out once, wherever later steps use them: an explode of one element."""
    one = F.array(F.struct(*[c.alias(n) for n, c in made.items()]))
    return rows.select(*keep, F.explode(one).alias("_made")).select(*keep, "_made.*")


def notice_words(notice: str) -> list[str]:
    """As ``words``, for a notice, which is ASCII."""
    return re.findall("[0-9a-z]+", notice.lower())


def notice_pairs(notice: str) -> list[str]:
    w = notice_words(notice)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:], strict=False)))


def _literals(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def training_rows(spark: SparkSession, docs: DataFrame, settings: Settings) -> DataFrame:
    """(label, w): variants of the notices, and paragraphs of a bounded number of documents as the unknown class."""
    listed = [
        F.struct(F.lit(FAMILIES.index(family)).alias("label"), _literals(notice_words(text)).alias("w"))
        for family, texts in NOTICES.items()
        for text in texts
    ]
    variants = spark.range(settings.variants).select(F.col("id").alias("v"), F.explode(F.array(*listed)).alias("x")).select("v", "x.*")
    first = F.when(F.col("v") % 4 == 3, F.pmod(F.xxhash64("w", "v"), F.greatest(F.size("w") - 3, F.lit(1)))).otherwise(F.lit(0))
    cut = F.slice("w", first.cast("int") + 1, F.size("w"))
    # The first variant is whole; from others up to three words in ten are missing.
    thinned = F.filter(
        F.transform(cut, lambda x, i: F.when(F.pmod(F.xxhash64(x, i, "v"), F.lit(10)) >= F.pmod(F.col("v"), F.lit(4)), x)),
        lambda x: x.isNotNull(),
    )
    positive = variants.select("label", thinned.alias("w")).where(F.size("w") > 1)

    known = _literals(sorted({p for texts in NOTICES.values() for t in texts for p in notice_pairs(t)}))
    total = docs.count()
    every = max(1, total // settings.documents)
    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).limit(2 * settings.documents)
    shared = F.size(F.array_intersect(pairs(F.col("w")), known))  # no notices among the unknown
    negative = paragraphs(chosen).where(shared * 3 < F.size("w")).select(F.lit(0).alias("label"), "w").distinct()
    return positive.unionByName(negative)


def train(spark: SparkSession, docs: DataFrame, settings: Settings = Settings()) -> LicenseModel:
    rows = materialize(training_rows(spark, docs, settings).withColumn("grams", grams(F.col("w"))), "license-rows")
    rows = rows.withColumn("label", F.col("label").cast("double")).withColumn("held", F.pmod(F.xxhash64("w"), F.lit(5)) == 0)
    fit, held = rows.where(~F.col("held")), rows.where("held")
    terms = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=settings.vocabulary, binary=True).fit(fit)
    regression = LogisticRegression(family="multinomial", regParam=settings.penalty, maxIter=80).fit(terms.transform(fit))
    raw = regression.transform(terms.transform(held)).select("label", vector_to_array("rawPrediction").alias("raw"))
    raw = materialize(raw, "held-out")
    of_label = [F.get(_softmax(F.col("raw"), t), F.col("label").cast("int")) for t in settings.temperatures]
    losses = raw.agg(*[F.avg(-F.log(p + 1e-12)).alias(f"t{i}") for i, p in enumerate(of_label)]).first()
    usable = [(losses[f"t{i}"], t) for i, t in enumerate(settings.temperatures) if losses[f"t{i}"] is not None]
    temperature = min(usable)[1] if usable else 1.0
    best = F.array_max(F.slice(_softmax(F.col("raw"), temperature), 2, len(FAMILIES)))
    passed = raw.where(F.col("label") == 0).agg(F.percentile(best, 1 - settings.false_rate).alias("q")).first()["q"]
    return LicenseModel(terms, regression, temperature, max(0.5, min(0.95, passed or 0.5)), settings)


def _softmax(raw: Column, temperature: float) -> Column:
    def shares(z: Column) -> Column:
        powers = let(F.array_max(z), lambda top: F.transform(z, lambda x: F.exp((x - top) / temperature)))
        return let(powers, lambda p: let(F.aggregate(p, F.lit(0.0), lambda a, b: a + b), lambda total: F.transform(p, lambda x: x / total)))

    return let(raw, shares)


def scan(docs: DataFrame, model: LicenseModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, paragraph, family, probability, similarity, confirmed) of the paragraphs that the model gives a family."""
    rows = _once(paragraphs(docs, key, text), ["key", "paragraph", "w"], grams=grams(F.col("w")))
    judged = model.regression.transform(model.terms.transform(rows))
    judged = _once(judged, ["key", "paragraph", "w"], raw=vector_to_array("rawPrediction"))
    # The family with the largest raw value; the first is the unknown class.
    best = F.array_position("raw", F.array_max("raw")).cast("int")
    named = _once(judged.where(best > 1), ["key", "paragraph", "w"], best=best, shares=_softmax(F.col("raw"), model.temperature))
    sure = _once(
        named.where(F.get("shares", F.col("best") - 1) >= model.threshold), ["key", "paragraph"],
        family=F.element_at(_literals(FAMILIES), F.col("best")), probability=F.get("shares", F.col("best") - 1), own=F.array_distinct(pairs(F.col("w"))),
    )
    similarity = F.lit(None).cast("double")
    for name, texts in NOTICES.items():
        of = [F.size(F.array_intersect("own", _literals(p))) / F.least(F.size("own"), F.lit(len(p))) for p in map(notice_pairs, texts)]
        similarity = F.when(F.col("family") == name, F.greatest(*of) if len(of) > 1 else of[0]).otherwise(similarity)
    return sure.withColumn("similarity", similarity).select(
        "key", "paragraph", "family", "probability", "similarity", (F.col("similarity") >= model.settings.similarity).alias("confirmed")
    )
