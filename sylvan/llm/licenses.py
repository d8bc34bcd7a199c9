"""Licence scan: a trained paragraph classifier, DataFrame functions and Spark ML (JVM) only.

Method: multinomial logistic regression on sparse word n-grams (1 and 2
words) tells licence families from an unknown class; each family is scored
against the unknown class alone, so families do not compete, and the
threshold is calibrated on unknown rows kept from the fit; every family
above it is confirmed by comparing the text with the family's templates
(share of a template's n-grams that the text holds). A template that is held
in part counts only by n-grams that no better match of another family holds
nearby: a citation of version 3 is no citation of version 2.

A paragraph is scored in windows of ``WINDOW`` words that overlap by half,
so a long line reports each of its citations, whatever else stands in it.

A paragraph is a line. Features are n-grams of the templates. Only
paragraphs that pass a gate are scored. The gate loses nothing: of each
template it has so many n-grams that a paragraph without any of them cannot
hold the share that confirms the template. Which ones is a matter of speed
only (the rarest in the background), so no frequency switches a family off;
most paragraphs are settled by one overlap of word arrays.

Templates are names, fields with a bare identifier ("SPDX-License-Identifier:
MIT") and lines of the licences' own texts: of MIT, ISC and BSD the grant,
the conditions and the telling lines of the disclaimer, of the others
notices and first sentences. A line that the BSD licences share is of the
family ``bsd``.

Training: sentences made from the names and frames below, the fields and
lines of text as they are, and as unknown class the paragraphs of ``background_docs`` documents (those with the
smallest hash of their id) that no template confirms.

Defined cases: a null text has one empty paragraph; rows that share a
``doc_id`` are scanned each on its own; of equal matches of two families
the one that sorts first is the better; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.llm.common import bounded_sample, written

UNKNOWN = "unknown"
#: Share of a template's n-grams that confirms it.
LEAST = 0.7
#: Share of a partly held template's n-grams that must be its own.
OWN = 0.5
#: Words that are scored together; no template has more than half as many.
WINDOW = 64
# Names under which licences are cited, by family.
NAMES = {
    "agpl-3.0": ["GNU Affero General Public License, version 3", "AGPL-3.0", "AGPL v3", "Affero GPL version 3", "GNU Affero General Public License", "GNU Affero General Public License v3.0", "AGPLv3", "AGPL version 3"],
    "apache-2.0": ["Apache License, Version 2.0", "Apache-2.0", "Apache 2.0 license", "Apache License 2.0", "Apache Software License", "Apache License v2.0", "Apache License v2", "Apache v2 license"],
    "bsd-2-clause": ["BSD 2-Clause License", "BSD-2-Clause", "Simplified BSD License", "FreeBSD License"],
    "bsd-3-clause": ["BSD 3-Clause License", "BSD-3-Clause", "New BSD License", "Modified BSD License", "revised BSD license"],
    "cc-by-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC-BY-4.0", "Creative Commons Attribution 4.0", "Attribution 4.0 International"],
    "cc-by-nc-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0", "Attribution-NonCommercial 4.0 International"],
    "cc-by-nd-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License", "CC-BY-ND-4.0", "Attribution-NoDerivatives 4.0 International"],
    "cc-by-sa-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0", "Attribution-ShareAlike 4.0 International"],
    "cc0-1.0": ["CC0 1.0 Universal", "CC0-1.0", "Creative Commons Zero", "CC0 public domain dedication"],
    "epl-2.0": ["Eclipse Public License 2.0", "EPL-2.0", "Eclipse Public License, version 2.0", "Eclipse Public License v2.0", "Eclipse Public License v. 2.0", "EPL v2.0"],
    "gpl-2.0": ["GNU General Public License, version 2", "GPL-2.0", "GPLv2", "GNU GPL version 2", "GNU General Public License v2.0", "GNU General Public License v2", "GNU GPL v2", "GPL v2", "GPL version 2"],
    "gpl-3.0": ["GNU General Public License, version 3", "GPL-3.0", "GPLv3", "GNU GPL version 3", "GNU General Public License v3.0", "GNU General Public License v3", "GNU GPL v3", "GPL v3", "GPL version 3"],
    "isc": ["ISC License", "Internet Systems Consortium License"],
    "lgpl": ["GNU Lesser General Public License", "LGPL-3.0", "LGPL-2.1", "GNU Library General Public License", "GNU Lesser General Public License, version 3", "GNU Lesser General Public License, version 2.1",
             "GNU Lesser General Public License v3.0", "GNU Lesser General Public License v2.1", "LGPL-2.0", "LGPLv3", "LGPL v3", "LGPL version 3", "LGPL v2.1", "LGPL version 2.1"],
    "mit": ["MIT License", "The MIT License", "MIT/X11 license", "Expat License"],
    "mpl-2.0": ["Mozilla Public License 2.0", "MPL-2.0", "Mozilla Public License, version 2.0", "Mozilla Public License v2.0", "Mozilla Public License, v. 2.0", "MPL v2.0"],
    "unlicense": ["The Unlicense", "Unlicense"],
}
# Identifiers that are no name on their own; they count in a tag or field only.
IDENTIFIERS = {"isc": "ISC", "mit": "MIT"}
FIELDS = ["Identifier: {}", "License: {}"]
# Lines of the licences' own texts and notices, as they are wrapped in most copies. "bsd": those that do not tell 2 clauses from 3.
TEXTS = {
    "agpl-3.0": [
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works",
        "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "apache-2.0": [
        "you may not use this file except in compliance with the License", "Unless required by applicable law or agreed to in writing, software",
        'distributed under the License is distributed on an "AS IS" BASIS',
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright", "list of conditions and the following disclaimer", "Redistributions in binary form must reproduce the above copyright",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"', "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE",
    ],
    "bsd-3-clause": [
        "Neither the name of the copyright holder nor the names of its", "contributors may be used to endorse or promote products derived from",
        "this software without specific prior written permission",
    ],
    "cc0-1.0": ["The person who associated a work with this deed has dedicated the work to the public domain"],
    "epl-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "gpl-2.0": ["GNU General Public License as published by the Free Software Foundation; either version 2 of the License"],
    "gpl-3.0": [
        "The GNU General Public License is a free, copyleft license for software and other kinds of works",
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any", "purpose with or without fee is hereby granted, provided that the above",
        "copyright notice and this permission notice appear in all copies.", 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES',
        "WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF", "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS",
    ],
    "lgpl": [
        "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy", 'of this software and associated documentation files (the "Software"), to deal',
        "in the Software without restriction, including without limitation the rights", "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell",
        "copies of the Software, and to permit persons to whom the Software is", "furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all", "copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR', "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public", "If a copy of the MPL was not distributed with this"],
    "unlicense": ["This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or"],
}
FAMILIES = sorted({*NAMES, *TEXTS})
# Sentences that cite a licence, and sentences that only sound like one.
FRAMES = [
    "{}", "{}.", "Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "This work is licensed under the {}.",
    "This work is licensed under {}.", "This program is distributed under the terms of the {}.", "SPDX-License-Identifier: {}",
    "See the {} for details.", "The software is made available under the {}.", "Permission is granted under the {}.",
    "You may use this file under the {}; you may not use it otherwise.", "License: {}", "Published under {}",
]
OTHER = [
    "All rights reserved.", "The license of the driver was revoked.", "Copyright holders met in public.", "A general of the public library spoke.",
    "Version 2.0 was released by the team.", "Version 3 of the software is available.", "She got a license to teach.", "The commons were open to the public.",
    "Apache helicopters were seen.", "He studied at MIT.", "The eclipse was total.", "Mozilla held a conference.", "The attribution of the painting is uncertain.",
    "The GNU is a large antelope.", "Berkeley is a public university.", "This program is distributed to the public.", "See the terms of use for details.",
    "Permission is granted by the owner.", "This work is released under a pseudonym.", "by 4.0 percent", "The license expired.", "You may use this file.",
]


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def grams(ws: Column) -> Column:
    """Distinct words and word pairs."""
    pairs = F.transform(F.slice(ws, 2, F.greatest(F.size(ws) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", F.element_at(ws, i + 1), w))
    return F.array_distinct(F.concat(ws, pairs))


def windows(ws: Column) -> Column:
    """Overlapping stretches of ``WINDOW`` words; one if there are no more words than that."""
    half = WINDOW // 2
    last = F.greatest(F.ceil(F.size(ws) / half) - 2, F.lit(0))
    return F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: F.slice(ws, (i * half + 1).cast("int"), WINDOW))


def _rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table of fixed rows."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("_r")).select("_r.*")


def templates(spark: SparkSession) -> DataFrame:
    """``family, template, gram, parts``: the n-grams of each name, field and line of text, and how many it has."""
    by_family = [*NAMES.items(), *((f, [x.format(n) for x in FIELDS]) for f, n in IDENTIFIERS.items()), *TEXTS.items()]
    rows = [{"family": f, "template": f"{f}/{k}/{i}", "text": n} for k, (f, names) in enumerate(by_family) for i, n in enumerate(names)]
    t = _rows(spark, rows, "family string, template string, text string").withColumn("g", grams(words(F.col("text"))))
    return t.select("family", "template", F.explode("g").alias("gram"), F.size("g").alias("parts"))


@dataclass
class Model:
    classes: list[str]
    weights: list[dict]  # gram, w: one weight per class
    intercepts: list[float]
    gate: list[str]  # n-grams of which a paragraph that any template confirms holds one
    gate_words: list[str]  # a word of each of them
    threshold: float


def gate_of(parts: dict[str, list[str]], often: dict[str, float], least: float = LEAST) -> tuple[list[str], list[str]]:
    """The gate for templates ``parts`` (template: n-grams) and its words, for a background in which n-gram g has the share ``often[g]``.

    Who holds ``least`` of n n-grams lacks at most n - ceil(least * n), so one of any one more is held.
    """
    rare = lambda g: (often.get(g, 0), g)
    gate = {g for gs in parts.values() for g in sorted(gs, key=rare)[: len(gs) - math.ceil(least * len(gs) - 1e-9) + 1]}
    return sorted(gate), sorted({min(g.split(" "), key=rare) for g in gate})


def confirmed(found: DataFrame, keys: list[str], least: float = LEAST) -> DataFrame:
    """``keys, family, template, parts, held, share``: templates of which the rows of ``found`` (``keys, gram``) hold at least ``least``.

    The template table is fixed, so it is broadcast."""
    t = F.broadcast(templates(found.sparkSession))
    each = found.join(t, "gram").groupBy(*keys, "family", "template", "parts").agg(F.collect_list("gram").alias("held"))
    each = each.withColumn("share", F.size("held") / F.col("parts")).filter(F.col("share") >= least)
    return each.select(*keys, "family", "template", "parts", "held", "share")


def own(matches: DataFrame) -> DataFrame:
    """The ``matches`` (``uid, pos, win, family, template, parts, held, share, p``) that are whole, or that hold ``OWN`` of their template by
    n-grams that no better match of another family holds in the same window or one beside it.

    A group holds the matches of three windows, at most one for each template: it is bounded by the templates."""
    rank = F.struct("share", "p", (-F.array_position(F.array(*[F.lit(f) for f in FAMILIES]), F.col("family"))).alias("order"))
    m = F.struct("win", "family", "template", "parts", "held", "share", "p", rank.alias("rank"))
    near = matches.select("uid", "pos", m.alias("m"), F.explode(F.array(F.col("win") - 1, F.col("win"), F.col("win") + 1)).alias("at"))
    near = near.groupBy("uid", "pos", "at").agg(F.collect_list("m").alias("all"))
    one = near.select("uid", "pos", "at", "all", F.explode("all").alias("m")).filter(F.col("m.win") == F.col("at"))
    better = F.filter("all", lambda b: (b["family"] != F.col("m.family")) & (b["rank"] > F.col("m.rank")))
    left = F.array_except(F.col("m.held"), F.flatten(F.transform(better, lambda b: b["held"])))
    return one.filter((F.col("m.share") == 1) | (F.size(left) >= OWN * F.col("m.parts"))).select("uid", "pos", "m.family", "m.share", "m.p")


def train(docs: DataFrame, background_docs: int = 200) -> Model:
    spark = docs.sparkSession
    sample = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.lit(0).alias("one"))
    sample = bounded_sample(sample, "one", background_docs, "doc_id")
    paragraphs = sample.select(F.monotonically_increasing_id().alias("k"), F.explode(F.split("text", "\n")).alias("text"))
    paragraphs = paragraphs.select("k", "text", F.posexplode(windows(words(F.col("text")))).alias("win", "w"))
    paragraphs = written(paragraphs.select(F.concat_ws("/", F.col("k").cast("string"), F.xxhash64("text").cast("string"), F.col("win").cast("string")).alias("k"), grams(F.col("w")).alias("g")), "licence-background")
    known = templates(spark)
    parts: dict[str, list[str]] = defaultdict(list)
    for r in known.select("template", "gram").collect():  # fixed by the names above
        parts[r["template"]].append(r["gram"])
    vocabulary = sorted({g for gs in parts.values() for g in gs})
    held = paragraphs.select("k", F.explode("g").alias("gram")).join(F.broadcast(known.select("gram").distinct()), "gram")
    total = paragraphs.count()
    often = {r["gram"]: r["count"] / max(total, 1) for r in held.groupBy("gram").count().collect()}
    gate, gate_words = gate_of(parts, often)

    positive = [{"label": f, "text": s.format(n), "weight": 1.0} for f, names in NAMES.items() for n in names for s in FRAMES]
    # lines of text and fields have no frames: each weighs as much as a name in all of them
    alone = [*TEXTS.items(), *((f, [s + x.format(n) for x in FIELDS for s in ("", "SPDX-License-")]) for f, n in IDENTIFIERS.items())]
    positive += [{"label": f, "text": s, "weight": float(len(FRAMES))} for f, lines in alone for s in lines]
    negative = [{"label": UNKNOWN, "text": s, "weight": 1.0} for s in OTHER]
    rows = _rows(spark, positive + negative, "label string, text string, weight double").select("label", grams(words(F.col("text"))).alias("g"), "weight")
    clean = paragraphs.join(confirmed(held, ["k"]).select("k").distinct(), "k", "left_anti")
    rows = rows.unionByName(clean.select(F.lit(UNKNOWN).alias("label"), "g", F.lit(1.0).alias("weight")))
    classes = sorted([*FAMILIES, UNKNOWN])
    rows = rows.withColumn("y", F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("label")).cast("double") - 1)
    rows = written(rows.withColumn("aside", (F.col("label") == UNKNOWN) & (F.pmod(F.xxhash64(F.array_join("g", " ")), F.lit(5)) == 0)), "licence-rows")
    vector = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="g", outputCol="x", minTF=0.0)
    model = LogisticRegression(featuresCol="x", labelCol="y", weightCol="weight", family="multinomial", regParam=0.001, maxIter=60, standardization=False)
    fitted = model.fit(vector.transform(rows.filter(~F.col("aside"))).select("x", "y", "weight"))
    # calibration: above what any unknown row kept from the fit reaches
    scored = fitted.transform(vector.transform(rows.filter("aside")).select("x")).withColumn("p", vector_to_array("probability"))
    none = F.col("p")[classes.index(UNKNOWN)]
    licence = F.array_max(F.transform("p", lambda v, i: F.when(i == classes.index(UNKNOWN), 0.0).otherwise(v / (v + none))))
    highest = scored.agg(F.max(licence)).first()[0]
    matrix = fitted.coefficientMatrix.toArray()
    weights = [{"gram": g, "w": [float(v) for v in matrix[:, i]]} for i, g in enumerate(vocabulary)]
    return Model(classes, weights, [float(v) for v in fitted.interceptVector], gate, gate_words, min(0.9, max(0.5, (highest or 0) + 0.05)))


def scan_licences(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, n_paragraphs, n_licence, families, found`` for each input row.

    ``found``: sorted array of (paragraph, family, probability against the unknown class, share of the template), each family
    once a paragraph; ``n_licence``: paragraphs with any; ``families``: the distinct ones, sorted.
    """
    spark = docs.sparkSession
    model = model or train(docs)
    gate, gate_words = (F.array(*[F.lit(g) for g in gs]) for gs in (model.gate, model.gate_words))
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    some = F.filter(F.transform(F.col("_l"), lambda p, i: F.struct(i.alias("pos"), words(p).alias("w"))), lambda s: F.arrays_overlap(s["w"], gate_words))
    some = F.filter(some, lambda s: F.arrays_overlap(grams(s["w"]), gate))
    rows = docs.select("doc_id", lines.alias("_l")).select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.size("_l").cast("long").alias("n_paragraphs"), some.alias("some"))
    rows = written(rows, "licence-candidates")
    found = rows.filter(F.size("some") > 0).select("uid", F.explode("some").alias("s")).select("uid", "s.pos", F.posexplode(windows(F.col("s.w"))).alias("win", "w"))
    found = found.select("uid", "pos", "win", grams(F.col("w")).alias("g")).filter(F.arrays_overlap("g", gate)).select("uid", "pos", "win", F.explode("g").alias("gram"))
    weights = F.broadcast(_rows(spark, model.weights, "gram string, w array<double>"))  # as large as the vocabulary
    held = written(found.join(weights, "gram"), "licence-grams")
    u = model.classes.index(UNKNOWN)
    known = [i for i in range(len(model.classes)) if i != u]
    against = [(F.sum(F.col("w")[i] - F.col("w")[u]) + F.lit(model.intercepts[i] - model.intercepts[u])) for i in known]
    each = F.array(*[F.struct(F.lit(model.classes[i]).alias("family"), (1 / (1 + F.exp(-z))).alias("p")) for i, z in zip(known, against)])
    scored = held.groupBy("uid", "pos", "win").agg(each.alias("each")).select("uid", "pos", "win", F.explode("each").alias("s"))
    scored = scored.select("uid", "pos", "win", "s.family", "s.p").filter(F.col("p") >= model.threshold)
    keys = ["uid", "pos", "win"]
    sure = own(scored.join(confirmed(held.select(*keys, "gram"), keys), [*keys, "family"]))
    sure = sure.groupBy("uid", "pos", "family").agg(F.max("p").alias("p"), F.max("share").alias("share"))
    # a group is one document's findings, bounded by a row
    per_doc = sure.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("pos", "family", F.round("p", 6).alias("p"), "share"))).alias("found"))
    none = F.array().cast(per_doc.schema["found"].dataType)
    out = rows.join(per_doc, "uid", "left").withColumn("found", F.coalesce("found", none))
    each_once = lambda name: F.array_distinct(F.transform("found", lambda f: f[name]))
    families = F.array_join(F.array_sort(each_once("family")), ",")
    return out.select("doc_id", "n_paragraphs", F.size(each_once("pos")).cast("long").alias("n_licence"), families.alias("families"), "found")
