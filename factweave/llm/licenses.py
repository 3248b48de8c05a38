"""License scans: a trained paragraph classifier, confirmed by templates.  DataFrame operations only.

A softmax regression over word uni- and bigrams is trained on the driver from the templates below and from
ordinary prose; it is a table of n-gram weights whose size depends on the templates alone.  Paragraphs are
scored by a join with that table; the unknown class is calibrated on phrases with license words that name no family.
A prediction counts when the paragraph also contains enough of a template of the predicted family.
"""

from __future__ import annotations

import json
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "unknown"
#: Family -> names that identify it (fixed values).
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0 license"],
    "MIT": ["MIT License", "Expat License", "terms of the MIT license"],
    "BSD": ["BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "BSD-style license", "Simplified BSD License"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2", "GPL-2.0", "GPLv2", "GPL version 2", "GPL v2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3", "GPL-3.0", "GPLv3", "GPL version 3", "GPL v3"],
    "LGPL": ["GNU Lesser General Public License", "GNU Library General Public License", "LGPL"],
    "AGPL-3.0": ["GNU Affero General Public License", "AGPL-3.0", "AGPLv3"],
    "MPL-2.0": ["Mozilla Public License, v. 2.0", "Mozilla Public License", "MPL-2.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0-1.0": ["CC0 1.0 Universal", "Creative Commons Zero", "CC0 public domain dedication"],
    "ISC": ["ISC License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
#: Family -> paragraphs of its text or header that needn't name it (fixed values).
BODIES = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ],
    "GPL-2.0": ["GNU General Public License as published by the Free Software Foundation; either version 2"],
    "GPL-3.0": ["GNU General Public License as published by the Free Software Foundation, either version 3"],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
#: Sentences around a name (fixed values).
FRAMES = [
    "Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "Released under {}.", "This work is licensed under the {}.",
    "This work is licensed under {}.", "This program is distributed under the terms of the {}.", "Permission is granted under the {}.",
    "You may not use this file except in compliance with the {}.", "The source code is available under the {} license.", "License: {}", "See {} for details.",
    "Copyright holders make this available under the {}.", "{}", "is free software under the {}; see the file LICENSE.",
]
#: License words without a family, and ordinary sentences: the unknown class (fixed values).
OTHERS = [
    "He lost his driver's license last week.", "The bar was granted a liquor license.", "All rights reserved.", "A license is required to operate the machine.", "Poetic license is a virtue.",
    "Copyright 2009 by the author.", "This text may not be copied without permission.", "The public library is open in general on Mondays.", "The general said that the public was free.",
    "The software is licensed, not sold.", "Licensed physicians only.", "Version 2.0 of the program was released in 2004.", "Version 3 of the plan is under review.", "She studied at MIT in Boston.",
    "Apache helicopters were seen over the city.", "The Mozilla project began in 1998.", "Creative people are common here.", "Permission to speak was granted.", "The terms of the agreement are secret.",
    "It was released under a new name.", "This work is the best of the year.", "You may use this file as you like.", "The Berkeley campus is large.", "Attribution of the quote is uncertain.",
    "For commercial use ask the publisher.", "The lesser of two evils.", "Read the license terms before you sign.", "The work is licensed to the museum.", "A fishing license costs ten euros.",
    "Licensed under our own terms.", "Released under embargo.", "Sous licence.", "Unter Lizenz.", "Bajo licencia.",
]
#: License words: a line with one of them that is of no family counts as unknown.
GATE = r"(?i)licen[cs]|\bcc[ 0-]|creative commons|\b[al]?gpl|\bmpl-|apache-2|mozilla public|bsd-"
#: No template is confirmed without one of these, whatever stands between its words (a test counts them in every template).
CANDIDATE = r"(?i)licen[cs]|\bcc(?![a-z1-9])|commons|\b[al]?gpl|\bmpl|apache|mozilla|bsd|software|copyright|permi[st]|redistribut|merchantab|documentation|unencumbered|binary|disclaim|warrant|implied|liab|damages"
#: Lines without letters and digits (blank, or a bare comment mark) part paragraphs.
BLANK = r"(?:\r\n?|\n)(?:[^\p{L}\p{N}\r\n]*(?:\r\n?|\n))+"
TOKEN = r"[a-z0-9]+(?:\.[0-9]+)*"
ROUNDS, RATE, DECAY = 400, 2.0, 1e-4
#: Share of a template's words that a paragraph must hold in order, as bigrams.
CONFIRM = 0.99
#: The same for the longer texts of licenses, whose holders and clauses vary.
CONFIRM_BODY = 0.8


def tokens(text: str) -> list[str]:
    return re.findall(TOKEN, text.lower().replace("licence", "license"))


def grams(words: list[str]) -> list[str]:
    return sorted({*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))})


def train(seed: int = 1) -> dict:
    """Weights (n-gram -> one number a class), bias, temperature and the least probability of a prediction."""
    rng = random.Random(seed)
    classes = [UNKNOWN, *NAMES]
    rows: list[tuple[int, list[str]]] = [(0, grams(tokens(t))) for t in OTHERS]
    filler = sorted({w for t in OTHERS for w in tokens(t)})
    for k, family in enumerate(NAMES, 1):
        for name in NAMES[family]:
            for frame in FRAMES:
                rows.append((k, grams(tokens(frame.format(name)))))
                pad = rng.sample(filler, 6)
                rows.append((k, grams([*pad[:3], *tokens(frame.format(name)), *pad[3:]])))
    for k, family in enumerate(NAMES, 1):
        for body in BODIES.get(family, []):
            words = tokens(body)
            for _ in range(3):  # whole, and with some words lost or others around
                pad = rng.sample(filler, 6)
                rows += [(k, grams(words)), (k, grams([w for w in words if rng.random() > 0.05])), (k, grams([*pad[:3], *words, *pad[3:]]))]
    for frame in FRAMES:  # frames without a name are unknown
        for _ in range(12):
            rows.append((0, grams(tokens(frame.format(" ".join(rng.sample(filler, 3)))))))
    vocabulary = {g: i for i, g in enumerate(sorted({g for _, gs in rows for g in gs}))}
    held = [i for i in range(len(rows)) if i % 5 == 0]
    x = np.zeros((len(rows), len(vocabulary)))
    for i, (_, gs) in enumerate(rows):
        x[i, [vocabulary[g] for g in gs]] = 1.0
    y = np.array([k for k, _ in rows])
    share = 1.0 / np.bincount(y, minlength=len(classes))[y]
    share /= share.sum()
    w, b = np.zeros((len(vocabulary), len(classes))), np.zeros(len(classes))
    fit = np.setdiff1d(np.arange(len(rows)), held)
    gw, xf = np.zeros_like(w), x[fit]
    for _ in range(ROUNDS):
        z = xf @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(fit)), y[fit]] -= 1
        p *= share[fit, None]
        gw = 0.9 * gw + xf.T @ p + DECAY * w
        w -= RATE * gw
        b -= RATE * p.sum(axis=0)
    z = x[held] @ w + b  # temperature on the held-out rows
    nll = lambda t: -np.log(np.exp(z / t - (z / t).max(1, keepdims=True))[np.arange(len(held)), y[held]] / np.exp(z / t - (z / t).max(1, keepdims=True)).sum(1)).mean()
    t = min((0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=nll)
    p = np.exp((z - z.max(1, keepdims=True)) / t)
    p /= p.sum(1, keepdims=True)
    false = p[y[held] == 0, 1:].max(axis=1)  # the best family of what has none
    least = float(min(0.9, max(0.3, np.quantile(false, 0.95) if len(false) else 0.3)))
    w[np.abs(w) < 0.01] = 0  # sparse
    return {"classes": classes, "bias": b.tolist(), "temperature": t, "least": least, "weights": {g: w[i].round(6).tolist() for g, i in vocabulary.items() if w[i].any()}}


def templates() -> list[tuple[str, list[str], int]]:
    """(family, distinct bigrams or the single word, how many of them confirm) of every name and text."""
    out = []
    for source, share in ((NAMES, CONFIRM), (BODIES, CONFIRM_BODY)):
        for family, texts in source.items():
            for text in texts:
                words = tokens(text)
                needed = sorted({f"{a} {b}" for a, b in zip(words, words[1:])} or words)
                # headers of the GNU licenses differ in the version alone
                least = len(needed) if family.startswith("GPL") else math.ceil(share * len(needed))
                out.append((family, needed, least))
    return out


def inline(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small fixed table, as an expression of the plan."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*")


def paragraphs(docs: DataFrame) -> DataFrame:
    """row, doc_id, paragraph, line, words, named (has license words) of what a template can confirm or counts as unknown.

    Paragraphs end at blank lines.  Each line of one is a row; of several lines, there is one more of all joined, with line -1.
    """
    rows = docs.where(F.col("text").rlike(CANDIDATE)).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.posexplode(F.split("text", BLANK)).alias("paragraph", "block"))
    lines = F.split("block", r"[\r\n]+")
    rows = rows.where(F.col("block").rlike(CANDIDATE)).select("row", "doc_id", "paragraph", F.when(F.size(lines) > 1, F.concat(F.array("block"), lines)).otherwise(F.concat(F.array(F.lit(None).cast("string")), lines)).alias("units"))
    rows = rows.select("row", "doc_id", "paragraph", F.posexplode("units").alias("at", "unit")).where(F.col("unit").rlike(CANDIDATE))
    plain = F.replace(F.lower("unit"), F.lit("licence"), F.lit("license"))
    return rows.select("row", "doc_id", "paragraph", (F.col("at") - 1).alias("line"), F.regexp_extract_all(plain, F.lit(TOKEN), F.lit(0)).alias("words"), F.col("unit").rlike(GATE).alias("named"))


def classify(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """doc_id, row, paragraph, line, family, probability, confirmed of every line and paragraph that fits a template or has license words.

    ``family`` is unknown where the probability of the best family is under the calibrated least, or where
    no template of the family is contained.  The others are unknown without being scored, and left out.
    """
    spark, model = docs.sparkSession, model or train()
    classes = model["classes"]
    table = inline(spark, [{"gram": g, "w": w} for g, w in model["weights"].items()], "gram: string, w: array<double>")
    parts = paragraphs(docs)
    words = F.col("words")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))
    all_grams = F.array_distinct(F.concat(words, F.when(F.size(words) > 1, pairs).otherwise(F.array().cast("array<string>"))))
    confirming = defaultdict(list)
    for family, needed, least in templates():
        confirming[family].append((needed, least))
    grams_col = F.col("grams")
    confirmed = {
        family: F.greatest(*checks) if len(checks := [F.size(F.array_intersect(grams_col, F.array(*map(F.lit, needed)))) >= F.lit(k) for needed, k in options]) > 1 else checks[0]
        for family, options in confirming.items()
    }
    parts = parts.withColumn("grams", all_grams).select("row", "doc_id", "paragraph", "line", "named", "grams", F.array(*(F.when(confirmed[c], F.lit(c)) for c in classes[1:])).alias("fits"))
    # not a filter: pushed below the arrays, it would build them again for every template
    scored = F.when(F.col("named") | F.exists("fits", lambda c: c.isNotNull()), F.col("grams"))
    each = parts.select("row", "doc_id", "paragraph", "line", "named", "fits", F.explode_outer(scored).alias("gram")).where("gram is not null").join(F.broadcast(table), "gram", "left")  # as many rows as the templates have n-grams
    sums = each.groupBy("row", "doc_id", "paragraph", "line", "named", "fits").agg(*(F.coalesce(F.sum(F.get("w", F.lit(k))), F.lit(0.0)).alias(f"z{k}") for k in range(len(classes))))
    z = [(F.col(f"z{k}") + F.lit(model["bias"][k])) / F.lit(float(model["temperature"])) for k in range(len(classes))]
    sums = sums.select("row", "doc_id", "paragraph", "line", "named", "fits", F.array(*z).alias("z"))
    top = F.array_max("z")
    p = F.transform("z", lambda v: F.exp(v - top) / F.aggregate("z", F.lit(0.0), lambda a, u: a + F.exp(u - top)))
    best = F.array_max(F.slice("p", 2, len(classes)))
    out = sums.withColumn("p", p).withColumn("probability", best)
    out = out.withColumn("guess", F.get(F.array(*map(F.lit, classes[1:])), (F.array_position(F.slice("p", 2, len(classes)), best) - 1).cast("int")))
    sure = F.array_contains(F.filter("fits", lambda c: c.isNotNull()), F.col("guess"))
    return out.select("doc_id", "row", "paragraph", "line", "named", F.when(sure & (F.col("probability") >= model["least"]), F.col("guess")).otherwise(UNKNOWN).alias("family"), "probability", sure.alias("confirmed"))


def scan(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """doc_id, families (sorted, joined by ","), n_licensed and n_unknown paragraphs of every row.

    A paragraph whose family its single lines don't show (wrapped lines, license texts) counts once; otherwise each line
    with license words or a license text counts by itself.  Null and empty texts and texts without license words have no families (empty string) and counts of 0.
    Repeated rows of a doc_id are scanned each; their paragraphs count together for that doc_id, on each of its rows.
    """
    known, of_line = F.col("family") != UNKNOWN, F.col("line") >= 0
    blocks = classify(docs, model).groupBy("doc_id", "row", "paragraph").agg(
        F.collect_set(F.when(of_line & known, F.col("family"))).alias("lines"),
        F.count_if(of_line & known).alias("n"),
        F.count_if(of_line & ~known & F.col("named")).alias("u"),
        F.max(F.when(~of_line & known, F.col("family"))).alias("whole"),
    )
    wrapped = F.col("whole").isNotNull() & ~F.array_contains("lines", F.col("whole"))  # a family that its lines show together only
    blocks = blocks.select("doc_id", F.when(wrapped, F.array_append("lines", F.col("whole"))).otherwise(F.col("lines")).alias("found"), F.when(wrapped, F.col("n") + 1).otherwise(F.col("n")).alias("n"), F.when(wrapped, 0).otherwise(F.col("u")).alias("u"))
    hits = blocks.groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))), ",").alias("families"), F.sum("n").alias("n_licensed"), F.sum("u").alias("n_unknown")
    )
    hits = hits.select(F.col("doc_id").alias("hit_id"), "families", "n_licensed", "n_unknown")
    return docs.select("doc_id").join(hits.hint("merge"), F.expr("doc_id <=> hit_id"), "left").select(
        "doc_id", F.coalesce("families", F.lit("")).alias("families"), F.coalesce("n_licensed", F.lit(0)).cast("long").alias("n_licensed"), F.coalesce("n_unknown", F.lit(0)).cast("long").alias("n_unknown")
    )


def family_counts(docs: DataFrame) -> Counter:
    """For reports: documents a family."""
    rows = scan(docs).groupBy("families").count().collect()
    return Counter({r["families"]: r["count"] for r in rows})
