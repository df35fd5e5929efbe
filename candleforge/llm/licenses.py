"""Licence scans by a trained paragraph classifier. The scan has DataFrame functions only.

A paragraph is what blank lines bound. Only paragraphs with one of the `keywords` are looked at further: words that
every text has that holds enough of a template to be confirmed, so no licence is lost by that. A
paragraph's candidates are its lines with a keyword, and its notices: stretches of
its joined words that no line break or neighbour hides. For each template,
words are looked at in overlapping windows of about twice its length; where a window holds enough of its
two-word runs, and no fewer than those it overlaps, the words from the first to the last of them are a
notice if the classifier gives them that template's family. A notice counts once for each paragraph and family, and only where no single
line of the paragraph has that family already. A candidate's features are its distinct one- and two-word runs (lower-cased letters and digits), each 1 over the root of
their number. A multinomial logistic regression over the templates' runs gives a probability for
each family and for `unknown`. It is trained on the driver, on texts made from the templates (cut,
with words dropped and foreign words added) and on counter-examples (templates' words in disorder,
and sentences that only talk of licences). Half of those texts are held out: on them, a temperature
is fitted to the probabilities, and the threshold below which a prediction becomes `unknown` is the
least that lets pass at most MAX_FALSE of the counter-examples. A family that passes must be
confirmed: one of its templates must have at least CONFIRM of its two-word runs in the candidate, all of them if
they are at most FEW.

Templates are well-known notices and short forms made from each family's names. Equal paragraphs are searched
once, and equal candidates classified once, however many documents hold them; a paragraph in over
1/HOT of the finds meets its documents by a broadcast.

Nulls, ties and odd rows: a null or empty text has no candidate. Documents are rows with one id; rows
that repeat an id (or have none) are counted together. Families of equal probability: the first by
name. Only doc_id and text are read. Empty in, empty out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candleforge.llm.shared import Spilled, join_hot

#: Well-known licence notices, by SPDX name: fixed values.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, version 3.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0-1.0": [
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
#: Other names of the families: fixed values.
NAMES = {
    "Apache-2.0": ["Apache License 2.0", "Apache 2.0"],
    "MIT": ["MIT"],
    "GPL-3.0": ["GNU GPL version 3", "GNU GPL v3", "GPL v3"],
    "GPL-2.0": ["GNU GPL version 2", "GNU GPL v2", "GPL v2"],
    "LGPL-3.0": ["GNU LGPL version 3", "GNU LGPL v3", "LGPL v3"],
    "BSD-3-Clause": ["BSD 3-Clause", "new BSD"],
    "MPL-2.0": ["Mozilla Public License 2.0", "MPL 2.0"],
    "ISC": ["ISC"],
    "CC-BY-4.0": ["CC BY 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
    "CC0-1.0": ["CC0 1.0"],
    "Unlicense": ["Unlicense"],
}


def short_forms(family: str, names: list[str]) -> list[str]:
    tag = [f"SPDX-License-Identifier: {family}", f"{family} license", f"{family} licensed"]
    return tag + [t for n in names for t in (f"{n} license", f"{n} licensed", f"licensed under the {n}", f"released under the {n}", f"distributed under the {n}")]


TEMPLATES = {f: list(dict.fromkeys([*texts, *short_forms(f, NAMES[f])])) for f, texts in NOTICES.items()}
#: Sentences that only talk of licences: fixed values.
COUNTER = [
    "You need a driving license to rent a car in this country.",
    "The shop lost its license to sell spirits last year.",
    "Copyright law is a subject of the second term.",
    "All rights reserved by the author and the publisher.",
    "She asked for permission to leave the room.",
    "The warranty of the machine ends after two years.",
    "A license fee is due at the end of each month.",
    "Please read the license before you open the box.",
    "The film is in the public domain in some states.",
    "Redistribution of wealth was the theme of the debate.",
    "The software license costs more than the hardware.",
    "He was granted a fishing license by the county.",
]
#: Words that texts about licences have; `keywords` adds what templates need besides.
KEYWORDS = (
    "agpl apache bsd cc cc0 copyright copyrighted gnu gpl isc lgpl licence licenced licences license licensed licenses licensing mozilla mpl "
    "permission permissions redistribute redistribution spdx unencumbered unlicense warranties warranty"
).split()
#: Words that are in all texts, which are never keywords, and words that are in many.
COMMON = frozenset("a an and any are as at be by for from in is it its may not of on or such that the this to was with without you".split())
ORDINARY = frozenset(
    "appear code conditions copies except file following free general included international later neither persons possible products provided public purpose related required source "
    "specific subject terms under version work".split()
)
BLANK = r"\n\s*\n"
UNKNOWN = "unknown"
CONFIRM, FEW, MAX_FALSE, SEED = 0.6, 4, 0.01, 17
N_MADE = 24  # training texts for each template, and as many counter-examples for each


def tokens(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def runs(words: list[str]) -> set[str]:
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))}


@dataclass
class LicenseModel:
    families: list[str]  # the last is UNKNOWN
    features: list[str]
    weights: np.ndarray  # features x families
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.5

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = (x @ self.weights + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def matrix(self, texts: list[list[str]]) -> np.ndarray:
        at = {f: i for i, f in enumerate(self.features)}
        x = np.zeros((len(texts), len(at)))
        for i, words in enumerate(texts):
            own = runs(words)
            x[i, [at[r] for r in own if r in at]] = 1 / max(1.0, len(own)) ** 0.5
        return x


def _made(rng: np.random.Generator, template: list[str]) -> list[str]:
    """A template with foreign words around; one of over ten words also has its end cut and words dropped."""
    n = len(template)
    words = template if n <= 10 else [w for w in template[: int(n * rng.uniform(0.8, 1))] if rng.random() > 0.05]
    foreign = [f"w{k}" for k in rng.integers(0, 10**9, rng.integers(0, 6))]
    cut = rng.integers(0, len(foreign) + 1)
    return [*foreign[:cut], *words, *foreign[cut:]]


def train(templates: dict[str, list[str]] = TEMPLATES, counter: list[str] = COUNTER) -> LicenseModel:
    rng = np.random.default_rng(SEED)
    families = [*sorted(templates), UNKNOWN]
    plain = [(families.index(f), tokens(t)) for f in sorted(templates) for t in templates[f]]
    features = sorted(set().union(*(runs(w) for _, w in plain)))
    pool = [w for _, words in plain for w in words]
    made = [(f, w) for f, w in plain]
    for f, words in plain:
        for _ in range(N_MADE):
            made.append((f, _made(rng, words)))
            made.append((len(families) - 1, [str(w) for w in rng.choice(pool, rng.integers(4, 30))]))
    made += [(len(families) - 1, _made(rng, tokens(c))) for c in counter for _ in range(N_MADE)]
    model = LicenseModel(families, features, np.zeros((len(features), len(families))), np.zeros(len(families)))
    x, y = model.matrix([w for _, w in made]), np.array([f for f, _ in made])
    held = rng.random(len(made)) < 0.5
    held[: len(plain)] = False
    own, target = x[~held], np.eye(len(families))[y[~held]]
    for step in range(400):
        p = model.probabilities(own)
        d = (p - target) / len(own)
        rate = 60 / (1 + step / 100)
        model.weights -= rate * (own.T @ d + 1e-6 * model.weights)
        model.bias -= 0.1 * rate * d.sum(axis=0)
    best = (np.inf, 1.0)
    for t in np.geomspace(0.2, 5, 40):
        model.temperature = float(t)
        p = model.probabilities(x[held])
        best = min(best, (float(-np.log(p[np.arange(held.sum()), y[held]] + 1e-12).mean()), float(t)))
    model.temperature = best[1]
    p = model.probabilities(x[held])[:, :-1].max(axis=1)
    false = np.sort(p[y[held] == len(families) - 1])
    model.threshold = float(max(0.5, false[int(np.ceil((1 - MAX_FALSE) * len(false))) - 1] + 1e-9))
    return model


def _words(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _pairs(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b))


def _two(text: str) -> set[str]:
    return {r for r in runs(tokens(text)) if " " in r}


def enough(n: int) -> int:
    """How many of a template's n two-word runs confirm it."""
    return n if n <= FEW else int(np.ceil(CONFIRM * n))


def keywords(templates: dict[str, list[str]]) -> list[str]:
    """KEYWORDS, and of each template its longest words, ORDINARY ones last, until runs without any keyword can't confirm it."""
    out = set(KEYWORDS)
    for words in (tokens(t) for texts in templates.values() for t in texts):
        two = _two(" ".join(words))
        for w in sorted(set(words) - COMMON, key=lambda w: (w in ORDINARY, -len(w), w)):
            if sum(out.isdisjoint(r.split(" ")) for r in two) < enough(len(two)):
                break
            out.add(w)
    return sorted(out)


def _gate(text: Column, words: list[str]) -> Column:
    return F.arrays_overlap(F.split(F.lower(text), "[^a-z0-9]+"), F.array(*map(F.lit, words)))


def notices(once: DataFrame, templates: dict[str, list[str]]) -> DataFrame:
    """(para, wanted, words): stretches of once(para, block) that hold enough of a template of the family `wanted`."""
    texts = [(f, t) for f in templates for t in templates[f]]
    rows = [(p, k, f, (len(tokens(t)) + 1) // 2, enough(len(_two(t)))) for k, (f, t) in enumerate(texts) for p in sorted(_two(t))]
    known = F.broadcast(once.sparkSession.createDataFrame(rows, "pair string, k int, wanted string, step int, enough int"))
    words = once.select("para", F.split(_words("block"), " ").alias("words"))
    # templates that the whole paragraph has enough of; only their runs are looked at by place
    every = F.array(*map(F.lit, sorted({r[0] for r in rows})))
    held = words.select("para", F.explode(F.array_intersect(_pairs(F.col("words")), every)).alias("pair")).join(known, "pair")
    held = held.groupBy("para", "k", "enough").agg(F.count("*").alias("n")).where("n >= enough").groupBy("para").agg(F.collect_set("k").alias("ks"))
    placed = words.join(held, "para").select("para", "ks", F.posexplode(_pairs(F.col("words"))).alias("at", "pair"))
    met = placed.join(known, "pair").where(F.array_contains("ks", F.col("k"))).drop("ks")
    # a window is four steps, so it holds any stretch of three, which is one and a half times the template
    met = met.withColumn("window", F.explode(F.transform(F.array(*map(F.lit, range(4))), lambda i: F.floor(F.col("at") / F.col("step")) - i)))
    full = met.groupBy("para", "k", "window", "wanted", "enough").agg(F.count_distinct("pair").alias("n"), F.min("at").alias("a"), F.max("at").alias("b"))
    full = full.where(F.col("n") >= F.col("enough")).withColumn("worth", F.struct("n", F.col("a") - F.col("b")))
    # of windows that overlap, the fullest: a part of a notice could look like another family's
    near = Window.partitionBy("para", "k").orderBy("window").rangeBetween(-3, 3)
    full = full.withColumn("best", F.max("worth").over(near)).where(F.col("worth") == F.col("best")).select("para", "wanted", "a", "b").distinct()
    return full.join(words, "para").select("para", "wanted", F.array_join(F.slice("words", F.col("a") + 1, F.col("b") - F.col("a") + 2), " ").alias("words"))


def classify(texts: DataFrame, model: LicenseModel, templates: dict[str, list[str]]) -> DataFrame:
    """(key, family, p, ok) for each key of texts(key, words); ok: a family that passes and is confirmed."""
    spark, n_families = texts.sparkSession, len(model.families)
    weights = [(f, *map(float, model.weights[i])) for i, f in enumerate(model.features)]
    weights = F.broadcast(spark.createDataFrame(weights, "feature string, " + ", ".join(f"w{k} double" for k in range(n_families))))  # as large as the templates
    plain = [(f, _two(t)) for f in templates for t in templates[f]]
    pairs = F.broadcast(spark.createDataFrame([(p, k, f, enough(len(two))) for k, (f, two) in enumerate(plain) for p in sorted(two)], "feature string, k int, wanted string, enough int"))

    once = texts.groupBy("key").agg(F.min("words").alias("words"))
    words = F.split("words", " ")
    every = once.select("key", F.array_distinct(F.concat(words, _pairs(words))).alias("runs"))
    every = every.select("key", F.size("runs").alias("n"), F.explode("runs").alias("feature"))
    got = every.join(weights, "feature", "left").groupBy("key").agg(F.first("n").alias("n"), *(F.sum(F.coalesce(f"w{k}", F.lit(0.0))).alias(f"w{k}") for k in range(n_families)))
    logits = F.array(*((F.col(f"w{k}") / F.sqrt("n") + float(model.bias[k])) / model.temperature for k in range(n_families)))
    got = got.withColumn("z", logits).withColumn("top", F.array_max("z"))
    got = got.withColumn("total", F.aggregate(F.transform("z", lambda z: F.exp(z - F.col("top"))), F.lit(0.0), lambda a, b: a + b))
    at = F.array_position("z", F.col("top")).cast("int") - 1
    got = got.select("key", F.get(F.array(*map(F.lit, model.families)), at).alias("family"), (1 / F.col("total")).alias("p"))
    held = every.join(pairs, "feature").groupBy("key", "k", "wanted", "enough").agg(F.count("*").alias("held")).where("held >= enough")
    held = held.groupBy("key").agg(F.collect_set("wanted").alias("confirmed"))
    passes = (F.col("family") != UNKNOWN) & (F.col("p") >= model.threshold) & F.coalesce(F.array_contains("confirmed", F.col("family")), F.lit(False))
    return got.join(held, "key", "left").select("key", "family", "p", passes.alias("ok"))


def scan(docs: DataFrame, model: LicenseModel, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """A row per document: doc_id, n_candidates, n_licensed, families (sorted, comma-joined), confidence.

    confidence: the highest probability among the confirmed candidates, to six places, or null.
    """
    words = keywords(templates)
    blocks = docs.select("doc_id", F.explode(F.split("text", BLANK)).alias("block")).where(_gate(F.col("block"), words))
    found = Spilled(blocks.select("doc_id", F.sha2("block", 256).alias("para"), "block"), "paragraphs").df
    once = Spilled(found.groupBy("para").agg(F.min("block").alias("block"), F.count("*").alias("copies")), "paragraphs-once").df
    lines = once.select("para", F.explode(F.split("block", "\n")).alias("line")).where(_gate(F.col("line"), words))
    lines = lines.select("para", F.lit(None).cast("string").alias("wanted"), _words("line").alias("words"))
    parts = Spilled(lines.unionByName(notices(once, templates)).withColumn("key", F.sha2("words", 256)), "candidates").df
    judged = parts.select("para", "wanted", "key").join(classify(parts.select("key", "words"), model, templates), "key")

    whole, passed = F.col("wanted").isNull(), F.col("ok") & (F.col("wanted").isNull() | (F.col("wanted") == F.col("family")))
    by_family = judged.withColumn("ok", passed).groupBy("para", F.when(F.col("ok"), F.col("family")).alias("family")).agg(
        F.count(F.when(whole, 1)).alias("n_lines"), F.max(F.when(whole, F.col("p"))).alias("of_lines"), F.max("p").alias("of_any"),
    )
    held = F.col("family").isNotNull()
    n = F.when(held, F.greatest("n_lines", F.lit(1)))
    per_para = by_family.groupBy("para").agg(
        F.sum(F.coalesce(n, "n_lines")).alias("candidates"), F.sum(F.coalesce(n, F.lit(0))).alias("licensed"),
        F.collect_set("family").alias("families"), F.max(F.when(held, F.coalesce("of_lines", "of_any"))).alias("p"),
    )
    per_para = Spilled(per_para.join(once.select("para", "copies"), "para"), "judged").df
    hits = join_hot(found.groupBy("doc_id", "para").agg(F.count("*").alias("n")), per_para, ["para"], "copies")
    per_doc = hits.groupBy("doc_id").agg(
        F.sum(F.col("n") * F.col("candidates")).alias("n_candidates"), F.sum(F.col("n") * F.col("licensed")).alias("n_licensed"),
        F.array_distinct(F.flatten(F.collect_list("families"))).alias("families"), F.max("p").alias("confidence"),
    )
    ids = docs.select("doc_id").distinct().withColumnRenamed("doc_id", "id")
    out = ids.join(per_doc, F.col("id").eqNullSafe(F.col("doc_id")), "left")
    return out.select(
        F.col("id").alias("doc_id"), F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"), F.coalesce("n_licensed", F.lit(0)).alias("n_licensed"),
        F.array_join(F.array_sort(F.coalesce("families", F.array().cast("array<string>"))), ",").alias("families"), F.round("confidence", 6).alias("confidence"),
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), train())
