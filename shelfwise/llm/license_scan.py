"""Licence statements: a trained paragraph classifier, confirmed against templates, in DataFrame functions only.

Features are words and word pairs. The classifier is a sparse multinomial logistic regression fitted here on labelled
statements and on a bounded sample of the corpus's own lines; its temperature and the probability under which a family
is unknown come from statements held back from the fit. The vocabulary is that of the statements without function
words, whatever the sample holds, so a line with none of its words has no feature: one regular expression finds the
lines that need the classifier, and misses none.

Three kinds of units are judged: single lines, passages of several lines, and stretches of words across lines in which
a template's three-word runs are found. Lines are joined up to one without words; comment marks are no words.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm import tables

# Documents whose lines stand for text without licences; the only sample, used for the fit alone.
SAMPLE_DOCS = 300
CONFIRMED = 0.6
# A passage is up to PASSAGE lines; one starts at each second half, so a wrapped statement of 5 lines is whole in one.
PASSAGE = 8
# Kinds of units; a stretch has its template's number.
LINE, PASSED = -1, -2
NONE, UNKNOWN = "none", "unknown"
# Statements by which works name their licence, by family.
TEMPLATES = {
    "mit": ["Released under the MIT License.", "This project is licensed under the terms of the MIT license.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "Distributed under the MIT software license."],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.", "This file is licensed under the Apache License 2.0.",
                   "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Released under the Apache Software License version 2."],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.", "Released under the GNU GPL version 2 or later.", "Licensed under the GPLv3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License, version 2.1.", "Released under the LGPL version 3.",
             "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"],
    "agpl": ["This work is licensed under the GNU Affero General Public License, version 3.", "Released under the AGPLv3."],
    "bsd": ["Licensed under the BSD 3-Clause License.", "Released under the 2-clause BSD license.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc0": ["Released under CC0 1.0 Universal.", "This work is dedicated to the public domain under the Creative Commons CC0 waiver."],
}
# Statements of licences outside the families, and sentences that only use such words.
OTHER = ["Licensed under the Example Community License.", "All rights reserved under a proprietary license agreement.", "Released under the terms of our own license.",
         "Use of this software is governed by the end user license agreement.", "Licensed under the Artistic License."]
PROSE = ["He renewed his driving license last week.", "The committee is licensed to sell wine in this town.", "The public and general mood was free.",
         "She studied at MIT before moving abroad.", "The Apache helicopter landed near the village.", "A permission slip was granted to every person.",
         "The new source of income was subject to tax.", "The album was released under a new name.", "Creative people do common work.", "The terms of the treaty are public."]
FRAMES = ["{}", "Note: {}", "{} See the file for details.", "# {}", "Copyright 2021 The Authors. {}", "{} All rights reserved.", "Unless stated otherwise: {}"]
HELD_FRAMES = ["* {} *", "Please note that {}", "{} Thank you."]
# Function words: no features by themselves or in pairs with each other, nor are numbers.
STOP = set("a an and any are as at be by following for from in is it may not of or our own that the these this to under use used with you".split())


def tokens(line: Column) -> Column:
    """Lower-case words of letters, digits and inner dots, dashes and plus signs."""
    parts = F.split(F.lower(line), r"[^a-z0-9.+\-]+")
    return F.array_remove(F.transform(parts, lambda t: F.regexp_replace(t, r"^[.\-]+|[.\-]+$", "")), "")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), use)[0]


def _runs(words: Column, n: int) -> Column:
    return F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0))), lambda _, i: F.array_join(F.slice(words, i + 1, F.lit(n)), " "))


def grams(line: Column, n: int) -> Column:
    """Distinct runs of ``n`` words."""
    return _bound(tokens(line), lambda w: F.array_distinct(_runs(w, n)))


def features(line: Column) -> Column:
    return _bound(tokens(line), lambda w: F.array_distinct(F.concat(w, _runs(w, 2))))


@dataclass
class Classifier:
    """What a fit leaves: a weight per class for each feature, biases, the temperature and the least probability."""

    classes: list[str]
    weights: dict[str, list[float]]
    biases: list[float]
    temperature: float
    least: float


def _counts_as_feature(f: str) -> bool:
    return any(w not in STOP and not w.replace(".", "").isdigit() for w in f.split(" "))


def _labelled(spark, frames: list[str]) -> DataFrame:
    rows = [(f.format(s), family) for family, statements in TEMPLATES.items() for s in statements for f in frames]
    rows += [(f.format(s), UNKNOWN) for s in OTHER for f in frames] + [(s, NONE) for s in PROSE]
    return spark.createDataFrame(rows, "line string, family string")


def _templates(spark) -> DataFrame:
    """A row per three-word run of a template: ``template``, ``family``, ``n`` runs in all, ``run``."""
    rows = [(k, c, s) for k, (c, s) in enumerate((c, s) for c, group in TEMPLATES.items() for s in group)]
    cut = spark.createDataFrame(rows, "template int, family string, s string").withColumn("g", grams(F.col("s"), 3))
    return cut.select("template", "family", F.size("g").alias("n"), F.explode("g").alias("run"))


def _passages(lines: Column) -> Column:
    """Runs of two to ``PASSAGE`` lines with words: ``line`` number of the first and the ``lines``."""
    half = PASSAGE // 2
    windows = F.transform(F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / half)), lambda g: F.struct(
        (g * half).alias("at"), F.slice(lines, (g * half + 1).cast("int"), F.lit(PASSAGE)).alias("some")))

    def runs(w: Column) -> Column:
        blank = lambda k: ~F.lower(F.get(w["some"], k)).rlike("[a-z0-9+]")
        begins = F.filter(F.sequence(F.lit(0), F.size(w["some"]) - 1), lambda k: ~blank(k) & ((k == 0) | F.coalesce(blank(k - 1), F.lit(True))))
        lengths = lambda k: F.coalesce(F.array_min(F.filter(F.sequence(k, F.size(w["some"]) - 1), blank)), F.size(w["some"])) - k
        return F.transform(begins, lambda k: F.struct((w["at"] + k).cast("int").alias("line"), F.slice(w["some"], k + 1, lengths(k)).alias("lines")))

    return F.filter(F.flatten(F.transform(windows, runs)), lambda p: F.size(p["lines"]) > 1)


def _stretches(texts: DataFrame, spark) -> DataFrame:
    """Stretches of words over several lines that hold ``CONFIRMED`` of a template's runs, the best of overlapping ones.

    A stretch is at most twice as long as its template.
    """
    templates = _templates(spark)
    known = [(r.template, r.family, r.n, r.run) for r in templates.collect()]
    reach, runs = 2 * max(n for _, _, n, _ in known), sorted({r for *_, r in known})
    # A line without words leaves an empty one, which is in no run.
    words = F.flatten(F.transform(F.split("_text", "\n"), lambda line, i: _bound(tokens(line), lambda w: F.transform(
        F.when(F.size(w) > 0, w).otherwise(F.array(F.lit(""))), lambda t: F.struct(i.alias("line"), t.alias("t"))))))
    split = texts.select("doc_id", "_h", words.alias("w"))
    run_at = lambda k: F.concat_ws(" ", F.get("w", k)["t"], F.get("w", k + 1)["t"], F.get("w", k + 2)["t"])
    at = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda k: run_at(k).isin(runs))
    met = split.select("doc_id", "_h", F.explode(F.transform(at, lambda k: F.struct(
        k.alias("pos"), F.get("w", k)["line"].alias("line"), F.get("w", k + 2)["line"].alias("last"), run_at(k).alias("run"),
        F.transform(F.slice("w", k + 1, F.lit(reach + 3)), lambda x: x["t"]).alias("words")))).alias("m")).select("doc_id", "_h", "m.*")
    met = met.dropDuplicates(["doc_id", "_h", "pos"]).join(F.broadcast(templates), "run")
    order = Window.partitionBy("doc_id", "_h", "template").orderBy("pos")
    met = met.withColumn("ahead", F.collect_list(F.struct("pos", "last", "run")).over(order.rangeBetween(0, reach)))
    # It stays in its paragraph: before the next line without words.
    ends = F.coalesce(F.nullif(F.array_position("words", ""), F.lit(0)), F.size("words") + 1).cast("int") - 1
    met = met.withColumn("ahead", F.filter("ahead", lambda x: x["pos"] < F.col("pos") + F.least(F.col("n") * 2, ends)))
    met = met.withColumn("similarity", F.size(F.array_distinct(F.transform("ahead", lambda x: x["run"]))) / F.col("n"))
    # It ends where a run comes again.
    met = met.withColumn("until", F.array_max(F.transform(F.filter("ahead", lambda x, i: ~F.exists(
        F.slice("ahead", F.lit(1), i), lambda y: y["run"] == x["run"])), lambda x: F.struct(x["pos"].alias("pos"), x["last"].alias("last")))))
    met = met.where(F.col("similarity") >= CONFIRMED)
    # Of starts close to each other the one that holds most stays, the most compact first: the template's own beginning.
    value = F.struct("similarity", (F.col("pos") - F.col("until.pos")).alias("short"), (-F.col("pos")).alias("early"))
    met = met.withColumn("value", value)
    near = F.collect_list(F.struct("pos", "value")).over(order.rangeBetween(-reach, reach))
    best = ~F.exists("near", lambda x: (F.abs(x["pos"] - F.col("pos")) < F.col("n")) & (x["value"] > F.col("value")))
    found = met.withColumn("near", near).where(best).withColumn("end", F.col("until.pos") + 2)
    # Of stretches of several templates over the same words the one with the most of its template stays.
    rank = F.struct("similarity", "n", (-F.col("template")).alias("t"))
    others = F.collect_list(F.struct("pos", "end", rank.alias("rank"))).over(Window.partitionBy("doc_id", "_h").orderBy("pos").rangeBetween(-reach - 2, reach + 2))
    beaten = F.exists("others", lambda x: (x["pos"] <= F.col("end")) & (F.col("pos") <= x["end"]) & (x["rank"] > F.col("rank")))
    found = found.withColumn("rank", rank).withColumn("others", others).where(~beaten & (F.col("until.last") > F.col("line")))
    inside = F.array_remove(F.slice("words", F.lit(1), (F.col("end") - F.col("pos") + 1).cast("int")), "")
    return found.select("doc_id", "_h", "line", F.col("until.last").alias("last"), "template", "similarity", F.array_join(inside, " ").alias("text"), F.col("family").alias("stated"))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE_DOCS) -> Classifier:
    """Fit on the labelled statements and on the lines of ``sample`` documents, picked by a hash of their id and text."""
    spark = docs.sparkSession
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).where("text is not null")
    plain = plain.withColumn("h", F.xxhash64("doc_id", "text")).orderBy("h").limit(sample)
    lines = plain.select(F.explode(F.split("text", "\n")).alias("line")).distinct()
    # Lines that share a run of three words with a statement may be one; they are no example of either kind.
    runs = _templates(spark).select("run").distinct()
    stated_like = lines.select("line", F.explode(grams(F.col("line"), 3)).alias("run")).join(F.broadcast(runs), "run").select("line")
    lines = lines.join(stated_like.distinct(), "line", "left_anti").orderBy(F.xxhash64("line")).limit(len(FRAMES) * sample)
    # Passages that hold no such line are examples as well.
    broken = plain.select("doc_id", "h", _passages(F.split("text", "\n")).alias("p")).select("h", F.explode("p").alias("p"))
    passages = broken.select(F.array_join("p.lines", "\n").alias("line")).distinct()
    like = passages.select("line", F.explode(grams(F.col("line"), 3)).alias("run")).join(F.broadcast(runs), "run").select("line")
    passages = passages.join(like.distinct(), "line", "left_anti").orderBy(F.xxhash64("line")).limit(len(FRAMES) * sample)
    statements = spark.createDataFrame([(x,) for x in [*(x for g in TEMPLATES.values() for x in g), *OTHER]], "line string")
    vocabulary = sorted({f for r in statements.select(features(F.col("line")).alias("f")).collect() for f in r.f if _counts_as_feature(f)})
    used = lambda line: F.filter(features(line), lambda f: f.isin(vocabulary))
    # The samples are bounded, and so is what is collected: their words and word pairs.
    plain_rows = [r.f for r in lines.union(passages).select(used(F.col("line")).alias("f")).collect()]
    stated = [(r.family, r.f) for r in _labelled(spark, FRAMES).select("family", used(F.col("line")).alias("f")).collect()]
    train = spark.createDataFrame([*stated, *((NONE, f) for f in plain_rows)], "family string, f array<string>")
    classes = [NONE, UNKNOWN, *sorted(TEMPLATES)]
    number = F.create_map(*[F.lit(x) for k, c in enumerate(classes) for x in (c, float(k))])
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="f", outputCol="features").setBinary(True)
    ready = lambda df: vectors.transform(df.select("f", number[F.col("family")].alias("label")))
    model = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=40).fit(ready(train).coalesce(1))
    matrix = model.coefficientMatrix.toArray()
    held = _labelled(spark, HELD_FRAMES).withColumn("f", features(F.col("line")))
    # A few hundred held-back statements, scored on the driver to set two numbers.
    scored = [(int(r.label), list(r.rawPrediction)) for r in model.transform(ready(held)).select("label", "rawPrediction").collect()]

    def probabilities(raw: list[float], t: float) -> list[float]:
        top = max(raw)
        e = [math.exp((x - top) / t) for x in raw]
        return [x / sum(e) for x in e]

    loss = lambda t: -sum(math.log(max(probabilities(raw, t)[y], 1e-12)) for y, raw in scored)
    temperature = min((0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=loss)
    judged = sorted(((max(p), p.index(max(p)) == y) for y, p in ((y, probabilities(raw, temperature)) for y, raw in scored)), reverse=True)
    least, wrong = 0.5, 0
    for p, right in judged:
        wrong += not right
        if wrong > 0.01 * len(judged):
            least = max(least, p)
            break
    return Classifier(classes, {w: [float(x) for x in matrix[:, k]] for k, w in enumerate(vocabulary)}, [float(x) for x in model.interceptVector], temperature, least)


def _trigger(model: Classifier) -> str:
    """Matches every lower-case line that has a feature, since each feature has a word that is one.

    Words stand between characters that belong to no word; they are grouped by their first letter.
    """
    groups: dict[str, list[str]] = {}
    for w in sorted(w for w in model.weights if " " not in w):
        groups.setdefault(w[0], []).append(re.sub(r"([^a-z0-9])", r"\\\1", w[1:]))
    return "(?<![a-z0-9])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in groups.items()) + ")(?![a-z0-9])"


def license_scan(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, ``licenses`` (``line`` number from 0, ``family``, ``probability``, ``similarity``) and ``family``.

    A line is listed when its likeliest class is not none. Its family is unknown when the class is, when the
    probability is under the calibrated least one, or when fewer than ``CONFIRMED`` of the three-word runs of the best template
    of the family are there. A statement wrapped over lines is listed once, at its first line, unless one of its lines
    states the same family alone; its lines are not listed as unknown. Several lines that are a statement only together
    are listed as unknown at the first. ``family`` is that of the first known statement, else unknown if there is any,
    else none. A null text has no lines. Ids may be null or repeat, an empty table gives an empty result, other columns
    are ignored.
    """
    spark = docs.sparkSession
    trigger = _trigger(model)
    base = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    base = base.withColumn("_h", F.xxhash64("_text"))
    # Texts without a trigger hold no feature; the others are stored once for the three kinds of units.
    texts = tables.stage(base.where(F.lower("_text").rlike(trigger)), "triggered")
    vocabulary, has = list(model.weights), F.lower("text").rlike(trigger)
    templates = F.broadcast(_templates(spark))
    runs = [r.run for r in templates.select("run").distinct().collect()]
    used = F.filter(features(F.col("text")), lambda f: f.isin(vocabulary)).alias("f")
    no_runs, alone = F.array().cast("array<string>").alias("runs"), F.lit(None).cast("double").alias("similarity")
    place = ["doc_id", "_h", "line", "last", "unit"]
    lines = texts.select("doc_id", "_h", F.posexplode(F.split("_text", "\n")).alias("line", "text")).where(has).select(
        "doc_id", "_h", "line", F.col("line").alias("last"), F.lit(LINE).alias("unit"), F.lit("").alias("stated"), used,
        F.filter(grams(F.col("text"), 3), lambda g: g.isin(runs)).alias("runs"), alone)
    passages = texts.select("doc_id", "_h", F.explode(_passages(F.split("_text", "\n"))).alias("p")).select(
        "doc_id", "_h", "p.line", (F.col("p.line") + F.size("p.lines") - 1).alias("last"), F.array_join("p.lines", "\n").alias("text")).where(has).select(
        "doc_id", "_h", "line", "last", F.lit(PASSED).alias("unit"), F.lit("").alias("stated"), used, no_runs, alone)
    stretches = _stretches(texts, spark).select("doc_id", "_h", "line", "last", F.col("template").alias("unit"), "stated", used, no_runs, "similarity")
    # What a feature can give any class at most over none; a unit whose sum stays below is none for sure.
    none = model.classes.index(NONE)
    over = lambda w: max(x for k, x in enumerate(w) if k != none) - w[none]
    gain = F.create_map(*[F.lit(x) for f, w in model.weights.items() for x in (f, float(over(w)))])
    most = F.aggregate("f", F.lit(float(over(model.biases))), lambda a, f: a + F.coalesce(gain[f], F.lit(0.0)))
    units = lines.unionByName(passages).unionByName(stretches).where((F.size("f") > 0) & (most >= -1e-6))
    units = tables.stage(units.dropDuplicates(place), "units")
    # Weights and templates are as large as the labelled statements make them.
    weights = F.broadcast(spark.createDataFrame(list(model.weights.items()), "f string, w array<double>"))
    # Sums in thousandths of a millionth do not depend on the order of the rows.
    sums = [F.sum(F.round(F.col("w")[k] * 1e9).cast("bigint")).alias(f"w{k}") for k in range(len(model.classes))]
    logits = units.select(*place, "stated", "similarity", F.explode("f").alias("f")).join(weights, "f").groupBy(*place, "stated", "similarity").agg(*sums)
    scaled = logits.select(*place, "stated", "similarity", F.array(*[(F.col(f"w{k}") / 1e9 + b) / model.temperature for k, b in enumerate(model.biases)]).alias("z"))
    scaled = scaled.withColumn("top", F.array_max("z")).withColumn("e", F.transform("z", lambda v: F.exp(v - F.col("top"))))
    name = F.element_at(F.array(*[F.lit(c) for c in model.classes]), F.array_position("z", F.col("top")).cast("int"))
    likely = scaled.select(*place, "stated", "similarity", name.alias("family"), (F.lit(1.0) / F.aggregate("e", F.lit(0.0), lambda a, b: a + b)).alias("probability")).where(F.col("family") != NONE)
    met = units.where(F.col("unit") == LINE).select(*place, F.explode("runs").alias("run")).join(templates, "run")
    met = met.groupBy(*place, "family", "template").agg((F.count(F.lit(1)) / F.max("n")).alias("s"))
    same = lambda a, b, on: [a[c].eqNullSafe(b[c]) for c in on]
    met = met.groupBy(*place, "family").agg(F.max("s").alias("found"))
    judged = likely.join(met, same(likely, met, [*place, "family"]), "left").select(
        *[likely[c] for c in place], likely["family"], "stated", "probability", F.coalesce("similarity", "found", F.lit(0.0)).alias("similarity"))
    sure = (F.col("family") != UNKNOWN) & (F.col("probability") >= model.least) & (F.col("similarity") >= CONFIRMED)
    judged = tables.stage(judged.withColumn("sure", sure), "judged")
    text = ["doc_id", "_h"]
    line = judged.where(F.col("unit") == LINE).withColumn("family", F.when(F.col("sure"), F.col("family")).otherwise(UNKNOWN))

    def merged(rows: DataFrame, by: list[str], shared: int) -> DataFrame:
        """One row for rows that overlap in more than ``shared`` lines."""
        order = Window.partitionBy(*by).orderBy("line", "last")
        before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
        rows = rows.withColumn("_new", F.coalesce(F.col("line") > before - shared, F.lit(True)).cast("int"))
        rows = rows.withColumn("_group", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        best = F.max(F.struct("similarity", "probability"))
        return rows.groupBy(*dict.fromkeys([*by, "family", "_group"])).agg(F.min("line").alias("line"), F.max("last").alias("last"), best.alias("_b")).select(
            *text, "line", "last", "family", "_b.probability", "_b.similarity")

    def apart(rows: DataFrame, others: DataFrame, on: list[str]) -> DataFrame:
        """Rows none of whose lines are lines of ``others``."""
        spread = lambda df: df.select("*", F.explode(F.sequence("line", "last")).alias("_at"))
        a, b = spread(rows), spread(others).select(*on, "_at").distinct()
        key = ["doc_id", "_h", "line", "last", "family"]
        hit = a.join(b, same(a, b, [*on, "_at"]), "left_semi").select(*key).distinct()
        return rows.join(hit, same(rows, hit, key), "left_anti")

    wrapped = merged(judged.where((F.col("unit") >= 0) & F.col("sure") & (F.col("family") == F.col("stated"))), [*text, "family"], 1)
    wrapped = apart(wrapped, line.where("sure"), [*text, "family"])
    listed = ["doc_id", "_h", "line", "last", "family", "probability", "similarity"]
    stated = line.where("sure").select(*listed).unionByName(wrapped).unionByName(apart(line.where("NOT sure").select(*listed), wrapped, text))
    together = merged(apart(judged.where(F.col("unit") == PASSED).withColumn("family", F.lit(UNKNOWN)).select(*listed), stated, text), [*text, "family"], 0)
    stated = stated.unionByName(together)
    # A text's statements are bounded by its own lines.
    per_text = stated.groupBy("doc_id", "_h").agg(F.array_sort(F.collect_list(F.struct(
        F.col("line").cast("bigint").alias("line"), "family", "probability", "similarity"))).alias("licenses"))
    rows = base.select("doc_id", "_h")
    joined = rows.join(per_text, rows["doc_id"].eqNullSafe(per_text["doc_id"]) & (rows["_h"] == per_text["_h"]), "left").select(rows["doc_id"], "licenses")
    listed = F.coalesce("licenses", F.array().cast("array<struct<line:bigint,family:string,probability:double,similarity:double>>"))
    first = F.filter("licenses", lambda s: s["family"] != UNKNOWN)
    return joined.select("doc_id", listed.alias("licenses")).select(
        "doc_id", "licenses", F.when(F.size(first) > 0, first[0]["family"]).when(F.size("licenses") > 0, UNKNOWN).otherwise(NONE).alias("family"))
