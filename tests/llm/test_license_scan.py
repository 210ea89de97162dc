import re

import pytest
from pyspark.sql import types as T

from shelfwise.llm import license_scan as ls
from shelfwise.llm.queries import op5_license_scan

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("licenses", T.StringType()), T.StructField("_j", T.StringType())])
FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return ls.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def test_families_unknown_and_prose(spark, model):
    texts = {
        1: ("Some words here.\nReleased under the MIT License.\nMore.", "mit"), 2: ("licensed under the apache license, version 2.0", "apache-2.0"),
        3: ("x\n\nThis work is licensed under the GNU General Public License, version 3.", "gpl"), 4: ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        5: ("Licensed under the Artistic License.", "unknown"), 6: ("He lost his driving license yesterday.", "none"), 7: (None, "none"), 8: ("", "none"),
        9: ("the of and\n" * 3000, "none"), 10: ("This library is licensed under the GNU Lesser General Public License, version 2.1.", "lgpl"),
        11: ("\n\nLicensed under CC BY 4.0.\nReleased under the MIT License.", "cc-by"), None: ("Released under the MIT License.", "mit")}
    df = spark.createDataFrame([(i, t, "", "") for i, (t, _) in texts.items()] + [(1, texts[1][0], "", "")], DOCS).repartition(2)
    rows = ls.license_scan(df, model).collect()
    assert len(rows) == len(texts) + 1
    assert {r.doc_id: r.family for r in rows} == {i: f for i, (_, f) in texts.items()}
    assert [(s.line, s.family) for s in next(r for r in rows if r.doc_id == 11).licenses] == [(2, "cc-by"), (3, "mit")]
    assert ls.license_scan(spark.createDataFrame([], DOCS), model).collect() == []


def test_trigger_misses_no_feature(spark, model):
    for feature in model.weights:
        assert re.search(ls._trigger(model), f"x {feature} y")


def test_held_out_accuracy(spark, model):
    """Statements in frames that the fit has not seen."""
    frames = ["We say: {}", "{} (see above)", "-- {}"]
    rows = [(k, f.format(s), c, "") for k, (c, s, f) in enumerate((c, s, f) for c, g in ls.TEMPLATES.items() for s in g for f in frames)]
    got = {r.doc_id: r.family for r in ls.license_scan(spark.createDataFrame(rows, DOCS), model).collect()}
    assert sum(got[k] == c for k, _, c, _ in rows) >= 0.97 * len(rows)


def test_query_finds_the_planted_lines(spark):
    lines = {"mit": "Released under the MIT License.", "gpl": "This work is licensed under the GNU General Public License, version 3.",
             "apache-2.0": "Licensed under the Apache License, Version 2.0.", "cc-by-nc": "Licensed under CC BY-NC 4.0."}
    want = {r.doc_id: next((c for c, s in lines.items() if s in r.text.split("\n")), "none") for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: r.family for r in op5_license_scan(spark, FOLDER).collect()}
    assert got == want and set(want.values()) > {"none", "mit"}


WRAPPED = {
    "gpl": ["# This program is free software: you can redistribute it and/or modify", "# it under the terms of the GNU General Public License as published by",
            "# the Free Software Foundation, either version 3 of the License, or", "# (at your option) any later version."],
    "bsd": [" * Redistribution and use in source and binary forms, with or without", " * modification, are permitted provided that the following conditions",
            " * are met:"],
    "mit": ["// Permission is hereby granted, free of charge, to any person", "// obtaining a copy of this software and associated documentation files", '// (the "Software"), to deal in the Software without restriction'],
    "apache-2.0": ["   Licensed under the Apache", "   License, Version 2.0 (the", '   "License");'],
}


def test_sample_with_licence_words_hides_no_statement(spark):
    """Headings and plain lines that use a statement's words are no reason to skip it."""
    plain = ["MIT License", "er kam mit dem Zug", "the license was released", "under the bridge", "the software of the gnu", "general public", "his license", "terms of the work"]
    stated = {0: ("Released under the MIT License.", "mit"), 1: ("Licensed under the GNU General Public License, version 3.", "gpl"), 2: ("Licensed under the Apache License, Version 2.0.", "apache-2.0")}
    rows = [(k, "\n\n".join([*plain, f"line {k} of the text", stated[k][0] if k < 3 else "no more"]), "", "") for k in range(200)]
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in ls.license_scan(df, ls.fit(df)).collect()}
    assert {k: got[k].family for k in stated} == {k: f for k, (_, f) in stated.items()}
    assert all(got[k].family in ("none", "unknown") for k in range(3, 200))
    assert not any(s.line in (2, 6, 10, 12, 14) for r in got.values() for s in r.licenses)


def test_statements_wrapped_over_lines(spark, model):
    alone = list(WRAPPED)
    rows = [(k, "\n".join(["#!/bin/sh", "", *WRAPPED[c], "", "the rest of it"]), "", "") for k, c in enumerate(alone)]
    rows += [(10, "\n".join(["a b c", *WRAPPED["gpl"], "", *WRAPPED["bsd"]]), "", ""), (11, "\n".join(WRAPPED["bsd"] * 50), "", ""),
             (12, "\n\n".join(WRAPPED["bsd"]), "", ""), (None, "\n".join(WRAPPED["gpl"]), "", ""), (13, "\n".join(WRAPPED["gpl"]).replace("\n", "\r\n"), "", "")]
    got = {r.doc_id: r for r in ls.license_scan(spark.createDataFrame(rows * 2, DOCS), model).collect()}
    for k, c in enumerate(alone):
        assert [(s.line, s.family) for s in got[k].licenses if s.family != "unknown"] == [(2, c)] and got[k].family == c
    assert [(s.line, s.family) for s in got[10].licenses if s.family != "unknown"] == [(1, "gpl"), (6, "bsd")]
    assert [s.line for s in got[11].licenses if s.family == "bsd"] == list(range(0, 150, 3))
    assert got[12].family in ("none", "unknown") and got[None].family == got[13].family == "gpl"
