import hashlib
import re

import pytest
from pyspark.sql import types as T

from shelfwise.llm.queries import op2_substring_dedup
from shelfwise.llm.substring_dedup import substring_dedup

FOLDER = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("hashes", T.StringType()), T.StructField("range", T.LongType())])


def brute(rows, width):
    """{position in rows: (n_words, kept words)}"""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, split):
        for k in range(len(w) - width + 1):
            if i is not None:
                key = tuple(w[k:k + width])
                least[key] = min(least.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, split):
        gone = set()
        for k in range(len(w) - width + 1):
            if i is not None and least[tuple(w[k:k + width])] < i:
                gone.update(range(k, k + width))
        out.append((i, len(w), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_matches_brute_force_on_edge_cases(spark):
    words = [f"w{k}" for k in range(40)]
    rows = [(5, " ".join(words)), (3, "x " + " ".join(words[10:30]) + " y"), (7, None), (8, ""), (9, " \t\n"), (None, " ".join(words)),
            (3, " ".join(words[:12])), (10, "a a a a a a a a"), (11, "a a a a a"), (12, "b " * 5000), (13, "b " * 3000),
            (14, "é ö " * 6), (15, "é ö " * 7), (2, "\n".join(words[5:9])), (-4, "\t".join(words[20:30]))]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], DOCS).repartition(3)
    got = sorted(((r.doc_id, r.n_words, r.kept_text) for r in substring_dedup(df, width=4).collect()), key=str)
    assert got == sorted(brute(rows, 4), key=str)


def test_intervals_are_maximal(spark):
    text = " ".join(f"w{k}" for k in range(30))
    df = spark.createDataFrame([(1, text, "", 0), (2, text + " tail", "", 0)], DOCS)
    got = {r.doc_id: r for r in substring_dedup(df, width=5).collect()}
    assert [tuple(s) for s in got[2].removed] == [(0, 30)] and got[2].kept_text == "tail" and got[1].removed == []


def test_empty_table(spark):
    assert substring_dedup(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("folder", [FOLDER])
def test_query_equals_brute_force(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = sorted((i, n, n - len(kept.split()), hashlib.sha256(kept.encode()).hexdigest()) for i, n, kept in brute(rows, 50))
    assert sorted(tuple(r) for r in op2_substring_dedup(spark, folder).collect()) == want
