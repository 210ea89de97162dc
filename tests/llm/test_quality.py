import re
from collections import Counter

from pyspark.sql import functions as F, types as T

from shelfwise.llm import quality as q
from shelfwise.llm.queries import ORACLES, op7_quality
from tests.harness import compare, connect

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("_w", T.StringType()), T.StructField("n", T.StringType())])


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = Counter(zip(w, w[1:], w[2:]))
    covered = {k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in q.SYMBOLS), len(lines) - len(set(lines)), len(covered)


def test_base_counts_and_edges(spark):
    texts = ["a b c a b c d", "", None, " \t\n", "x", "x y", "a a a a a", "é# ü| é# ü| é#\n\né\né\n \n\t\n", "a b c\nd e f\na b c\n", "w " * 4000, "\x0ba\x1cb\x85c d",
             " ".join(f"w{i % 50}" for i in range(3000))]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", "c", "c") for i, t in enumerate(texts)] + [(None, "a", "en", "s", "", ""), (0, texts[0], "en", "s", "", "")]
    got = q.quality(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert len(got) == len(rows)
    found = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=str)
    assert found == sorted(((r[0], *brute(r[1])) for r in rows), key=str)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert q.quality(spark.createDataFrame([], DOCS)).collect() == []


def test_buckets(spark):
    values = [0, 1, 127, 128, 129, 130, 1000, 10**6, 10**12 + 12345]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v bigint").select(q.bucket(F.col("v"))).collect()]
    for v, b in zip(values, got):
        assert b <= v < b + max(1, v // 64 + 1) and (v > 127 or v == b)


def test_thresholds_follow_the_group(spark):
    words = lambda n, k: " ".join("abcdefghij"[: 4 + (i * k) % 3] + str(i) for i in range(n))
    rows = [(i, words(80 + i % 7, 1), "en", "plain") for i in range(150)]
    rows += [(1000 + i, " ".join(x + "$$" for x in words(80, 2).split()), "en", "code") for i in range(150)]
    rows += [(9999, " ".join(x + "$$" for x in words(80, 2).split()), "en", "plain")]
    got = {r.doc_id: r.kept for r in q.quality(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert not got.pop(9999) and all(got.values())


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare("op7", op7_quality(spark, folder).toPandas(), connect(folder).execute(ORACLES["op7_quality"]).df()) is None
