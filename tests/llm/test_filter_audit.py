import re
from fractions import Fraction
from itertools import permutations

from pyspark.sql import types as T

from shelfwise.llm.filter_audit import FILTERS, SQL, filter_audit, shapley_map
from shelfwise.llm.queries import op12_filter_audit
from tests.harness import compare, connect

FOLDER = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("mask", T.StringType()), T.StructField("n", T.LongType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.LongType()), T.StructField("toxic", T.LongType()),
                       T.StructField("part", T.StringType())])


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    failed = []
    for i, t, _ in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed.append({c for c, f in zip(FILTERS, [
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search("[#$%&*|]", t)), i is not None and least[t] < i]) if f})
    out = []
    for part in {x or "" for _, _, x in docs}:
        own = [(i, f) for (i, _, x), f in zip(docs, failed) if (x or "") == part]
        rows, total = [], dict.fromkeys(FILTERS, 0)
        for order in permutations(FILTERS):
            left = own
            for k, c in enumerate(order):
                gone, stay = [x for x in left if c in x[1]], [x for x in left if c not in x[1]]
                total[c] += len(gone)
                rows.append((part, "".join(order), k + 1, len(stay), len(gone), sum(c in f for _, f in own) - len(gone),
                             sum(f == {c} for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), c))
                left = stay
        out += [(*r[:-1], total[r[-1]]) for r in rows]
    return sorted(out)


def test_matches_brute_force_on_edge_cases(spark):
    long = " ".join(f"word{k}" for k in range(120))
    docs = [(1, long, "en"), (2, long, "en"), (3, long, "de"), (3, long, "de"), (4, None, None), (5, "", ""), (6, " \t\n", "en"), (7, "A B C # x", "en"),
            (8, "same " * 200, "en"), (None, long, "en"), (None, "x", None), (9, "ÄÖ é " * 60, "fr"), (10, "X" * 5000, "fr"), (0, "A B C # x", "fr"), (-2, "tail", "de"),
            (11, long + " $", "en"), (11, long, "en"), (11, "other", "en")]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, None), (3, None, 1), (7, 0, 1), (None, 1, 1), (11, 1, 1), (4, 1, 0), (99, 1, 1)]
    got = filter_audit(spark.createDataFrame([(*r, "clash", 1) for r in docs], DOCS).repartition(3),
                       spark.createDataFrame([(*r, "clash") for r in labels], LABELS))
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, labels)


def test_large_labels_are_salted_and_give_the_same(spark):
    docs = [(i % 7, f"text {i % 5} A", "en") for i in range(60)]
    labels = [(i, i % 2, i % 3) for i in range(7)]
    a = spark.createDataFrame([(*r, "", 0) for r in docs], DOCS)
    b = spark.createDataFrame([(*r, "") for r in labels], LABELS)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "0b")
    try:
        assert sorted(tuple(r) for r in filter_audit(a, b).collect()) == brute(docs, labels)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_table(spark):
    assert filter_audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []


def test_shares_are_exact_for_any_removals():
    n = len(FILTERS)
    v = [Fraction(0)] + [Fraction((S * 2654435761) % 1009) for S in range(1, 1 << n)]
    want = [Fraction(0)] * n
    for order in permutations(range(n)):
        done = 0
        for i in order:
            want[i] += (v[done | 1 << i] - v[done]) / 120
            done |= 1 << i
    assert [sum(w * x for w, x in zip(row, v)) for row in shapley_map()] == want


def test_query_equals_its_sql(spark):
    assert compare("op12", op12_filter_audit(spark, FOLDER).toPandas(), connect(FOLDER).execute(SQL).df()) is None
