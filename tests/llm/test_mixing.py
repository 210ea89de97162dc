import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F, types as T

from shelfwise.llm import mixing
from shelfwise.llm.queries import op4_mixing

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("size", T.StringType()), T.StructField("_key", T.StringType())])


def test_targets_share_the_excess():
    assert mixing.targets([10, 10, 100], [3, 1, 2], 60) == [20, pytest.approx(40 / 3), pytest.approx(80 / 3)]
    assert mixing.targets([10, 10], [1, 1], 100) == [20, 20]
    assert mixing.targets([], [], 0) == []
    assert mixing.targets([0, 50], [3, 1], 75) == [0, 75]


def test_flow_equals_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        patterns = [(tuple(k for k in range(3) if rng.random() < 0.6), rng.randint(0, 3)) for _ in range(3)]
        quotas = [rng.randint(0, 4) for _ in range(3)]
        got = mixing.route(patterns, quotas)
        best = (0, 0)
        for give in itertools.product(*(range(2 * n + 1) for _, n in patterns)):
            # A split of what is given fits if every set of patterns finds enough quota (Hall's condition).
            fits = all(sum(give[p] for p in chosen) <= sum(quotas[s] for s in set().union(*(patterns[p][0] for p in chosen)))
                       for r in range(1, 4) for chosen in itertools.combinations(range(3), r))
            if fits:
                cost = sum(min(g, n) + 2 * max(g - n, 0) for g, (_, n) in zip(give, patterns))
                best = max(best, (sum(give), -cost))
        assert (sum(got), -sum(min(g, n) + 2 * max(g - n, 0) for g, (_, n) in zip(got, patterns))) == best


def test_sources_come_near_targets_and_reruns_agree(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["a", "a", "a", "b", "é", None]), "s", "k") for i in range(3000)]
    rows += [(None, "x y", "a", "", ""), (5, None, "b", "", ""), (7, "p q", "b", "", ""), (7, "p q", "b", "", "")]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows) and sum(r.size for r in got) == sum(len((t or "").split()) for _, t, *_ in rows)
    taken, aim = defaultdict(int), {}
    for r in got:
        (source,) = r.sources
        assert r.taken == r.size * r.copies <= 2 * r.size
        taken[source.name] += r.taken
        aim[source.name] = (source.target, source.size)
    names = ["a", "b", "é", None]
    want = mixing.targets([aim[n][1] for n in names], [3, 1, 2, 3], 1.5 * sum(s for _, s in aim.values()))
    assert [aim[n][0] for n in names] == pytest.approx(want)
    assert all(abs(taken[n] - aim[n][0]) <= 31 for n in names)
    again = sorted(((r.doc_id, r.size, r.taken) for r in mixing.mix(df.repartition(3)).collect()), key=str)
    assert again == sorted(((r.doc_id, r.size, r.taken) for r in got), key=str)


def test_overlapping_sources_and_kept_columns(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.lit("x").alias("source"))
    both = F.when(F.col("doc_id") < 100, F.array(F.lit("a"), F.lit("b"))).when(F.col("doc_id") < 200, F.array(F.lit("a"))).when(F.col("doc_id") < 290, F.array(F.lit("b")))
    got = mixing.mix(df, sources=both, weights=[1.0, 1.0], share=1.0, keep=["text", "source"]).collect()
    assert len(got) == 300 and {(r.text, r.source) for r in got} == {("a b c d", "x")}
    assert all(r.taken == 0 for r in got if r.doc_id >= 290)
    assert abs(sum(r.taken for r in got) - 1200) <= 4 * 3


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op4_mixing(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert {d.doc_id: len(d.text.encode().split()) for d in docs} == {i: r["size"] for i, r in rows.items()}
    own, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for d in docs:
        own[d.source] += rows[d.doc_id]["size"]
        taken[d.source] += rows[d.doc_id].taken
        longest[d.source] = max(longest[d.source], rows[d.doc_id]["size"])
    names = sorted(own)
    want = dict(zip(names, mixing.targets([own[n] for n in names], [(3, 1, 2)[k % 3] for k in range(len(names))], 1.5 * sum(own.values()))))
    for d in docs:
        assert rows[d.doc_id].source_size == own[d.source] and rows[d.doc_id].target == pytest.approx(want[d.source])
    assert all(abs(taken[n] - want[n]) <= longest[n] / 2 + 1 for n in names)
