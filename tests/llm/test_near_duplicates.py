import random
from collections import Counter, defaultdict

from pyspark.sql import types as T

from shelfwise.llm import near_duplicates as nd
from shelfwise.llm.queries import op8_near_duplicates

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("label", T.StringType()),
                     T.StructField("node", T.StringType()), T.StructField("key", T.StringType())])


def brute(rows, similarity=0.8):
    """{doc_id: (copy_of, class_id, n_links)} of rows with different ids."""
    sets, inverted = {}, defaultdict(set)
    for i, t in rows:
        w = (t or "").encode().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        for s in sets[i]:
            inverted[s].add(i)
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for i, s in sets.items():
        shared = Counter(j for x in s for j in inverted[x] if j != i)
        for j, n in shared.items():
            if 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                links[i] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    text, first = dict(rows), {}
    for i, t in sorted(rows):
        if sets[i]:
            first.setdefault(t, i)
    return {i: (first[text[i]] if sets[i] else i, find(i), links[i]) for i, _ in rows}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def test_equals_brute_force(spark):
    rng, rows = random.Random(11), []
    for g in range(12):
        base = [f"g{g}w{k}" for k in range(60 + 20 * g)]
        rows += [" ".join(base)] * 2 + [edited(rng, base, k) for k in (1, 1, 2, 3, 5, 9)]
    rows += ["a b c", "a b c", "a  b c", "a b c d", "", "", None, " \n", "z " * 3000, "z " * 2000]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    df = spark.createDataFrame([(i, t, "l", "n", "k") for i, t in rows], DOCS).repartition(3)
    got = {r.doc_id: (r.copy_of, r.class_id, r.n_links) for r in nd.near_duplicates(df).collect()}
    want = brute(rows)
    assert got == want
    assert sum(n > 0 for _, _, n in want.values()) > 50


def test_large_group_is_spread_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "NEAR_BLOCK", 8)
    monkeypatch.setattr(nd, "EXACT_BLOCK", 8)
    rng = random.Random(2)
    base = [f"w{k}" for k in range(120)]
    rows = [(i, edited(rng, base, 1)) for i in range(60)] + [(i, " ".join(base)) for i in range(60, 90)]
    df = spark.createDataFrame([(i, t, "", "", "") for i, t in rows], DOCS)
    assert {r.doc_id: (r.copy_of, r.class_id, r.n_links) for r in nd.near_duplicates(df).collect()} == brute(rows)


def test_rows_without_or_with_repeated_ids_and_empty_table(spark):
    text = " ".join(f"w{k}" for k in range(30))
    df = spark.createDataFrame([(None, text, "", "", ""), (4, text, "", "", ""), (4, text, "", "", ""), (9, text + " tail", "", "", "")], DOCS)
    got = sorted(((r.doc_id, r.class_id) for r in nd.near_duplicates(df).collect()), key=str)
    assert got == [(4, 4), (4, 4), (9, 4), (None, None)]
    assert nd.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_depth_meets_recall():
    assert nd.prefix_depth(0.8, 20, 6, 0.9999) == 4 and nd.prefix_depth(0.8, 20, 6, 0.5) == 6


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert {r.doc_id: (r.copy_of, r.class_id, r.n_links) for r in op8_near_duplicates(spark, folder).collect()} == brute(rows)
