import random
import re
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from shelfwise.llm import decontamination as dc, tables
from shelfwise.llm.queries import op3_decontamination

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("item_id", T.StringType()), T.StructField("cosine", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("doc_id", T.StringType())])


def squeezed(text):
    return f" {b' '.join(dc.normal((text or '').encode()).copy()).decode()} "


def test_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([bytes([rng.randrange(4)]) for _ in range(rng.randrange(1, 90))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert dc.longest_common(a, b) == table[-1][-1]


def test_finds_copies_and_paraphrases_and_leaves_the_rest(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(3000)]
    common = ["the", "of", "and", "to"]
    line = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(words) for _ in range(n)]
    items = [(k, line(rng.randint(15, 70))) for k in range(30)]
    docs, want = [], set()
    for i in range(400):
        text = line(rng.randint(20, 400))
        if i % 4 == 0:
            k, tokens = items[i // 4 % 30]
            tokens = list(tokens)
            if i % 8 == 0:  # a paraphrase: every eighth word is another, a few come in between
                for p in range(3, len(tokens) - 4, 8):
                    tokens[p] = "other"
                tokens.insert(5, "extra")
            at = rng.randrange(len(text))
            text[at:at] = tokens
            want.add((i, k))
        docs.append((i, " ".join(text).upper() if i % 3 == 0 else ", ".join(text), "", ""))
    docs += [(900, None, "", ""), (901, "", "", ""), (None, " ".join(items[0][1]), "", ""), (902, " ".join(items[1][1][:-8]), "", ""), (903, "w1 " * 20000, "", "")]
    bench = spark.createDataFrame([(k, " ".join(t), "") for k, t in items] + [(99, None, ""), (98, " .. ", "")], ITEMS)
    df = spark.createDataFrame(docs, DOCS).repartition(4)
    got = {(r.doc_id, r.item_id) for r in dc.decontaminate(df, bench).collect()}
    assert (None, 0) in got and len(want - got) <= 0.05 * len(want)
    assert {g for g in got if g[0] is not None and g[0] < 900} <= want
    none = spark.createDataFrame([], DOCS)
    assert dc.decontaminate(none, bench).collect() == [] and dc.decontaminate(df, bench.where("item_id > 90")).collect() == []


def test_longest_run():
    a = [b"a", b"b", b"c", b"a", b"b", b"d"]
    assert dc.longest_run(a, [b"x", b"a", b"b", b"", b"d", b"a"]) == 3 and dc.longest_run(a, [b"x"]) == 0 == dc.longest_run(a, [])


def test_finds_copies_cut_at_either_end_or_in_the_middle(spark):
    rng = random.Random(11)
    line = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    items = [(k, line(rng.randint(20, 70))) for k in range(30)]
    docs = []
    for k, tokens in items:
        n, fifth = len(tokens), len(tokens) // 5
        cuts = [tokens[:-4], tokens[:n - fifth], tokens[fifth:], tokens[:n // 2] + tokens[n // 2 + fifth:], tokens[:n * 7 // 20]]
        docs += [(10 * k + j, " ".join([*line(60), *cut, *line(60)]), "", "") for j, cut in enumerate(cuts)]
    bench = spark.createDataFrame([(k, " ".join(t), "") for k, t in items], ITEMS)
    got = {(r.doc_id, r.item_id) for r in dc.decontaminate(spark.createDataFrame(docs, DOCS).repartition(4), bench).collect()}
    # About a third of an item alone is no copy of it.
    assert got == {(10 * k + j, k) for k, _ in items for j in range(4)}


def test_query_finds_every_verbatim_passage(spark):
    folder = "/root/testdata/sf0.01"
    items = [(r.item_id, squeezed(r.text)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = [(r.doc_id, squeezed(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = {(i, k) for i, t in docs for k, s in items if s in t}
    got = {(r.doc_id, r.item_id) for r in op3_decontamination(spark, folder).collect()}
    assert len(want) > 5 and want <= got
    # What else is found shares most of an item's words in order; at most a few documents do.
    assert len({i for i, _ in got - want}) <= 0.005 * len(docs)


def test_only_texts_that_can_hold_an_item_are_split(monkeypatch):
    item = [f"w{k}" for k in range(20)]
    place = {w.encode(): k for k, w in enumerate(sorted(item))}
    vectors = np.ones((20, 2), np.float32)
    space = SimpleNamespace(value=dc.Space(place, np.ones(20, np.float32), vectors))
    split = []
    real = dc.pieces
    monkeypatch.setattr(dc, "pieces", lambda text: split.append(text) or real(text))
    # Every window of the first text is near the item, but it has only half of the item's words.
    texts = [" ".join(item[:10] * 12), "", " ".join(["x", *item, "y"] * 2), "z"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array([t.encode() for t in texts], pa.binary()), pa.array([5, 6, 7, 8])], ["doc_id", "text", "text_key"])
    search = dc._searcher(space, SimpleNamespace(value=[(9, [w.encode() for w in item])]))
    assert [(r["doc_id"], r["item_id"], r["common"]) for out in search(iter([batch])) for r in out.to_pylist()] == [(3, 9, 1.0)]
    assert split == [texts[2].encode()]


def test_space_comes_from_all_passages_whatever_the_partitions(spark):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(100))) for _ in range(200)] + ["w1 x " * 400, "", "x", None]
    items = [[f"w{k}".encode() for k in rng.sample(range(60), 20)] for _ in range(8)]
    df = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], DOCS)
    spaces = [dc.fit(tables.texts(df.repartition(n)), items, rank=6) for n in (1, 5)]
    vocabulary = sorted({w for t in items for w in t})
    rows = [t.encode().split()[a:a + dc.WINDOW] for t in texts if t for a in range(0, len(t.split()), dc.WINDOW)]
    rows = [(r, 1) for r in rows] + [(t[a:a + dc.WINDOW], dc.ITEM_WEIGHT) for t in items for a in range(0, len(t), dc.WINDOW)]
    total = sum(w == 1 for _, w in rows)
    idf = np.array([np.log((1 + total) / (1 + sum(w == 1 and v in r for r, w in rows))) + 0.1 for v in vocabulary])
    a = np.array([[float(v in r) for v in vocabulary] for r, _ in rows]) * idf
    a *= np.array([[w] for _, w in rows]) / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)
    basis = np.random.default_rng(0).standard_normal((len(vocabulary), 14))
    for _ in range(dc.POWER_ROUNDS + 1):
        basis = a.T @ (a @ np.linalg.qr(basis)[0])
    want = np.linalg.svd(basis, full_matrices=False)[0][:, :6]
    for space in spaces:
        assert list(space.place) == vocabulary and np.allclose(space.idf, idf, atol=1e-5)
        got = space.vectors / space.idf[:, None]
        assert np.allclose(got @ got.T, want @ want.T, atol=1e-3)
