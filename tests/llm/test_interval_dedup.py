import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from shelfwise.llm import interval_dedup as interval_module, transform
from shelfwise.llm.interval_dedup import anchors, interval_dedup
from shelfwise.llm.queries import op11_interval_dedup

FOLDER = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("rid", T.StringType()),
                     T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])


def brute(rows, width):
    """(id, n_bytes, spans, kept) of every row."""
    rows = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, t in rows:
        for k in range(len(t) - width + 1):
            if i is not None:
                least[t[k:k + width]] = min(least.get(t[k:k + width], (i, k)), (i, k))
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for k in range(len(t) - width + 1):
            if i is not None and least[t[k:k + width]] < (i, k):
                gone[k:k + width] = b"\1" * width
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(bytes(gone), np.uint8), [0]])))
        out.append((i, len(t), list(zip(edges[::2].tolist(), edges[1::2].tolist())), bytes(c for c, g in zip(t, gone) if not g)))
    return out


def result(df):
    return [(r.doc_id, r.n_bytes, [tuple(s) for s in r.removed], bytes(r.kept)) for r in df.collect()]


def rows_of(seed):
    rng = random.Random(seed)
    phrase = "".join(rng.choice("abcdefgh ") for _ in range(300))
    rows = [(k, "".join(rng.choice("ab") for _ in range(rng.randrange(120)))) for k in range(40)]
    for k in range(40, 160):
        a, b = sorted(rng.randrange(300) for _ in range(2))
        rows.append((k, "".join(rng.choice("xyz") for _ in range(rng.randrange(30))) + phrase[a:b] + rng.choice(["", "é!", phrase[:50]])))
    rows += [(200 + k, phrase) for k in range(20)] + [(300, None), (301, ""), (None, phrase), (None, None), (-3, phrase[5:60]), (3, phrase), (3, phrase), (4, phrase[9:]),
             (4, phrase[2:]), (400, "a" * 3000), (401, "ab" * 900), (402, phrase[:7]), (403, "é" * 40)]
    return rows


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"often": 3}), (3, {"often": 0}), (4, {"symbols": 500})])
def test_matches_brute_force(spark, seed, options):
    """``often`` sends single strings; ``symbols`` makes small transforms."""
    rows = rows_of(seed)
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], DOCS).repartition(3)
    got = result(interval_dedup(df, width=12, gram=5, **options))
    assert sorted(got, key=str) == sorted(brute(rows, 12), key=str)


@pytest.mark.parametrize("most", [300, 1500])
def test_groups_beyond_one_transform_get_longer_anchors(monkeypatch, most):
    monkeypatch.setattr(transform, "MOST", most)
    rows = [(i, t) for i, t in rows_of(6) if i is not None and t]
    rows = list(dict.fromkeys(rows))
    sent, texts = [], [t.encode() for _, t in rows]
    for k, t in enumerate(texts):
        if len(t) >= 12:
            sent.append((1, k, rows[k][0], 0, len(t), t))
    table = pa.Table.from_pylist([dict(zip(interval_module._ROUTED.names, r)) for r in sent], schema=interval_module._ROUTED)
    found = interval_module._expander(12, most, (7, 9))(iter(table.to_batches(max_chunksize=13)))
    got = {(r["rid"], p) for b in found for r in b.to_pylist() for p in range(r["at"], r["at"] + r["n"])}
    least = {}
    for (i, _), t in zip(rows, texts):
        for k in range(len(t) - 11):
            least[t[k:k + 12]] = min(least.get(t[k:k + 12], (i, k)), (i, k))
    assert got == {(k, p) for k, t in enumerate(texts) for p in range(len(t) - 11) if least[t[p:p + 12]] < (rows[k][0], p)}


def test_very_long_texts_come_in_pieces(spark):
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefghijklmnop") for _ in range(2_300_000))
    rows = [(1, long), (2, "x" * 500 + long[1_048_500:1_048_700] + "y"), (3, long[:60])]
    df = spark.createDataFrame([(*r, "", 1, 2) for r in rows], DOCS)
    got = {r.doc_id: [tuple(s) for s in r.removed] for r in interval_dedup(df).select("doc_id", "removed").collect()}
    assert got == {1: [], 2: [(1, 700)], 3: []}


def test_empty_table(spark):
    assert interval_dedup(spark.createDataFrame([], DOCS)).collect() == []


def test_every_string_is_in_one_stretch_of_its_anchor():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 99, rng.integers(0, 90)).astype(np.uint8)) for _ in range(30)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    start, n, h, _ = anchors(data, offsets, 20, 6)
    covered = np.concatenate([np.arange(s, s + k) for s, k in zip(start, n)])
    want = np.concatenate([np.arange(o, o + max(len(t) - 19, 0)) for o, t in zip(offsets, texts)])
    assert np.array_equal(np.sort(covered), want)
    of = defaultdict(set)
    for s, k, x in zip(start, n, h):
        for p in range(s, s + k):
            of[data[p:p + 20].tobytes()].add(int(x))
    assert all(len(v) == 1 for v in of.values())


@pytest.mark.parametrize("seed", range(25))
def test_classes_are_those_of_equal_strings(seed):
    rng = np.random.default_rng(seed)
    depth, symbols = int(rng.integers(1, 12)), int(rng.integers(1, 4))
    texts = [bytes(rng.integers(97, 97 + symbols, rng.integers(1, 40)).astype(np.uint8)) for _ in range(rng.integers(1, 12))]
    ends = np.cumsum([len(t) for t in texts])
    number, which, offset = transform.classes(np.frombuffer(b"".join(texts), np.uint8), ends - [len(t) for t in texts], ends, depth)
    got, want = defaultdict(set), defaultdict(set)
    for k, j, o in zip(number, which, offset):
        got[k].add((j, o))
    for j, t in enumerate(texts):
        for k in range(len(t) - depth + 1):
            want[t[k:k + depth]].add((j, k))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_values_appear_in_ascending_order_up_to_the_threshold():
    """Marks set for a threshold are those set for a lower one, and more."""
    data = np.frombuffer(b"banana bandana banal anagram" * 3, np.uint8)
    symbols, _ = transform.joined(data, np.array([0]), np.array([len(data)]))
    order = transform.suffix_order(symbols, 40)
    marks = [transform.boundaries(symbols, order, d) for d in range(1, 20)]
    assert all((a <= b).all() for a, b in zip(marks, marks[1:])) and marks[0].sum() < marks[-1].sum()


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    want = sorted((i, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in brute(rows, 100))
    assert sorted(tuple(r) for r in op11_interval_dedup(spark, FOLDER).collect()) == want
