import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from shelfwise.llm import merkle
from shelfwise.llm.queries import op13_merkle_manifest
from tests.harness import compare, connect

FOLDER = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("tree", T.StringType()),
                     T.StructField("_at", T.LongType())])


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    """Same columns as the operator, from lists of levels."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, t, lang, s, n: h("".join(enc(v) for v in (i, s, lang, n, t)))
    small = lambda t: t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)

    def grow(nodes):
        levels = [nodes]
        while len(nodes) > 1:
            nodes = [h("".join(nodes[k:k + 16])) for k in range(0, len(nodes), 16)]
            levels.append(nodes)
        return levels

    def path(levels, i):
        for nodes in levels[:-1]:
            first = i // 16 * 16
            yield i - first, nodes[first:i] + nodes[i + 1:first + 16]
            i //= 16

    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0], leaf(*r), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = grow([x[1] for x in by[s]])
    top = grow([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (doc, own, (_, t, lang, _, n)) in enumerate(by[s]):
            steps = [*path(trees[s], i), *path(top, k)]
            f = leaf(doc, small(t), lang, s, n) if doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0 else own
            for at, others in steps:
                f = h("".join(others[:at] + [f] + others[at:]))
            out.append((doc, own, trees[s][-1][0], top[-1][0], h("".join("".join(o) for _, o in steps)), f, f == top[-1][0]))
    return out


@pytest.mark.parametrize("levels", range(1, 7))
def test_addresses_fill_a_full_tree_once(levels):
    if merkle.FAN**levels > 1 << 21:
        levels = 5
    found = np.concatenate([merkle.address(levels, d, np.arange(merkle.FAN**d)) for d in range(levels)])
    assert np.array_equal(np.sort(found), np.arange(merkle.nodes_of(levels)))


def test_bottom_trees_lie_together():
    """Split at half height: a bottom tree of a four-level tree is one stretch of 17 nodes."""
    for b in (0, 1, 255):
        own = [merkle.address(4, 2, b), *merkle.address(4, 3, np.arange(16 * b, 16 * b + 16))]
        assert sorted(own) == list(range(17 + 17 * b, 34 + 17 * b))


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 257, 300])
def test_block_equals_plain_levels(n):
    leaves = [hashlib.sha256(str(k).encode()).digest() for k in range(n)]
    block = merkle.Block.build(b"".join(leaves), merkle.levels_for(n, 4))
    nodes = [x.hex() for x in leaves]
    while len(nodes) > 1:
        nodes = [h("".join(nodes[k:k + 16])) for k in range(0, len(nodes), 16)]
    root = bytes(block.nodes[0]).hex()
    assert root == nodes[0]
    assert all(merkle.fold(leaves[k].hex(), steps) == root for k, steps in enumerate(block.paths()))


def edge_rows():
    rows = [(k, f"Text {k}", "en", "web", k) for k in range(-40, 300)]
    rows += [(k, "Copy A", None, None, None) for k in range(40)] + [(None, "Null ID", "en", "web", 1), (None, None, None, None, None), (None, None, None, None, None)]
    rows += [(7, "Text 7", "en", "web", 7)] * 3 + [(5, "", "", "", 0), (6, "É" * 3000, "fr", "Ünï", 3), (9, None, "fr", "Ünï", 0)]
    return rows + [(k, "Lone", "de", f"one{k}", k) for k in range(40)]


@pytest.mark.parametrize("levels", [2, 4])
def test_matches_brute_force_on_edge_cases(spark, levels):
    rows = edge_rows()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], DOCS).repartition(3)
    got = merkle.manifest(df, levels)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(brute(rows), key=str)


def test_empty_and_single(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS)).collect() == []
    one = [(1, "A", "en", "x", 1)]
    assert [tuple(r) for r in merkle.manifest(spark.createDataFrame([(*r, "", 0) for r in one], DOCS)).collect()] == brute(one)


def test_query_equals_its_sql_and_brute_force(spark):
    got = op13_merkle_manifest(spark, FOLDER).toPandas()
    assert compare("op13", got, connect(FOLDER).execute(merkle.SQL).df()) is None
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert sorted(map(tuple, got.itertuples(index=False))) == sorted(brute(rows))
