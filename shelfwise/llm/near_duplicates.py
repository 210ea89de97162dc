"""Near-duplicate join on word shingles: MinHash LSH forest, then exact Jaccard similarity.

Copies of a text are one node. A forest of prefix tries over MinHash signatures proposes groups: prefixes start at
their full depth and are shortened until a pair at the wanted similarity shares one in some tree with the target
recall. Groups are never paired off as rows: tasks read the sorted groups as a stream, compare signatures block by
block, and send one edge per node. What hangs together so meets once more with its whole shingle sets, again in
blocks of bounded size, where every pair is decided exactly; a large group is spread over pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm import tables, words
from shelfwise.llm.components import components
from shelfwise.operators.spread import spread_join

WIDTH = 5
SIMILARITY = 0.8
TREES = 20
DEPTH = 6
RECALL = 0.9999
# Signature agreement that leads to the exact check: 5.5 standard deviations below the similarity.
SLACK = 5.5
NEAR_BLOCK = 1024
EXACT_BLOCK = 256
COPY_WAYS = 16


def prefix_depth(similarity: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix at which a pair of ``similarity`` meets in some tree with a chance of ``recall``."""
    while depth > 1 and 1 - (1 - similarity ** depth) ** trees < recall:
        depth -= 1
    return depth


def _signer(width: int, trees: int, depth: int, cut: int):
    out = pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("prefixes", pa.binary()), ("marks", pa.binary())])
    factor, shift = words.sequence(trees * depth, 5) | np.uint64(1), words.sequence(trees * depth, 6)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch.column("text")):
                found, row = words.shingle_hashes(part, width)
                first, _ = words.runs(row)
                rows = row[first]
                least = np.empty((len(rows), trees * depth), np.uint64)
                with np.errstate(over="ignore"):
                    for k in range(trees * depth if len(rows) else 0):
                        least[:, k] = np.minimum.reduceat((found * factor[k] + shift[k]) >> np.uint64(32), first)
                    prefix = np.zeros((len(rows), trees), np.uint64)
                    by_tree = least.reshape(len(rows), trees, depth)
                    for k in range(cut):
                        prefix = words.mix(prefix * np.uint64(0x9E3779B97F4A7C15) + by_tree[:, :, k])
                marks = (words.mix(least) & np.uint64(255)).astype(np.uint8)
                n = len(rows)
                at = pa.array(rows + part.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), batch.column("key").take(at), words.binaries(prefix.ravel(), np.full(n, trees)).cast(pa.binary()),
                     words.binaries(marks.ravel(), np.full(n, trees * depth)).cast(pa.binary())], schema=out)

    return sign


def _planter(trees: int):
    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            prefix = np.frombuffer(b"".join(batch.column("prefixes").to_pylist()), np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(trees, dtype=np.int32), n)), pa.array(prefix.view(np.int64)),
                 pa.array(np.repeat(batch.column("node").to_numpy(), trees))], names=["tree", "prefix", "node"])

    return plant


def _in_blocks(members: DataFrame, group: list[str], size: int) -> DataFrame:
    """``members`` with ``_i`` and ``_j``: a group of many is spread over all pairs of its blocks, one of few has one.

    A row of block k comes to the pairs (k, j) and (i, k); it is marked as of the first or second side.
    """
    sizes = members.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*group, F.ceil(F.col("_n") / size).cast("int").alias("_blocks"))
    placed = members.join(sizes, group).withColumn("_k", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    placed = placed.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return placed.select(*members.columns, F.least("_k", "_o").alias("_i"), F.greatest("_k", "_o").alias("_j"), (F.col("_k") > F.col("_o")).alias("_second"))


def _streamed(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Whole groups of a stream that is sorted by ``keys``: a table with the first row and the length of each group."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        changes = np.zeros(len(table), bool)
        for k in keys:
            values = table[k].to_numpy()
            changes[1:] |= values[1:] != values[:-1]
        cut = np.flatnonzero(changes)
        if not len(cut):
            held = table
            continue
        first = np.concatenate([[0], cut[:-1]])
        yield table.slice(0, int(cut[-1])), first, np.diff(np.append(first, cut[-1]))
        held = table.slice(int(cut[-1]))
    if held is not None and len(held):
        yield held, np.zeros(1, np.int64), np.array([len(held)])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of the component of each of ``n`` places, joined by pairs."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _edge_rows(node: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """One edge for each place that is not its component's root."""
    root = _roots(len(node), a, b)
    off = np.flatnonzero(root != np.arange(len(node)))
    pairs = np.unique(np.stack([node[off], node[root[off]]]), axis=1) if len(off) else np.empty((2, 0), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int64()), pa.array(pairs[1], pa.int64())], names=["a", "b"])


def _similar(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first, length in _streamed(batches, ["tree", "prefix", "_i", "_j"]):
            node = table["node"].to_numpy()
            marks = np.frombuffer(b"".join(table["marks"].to_pylist()), np.uint8).reshape(len(node), -1)
            second, split = table["_second"].to_numpy(), table["_i"].to_numpy() != table["_j"].to_numpy()
            left, right = [], []
            # Places a fixed distance apart, for all groups at once; only groups longer than the distance take part.
            at = np.arange(len(node))
            last = np.repeat(first + length, length)
            for k in range(1, int(length.max())):
                at = at[at + k < last[at]]
                a, b = at, at + k
                ok = ~split[a] | (second[a] != second[b])
                a, b = a[ok], b[ok]
                near = (marks[a] == marks[b]).mean(axis=1) >= least
                left.append(a[near])
                right.append(b[near])
            none = np.empty(0, np.int64)
            yield _edge_rows(node, np.concatenate([none, *left]), np.concatenate([none, *right]))

    return run


def _shingler(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch.column("text")):
                found, row = words.shingle_hashes(part, width)
                parts = [np.unique(x) for x in np.split(found, np.cumsum(np.bincount(row, minlength=part.n))[:-1])]
                mine = batch.slice(part.first, part.n)
                yield pa.RecordBatch.from_arrays(
                    [mine.column("label"), mine.column("node"), mine.column("copies"), pa.array([words.pack_sorted(p) for p in parts], pa.binary())],
                    names=["label", "node", "copies", "shingles"])

    return run


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many values every two of some sets have in common."""
    sizes = np.array([len(s) for s in sets])
    value, which = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(which, kind="stable")
    which, owner = which[order], owner[order]
    both = np.zeros((len(sets), len(sets)), np.int64)
    for low in range(0, len(value), 4096):
        a, b = np.searchsorted(which, (low, low + 4096))
        held = np.zeros((len(sets), min(4096, len(value) - low)), np.float32)
        held[owner[a:b], which[a:b] - low] = 1
        both += (held @ held.T).astype(np.int64)
    return both


def _exact(similarity: float):
    limit = Fraction(similarity).limit_denominator(1000)
    names = ["node", "links", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first, length in _streamed(batches, ["label", "_i", "_j"]):
            node, copies, second = (table[c].to_numpy() for c in ("node", "copies", "_second"))
            across = table["_i"].to_numpy() != table["_j"].to_numpy()
            raw = table["shingles"].to_pylist()
            for lo, n in zip(first.tolist(), length.tolist()):
                here = slice(lo, lo + n)
                sets = [words.unpack_sorted(r) for r in raw[here]]
                size = np.array([len(s) for s in sets])
                both = _shared(sets)
                link = both * limit.denominator >= (size[:, None] + size[None, :] - both) * limit.numerator
                if across[lo]:
                    link &= second[here][:, None] != second[here][None, :]
                np.fill_diagonal(link, False)
                links = link @ copies[here]
                a, b = np.nonzero(np.triu(link))
                root = _roots(n, a, b)
                linked = np.flatnonzero(links)
                own = node[here]
                yield pa.RecordBatch.from_arrays([pa.array(own[linked]), pa.array(links[linked], pa.int64()), pa.array(own[linked]), pa.array(own[root[linked]])], names=names)

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY,
                    trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """Per row ``doc_id``, ``copy_of`` (least id with the same text), ``class_id`` and ``n_links``.

    Two documents link when the Jaccard similarity of their sets of ``width``-word shingles reaches
    ``similarity``; copies link. A class is all that hangs together by links, named by its least id. A text of fewer
    words is one shingle. A text without words (or null) has none and links to nothing: it is a class of its own. Rows
    without an id take no part and have a null class. Rows that repeat an id are one document with several texts.
    An empty table gives an empty result, other columns are ignored.
    """
    keyed = tables.texts(docs, id_col, text_col).withColumn("key", F.md5("text"))
    cut = prefix_depth(similarity, trees, depth, recall)
    signed = keyed.where("doc_id is not null").mapInArrow(
        _signer(width, trees, depth, cut), "doc_id bigint, key string, prefixes binary, marks binary")
    best = signed.groupBy("key").agg(F.min(F.struct("doc_id", "prefixes", "marks")).alias("b"), F.count(F.lit(1)).alias("copies"))
    nodes = tables.stage(best.select(F.col("b.doc_id").alias("node"), "key", "copies", "b.prefixes", "b.marks"), "nodes")

    planted = nodes.select("node", "prefixes").mapInArrow(_planter(trees), "tree int, prefix bigint, node bigint")
    groups = _in_blocks(planted, ["tree", "prefix"], NEAR_BLOCK)
    carried = groups.join(nodes.select("node", "marks"), "node")
    order = ["tree", "prefix", "_i", "_j"]
    least = similarity - SLACK * (similarity * (1 - similarity) / (trees * depth)) ** 0.5
    similar = carried.repartition(*order).sortWithinPartitions(*order, "node").mapInArrow(_similar(least), "a bigint, b bigint")
    together = components(similar)

    members = together.join(nodes.select("node", "copies", "key"), "node")
    whole = keyed.join(members.select("label", "node", "copies", "key", F.col("node").alias("doc_id")), ["doc_id", "key"])
    # A copy that repeats its id would come twice.
    sets = whole.select("label", "node", "copies", "text").mapInArrow(_shingler(width), "label bigint, node bigint, copies bigint, shingles binary")
    sets = tables.stage(sets.dropDuplicates(["label", "node", "shingles"]), "sets")
    order = ["label", "_i", "_j"]
    blocks = _in_blocks(sets, ["label"], EXACT_BLOCK).repartition(*order).sortWithinPartitions(*order, "node")
    linked = tables.stage(blocks.mapInArrow(_exact(similarity), "node bigint, links bigint, a bigint, b bigint"), "links")
    classes = components(linked.where("a <> b"))
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    found = links.join(classes, "node", "left").select("node", "links", F.coalesce("label", "node").alias("label"))

    copied = nodes.where("copies > 1").select("key", F.col("node").alias("_first"), "copies")
    # Both lookups grow with the input: they are merged, never broadcast.
    placed = spread_join(keyed.select("doc_id", "key"), copied.hint("merge"), ["key"], ["doc_id"], "left", COPY_WAYS)
    node = F.when(F.col("doc_id").isNotNull(), F.coalesce("_first", "doc_id"))
    placed = placed.select("doc_id", node.alias("node"), (F.coalesce("copies", F.lit(1)) - 1).alias("_others"))
    result = spread_join(placed, found.hint("merge"), ["node"], ["doc_id"], "left", COPY_WAYS)
    return result.select(
        "doc_id", F.col("node").alias("copy_of"), F.coalesce("label", "node").alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.col("_others") + F.coalesce("links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"))
