"""A Merkle manifest of a dataset: a 16-ary hash tree per source, and one over the sources, stored in van Emde Boas order.

A tree is cut into aligned blocks of :data:`LEVELS` node levels. A block is one row whose nodes lie in one byte array: the
tree of its levels is split at half its height into a top and bottoms, these again, and so on, each laid out after
the other, so that a path from leaf to root stays in few neighbouring stretches whatever the size of a cache line or
page. Where a node lies is arithmetic alone (:func:`address`). Blocks are built from sorted leaves; their roots are
the leaves of the next round of blocks, until one is left. Proofs go the other way: from the last round down, each block
hands the siblings above it to the blocks below, so that no leaf is joined with a path node by node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm import tables

FAN = 16
LEVELS = 4
DIGEST = 32
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes of blocks, or rows, that a task sends on at once.
SENT_BYTES, SENT_ROWS = 4 << 20, 2000

_BLOCK = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("total", pa.int64()), ("levels", pa.int32()), ("nodes", pa.binary()), ("root", pa.binary()),
                    ("ids", pa.list_(pa.int64())), ("probes", pa.list_(pa.binary())), ("names", pa.list_(pa.string())), ("n", pa.int32())])
_BLOCK_DDL = ("tree string, block bigint, total bigint, levels int, nodes binary, root binary, ids array<bigint>, probes array<binary>, "
              "names array<string>, n int")
_STEP = pa.struct([("at", pa.int32()), ("siblings", pa.string())])
_ABOVE = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("subroot", pa.string()), ("root", pa.string()), ("above", pa.list_(_STEP))])
_ABOVE_DDL = "tree string, block bigint, subroot string, root string, above array<struct<at:int,siblings:string>>"
_PROOF = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_())])


def nodes_of(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (FAN**levels - 1) // (FAN - 1)


def address(levels: int, depth: int, index):
    """Place of the ``index``-th node (a number or an array) at ``depth`` of a full tree: the top half first, then each bottom."""
    if levels == 1:
        return index * 0
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    bottom, below = levels - top, depth - top
    width = FAN**below
    return nodes_of(top) + index // width * nodes_of(bottom) + address(bottom, below, index % width)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Block:
    """One aligned subtree of ``n`` leaves in van Emde Boas order."""

    def __init__(self, levels: int, n: int, nodes: np.ndarray):
        self.levels, self.n, self.nodes = levels, n, nodes

    @staticmethod
    def build(leaves: bytes, levels: int) -> Block:
        n = len(leaves) // DIGEST
        block = Block(levels, n, np.zeros((nodes_of(levels), DIGEST), np.uint8))
        block.nodes[address(levels, levels - 1, np.arange(n))] = np.frombuffer(leaves, np.uint8).reshape(n, DIGEST)
        last = 0
        for depth in range(levels - 1, -1, -1):
            last = max(last, int(address(levels, depth, block.count(depth) - 1)))
            if depth:
                below, width = block.level(depth), 2 * DIGEST * FAN
                own = b"".join(hashlib.sha256(below[k:k + width].encode()).digest() for k in range(0, len(below), width))
                block.nodes[address(levels, depth - 1, np.arange(len(own) // DIGEST))] = np.frombuffer(own, np.uint8).reshape(-1, DIGEST)
        block.nodes = block.nodes[: last + 1]
        return block

    def count(self, depth: int) -> int:
        return -(-self.n // FAN ** (self.levels - 1 - depth))

    def level(self, depth: int) -> str:
        """Digests of one level side by side, as hex text."""
        return self.nodes[address(self.levels, depth, np.arange(self.count(depth)))].tobytes().hex()

    def paths(self) -> Iterator[list[tuple[int, str]]]:
        """For every leaf, from the leaves up: its place in its run and the digests of the others."""
        levels, one, run = [self.level(d) for d in range(self.levels - 1, 0, -1)], 2 * DIGEST, 2 * DIGEST * FAN
        for i in range(self.n):
            steps = []
            for text in levels:
                first, at = i // FAN * run, i % FAN
                steps.append((at, text[first:first + one * at] + text[first + one * (at + 1):first + run]))
                i //= FAN
            yield steps


def fold(digest: str, steps: list[tuple[int, str]]) -> str:
    """The root that follows from a leaf and its siblings."""
    for at, siblings in steps:
        cut = 2 * DIGEST * at
        digest = _hash(siblings[:cut] + digest + siblings[cut:])
    return digest


def levels_for(total: int, levels: int) -> int:
    """Levels of the blocks of a round: all of them, or for the last round as few as its leaves need."""
    return next((k for k in range(1, levels) if FAN ** (k - 1) >= total), levels)


def _builder(levels: int):
    payload = ("id", "probe", "name")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, size = [], 0
        key, leaves, extra = None, [], ([], [], [])

        def close():
            block = Block.build(b"".join(leaves), levels_for(key[2], levels))
            root = block.nodes[0].tobytes()
            carried = [x if any(v is not None for v in x) else None for x in extra]
            done.append((*key, block.levels, block.nodes.tobytes(), root, *carried, block.n))
            return block.nodes.nbytes + 48 * block.n

        def sent():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _BLOCK)], schema=_BLOCK)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("tree", "block", "total", "leaf", *payload)]
            for tree, number, total, leaf, *more in zip(*columns):
                if key != (tree, number, total):
                    if key is not None:
                        size += close()
                        if size >= SENT_BYTES:
                            yield sent()
                            done, size = [], 0
                    key, leaves, extra = (tree, number, total), [], ([], [], [])
                leaves.append(leaf)
                for held, value in zip(extra, more):
                    held.append(value)
        if key is not None:
            close()
            yield sent()

    return build


def _blocks_of(batch: pa.RecordBatch) -> Iterator[tuple[dict, Block]]:
    for row in batch.to_pylist():
        yield row, Block(row["levels"], row["n"], np.frombuffer(row["nodes"], np.uint8).reshape(-1, DIGEST))


def _hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies above each block of the round below, or above each tree where the leaves are trees."""
    rows: list[tuple] = []
    for batch in batches:
        for row, block in _blocks_of(batch):
            over, names = [(s["at"], s["siblings"]) for s in row["above"]], row["names"]
            first = row["block"] * FAN ** (row["levels"] - 1)
            for k, steps in enumerate(block.paths()):
                leaf = bytes(block.nodes[address(block.levels, block.levels - 1, k)]).hex()
                place = (row["tree"], first + k, row["subroot"]) if names is None else (names[k], 0, leaf)
                rows.append((*place, row["top"], [{"at": a, "siblings": s} for a, s in steps + over]))
            if len(rows) >= SENT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ABOVE)], schema=_ABOVE)
                rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ABOVE)], schema=_ABOVE)


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for batch in batches:
        for row, block in _blocks_of(batch):
            over = [(s["at"], s["siblings"]) for s in row["above"]]
            leaves, one = block.level(block.levels - 1), 2 * DIGEST
            ids, probes = row["ids"] or [None] * block.n, row["probes"] or [None] * block.n
            for k, steps in enumerate(block.paths()):
                leaf, steps = leaves[k * one:(k + 1) * one], steps + over
                folded = fold(probes[k].hex() if probes[k] is not None else leaf, steps)
                rows.append((ids[k], leaf, row["subroot"], row["top"], _hash("".join(s for _, s in steps)), folded, folded == row["top"]))
            if len(rows) >= SENT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PROOF)], schema=_PROOF)
                rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PROOF)], schema=_PROOF)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame) -> DataFrame:
    """``tree``, ``id``, ``leaf`` and, for the rows that are tampered with, the leaf of their lower-cased text as ``probe``."""
    digest = lambda text: F.unhex(F.sha2(F.concat(*[_field(c) for c in (
        F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)]), 256))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("tree"), F.col("doc_id").cast("bigint").alias("id"), digest(F.col("text")).alias("leaf"),
        F.when(tampered, digest(F.translate(F.col("text"), CAPITALS, SMALL))).alias("probe"), F.lit(None).cast("string").alias("name"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``index`` of each row in its tree by ``order``, and the tree's ``total``, without sorting a tree in one task.

    Key ranges are written sorted; only their counts per tree are added up. Equal rows are told apart by where they were
    read, so that they, too, spread over ranges.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(parts, "tree", *order, "_read").sortWithinPartitions("tree", *order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = tables.stage(ranged.select(*rows.columns, F.spark_partition_id().alias("_part"), place.alias("_at")), "merkle-ranges")
    counts = ranged.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    tree = Window.partitionBy("tree")
    before = F.sum("_n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("tree", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_offset"), F.sum("_n").over(tree).alias("total"))
    return ranged.join(offsets.hint("merge"), ["tree", "_part"]).select(*rows.columns, (F.col("_at") + F.col("_offset")).alias("index"), "total")


def _round(rows: DataFrame, levels: int) -> DataFrame:
    width = FAN ** (levels - 1)
    dealt = rows.select("tree", F.floor(F.col("index") / width).cast("bigint").alias("block"), "total", (F.col("index") % width).alias("slot"), "leaf", "id", "probe", "name")
    return tables.stage(dealt.repartition("tree", "block").sortWithinPartitions("tree", "block", "slot").mapInArrow(_builder(levels), _BLOCK_DDL), "merkle-blocks")


def build(rows: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """Stored blocks of all trees of ``rows`` (``tree``, ``index``, ``total``, ``leaf`` and payload), a table per round."""
    width, rounds = FAN ** (levels - 1), [_round(rows, levels)]
    largest = rounds[0].agg(F.max("total")).first()[0] or 0
    null = lambda c, kind: F.lit(None).cast(kind).alias(c)
    while largest > width:
        largest = -(-largest // width)
        roots = rounds[-1].where(F.col("total") > width).select(
            "tree", F.col("block").alias("index"), F.ceil(F.col("total") / width).cast("bigint").alias("total"), F.col("root").alias("leaf"),
            null("id", "bigint"), null("probe", "binary"), null("name", "string"))
        rounds.append(_round(roots, levels))
    return rounds


def _tops(rounds: list[DataFrame], levels: int) -> DataFrame:
    tops = [r.where(F.col("total") <= FAN ** (levels - 1)).select("tree", F.col("root").alias("leaf")) for r in rounds]
    union = tops[0]
    for t in tops[1:]:
        union = union.unionByName(t)
    return union


def _with_above(blocks: DataFrame, above: DataFrame) -> DataFrame:
    return blocks.drop("root").join(above.withColumnRenamed("root", "top").hint("merge"), ["tree", "block"])


def _descend(rounds: list[DataFrame], last: DataFrame) -> DataFrame:
    """Blocks of the first round with what lies above them; ``last`` says it for the only block of each tree's last round."""
    above = last
    for blocks in reversed(rounds[1:]):
        # A tree enters in the round where it has one block; the others come from the round above.
        handed = tables.stage(_with_above(blocks, above).mapInArrow(_hand_down, _ABOVE_DDL), "merkle-above")
        above = handed.unionByName(last.join(handed.select("tree").distinct().hint("merge"), "tree", "left_anti"))
    return _with_above(rounds[0], above)


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per row ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

    Leaves of a source ascend by id, then by their own digest; a null id comes first and is never tampered with. Rows that repeat
    each other are leaves of their own, next to each other. A null source is a tree of its own, before that of the empty name. Null
    texts and fields count as ``-``, empty ones as ``0:``. An empty table gives no rows; other columns are ignored, whatever
    their names.
    """
    own = tables.stage(leaves(docs), "merkle-leaves")
    rounds = build(numbered(own, ["id", "leaf"]), levels)
    null = lambda c, kind: F.lit(None).cast(kind).alias(c)
    sources = _tops(rounds, levels).select(F.lit("").alias("tree"), "leaf", null("id", "bigint"), null("probe", "binary"), F.col("tree").alias("name"))
    over = build(numbered(sources, ["name"]), levels)
    none = F.array().cast("array<struct<at:int,siblings:string>>")
    root = over[-1].select("tree", "block", F.lit("").alias("subroot"), F.lower(F.hex("root")).alias("root"), none.alias("above"))
    last = tables.stage(_descend(over, root).mapInArrow(_hand_down, _ABOVE_DDL), "merkle-above")
    return _descend(rounds, last).mapInArrow(
        _prove, "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


_LEAF = "sha256(" + " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END" for c in ("doc_id", "source", "lang", "n_chars")) + \
    " || CASE WHEN text IS NULL THEN '-' ELSE strlen({0}) || ':' || {0} END)"
SQL = f"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce('s' || source, '') AS tree, {_LEAF.format('text')} AS leaf,
    CASE WHEN xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 5 = 0
      THEN {_LEAF.format(f"translate(text, '{CAPITALS}', '{SMALL}')")} END AS probe FROM documents),
  own AS (SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS rid,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM docs),
  lev AS (SELECT tree, 0 AS lvl, i, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM own
    UNION ALL SELECT tree, lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM lev WHERE n > 1 GROUP BY tree, lvl, i // 16, n),
  sub AS (SELECT tree, lvl, h, row_number() OVER (ORDER BY tree) - 1 AS i FROM lev WHERE n = 1),
  top AS (SELECT 0 AS lvl, i, h, count(*) OVER () AS n FROM sub
    UNION ALL SELECT lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM top WHERE n > 1 GROUP BY lvl, i // 16, n),
  root AS (SELECT h FROM top WHERE n = 1),
  runs AS (SELECT tree, lvl, i, h FROM lev WHERE n > 1
    UNION ALL SELECT s.tree, s.lvl + t.lvl, t.i, t.h FROM top t JOIN sub s ON t.i // 16 = (s.i >> CAST(4 * t.lvl AS INTEGER)) // 16 WHERE t.n > 1),
  place AS (SELECT rid, own.tree, own.i, sub.lvl AS height, sub.i AS top_i, leaf, probe FROM own JOIN sub USING (tree)),
  spot AS (SELECT p.*, r.lvl, r.i AS j, r.h, CASE WHEN r.lvl < height THEN p.i >> CAST(4 * r.lvl AS INTEGER) ELSE top_i >> CAST(4 * (r.lvl - height) AS INTEGER) END AS k
    FROM place p JOIN runs r ON r.tree = p.tree),
  steps AS (SELECT rid, lvl, j, k, h FROM spot WHERE j // 16 = k // 16),
  proof AS (SELECT rid, string_agg(h, '' ORDER BY lvl, j) AS s FROM steps WHERE j <> k GROUP BY rid),
  fold AS (SELECT rid, 0 AS lvl, coalesce(probe, leaf) AS f FROM own
    UNION ALL SELECT fold.rid, fold.lvl + 1, sha256(string_agg(CASE WHEN j = k THEN f ELSE h END, '' ORDER BY j))
    FROM fold JOIN steps ON steps.rid = fold.rid AND steps.lvl = fold.lvl GROUP BY fold.rid, fold.lvl),
  folded AS (SELECT rid, max_by(f, lvl) AS f FROM fold GROUP BY rid)
SELECT doc_id, leaf, sub.h AS subroot, root.h AS root, sha256(coalesce(proof.s, '')) AS proof_sha256, folded.f AS folded_root, folded.f = root.h AS verified
FROM own JOIN sub USING (tree) CROSS JOIN root LEFT JOIN proof ON proof.rid = own.rid JOIN folded ON folded.rid = own.rid
"""
