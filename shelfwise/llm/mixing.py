"""Mix overlapping sources to target weights by min-cost flow.

Documents are added up by membership pattern, the set of sources they belong to. Flow runs from patterns to sources:
each further repetition of a pattern's words costs more than all earlier ones together, so no words are repeated while
others that could fill the same quota are still unused. The words a pattern gives then become documents, picked
whole in a seeded order.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm import tables

SHARE = 1.5
WEIGHTS = (3.0, 1.0, 2.0)
REPEATS = 2
CELLS = 4096
MOST_PATTERNS = 100_000


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, repeats: int = REPEATS) -> list[float]:
    """``total`` shared by weight; what is above ``repeats`` times a source's size is shared again among the others."""
    found, active, left = [0.0] * len(sizes), list(range(len(sizes))), float(total)
    while active:
        whole = sum(weights[k] for k in active)
        above = [k for k in active if left * weights[k] / whole > repeats * sizes[k]]
        if not above:
            for k in active:
                found[k] = left * weights[k] / whole
            break
        for k in above:
            found[k] = float(repeats * sizes[k])
        left -= sum(found[k] for k in above)
        active = [k for k in active if k not in set(above)]
    return found


class _Network:
    """Successive shortest paths with potentials, on whole numbers."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def edge(self, a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def fill(self, source: int, sink: int) -> None:
        potential = [0] * len(self.out)
        while True:
            far, via, queue = {source: 0}, {}, [(0, source)]
            done = set()
            while queue:
                d, x = heapq.heappop(queue)
                if x in done:
                    continue
                done.add(x)
                for e in self.out[x]:
                    y = self.to[e]
                    if self.room[e] > 0 and y not in done:
                        via_x = d + self.cost[e] + potential[x] - potential[y]
                        if via_x < far.get(y, via_x + 1):
                            far[y], via[y] = via_x, e
                            heapq.heappush(queue, (via_x, y))
            if sink not in far:
                return
            most = max(far.values())
            for x in range(len(potential)):
                potential[x] += far.get(x, most)
            path, x = [], sink
            while x != source:
                path.append(via[x])
                x = self.to[via[x] ^ 1]
            amount = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= amount
                self.room[e ^ 1] += amount


def route(patterns: Sequence[tuple[Sequence[int], int]], quotas: Sequence[int], repeats: int = REPEATS) -> list[int]:
    """Words each pattern gives in total, for patterns of (sources, size) and a quota of words for each source."""
    n, k = len(patterns), len(quotas)
    net, source, sink = _Network(n + k + 2), n + k, n + k + 1
    given = []
    for p, (members, size) in enumerate(patterns):
        given.append([net.edge(source, p, size, 1 << r) for r in range(repeats)])
        for s in members:
            net.edge(p, n + s, repeats * size, 0)
    for s, quota in enumerate(quotas):
        net.edge(n + s, sink, quota, 0)
    net.fill(source, sink)
    return [sum(net.room[e ^ 1] for e in edges) for edges in given]


def _cells(sized: DataFrame, seed: int) -> DataFrame:
    """Add a seeded key and, from it, one of ``CELLS`` cells."""
    keyed = sized.withColumn("_key", F.xxhash64(F.lit(seed), "doc_id", "_text"))
    return keyed.withColumn("_cell", F.pmod(F.shiftrightunsigned("_key", 20), F.lit(CELLS)).cast("int"))


def _cuts(placed: DataFrame, budget: DataFrame) -> DataFrame:
    """``budget`` with, for each pattern, the cell where its part of a round ends and the words left for that cell."""
    cells = placed.groupBy("_pattern", "_cell").agg(F.sum("size").alias("_words")).join(F.broadcast(budget), "_pattern")
    so_far = Window.partitionBy("_pattern").orderBy("_cell")
    line = cells.withColumn("_upto", F.sum("_words").over(so_far)).where("_upto >= _part")
    cut = line.groupBy("_pattern").agg(F.min(F.struct("_cell", (F.col("_part") - F.col("_upto") + F.col("_words")).alias("_left"))).alias("_c"))
    return budget.join(F.broadcast(cut), "_pattern", "left").select(
        "_pattern", "_rounds", "_sources", F.col("_c._cell").alias("_cut"), F.col("_c._left").alias("_left"))


def _selected(placed: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add ``copies`` and ``taken``.

    A pattern gives whole rounds of all its documents and one part of a round. For that part documents stand in a
    seeded order, cut into cells; cells before the one where the budget ends are in, and inside that cell alone the
    documents are lined up. The document on the line is in if that brings the sum nearer to the budget.
    """
    joined = placed.join(F.broadcast(cuts), "_pattern")
    split, clear = joined.where("_cell = _cut"), joined.where("_cut IS NULL OR _cell <> _cut")
    order = Window.partitionBy("_pattern").orderBy("_key", "doc_id", "_text", "size").rowsBetween(Window.unboundedPreceding, -1)
    split = split.withColumn("_so_far", F.coalesce(F.sum("size").over(order), F.lit(0)))
    split = split.withColumn("_extra", (F.col("_so_far") * 2 + F.col("size") <= F.col("_left") * 2) & (F.col("_so_far") < F.col("_left")))
    both = split.drop("_so_far").unionByName(clear.withColumn("_extra", F.coalesce(F.col("_cell") < F.col("_cut"), F.lit(False))))
    return both.withColumn("copies", F.col("_rounds") + F.col("_extra").cast("int")).withColumn("taken", F.col("size") * F.col("copies"))


def words_of(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sources: Column | None = None, weights: Sequence[float] = WEIGHTS,
        share: float = SHARE, repeats: int = REPEATS, seed: int = 7, keep: Sequence[str] = ()) -> DataFrame:
    """Per row ``doc_id``, ``size``, ``copies``, ``taken``, and ``sources`` with each source's ``size`` and ``target``.

    ``sources`` is an array of the sources a document belongs to (default: its ``source`` alone). Sources stand in
    the order of their code points, null last, and ``weights`` repeat along them. A document without any source is
    not taken. A null text has size 0 and is taken 0 times its words. Ids may be null or repeat: rows are picked by
    id and text, and equal rows stand side by side. ``keep`` names columns of ``docs`` to carry along. An empty table
    gives an empty result. Patterns, not documents, come to the driver; more than ``MOST_PATTERNS`` raise ValueError.
    """
    named = F.array(F.col("source").cast("string")) if sources is None else F.coalesce(sources, F.array().cast("array<string>"))
    member = F.array_sort(F.array_distinct(F.transform(named, lambda s: F.struct(s.isNull().alias("none"), s.alias("name")))))
    sized = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), words_of(F.col(f"`{text_col}`")).alias("size"),
                        F.xxhash64(F.col(f"`{text_col}`")).alias("_text"), member.alias("_pattern"), *[F.col(f"`{c}`").alias(f"_keep_{c}") for c in keep])
    placed = _cells(sized, seed)
    small = placed.select("doc_id", "size", "_text", "_pattern", "_key", "_cell")
    small = tables.stage(small, "sizes")
    sums = small.groupBy("_pattern").agg(F.sum("size").alias("n")).limit(MOST_PATTERNS + 1).collect()
    if len(sums) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} different sets of sources")
    patterns = [(tuple((m["none"], m["name"]) for m in r["_pattern"] or ()), int(r["n"] or 0)) for r in sums]
    names = sorted({m for members, _ in patterns for m in members}, key=lambda m: (m[0], m[1] or ""))
    place = {m: k for k, m in enumerate(names)}
    patterns.sort(key=lambda p: [place[m] for m in p[0]])
    own = [sum(n for members, n in patterns if m in members) for m in names]
    total = sum(n for _, n in patterns)
    aims = targets(own, [weights[k % len(weights)] for k in range(len(names))], share * total, repeats)
    given = route([([place[m] for m in members], n) for members, n in patterns], [round(a) for a in aims], repeats)
    spark = docs.sparkSession
    shape = "_pattern array<struct<none:boolean,name:string>>, _rounds int, _part bigint, _sources array<struct<name:string,size:bigint,target:double>>"
    rows = []
    for (members, n), g in zip(patterns, given):
        rounds = min(repeats, g // n) if n else 0
        rows.append(([{"none": a, "name": b} for a, b in members], rounds, g - rounds * n,
                     [{"name": m[1], "size": own[place[m]], "target": aims[place[m]]} for m in members]))
    # A row per pattern: small enough to broadcast by the check above.
    budget = spark.createDataFrame(rows, shape)
    chosen = _selected(placed if keep else small, _cuts(small, budget))
    return chosen.select("doc_id", "size", "copies", "taken", F.col("_sources").alias("sources"), *[F.col(f"_keep_{c}").alias(c) for c in keep])
