"""What each of five filters removes in any order, and its Shapley share, from the 32 coalitions of filters.

Every document becomes a set of failed filters. Per part, the removals of all 32 coalitions are tabulated; a step of an
order removes the difference of two coalitions. The Shapley shares are the exact solution of the kernel-weighted least
squares fit of coalition removals by sums of shares, under the constraint that the shares of all filters add up to
what all remove: its normal equations are solved in rationals once, as a linear map of the 32 removals.

An identical text table-wide is found without sending all copies to one task: copies are counted by (text, part, labels)
first, and only these counts meet by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.operators.spread import lookup_join

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
BLANK = r"[\x20\x09-\x0D]+"
_OUT = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *[
    (c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]])


def solve(rows: list[list[Fraction]], n: int) -> list[list[Fraction]]:
    """Right-hand sides of ``rows`` (``n`` unknowns first) after Gauss-Jordan elimination in rationals."""
    rows = [list(r) for r in rows]
    for c in range(n):
        p = next(i for i in range(c, n) if rows[i][c])
        rows[c], rows[p] = rows[p], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for i in range(n):
            if i != c and rows[i][c]:
                rows[i] = [x - rows[i][c] * y for x, y in zip(rows[i], rows[c])]
    return [r[n:] for r in rows]


def shapley_map(n: int = len(FILTERS)) -> list[list[Fraction]]:
    """Row i holds what the removal of each coalition adds to the share of filter i.

    Minimises the sum over coalitions S, neither empty nor full, of w(S) (v(S) - shares in S)^2 with
    w(S) = (n - 1) / (C(n, s) s (n - s)), subject to the shares adding up to v(all).
    """
    size = 1 << n
    weight = lambda s: Fraction(n - 1, comb(n, s) * s * (n - s))
    inner = [(S, weight(S.bit_count())) for S in range(1, size - 1)]
    has = lambda S, i: S >> i & 1
    rows = []
    for i in range(n):
        left = [sum((w for S, w in inner if has(S, i) and has(S, j)), Fraction()) for j in range(n)]
        right = [Fraction()] * size
        for S, w in inner:
            if has(S, i):
                right[S] = w
        rows.append([*left, Fraction(1), *right])
    rows.append([*[Fraction(1)] * n, Fraction(0), *[Fraction(int(S == size - 1)) for S in range(size)]])
    return solve(rows, n + 1)[:n]


def _steps() -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Of every order and step: its name, the coalition before, the coalition after and the filter."""
    names, before, filters = [], [], []
    for order in permutations(range(len(FILTERS))):
        done = 0
        for i in order:
            names.append("".join(FILTERS[k] for k in order))
            before.append(done)
            filters.append(i)
            done |= 1 << i
    before, filters = np.array(before), np.array(filters)
    return names, before, before | 1 << filters, filters


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, before, after, which = _steps()
    orders = len(names) // len(FILTERS)
    share = np.array([[int(x * orders) for x in row] for row in shapley_map()], np.int64)
    step = np.tile(np.arange(1, len(FILTERS) + 1), orders)
    for batch in batches:
        for row in batch.to_pylist():
            v, good, toxic = (np.array(row[c], np.int64) for c in ("removed", "good", "toxic"))
            removed = v[after] - v[before]
            columns = [
                [row["part"]] * len(names), names, step, row["n"] - v[after], removed, v[1 << which] - removed,
                v[ALL] - v[ALL ^ (1 << which)], good[after] - good[before], toxic[after] - toxic[before], (share @ v)[which]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT)], schema=_OUT)


def _own_failures(text: Column) -> Column:
    """Bits of the filters that look at one text alone: A, B, C and D."""
    words = F.array_remove(F.split(text, BLANK), "")
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]", ""))
    fails = [F.size(words) < 100, 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
             100 * capitals > 10 * F.char_length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def coalition_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per ``part`` its documents ``n`` and, by coalition, how many are ``removed`` by it, of these ``good`` and ``toxic``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"),
                      F.unhex(F.sha2(text, 256)).alias("key"), _own_failures(text).alias("mask"))
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").eqNullSafe(1).alias("good"),
                          F.col("toxic").eqNullSafe(1).alias("toxic"))
    marks = marks.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    ids = own.groupBy("key", "part", "mask", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    marked = lookup_join(ids, marks.where("good OR toxic"), ["doc_id"], ["key"], "left", ways=8)
    group = ["key", "part", "mask", "good", "toxic"]
    no = F.lit(False)
    texts = marked.withColumns({"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)}).groupBy(*group).agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_no_id"))
    first = F.min("least.doc_id").over(Window.partitionBy("key"))
    kept = F.col("n_no_id") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    copies = 1 << FILTERS.index("E")
    split = texts.withColumn("first", first).withColumn("kept", kept).select(*group, F.explode(F.array(
        F.struct(F.col("mask").alias("failed"), F.col("kept").alias("m")),
        F.struct((F.col("mask") + copies).alias("failed"), (F.col("n") - F.col("kept")).alias("m")))).alias("x"))
    masks = split.where("x.m > 0").groupBy("part", F.col("x.failed").alias("failed")).agg(
        F.sum("x.m").alias("n"), F.sum(F.when(F.col("good"), F.col("x.m")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("x.m")).otherwise(0)).alias("toxic"))
    removals = lambda c: F.array(*[F.sum(F.when(F.col("failed").bitwiseAND(F.lit(S)) != 0, F.col(c)).otherwise(0))
                                   for S in range(ALL + 1)])
    return masks.groupBy("part").agg(F.sum("n").alias("n"), removals("n").alias("removed"), removals("good").alias("good"), removals("toxic").alias("toxic"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and order, five rows: ``part``, ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``, ``unique_fails``,
    ``good_lost``, ``toxic_lost``, ``shapley`` (over all 120 orders).

    A part is a value of ``lang``; a null one counts as the empty string. A null text is empty (it fails A only). A row without
    an id is no copy and makes none; rows that repeat an id and a text are each counted, none as a copy of the other. Of labels that
    repeat an id, a 1 counts before anything else; labels without an id are ignored. An empty table gives no rows; other
    columns are ignored, whatever their names.
    """
    return coalition_counts(docs, labels).mapInArrow(
        _report, "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
        "good_lost bigint, toxic_lost bigint, shapley bigint")


SQL = r"""
WITH words AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
  marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
        FROM labels GROUP BY doc_id),
  failed AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        (CASE WHEN len(w) < 100 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END)
        + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END)
        + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
        + (CASE WHEN min(words.doc_id) OVER (PARTITION BY t) < words.doc_id THEN 16 ELSE 0 END) AS mask
        FROM words LEFT JOIN marks ON marks.doc_id = words.doc_id),
  masks AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, mask),
  letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit),
  orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS o FROM letter a, letter b, letter c, letter d, letter e
        WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
  steps AS (SELECT o, k AS step, bit, coalesce((SELECT sum(x.bit) FROM letter x WHERE strpos(o, x.c) < k), 0) AS before
        FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS k), letter WHERE strpos(o, c) = k),
  counted AS (SELECT part, o AS filter_order, step, bit,
        sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
        FROM masks, (SELECT o, step, bit, CAST(before AS BIGINT) AS before FROM steps) GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM counted
"""
