"""Ids that never change, worklists that resume, snapshots that grow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.operators.numbering import running_total
from shelfwise.operators.spread import max_by_order


def derived_id(namespace: str, *keys: Column) -> Column:
    """Opaque id in UUID form, the same whenever a lost task is run again."""
    h = F.md5(F.concat_ws("|", F.lit(namespace), *keys))
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(h, at, n) for at, n in cut])


def append_ids(known: DataFrame, seen: DataFrame, keys: list[str], namespace: str) -> DataFrame:
    """Known ids unchanged, plus an id for every new key."""
    new = seen.select(*keys).distinct().join(known.select(*keys), keys, "left_anti")
    ids = new.withColumn("uid", derived_id(namespace, *[F.col(k) for k in keys]))
    return known.select(*keys, "uid").unionByName(ids)


def worklist(inputs: DataFrame, state: DataFrame, key: str, ready: Column) -> DataFrame:
    """Inputs without a recorded outcome: pending, or settled at once.

    A failed attempt is not in ``state`` and so stays pending.
    """
    todo = inputs.join(state.select(key), key, "left_anti")
    return todo.withColumn("status", F.when(ready, "pending").otherwise("no_address"))


def union_snapshots(probes: DataFrame, key: str, order: list[str], volatile: list[str]) -> DataFrame:
    """Every id ever returned with its latest record, volatile fields dropped."""
    values = [c for c in probes.columns if c != key and c not in order and c not in volatile]
    usable = probes.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    return max_by_order(usable, [key], [F.col(c) for c in order], values)


def coverage_curve(probes: DataFrame, probe: str, key: str) -> DataFrame:
    """New and total distinct ids after each probe, in probe order."""
    first = probes.groupBy(key).agg(F.min(probe).alias(probe))
    new = first.groupBy(probe).agg(F.count(F.lit(1)).alias("new_ids"))
    every = probes.groupBy(probe).agg(F.count(F.lit(1)).alias("returned"))
    rows = every.join(new, probe, "left").withColumn("new_ids", F.coalesce("new_ids", F.lit(0).cast("bigint")))
    return running_total(rows, [], [probe], "new_ids", "total_ids")
