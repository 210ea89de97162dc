"""Joins that stay balanced when one key holds a large share of the rows.

A side is broadcast only when a bound on its size is within the session's own
limit; otherwise the unique side is copied under a few salts
and the other side picks one, so a hot key is shared by several tasks. The salt in
the key also means that no later step can rely on the join's partitioning, which
leaves adaptive execution free to split a skewed partition as far as needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, functions as F

WAYS = 2
# For keys with few values, such as the chain, where one value is always large.
FEW_KEYS_WAYS = 64
UNPACKED = 4
# Keys with so many values that a sort seldom looks beyond them.
MANY_VALUES = ("barcode",)


def lookup_bytes(df: DataFrame) -> int | None:
    """Bound on the size of a lookup table, from plan statistics; no job is run.

    The optimiser multiplies the sizes of joined inputs, which says nothing
    about lookups joined one-to-one. A lookup built with filters, aggregates
    and such joins has no more rows than its files, so ``UNPACKED`` times their
    size bounds it as well, and the lesser bound counts.
    """
    if not hasattr(df, "_jdf"):  # no JVM handle (Connect): the size is unknown
        return None
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    files = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return min(int(plan.stats().sizeInBytes()), UNPACKED * files)


def fits_broadcast(df: DataFrame) -> bool:
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    size = lookup_bytes(df)
    return size is not None and size <= _as_bytes(limit)


def _as_bytes(text: str) -> int:
    text = text.strip().lower().rstrip("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], 1)
    return int(text[:-1]) * scale if scale > 1 else int(text)


def widen(scan: DataFrame) -> DataFrame:
    """Spread a scan of few splits over all cores before heavy per-row work.

    A scan with at least as many splits as cores is returned unchanged.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, *scan.columns)


def lookup_join(big: DataFrame, small: DataFrame, on: list[str], spread_by: list[str],
                how: str = "left", ways: int = WAYS) -> DataFrame:
    """Join ``big`` to ``small``, which has at most a few rows per key.

    ``spread_by`` are columns of ``big`` that vary inside one key.
    """
    if fits_broadcast(small):
        return big.join(F.broadcast(small), on, how)
    return spread_join(big, small, on, spread_by, how, ways)


def spread_join(big: DataFrame, small: DataFrame, on: list[str], spread_by: list[str],
                how: str = "left", ways: int = WAYS) -> DataFrame:
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(ways)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    return hashed_join(salted, copies, [*on, "_salt"], how).drop("_salt")


def hashed_join(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join on equal ``on``, with a hash of them as the first key.

    Spark sorts rows by the first key and compares the others only where it ties. A chain ties for most rows, a hash for rows
    of one key and a few others; 32 bits of it, because more are shuffled whole. With an item among the keys its hash alone, so that
    rows of an item lie together and compress. Keys of different types, which a join makes equal first, are joined plainly.
    """
    kinds, others = dict(left.dtypes), dict(right.dtypes)
    if any(kinds[c] != others[c] for c in on):
        return left.join(right, on, how)
    columns = [*on, *[c for c in left.columns if c not in on]]
    if how not in ("left_semi", "left_anti"):
        columns += [c for c in right.columns if c not in on]
    key = _hash(on)
    return left.withColumn("_key", key).join(right.withColumn("_key", key), ["_key", *on], how).select(*columns)


def grouped(df: DataFrame, keys: list[str]) -> GroupedData:
    """Groups by ``keys`` with a hash of them as the first key, for aggregates that Spark sorts: see :func:`hashed_join`."""
    return df.withColumn("_key", _hash(keys)).groupBy("_key", *keys)


def _hash(keys: list[str]) -> Column:
    return F.hash(*([c for c in keys if c in MANY_VALUES] or keys))


def many_first(keys: list[str]) -> list[str]:
    """Keys of many values first: groups and joins by all of them are sorted as fast as by a hash, and where both go by the same
    keys in this order, groups are joined where they are, without a shuffle."""
    return sorted(keys, key=lambda c: c not in MANY_VALUES)


def exists_join(big: DataFrame, keys: DataFrame, on: list[str], spread_by: list[str],
                how: str = "left_semi") -> DataFrame:
    """Keep (``left_semi``) or drop (``left_anti``) rows of ``big`` by key."""
    return lookup_join(big, keys.select(*on).distinct(), on, spread_by, how)


def max_by_order(df: DataFrame, keys: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """One row per key, the values of the greatest order; combined map-side."""
    best = F.max(F.struct(
        *[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(v) for v in values]
    )).alias("_best")
    return grouped(df, keys).agg(best).select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])


def min_by_order(df: DataFrame, keys: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """One row per key, the values of the least order; combined map-side."""
    best = F.min(F.struct(
        *[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(v) for v in values]
    )).alias("_best")
    return grouped(df, keys).agg(best).select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])
