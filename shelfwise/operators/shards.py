"""Published shards: which file each product goes to, and what it holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions import text
from shelfwise.operators.spread import lookup_join, max_by_order
from shelfwise.session import cut_lineage

# Prefix lengths and limits of the published files.
COUNT_LEVELS, MAX_ITEMS = (3, 6, 8), 2_000
DETAIL_LEVELS, DETAIL_BYTES = (3, 6, 8, 10, 13), 120_000
PROMO_LEVELS, PROMO_BYTES = (3, 6, 8, 10), 250_000
NAME_LEVELS, NAME_CHARS = (2, 3, 4), 200_000
MAX_FILES = 20_000


def prefix(key: Column, length: int) -> Column:
    return F.rpad(F.substring(key, 1, length), length, "0")


def assign(keys: DataFrame, levels: tuple[int, ...], limit: int, weight: Column, fixed: int = 0) -> DataFrame:
    """Add ``shard``: the shortest prefix whose bucket is within ``limit``.

    Buckets nest, so the totals of every level are rolled up from the deepest
    one and the keys themselves are counted once.
    """
    deepest = levels[-1]
    name = lambda level: f"_p{level}"
    # Stored, so that the texts are measured once for all levels.
    sizes = cut_lineage(keys.groupBy(prefix(F.col("barcode"), deepest).alias(name(deepest))).agg(F.sum(weight).alias("_w")))
    buckets = sizes
    for level in levels[:-1]:
        buckets = buckets.withColumn(name(level), F.substring(name(deepest), 1, level))
    # One size table per level, each aggregated from the next deeper one.
    totals, table = {}, buckets
    for level in reversed(levels[:-1]):
        table = table.groupBy(*[name(n) for n in levels if n <= level]).agg(F.sum("_w").alias("_w"))
        totals[level] = table.select(name(level), F.col("_w").alias(f"_t{level}"))
    choice = F.col(name(deepest))
    for level in reversed(levels[:-1]):
        buckets = lookup_join(buckets, totals[level], [name(level)], [name(deepest)], "inner")
        choice = F.when(F.col(f"_t{level}") + fixed <= limit, F.col(name(level))).otherwise(choice)
    mapping = cut_lineage(buckets.select(name(deepest), choice.alias("shard")))
    keyed = keys.withColumn(name(deepest), prefix(F.col("barcode"), deepest))
    return lookup_join(keyed, mapping, [name(deepest)], ["barcode"], "inner").drop(name(deepest))


def by_count(products: DataFrame, levels=COUNT_LEVELS, max_items: int = MAX_ITEMS) -> DataFrame:
    return assign(products, levels, max_items, F.lit(1))


def by_bytes(docs: DataFrame, levels=DETAIL_LEVELS, budget: int = DETAIL_BYTES) -> DataFrame:
    """``docs``: barcode, json. A shard's text is ``{"key":value,…}``."""
    weight = F.octet_length("barcode") + F.octet_length("json") + 4
    return assign(docs, levels, budget, weight, fixed=1)


def route(keys: DataFrame, shards: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """Longest listed prefix each barcode falls under; null when none."""
    asked = keys.select("barcode").distinct()
    tries = asked.select("barcode", F.explode(F.array(*[
        F.struct(F.lit(n).alias("level"), prefix(F.col("barcode"), n).alias("shard")) for n in levels])).alias("t"))
    listed = shards.select("shard").distinct()
    hits = lookup_join(tries.select("barcode", "t.*"), listed, ["shard"], ["barcode"], "inner")
    best = max_by_order(hits, ["barcode"], [F.col("level")], ["shard"])
    return asked.join(best, "barcode", "left")


def name_shards(term_rows: DataFrame, levels=NAME_LEVELS, limit: int = NAME_CHARS) -> DataFrame:
    """(shard, barcode) of the word shards.

    ``term_rows``: term, barcode, chars (length of the row's text). A bucket
    over the limit hands its longer words to deeper prefixes; a row all of
    whose words end at the prefix stays.
    """
    plain = F.translate(F.col("term"), text.QUOTE_MARKS, "")
    # Every level reads the rows several times; they are stored, so that the names are cut into words once.
    rows = cut_lineage(term_rows.select(plain.alias("w"), "barcode", "chars").filter(F.length("w") >= levels[0]))
    done, shards = None, rows
    for at, level in enumerate(levels):
        last = at == len(levels) - 1
        members = shards.groupBy(F.substring("w", 1, level).alias("shard"), "barcode").agg(
            F.max("chars").alias("chars"), F.max(F.length("w")).alias("_longest"))
        sizes = members.groupBy("shard").agg((F.sum("chars") + F.count(F.lit(1)) + 1).alias("_size"))
        deeper = sizes.filter((F.col("_size") > limit) & F.lit(not last)).select("shard", F.lit(1).alias("_deep"))
        marked = lookup_join(members, deeper, ["shard"], ["barcode"])
        stay = marked.filter(F.col("_deep").isNull() | (F.col("_longest") <= level)).select("shard", "barcode")
        done = stay if done is None else done.unionByName(stay)
        if last:
            break
        inside = shards.withColumn("shard", F.substring("w", 1, level)).filter(F.length("w") > level)
        shards = lookup_join(inside, deeper, ["shard"], ["barcode"], "left_semi").drop("shard")
    return done.distinct()


def write_shards(docs: DataFrame, path: str) -> None:
    """JSON lines by shard; a shard is bounded by its budget, so one file each. Shards of an earlier write go."""
    docs.repartition("shard").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("shard").json(path)


def limited(files: Column, strict: bool, message: Column) -> Column:
    """``files`` as it is, or with ``strict`` an error where the host's limit is passed."""
    return F.when(files > MAX_FILES, F.raise_error(message)).otherwise(files) if strict else files


def shard_index(shards: DataFrame, levels: tuple[int, ...], built_at: str, strict: bool = True) -> DataFrame:
    """The published index: levels and the sorted shard list.

    More than 20,000 shards are an error, or with ``strict`` off an index that :func:`over_limit` reports.
    """
    names = shards.select("shard").distinct()
    out = names.agg(F.count(F.lit(1)).alias("files"), F.sort_array(F.collect_set("shard")).alias("shards"))
    return out.select(limited(F.col("files"), strict, F.lit("too many shard files")).alias("files"), "shards",
                      F.array(*[F.lit(n) for n in levels]).alias("levels"), F.lit(built_at).alias("built_at"))


def over_limit(index: DataFrame) -> DataFrame:
    """Must be empty before an index is published: its number of files, where the host does not take so many."""
    return index.filter(F.col("files") > MAX_FILES).select("files")
