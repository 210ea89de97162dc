"""Proposing one display name per barcode from what the chains call it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions import text
from shelfwise.operators.spread import FEW_KEYS_WAYS, lookup_join, min_by_order

# Fixed value: the length some exports cut names to.
CAPPED_LENGTH = 20


def one_per_chain(names: DataFrame) -> DataFrame:
    """One row per chain and barcode, that of the least store: a chain votes once, however many stores it has."""
    values = [c for c in names.columns if c not in ("chain_id", "barcode", "store_id")]
    return min_by_order(names, ["chain_id", "barcode"], [F.col("store_id")], ["store_id", *values])


def capping_chains(names: DataFrame) -> DataFrame:
    """Longest name of each chain, and whether it is exactly the cap."""
    named = names.filter(F.coalesce("name", F.lit("")) != "")
    longest = named.groupBy("chain_id").agg(F.max(F.length("name")).cast("bigint").alias("longest"))
    return longest.withColumn("capped", (F.col("longest") == CAPPED_LENGTH).cast("int"))


def candidates(names: DataFrame, barcodes: DataFrame | None = None) -> DataFrame:
    """Unescaped names with the capping mark of their chain."""
    named = names.filter(F.coalesce("name", F.lit("")) != "")
    if barcodes is not None:
        named = lookup_join(named, barcodes.select("barcode").distinct(), ["barcode"], ["name"], "left_semi")
    marked = lookup_join(named, capping_chains(names).select("chain_id", "capped"), ["chain_id"], ["barcode"], "inner", FEW_KEYS_WAYS)
    return marked.withColumn("name", text.unescape_name(F.col("name")))


def propose(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Most frequent name per undecided barcode.

    Names of uncapped chains are preferred; on a tie the longest name wins and
    the source says so. Counting narrows in three steps, each combined before
    its shuffle: by name, by number of votes, by barcode.
    """
    open_rows = rows.join(decided.select("barcode").distinct(), "barcode", "left_anti")
    votes = open_rows.groupBy("barcode", "capped", "name").agg(F.count(F.lit(1)).alias("n"))
    tally = votes.groupBy("barcode", "capped", "n").agg(
        F.count(F.lit(1)).alias("tied"),
        F.max(F.struct(F.length("name").alias("l"), F.col("name"))).alias("longest"),
        F.min("name").alias("only"))
    # The least `capped` is the trusted pool when it exists.
    best = tally.groupBy("barcode").agg(F.max(F.struct(
        (-F.col("capped")).alias("trust"), F.col("n"), F.col("tied"), F.col("longest"), F.col("only"))).alias("b"))
    pool = F.when(F.col("b.trust") == 0, "trusted").otherwise("capping-fallback")
    tie = F.col("b.tied") > 1
    return best.select(
        "barcode", F.when(tie, F.col("b.longest.name")).otherwise(F.col("b.only")).alias("name"),
        F.when(tie, F.concat(pool, F.lit("/tie-longest"))).otherwise(pool).alias("source"),
        F.col("b.n").alias("votes"))


def propose_brand(rows: DataFrame) -> DataFrame:
    """Most common non-blank manufacturer in the pool that names a barcode."""
    pool = rows.groupBy("barcode").agg(F.min("capped").alias("_pool"))
    votes = rows.filter(F.trim(F.coalesce("manufacturer", F.lit(""))) != "").groupBy(
        "barcode", "capped", "manufacturer").agg(F.count(F.lit(1)).alias("n"))
    pooled = votes.join(pool, "barcode").filter(F.col("capped") == F.col("_pool"))
    best = pooled.groupBy("barcode").agg(F.min(F.struct((-F.col("n")).alias("k"), F.col("manufacturer"))).alias("b"))
    return best.select("barcode", F.col("b.manufacturer").alias("brand"))


def review_rows(proposals: DataFrame, brands: DataFrame, rows: DataFrame) -> DataFrame:
    """Review sheet: proposal, brand, votes cast and the candidates seen.

    One candidate is listed per chain and name, so a list is as long as the
    chains are many.
    """
    seen = rows.select("barcode", "chain_id", "name").distinct().groupBy("barcode").agg(
        F.concat_ws(" | ", F.sort_array(F.collect_list(F.concat_ws(": ", "chain_id", "name")))).alias("candidates"))
    counts = rows.groupBy("barcode").agg(F.count(F.lit(1)).alias("chains"))
    out = proposals.join(brands, "barcode", "left").join(counts, "barcode").join(seen, "barcode")
    return out.select("barcode", F.col("name").alias("proposed_name"), "source",
                      F.coalesce("brand", F.lit("")).alias("brand"), "chains", "candidates")
