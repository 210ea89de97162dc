"""Checking a curated list of weighed produce against current prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.operators.prices import ITEM_KEY


def reconcile(units: DataFrame, chain_products: DataFrame, base: DataFrame,
              tolerance_pct: int = 50) -> DataFrame:
    """Every curated row with its current price and what is wrong with it.

    ``units``: slug, chain_id, barcode, agorot. The first row of a (slug,
    chain) counts, by barcode; the others are duplicates.
    """
    first = units.groupBy("slug", "chain_id").agg(F.min("barcode").alias("_first"))
    now = base.select(*ITEM_KEY, F.col("agorot").alias("now"))
    sold = chain_products.select(*ITEM_KEY, "name", "is_weighted")
    rows = units.join(first, ["slug", "chain_id"]).join(now, ITEM_KEY, "left").join(sold, ITEM_KEY, "left")
    drift = F.abs(F.col("now") - F.col("agorot")) * 100 > F.col("agorot") * tolerance_pct
    status = (
        F.when(F.col("barcode") != F.col("_first"), "listed twice")
        .when(F.col("now").isNull(), "no longer priced")
        .when(F.coalesce("is_weighted", F.lit(0)) != 1, "no longer weighed")
        .when(drift, "drifted").otherwise("ok"))
    return rows.select("slug", "chain_id", "barcode", "agorot", "now", status.alias("status"))


def wide_lines(units: DataFrame, ratio: int = 8, more_than: int = 3) -> DataFrame:
    """Lines whose dearest row is many times the cheapest."""
    out = units.groupBy("slug").agg(
        F.count(F.lit(1)).alias("rows"), F.min("agorot").alias("low"), F.max("agorot").alias("high"))
    return out.filter((F.col("rows") > more_than) & (F.col("high") > F.col("low") * ratio))


def chain_share(units: DataFrame) -> DataFrame:
    """Chains carrying each line, of all chains in the list."""
    pairs = units.select("slug", "chain_id").distinct()
    total = units.select("chain_id").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    out = pairs.groupBy("slug").agg(F.count(F.lit(1)).alias("chains"))
    return out.withColumn("all_chains", total).withColumn(
        "is_core", (F.col("chains") * 10 >= F.col("all_chains") * 4).cast("int"))
