"""Gates a built mart must pass before it is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.operators.prices import cheapest_rows
from shelfwise.operators.spread import FEW_KEYS_WAYS, exists_join, lookup_join

# The least a national mart holds.
MINIMUMS = {"barcodes": 50_000, "chains with prices": 3, "stores": 100, "cities": 20}
MIN_RELEASE_PRODUCTS = 200_000


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, one row per table."""
    out = None
    for name, table in tables.items():
        one = table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def minimum_counts(products: DataFrame, base: DataFrame, stores: DataFrame,
                   minimums: dict[str, int] | None = None) -> DataFrame:
    """Each counted thing with its minimum and whether it is met."""
    floor = minimums or MINIMUMS
    named = stores.filter(F.coalesce("city", F.lit("")) != "")
    counts = table_counts({
        "barcodes": products,
        "chains with prices": base.select("chain_id").distinct(),
        "stores": stores,
        "cities": named.select("city").distinct(),
    })
    least = F.create_map(*[F.lit(x) for kv in floor.items() for x in kv])
    return counts.select(
        F.col("table_name").alias("label"), F.col("rows").alias("actual"),
        F.get(F.array(least[F.col("table_name")]), F.lit(0)).cast("bigint").alias("minimum"),
        (F.col("rows") >= least[F.col("table_name")]).cast("int").alias("ok"))


def orphan_prices(base: DataFrame, products: DataFrame) -> DataFrame:
    """Baseline prices of barcodes without a product."""
    return exists_join(base, products, ["barcode"], ["chain_id"], "left_anti")


def stranded_offers(offers: DataFrame, links: DataFrame, terms: list[str]) -> DataFrame:
    """Offers that no branch honours."""
    return offers.join(links.select(*terms).distinct(), terms, "left_anti")


def inconsistent_units(offers: DataFrame) -> DataFrame:
    """Offers whose unit price is not total over quantity, to an agora."""
    exact = F.col("agorot").cast("decimal(18,0)") / F.col("min_qty").cast("decimal(10,3)")
    return offers.filter((F.col("min_qty") <= 0) | (F.abs(F.col("unit_agorot") - exact) > 1))


def live_view(stores: DataFrame, base: DataFrame, exc: DataFrame, products: DataFrame, chains: DataFrame, limit: int = 3) -> DataFrame:
    """A few cheapest named prices of stores in a city; empty means the mart does not answer. No item meets all its stores."""
    of_chains = lambda df, spread: lookup_join(df, chains.select("chain_id").distinct(), ["chain_id"], [spread], "left_semi", FEW_KEYS_WAYS)
    sold = lambda df, spread: of_chains(exists_join(df, products, ["barcode"], [spread]), spread)
    shops = stores.filter(F.coalesce("city", F.lit("")) != "")
    few = cheapest_rows(shops, sold(base, "chain_id"), sold(exc, "store_id"), limit)
    return F.broadcast(few).join(products.select("barcode", "name"), "barcode").select(
        "name", "barcode", "chain_id", "store_id", "agorot")


def release_gate(manifest: DataFrame, live_built_at: str, least: int = MIN_RELEASE_PRODUCTS) -> DataFrame:
    """Accept a build with enough products that is newer than the live one."""
    enough, newer = F.col("products") > least, F.col("built_at") > live_built_at
    why = F.when(~enough, "too few products").when(~newer, "not newer than the live build")
    return manifest.withColumns({"accepted": (enough & newer).cast("int"), "reason": why})


def stale_chains(chain_as_of: DataFrame, built_at: Column) -> DataFrame:
    """Chains whose data is from before the day of the build."""
    age = F.datediff(built_at.cast("date"), F.col("as_of").cast("date"))
    return chain_as_of.withColumn("days_old", age.cast("bigint")).filter("days_old > 0")


def unnamed_chains(rows: DataFrame, chains: DataFrame) -> DataFrame:
    """Chain ids in use that have no name; must be empty."""
    named = chains.filter(F.coalesce("name", F.lit("")) != "")
    return rows.select("chain_id").distinct().join(named.select("chain_id"), "chain_id", "left_anti")


def require_empty(df: DataFrame, message: str) -> None:
    """Stop the build when a check finds anything; looks at one row."""
    if df.limit(1).count():
        raise ValueError(message)


def failures(checks: dict[str, DataFrame]) -> DataFrame:
    """Findings of each named check, for those that found any."""
    return table_counts(checks).filter("rows > 0").withColumnRenamed("table_name", "check")
