"""The nightly build: published rows to the tables that queries read."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.operators import catalog, offers, prices, quality, search
from shelfwise.operators.spread import max_by_order
from shelfwise.session import cut_lineage


@dataclass
class Sources:
    """Inputs of a build. Price rows carry ``order`` columns; later wins."""

    prices: DataFrame
    stores: DataFrame
    offers: DataFrame
    chains: DataFrame
    products: DataFrame
    product_categories: DataFrame
    decided_names: DataFrame
    chain_products: DataFrame
    order: list[str] = field(default_factory=list)
    today: str = ""


@dataclass
class Raw:
    """Parts as published, before a build: rows of several feeds that may disagree on ids and names.

    ``prices``: price rows with ``subchain_id``, ``name``, units and ``is_weighted``; ``stores``: branch rows with ``subchain_id``,
    ``store_name``, ``city``, ``address`` and ``chain_name``; ``offers``: offer rows. The rest are lookups: ``brands`` (chain_id, sub,
    brand_name), ``aliases`` (wrong_id, right_id), ``city_codes`` (code, city_name), ``branch_ids`` and ``locations``, ``display``
    (chain_id, display_name).
    """

    prices: DataFrame
    stores: DataFrame
    offers: DataFrame
    brands: DataFrame
    aliases: DataFrame
    city_codes: DataFrame
    branch_ids: DataFrame
    locations: DataFrame
    display: DataFrame
    product_categories: DataFrame
    decided_names: DataFrame
    order: list[str] = field(default_factory=list)
    today: str = ""


def prepare(raw: Raw) -> Sources:
    """Sources of a build: mistaken chain ids put right, sub-brands split off, stores with their city, place and chain name.

    Prices and offers published under a mistaken id move to the right one; its store rows go, since the right id has its own.
    A product's own name in a chain is kept for weighed items, and for items other chains call by those barcodes.
    """
    fixed = prices.correct_chain_ids(raw.prices, raw.aliases, ["barcode"])
    observed = prices.split_chains(fixed, raw.brands).drop("brand_name")
    shops = prices.split_chains(prices.drop_aliased(raw.stores, raw.aliases), raw.brands)
    shops = prices.resolve_cities(shops, raw.city_codes).withColumn("city", F.coalesce("city_name", F.lit("")))
    shops = prices.locate_stores(shops, raw.branch_ids, raw.locations)
    brands = shops.filter("brand_name is not null").select("chain_id", "brand_name").distinct()
    named = shops.groupBy("chain_id").agg(F.min("chain_name").alias("file_name")).withColumn("source", F.col("chain_id"))
    chains = prices.chain_names(named, brands, raw.display)
    products = prices.product_rows(observed, raw.order)
    # What a chain calls an item: its last named row.
    keyed = observed.filter("coalesce(name, '') <> ''").withColumn("part", F.col("chain_id"))
    kinds = ["name", "unit_qty", "unit_of_measure", "is_weighted"]
    own = max_by_order(keyed, ["part", "barcode"], [F.col(c) for c in raw.order], kinds)
    sold = observed.select(F.col("chain_id").alias("part"), "chain_id", "barcode").distinct()
    claimed = catalog.weighed_products(own, sold)
    return Sources(
        prices=observed, stores=shops.drop("brand_name", "chain_name"), offers=prices.correct_chain_ids(raw.offers, raw.aliases, ["barcode"]),
        chains=chains, products=products, product_categories=raw.product_categories, decided_names=raw.decided_names,
        chain_products=catalog.claim_disagreements(claimed, own, sold), order=raw.order, today=raw.today)


# Files are laid out by chain and sorted by barcode, so that a chain filter
# prunes folders and a barcode filter skips row groups.
LAYOUT = {
    "chain_prices": (["chain_id"], ["barcode"]),
    "price_exceptions": (["chain_id"], ["barcode", "store_id"]),
    "promo_offers": (["chain_id"], ["barcode"]),
    "promo_stores": (["chain_id"], ["barcode", "store_id"]),
    "deals": (["chain_id"], ["barcode"]),
    "deal_branches": (["chain_id"], ["store_id", "deal_id"]),
    "product_tokens": ([], ["token", "barcode"]),
    "postings": ([], ["token", "barcode"]),
    "deal_postings": ([], ["token", "barcode"]),
}


def build_mart(spark: SparkSession, src: Sources, save=None) -> dict[str, DataFrame]:
    """All mart tables, in dependency order.

    ``save(name, df)`` is called once per table and its result is used by the
    later ones: pass a writer to read back each stored stage instead of
    computing it again.
    """
    keep = save or (lambda name, df: df)
    out: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        out[name] = keep(name, df)
        return out[name]

    latest = put("latest_prices", prices.latest_prices(src.prices, src.order))
    base = put("chain_prices", prices.baselines(latest))
    stores = put("stores", prices.drop_priceless(prices.priced_items(latest, src.stores), base, ["store_id"]))
    put("chains", prices.drop_priceless(src.chains, base, ["chain_id"]))
    exc = put("price_exceptions", prices.exceptions(latest, base))

    rows = prices.drop_priceless(offers.attribute_brands(src.offers, stores), base, ["barcode"])
    promo, linked = offers.build_offers(rows, base, exc)
    promo = put("promo_offers", promo)
    linked = put("promo_stores", linked)

    products = put("products", catalog.mart_products(src.products, src.product_categories, src.decided_names))
    put("chain_products", src.chain_products)
    merged, links, everywhere = offers.read_merge(promo, linked, src.today)
    put("promo_everywhere", everywhere)
    kept, kept_links = offers.prune_dominated(merged, cut_lineage(links))
    kept, kept_links = keep("kept_offers", kept), keep("kept_links", kept_links)
    deals = put("deals", offers.build_deals(
        kept, base, products, src.chain_products, src.product_categories))
    put("deal_branches", offers.deal_branches(deals, kept_links))
    put("deal_products", offers.best_deal_per_product(deals))
    put("store_bits", offers.store_bits(stores, linked))

    put("product_tokens", search.product_tokens(products))
    docs = put("search_docs", search.index_docs(products))
    put("postings", search.postings(docs))
    discounted = deals.filter("discount_tenths > 0")
    put("deal_postings", search.postings(search.index_docs(products, discounted)))
    put("fts_filler", search.filler_words(docs))
    return out


def stage_writer(spark: SparkSession, root: str, run: str):
    """A ``save`` for :func:`build_mart`: Parquet under ``root/run``, read back."""

    def save(name: str, df: DataFrame) -> DataFrame:
        path = f"{root}/run={run}/{name}"
        parts, order = LAYOUT.get(name, ([], []))
        if parts:
            # Range, not hash, so that a large chain is split over many tasks.
            df = df.repartitionByRange(*parts, *order).sortWithinPartitions(*parts, *order)
        elif order:
            df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        # A run written again replaces all of its folders, also those of chains that are gone.
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*parts) if parts else writer).parquet(path)
        back = spark.read.schema(df.schema).parquet(path)
        return back.select(*df.columns)

    return save


def manifest(tables: dict[str, DataFrame], built_at: str, sources: list[str]) -> DataFrame:
    """Row counts with the moment and the inputs of the build."""
    return quality.table_counts(tables).withColumns({
        "built_at": F.lit(built_at), "sources": F.array(*[F.lit(s) for s in sorted(sources)])})


def publish(spark: SparkSession, root: str, run: str, checks: dict[str, DataFrame]) -> None:
    """Point readers at a run once every check is empty.

    The pointer is the last thing written; until then readers see the old run.
    """
    for name, found in checks.items():
        quality.require_empty(found, f"{name}: the new mart is not published")
    pointer = spark.range(1).select(F.lit(run).alias("run"), F.lit(datetime.now().isoformat()).alias("published_at"))
    pointer.coalesce(1).write.mode("append").json(f"{root}/published")


def current_run(spark: SparkSession, root: str) -> str:
    rows = spark.read.schema("run string, published_at string").json(f"{root}/published")
    return rows.orderBy(F.desc("published_at")).first()["run"]
