"""The mart, rebuilt only for the chains whose files changed.

No table row depends on two chains, so every table is stored by chain. A digest tree says which chains changed: one
digest per folder of files, one per chain over its folders. The others are adopted: the new run points at the folders of the
run that built them, and nothing is read or copied. Deals are numbered inside their chain; a deal's id adds the rows of the
chains before it, which the run's list of parts holds.

A run is complete before anything points at it: tables, then the list of parts, then (``mart.publish``) the pointer.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.operators import catalog, offers, prices, search
from shelfwise.plans.mart import LAYOUT, Sources
from shelfwise.session import cut_lineage, shuffles_dropped

CHAIN_TABLES = ("latest_prices", "chain_prices", "price_exceptions", "stores", "promo_offers", "promo_stores", "promo_everywhere", "kept_offers",
                "kept_links", "chain_deals", "chain_deal_branches", "store_bits")
# Builds that run at a time: enough to fill the cores while one of them is planned or ends.
SIDE_BY_SIDE = 3
PARTS = "table string, chain_id string, run string, rows bigint"
CHAINS = "chain_id string, digest string, run string, built_at string"


def file_digests(files: DataFrame) -> DataFrame:
    """``chain_id`` and ``digest`` from ``chain_id``, ``folder``, ``path``, ``size`` and ``modified`` of its files.

    The digest of a folder is made of sums that combine before the shuffle, whatever its number of files.
    """
    own = F.xxhash64("path", "size", "modified")
    folders = files.groupBy("chain_id", "folder").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("size").cast("decimal(38,0)")).alias("bytes"), F.bit_xor(own).alias("x"),
        F.sum(own.cast("decimal(38,0)")).alias("s"))
    named = folders.select("chain_id", "folder", F.sha2(F.concat_ws("|", "n", "bytes", "x", "s"), 256).alias("d"))
    tree = F.sort_array(F.collect_list(F.concat_ws(":", "folder", "d")))
    return named.groupBy("chain_id").agg(F.sha2(F.array_join(tree, ","), 256).alias("digest"))


@dataclass
class Run:
    """A stored run. Its lists are as long as the chain list times the tables."""

    spark: SparkSession
    root: str
    name: str

    def path(self, table: str) -> str:
        return f"{self.root}/run={self.name}/{table}"

    def chains(self) -> dict[str, dict]:
        return {r.chain_id: r.asDict() for r in self.spark.read.schema(CHAINS).json(self.path("_chains")).collect()}

    def parts(self) -> list[dict]:
        return [r.asDict() for r in self.spark.read.schema(PARTS).json(self.path("_parts")).collect()]

    def table(self, name: str) -> DataFrame:
        """A table of the run, its parts read where they were built."""
        if name not in CHAIN_TABLES:
            return self.spark.read.parquet(self.path(name))
        schema, found = self._schema(name), None
        by_run: dict[str, list[str]] = {}
        for p in self.parts():
            if p["table"] == name and p["rows"]:
                by_run.setdefault(p["run"], []).append(p["chain_id"])
        for run, chains in sorted(by_run.items()):
            base = f"{self.root}/run={run}/{name}"
            own = self.spark.read.schema(schema).option("basePath", base).parquet(base).filter(F.col("chain_id").isin(chains))
            found = own if found is None else found.unionByName(own)
        return self.spark.createDataFrame([], schema) if found is None else found

    def _schema(self, name: str):
        from pyspark.sql import types as T

        [row] = self.spark.read.schema("name string, schema string").json(self.path("_schemas")).filter(F.col("name") == name).collect()
        return T.StructType.fromJson(json.loads(row["schema"]))

    def deals(self) -> DataFrame:
        """All deals with their ids in the order of all chains."""
        return self._with_ids(self.table("chain_deals"))

    def deal_branches(self) -> DataFrame:
        return self._with_ids(self.table("chain_deal_branches"))

    def _with_ids(self, rows: DataFrame) -> DataFrame:
        before, first = 0, []
        for p in sorted((p for p in self.parts() if p["table"] == "chain_deals"), key=lambda p: p["chain_id"].encode()):
            first.append((p["chain_id"], before))
            before += p["rows"]
        offsets = self.spark.createDataFrame(first, "chain_id string, _before bigint")
        return rows.join(F.broadcast(offsets), "chain_id").withColumn("deal_id", F.col("_before") + F.col("number")).drop("_before", "number")


def _chain_tables(src: Sources, put) -> None:
    latest = put("latest_prices", prices.latest_prices(src.prices, src.order))
    base = put("chain_prices", prices.baselines(latest))
    stores = put("stores", prices.drop_priceless(prices.priced_items(latest, src.stores), base, ["store_id"]))
    exc = put("price_exceptions", prices.exceptions(latest, base))
    rows = prices.drop_priceless(offers.attribute_brands(src.offers, stores), base, ["barcode"])
    promo, linked = offers.build_offers(rows, base, exc)
    promo, linked = put("promo_offers", promo), put("promo_stores", linked)
    merged, links, everywhere = offers.read_merge(promo, linked, src.today)
    put("promo_everywhere", everywhere)
    kept, kept_links = offers.prune_dominated(merged, cut_lineage(links))
    kept, kept_links = put("kept_offers", kept), put("kept_links", kept_links)
    products = catalog.mart_products(src.products, src.product_categories, src.decided_names)
    deals = put("chain_deals", offers.build_deals(kept, base, products, src.chain_products, src.product_categories, group=["chain_id"], out="number"))
    put("chain_deal_branches", links_of(deals, kept_links))
    put("store_bits", offers.store_bits(stores, linked))


def links_of(deals: DataFrame, links: DataFrame) -> DataFrame:
    return links.join(deals.select("number", *offers.READ_TERMS), offers.READ_TERMS).select("chain_id", "number", "store_id")


def build(spark: SparkSession, root: str, run: str, src: Sources, files: DataFrame, categories: DataFrame, built_at: str,
          previous: str | None = None, sources: tuple[str, ...] = ()) -> Run:
    """Build ``run`` from ``src``, taking over from ``previous`` what did not change.

    Chains without files are gone. A run of the same name that was broken off is written again from its start.
    """
    made, before = Run(spark, root, run), {}
    old_parts: list[dict] = []
    if previous is not None:
        old = Run(spark, root, previous)
        before, old_parts = old.chains(), old.parts()
    now = {r.chain_id: r.digest for r in file_digests(files).collect()}
    changed = sorted(c for c, d in now.items() if c not in before or before[c]["digest"] != d)
    schemas: dict[str, str] = {}
    stored: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        order = LAYOUT.get(name, ([], ["barcode"] if "barcode" in df.columns else ["store_id"]))[1]
        # Range, not hash, so that a large chain is split over many tasks.
        laid = df.repartitionByRange("chain_id", *order).sortWithinPartitions("chain_id", *order)
        laid.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("chain_id").parquet(made.path(name))
        schemas[name] = df.schema.json()
        stored[name] = spark.read.schema(df.schema).parquet(made.path(name)).select(*df.columns)
        return stored[name]

    own = lambda df: df.filter(F.col("chain_id").isin(changed)) if changed else df.filter("false")
    if changed or previous is None:
        with shuffles_dropped(spark):
            _chain_tables(replace(src, prices=own(src.prices), stores=own(src.stores), offers=own(src.offers), chain_products=own(src.chain_products)), put)
    else:
        schemas = {n: old._schema(n).json() for n in CHAIN_TABLES}
    counts = _rows_by_chain(stored)
    adopted = [{**p} for p in old_parts if p["chain_id"] in now and p["chain_id"] not in changed]
    parts = adopted + [{"table": t, "chain_id": c, "run": run, "rows": counts.get((t, c), 0)} for t in CHAIN_TABLES for c in changed]
    chains = [{"chain_id": c, "digest": d, "run": run if c in changed else before[c]["run"],
               "built_at": built_at if c in changed else before[c]["built_at"]} for c, d in now.items()]

    def listed(name: str, rows: list[dict], ddl: str) -> None:
        spark.createDataFrame([tuple(r[f.split()[0]] for f in ddl.split(", ")) for r in rows], ddl).coalesce(1).write.mode("overwrite").json(made.path(name))

    listed("_schemas", [{"name": n, "schema": s} for n, s in schemas.items()], "name string, schema string")
    listed("_chains", chains, CHAINS)
    listed("_parts", parts, PARTS)
    with shuffles_dropped(spark):
        _shared_tables(made, src, categories)
    _meta(made, built_at, sources)
    return made


def _rows_by_chain(tables: dict[str, DataFrame]) -> dict[tuple[str, str], int]:
    """Rows of each table and chain, all counted by one job."""
    if not tables:
        return {}
    named = reduce(DataFrame.unionByName, [t.select(F.lit(n).alias("name"), "chain_id") for n, t in tables.items()])
    return {(r["name"], r["chain_id"]): r["count"] for r in named.groupBy("name", "chain_id").count().collect()}


def _shared_tables(made: Run, src: Sources, categories: DataFrame) -> None:
    """Tables that no chain owns; they are as large as the product list. Those that need none of the others are built side by side."""
    spark = made.spark

    def put(name: str, df: DataFrame) -> DataFrame:
        order = LAYOUT.get(name, ([], []))[1]
        laid = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
        laid.write.mode("overwrite").parquet(made.path(name))
        return spark.read.schema(df.schema).parquet(made.path(name))

    products = put("products", catalog.mart_products(src.products, src.product_categories, src.decided_names))

    def searched() -> None:
        docs = put("search_docs", search.index_docs(products))
        put("postings", search.postings(docs))
        put("fts_filler", search.filler_words(docs))

    steps = [
        searched,
        lambda: put("chains", prices.drop_priceless(src.chains, made.table("chain_prices"), ["chain_id"])),
        lambda: put("category_counts", catalog.category_counts(put("categories", categories), products)),
        lambda: put("deal_products", offers.best_deal_per_product(made.deals())),
        lambda: put("product_tokens", search.product_tokens(products)),
        lambda: put("deal_postings", search.postings(search.index_docs(products, made.deals().filter("discount_tenths > 0")))),
    ]
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        for done in [pool.submit(s) for s in steps]:
            done.result()


SHARED_TABLES = ("products", "chains", "categories", "category_counts", "deal_products", "product_tokens", "search_docs", "postings", "deal_postings", "fts_filler")


def _meta(made: Run, built_at: str, sources: tuple[str, ...]) -> None:
    """``key`` and ``value``: when, from what, how many rows a table has, and when each chain was built."""
    totals: dict[str, int] = dict.fromkeys(CHAIN_TABLES, 0)
    for p in made.parts():
        totals[p["table"]] += p["rows"]
    shared = reduce(DataFrame.unionByName, [made.table(n).select(F.lit(n).alias("name")) for n in SHARED_TABLES])
    totals.update({n: 0 for n in SHARED_TABLES} | {r["name"]: r["count"] for r in shared.groupBy("name").count().collect()})
    as_of = {c: r["built_at"] for c, r in sorted(made.chains().items())}
    rows = [("built_at", built_at), ("sources", json.dumps(sorted(sources))), ("counts", json.dumps(totals, sort_keys=True)),
            ("chain_as_of", json.dumps(as_of, ensure_ascii=False))]
    made.spark.createDataFrame(rows, "key string, value string").coalesce(1).write.mode("overwrite").parquet(made.path("meta"))
