"""The mart, built a second time from changed files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from shelfwise.plans import incremental
from shelfwise.plans.bridge import ORDER, TODAY, Bridge
from shelfwise.plans.mart import Sources
from shelfwise.plans.queries.offers import KEY, RESOLVED
from shelfwise.plans.registry import query
from shelfwise.session import shared_dir

CHANGED, GONE = "AFRICA", "EUROPE"


def _sources(b: Bridge, prices: DataFrame, offers: DataFrame) -> Sources:
    return Sources(
        prices=prices, stores=b.stores(), offers=offers, chains=b.chains(), products=b.products(), product_categories=b.product_categories(),
        decided_names=b.products().filter("false").select("barcode", "name"), chain_products=b.chain_products(), order=ORDER, today=TODAY)


def _files(prices: DataFrame) -> DataFrame:
    """The lines of a store and month as one file."""
    month = F.date_format("l_shipdate", "yyyyMM")
    return prices.groupBy("chain_id", F.col("store_id").alias("folder"), month.alias("path")).agg(
        F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("barcode", *ORDER).cast("decimal(38,0)")).alias("modified"))


def _runs(b: Bridge) -> tuple[incremental.Run, incremental.Run]:
    """First without every seventh line of one chain, then with them but without another chain."""
    root = f"{shared_dir(b.spark)}/mart-{uuid.uuid4().hex}"
    prices = b.observations("l_shipdate")
    early = (F.col("chain_id") != CHANGED) | (F.col("l_orderkey") % 7 != 0)
    early_offers = (F.col("chain_id") != CHANGED) | (F.col("promo_id").cast("bigint") % 7 != 0)
    first = incremental.build(
        b.spark, root, "1", _sources(b, prices.filter(early), b.offer_rows().filter(early_offers)), _files(prices.filter(early)), b.categories(), "1998-05-31")
    stays = F.col("chain_id") != GONE
    second = incremental.build(
        b.spark, root, "2", _sources(b, prices.filter(stays), b.offer_rows().filter(stays)), _files(prices.filter(stays)), b.categories(), TODAY,
        previous="1", sources=("lineitem",))
    return first, second


@query("mart_rebuilt_for_changed_chains", RESOLVED + f"""
    , p AS (SELECT chain_id, count(*) AS prices, sum(agorot) AS agorot FROM base GROUP BY chain_id),
    e AS (SELECT chain_id, count(*) AS exceptions FROM exc GROUP BY chain_id),
    o AS (SELECT chain_id, count(*) AS offers FROM (
        SELECT {KEY}, agorot FROM offers UNION SELECT {KEY}, agorot FROM shelf_offers) GROUP BY chain_id),
    s AS (SELECT chain_id, count(*) AS stores FROM stores GROUP BY chain_id)
    SELECT chain_id, prices, agorot::BIGINT AS agorot, coalesce(exceptions, 0) AS exceptions, offers, stores, (chain_id = '{CHANGED}')::BIGINT AS rebuilt,
           CASE WHEN chain_id = '{CHANGED}' THEN '{TODAY}' ELSE '1998-05-31' END AS as_of
    FROM p LEFT JOIN e USING (chain_id) JOIN o USING (chain_id) JOIN s USING (chain_id) WHERE chain_id <> '{GONE}'""",
       ("base", "exc", "stores", "offer_rows", "offers"))
def mart_rebuilt_for_changed_chains(b: Bridge):
    _, second = _runs(b)
    per = lambda name, **aggs: second.table(name).groupBy("chain_id").agg(*[a.alias(n) for n, a in aggs.items()])
    one = F.count(F.lit(1))
    built = b.spark.createDataFrame([(c, int(r["run"] == "2"), r["built_at"]) for c, r in second.chains().items()], "chain_id string, rebuilt int, as_of string")
    return per("chain_prices", prices=one, agorot=F.sum("agorot")).join(per("price_exceptions", exceptions=one), "chain_id", "left").join(
        per("promo_offers", offers=one), "chain_id").join(per("stores", stores=one), "chain_id").join(built, "chain_id").select(
        "chain_id", "prices", "agorot", F.coalesce("exceptions", F.lit(0)).cast("bigint").alias("exceptions"), "offers", "stores", "rebuilt", "as_of")
