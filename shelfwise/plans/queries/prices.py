"""Prices: observations, baselines, exceptions and effective prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import prices
from shelfwise.operators.search import product_tokens
from shelfwise.operators.spread import lookup_join
from shelfwise.plans.bridge import ORDER, Bridge
from shelfwise.plans.registry import query

CITY, WORD, BARCODE_PART = "NATION_3", "red", 7


@query("latest_observation", "SELECT * FROM latest", ("latest",))
def latest_observation(b: Bridge):
    return b.latest()


@query("price_support", "SELECT * FROM support", ("support",))
def price_support(b: Bridge):
    return prices.price_support(b.latest())


@query("modal_baseline", "SELECT * FROM base", ("base",))
def modal_baseline(b: Bridge):
    return b.baselines()


@query("price_exceptions", "SELECT * FROM exc", ("exc",))
def price_exceptions(b: Bridge):
    return b.prices()[2]


@query("priced_items_per_store", """
    SELECT s.chain_id, s.store_id, count(l.barcode) AS priced_items FROM stores s
    LEFT JOIN latest l ON s.chain_id = l.chain_id AND s.store_id = l.store_id GROUP BY ALL""", ("stores", "latest"))
def priced_items_per_store(b: Bridge):
    return prices.priced_items(b.latest(), b.stores()).select("chain_id", "store_id", "priced_items")


@query("effective_store_price", "SELECT chain_id, store_id, city, barcode, agorot FROM effective", ("effective",))
def effective_store_price(b: Bridge):
    _, base, exc = b.prices()
    return prices.effective_prices(b.stores(), base, exc).select("chain_id", "store_id", "city", "barcode", "agorot")


@query("observed_store_price", """
    SELECT l.* FROM latest l JOIN stores s ON l.chain_id = s.chain_id AND l.store_id = s.store_id""", ("latest", "stores"))
def observed_store_price(b: Bridge):
    return prices.observed_prices(b.latest(), b.stores())


@query("cheapest_by_barcode", """
    SELECT barcode, min(agorot) AS cheapest_agorot, count(DISTINCT chain_id) AS chains FROM effective GROUP BY barcode""",
       ("effective",))
def cheapest_by_barcode(b: Bridge):
    _, base, exc = b.prices()
    return prices.cheapest_by_barcode(b.stores(), base, exc)


@query("cheapest_word_in_city", f"""
    SELECT p.name, lower(e.chain_id) AS chain, e.store_name, e.store_id, e.barcode, e.agorot
    FROM effective e JOIN products p ON e.barcode = p.barcode
    WHERE e.city = '{CITY}' AND list_contains(string_split(p.name, ' '), '{WORD}')
    ORDER BY e.agorot, e.barcode, chain, e.store_id LIMIT 50""", ("effective", "products"))
def cheapest_word_in_city(b: Bridge):
    _, base, exc = b.prices()
    return prices.cheapest_in_city(
        WORD, CITY, b.products(), product_tokens(b.products()), b.chains(), b.stores(), base, exc)


@query("barcode_across_chains", f"""
    SELECT lower(chain_id) AS chain, agorot, store_count FROM base
    WHERE barcode = '729' || reverse(lpad('{BARCODE_PART}', 9, '0'))""", ("base",))
def barcode_across_chains(b: Bridge):
    code = "729" + str(BARCODE_PART).zfill(9)[::-1]
    return prices.barcode_across_chains(code, b.baselines(), b.chains())


@query("price_gap_to_cheapest", """
    SELECT barcode, chain_id, agorot, agorot - min(agorot) OVER (PARTITION BY barcode) AS gap_agorot FROM base""", ("base",))
def price_gap_to_cheapest(b: Bridge):
    return prices.price_gaps(b.baselines())


@query("price_tiers", """
    SELECT chain_id, barcode, agorot, count(*) AS branches, 0::BIGINT AS is_baseline FROM exc GROUP BY ALL
    UNION ALL SELECT chain_id, barcode, agorot, store_count, 1 FROM base""", ("exc", "base"))
def price_tiers(b: Bridge):
    _, base, exc = b.prices()
    return prices.price_tiers(base, exc)


@query("price_tier_stores", "SELECT chain_id, barcode, agorot, store_id FROM exc", ("exc",))
def price_tier_stores(b: Bridge):
    return prices.tier_stores(b.prices()[2])


@query("priceless_chain_removal", """
    WITH s AS (SELECT n_name AS chain_id, s_suppkey, s_nationkey FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT chain_id, CAST(s_suppkey AS VARCHAR) AS store_id FROM s WHERE chain_id IN (
        SELECT s.chain_id FROM lineitem JOIN s ON l_suppkey = s_suppkey WHERE s_nationkey % 3 <> 0)""")
def priceless_chain_removal(b: Bridge):
    """Nations as chains; every third one publishes stores but no prices."""
    shops = b.suppliers().select(F.col("city").alias("chain_id"), "store_id", "s_suppkey", "s_nationkey")
    sold = b.table("lineitem").select(F.col("l_suppkey").alias("s_suppkey"), "l_orderkey")
    priced = lookup_join(sold, shops.select("s_suppkey", "s_nationkey", "chain_id"), ["s_suppkey"], ["l_orderkey"], "inner").filter("s_nationkey % 3 <> 0")
    return prices.drop_priceless(shops.drop("s_suppkey", "s_nationkey"), priced, ["store_id"])


@query("sub_brand_split", """
    SELECT CASE WHEN s_nationkey % 2 = 0 THEN chain_id || '-' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0')
                ELSE chain_id END AS chain_id, count(*) AS rows, sum(agorot)::BIGINT AS total
    FROM obs JOIN (SELECT store_id AS sid, s_nationkey FROM stores) ON store_id = sid GROUP BY 1""", ("obs",))
def sub_brand_split(b: Bridge):
    nation = b.table("nation").join(b.table("region"), F.expr("n_regionkey = r_regionkey"))
    brands = nation.filter("n_nationkey % 2 = 0").select(
        F.col("r_name").alias("chain_id"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("sub"),
        F.col("n_name").alias("brand_name"))
    subs = b.suppliers().select("store_id", F.col("s_nationkey").cast("string").alias("subchain_id"))
    rows = b.observations().select("chain_id", "store_id", "barcode", "agorot")
    rows = lookup_join(rows, subs, ["store_id"], ["barcode"], "inner")
    return prices.split_chains(rows, brands).groupBy("chain_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("agorot").alias("total"))


@query("chain_alias_baseline", """
    , fixed AS (SELECT CASE chain_id WHEN 'AFRICA' THEN 'ASIA' ELSE chain_id END AS chain_id, barcode, agorot FROM latest),
    c AS (SELECT chain_id, barcode, agorot, count(*) AS store_count FROM fixed GROUP BY ALL)
    SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY chain_id, barcode ORDER BY store_count DESC, agorot) = 1""",
       ("latest",))
def chain_alias_baseline(b: Bridge):
    region = b.table("region")
    right = region.filter("r_regionkey = 2").select(F.col("r_name").alias("right_id"))
    aliases = region.filter("r_regionkey = 0").select(F.col("r_name").alias("wrong_id")).withColumn(
        "right_id", right.scalar())
    return prices.baselines(prices.correct_chain_ids(b.latest(), aliases, ["barcode"]))


@query("aliased_dimension_rows", "SELECT chain_id, store_id FROM stores WHERE chain_id <> 'AFRICA'", ("stores",))
def aliased_dimension_rows(b: Bridge):
    aliases = b.table("region").filter("r_regionkey = 0").select(F.col("r_name").alias("wrong_id"))
    return prices.drop_aliased(b.stores().select("chain_id", "store_id"), aliases)


@query("city_names", """
    SELECT store_id, CASE s_suppkey % 4 WHEN 0 THEN n_name WHEN 1 THEN n_name ELSE NULL END AS city_name
    FROM stores JOIN nation ON s_nationkey = n_nationkey""", ("stores",))
def city_names(b: Bridge):
    key = F.col("s_suppkey") % 4
    raw = (F.when(key == 0, F.concat(F.lit("00"), F.col("s_nationkey").cast("string")))
           .when(key == 1, F.concat(F.lit("  "), "city", F.lit(" "))).when(key == 2, "Unknown").otherwise("0"))
    codes = b.table("nation").select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("city_name"))
    shops = b.suppliers().select("store_id", raw.alias("city"), "s_nationkey", "s_suppkey")
    # Code 0 is a placeholder, never a place, so nation 0 keeps its name here.
    shops = shops.withColumn("city", F.when((key == 0) & (F.col("s_nationkey") == 0), "NATION_0").otherwise(F.col("city")))
    return prices.resolve_cities(shops, codes).select("store_id", "city_name")


@query("chain_display_names", """
    SELECT n_name AS chain_id, CASE WHEN n_nationkey % 4 = 0 THEN 'brand ' || n_name WHEN n_nationkey % 4 = 1 THEN 'file ' || n_name
        WHEN n_nationkey % 4 = 2 THEN 'shown ' || n_name ELSE r_name END AS name
    FROM nation JOIN region ON n_regionkey = r_regionkey""")
def chain_display_names(b: Bridge):
    n = b.table("nation").join(b.table("region"), F.expr("n_regionkey = r_regionkey"))
    labelled = lambda word: F.concat_ws(" ", F.lit(word), "n_name")
    key = F.col("n_nationkey") % 4
    chains = n.select(F.col("n_name").alias("chain_id"), F.when(key < 2, labelled("file")).otherwise("").alias("file_name"),
                      F.col("r_name").alias("source"))
    brands = n.filter(key == 0).select(F.col("n_name").alias("chain_id"), labelled("brand").alias("brand_name"))
    display = n.filter(key < 3).select(F.col("n_name").alias("chain_id"), labelled("shown").alias("display_name"))
    return prices.chain_names(chains, brands, display)


@query("raw_price_rows", """
    SELECT '7290' || lpad(CAST(l_suppkey % 10 AS VARCHAR), 9, '0') AS chain_id, CAST(l_suppkey AS VARCHAR) AS store_id,
           count(*) AS rows, sum(1000 * 100 + 100 * l_partkey + 50)::BIGINT AS total,
           sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::BIGINT AS weighed
    FROM lineitem WHERE l_linenumber NOT IN (1, 2) AND length(CAST(l_orderkey AS VARCHAR)) >= 4 GROUP BY 1, 2""")
def raw_price_rows(b: Bridge):
    """Text rows: prices like ``1,234.50``, some not numbers, some codes short."""
    key = F.col("l_linenumber")
    text = F.concat(F.expr("format_number(l_partkey + 1000, 0)"), F.lit(".50"))
    raw = b.table("lineitem").select(
        F.concat(F.lit("7290"), F.lpad((F.col("l_suppkey") % 10).cast("string"), 9, "0")).alias("chainid"),
        F.concat(F.lit("00"), F.col("l_suppkey").cast("string")).alias("storeid"),
        F.concat(F.lit("x-72"), F.col("l_orderkey").cast("string")).alias("item_code"), F.lit("").alias("itemcode"),
        F.when(key == 1, "free").when(key == 2, "0").otherwise(text).alias("itemprice"),
        F.when(F.col("l_returnflag") == "R", "1").otherwise("0").alias("bisweighted"))
    return prices.price_rows(raw).groupBy("chain_id", "store_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("agorot").alias("total"), F.sum("is_weighted").alias("weighed"))


@query("raw_store_rows", """
    SELECT CAST(n_nationkey + 100 AS VARCHAR) AS chain_id, CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 9 <> 0""")
def raw_store_rows(b: Bridge):
    s = b.suppliers()
    raw = s.select(
        F.concat(F.lit("c"), (F.col("s_nationkey") + 100).cast("string")).alias("ChainID"),
        F.when(F.col("s_suppkey") % 9 != 0, F.concat(F.lit("0"), "store_id")).otherwise("").alias("StoreID"),
        F.col("store_name").alias("StoreName"))
    return prices.store_rows(raw).select("chain_id", "store_id", "store_name")


@query("last_product_row", """
    SELECT barcode, CASE WHEN l_linenumber % 2 = 0 THEN 'alt ' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS name
    FROM obs WHERE l_linenumber % 3 <> 0
    QUALIFY row_number() OVER (PARTITION BY barcode ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, agorot DESC) = 1""",
       ("obs",))
def last_product_row(b: Bridge):
    key = F.col("l_linenumber")
    rows = b.observations()
    name = F.when(key % 3 == 0, "").otherwise(
        F.concat(F.when(key % 2 == 0, "alt ").otherwise(""), F.col("l_orderkey").cast("string")))
    blank = F.lit(None).cast("string")
    rows = rows.withColumns({"name": name, "manufacturer": blank, "unit_qty": blank, "quantity": blank,
                             "unit_of_measure": blank, "is_weighted": F.lit(0)})
    return prices.product_rows(rows, ORDER).select("barcode", "name")


@query("shelf_price_of_offer", """
    SELECT r.chain_id, r.store_id, r.barcode, r.promo_id, coalesce(e.agorot, b.agorot) AS shelf
    FROM offer_rows r LEFT JOIN exc e USING (chain_id, store_id, barcode)
    LEFT JOIN base b ON r.chain_id = b.chain_id AND r.barcode = b.barcode WHERE r.agorot IS NULL""",
       ("offer_rows", "exc", "base"))
def shelf_price_of_offer(b: Bridge):
    _, base, exc = b.prices()
    staged = b.offer_rows().filter("unpriced_qty > 0")
    return prices.shelf_prices(staged, base, exc).select("chain_id", "store_id", "barcode", "promo_id", "shelf")


@query("located_stores", """
    SELECT s.chain_id, s.store_id, 'u' || s.store_id AS branch_uid, CASE WHEN s_suppkey % 3 = 0 THEN lat END AS lat
    FROM stores s""", ("stores",))
def located_stores(b: Bridge):
    s = b.suppliers()
    uid = F.concat(F.lit("u"), "store_id")
    ids = s.select("chain_id", "store_id", uid.alias("branch_uid"))
    spots = s.filter("s_suppkey % 3 = 0").select(uid.alias("branch_uid"), "lat", "lon", "precision")
    shops = b.stores().select("chain_id", "store_id")
    return prices.locate_stores(shops, ids, spots).select("chain_id", "store_id", "branch_uid", "lat")
