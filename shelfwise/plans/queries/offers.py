"""Offers: merging, pruning, deals, listings and branch lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions import money
from shelfwise.operators import offers, quality
from shelfwise.operators.spread import lookup_join
from shelfwise.plans.bridge import TODAY, Bridge
from shelfwise.plans.registry import query

TERMS = "chain_id, barcode, club::BIGINT AS club, coupon::BIGINT AS coupon, qty_milli::BIGINT AS qty_milli"
READ = f"{TERMS}, unit_agorot"
KEY = "chain_id, barcode, club, coupon, qty_milli"
CHAIN, BRANCH = "ASIA", "9"
RESOLVED = """
    , resolved AS (SELECT r.chain_id, r.barcode, r.club, r.coupon, r.qty_milli, r.store_id, r.promo_id, r.description,
          r.starts, r.ends, 100 + coalesce(e.agorot, b.agorot) AS agorot
        FROM offer_rows r LEFT JOIN exc e USING (chain_id, store_id, barcode)
        LEFT JOIN base b ON r.chain_id = b.chain_id AND r.barcode = b.barcode
        WHERE r.agorot IS NULL AND coalesce(e.agorot, b.agorot) IS NOT NULL),
    shelf_offers AS (SELECT chain_id, barcode, club, coupon, qty_milli, agorot, (agorot * 2000 + qty_milli) // (2 * qty_milli)
        AS unit_agorot, min(promo_id) AS promo_id, min(description) AS description, min(starts) AS starts, max(ends) AS ends
        FROM resolved GROUP BY chain_id, barcode, club, coupon, qty_milli, agorot)"""
BUILT = "CAST(starts AS VARCHAR) AS starts, CAST(ends AS VARCHAR) AS ends, agorot, unit_agorot, promo_id, description"


def _resolved(b: Bridge):
    """Offers at their shelf price, stored, as are the exceptions: so the shuffles of each step are gone before the next."""
    _, base, exc = b.prices()
    _, staged = offers.split_priced(b.offer_rows())
    return b.once("resolved", lambda: offers.resolve_shelf_offers(staged, base, b.once("exc", lambda: exc)))


@query("offer_merge_on_terms", f"SELECT {TERMS}, {BUILT} FROM offers", ("offers",))
def offer_merge_on_terms(b: Bridge):
    return b.offer_tables()[0]


@query("offer_branch_links", f"SELECT {TERMS}, agorot, store_id FROM links", ("links",))
def offer_branch_links(b: Bridge):
    return b.offer_tables()[1]


@query("staged_and_priced_rows", """
    SELECT CASE WHEN agorot IS NULL THEN 'staged' ELSE 'priced' END AS kind, count(*) AS rows FROM offer_rows GROUP BY 1""",
       ("offer_rows",))
def staged_and_priced_rows(b: Bridge):
    priced, staged = offers.split_priced(b.offer_rows())
    return quality.table_counts({"priced": priced, "staged": staged}).withColumnRenamed("table_name", "kind")


@query("shelf_priced_offers", RESOLVED + f"SELECT {TERMS}, {BUILT} FROM shelf_offers", ("offer_rows", "exc", "base"))
def shelf_priced_offers(b: Bridge):
    return offers.group_resolved(_resolved(b))


@query("offers_with_shelf_priced", RESOLVED + f"""
    SELECT {TERMS}, {BUILT} FROM offers UNION ALL SELECT {TERMS}, {BUILT} FROM shelf_offers s
    WHERE NOT EXISTS (SELECT 1 FROM offers o WHERE o.chain_id = s.chain_id AND o.barcode = s.barcode AND o.club = s.club
        AND o.coupon = s.coupon AND o.qty_milli = s.qty_milli AND o.agorot = s.agorot)""",
       ("offer_rows", "exc", "base", "offers"))
def offers_with_shelf_priced(b: Bridge):
    return offers.add_new_offers(b.offer_tables()[0], _resolved(b))


@query("relinked_branches", RESOLVED + f"""
    SELECT DISTINCT {TERMS}, agorot, store_id FROM (
        SELECT {KEY}, agorot, store_id FROM links UNION ALL SELECT {KEY}, agorot, store_id FROM resolved)""",
       ("offer_rows", "exc", "base", "links"))
def relinked_branches(b: Bridge):
    return offers.relink(b.offer_tables()[1], _resolved(b))


@query("offer_brand_attribution", """
    SELECT CASE WHEN s_nationkey % 2 = 0 THEN chain_id || '-' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0')
                ELSE chain_id END AS chain_id, count(*) AS rows
    FROM offer_rows JOIN (SELECT store_id, s_nationkey FROM stores) USING (store_id) GROUP BY 1""", ("offer_rows", "stores"))
def offer_brand_attribution(b: Bridge):
    sub = F.lpad(F.col("s_nationkey").cast("string"), 3, "0")
    split = F.when(F.col("s_nationkey") % 2 == 0, F.concat_ws("-", "chain_id", sub)).otherwise(F.col("chain_id"))
    shops = b.suppliers().withColumn("chain_id", split).select("chain_id", "store_id")
    return offers.attribute_brands(b.offer_rows(), shops).groupBy("chain_id").agg(F.count(F.lit(1)).alias("rows"))


@query("offer_compression", """
    SELECT count(*) AS published_rows, count(DISTINCT (chain_id, barcode, club, coupon, qty_milli, agorot)) AS distinct_offers,
           count(DISTINCT (chain_id, promo_id)) AS promo_ids FROM offer_rows WHERE agorot IS NOT NULL""", ("offer_rows",))
def offer_compression(b: Bridge):
    return offers.compression(offers.split_priced(b.offer_rows())[0])


@query("live_offer_merge", f"""
    SELECT {READ}, agorot, description, CAST(starts AS VARCHAR) AS starts, CAST(ends AS VARCHAR) AS ends FROM merged""",
       ("merged",))
def live_offer_merge(b: Bridge):
    return b.read_tables()[0]


@query("branches_on_any_offer", "SELECT * FROM everywhere", ("everywhere",))
def branches_on_any_offer(b: Bridge):
    return b.read_tables()[2]


@query("domination_prune", f"SELECT {READ}, agorot FROM kept", ("kept",))
def domination_prune(b: Bridge):
    return b.kept()[0].select(*offers.READ_TERMS, "agorot")


DEAL = """chain_id, barcode, club::BIGINT AS club, coupon::BIGINT AS coupon, qty_milli::BIGINT AS qty_milli, unit_agorot,
    agorot, deal_id, base_agorot, coalesce(category_id, -1)::BIGINT AS category_id, name, discount_tenths"""
def deal_columns() -> list:
    return [*offers.READ_TERMS, "agorot", "deal_id", "base_agorot",
            F.coalesce("category_id", F.lit(-1)).alias("category_id"), "name", "discount_tenths"]


@query("deals", f"SELECT {DEAL} FROM deals", ("deals",))
def deals(b: Bridge):
    return b.deals()[0].select(*deal_columns())


@query("best_deal_per_product", f"SELECT {DEAL}, chains_on_deal FROM best_deals", ("best_deals",))
def best_deal_per_product(b: Bridge):
    return offers.best_deal_per_product(b.deals()[0]).select(*deal_columns(), "chains_on_deal")


@query("deals_first_page", f"""
    SELECT {DEAL}, chains_on_deal FROM best_deals ORDER BY discount_tenths DESC, deal_id LIMIT 25""", ("best_deals",))
def deals_first_page(b: Bridge):
    best = offers.best_deal_per_product(b.deals()[0])
    return offers.list_deals(best, limit=24).select(*deal_columns(), "chains_on_deal")


@query("deals_page_after_cursor", f"""
    SELECT {DEAL}, chains_on_deal FROM best_deals WHERE category_id = 107
      AND (discount_tenths < 60 OR (discount_tenths = 60 AND deal_id > 1000))
    ORDER BY discount_tenths DESC, deal_id LIMIT 25""", ("best_deals",))
def deals_page_after_cursor(b: Bridge):
    best = offers.best_deal_per_product(b.deals()[0])
    page = offers.list_deals(best, 24, cursor=offers.encode_cursor(60, 1000), category_id=107)
    return page.select(*deal_columns(), "chains_on_deal")


@query("deals_of_chain", f"""
    , ranked AS (SELECT * FROM real_deals WHERE chain_id = '{CHAIN}'
        QUALIFY row_number() OVER (PARTITION BY barcode ORDER BY unit_agorot, deal_id) = 1),
    n AS (SELECT {KEY}, unit_agorot, count(*) AS branches_on_deal FROM klinks GROUP BY ALL)
    SELECT {DEAL}, branches_on_deal, (SELECT count(*) FROM (SELECT store_id FROM stores WHERE chain_id = '{CHAIN}' UNION SELECT store_id FROM links WHERE chain_id = '{CHAIN}')) AS branches_total
    FROM ranked JOIN n USING ({KEY}, unit_agorot)
    ORDER BY discount_tenths DESC, deal_id LIMIT 25""", ("real_deals", "klinks", "stores", "links"))
def deals_of_chain(b: Bridge):
    table, links, _ = b.deals()
    page = offers.list_chain_deals(table, offers.deal_branches(table, links), CHAIN, bits=offers.store_bits(b.stores(), b.stored_links()))
    return page.select(*deal_columns(), "branches_on_deal", "branches_total")


@query("deals_of_branch", f"""
    , here AS (SELECT d.* FROM real_deals d JOIN klinks k USING ({KEY}, unit_agorot)
        WHERE d.chain_id = '{CHAIN}' AND k.store_id = '{BRANCH}')
    SELECT {DEAL} FROM (SELECT * FROM here QUALIFY row_number() OVER (PARTITION BY barcode ORDER BY unit_agorot, deal_id) = 1)
    ORDER BY discount_tenths DESC, deal_id LIMIT 25""", ("real_deals", "klinks"))
def deals_of_branch(b: Bridge):
    table, links, _ = b.deals()
    page = offers.list_chain_deals(table, offers.deal_branches(table, links), CHAIN, store_id=BRANCH)
    return page.select(*deal_columns())


@query("best_deal_per_chain_product", f"""
    SELECT {DEAL} FROM real_deals QUALIFY row_number() OVER (PARTITION BY chain_id, barcode ORDER BY unit_agorot, deal_id) = 1""",
       ("real_deals",))
def best_deal_per_chain_product(b: Bridge):
    return offers.chain_deals_every_chain(b.deals()[0]).select(*deal_columns())


@query("best_deal_per_branch_product", f"""
    SELECT chain_id, barcode, store_id, deal_id, unit_agorot, discount_tenths
    FROM real_deals JOIN klinks USING ({KEY}, unit_agorot)
    QUALIFY row_number() OVER (PARTITION BY chain_id, barcode, store_id ORDER BY unit_agorot, deal_id) = 1""",
       ("real_deals", "klinks"))
def best_deal_per_branch_product(b: Bridge):
    table, links, _ = b.deals()
    return offers.branch_deals_every_branch(table, offers.deal_branches(table, links))


@query("live_promotions_of_chain", f"""
    SELECT description, name, barcode, agorot, qty_milli::BIGINT AS qty_milli FROM offers JOIN products USING (barcode)
    WHERE chain_id = '{CHAIN}' AND ends >= DATE '{TODAY}'""", ("offers", "products"))
def live_promotions_of_chain(b: Bridge):
    return offers.live_promotions(CHAIN, TODAY, b.offer_tables()[0], b.products())


MODES = f"""
    , reach AS (SELECT chain_id, count(*) AS n FROM everywhere GROUP BY chain_id),
    runs AS (SELECT {KEY}, unit_agorot, count(*) AS runs_at FROM klinks GROUP BY ALL),
    modes AS (SELECT r.*, n - runs_at AS missing_at, CASE WHEN n = runs_at THEN 'all' WHEN n - runs_at < runs_at THEN 'except'
        ELSE 'only' END AS mode FROM runs r JOIN reach USING (chain_id)),
    listing AS (SELECT {KEY}, unit_agorot, mode, store_id FROM modes JOIN klinks USING ({KEY}, unit_agorot) WHERE mode = 'only'
        UNION ALL SELECT {KEY}, unit_agorot, mode, e.store_id FROM modes JOIN everywhere e USING (chain_id)
        WHERE mode = 'except' AND NOT EXISTS (SELECT 1 FROM klinks k WHERE k.chain_id = modes.chain_id
            AND k.barcode = modes.barcode AND k.club = modes.club AND k.coupon = modes.coupon
            AND k.qty_milli = modes.qty_milli AND k.unit_agorot = modes.unit_agorot AND k.store_id = e.store_id))"""


def _coarse(b: Bridge):
    """Read tables with nations as chains' branches: few branches, many shared."""
    kept, links, everywhere = b.kept()
    city = b.suppliers().select("store_id", "city")
    by_city = lambda df: lookup_join(df, city, ["store_id"], ["chain_id"], "inner").drop("store_id").withColumnRenamed(
        "city", "store_id").distinct()
    return kept, b.once("coarse_links", lambda: by_city(links)), b.once("coarse_everywhere", lambda: by_city(everywhere))


def _modes(b: Bridge, links: DataFrame, everywhere: DataFrame) -> DataFrame:
    return b.once("modes", lambda: offers.branch_modes(links, everywhere))


COARSE = MODES.replace("FROM klinks", "FROM cl").replace("JOIN klinks", "JOIN cl").replace("FROM everywhere", "FROM ce").replace(
    "JOIN everywhere e", "JOIN ce e").replace(", reach AS", f"""
    , city AS (SELECT store_id AS sid, city FROM stores),
    cl AS (SELECT DISTINCT {KEY}, unit_agorot, city AS store_id FROM klinks JOIN city ON sid = store_id),
    ce AS (SELECT DISTINCT chain_id, city AS store_id FROM everywhere JOIN city ON sid = store_id),
    reach AS""", 1)


@query("branch_list_modes", COARSE + f"SELECT {READ}, runs_at, missing_at, mode FROM modes", ("klinks", "everywhere", "stores"))
def branch_list_modes(b: Bridge):
    _, links, everywhere = _coarse(b)
    return offers.branch_modes(links, everywhere)


@query("branch_lists", COARSE + f"SELECT {READ}, mode, store_id FROM listing", ("klinks", "everywhere", "stores"))
def branch_lists(b: Bridge):
    _, links, everywhere = _coarse(b)
    return offers.branch_listing(links, everywhere, _modes(b, links, everywhere))


@query("promotion_documents", COARSE + f"""
    , lists AS (SELECT {KEY}, unit_agorot, string_agg(store_id, ',' ORDER BY store_id) AS stores FROM listing GROUP BY ALL)
    SELECT chain_id, barcode, unit_agorot, qty_milli::BIGINT AS qty_milli,
           coalesce(description, '') AS d, CAST(ends AS VARCHAR) AS e, club::BIGINT AS c,
           coupon::BIGINT AS k, CASE WHEN starts > DATE '{TODAY}' THEN CAST(starts AS VARCHAR) END AS b,
           CASE WHEN mode = 'only' THEN stores END AS s, CASE WHEN mode = 'except' THEN stores END AS x
    FROM kept JOIN modes USING ({KEY}, unit_agorot) LEFT JOIN lists USING ({KEY}, unit_agorot)""",
       ("kept", "klinks", "everywhere", "stores"))
def promotion_documents(b: Bridge):
    kept, links, everywhere = _coarse(b)
    modes = _modes(b, links, everywhere)
    rows = offers.promotion_entries(kept, modes, offers.branch_listing(links, everywhere, modes), TODAY)
    o = F.col("offer")
    return rows.select("chain_id", "barcode", "unit_agorot", "min_qty", o["d"].alias("d"), o["e"].alias("e"),
                       F.coalesce(o["c"], F.lit(0)).alias("c"), F.coalesce(o["k"], F.lit(0)).alias("k"), o["b"].alias("b"),
                       F.array_join(o["s"], ",").alias("s"), F.array_join(o["x"], ",").alias("x"))


@query("offer_runs_at_branch", COARSE + f"""
    SELECT {KEY.replace('club', 'club::BIGINT AS club').replace('coupon', 'coupon::BIGINT AS coupon').replace('qty_milli', 'qty_milli::BIGINT AS qty_milli')},
           unit_agorot FROM cl WHERE store_id = 'NATION_7'""", ("klinks", "everywhere", "stores"))
def offer_runs_at_branch(b: Bridge):
    kept, links, everywhere = _coarse(b)
    modes = _modes(b, links, everywhere)
    rows = offers.promotion_entries(kept, modes, offers.branch_listing(links, everywhere, modes), TODAY)
    chain = everywhere.filter("store_id = 'NATION_7'").select("chain_id")
    here = rows.join(chain, "chain_id", "left_semi")
    runs = offers.runs_at(F.lit("NATION_7"), F.col("offer.s"), F.col("offer.x"))
    return here.filter(runs).select(*offers.READ_TERMS)


@query("store_bits", """
    SELECT chain_id, store_id, row_number() OVER (PARTITION BY chain_id ORDER BY store_id) - 1 AS bit FROM (
        SELECT chain_id, store_id FROM stores UNION SELECT chain_id, store_id FROM links)""", ("stores", "links"))
def store_bits(b: Bridge):
    return offers.store_bits(b.stores(), b.offer_tables()[1])


@query("branches_without_bit", """
    SELECT DISTINCT chain_id, store_id FROM links WHERE (chain_id, store_id) IN (SELECT (chain_id, store_id) FROM (
        SELECT chain_id, store_id, row_number() OVER (PARTITION BY chain_id ORDER BY store_id) - 1 AS bit FROM (
            SELECT chain_id, store_id FROM stores UNION SELECT chain_id, store_id FROM links)) WHERE bit % 3 = 1)""", ("links", "stores"))
def branches_without_bit(b: Bridge):
    """A numbering that lost every third branch of a chain."""
    links = b.offer_tables()[1]
    return offers.branches_without_bit(links, offers.store_bits(b.stores(), links).filter("bit % 3 <> 1"))


@query("deal_bitmap_sizes", f"""
    SELECT deal_id, count(*) AS branches FROM deals JOIN klinks USING ({KEY}, unit_agorot) GROUP BY deal_id""", ("deals", "klinks"))
def deal_bitmap_sizes(b: Bridge):
    table, links, _ = b.deals()
    bits = offers.store_bits(b.stores(), b.stored_links())
    maps = offers.branch_bitmaps(offers.deal_branches(table, links), bits)
    return maps.groupBy("deal_id").agg(F.sum(F.bitmap_count("bitmap")).alias("branches"))


@query("offer_key_hash", """
    SELECT sha1(chain_id || '|' || barcode || '|' || club || '|' || coupon || '|' || qty_milli // 1000 || '.'
                || lpad(CAST(qty_milli % 1000 AS VARCHAR), 3, '0') || '|' || agorot) AS offer_key, unit_agorot FROM offers""",
       ("offers",))
def offer_key_hash(b: Bridge):
    rows = b.offer_tables()[0]
    key = money.offer_key(*[F.col(c) for c in offers.BUILD_TERMS])
    return rows.select(key.alias("offer_key"), "unit_agorot")


@query("stranded_offers", f"""
    SELECT {TERMS}, agorot FROM offers o WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.chain_id = o.chain_id
      AND l.barcode = o.barcode AND l.club = o.club AND l.coupon = o.coupon AND l.qty_milli = o.qty_milli
      AND l.agorot = o.agorot AND CAST(l.store_id AS INT) % 2 = 0)""", ("offers", "links"))
def stranded_offers(b: Bridge):
    rows, links = b.offer_tables()
    some = links.filter("cast(store_id as int) % 2 = 0")
    return quality.stranded_offers(rows, some, offers.BUILD_TERMS).select(*offers.BUILD_TERMS)


@query("inconsistent_unit_prices", f"""
    SELECT {TERMS}, agorot FROM offers WHERE abs(agorot * 1000 - (unit_agorot + club * 2) * qty_milli) > qty_milli""", ("offers",))
def inconsistent_unit_prices(b: Bridge):
    rows = b.offer_tables()[0].withColumn("unit_agorot", F.col("unit_agorot") + F.col("club") * 2)
    return quality.inconsistent_units(rows).select(*offers.BUILD_TERMS)
