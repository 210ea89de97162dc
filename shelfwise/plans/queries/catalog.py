"""Products: parts, names, categories, documents and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import text
from shelfwise.operators import catalog, categories, names, offers, produce, quality
from shelfwise.operators.prices import priced_items
from shelfwise.plans.bridge import TODAY, Bridge, ean
from shelfwise.plans.registry import query


# --- merging parts -----------------------------------------------------------


@query("union_of_drifting_parts", """
    SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price,
           CASE WHEN o_orderstatus = 'O' THEN 1::BIGINT ELSE 0::BIGINT END AS coupon FROM orders""")
def union_of_drifting_parts(b: Bridge):
    """One part per status; each knows only some of the columns."""
    o = b.table("orders")
    part = lambda s: o.filter(F.col("o_orderstatus") == s)
    rest = o.filter("o_orderstatus not in ('F', 'O')").select(F.col("o_orderkey").alias("id"))
    parts = [part("F").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price")),
             part("O").select(F.col("o_orderkey").alias("id"), F.lit(1).alias("coupon")), rest]
    return catalog.union_parts(parts, {"coupon": 0})


@query("upsert_replace", """
    SELECT o_custkey AS id, o_orderkey AS last_order, o_orderpriority AS priority FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def upsert_replace(b: Bridge):
    rows = b.table("orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("last_order"),
        F.col("o_orderpriority").alias("priority"), "o_orderdate", "o_orderkey")
    return catalog.replace_rows(rows, ["id"], ["o_orderdate", "o_orderkey"])


@query("insert_ignore", """
    SELECT c_custkey AS id, 'customer' AS origin FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT DISTINCT o_custkey, 'order' FROM orders WHERE o_custkey % 2 <> 0""")
def insert_ignore(b: Bridge):
    known = b.table("customer").filter("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("id"), F.lit("customer").alias("origin"))
    rows = b.table("orders").select(F.col("o_custkey").alias("id"), F.lit("order").alias("origin"))
    return catalog.ignore_rows(known, rows, ["id"])


def _parts(b: Bridge):
    """Two parts: even chains carry their own names, odd ones too."""
    base = b.baselines().select("chain_id", "barcode").withColumn(
        "part", F.when(F.length("chain_id") % 2 == 0, "even").otherwise("odd"))
    p = b.products()
    odd = p.withColumns({"part": F.lit("odd"), "is_weighted": F.lit(0),
                         "name": F.when(F.length("name") > 10, F.col("name")).otherwise("")})
    return p.withColumn("part", F.lit("even")).unionByName(odd), base


@query("weighed_chain_products", """
    SELECT chain_id, barcode, name FROM base JOIN products USING (barcode)
    WHERE length(chain_id) % 2 = 0 AND is_weighted = 1""", ("base", "products"))
def weighed_chain_products(b: Bridge):
    products, base = _parts(b)
    return catalog.weighed_products(products, base).select("chain_id", "barcode", "name")


@query("disagreeing_chain_products", """
    , claimed AS (SELECT chain_id, barcode, name, is_weighted FROM base JOIN products USING (barcode)
                  WHERE length(chain_id) % 2 = 0 AND is_weighted = 1),
    hot AS (SELECT DISTINCT barcode FROM claimed)
    SELECT chain_id, barcode, name, is_weighted::BIGINT AS is_weighted FROM claimed
    UNION ALL SELECT chain_id, barcode, name, 0::BIGINT FROM base JOIN products USING (barcode) JOIN hot USING (barcode)
    WHERE length(chain_id) % 2 = 1 AND length(name) > 10""", ("base", "products"))
def disagreeing_chain_products(b: Bridge):
    products, base = _parts(b)
    claimed = catalog.weighed_products(products, base)
    return catalog.claim_disagreements(claimed, products, base).select("chain_id", "barcode", "name", "is_weighted")


@query("decided_name_override", """
    SELECT barcode, CASE WHEN is_weighted = 1 THEN 'decided  ' || manufacturer ELSE name END AS name,
           CASE WHEN is_weighted = 1 THEN 'decided ' || manufacturer ELSE name END AS sort_key,
           coalesce(category_id, -1)::BIGINT AS category_id FROM products""", ("products",))
def decided_name_override(b: Bridge):
    p = b.products()
    decided = p.filter("is_weighted = 1").select("barcode", F.concat(F.lit("decided  "), "manufacturer").alias("name"))
    out = catalog.mart_products(p, b.product_categories(), decided)
    return out.select("barcode", "name", "sort_key", F.coalesce("category_id", F.lit(-1)).alias("category_id"))


# --- categories and summaries --------------------------------------------------


COUNTS = """
    , sub AS (SELECT c.id, c.parent_id, c.name_he, count(p.barcode) AS n FROM categories c LEFT JOIN products p
              ON p.category_id = c.id WHERE c.parent_id IS NOT NULL GROUP BY ALL)"""


@query("category_rollup", COUNTS + """
    SELECT id::BIGINT AS category_id, n AS count FROM sub
    UNION ALL SELECT c.id::BIGINT, coalesce(sum(s.n), 0)::BIGINT FROM categories c LEFT JOIN sub s ON s.parent_id = c.id
    WHERE c.parent_id IS NULL GROUP BY c.id""", ("categories", "products"))
def category_rollup(b: Bridge):
    return catalog.category_counts(b.categories(), b.mart_products())


@query("category_tree", COUNTS + """
    , seen AS (SELECT * FROM sub WHERE n > 0)
    SELECT t.id::BIGINT AS id, t.name_he, sum(s.n)::BIGINT AS count,
           string_agg(s.id || ':' || s.name_he || ':' || s.n, ',' ORDER BY s.id) AS children
    FROM categories t JOIN seen s ON s.parent_id = t.id WHERE t.parent_id IS NULL GROUP BY t.id, t.name_he""",
       ("categories", "products"))
def category_tree(b: Bridge):
    groups = b.categories()
    tree = catalog.category_tree(catalog.visible_categories(groups, catalog.category_counts(groups, b.mart_products())))
    child = F.transform("children", lambda c: F.concat_ws(":", c["id"], c["name_he"], c["count"]))
    return tree.select("id", "name_he", "count", F.array_join(child, ",").alias("children"))


@query("product_summary", """
    SELECT p.barcode, p.name, coalesce(p.category_id, -1)::BIGINT AS category_id, coalesce(x.low, -1) AS min_agorot,
           coalesce(x.n, 0) AS chains, (p.barcode IN (SELECT barcode FROM real_deals))::BIGINT AS on_deal,
           p.is_weighted::BIGINT AS weighted
    FROM products p LEFT JOIN (SELECT barcode, min(agorot) AS low, count(*) AS n FROM base GROUP BY barcode) x
    ON p.barcode = x.barcode""", ("products", "base", "real_deals"))
def product_summary(b: Bridge):
    rows = catalog.product_summaries(b.mart_products(), b.once("base", b.baselines), b.deals()[0])
    return rows.select("barcode", "name", F.coalesce("category_id", F.lit(-1)).alias("category_id"),
                       F.coalesce("min_agorot", F.lit(-1)).alias("min_agorot"), "chains", "on_deal", "weighted")


@query("category_page", """
    SELECT barcode, name FROM products WHERE category_id = 107 AND (sort_key, barcode) > ('large', '729500000000')
    ORDER BY sort_key, barcode LIMIT 25""", ("products",))
def category_page(b: Bridge):
    cursor = offers.encode_cursor("large", "729500000000")
    return catalog.category_page(b.mart_products(), 107, 24, cursor).select("barcode", "name")


# --- lookups -------------------------------------------------------------------


@query("scan_resolution", """
    , scans AS (SELECT barcode, CASE p_size % 4 WHEN 0 THEN '0' || barcode WHEN 1 THEN '729000' || barcode
            WHEN 2 THEN substr(barcode, 1, 3) || '-' || substr(barcode, 4) ELSE '9' || barcode END AS raw, p_size % 4 AS k
        FROM products JOIN (SELECT '729' || reverse(lpad(CAST(p_partkey AS VARCHAR), 9, '0')) AS barcode, p_size FROM part)
        USING (barcode))
    SELECT raw, CASE WHEN k = 3 THEN NULL ELSE barcode END AS barcode FROM scans""", ("products",))
def scan_resolution(b: Bridge):
    code, kind = ean("p_partkey"), F.col("p_size") % 4
    raw = (F.when(kind == 0, F.concat(F.lit("0"), code)).when(kind == 1, F.concat(F.lit("729000"), code))
           .when(kind == 2, F.concat(F.substring(code, 1, 3), F.lit("-"), F.substring(code, 4, 20)))
           .otherwise(F.concat(F.lit("9"), code)))
    return catalog.resolve_scans(b.table("part").select(raw.alias("raw")), b.products())


@query("variant_resolution", """
    SELECT raw, CASE WHEN short OR raw LIKE '729000%' THEN code ELSE NULL END AS barcode FROM (
        SELECT p_size % 2 = 0 AS short, CASE WHEN p_size % 2 = 0 THEN '729000' || barcode ELSE '1' || barcode END AS raw,
               barcode AS code FROM part JOIN products ON barcode = '729' || reverse(lpad(CAST(p_partkey AS VARCHAR), 9, '0')))""",
       ("products",))
def variant_resolution(b: Bridge):
    code = ean("p_partkey")
    raw = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("729000"), code)).otherwise(F.concat(F.lit("1"), code))
    return catalog.resolve_scans(b.table("part").select(raw.alias("raw")), b.products(), variants=True)


@query("exceptions_at_asked_stores", """
    SELECT e.* FROM exc e JOIN stores s USING (chain_id, store_id) WHERE s_suppkey % 3 = 0""", ("exc", "stores"))
def exceptions_at_asked_stores(b: Bridge):
    s = b.suppliers()
    asked = s.select(F.when(F.col("s_suppkey") % 3 == 0, F.concat_ws(":", "chain_id", "store_id"))
                     .when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit(":"), "store_id"))
                     .otherwise(F.concat(F.lit("ASIA:,"), "store_id")).alias("value"))
    return catalog.exceptions_for(b.prices()[2], catalog.store_pairs(asked))


@query("exceptions_without_valid_pair", "SELECT * FROM exc", ("exc",))
def exceptions_without_valid_pair(b: Bridge):
    asked = b.suppliers().select(F.concat(F.lit(":"), "store_id").alias("value"))
    return catalog.exceptions_for(b.prices()[2], catalog.store_pairs(asked))


@query("price_documents", """
    , p AS (SELECT barcode, string_agg(chain_id || '=' || agorot || '/' || store_count, ',' ORDER BY chain_id) AS prices
            FROM base GROUP BY barcode)
    SELECT q.barcode, q.name AS n, p.prices, q.is_weighted::BIGINT AS w,
           CASE WHEN is_weighted = 1 AND unit_qty = 'kilo' THEN 'kilo' END AS u
    FROM products q JOIN p USING (barcode)""", ("base", "products"))
def price_documents(b: Bridge):
    docs = catalog.price_documents(b.products(), b.baselines())
    entries = F.transform(F.map_entries("doc.p"), lambda e: F.concat(
        e["key"], F.lit("="), (e["value"]["price"] * 100).cast("bigint").cast("string"), F.lit("/"), e["value"]["stores"].cast("string")))
    return docs.select("barcode", F.col("doc.n").alias("n"), F.array_join(F.array_sort(entries), ",").alias("prices"),
                       F.coalesce("doc.w", F.lit(0)).alias("w"), F.col("doc.u").alias("u")).filter("prices is not null")


@query("batch_product_lookup", """
    SELECT raw, CASE WHEN k THEN barcode END AS barcode, CASE WHEN k THEN name END AS name,
           coalesce(CASE WHEN k THEN (SELECT count(*) FROM base x WHERE x.barcode = r.barcode) END, 0) AS chains,
           coalesce(CASE WHEN k THEN (SELECT count(*) FROM exc x WHERE x.barcode = r.barcode) END, 0) AS exceptions,
           coalesce(CASE WHEN k THEN (SELECT count(*) FROM kept x WHERE x.barcode = r.barcode) END, 0) AS offers
    FROM (SELECT CASE WHEN p_size % 2 = 0 THEN barcode ELSE 'x' || substr(barcode, 3) END AS raw, p_size % 2 = 0 AS k,
                 barcode, name FROM part JOIN products ON barcode = '729' || reverse(lpad(CAST(p_partkey AS VARCHAR), 9, '0'))
          ) r""", ("products", "base", "exc", "kept"))
def batch_product_lookup(b: Bridge):
    code = ean("p_partkey")
    asked = b.table("part").select(
        F.when(F.col("p_size") % 2 == 0, code).otherwise(F.concat(F.lit("x"), F.substring(code, 3, 20))).alias("raw"))
    _, base, exc = b.prices()
    kept, links, everywhere = b.kept()
    modes = offers.branch_modes(links, everywhere)
    entries = offers.promotion_entries(kept, modes, offers.branch_listing(links, everywhere, modes), TODAY)
    found = catalog.product_lookup(asked, b.products(), base, exc, entries)
    many = lambda name, n: found[name].groupBy("raw").agg(n.cast("bigint").alias(name if name != "detail" else "exceptions"))
    rows = found["documents"].join(many("detail", F.count(F.lit(1))), "raw", "left").join(
        many("offers", F.count(F.lit(1))), "raw", "left")
    none = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return rows.select("raw", "barcode", F.col("doc.n").alias("name"), none(F.size(F.map_keys("doc.p"))).alias("chains"),
                       none(F.col("exceptions")).alias("exceptions"), none(F.col("offers")).alias("offers"))


@query("meta_summary", """
    SELECT (SELECT count(*) FROM products) AS products, (SELECT count(DISTINCT barcode) FROM deals) AS promo_products,
           (SELECT count(*) FROM region) AS chains, (SELECT count(*) FROM stores) AS stores""", ("products", "deals", "stores"))
def meta_summary(b: Bridge):
    return catalog.meta_summary(b.products(), b.deals()[0], b.chains(), b.stores())


@query("store_directory", """
    SELECT s.chain_id, s.store_id, store_name AS name, city, count(l.barcode) AS priced_items FROM stores s
    LEFT JOIN latest l ON s.chain_id = l.chain_id AND s.store_id = l.store_id GROUP BY ALL""", ("stores", "latest"))
def store_directory(b: Bridge):
    return catalog.store_directory(priced_items(b.latest(), b.stores()))


@query("store_labels", """
    SELECT store_id, CASE s_suppkey % 3 WHEN 0 THEN 'סניף ' || store_id WHEN 1 THEN store_name
           ELSE store_name || ' · ' || city END AS label FROM stores""", ("stores",))
def store_labels(b: Bridge):
    k = F.col("s_suppkey") % 3
    label = text.store_label(F.col("store_id"), F.when(k != 0, F.col("store_name")),
                             F.when(k == 2, F.col("city")).otherwise(F.col("s_nationkey").cast("string")))
    return b.suppliers().select("store_id", label.alias("label"))


# --- names ---------------------------------------------------------------------


NAMES = """
    , every AS (SELECT o.chain_id, o.store_id, o.barcode, CASE o.chain_id
          WHEN 'ASIA' THEN substr(p.name || ' ..................', 1, 20)
          WHEN 'EUROPE' THEN '"' || replace(p.name, ' ', ' ""') || '"'
          ELSE p.name || CASE WHEN o.agorot % 3 = 0 THEN ' x' ELSE '' END END AS name,
          CASE WHEN o.agorot % 2 = 0 THEN p.manufacturer ELSE '' END AS manufacturer
        FROM latest o JOIN products p USING (barcode)),
    raw AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY chain_id, barcode ORDER BY store_id) = 1),
    rows AS (SELECT barcode, chain_id, CASE chain_id WHEN 'EUROPE' THEN replace(trim(name, '"'), '""', '"') ELSE trim(name) END AS name,
          manufacturer, CASE chain_id WHEN 'ASIA' THEN 1 ELSE 0 END AS capped FROM raw)"""


def _names(b: Bridge):
    named = b.latest().join(b.products().select("barcode", "name", "manufacturer"), "barcode")
    p = F.col("name")
    name = (F.when(F.col("chain_id") == "ASIA", F.substring(F.concat(p, F.lit(" ..................")), 1, 20))
            .when(F.col("chain_id") == "EUROPE", F.concat(F.lit('"'), F.replace(p, F.lit(" "), F.lit(' ""')), F.lit('"')))
            .otherwise(F.concat(p, F.when(F.col("agorot") % 3 == 0, " x").otherwise(""))))
    maker = F.when(F.col("agorot") % 2 == 0, F.col("manufacturer")).otherwise("")
    every = named.select("chain_id", "store_id", "barcode", name.alias("name"), maker.alias("manufacturer"))
    return names.one_per_chain(every)


@query("name_capping_chains", NAMES + """
    SELECT chain_id, max(length(name)) AS longest, (max(length(name)) = 20)::BIGINT AS capped FROM raw GROUP BY chain_id""",
       ("latest", "products"))
def name_capping_chains(b: Bridge):
    return names.capping_chains(_names(b))


VOTE = NAMES + """
    , pool AS (SELECT * FROM rows QUALIFY capped = min(capped) OVER (PARTITION BY barcode)),
    votes AS (SELECT barcode, capped, name, count(*) AS n FROM pool GROUP BY ALL),
    top AS (SELECT * FROM votes QUALIFY n = max(n) OVER (PARTITION BY barcode)),
    chosen AS (SELECT *, count(*) OVER (PARTITION BY barcode) AS tied,
        row_number() OVER (PARTITION BY barcode ORDER BY length(name) DESC, name DESC) AS rn FROM top)"""


@query("name_vote", VOTE + """
    SELECT barcode, name, CASE capped WHEN 0 THEN 'trusted' ELSE 'capping-fallback' END
           || CASE WHEN tied > 1 THEN '/tie-longest' ELSE '' END AS source, n AS votes
    FROM chosen WHERE rn = 1 AND barcode NOT IN (SELECT barcode FROM products WHERE is_weighted = 1)""", ("latest", "products"))
def name_vote(b: Bridge):
    decided = b.products().filter("is_weighted = 1")
    return names.propose(names.candidates(_names(b)), decided)


@query("brand_vote", VOTE + """
    SELECT barcode, manufacturer AS brand FROM (SELECT barcode, manufacturer, count(*) AS n FROM pool
        WHERE manufacturer <> '' GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY barcode ORDER BY n DESC, manufacturer) = 1""", ("latest", "products"))
def brand_vote(b: Bridge):
    return names.propose_brand(names.candidates(_names(b)))


@query("name_review_sheet", VOTE + """
    , seen AS (SELECT barcode, string_agg(c, ' | ' ORDER BY c) AS candidates FROM (
        SELECT DISTINCT barcode, chain_id || ': ' || name AS c FROM rows) GROUP BY barcode)
    SELECT c.barcode, c.name AS proposed_name, CASE capped WHEN 0 THEN 'trusted' ELSE 'capping-fallback' END
           || CASE WHEN tied > 1 THEN '/tie-longest' ELSE '' END AS source, s.candidates,
           coalesce((SELECT max(manufacturer) FROM pool p WHERE p.barcode = c.barcode), '') AS brand,
           (SELECT count(*) FROM rows r WHERE r.barcode = c.barcode) AS chains
    FROM chosen c JOIN seen s USING (barcode) WHERE rn = 1""", ("latest", "products"))
def name_review_sheet(b: Bridge):
    rows = names.candidates(_names(b))
    nothing = b.products().filter("false")
    return names.review_rows(names.propose(rows, nothing), names.propose_brand(rows), rows)


# --- placing -------------------------------------------------------------------


def _paths(b: Bridge):
    """Category paths: type > brand > first word, under a shop root for some."""
    path = F.concat(F.when(F.col("p_size") % 5 == 0, "SHOP>").otherwise(""), F.col("p_type"), F.lit(">"),
                    F.when(F.col("p_size") % 4 != 0, F.col("p_brand")).otherwise("ECONOMY"), F.lit(">"),
                    F.substring_index("p_name", " ", 1))
    return b.table("part").select(
        ean("p_partkey").alias("barcode"), path.alias("path"), "p_type", "p_brand",
        F.substring_index("p_name", " ", 1).alias("word"), F.substring_index("p_name", " ", -1).alias("second_level"),
        F.col("p_name").alias("name"))


PATHS = """
    WITH paths AS (SELECT '729' || reverse(lpad(CAST(p_partkey AS VARCHAR), 9, '0')) AS barcode, p_type AS dept, p_name AS name,
        CASE WHEN p_size % 4 <> 0 THEN p_brand ELSE 'ECONOMY' END AS cat, split_part(p_name, ' ', 1) AS leaf,
        split_part(p_name, ' ', 2) AS second_level, CASE WHEN p_size % 5 = 0 THEN 'SHOP' ELSE '' END AS root FROM part)"""
LADDER = PATHS + """
    , placed AS (SELECT barcode, CASE WHEN leaf = 'red' THEN 'leaf-' || dept
        WHEN dept = 'LARGE' AND cat <> 'ECONOMY' THEN 'pair-' || cat
        WHEN dept IN ('SMALL', 'ECONOMY') THEN 'dept-' || dept
        WHEN cat = 'ECONOMY' THEN 'dept-ECONOMY'
        WHEN root = 'SHOP' THEN 'root-shop'
        WHEN second_level = 'ring' THEN 'fall-ring' END AS slug FROM paths)"""


def _rules(b: Bridge):
    """Placement rules drawn from the parts themselves."""
    p = b.table("part").select("p_type", "p_brand", F.substring_index("p_name", " ", 1).alias("w"),
                               F.substring_index("p_name", " ", -1).alias("last"),
                               F.when(F.col("p_size") % 5 == 0, "SHOP").alias("shop"))
    nil = F.lit("")

    def rule(rows, level, slug, dept=nil, cat=nil, leaf=nil, root=nil, second=nil):
        return rows.select(F.lit(level).alias("level"), dept.alias("dept"), cat.alias("cat"), leaf.alias("leaf"),
                           root.alias("root"), second.alias("second_level"), slug.alias("slug")).distinct()

    t, br = F.col("p_type"), F.col("p_brand")
    red = p.filter("w = 'red'")
    leafs = rule(red, "leaf", F.concat(F.lit("leaf-"), t), t, br, F.col("w")).unionByName(
        rule(red, "leaf", F.concat(F.lit("leaf-"), t), t, F.lit("ECONOMY"), F.col("w")))
    pairs = rule(p.filter("p_type = 'LARGE'"), "pair", F.concat(F.lit("pair-"), br), t, br)
    depts = rule(p.filter("p_type in ('SMALL', 'ECONOMY')"), "department", F.concat(F.lit("dept-"), t), t)
    roots = rule(p.filter("shop is not null"), "root", F.lit("root-shop"), root=F.col("shop"))
    falls = rule(p.filter("last = 'ring'"), "fallback", F.lit("fall-ring"), second=F.concat(F.col("last"), F.lit("")))
    return leafs.unionByName(pairs).unionByName(depts).unionByName(roots).unionByName(falls)


def _placed(b: Bridge):
    roots = b.table("part").filter("p_size % 5 = 0").select(F.when(F.col("p_size") % 5 == 0, "SHOP").alias("root"))
    return categories.place(categories.split_path(_paths(b), roots), _rules(b))


@query("category_ladder", LADDER + "SELECT barcode, slug FROM placed")
def category_ladder(b: Bridge):
    return _placed(b).select("barcode", "slug")


def _pair_rules(b: Bridge):
    p = b.table("part").filter("p_type in ('PROMO', 'MEDIUM')")
    return p.select(F.lit("one").alias("chain"), F.col("p_type").alias("dept"), F.col("p_brand").alias("cat"),
                    F.concat(F.lit("pair-"), "p_brand").alias("slug"))


@query("pair_placements", PATHS + """
    SELECT barcode, 'pair-' || cat AS slug FROM paths WHERE dept IN ('PROMO', 'MEDIUM') AND cat <> 'ECONOMY' AND root = ''""")
def pair_placements(b: Bridge):
    rows = _paths(b).withColumn("chain", F.lit("one"))
    return categories.place_by_pair(rows, _pair_rules(b))[0].select("barcode", "slug")


@query("unplaced_paths", PATHS + """
    SELECT 'one' AS chain, CASE WHEN root = '' THEN dept ELSE root END AS dept, CASE WHEN root = '' THEN cat ELSE dept END AS cat,
           count(*) AS products FROM paths WHERE NOT (dept IN ('PROMO', 'MEDIUM') AND cat <> 'ECONOMY' AND root = '')
    GROUP BY ALL ORDER BY products DESC, chain, dept, cat LIMIT 8""")
def unplaced_paths(b: Bridge):
    rows = _paths(b).withColumn("chain", F.lit("one"))
    return categories.top_misses(categories.place_by_pair(rows, _pair_rules(b))[1], 8)


def _merged_sources(b: Bridge):
    first = _placed(b).filter("slug is not null").select("barcode", "slug", F.lit("first").alias("source"))
    rows = _paths(b).withColumn("chain", F.lit("one"))
    second = categories.place_by_pair(rows, _pair_rules(b))[0].select("barcode", "slug", F.lit("second").alias("source"))
    last = b.products().filter("is_weighted = 1").select("barcode", F.lit("weighed").alias("slug"), F.lit("last").alias("source"))
    rank = F.when(F.col("source") == "first", 1).when(F.col("source") == "second", 2).otherwise(3)
    every = first.unionByName(second).unionByName(last)
    return categories.merge_sources(every, every.select("source").distinct().withColumn("rank", rank))


MERGED = LADDER + """
    , every AS (SELECT barcode, slug, 'first' AS source, 1 AS r FROM placed WHERE slug IS NOT NULL
      UNION ALL SELECT barcode, 'pair-' || cat, 'second', 2 FROM paths WHERE dept IN ('PROMO', 'MEDIUM') AND cat <> 'ECONOMY' AND root = ''
      UNION ALL SELECT '729' || reverse(lpad(CAST(p_partkey AS VARCHAR), 9, '0')), 'weighed', 'last', 3 FROM part WHERE p_size % 8 = 0),
    merged AS (SELECT barcode, slug, source FROM every QUALIFY row_number() OVER (PARTITION BY barcode ORDER BY r) = 1)"""


@query("category_source_precedence", MERGED + "SELECT * FROM merged")
def category_source_precedence(b: Bridge):
    return _merged_sources(b)


@query("placement_totals", MERGED + """
    SELECT 'department' AS kind, split_part(slug, '-', 1) AS name, count(*) AS products FROM merged GROUP BY ALL
    UNION ALL SELECT 'source', source, count(*) FROM merged GROUP BY ALL""")
def placement_totals(b: Bridge):
    merged = _merged_sources(b)
    tops = merged.select("slug", F.substring_index("slug", "-", 1).alias("top_slug")).distinct()
    return categories.totals(merged, tops).select("kind", "name", "products")


@query("mapping_audit", """
    WITH r AS (SELECT DISTINCT p_type AS dept, p_brand AS cat, CASE WHEN p_type = 'PROMO' THEN 'lost' ELSE 'known' END AS slug FROM part
               WHERE p_size < 26),
    d AS (SELECT DISTINCT p_type AS dept, p_brand AS cat FROM part WHERE p_size >= 26)
    SELECT lower(dept) AS map_name, dept, cat, slug, CASE WHEN slug = 'lost' THEN 'unknown slug' ELSE 'no longer in any dump' END AS problem
    FROM r WHERE slug = 'lost' OR (dept, cat) NOT IN (SELECT (dept, cat) FROM d)""")
def mapping_audit(b: Bridge):
    p = b.table("part").select(F.lower("p_type").alias("map_name"), F.col("p_type").alias("dept"), F.col("p_brand").alias("cat"), "p_size")
    slug = F.when(F.col("dept") == "PROMO", "lost").otherwise("known")
    rules = p.filter("p_size < 26").withColumn("slug", slug).drop("p_size").distinct()
    dumps = p.filter("p_size >= 26").drop("p_size")
    return categories.audit(rules, dumps, rules.select("slug").filter("slug = 'known'"))


@query("category_path_examples", PATHS + """
    , pathed AS (SELECT CASE WHEN root = '' THEN '' ELSE root || '>' END || dept || '>' || cat || '>' || leaf AS path, barcode, name FROM paths)
    SELECT path, count(*) AS products, string_agg(name, '|' ORDER BY rn) FILTER (rn <= 8) AS names
    FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY barcode, name) AS rn FROM pathed) GROUP BY path""")
def category_path_examples(b: Bridge):
    return categories.path_examples(_paths(b)).withColumn("names", F.array_join("names", "|"))


@query("taxonomy_coverage", """
    SELECT chain_id, count(*) AS priced, count(*) FILTER (barcode IN (SELECT barcode FROM products WHERE is_weighted = 1)) AS matched,
           floor(count(*) FILTER (barcode IN (SELECT barcode FROM products WHERE is_weighted = 1)) * 1000.0 / count(*))::BIGINT AS coverage_tenths
    FROM base GROUP BY chain_id""", ("base", "products"))
def taxonomy_coverage(b: Bridge):
    return categories.coverage(b.baselines(), b.products().filter("is_weighted = 1"))


@query("taxonomy_flatten", """
    WITH heads AS (SELECT p_type, dense_rank() OVER (ORDER BY p_type) AS position FROM (SELECT DISTINCT p_type FROM part)),
    subs AS (SELECT h.position, h.p_type, b.p_brand, row_number() OVER (PARTITION BY h.position ORDER BY b.p_brand) AS pos
             FROM (SELECT DISTINCT p_type, p_brand FROM part) b JOIN heads h USING (p_type)),
    flat AS (SELECT position, 0 AS pos, p_type AS slug FROM heads UNION ALL SELECT position, pos, p_type || '-' || p_brand FROM subs),
    n AS (SELECT *, row_number() OVER (ORDER BY position, pos) AS id FROM flat)
    SELECT id, slug, CASE WHEN pos > 0 THEN (SELECT id FROM n m WHERE m.position = n.position AND m.pos = 0) ELSE -1 END AS parent_id FROM n""")
def taxonomy_flatten(b: Bridge):
    """Types with their brands as aisles; both are fixed, short lists."""
    pairs = b.table("part").select("p_type", "p_brand").distinct()
    sub = F.struct(F.concat_ws("-", "p_type", "p_brand").alias("slug"), F.lower("p_brand").alias("name_he"))
    tops = pairs.groupBy("p_type").agg(F.array_sort(F.collect_list(sub)).alias("subs"))
    departments = tops.select(F.col("p_type").alias("position"), F.col("p_type").alias("slug"),
                              F.lower("p_type").alias("name_he"), "subs")
    rows = categories.flatten_taxonomy(departments)
    return rows.select("id", "slug", F.coalesce("parent_id", F.lit(-1)).alias("parent_id"))


@query("shape_drift", """
    WITH was AS (SELECT 'department' AS kind, p_brand AS name, count(*) * 2 AS was FROM part WHERE p_size < 26 GROUP BY ALL
                 UNION ALL SELECT 'source', p_type, count(*) * 2 FROM part WHERE p_size < 26 GROUP BY ALL
                 UNION ALL SELECT 'rows', 'all', count(*) * 2 FROM part WHERE p_size < 26),
    now AS (SELECT 'department' AS kind, p_brand AS name, count(*) AS now FROM part WHERE p_size % 5 <> 0 GROUP BY ALL
            UNION ALL SELECT 'source', p_type, count(*) FROM part WHERE p_size % 5 <> 0 GROUP BY ALL
            UNION ALL SELECT 'rows', 'all', count(*) FROM part WHERE p_size % 5 <> 0)
    SELECT kind, name, was, coalesce(now, 0) AS now FROM was LEFT JOIN now USING (kind, name)
    WHERE (kind = 'rows' AND coalesce(now, 0) * 10 <= was * 9) OR (kind = 'department' AND abs(coalesce(now, 0) - was) > greatest(50, was * 0.2))
       OR (kind = 'source' AND coalesce(now, 0) * 10 < was * 8)""")
def shape_drift(b: Bridge):
    def counts(rows, times):
        n = (F.count(F.lit(1)) * times).alias("products")
        one = lambda kind, c: rows.groupBy(c.alias("name")).agg(n).withColumn("kind", F.lit(kind))
        return one("department", F.col("p_brand")).unionByName(one("source", F.col("p_type"))).unionByName(one("rows", F.lit("all")))

    part = b.table("part")
    return categories.shape_drift(counts(part.filter("p_size % 5 <> 0"), 1), counts(part.filter("p_size < 26"), 2))


@query("category_from_address", """
    SELECT '729' || reverse(lpad(CAST(p_partkey AS VARCHAR), 9, '0')) AS barcode, p_type || '>' || p_brand AS path, p_name AS name FROM part""")
def category_from_address(b: Bridge):
    slug = F.replace(F.col("p_name"), F.lit(" "), F.lit("-"))
    url = F.concat(F.lit("/"), F.url_encode(F.lit(text.CATEGORY_ROOT)), F.lit("/"), F.url_encode("p_type"), F.lit("/"),
                   F.url_encode("p_brand"), F.lit("/"), slug, F.lit("/p/P_"), F.col("p_partkey").cast("string"))
    parsed = text.url_path(url)
    return b.table("part").select(ean("p_partkey").alias("barcode"), parsed.alias("u")).select("barcode", "u.path", "u.name")


@query("category_from_objects", """
    SELECT '729' || reverse(lpad(CAST(p_partkey AS VARCHAR), 9, '0')) AS barcode,
           p_type || '>' || CASE WHEN p_size % 2 = 0 THEN p_brand || '>' ELSE '' END || p_name AS path FROM part""")
def category_from_objects(b: Bridge):
    middle = F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("")
    groups = F.array(*[F.struct(c.alias("name")) for c in (F.col("p_type"), middle, F.col("p_name"))])
    return b.table("part").select(ean("p_partkey").alias("barcode"), text.category_path(groups).alias("path"))


# --- produce -------------------------------------------------------------------


def _units(b: Bridge):
    """Curated lines: a product name at every chain that has it, first price."""
    sold = b.lines("l_quantity").select("chain_id", "barcode", "agorot").join(
        b.products().select("barcode", F.col("name").alias("slug")), "barcode")
    return sold.groupBy("slug", "chain_id", "barcode").agg(F.max("agorot").alias("agorot"))


UNITS = """
    , units AS (SELECT name AS slug, chain_id, barcode, max(agorot) AS agorot FROM obs JOIN products USING (barcode) GROUP BY ALL)"""


@query("produce_reconciliation", UNITS + """
    , f AS (SELECT slug, chain_id, min(barcode) AS first FROM units GROUP BY ALL)
    SELECT u.slug, u.chain_id, u.barcode, u.agorot, b.agorot AS now, CASE WHEN u.barcode <> f.first THEN 'listed twice'
        WHEN b.agorot IS NULL THEN 'no longer priced' WHEN p.is_weighted <> 1 THEN 'no longer weighed'
        WHEN abs(b.agorot - u.agorot) * 100 > u.agorot * 2 THEN 'drifted' ELSE 'ok' END AS status
    FROM units u JOIN f USING (slug, chain_id) LEFT JOIN base b USING (chain_id, barcode) LEFT JOIN products p USING (barcode)""",
       ("obs", "products", "base"))
def produce_reconciliation(b: Bridge):
    return produce.reconcile(_units(b), b.chain_products(), b.baselines(), tolerance_pct=2)


@query("produce_wide_lines", UNITS + """
    SELECT slug, count(*) AS rows, min(agorot) AS low, max(agorot) AS high FROM units GROUP BY slug
    HAVING count(*) > 3 AND max(agorot) > 5 * min(agorot)""", ("obs", "products"))
def produce_wide_lines(b: Bridge):
    return produce.wide_lines(_units(b), ratio=5)


@query("produce_chain_share", UNITS + """
    SELECT slug, count(DISTINCT chain_id) AS chains, (SELECT count(DISTINCT chain_id) FROM units) AS all_chains,
           (count(DISTINCT chain_id) * 10 >= 4 * (SELECT count(DISTINCT chain_id) FROM units))::BIGINT AS is_core
    FROM units GROUP BY slug""", ("obs", "products"))
def produce_chain_share(b: Bridge):
    return produce.chain_share(_units(b))


# --- gates ---------------------------------------------------------------------


@query("table_row_counts", """
    SELECT 'products' AS table_name, count(*) AS rows FROM products UNION ALL SELECT 'stores', count(*) FROM stores
    UNION ALL SELECT 'baselines', count(*) FROM base UNION ALL SELECT 'exceptions', count(*) FROM exc
    UNION ALL SELECT 'offers', count(*) FROM offers UNION ALL SELECT 'links', count(*) FROM links""",
       ("products", "stores", "base", "exc", "offers", "links"))
def table_row_counts(b: Bridge):
    _, base, exc = b.prices()
    rows, links = b.offer_tables()
    return quality.table_counts({"products": b.products(), "stores": b.stores(), "baselines": base,
                                 "exceptions": exc, "offers": rows, "links": links})


@query("minimum_count_gate", """
    SELECT label, actual, minimum, (actual >= minimum)::BIGINT AS ok FROM (
        SELECT 'barcodes' AS label, count(*) AS actual, 50000::BIGINT AS minimum FROM products
        UNION ALL SELECT 'chains with prices', count(DISTINCT chain_id), 3 FROM base
        UNION ALL SELECT 'stores', count(*), 100 FROM stores UNION ALL SELECT 'cities', count(DISTINCT city), 20 FROM stores)""",
       ("products", "base", "stores"))
def minimum_count_gate(b: Bridge):
    return quality.minimum_counts(b.products(), b.baselines(), b.stores())


@query("orphan_prices", """
    SELECT * FROM base WHERE barcode NOT IN (SELECT barcode FROM products WHERE is_weighted = 0)""", ("base", "products"))
def orphan_prices(b: Bridge):
    return quality.orphan_prices(b.baselines(), b.products().filter("is_weighted = 0"))


@query("view_liveness", """
    SELECT p.name, e.barcode, e.chain_id, e.store_id, e.agorot FROM effective e JOIN products p USING (barcode)
    ORDER BY e.agorot, e.barcode, e.chain_id, e.store_id LIMIT 3""", ("effective", "products"))
def view_liveness(b: Bridge):
    _, base, exc = b.prices()
    return quality.live_view(b.stores(), base, exc, b.products(), b.chains())


@query("release_gate", """
    SELECT chain_id, products, built_at, (products > 1980 AND built_at > '2001-10-25')::BIGINT AS accepted,
           CASE WHEN products <= 1980 THEN 'too few products' WHEN built_at <= '2001-10-25' THEN 'not newer than the live build' END AS reason
    FROM (SELECT chain_id, count(DISTINCT barcode) AS products, CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) AS built_at
          FROM obs GROUP BY chain_id)""", ("obs",))
def release_gate(b: Bridge):
    builds = b.observations().groupBy("chain_id").agg(
        F.count_distinct("barcode").alias("products"), F.max(F.to_date("l_shipdate")).cast("string").alias("built_at"))
    return quality.release_gate(builds, "2001-10-25", least=1980)


@query("stale_chains", """
    SELECT chain_id, CAST(as_of AS VARCHAR) AS as_of, datediff('day', as_of, DATE '2001-10-28') AS days_old FROM (
        SELECT store_id AS chain_id, max(CAST(l_shipdate AS DATE)) AS as_of FROM obs GROUP BY store_id)
    WHERE as_of < DATE '2001-10-28'""", ("obs",))
def stale_chains(b: Bridge):
    as_of = b.observations().groupBy(F.col("store_id").alias("chain_id")).agg(F.max(F.to_date("l_shipdate")).alias("as_of"))
    return quality.stale_chains(as_of, F.lit("2001-10-28"))


@query("unnamed_chains", "SELECT DISTINCT chain_id FROM base WHERE chain_id LIKE '%A'", ("base",))
def unnamed_chains(b: Bridge):
    named = b.chains().withColumn("name", F.when(F.col("chain_id").endswith("A"), "").otherwise(F.col("name")))
    return quality.unnamed_chains(b.baselines(), named)
