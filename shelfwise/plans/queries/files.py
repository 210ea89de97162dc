"""Published files: choosing, reading, sharding and streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions import text
from shelfwise.operators import promotions, shards
from shelfwise.operators.spread import widen
from shelfwise.plans.bridge import Bridge, ean
from shelfwise.plans.registry import query
from shelfwise.session import shared_dir
from shelfwise.sources import csv, files, xml
from shelfwise.streaming import jobs, latest


# --- choosing files --------------------------------------------------------------


def _file_table(b: Bridge) -> DataFrame:
    """One published file per order line, named like the portals name them."""
    kind = F.when(F.col("l_returnflag") == "A", "PriceFull").when(F.col("l_returnflag") == "N", "PromoFull").otherwise("Price")
    day = F.date_format("l_shipdate", "yyyyMMdd")
    time = F.concat(F.lit("0"), F.col("l_linenumber").cast("string"), F.lit("00"))
    chain = F.concat(F.lit("7290"), F.lpad((F.col("l_partkey") % 50).cast("string"), 9, "0"))
    odd = F.col("l_quantity").cast("int") % 10 == 0
    stamp = F.when(odd, F.lit("x")).otherwise(F.concat_ws("-", day, time))
    name = F.concat(kind, chain, F.lit("-"), F.lpad(F.col("l_suppkey").cast("string"), 3, "0"), F.lit("-"), stamp, F.lit(".xml"))
    rows = b.table("lineitem").select(
        F.concat(F.lit("/in/"), name).alias("path"), chain.alias("chain_id"), F.col("l_suppkey").cast("string").alias("store_id"),
        F.to_date("l_shipdate").alias("day"), "l_orderkey")
    return files.describe_names(widen(rows))


FILES = """
    WITH raw AS (SELECT CASE l_returnflag WHEN 'A' THEN 'PriceFull' WHEN 'N' THEN 'PromoFull' ELSE 'Price' END AS k,
        '7290' || lpad(CAST(l_partkey % 50 AS VARCHAR), 9, '0') AS chain_id, CAST(l_suppkey AS VARCHAR) AS store_id,
        strftime(l_shipdate, '%Y%m%d') AS d, '0' || l_linenumber || '00' AS t, CAST(l_quantity AS INT) % 10 = 0 AS odd,
        CAST(l_shipdate AS DATE) AS day, l_orderkey FROM lineitem),
    f AS (SELECT *, lower(k) AS kind, CASE WHEN NOT odd THEN d || t || '00' END AS stamp,
        k || chain_id || '-' || lpad(store_id, 3, '0') || '-' || CASE WHEN odd THEN 'x' ELSE d || '-' || t END || '.xml' AS name FROM raw)"""


@query("file_names_described", FILES + """
    SELECT kind, stamp, count(*) AS files FROM f GROUP BY ALL""")
def file_names_described(b: Bridge):
    return _file_table(b).groupBy("kind", "stamp").agg(F.count(F.lit(1)).alias("files"))


@query("newest_file_per_branch", FILES + """
    SELECT name, l_orderkey FROM f QUALIFY stamp IS NULL OR stamp = max(stamp) OVER (PARTITION BY kind, chain_id, store_id)""")
def newest_file_per_branch(b: Bridge):
    return files.newest_per_branch(_file_table(b)).select("name", "l_orderkey")


@query("newest_file_per_name", FILES + """
    , n AS (SELECT name, stamp, k || chain_id || '-' || lpad(store_id, 3, '0') AS prefix FROM f)
    SELECT name FROM n WHERE stamp IS NULL UNION ALL SELECT max(name) FROM n WHERE stamp IS NOT NULL GROUP BY prefix""")
def newest_file_per_name(b: Bridge):
    return files.newest_per_name(_file_table(b).select("name", "kind")).select("name")


@query("quarantined_names", FILES + """
    SELECT name, 'no date in the name' AS reason FROM f WHERE odd""")
def quarantined_names(b: Bridge):
    return files.quarantine(_file_table(b))[1].select("name", "reason")


@query("full_snapshot_files", FILES + "SELECT name, l_orderkey FROM f WHERE kind <> 'price'")
def full_snapshot_files(b: Bridge):
    return files.full_snapshots(_file_table(b)).select("name", "l_orderkey")


@query("latest_day_within_lookback", FILES + """
    , r AS (SELECT * FROM f WHERE kind <> 'price' AND day BETWEEN DATE '1998-05-29' AND DATE '1998-06-01'),
    n AS (SELECT store_id, max(day) AS day FROM r GROUP BY store_id)
    SELECT name, l_orderkey, CASE WHEN day < DATE '1998-06-01' THEN CAST(day AS VARCHAR) || 'T12:00:00+00:00' ELSE '' END AS as_of
    FROM r JOIN n USING (store_id, day)""")
def latest_day_within_lookback(b: Bridge):
    rows = files.latest_day(_file_table(b).withColumn("source", F.col("store_id")), "1998-06-01")
    return rows.select("name", "l_orderkey", F.coalesce("as_of", F.lit("")).alias("as_of"))


@query("backfilled_parts", """
    WITH h AS (SELECT l_suppkey AS chain, CAST(l_shipdate AS DATE) AS d, l_returnflag = 'R' AS expired FROM lineitem),
    n AS (SELECT chain, max(d) AS d FROM h WHERE NOT expired GROUP BY chain)
    SELECT CAST(chain AS VARCHAR) AS chain, CAST(d AS VARCHAR) AS built_at,
           CASE WHEN chain % 2 = 0 AND d = DATE '2001-10-20' THEN 'noted' ELSE CAST(d AS VARCHAR) END AS as_of FROM n""")
def backfilled_parts(b: Bridge):
    day = F.to_date("l_shipdate").cast("string")
    history = b.table("lineitem").select(F.col("l_suppkey").cast("string").alias("chain"), day.alias("built_at"),
                                         (F.col("l_returnflag") == "R").alias("expired"))
    notes = b.table("supplier").filter("s_suppkey % 2 = 0").select(
        F.col("s_suppkey").cast("string").alias("chain"), F.lit("noted").alias("as_of"))
    return files.backfill(history, notes, run="2001-10-20")


@query("page_links", """
    SELECT DISTINCT unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages""")
def page_links(b: Bridge):
    return files.page_links(b.table("pages"), 'href="([^"]+)"').select("link")


@query("download_links", """
    WITH l AS (SELECT DISTINCT unnest(regexp_extract_all(replace(html, 'href="/', 'href="/Prices/Download?fileName=Stores'),
        '/Prices/Download\\?fileName=([^"''&<>]+)', 1)) AS link FROM pages)
    SELECT link, 1::BIGINT AS is_full FROM l""".replace("\\\\", "\\"))
def download_links(b: Bridge):
    html = F.replace(F.col("html"), F.lit('href="/'), F.lit('href="/Prices/Download?fileName=Stores'))
    links = files.page_links(b.table("pages").select(html.alias("html")))
    return links.select("link", F.col("is_full").cast("int").alias("is_full"))


@query("image_barcodes", """
    SELECT page_id, CASE page_id % 3 WHEN 2 THEN NULL ELSE lpad(CAST(page_id * 7919 + 10000000 AS VARCHAR), 8, '0') END AS barcode FROM pages""")
def image_barcodes(b: Bridge):
    code = F.lpad((F.col("page_id") * 7919 + 10000000).cast("string"), 8, "0")
    url = F.concat(F.lit("https://img/gs1-products/1062/small/"), code, F.lit("-7/"),
                   F.when(F.col("page_id") % 3 == 0, code).otherwise("other"), F.lit("/a.jpg"))
    url = F.when(F.col("page_id") % 3 == 2, F.col("url")).otherwise(url)
    return b.table("pages").select("page_id", text.image_barcode(url).alias("barcode"))


@query("file_header_identity", """
    SELECT CAST(s_suppkey AS VARCHAR) AS path, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_nationkey + 100 AS VARCHAR) END AS chain_id,
           CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_suppkey AS VARCHAR) END AS store_id FROM supplier""")
def file_header_identity(b: Bridge):
    key = F.col("s_suppkey")
    store = F.when(key % 3 != 0, F.concat(F.lit("<StoreId>00"), key.cast("string"), F.lit("</StoreId>"))).otherwise("")
    content = F.concat(F.lit("<Root><ChainID>"), (F.col("s_nationkey") + 100).cast("string"), F.lit("</ChainID>"), store,
                       F.lit("<Items/></Root>"))
    return files.header_identity(b.table("supplier").select(key.cast("string").alias("_file"), content.alias("content")))


# --- reading files ---------------------------------------------------------------


@query("masked_cells_filled", """
    WITH c AS (SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber IN (1, 4, 6) THEN NULL
        WHEN l_linenumber = 5 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS v FROM lineitem)
    SELECT CAST(l_suppkey AS VARCHAR) AS store_id, l_orderkey, l_linenumber::BIGINT AS l_linenumber, coalesce(last_value(v IGNORE NULLS) OVER (
        PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey ROWS UNBOUNDED PRECEDING), '') AS value FROM c""")
def masked_cells_filled(b: Bridge):
    """One export per supplier, a block per shipping day."""
    line = F.col("l_linenumber")
    cell = F.when(line.isin(1, 4, 6), "").when(line == 5, "''").otherwise(F.col("l_orderkey").cast("string"))
    rows = b.table("lineitem").select(
        F.col("l_suppkey").cast("string").alias("_file"), F.unix_date(F.to_date("l_shipdate")).alias("_block"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey").alias("_row"), cell.alias("value"))
    out = csv.unmask(rows, ["value"])
    return out.select(F.col("_file").alias("store_id"), F.col("_row.l_orderkey").alias("l_orderkey"),
                      F.col("_row.l_linenumber").alias("l_linenumber"), "value")


def _element(tag: str, value: Column | str) -> Column:
    inner = F.lit(value) if isinstance(value, str) else value.cast("string")
    return F.concat(F.lit(f"<{tag}>"), inner, F.lit(f"</{tag}>"))


def _group(code: Column, qty: Column | str, price: Column | str, rate: str = "") -> Column:
    item = F.concat(_element("ItemCode", code), _element("MinQty", qty), _element("DiscountedPrice", price),
                    _element("DiscountRate", rate) if rate else F.lit(""))
    return _element("Group", _element("PromotionItems", _element("PromotionItem", item)))


def _promotion_texts(b: Bridge) -> DataFrame:
    """One promotion file per order line, in every published shape."""
    code, qty = ean("l_partkey"), F.col("l_quantity").cast("int") % 4 + 1
    price = F.concat((F.col("l_partkey") % 500 + 1).cast("string"), F.lit(".50"))
    shape = F.col("l_linenumber")
    nil = F.lit("0000000000000")
    groups = lambda *g: _element("Groups", F.concat(*g))
    flat = F.concat(_element("MinQty", qty), _element("DiscountedPrice", price),
                    _element("PromotionItems", _element("Item", _element("ItemCode", code))))
    body = (F.when(shape == 1, groups(_group(code, qty, price)))
            .when(shape == 2, groups(_group(code, qty, price), _group(code, "1", "1.00")))
            .when(shape == 3, groups(_group(nil, "1", ""), _group(code, "1", ""), _group(code, "1", "1.00")))
            .when(shape == 4, groups(_group(code, "1", price), _group(F.concat(code, F.lit("9")), "1", "0.10")))
            .when(shape == 5, groups(_group(code, qty, price), _group(code, "1", "0.00", "100")))
            .when(shape == 6, flat)
            .otherwise(groups(_group(code, "1", "0.00", "50"), _group(code, qty, "0.02"))))
    promo = F.concat(_element("PromotionId", F.concat(F.lit("00"), F.col("l_orderkey").cast("string"), F.lit("1"))),
                     _element("ClubID", F.when(F.col("l_returnflag") == "R", "(1=card").otherwise("0=")),
                     _element("AdditionalIsCoupon", F.when(F.col("l_linestatus") == "F", "1").otherwise("0")), body)
    content = F.concat(F.lit("<Root>"), _element("ChainID", "7290000000001"), _element("StoreId", F.concat(F.lit("0"), F.col("l_suppkey").cast("string"))),
                       _element("Promotions", _element("Promotion", promo)), F.lit("</Root>"))
    rows = b.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                      "l_returnflag", "l_linestatus")
    return widen(rows).select(F.col("l_orderkey").cast("string").alias("_file"), content.alias("content"))


@query("promotion_files_to_offers", """
    WITH r AS (SELECT '729' || reverse(lpad(CAST(l_partkey AS VARCHAR), 9, '0')) AS barcode, CAST(l_suppkey AS VARCHAR) AS store_id,
        ltrim(CAST(l_orderkey AS VARCHAR) || '1', '0') AS promo_id, (l_returnflag = 'R')::BIGINT AS club, (l_linestatus = 'F')::BIGINT AS coupon,
        CAST(l_quantity AS INT) % 4 + 1 AS q, (l_partkey % 500 + 1) * 100 + 50 AS p, l_linenumber AS s FROM lineitem),
    o AS (SELECT *, CASE s WHEN 1 THEN q WHEN 2 THEN q + 1 WHEN 3 THEN 2 WHEN 5 THEN q + 1 WHEN 6 THEN q ELSE q + 1 END AS n,
        CASE s WHEN 1 THEN p WHEN 2 THEN p + 100 WHEN 6 THEN p END AS a,
        CASE s WHEN 1 THEN p WHEN 2 THEN p + 100 WHEN 6 THEN p WHEN 3 THEN 100 ELSE 0 END AS known,
        CASE s WHEN 3 THEN 1000 WHEN 5 THEN q * 1000 WHEN 7 THEN q * 1000 + 500 ELSE 0 END AS wait FROM r WHERE s <> 4)
    SELECT store_id, promo_id, barcode, club, coupon, (n * 1000)::BIGINT AS qty_milli, coalesce(a, -1)::BIGINT AS agorot,
           coalesce((2 * a + n) // (2 * n), -1)::BIGINT AS unit_agorot, known::BIGINT AS known_agorot, wait::BIGINT AS unpriced_milli FROM o""")
def promotion_files_to_offers(b: Bridge):
    rows = promotions.offer_rows(xml.parse_promotions(_promotion_texts(b)))
    return rows.select("store_id", "promo_id", "barcode", "club", "coupon", "min_qty", F.coalesce("agorot", F.lit(-1)).alias("agorot"),
                       F.coalesce("unit_agorot", F.lit(-1)).alias("unit_agorot"), "known_agorot",
                       (F.col("unpriced_qty") * 1000).cast("bigint").alias("unpriced_milli"))


@query("flat_price_files", """
    SELECT CAST(s_nationkey AS VARCHAR) AS chainid, CAST(s_suppkey AS VARCHAR) AS storeid, CAST(s_suppkey * 3 + x AS VARCHAR) AS itemcode,
           '1' || x AS itemprice FROM supplier, (SELECT unnest([1, 2]) AS x)""")
def flat_price_files(b: Bridge):
    key = F.col("s_suppkey")
    item = lambda x: _element("item", F.concat(_element("itemcode", key * 3 + x), _element("itemprice", f"1{x}")))
    content = F.concat(F.lit("<root>"), _element("chainid", F.col("s_nationkey")), _element("storeid", key),
                       _element("items", F.concat(item(1), item(2))), F.lit("</root>"))
    texts = b.table("supplier").select(key.cast("string").alias("_file"), content.alias("content"))
    return xml.flat_prices(texts).select("chainid", "storeid", "itemcode", "itemprice")


# --- shards ----------------------------------------------------------------------


@query("shards_by_count", """
    , k AS (SELECT barcode, barcode[1:3] AS a, barcode[1:5] AS b, barcode[1:7] AS c FROM products),
    s AS (SELECT *, count(*) OVER (PARTITION BY a) AS na, count(*) OVER (PARTITION BY b) AS nb FROM k)
    SELECT barcode, CASE WHEN na <= 25 THEN a WHEN nb <= 25 THEN b ELSE c END AS shard FROM s""", ("products",))
def shards_by_count(b: Bridge):
    return shards.by_count(b.products().select("barcode"), levels=(3, 5, 7), max_items=25)


DOCS = """
    , d AS (SELECT barcode, octet_length(encode('{{"n":"' || name || '"}}')) AS n FROM products),
    s AS (SELECT barcode, sum(length(barcode) + n + 4) OVER (PARTITION BY barcode[1:5]) + 1 AS s5,
                 sum(length(barcode) + n + 4) OVER (PARTITION BY barcode[1:3]) + 1 AS s3 FROM d),
    sh AS (SELECT barcode, CASE WHEN s3 <= 900 THEN barcode[1:3] WHEN s5 <= 900 THEN barcode[1:5] ELSE barcode[1:8] END AS shard FROM s)""".replace("{{", "{").replace("}}", "}")


def _sharded(b: Bridge) -> DataFrame:
    docs = b.products().select("barcode", F.to_json(F.struct(F.col("name").alias("n"))).alias("json"))
    return shards.by_bytes(docs, levels=(3, 5, 8), budget=900)


@query("shards_by_bytes", DOCS + "SELECT barcode, shard FROM sh", ("products",))
def shards_by_bytes(b: Bridge):
    return _sharded(b).select("barcode", "shard")


@query("shard_routing", DOCS + "SELECT barcode, shard FROM sh UNION ALL SELECT '1' || barcode, NULL FROM products", ("products",))
def shard_routing(b: Bridge):
    placed = _sharded(b)
    asked = placed.select("barcode").unionByName(placed.select(F.concat(F.lit("1"), "barcode").alias("barcode")))
    return shards.route(asked, placed, (3, 5, 8))


@query("shard_index", DOCS + """
    SELECT count(DISTINCT shard) AS files, string_agg(DISTINCT shard, ',' ORDER BY shard) AS shards, '3,5,8' AS levels, '1998-06-01' AS built_at FROM sh""",
       ("products",))
def shard_index(b: Bridge):
    """The whole index; whether a host takes that many files is asked before publishing (``shards.over_limit``)."""
    out = shards.shard_index(_sharded(b), (3, 5, 8), "1998-06-01", strict=False)
    return out.select("files", F.array_join("shards", ",").alias("shards"),
                      F.array_join(F.col("levels").cast("array<string>"), ",").alias("levels"), "built_at")


# --- streams ---------------------------------------------------------------------


BATCHES = 4


def _events(b: Bridge, root: str) -> DataFrame:
    """All events as a stream of ``BATCHES`` micro-batches in order of time, unordered inside each."""
    events = b.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    width = ((high or 0) - (low or 0)) // BATCHES + 1
    for k in range(BATCHES):
        # Events without a time come first.
        part = events.filter(F.coalesce(F.floor((F.unix_micros("ts") - (low or 0)) / width), F.lit(0)) == k)
        part.repartition(2, F.xxhash64(*events.columns)).sortWithinPartitions(F.xxhash64(*events.columns)).write.mode("append").parquet(f"{root}/feed")
    return b.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/feed")


def _run_folder(b: Bridge, name: str) -> str:
    return f"{shared_dir(b.spark)}/{name}-{uuid.uuid4().hex}"


@query("stream_latest_value", """
    SELECT user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM (SELECT user_id, event_type, max(ts) AS ts, arg_max(value, {'t': ts, 'v': value}) AS value
        FROM events GROUP BY ALL)""")
def stream_latest_value(b: Bridge):
    """Events as a stream; every micro-batch rewrites the buckets of its keys."""
    root, keys = _run_folder(b, "latest"), ["user_id", "event_type"]
    feed = _events(b, root).select(*keys, "ts", "value")
    table = latest.LatestTable(b.spark, f"{root}/table", feed.schema, keys, "ts", buckets=16)
    table.follow(feed, f"{root}/checkpoint").awaitTermination()
    return table.read().select("user_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@query("stream_new_offer_alerts", """
    SELECT user_id || '-' || event_type AS offer_key, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen FROM events GROUP BY 1""")
def stream_new_offer_alerts(b: Bridge):
    """First sight of every key, kept in state until forty days after its last."""
    root = _run_folder(b, "alerts")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = b.spark.conf.get(provider)
    b.spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        feed = _events(b, root).select(F.concat_ws("-", "user_id", "event_type").alias("offer_key"), "ts",
                                 (F.col("ts") + F.expr("interval 40 days")).alias("ends"))
        run = jobs.write_alerts(jobs.announce_new_offers(feed), f"{root}/alerts", f"{root}/checkpoint")
        run.awaitTermination()
    finally:
        b.spark.conf.set(provider, before)
    alerts = b.spark.read.schema("offer_key string, first_seen timestamp, ends timestamp").parquet(f"{root}/alerts")
    return alerts.select("offer_key", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


@query("stream_announce_once", "SELECT DISTINCT user_id || '-' || event_type AS offer_key FROM events")
def stream_announce_once(b: Bridge):
    root = _run_folder(b, "once")
    feed = _events(b, root).select(F.concat_ws("-", "user_id", "event_type").alias("offer_key"), "ts")
    run = jobs.write_alerts(jobs.announce_once(feed), f"{root}/alerts", f"{root}/checkpoint")
    run.awaitTermination()
    return b.spark.read.schema("offer_key string, ts timestamp").parquet(f"{root}/alerts").select("offer_key")
