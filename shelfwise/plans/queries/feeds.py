"""Feeds of files: masked exports, packed branch files, lookups, ingest; and the parts of alerts that keep state."""

from __future__ import annotations

import gzip
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfwise.functions import text
from shelfwise.operators import alerts
from shelfwise.plans.bridge import TODAY, Bridge, ean
from shelfwise.plans.queries.files import _element, _promotion_texts
from shelfwise.plans.queries.places import DATES, KEYS_SQL, LEDGER, LEDGER_KEY, _ledger
from shelfwise.plans.registry import query
from shelfwise.session import shared_dir
from shelfwise.sources import csv, lookups, payload, xml
from shelfwise.streaming import jobs


def _new_folder(b: Bridge, name: str) -> str:
    return f"{shared_dir(b.spark)}/{name}-{uuid.uuid4().hex}"


# --- masked exports ----------------------------------------------------------------


PER_FILE = 50


@query("masked_exports", f"""
    WITH c AS (SELECT p_partkey, p_partkey // {PER_FILE} AS f, CASE WHEN p_partkey % 3 = 0 THEN p_brand || ', Ltd' END AS b,
        CASE WHEN p_size % 11 = 0 THEN '' WHEN p_size % 2 = 0 THEN p_type END AS t FROM part)
    SELECT CAST(p_partkey AS VARCHAR) AS itemcode, coalesce(last_value(b IGNORE NULLS) OVER w, '') AS brand,
        coalesce(last_value(t IGNORE NULLS) OVER w, '') AS kind, CASE WHEN f % 2 = 1 THEN 'x' || p_partkey END AS note
    FROM c WINDOW w AS (PARTITION BY f ORDER BY p_partkey ROWS UNBOUNDED PRECEDING)""")
def masked_exports(b: Bridge):
    """A file per fifty parts, every second one with other columns in another order."""
    root = _new_folder(b, "exports")
    size = F.col("p_size")
    rows = b.table("part").select(
        F.floor(F.col("p_partkey") / PER_FILE).alias("f"), F.col("p_partkey"),
        F.when(F.col("p_partkey") % 3 == 0, F.concat("p_brand", F.lit(", Ltd"))).alias("b"),
        F.when(size % 11 == 0, "''").when(size % 2 == 0, F.col("p_type")).alias("t"), F.concat(F.lit("x"), "p_partkey").alias("note"))
    kinds = [["p_partkey AS ItemCode", "b AS Brand", "t AS Kind"], ["t AS ` KIND`", "p_partkey AS itemcode", "note", "b AS brand"]]
    for k, columns in enumerate(kinds):
        part = rows.filter(F.col("f") % 2 == k).repartition("f").sortWithinPartitions("f", "p_partkey")
        part.selectExpr("f", *columns).write.option("header", True).partitionBy("f").csv(f"{root}/{k}")
    found = csv.read_masked(b.spark, root)
    return found.select("itemcode", "brand", "kind", "note")


# --- packed branch files --------------------------------------------------------------


@F.pandas_udf(T.BinaryType())
def _gzipped(raw: pd.Series) -> pd.Series:
    return raw.map(gzip.compress)


def _branch_files(b: Bridge) -> DataFrame:
    """Files of twenty branches in three shapes and four packings, an older one of each with other names, and broken ones."""
    s = b.table("supplier").select("s_suppkey", "s_nationkey", "s_name")
    key, shape = F.col("s_suppkey"), F.col("s_nationkey") % 3
    versions = s.withColumn("v", F.explode(F.array(F.lit("a"), F.lit("b")))).withColumn("f", F.floor(key / 20))
    name = F.when(F.col("v") == "a", "old").otherwise(F.col("s_name"))
    store = F.concat(F.lit("<Store>"), _element("StoreID", F.concat(F.lit("00"), key.cast("string"))), _element("StoreName", name),
                     F.lit("<Extra><Note>n</Note></Extra>"), _element("City", F.concat(F.lit("City "), F.col("s_nationkey").cast("string"))), F.lit("</Store>"))
    lower = F.replace(F.replace(F.replace(store, F.lit("Store>"), F.lit("store>")), F.lit("StoreID"), F.lit("storeid")), F.lit("StoreName"), F.lit("x:storename"))
    one = F.when(shape == 1, F.concat(F.lit("<SubChain>"), _element("SubChainID", (key % 2).cast("string")), F.lit("<Stores>"), store, F.lit("</Stores></SubChain>"))).when(
        shape == 2, lower).otherwise(store)
    grouped = versions.groupBy("s_nationkey", "f", "v").agg(F.array_join(F.sort_array(F.collect_list(one)), "").alias("body"))
    head = F.concat(_element("ChainID", F.concat(F.lit("72900-"), F.col("s_nationkey").cast("string"))), _element("ChainName", "chain"))
    content = F.when(F.col("s_nationkey") % 3 == 2, F.concat(F.lit('<root xmlns:x="u"><deep><er>'), "body", F.lit("</er></deep>"), head, F.lit("</root>"))).otherwise(
        F.concat(F.lit("<Root>"), head, F.lit("<Stores>"), "body", F.lit("</Stores></Root>")))
    plain = F.encode(content, "UTF-8")
    packing = (F.col("f") + F.col("s_nationkey")) % 4
    packed = F.when(packing == 0, _gzipped(plain)).when(packing == 1, F.concat(F.unhex(F.lit("EFBBBF")), plain)).when(
        packing == 2, F.encode(F.concat(F.lit('<?xml version="1.0" encoding="UTF-16"?>'), content), "UTF-16")).otherwise(plain)
    named = grouped.select(F.concat_ws("-", "v", "s_nationkey", "f").alias("_file"), packed.alias("content"))
    broken = s.filter(key % 10 == 0).select(
        F.concat(F.lit("z-"), key.cast("string")).alias("_file"),
        F.when(key % 20 == 0, F.unhex(F.lit("1F8B00"))).when(key % 30 == 0, F.encode(F.lit("no xml"), "UTF-8")).otherwise(
            F.encode(F.concat(F.lit("<Root><ChainID>72900</ChainID><Store><StoreID>1</StoreID></Store>")), "UTF-8")).alias("content"))
    return named.unionByName(broken)


@query("branches_from_packed_files", """
    SELECT '72900' || s_nationkey AS chain_id, CAST(s_suppkey AS VARCHAR) AS store_id, CASE WHEN s_nationkey % 3 = 1 THEN CAST(s_suppkey % 2 AS VARCHAR) ELSE '' END AS subchain_id,
           'chain' AS chain_name, s_name AS store_name, 'City ' || s_nationkey AS city FROM supplier""")
def branches_from_packed_files(b: Bridge):
    found = payload.latest_branches(payload.store_branches(_branch_files(b)))
    return found.select("chain_id", "store_id", "subchain_id", "chain_name", "store_name", "city")


@query("payload_kinds", """
    SELECT v || '-' || s_nationkey || '-' || s_suppkey // 20 AS file, CASE WHEN (s_suppkey // 20 + s_nationkey) % 4 = 0 THEN 'gzip' ELSE 'xml' END AS kind, 1::BIGINT AS readable
    FROM supplier, (SELECT unnest(['a', 'b']) AS v) GROUP BY ALL
    UNION ALL SELECT 'z-' || s_suppkey, CASE WHEN s_suppkey % 20 = 0 THEN 'unreadable' WHEN s_suppkey % 30 = 0 THEN 'other' ELSE 'xml' END, 0 FROM supplier WHERE s_suppkey % 10 = 0""")
def payload_kinds(b: Bridge):
    return payload.sniffed_texts(_branch_files(b)).select(F.col("_file").alias("file"), "kind", F.col("content").isNotNull().cast("int").alias("readable"))


@query("unknown_tag_paths", """
    SELECT path, sum(n)::BIGINT AS n FROM (
        SELECT unnest(['stores/store/extra', 'stores/store/extra/note', 'stores/subchain/stores/store/extra', 'stores/subchain/stores/store/extra/note',
                       'deep/er/store/extra', 'deep/er/store/extra/note']) AS path, unnest([0, 0, 1, 1, 2, 2]) AS shape, 2 AS n FROM (SELECT 1)) p
    JOIN supplier ON s_nationkey % 3 = shape GROUP BY path""")
def unknown_tag_paths(b: Bridge):
    store = ["storeid", "storename", "city"]
    known = ["chainid", "chainname", "stores/subchain/subchainid", *[f"{at}/{c}" for at in ("stores/store", "stores/subchain/stores/store", "deep/er/store") for c in store]]
    return payload.unknown_paths(_branch_files(b), known)


@query("flat_store_files", """
    SELECT CAST(s_nationkey AS VARCHAR) AS chainid, 'c' AS chainname, CAST(s_suppkey % 3 AS VARCHAR) AS subchainid, CAST(s_suppkey * 2 + x AS VARCHAR) AS storeid,
           s_name AS storename, CASE WHEN x = 1 THEN 'Town' END AS city FROM supplier, (SELECT unnest([0, 1]) AS x)""")
def flat_store_files(b: Bridge):
    key = F.col("s_suppkey")
    store = lambda x: _element("store", F.concat(_element("storeid", key * 2 + x), _element("storename", F.col("s_name")), _element("city", "Town") if x else F.lit("")))
    content = F.concat(F.lit("<root>"), _element("chainid", F.col("s_nationkey")), _element("chainname", "c"), F.lit("<subchains><subchain>"),
                       _element("subchainid", key % 3), F.lit("<stores>"), store(0), store(1), F.lit("</stores></subchain></subchains></root>"))
    texts = b.table("supplier").select(key.cast("string").alias("_file"), content.alias("content"))
    return xml.flat_stores(texts).select("chainid", "chainname", "subchainid", "storeid", "storename", "city")


@query("flat_promotion_files", """
    WITH g AS (SELECT l_orderkey, l_partkey, unnest(CASE l_linenumber WHEN 1 THEN [''] WHEN 2 THEN ['', ''] WHEN 3 THEN ['0', '', ''] WHEN 4 THEN ['', '9']
        WHEN 5 THEN ['', ''] WHEN 6 THEN [] ELSE ['', ''] END) AS extra FROM lineitem)
    SELECT ltrim(l_orderkey || '1', '0') AS promotion, CASE extra WHEN '0' THEN '0000000000000' ELSE '729' || reverse(lpad(CAST(l_partkey AS VARCHAR), 9, '0')) || extra END AS item,
           count(*) AS lines FROM g GROUP BY ALL""")
def flat_promotion_files(b: Bridge):
    rows = xml.flat_promotions(_promotion_texts(b))
    return rows.groupBy(F.regexp_replace("PromotionID", "^0+", "").alias("promotion"), F.col("ItemCode").alias("item")).agg(F.count(F.lit(1)).alias("lines"))


# --- ingest ------------------------------------------------------------------------


@query("stream_ingested_promotions", """
    WITH r AS (SELECT l_orderkey % 28 + 1 AS d, l_orderkey % 10 = 7 AS broken, l_linenumber <> 4 AS offered FROM lineitem)
    SELECT '1998-06-' || lpad(CAST(d AS VARCHAR), 2, '0') AS day, count(*) FILTER (NOT broken AND offered) AS offers, count(*) FILTER (broken) AS unreadable,
           1::BIGINT AS batches_tried_twice, (SELECT count(*) FROM lineitem) AS files_read FROM r GROUP BY d""")
def stream_ingested_promotions(b: Bridge):
    """Promotion files over several micro-batches, every tenth order's broken off; one batch is written twice."""
    root = _new_folder(b, "ingest")
    order = F.col("_file").cast("bigint")
    path = F.format_string("/in/PromoFull7290000000001-%03d-199806%02d-0500.xml", order % 1000, order % 28 + 1)
    content = F.when(order % 10 == 7, F.substring("content", 1, 60)).otherwise(F.col("content"))
    _promotion_texts(b).select(path.alias("_file"), content.alias("content")).repartition(24, "_file", "content").write.parquet(f"{root}/feed")
    ingest = jobs.PromotionIngest(b.spark, f"{root}/offers")
    feed = b.spark.readStream.schema("_file string, content string").option("maxFilesPerTrigger", 8).parquet(f"{root}/feed")

    def twice(batch: DataFrame, number: int) -> None:
        for _ in range(2 if number == 1 else 1):
            ingest.write(batch, number)

    feed.writeStream.foreachBatch(twice).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    one = F.count(F.lit(1))
    offers = b.spark.read.parquet(f"{root}/offers").groupBy(F.col("day").cast("string").alias("day")).agg(one.alias("offers"))
    stamp = F.regexp_extract("_file", r"-(\d{8})-0500", 1)
    lost = ingest.unreadable().groupBy(F.to_date(stamp, "yyyyMMdd").cast("string").alias("day")).agg(one.alias("unreadable"))
    log = ingest.log().agg(F.count_if(F.col("tries") == 2).alias("twice"), F.sum("files").alias("files"))
    none = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return offers.join(lost, "day", "full_outer").select(
        "day", none("offers"), none("unreadable"), log.select("twice").scalar().alias("batches_tried_twice"), log.select("files").scalar().alias("files_read"))


# --- lookup files ------------------------------------------------------------------


def _documents(b: Bridge, name: str, rows: DataFrame) -> str:
    """A folder with one JSON document per row of ``f`` and ``json``."""
    root = _new_folder(b, name)
    rows.repartition("f").write.partitionBy("f").text(root)
    return root


def _map_documents(rows: DataFrame, key: Column, value: Column, field: str, **more: Column) -> DataFrame:
    """Documents of at most fifty keys with a map field."""
    entries = rows.groupBy("f").agg(F.map_from_entries(F.collect_list(F.struct(key.alias("k"), value.alias("v")))).alias(field), F.first("f").alias("_f"))
    return entries.select("f", F.to_json(F.struct(F.col(field), *[c.alias(n) for n, c in more.items()])).alias("json"))


def _numbered_parts(b: Bridge) -> DataFrame:
    return b.table("part").select("p_partkey", "p_name", "p_type", "p_size", F.floor(F.col("p_partkey") / PER_FILE).alias("f"))


@query("branch_ids_from_files", """
    SELECT CAST(s_nationkey AS VARCHAR) AS chain_id, CAST(s_suppkey AS VARCHAR) AS store_id, 'u' || s_suppkey AS branch_uid FROM supplier""")
def branch_ids_from_files(b: Bridge):
    rows = b.table("supplier").select("s_suppkey", "s_nationkey", F.floor(F.col("s_suppkey") / PER_FILE).alias("f"))
    docs = _map_documents(rows, F.concat_ws("|", "s_nationkey", "s_suppkey"), F.concat(F.lit("u"), "s_suppkey"), "ids")
    return lookups.branch_ids(b.spark, _documents(b, "ids", docs))


@query("branch_locations_from_files", """
    SELECT 'u' || s_suppkey AS branch_uid, CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey * 10 ELSE -1 END AS lat10, CASE WHEN s_suppkey % 4 > 0 THEN 'City' END AS city,
           (s_suppkey % 4 > 0)::BIGINT AS resolved FROM supplier""")
def branch_locations_from_files(b: Bridge):
    rows = b.table("supplier").select("s_suppkey", F.floor(F.col("s_suppkey") / PER_FILE).alias("f"))
    point = F.when(F.col("s_suppkey") % 4 > 0, F.struct(F.col("s_suppkey").cast("double").alias("lat"), F.lit(1.5).alias("lon"), F.lit("City").alias("city")))
    entries = rows.withColumn("json", F.concat(F.lit('"u'), "s_suppkey", F.lit('":'), F.coalesce(F.to_json(point), F.lit("null"))))
    docs = entries.groupBy("f").agg(F.concat(F.lit('{"locations":{'), F.array_join(F.collect_list("json"), ","), F.lit("}}")).alias("json"))
    found = lookups.branch_locations(b.spark, _documents(b, "locations", docs))
    return found.select("branch_uid", F.coalesce((F.col("lat") * 10).cast("bigint"), F.lit(-1)).alias("lat10"), "city", F.col("resolved").cast("int").alias("resolved"))


@query("decided_names_from_files", """
    SELECT '729' || reverse(lpad(CAST(p_partkey AS VARCHAR), 9, '0')) AS barcode, p_name AS name FROM part WHERE p_size % 5 > 0""")
def decided_names_from_files(b: Bridge):
    """Every fifth size has an entry without a name."""
    entry = F.struct(F.concat(F.lit(" "), ean("p_partkey")).alias("barcode"), F.when(F.col("p_size") % 5 > 0, F.concat("p_name", F.lit(" "))).otherwise(" ").alias("name"))
    docs = _numbered_parts(b).groupBy("f").agg(F.to_json(F.struct(F.collect_list(entry).alias("products"))).alias("json"))
    return lookups.decided_names(b.spark, _documents(b, "decided", docs))


@query("taxonomy_from_files", """
    SELECT 'chain ' || p_partkey // 50 AS chain, '729' || reverse(lpad(CAST(p_partkey AS VARCHAR), 9, '0')) AS barcode, p_type || '/' || p_size AS path, p_name AS name,
           CASE WHEN p_size % 2 = 0 THEN p_type END AS second_level FROM part""")
def taxonomy_from_files(b: Bridge):
    product = F.struct(F.concat_ws("/", "p_type", "p_size").alias("path"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("second_level"))
    docs = _map_documents(_numbered_parts(b), ean("p_partkey"), product, "products", chain=F.concat(F.lit("chain "), F.col("_f").cast("string")))
    return lookups.taxonomy(b.spark, _documents(b, "taxonomy", docs))


@query("favourites_from_files", """
    SELECT 'barcode' AS kind, CAST(o_orderkey AS VARCHAR) AS a, NULL AS b FROM orders UNION ALL SELECT 'store', CAST(o_custkey AS VARCHAR), o_orderstatus FROM orders""")
def favourites_from_files(b: Bridge):
    """One file per five hundred orders."""
    rows = b.table("orders").withColumn("f", F.floor(F.col("o_orderkey") / 500))
    docs = rows.groupBy("f").agg(F.to_json(F.struct(
        F.collect_list(F.col("o_orderkey").cast("string")).alias("barcodes"),
        F.collect_list(F.array(F.col("o_custkey").cast("string"), "o_orderstatus")).alias("stores"))).alias("json"))
    barcodes, stores = lookups.favourites(b.spark, _documents(b, "favourites", docs))
    return barcodes.select(F.lit("barcode").alias("kind"), F.col("barcode").alias("a"), F.lit(None).cast("string").alias("b")).unionByName(
        stores.select(F.lit("store").alias("kind"), F.col("chain_id").alias("a"), F.col("store_id").alias("b")))


# --- tolerant columns -----------------------------------------------------------------


@query("tolerant_numbers_and_days", """
    SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_orderkey * 4 WHEN 1 THEN 1000004 WHEN 2 THEN -o_orderkey * 4 ELSE -1 END AS quarters,
           CASE WHEN o_orderkey % 4 IN (0, 1) THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders""")
def tolerant_numbers_and_days(b: Bridge):
    key = F.col("o_orderkey")
    words = F.when(key % 5 == 0, F.concat(F.lit(" "), key.cast("string"), F.lit(".0 "))).when(key % 5 == 1, "250,001.00").when(
        key % 5 == 2, F.concat(F.lit("-"), key.cast("string"))).when(key % 5 == 3, "NaN").otherwise("n/a")
    date = F.to_date("o_orderdate").cast("string")
    stamp = F.when(key % 4 == 0, F.concat(date, F.lit("T05:00:00"))).when(key % 4 == 1, F.concat(F.lit(" "), date)).when(key % 4 == 2, "").otherwise("31/12/1998")
    rows = b.table("orders").select("o_orderkey", words.alias("w"), stamp.alias("s"))
    return rows.select("o_orderkey", F.coalesce((text.number(F.col("w")) * 4).cast("bigint"), F.lit(-1)).alias("quarters"), text.day(F.col("s")).alias("day"))


@query("street_numbers", """
    SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'הרצל ' || c_custkey WHEN c_custkey % 4 = 1 THEN 'שדרות בן גוריון ' || c_custkey END AS street FROM customer""")
def street_numbers(b: Bridge):
    key = F.col("c_custkey")
    number = key.cast("string")
    address = (F.when(key % 4 == 0, F.concat(F.lit("הרצל  "), number, F.lit(" כניסה ב דירה 4"))).when(key % 4 == 1, F.concat(F.lit("שדרות בן גוריון "), number, F.lit(", קומה 2")))
               .when(key % 4 == 2, F.lit("הרצל פינת הנביאים")).otherwise(F.concat(F.lit("Main "), number)))
    return b.table("customer").select("c_custkey", text.street_number(address).alias("street"))


# --- alerts that keep state --------------------------------------------------------------


@query("alerts_when_seeding_or_starting_over", LEDGER + f"""
    SELECT 'over' AS how, {KEYS_SQL} FROM live""", ("offers",))
def alerts_when_seeding_or_starting_over(b: Bridge):
    """Seeding announces nothing; an emptied ledger announces every live offer."""
    live, old, compared = _ledger(b)
    seeded = alerts.new_alerts(compared, live, LEDGER_KEY, seed=True)
    again = alerts.compare_ledger(live, alerts.empty_ledger(old), TODAY, LEDGER_KEY)
    tell = lambda rows, how: rows.select(F.lit(how).alias("how"), *LEDGER_KEY)
    return tell(seeded, "seed").unionByName(tell(alerts.new_alerts(again, live, LEDGER_KEY), "over"))


@query("orders_built_today", f"""
    SELECT o_orderkey, (CAST(o_orderdate AS DATE) = DATE '{TODAY}' OR o_orderkey % 50 = 0)::BIGINT AS current FROM orders""")
def orders_built_today(b: Bridge):
    """Orders as marts: what day each was built."""
    built = F.when(F.col("o_orderkey") % 50 == 0, f"{TODAY}T23:59:59+00:00").otherwise(F.to_date("o_orderdate").cast("string"))
    return b.table("orders").select("o_orderkey", alerts.is_current(built, TODAY).cast("int").alias("current"))


@query("ledger_after_delivery", LEDGER + f"""
    , next AS (SELECT * FROM cmp WHERE ends >= DATE '{TODAY}')
    SELECT {KEYS_SQL}, {DATES}, (SELECT count(*) FROM cmp WHERE outcome = 'new') AS delivered FROM next""", ("offers",))
def ledger_after_delivery(b: Bridge):
    """Two runs: the second one's delivery breaks off before its mark, is repeated, and only then in force."""
    root = _new_folder(b, "ledger")
    live, old, compared = _ledger(b)
    at = (f"{root}/alerts", f"{root}/ledger")
    alerts.commit_delivered(old.filter("false"), old, *at, "1")
    after = alerts.next_ledger(compared, TODAY, LEDGER_KEY)
    news = alerts.new_alerts(compared, live, LEDGER_KEY)
    after.limit(1).write.parquet(f"{root}/ledger/run=2")  # what a broken-off run leaves
    schema = old.schema
    alerts.commit_delivered(news, after, *at, "2")
    delivered = b.spark.read.parquet(f"{root}/alerts/run=2").agg(F.count(F.lit(1)).alias("n")).scalar()
    return alerts.current_ledger(b.spark, at[1], schema).withColumn("delivered", delivered)
