"""The nightly build from files to a published mart, and the streams."""

import datetime

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import identity, offers, promotions, quality, shards
from shelfwise.plans import mart
from shelfwise.session import cut_lineage
from shelfwise.sources import payload, xml
from shelfwise.streaming import jobs
from tests.conftest import rows

CHAIN = "7290000000001"


def write_dumps(folder):
    (folder / "prices").mkdir(parents=True)
    (folder / "promos").mkdir()
    (folder / "stores").mkdir()
    items = {"001": [("7290001", "10.00"), ("7290002", "4.00")], "002": [("7290001", "10.00")], "003": [("7290001", "12.00")]}
    for store, sold in items.items():
        body = "".join(f"<Item><ItemCode>{c}</ItemCode><ItemName>name {c}</ItemName><ItemPrice>{p}</ItemPrice></Item>" for c, p in sold)
        (folder / "prices" / f"PriceFull{CHAIN}-{store}-20260910-0500.xml").write_text(
            f"<Root><ChainID>{CHAIN}</ChainID><StoreID>{store}</StoreID><Items>{body}</Items></Root>")
        promo = ("<Promotion><PromotionID>1</PromotionID><PromotionDescription>two for 15</PromotionDescription><Groups><Group><PromotionItems>"
                 "<PromotionItem><ItemCode>7290001</ItemCode><MinQty>2</MinQty><DiscountedPrice>15</DiscountedPrice></PromotionItem>"
                 "</PromotionItems></Group></Groups></Promotion>"
                 "<Promotion><PromotionID>2</PromotionID><Groups><Group><PromotionItems><PromotionItem><ItemCode>7290001</ItemCode><MinQty>1</MinQty>"
                 "<DiscountedPrice></DiscountedPrice></PromotionItem></PromotionItems></Group><Group><PromotionItems><PromotionItem>"
                 "<ItemCode>7290001</ItemCode><MinQty>1</MinQty><DiscountedPrice>1.00</DiscountedPrice></PromotionItem></PromotionItems></Group></Groups></Promotion>")
        (folder / "promos" / f"PromoFull{CHAIN}-{store}-20260910-0500.xml").write_text(
            f"<Root><ChainID>{CHAIN}</ChainID><StoreID>{store}</StoreID><Promotions>{promo}</Promotions></Root>")
    shops = "".join(f"<Store><StoreID>{s}</StoreID><StoreName>shop {s}</StoreName><City>T</City></Store>" for s in (*items, "004"))
    (folder / "stores" / "Stores1.xml").write_text(
        f"<Root><ChainID>{CHAIN}</ChainID><ChainName>north</ChainName><SubChains><SubChain><Stores>{shops}</Stores></SubChain></SubChains></Root>")


def sources(spark, folder):
    from shelfwise.operators import prices

    observed = prices.price_rows(xml.flat_prices(xml.read_texts(spark, str(folder / "prices"))).withColumnRenamed("_file", "_f"))
    branches = payload.latest_branches(payload.store_branches(payload.read_files(spark, str(folder / "stores"))))
    published = promotions.offer_rows(xml.parse_promotions(xml.read_texts(spark, str(folder / "promos"))))
    nothing = lambda ddl: spark.createDataFrame([], ddl)
    return mart.Sources(
        prices=observed, stores=branches, offers=published, order=["_f"], today="2026-09-10",
        chains=branches.select("chain_id", F.col("chain_name").alias("name")).distinct(),
        products=prices.product_rows(observed, ["_f"]),
        product_categories=spark.createDataFrame([("7290001", 5)], "barcode string, category_id int"),
        decided_names=spark.createDataFrame([("7290002", "decided")], "barcode string, name string"),
        chain_products=nothing("chain_id string, barcode string, name string"))


def test_build_from_files_and_publish(spark, tmp_path):
    write_dumps(tmp_path / "in")
    root = str(tmp_path / "mart")
    tables = mart.build_mart(spark, sources(spark, tmp_path / "in"), save=mart.stage_writer(spark, root, "r1"))
    assert rows(tables["chain_prices"], "barcode", "agorot", "store_count") == [("7290001", 1000, 2), ("7290002", 400, 1)]
    assert rows(tables["price_exceptions"], "store_id", "agorot") == [("3", 1200)]
    assert rows(tables["stores"], "store_id", "priced_items") == [("1", 2), ("2", 1), ("3", 1), ("4", 0)]
    # Shelf plus one shekel is 11.00 at two branches and 13.00 at the third; two for 15 is dearer.
    assert rows(tables["deals"], "unit_agorot", "discount_tenths", "name", "category_id") == [
        (550, 450, "name 7290001", 5), (650, 350, "name 7290001", 5)]
    assert rows(tables["deal_products"], "barcode", "unit_agorot") == [("7290001", 550)]
    assert rows(tables["deal_branches"], "deal_id", "store_id") == [(1, "1"), (1, "2"), (2, "3")]
    assert rows(tables["products"], "barcode", "name") == [("7290001", "name 7290001"), ("7290002", "decided")]
    assert ("decided", "7290002") in rows(tables["product_tokens"], "token", "barcode")
    assert {r.barcode for r in tables["deal_postings"].collect()} == {"7290001"}

    checks = {"orphans": quality.orphan_prices(tables["chain_prices"], tables["products"]),
              "stranded": quality.stranded_offers(tables["promo_offers"], tables["promo_stores"], offers.BUILD_TERMS),
              "units": quality.inconsistent_units(tables["promo_offers"]),
              "bits": offers.branches_without_bit(tables["deal_branches"], tables["store_bits"])}
    mart.publish(spark, root, "r1", checks)
    assert mart.current_run(spark, root) == "r1"
    with pytest.raises(ValueError, match="units"):
        mart.publish(spark, root, "r2", {"units": tables["deals"]})
    assert mart.current_run(spark, root) == "r1"
    counts = mart.manifest({n: tables[n] for n in ("deals", "products")}, "2026-09-10", ["b", "a"])
    assert rows(counts, "table_name", "rows") == [("deals", 2), ("products", 2)]


def test_shard_files_hold_their_documents(spark, tmp_path):
    docs = spark.range(300).select(F.format_string("%06d", F.col("id")).alias("barcode"), F.lit('{"n":1}').alias("json"))
    placed = shards.by_bytes(docs, (3, 6), 500)
    shards.write_shards(placed, str(tmp_path / "out"))
    back = spark.read.schema("barcode string, json string, shard string").json(str(tmp_path / "out"))
    assert rows(back, "shard", "barcode") == rows(placed, "shard", "barcode")
    with pytest.raises(Exception, match="too many"):
        many = spark.range(20_001).select(F.col("id").cast("string").alias("shard"))
        shards.shard_index(many, (3,), "x").collect()


def test_index_beyond_the_limit_is_whole_but_not_published(spark, tmp_path):
    many = spark.range(20_001).select(F.format_string("%05d", F.col("id")).alias("shard"))
    index = shards.shard_index(many, (3,), "x", strict=False)
    one = index.first()
    assert one.files == 20_001 and one.shards == [f"{k:05d}" for k in range(20_001)]
    with pytest.raises(ValueError, match="files"):
        mart.publish(spark, str(tmp_path), "r1", {"files": shards.over_limit(index)})
    mart.publish(spark, str(tmp_path), "r2", {"files": shards.over_limit(shards.shard_index(many.limit(20_000), (3,), "x"))})
    assert mart.current_run(spark, str(tmp_path)) == "r2"


def test_ids_are_stable_and_append_only(spark):
    known = spark.createDataFrame([("A", "old")], "chain_id string, uid string")
    seen = spark.createDataFrame([("A",), ("B",), ("B",)], "chain_id string")
    first = rows(identity.append_ids(known, seen, ["chain_id"], "chain"))
    assert first == rows(identity.append_ids(known, seen, ["chain_id"], "chain"))
    assert first[0] == ("A", "old") and len(first) == 2 and len(first[1][1]) == 36
    again = spark.createDataFrame(first, "chain_id string, uid string")
    assert rows(identity.append_ids(again, seen.filter("chain_id = 'B'"), ["chain_id"], "other")) == first


def test_lineage_is_cut_in_the_shared_folder(spark):
    assert rows(cut_lineage(spark.range(3))) == [(0,), (1,), (2,)]


def test_ingest_reads_each_file_once(spark, tmp_path):
    write_dumps(tmp_path / "in")
    box = tmp_path / "in" / "promos"
    for _ in range(2):
        jobs.ingest_promotions(spark, str(box), str(tmp_path / "table"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "table")).count() == 6
    extra = next(box.iterdir()).read_text().replace("<StoreID>00", "<StoreID>90")
    (box / f"PromoFull{CHAIN}-901-20260911-0500.xml").write_text(extra)
    jobs.ingest_promotions(spark, str(box), str(tmp_path / "table"), str(tmp_path / "check")).awaitTermination()
    table = spark.read.parquet(str(tmp_path / "table"))
    assert table.count() == 8 and table.select("day").distinct().count() == 2


def test_alert_stream_forgets_after_the_end(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    at = lambda d: datetime.datetime(2026, 9, d)
    feed = tmp_path / "feed"
    schema = "offer_key string, ts timestamp, ends timestamp"

    def send(*events):
        spark.createDataFrame([(k, at(t), at(e)) for k, t, e in events], schema).coalesce(1).write.mode("append").parquet(str(feed))
        stream = spark.readStream.schema(schema).parquet(str(feed))
        jobs.write_alerts(jobs.announce_new_offers(stream), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        out = spark.read.schema("offer_key string, first_seen timestamp, ends timestamp").parquet(str(tmp_path / "out"))
        return sorted((r.offer_key, r.first_seen.day) for r in out.collect())

    try:
        assert send(("a", 1, 5), ("b", 1, 20), ("a", 2, 5)) == [("a", 1), ("b", 1)]
        assert send(("b", 3, 21), ("c", 10, 25)) == [("a", 1), ("b", 1), ("c", 10)]   # b is known: no alert
        assert send(("a", 12, 28), ("b", 12, 22)) == [("a", 1), ("a", 12), ("b", 1), ("c", 10)]   # a had ended
    finally:
        spark.conf.set(provider, before)


def test_prepared_sources_have_right_ids_brands_cities_and_names(spark):
    frame = lambda data, ddl: spark.createDataFrame(data, ddl)
    price = "chain_id string, subchain_id string, store_id string, barcode string, agorot bigint, name string, manufacturer string, unit_qty string, " \
            "quantity decimal(10,3), unit_of_measure string, is_weighted int, at int"
    row = lambda chain, sub, store, code, agorot, name, weighed, at: (chain, sub, store, code, agorot, name, "", "kilo", None, "", weighed, at)
    raw = mart.Raw(
        prices=frame([row("1", "1", "5", "7290001", 100, "apple", 1, 1), row("1", "2", "6", "7290001", 120, "red apple", 1, 2),
                      row("9", "1", "5", "7290002", 300, "bread", 0, 3), row("2", "", "7", "7290001", 90, "APPLE", 0, 4), row("2", "", "7", "7290002", 310, "", 0, 5)], price),
        stores=frame([("1", "1", "5", "north", "five", "0070", "a"), ("1", "2", "6", "north", "six", " Old  Town ", "b"), ("9", "1", "5", "wrong", "x", "", ""),
                      ("2", "", "7", None, "seven", "unknown", "c")],
                     "chain_id string, subchain_id string, store_id string, chain_name string, store_name string, city string, address string"),
        offers=frame([("9", "5", "7290002")], "chain_id string, store_id string, barcode string"),
        brands=frame([("1", "002", "North Express")], "chain_id string, sub string, brand_name string"),
        aliases=frame([("9", "1")], "wrong_id string, right_id string"),
        city_codes=frame([("70", "Seventown")], "code string, city_name string"),
        branch_ids=frame([("1", "5", "u5")], "chain_id string, store_id string, branch_uid string"),
        locations=frame([("u5", 32.0, 34.8, "address")], "branch_uid string, lat double, lon double, precision string"),
        display=frame([("2", "Second")], "chain_id string, display_name string"),
        product_categories=frame([], "barcode string, category_id int"), decided_names=frame([], "barcode string, name string"), order=["at"], today="2025-01-01")
    src = mart.prepare(raw)
    assert rows(src.prices, "chain_id", "store_id", "barcode") == [("1", "5", "7290001"), ("1", "5", "7290002"), ("1-002", "6", "7290001"), ("2", "7", "7290001"), ("2", "7", "7290002")]
    assert rows(src.stores, "chain_id", "store_id", "city", "branch_uid", "lat") == [
        ("1", "5", "Seventown", "u5", 32.0), ("1-002", "6", "Old Town", None, None), ("2", "7", "", None, None)]
    assert rows(src.chains, "chain_id", "name") == [("1", "north"), ("1-002", "North Express"), ("2", "Second")]
    assert rows(src.offers, "chain_id") == [("1",)]
    assert rows(src.chain_products, "chain_id", "barcode", "name") == [("1", "7290001", "apple"), ("1-002", "7290001", "red apple"), ("2", "7290001", "APPLE")]
    assert rows(src.products, "barcode", "name") == [("7290001", "APPLE"), ("7290002", "bread")]


def test_stored_tables_are_read_by_column(spark):
    kept = cut_lineage(spark.range(3).selectExpr("id", "id * 2 AS twice", "cast(null AS date) AS day"))
    plan = kept.select("twice")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<twice:bigint>" in plan and "Range" not in plan
    assert rows(kept.select("id", "day")) == [(0, None), (1, None), (2, None)]
