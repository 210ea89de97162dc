import json

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import documents, offers, shards
from tests.conftest import rows


def exceptions(spark):
    """One item that a thousand stores price apart, one with a single store, and names that need escapes."""
    many = spark.range(1000).select(F.lit("A").alias("chain_id"), F.format_string("%04d", "id").alias("store_id"), F.lit("7290001").alias("barcode"),
                                    (F.col("id") % 7 * 50 + 100).alias("agorot"))
    few = spark.createDataFrame([("B", "1", "7290001", 1999), ("B", 'a"b', "7290002", 500), ("A", "é", "7290002", 5)],
                                "chain_id string, store_id string, barcode string, agorot bigint")
    return many.unionByName(few)


@pytest.mark.parametrize("budget", [50, 1000, 1_000_000])
def test_parts_hold_every_store_once_in_one_shape(spark, budget):
    found = documents.detail_documents(exceptions(spark), budget).collect()
    seen = [(d.barcode, c, s, p) for d in found for c, pairs in json.loads(d.json).items() for s, p in pairs]
    want = [(r.barcode, r.chain_id, r.store_id, r.agorot / 100) for r in exceptions(spark).collect()]
    assert sorted(seen) == sorted(want)
    for code in ("7290001", "7290002"):
        assert sorted(d.part for d in found if d.barcode == code) == list(range(1, 1 + sum(d.barcode == code for d in found)))
    # The text before the last entry of a part is within the budget.
    assert all(len(d.json.encode()) < budget + 80 + 10 * len(json.loads(d.json)) for d in found)
    if budget == 1_000_000:
        assert len(found) == 2


def test_stores_stay_in_order_over_parts(spark):
    found = documents.detail_documents(exceptions(spark), 300).filter("barcode = '7290001'").orderBy("part").collect()
    order = [s for d in found for s, _ in json.loads(d.json).get("A", [])]
    assert order == sorted(order) and len(order) == 1000


def test_files_hold_every_part_and_keep_the_budget(spark):
    docs = documents.detail_documents(exceptions(spark), 300)
    found = documents.files(docs, (3, 7), 2000).collect()
    texts = {}
    for f in found:
        texts.update(json.loads(f.text))
    assert texts == {d.barcode if d.part == 1 else f"{d.barcode}/{d.part}": json.loads(d.json) for d in docs.collect()}
    assert max(len(f.text.encode()) for f in found) < 2000 + 400 and {f.shard for f in found} == {"7290001", "7290002"}


def test_written_again_with_fewer_products_old_files_go(spark, tmp_path):
    docs = documents.detail_documents(exceptions(spark), 300)
    for some in (docs, docs.filter("barcode = '7290002'")):
        documents.write_files(documents.files(some, (3, 7), 2000), str(tmp_path))
    back = spark.read.text(str(tmp_path))
    assert [json.loads(r.value) for r in back.collect()] == [{"7290002": {"A": [["é", 0.05]], "B": [['a"b', 5]]}}]


def test_offer_keys_that_say_nothing_are_left_out(spark):
    schema = ("chain_id string, barcode string, club int, coupon int, min_qty decimal(10,3), unit_agorot bigint, agorot bigint, description string, "
              "starts date, ends date")
    from datetime import date
    from decimal import Decimal

    kept = spark.createDataFrame([
        ("A", "1", 0, 0, Decimal(1), 990, 990, None, None, None),
        ("A", "1", 1, 0, Decimal("2.5"), 400, 1000, 'two "and" half', date(2030, 1, 2), date(2031, 1, 1)),
        ("B", "1", 0, 1, Decimal(2), 100, 200, "d", date(2020, 1, 1), date(2031, 1, 1))], schema)
    links = kept.select(*offers.READ_TERMS, F.explode(F.when(F.col("chain_id") == "B", F.array(F.lit("s1"), F.lit("s2"), F.lit("s3"))).otherwise(
        F.when(F.col("club") == 1, F.array(F.lit("s1"))).otherwise(F.array(F.lit("s1"), F.lit("s2"))))).alias("store_id"))
    everywhere = spark.createDataFrame([("A", "s1"), ("A", "s2"), ("B", "s1"), ("B", "s2"), ("B", "s3"), ("B", "s4")], "chain_id string, store_id string")
    modes = offers.branch_modes(links, everywhere)
    entries = offers.promotion_entries(kept, modes, offers.branch_listing(links, everywhere, modes), "2025-01-01")
    [doc] = documents.promotions_for(spark.createDataFrame([("1",), ("1",), ("9",), (None,)], "barcode string"), entries).collect()
    assert json.loads(doc.json) == {
        "A": [{"u": 9.9, "d": "", "e": ""},
              {"u": 4, "d": 'two "and" half', "e": "2031-01-01", "q": 2.5, "t": 10, "c": 1, "b": "2030-01-02", "s": ["s1"]}],
        "B": [{"u": 1, "d": "d", "e": "2031-01-01", "q": 2, "t": 2, "k": 1, "x": ["s4"]}]}
    assert documents.promotions_for(spark.createDataFrame([("9",)], "barcode string"), entries).count() == 0


def test_word_files_limit_rows_per_word_by_chains(spark):
    products = spark.createDataFrame([(str(k), "milk " + "x" * k, k % 2) for k in range(1, 8)] + [("8", "12 'q", 0), ("9", None, 0)],
                                     "barcode string, name string, is_weighted int")
    base = spark.createDataFrame([(c, str(k)) for k in range(1, 8) for c in "ABCDEFG"[:k]], "chain_id string, barcode string")
    found = {r.shard: json.loads(r.text) for r in documents.name_files(products, base, per_term=3, share=2.0).collect()}
    assert [r[0] for r in found["mi"]] == ["5", "6", "7"] and found["mi"][0] == ["5", "milk xxxxx", 1]
    assert sorted(found) == ["mi", "xx"]


def test_index_and_meta(spark):
    products = spark.createDataFrame([(f"{k:05d}",) for k in range(30)], "barcode string")
    chains = spark.createDataFrame([("A", 'The "A"'), ("B", None)], "chain_id string, name string")
    as_of = spark.createDataFrame([("A", "2025-01-01")], "chain_id string, as_of string")
    promo = spark.createDataFrame([("00001",), ("00001",), ("00002",)], "barcode string")
    one = documents.catalog_index(products, chains, as_of, promo, "2025-01-02", F.lit(7), (3, 4), 15).first()
    assert one.files == 3 + 7 + 5
    assert json.loads(one.json) == {
        "levels": [3, 4], "shards": ["0000", "0001", "0002"], "chains": {"A": 'The "A"', "B": ""}, "built_at": "2025-01-02",
        "chain_as_of": {"A": "2025-01-01"}, "products": 30, "promo_products": 2}
    with pytest.raises(Exception, match="exceed the limit"):
        documents.catalog_index(products, chains, as_of, promo, "", F.lit(20_000), (3, 4), 15).collect()
    whole = documents.catalog_index(products, chains, as_of, promo, "", F.lit(20_000), (3, 4), 15, strict=False)
    assert whole.first().files == 20_008 and json.loads(whole.first().json)["shards"] == ["0000", "0001", "0002"]
    assert [r.files for r in shards.over_limit(whole).collect()] == [20_008]
    stores = spark.createDataFrame([(c, str(k), None, "Town", k) for c in "AB" for k in range(50)],
                                   "chain_id string, store_id string, store_name string, city string, priced_items bigint")
    found = [json.loads(r.json) for r in documents.meta_documents(products, promo, chains, as_of, stores, "2025-01-02", 300).collect()]
    assert len(found) > 3 and all(d["products"] == 30 and d["promo_products"] == 2 for d in found)
    merged = {}
    for d in found:
        for c, own in d["stores"].items():
            merged.setdefault(c, {}).update(own)
    assert merged == {c: {str(k): ["", "Town", k] for k in range(50)} for c in "AB"}
    sides = documents.store_documents(stores, 300)
    assert rows(sides.groupBy("chain_id").count()) == rows(spark.createDataFrame([(c, sides.filter(F.col("chain_id") == c).count()) for c in "AB"], "chain_id string, count bigint"))
