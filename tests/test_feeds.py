import gzip
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import prices, quality
from shelfwise.sources import csv, payload
from shelfwise.streaming.jobs import PromotionIngest
from tests.conftest import rows

GOOD = ("<Root><ChainID>1</ChainID><StoreID>2</StoreID><Promotions><Promotion><PromotionID>{0}</PromotionID><Groups><Group><PromotionItems>"
        "<PromotionItem><ItemCode>72900{0}</ItemCode><MinQty>2</MinQty><DiscountedPrice>15</DiscountedPrice></PromotionItem>"
        "</PromotionItems></Group></Groups></Promotion></Promotions></Root>")


def batch(spark, names):
    return spark.createDataFrame([(f"/in/PromoFull1-002-202609{n:02d}-0500.xml", GOOD.format(n) if n % 3 else "<Root><open>") for n in names], "_file string, content string")


def test_replayed_batch_replaces_itself_and_shows_in_the_log(spark, tmp_path):
    ingest = PromotionIngest(spark, str(tmp_path / "offers"))
    assert ingest.log().count() == 0
    ingest.write(batch(spark, [1, 2, 3]), 0)
    ingest.write(batch(spark, [4, 5]), 1)
    before = rows(spark.read.parquet(str(tmp_path / "offers")), "barcode", "day")
    ingest.write(batch(spark, [4, 5]), 1)
    assert rows(spark.read.parquet(str(tmp_path / "offers")), "barcode", "day") == before and len(before) == 4
    assert rows(ingest.log(), "batch", "tries", "files", "offers", "unreadable") == [(0, 1, 3, 2, 1), (1, 2, 2, 2, 0)]
    assert rows(ingest.unreadable(), "batch", "_file") == [(0, "/in/PromoFull1-002-20260903-0500.xml")]
    # A try that broke off after its offers and is repeated with fewer files leaves none of the first.
    ingest.write(batch(spark, [4]), 1)
    assert len(rows(spark.read.parquet(str(tmp_path / "offers")), "barcode")) == 3


def test_masked_files_with_mixed_headers_in_one_read(spark, tmp_path):
    for k in range(60):
        lines = ["A, B ,c", f"a{k},,''", ",b,", ",,c"] if k % 3 else ["﻿C,A", f"c{k},", f',"a,{k}"', "C,A", "", "''"]
        (tmp_path / f"price_{k:02d}.csv").write_text("\n".join(lines))
    (tmp_path / "price_zz.csv").write_text("")
    (tmp_path / "other.csv").write_text("x\n1\n")
    found = csv.read_masked(spark, str(tmp_path), "price_*.csv")
    assert sorted(found.columns) == ["_block", "_file", "_row", "a", "b", "c"]
    one = lambda k: [tuple(r) for r in found.filter(F.col("_file").endswith(f"price_{k:02d}.csv")).orderBy("_block", "_row").select("a", "b", "c").collect()]
    assert one(1) == [("a1", "", ""), ("a1", "b", ""), ("a1", "b", "c")]
    assert one(3) == [("", None, "c3"), ("a,3", None, "c3"), ("a,3", None, "")]
    assert found.count() == 40 * 3 + 20 * 3
    assert csv.read_masked(spark, str(tmp_path), "none_*.csv") is None


def test_headers_take_one_job_whatever_the_number_of_files(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"p_{k}.csv").write_text(f"h{k % 4}\n1\n")
    spark.sparkContext.setJobGroup("heads", "first lines")
    csv.read_masked(spark, str(tmp_path), "p_*.csv")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("heads")
    spark.sparkContext.setJobGroup("", "")
    assert 0 < len(jobs) <= 4  # one query; adaptive execution counts its stages as jobs


def test_branches_at_any_depth():
    inner = "<Store><StoreID>9</StoreID></Store>"
    raw = (f"<Root><A><SubChain><B><Store><StoreID>1</StoreID><Nested>{inner}</Nested></Store></B><SubChainID>7</SubChainID></SubChain>"
           "<SubChain><SubChain><Store><storeid>2</storeid></Store></SubChain><SubChainID>8</SubChainID></SubChain></A>"
           "<Store><StoreID>3</StoreID><City> c </City></Store><ChainID>5</ChainID></Root>")
    assert payload.branches_of(raw.encode()) == [
        ("5", None, "7", "1", None, None, None), ("5", None, "8", "2", None, None, None), ("5", None, "", "3", None, "c", None)]
    with pytest.raises(Exception):
        payload.branches_of(b"<Root><Store><StoreID>1</StoreID></Store>")


def test_walk_keeps_no_tree():
    import tracemalloc

    record = "<Store><StoreID>{0}</StoreID><Long>" + "x" * 2000 + "</Long></Store>"
    raw = ("<Root>" + "".join(record.format(k) for k in range(5000)) + "</Root>").encode()
    tracemalloc.start()
    assert sum(1 for _ in payload.walk(raw)) == 15001
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < len(raw) / 5


def test_unknown_paths_nested_repeated_and_packed(spark):
    texts = [b"<R><Store><StoreID>1</StoreID><New><Deep/><Deep/></New></Store></R>", gzip.compress(b"<x:R xmlns:x='u'><x:Store><x:Other/></x:Store></x:R>"), b"<R><broken>", b""]
    df = spark.createDataFrame([(bytearray(t),) for t in texts], "content binary").repartition(3)
    assert rows(payload.unknown_paths(df, ["store/storeid"])) == [("store/new", 1), ("store/new/deep", 2), ("store/other", 1)]
    assert ("store", 2) in rows(payload.tag_paths(df))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cheapest_rows_equal_the_fan_out(spark, seed):
    rng = random.Random(seed)
    stores = [(c, f"s{k}", "T" if k % 5 else "") for c in "AB" for k in range(6)] + [("C", "s1", "T")]
    base = [(c, str(k), rng.randrange(1, 5) * 100, 3) for c in "ABCD" for k in range(8)]
    # Some items are priced apart at every store, so that nobody charges the chain's price.
    exc = [(c, s, i, a + rng.choice([-50, 50])) for c, i, a, _ in base for d, s, _ in stores if c == d and (int(i) % 4 == 0 or rng.random() < 0.3)]
    shops = spark.createDataFrame(stores, "chain_id string, store_id string, city string").withColumn("store_name", F.lit(""))
    prices_of = spark.createDataFrame(base, "chain_id string, barcode string, agorot bigint, store_count int")
    apart = spark.createDataFrame(exc, "chain_id string, store_id string, barcode string, agorot bigint")
    products = spark.createDataFrame([(str(k), f"n{k}") for k in range(8) if k != 5], "barcode string, name string")
    chains = spark.createDataFrame([("A",), ("B",), ("C",)], "chain_id string")
    every = prices.effective_prices(shops.filter("city <> ''"), prices_of, apart).join(products, "barcode").join(chains, "chain_id")
    for limit in (1, 3, 20, 500):
        want = every.orderBy("agorot", "barcode", "chain_id", "store_id").limit(limit)
        got = quality.live_view(shops, prices_of, apart, products, chains, limit)
        assert rows(got, "name", "barcode", "chain_id", "store_id", "agorot") == rows(want, "name", "barcode", "chain_id", "store_id", "agorot")


def test_readable_and_unreadable_files_come_from_one_parse(spark):
    from shelfwise.sources import xml

    good = "<Root><ChainID>1</ChainID><StoreId>2</StoreId></Root>"
    texts = spark.createDataFrame([("a", good), ("b", good[:20]), ("c", None)], "_file string, content string")
    docs = xml.judged_promotions(texts)
    assert rows(docs, "_file", "readable") == [("a", True), ("b", False), ("c", False)]
    assert rows(docs.filter("not readable"), "_file") == rows(xml.unreadable(texts))
    assert rows(docs.filter("readable"), "_file", "doc.ChainID") == rows(xml.parse_promotions(texts), "_file", "doc.ChainID")
    assert docs._jdf.queryExecution().optimizedPlan().toString().count("from_xml") == 1


def test_a_known_offer_costs_one_call_to_the_state():
    import pandas as pd
    from types import SimpleNamespace
    from shelfwise.streaming.jobs import OfferMemory

    calls, timers = [], []
    held = [None]
    state = SimpleNamespace(get=lambda: calls.append("get") or held[0], exists=lambda: calls.append("exists") or held[0] is not None,
                            update=lambda v: held.__setitem__(0, v))
    memory = OfferMemory()
    memory.init(SimpleNamespace(getValueState=lambda *a: state, registerTimer=timers.append, deleteTimer=timers.remove))
    batch = lambda *pairs: pd.DataFrame({"ts": pd.to_datetime([p[0] for p in pairs]), "ends_ms": [p[1] for p in pairs]})
    first = list(memory.handleInputRows(("k",), iter([batch(("2025-01-02", 5), ("2025-01-01", 9)), batch(("2025-01-03", 7))]), None))
    assert [r.values.tolist() for r in first] == [[["k", pd.Timestamp("2025-01-01"), 9]]] and held == [(9,)] and timers == [9]
    assert list(memory.handleInputRows(("k",), iter([batch(("2025-01-04", 12))]), None)) == [] and held == [(12,)] and timers == [12]
    assert calls == ["get", "get"]


def test_a_bucket_of_offers_costs_one_read_and_one_write_of_the_state():
    import pandas as pd
    from types import SimpleNamespace
    from shelfwise.streaming.jobs import OfferBuckets

    calls, timers, held = [], [], [None]
    state = SimpleNamespace(get=lambda: calls.append("get") or held[0], update=lambda v: calls.append("update") or held.__setitem__(0, v),
                            clear=lambda: calls.append("clear") or held.__setitem__(0, None))
    memory = OfferBuckets()
    memory.init(SimpleNamespace(getValueState=lambda *a: state, registerTimer=timers.append, deleteTimer=timers.remove))
    batch = lambda *r: pd.DataFrame({"offer_key": [x[0] for x in r], "ts": pd.to_datetime([x[1] for x in r]), "ends_ms": [x[2] for x in r]})
    told = lambda frames: sorted((r.offer_key, r.first_seen.day, r.ends_ms) for f in frames for r in f.itertuples())
    many = [(f"k{n:04d}", "2025-01-01", 100 + n) for n in range(1000)]
    assert told(memory.handleInputRows((7,), iter([batch(*many, ("k0003", "2025-01-02", 9)), batch(("k0003", "2024-12-31", 101))]), None)) == [
        (k, 31 if k == "k0003" else 1, e) for k, _, e in many]
    assert calls == ["get", "update"] and timers == [100]
    assert told(memory.handleInputRows((7,), iter([batch(("k0000", "2025-01-03", 5000), ("new", "2025-01-03", 50))]), None)) == [("new", 3, 50)] and timers == [50]
    # The watermark passes: whatever ended goes, the end itself included; what was extended stays known.
    assert list(memory.handleExpiredTimer((7,), SimpleNamespace(getCurrentWatermarkInMs=lambda: 1099), None)) == []
    timers.remove(50)  # Spark removes the timer that went off
    assert timers == [5000]
    assert told(memory.handleInputRows((7,), iter([batch(("k0000", "2025-01-04", 1), ("k0999", "2025-01-04", 6000))]), None)) == [("k0999", 4, 6000)]
    list(memory.handleExpiredTimer((7,), SimpleNamespace(getCurrentWatermarkInMs=lambda: 9000), None))
    assert calls[-1] == "clear" and held == [None] and len(calls) == 10
