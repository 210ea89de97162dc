from pyspark.sql import functions as F

from shelfwise.operators import numbering, prices, spread
from tests.conftest import rows

OBS = "chain_id string, store_id string, barcode string, agorot long, seq int"


def observations(spark):
    return spark.createDataFrame([
        ("A", "1", "111111", 500, 1), ("A", "1", "111111", 450, 2),   # republished: last wins
        ("A", "2", "111111", 500, 1), ("A", "3", "111111", 450, 1), ("A", "4", "111111", 500, 1),
        ("A", "1", "222222", 900, 1), ("A", "2", "222222", 800, 1),   # tie: lower price
        ("B", "1", "111111", 430, 1),
    ], OBS)


def stores(spark):
    return spark.createDataFrame(
        [("A", str(i), "T" if i < 3 else "H") for i in range(1, 6)] + [("B", "1", "T"), ("C", "1", "T")],
        "chain_id string, store_id string, city string")


def test_last_observation_then_mode_then_exceptions(spark):
    latest = prices.latest_prices(observations(spark), ["seq"])
    base = prices.baselines(latest)
    assert rows(base, "chain_id", "barcode", "agorot", "store_count") == [
        ("A", "111111", 450, 2), ("A", "222222", 800, 1), ("B", "111111", 430, 1)]
    assert rows(prices.exceptions(latest, base)) == [
        ("A", "1", "222222", 900), ("A", "2", "111111", 500), ("A", "4", "111111", 500)]


def test_effective_price_covers_stores_that_published_nothing(spark):
    latest = prices.latest_prices(observations(spark), ["seq"])
    base = prices.baselines(latest)
    exc = prices.exceptions(latest, base)
    eff = prices.effective_prices(stores(spark), base, exc)
    got = {(r.chain_id, r.store_id, r.barcode): r.agorot for r in eff.collect()}
    assert len(got) == 5 * 2 + 1
    assert got["A", "5", "111111"] == 450 and got["A", "4", "111111"] == 500
    counted = prices.priced_items(latest, stores(spark))
    assert ("A", "5", 0) in rows(counted, "chain_id", "store_id", "priced_items")
    kept = prices.drop_priceless(stores(spark), base, ["store_id"])
    assert {r.chain_id for r in kept.collect()} == {"A", "B"}


def test_cheapest_without_fan_out_equals_minimum_over_fan_out(spark):
    latest = prices.latest_prices(observations(spark), ["seq"])
    base = prices.baselines(latest)
    exc = prices.exceptions(latest, base)
    shops = stores(spark)
    for keep in (F.lit(True), F.col("store_id").isin("2", "4"), F.col("store_id") == "1"):
        some = shops.filter(keep)
        long = prices.effective_prices(some, base, exc).groupBy("barcode").agg(F.min("agorot"))
        assert rows(long) == rows(prices.cheapest_by_barcode(some, base, exc), "barcode", "cheapest_agorot")


def test_sub_brands_split_only_when_listed(spark):
    brands = spark.createDataFrame([("77", "009", "North")], "chain_id string, sub string, brand_name string")
    data = spark.createDataFrame(
        [("77", "9", "1"), ("77", "10", "2"), ("77", None, "3"), ("88", "009", "4")],
        "chain_id string, subchain_id string, store_id string")
    assert rows(prices.split_chains(data, brands), "store_id", "chain_id") == [
        ("1", "77-009"), ("2", "77"), ("3", "77"), ("4", "88")]


def test_aliases_apply_to_their_own_source(spark):
    aliases = spark.createDataFrame([("X", "000", "99")], "source string, wrong_id string, right_id string")
    data = spark.createDataFrame([("X", "000", "1"), ("Y", "000", "2")], "source string, chain_id string, barcode string")
    assert rows(prices.correct_chain_ids(data, aliases, ["barcode"]), "barcode", "chain_id") == [("1", "99"), ("2", "000")]


def test_raw_rows_are_typed_and_filtered(spark):
    raw = spark.createDataFrame([
        ("7290", "007", "x7290001", "", "1,234.50", "1"), ("7290", "000", "", "123456", "5", "0"),
        ("7290", "1", "12345", "", "5", "0"), ("7290", "1", "123456", "", "0", "0"), ("7290", "1", "123456", "", "n/a", "0"),
        ("", "1", "123456", "", "5", "0"),
    ], "ChainId string, storeid string, itemcode string, item_code string, ItemPrice string, bIsWeighted string")
    assert rows(prices.price_rows(raw), "store_id", "barcode", "agorot", "is_weighted") == [
        ("0", "123456", 500, 0), ("7", "7290001", 123450, 1)]


def test_city_names(spark):
    shops = spark.createDataFrame([("1", "0070"), ("2", " Tel   Aviv "), ("3", "Unknown"), ("4", "0"), ("5", "123"), ("6", None)],
                                  "store_id string, city string")
    codes = spark.createDataFrame([("70", "Ashdod")], "code string, city_name string")
    assert rows(prices.resolve_cities(shops, codes), "store_id", "city_name") == [
        ("1", "Ashdod"), ("2", "Tel Aviv"), ("3", None), ("4", None), ("5", None), ("6", None)]


def test_numbers_do_not_depend_on_ranges(spark):
    data = spark.range(500).select((F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("k"), F.lit(2).alias("v"))
    keys = sorted((r.g, r.k) for r in data.collect())
    expected = [(g, k, [x for x in keys if x[0] == g].index((g, k)) + 1) for g, k in keys]
    skewed = data.filter("k < '3'")
    for ranges, source in ((1, None), (7, None), (40, skewed), (16, data.filter("false"))):
        got = numbering.number_rows(data, ["g"], ["k"], "n", ranges=ranges, sample_from=source)
        assert sorted((r.g, r.k, r.n) for r in got.collect()) == expected
        total = numbering.running_total(data, [], ["k", "g"], "v", "t", ranges=ranges, sample_from=source)
        assert [r.t for r in sorted(total.collect())] != [] and sorted(r.t for r in total.collect()) == list(range(2, 1001, 2))
        assert [r.t for r in sorted(total.collect(), key=lambda r: r.k)] == list(range(2, 1001, 2))
    one = data.limit(1)
    assert numbering.number_rows(one, ["g"], ["k"], "n", start=0).first()["n"] == 0


def test_numbered_rows_are_stored_and_large_groups_summed_by_range(spark, capsys, monkeypatch):
    data = spark.range(600).select((F.col("id") % 7 % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("k"), (F.col("id") % 5).alias("v"))
    numbering.number_rows(data, ["g"], ["k"], "n").explain()
    plan = capsys.readouterr().out
    # No comparison of a row with every edge, and nothing built again by each reader.
    assert "filter(" not in plan and "lambda" not in plan and "Window" not in plan and "hashpartitioning" not in plan
    numbering.running_total(data, ["g"], ["k"], "v", "t").explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and "lambda" not in plan
    whole = rows(numbering.running_total(data, ["g"], ["k"], "v", "t"))
    so_far = {}
    for g, k, v, t in sorted(whole, key=lambda r: r[:2]):
        so_far[g] = so_far.get(g, 0) + v
        assert t == so_far[g]
    monkeypatch.setattr(numbering, "ROWS_OF_A_TASK", 150)  # two of the three groups hold more
    assert rows(numbering.running_total(data, ["g"], ["k"], "v", "t", ranges=5)) == whole


def test_salted_join_equals_plain_join(spark):
    big = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    small = spark.createDataFrame([("hot", 1), ("7", 2)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(spread.spread_join(big, small, ["k"], ["id"], how)) == rows(big.join(small, "k", how))


def test_joins_and_groups_are_sorted_by_a_hash_of_their_keys(spark, capsys):
    left = spark.createDataFrame([("A", str(k % 7) if k % 5 else None, k) for k in range(60)], "chain_id string, barcode string, n bigint")
    right = spark.createDataFrame([("A", str(k), 10 * k) for k in range(5)] + [("A", None, 1)], "chain_id string, barcode string, v bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("inner", "left", "left_semi", "left_anti"):
            mine, plain = spread.hashed_join(left, right, ["chain_id", "barcode"], how), left.join(right, ["chain_id", "barcode"], how)
            assert mine.columns == plain.columns and rows(mine) == rows(plain)
            mine.explain()
            assert "Sort [_key" in capsys.readouterr().out
        # Keys that a join would cast first hash differently, so they are joined plainly.
        wide = right.withColumn("n", F.col("v").cast("int"))
        assert rows(spread.hashed_join(left, wide, ["n"], "left_semi")) == rows(left.join(wide, ["n"], "left_semi")) != []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    best = spread.max_by_order(left, ["chain_id", "barcode"], [F.col("n") % 10, F.col("n")], ["n"])
    assert best.columns == ["chain_id", "barcode", "n"] and best.count() == 8
    best.explain()
    assert "Sort [_key" in capsys.readouterr().out


def test_fan_out_is_not_shuffled_and_both_ways_agree(spark, tmp_path, capsys):
    spark.createDataFrame([(c, f"s{k}", "T") for c in "AB" for k in range(30)] + [("D", "s1", "T")],
                          "chain_id string, store_id string, city string").write.parquet(str(tmp_path / "stores"))
    shops = spark.read.parquet(str(tmp_path / "stores"))
    base = spark.createDataFrame([(c, str(k), 100 + k, 3) for c in "ABC" for k in range(40)], "chain_id string, barcode string, agorot bigint, store_count int")
    exc = spark.createDataFrame([(c, f"s{k}", str(k % 9), 7 + k) for c in "AC" for k in range(0, 40, 3)], "chain_id string, store_id string, barcode string, agorot bigint")
    near = prices.effective_prices(shops, base, exc)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        far = rows(prices.effective_prices(shops, base, exc), "chain_id", "store_id", "city", "barcode", "agorot")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(near, "chain_id", "store_id", "city", "barcode", "agorot") == far and len(far) == 2 * 30 * 40
    near.explain()
    plan = capsys.readouterr().out
    above = plan[:plan.index("Generate")]
    assert "Exchange hash" not in above
