import collections
import math

from pyspark.sql import functions as F

from shelfwise.functions import text as text_functions
from shelfwise.operators import alerts, catalog, categories, names, places, quality, search, shards
from tests.conftest import rows


def test_name_vote_prefers_uncapped_chains_and_marks_ties(spark):
    data = spark.createDataFrame([
        ("cap", "1", "x" * 20, ""), ("cap", "2", "short", ""), ("a", "1", "milk", "m"), ("b", "1", "milk", "m"), ("c", "1", "milk 1l", "z"),
        ("a", "3", "tea", ""), ("b", "3", "tea bags", ""), ("a", "4", "done", "")],
        "chain_id string, barcode string, name string, manufacturer string")
    found = names.candidates(data)
    decided = spark.createDataFrame([("4",)], "barcode string")
    assert rows(names.propose(found, decided), "barcode", "name", "source") == [
        ("1", "milk", "trusted"), ("2", "short", "capping-fallback"), ("3", "tea bags", "trusted/tie-longest")]
    assert rows(names.propose_brand(found)) == [("1", "m")]
    sheet = names.review_rows(names.propose(found, decided), names.propose_brand(found), found)
    assert ("2", "short", "cap: short") in rows(sheet, "barcode", "proposed_name", "candidates")


def test_ladder_is_most_specific_first(spark):
    rules = spark.createDataFrame([
        ("leaf", "d", "c", "l", "", "", "L"), ("pair_override", "d", "o", "", "", "", "O"), ("pair", "d", "c", "", "", "", "P"),
        ("pair", "d", "o", "", "", "", "no"), ("department", "d", "", "", "", "", "D"), ("department", "k", "", "", "", "", "K"),
        ("root", "", "", "", "shop", "", "R"), ("fallback", "", "", "", "", "sale", "F")],
        "level string, dept string, cat string, leaf string, root string, second_level string, slug string")
    data = spark.createDataFrame([
        ("1", "d>c>l", ""), ("2", "d>c>x", ""), ("3", "d>o", ""), ("4", "d>z", ""), ("5", "z>k", ""), ("6", "shop>z", ""), ("7", "z", "sale"),
        ("8", "z>q", ""), ("9", "shop>d>c>l", ""), ("10", "", "")], "barcode string, path string, second_level string")
    roots = spark.createDataFrame([("shop",)], "root string")
    placed = categories.place(categories.split_path(data, roots), rules)
    got = {r.barcode: r.slug for r in placed.collect()}
    assert [got[str(i)] for i in range(1, 11)] == ["L", "P", "O", "D", "K", "R", "F", None, "L", None]


def test_scans_and_pairs(spark):
    products = spark.createDataFrame([("1234567",), ("123456789012",), ("7290001111111",)], "barcode string")
    scans = spark.createDataFrame([("7290001234567",), ("0123456789012",), ("7290001111111",), ("5",)], "raw string")
    assert rows(catalog.resolve_scans(scans, products)) == [
        ("0123456789012", "123456789012"), ("5", None), ("7290001111111", "7290001111111"), ("7290001234567", "1234567")]
    pairs = spark.createDataFrame([("a:1, b:2",), ("junk",), (":3,c:",), ("a:1",)], "value string")
    assert rows(catalog.store_pairs(pairs)) == [("a", "1"), ("b", "2")]


def test_store_filter_without_a_valid_pair_is_no_filter(spark):
    exc = spark.createDataFrame([("A", "1", "x", 5), ("B", "2", "y", 6)], "chain_id string, store_id string, barcode string, agorot bigint")
    pairs = lambda text: catalog.store_pairs(spark.createDataFrame([(text,)], "value string"))
    assert rows(catalog.exceptions_for(exc, pairs(":1,junk"))) == rows(exc)
    assert rows(catalog.exceptions_for(exc, pairs("A:1"))) == [("A", "1", "x", 5)]


def test_codes_are_never_cut(spark):
    long = "729000" + "0" * 3 + "7" * 90
    tries = spark.createDataFrame([(long,)], "c string").select(text_functions.barcode_candidates(F.col("c")).alias("t")).first().t
    assert tries == [long, long[6:], "7" * 90]


def test_a_chain_votes_once(spark):
    seen = [("big", str(s), "1", "wrong") for s in range(5)] + [("a", "1", "1", "right"), ("b", "1", "1", "right")]
    data = spark.createDataFrame([(*r, "") for r in seen], "chain_id string, store_id string, barcode string, name string, manufacturer string")
    found = names.candidates(names.one_per_chain(data))
    assert rows(names.propose(found, data.filter("false")), "name", "votes") == [("right", 2)]


def test_disagreements_do_not_replace_claims(spark):
    products = spark.createDataFrame([("p", "1", "tomato", "kg", "", 1), ("q", "1", "matches", "", "", 0), ("q", "2", "soap", "", "", 0)],
                                     "part string, barcode string, name string, unit_qty string, unit_of_measure string, is_weighted int")
    base = spark.createDataFrame([("p", "A", "1"), ("q", "B", "1"), ("q", "B", "2")], "part string, chain_id string, barcode string")
    claimed = catalog.weighed_products(products, base)
    assert rows(catalog.claim_disagreements(claimed, products, base), "chain_id", "barcode", "name", "is_weighted") == [
        ("A", "1", "tomato", 1), ("B", "1", "matches", 0)]


def test_bm25_equals_the_formula(spark):
    texts = ["red ring", "red red box", "blue box with red lid", "green lid", "blue ring ring", "small bolt"]
    docs = search.index_docs(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "barcode string, name string"))
    query = ["red", "ring", "ring"]
    got = {r.barcode: r.score for r in search.bm25(search.postings(docs), search.corpus_stats(docs), query).collect()}
    words = [t.split() for t in texts]
    mean = sum(map(len, words)) / len(words)
    for i, w in enumerate(words):
        score = 0.0
        for q in query:
            n = sum(q in x for x in words)
            weight = max(math.log((len(words) - n + 0.5) / (n + 0.5)), 1e-6)
            tf = w.count(q)
            score += weight * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
        assert math.isclose(got.get(str(i), 0.0), score, abs_tol=1e-12)


def test_texts_are_cut_once_for_a_ranking_without_an_index(spark, capsys):
    texts = ["red milk red", "milk, MILK bread", "", "a b", "red-bread bread", None, "other words"]
    data = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "barcode string, name string")
    docs, query = search.index_docs(data), ["red", "bread", "bread", "none"]
    posts, stats = search.query_index(docs, query)
    assert rows(posts, "token", "barcode", "tf", "dl") == rows(search.postings(docs).filter("token in ('red', 'bread')"), "token", "barcode", "tf", "dl")
    assert rows(stats) == rows(search.corpus_stats(docs))
    found = search.bm25(posts, stats, query)
    assert rows(found) == rows(search.bm25(search.postings(docs), search.corpus_stats(docs), query))
    found.explain()
    assert "split(" not in capsys.readouterr().out


def test_search_tiers(spark):
    data = [("1", "milk"), ("2", "milk chocolate"), ("3", "chocolate milk bar"), ("4", "chocolate milk"), ("5", "soap"), ("6", "chocolate milk")]
    products = spark.createDataFrame(data, "barcode string, name string")
    summary = spark.createDataFrame([(b, n, 1, c, p, 0) for (b, n), c, p in zip(data, [9, 8, 2, 3, 1, 5], [1, 1, 1, 1, 1, None])],
                                    "barcode string, name string, category_id int, chains int, min_agorot int, on_deal int")
    docs = search.index_docs(products)
    words = search.query_tokens(spark, 'Chocolate  "milk"')
    assert words == ["chocolate", "milk"]
    found = search.tiered_search(docs, search.postings(docs), search.corpus_stats(docs), summary, words)
    assert [(r.barcode, r.tier) for r in found.collect()] == [("4", 0), ("3", 1), ("1", 2), ("2", 2)]


def shards_by_hand(keys, levels, limit, weight, fixed, at=0):
    buckets, out = collections.defaultdict(list), {}
    for k in keys:
        buckets[k[:levels[at]].ljust(levels[at], "0")].append(k)
    for prefix, members in buckets.items():
        if sum(map(weight, members)) + fixed <= limit or at + 1 == len(levels):
            out.update({m: prefix for m in members})
        else:
            out.update(shards_by_hand(members, levels, limit, weight, fixed, at + 1))
    return out


def test_shards_equal_the_recursive_rule(spark):
    keys = [str(i * 7919) for i in range(3000)] + [f"72900{i}" for i in range(2000)]
    data = spark.createDataFrame([(k,) for k in keys], "barcode string")
    got = {r.barcode: r.shard for r in shards.by_count(data, (3, 6, 8), 40).collect()}
    assert got == shards_by_hand(keys, (3, 6, 8), 40, lambda k: 1, 0)
    docs = data.withColumn("json", F.repeat(F.lit("א"), F.length("barcode")))
    placed = shards.by_bytes(docs, (3, 6, 8, 10), 900)
    by_size = {r.barcode: r.shard for r in placed.collect()}
    assert by_size == shards_by_hand(keys, (3, 6, 8, 10), 900, lambda k: len(k) * 3 + 4, 1)
    routed = {r.barcode: r.shard for r in shards.route(data, placed, (3, 6, 8, 10)).collect()}
    assert routed == by_size


def test_sanity_check_equals_brute_force(spark):
    spots = [(f"u{i}", 29.0 + i * 0.37 % 5, 34.0 + i * 0.61 % 2, f"c{i % 3}") for i in range(120)]
    refs = [(29.5 + i * 0.23 % 3.5, 34.3 + i * 0.47 % 1.2, f"c{i % 2}") for i in range(40)]

    def km(a, b, c, d):
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(h))

    expected = {}
    for uid, lat, lon, city in spots:
        near = [km(lat, lon, x, y) for x, y, c in refs if c == city]
        if not (29.3 <= lat <= 33.5 and 34.1 <= lon <= 35.9):
            expected[uid] = None
        elif near and min(near) > 20:
            expected[uid] = round(min(near), 6)
    points = spark.createDataFrame(spots, "branch_uid string, lat double, lon double, city string")
    known = spark.createDataFrame(refs, "lat double, lon double, city string")
    got = {r.branch_uid: r.km and round(r.km, 6) for r in places.sanity_check(points, known).collect()}
    assert got == expected and len(expected) > 20


def test_nearby_ignores_town_centres_and_wide_circles(spark):
    import pytest

    shops = spark.createDataFrame([
        ("A", "1", 32.001, 34.9, "address"), ("A", "2", 32.0, 34.9, "city"), ("A", "3", 32.03, 34.9, "address"), ("A", "4", 32.2, 34.9, "address"), ("A", "5", None, None, None)],
        "chain_id string, store_id string, lat double, lon double, precision string").withColumns(
        {"store_name": F.lit("n"), "city_name": F.lit("c"), "address": F.lit("a")})
    chains = spark.createDataFrame([("A", "chain a")], "chain_id string, name string")
    near = places.nearby(shops, chains, 32.0, 34.9)
    assert [r.store_id for r in near.collect()] == ["1", "3"] and "lat" not in near.columns
    with pytest.raises(ValueError):
        places.nearby(shops, chains, 32.0, 34.9, 15.1)


def test_ledger_refreshes_without_announcing_again(spark):
    day = lambda t: F.lit(t).cast("date")
    live = spark.createDataFrame([("k1", "2026-12-01"), ("k2", None), ("k2", "2026-11-01")], "k string, e string").select("k", F.col("e").cast("date").alias("ends"))
    old = spark.createDataFrame([("k1", "2026-10-01"), ("k3", "2026-09-01"), ("k4", "2026-12-31")], "k string, e string").select(
        "k", F.col("e").cast("date").alias("ends"), day("2026-09-01").alias("first_seen"), day("2026-09-01").alias("last_seen"))
    both = alerts.compare_ledger(live, old, "2026-09-10", ["k"])
    assert rows(both, "k", "outcome") == [("k1", "seen"), ("k2", "new"), ("k3", "absent"), ("k4", "absent")]
    assert {r.k for r in alerts.new_alerts(both, live, ["k"]).collect()} == {"k2"}
    assert alerts.new_alerts(both, live, ["k"], seed=True).count() == 0
    kept = alerts.next_ledger(both, "2026-09-10", ["k"])
    assert rows(kept, "k", F.col("ends").cast("string"), F.col("first_seen").cast("string"), F.col("last_seen").cast("string")) == [
        ("k1", "2026-12-01", "2026-09-01", "2026-09-10"), ("k2", "9999-12-31", "2026-09-10", "2026-09-10"), ("k4", "2026-12-31", "2026-09-01", "2026-09-01")]
    again = alerts.compare_ledger(live, alerts.empty_ledger(old), "2026-09-10", ["k"])
    assert {r.outcome for r in again.collect()} == {"new"}


def test_gates(spark):
    build = spark.createDataFrame([(200_001, "2026-09-10"), (200_000, "2026-09-10"), (300_000, "2026-09-01")], "products int, built_at string")
    got = quality.release_gate(build, "2026-09-05")
    assert rows(got, "accepted", "reason") == [(0, "not newer than the live build"), (0, "too few products"), (1, None)]
    assert rows(quality.failures({"a": build, "b": build.filter("false")})) == [("a", 3)]


def test_address_fill_is_one_to_one(spark):
    ours = spark.createDataFrame([("u1", "רחוב הרצל 5", "חדרה"), ("u2", "בן גוריון 7", ""), ("u3", "ויצמן 1", "חדרה"), ("u4", "ויצמן 1", "נתניה"), ("u5", "unknown", "x")],
                                 "branch_uid string, address string, city string")
    theirs = spark.createDataFrame([("t1", "הרצל5, חדרה", "חדרה", 1.0, 2.0), ("t2", "בן גוריון 7", "חדרה", 3.0, 4.0), ("t3", "ויצמן 1", "חדרה", 5.0, 6.0)],
                                   "id string, address string, city string, lat double, lon double")
    assert rows(places.fill_by_address(ours, theirs), "status", "branch_uid", "their_id") == [
        ("accepted", "u1", "t1"), ("ambiguous", None, None), ("review", "u2", "t2")]
    assert rows(places.ambiguous_addresses(ours, theirs), "side", "id") == [("ours", "u3"), ("ours", "u4"), ("theirs", "t3")]


def test_ledger_in_force_is_the_last_committed(spark, tmp_path):
    schema = "chain_id string, last_seen int"
    path = str(tmp_path / "ledger")
    ledger = lambda *r: spark.createDataFrame(list(r), schema)
    assert rows(alerts.current_ledger(spark, path, schema)) == []
    alerts.commit_delivered(ledger(("A", 1)), ledger(("A", 1)), str(tmp_path / "alerts"), path, "r1")
    ledger(("B", 2)).write.parquet(f"{path}/run=r2")  # written, but the run ended before its mark
    assert rows(alerts.current_ledger(spark, path, schema)) == [("A", 1)]
    alerts.commit_delivered(ledger(("C", 3)), ledger(("C", 3)), str(tmp_path / "alerts"), path, "r3")
    assert rows(alerts.current_ledger(spark, path, schema)) == [("C", 3)]


def test_shards_of_an_earlier_write_go(spark, tmp_path):
    path = str(tmp_path / "shards")
    docs = lambda *names: spark.createDataFrame([(n, "{}") for n in names], "shard string, doc string")
    shards.write_shards(docs("728", "729"), path)
    shards.write_shards(docs("728"), path)
    assert rows(spark.read.json(path), "shard") == [(728,)]


def test_display_order_is_a_column(spark):
    data = spark.createDataFrame([("A", "2", 5, 0), ("A", "1", 9, 0), ("B", "1", 4, 1), ("B", "1", 4, 0)], "chain_id string, barcode string, unit_agorot bigint, club int")
    got = alerts.display_order(data, ["club"]).orderBy("position").collect()
    assert [(r.chain_id, r.barcode, r.club, r.position) for r in got] == [("B", "1", 0, 1), ("B", "1", 1, 2), ("A", "2", 0, 3), ("A", "1", 0, 4)]


def test_alerts_judge_branches_where_pairs_are_made(spark, monkeypatch):
    terms = "chain_id string, barcode string, club int, coupon int, min_qty decimal(10,3), unit_agorot bigint"
    from decimal import Decimal

    key = lambda chain, barcode, unit: (chain, barcode, 0, 0, Decimal(1), unit)
    offers = spark.createDataFrame([
        (*key("A", "7290000000017", 500), 500, None, None), (*key("A", "7290000000017", 400), 400, None, None),
        (*key("B", "7290000000024", 300), 300, None, None)], terms + ", agorot bigint, starts date, ends date")
    links = spark.createDataFrame(
        [(*key("A", "7290000000017", 500), s) for s in ("3", "2", "9")] + [(*key("A", "7290000000017", 400), "7"), (*key("B", "7290000000024", 300), "2")],
        terms + ", store_id string")
    favourites = spark.createDataFrame([(1, "7290000000017"), (1, "7290000000024"), (2, "7290000000017")], "user_id bigint, barcode string")
    shops = spark.createDataFrame([(1, "A", "2"), (1, "A", "3"), (1, "A", "4"), (2, "B", "2")], "user_id bigint, chain_id string, store_id string")
    base = spark.createDataFrame([("A", "7290000000017", 900)], "chain_id string, barcode string, agorot bigint")
    for marks in (1024, 1):  # with one mark every pair passes, and the semi join decides alone
        monkeypatch.setattr(alerts, "MARKS", marks)
        found = alerts.candidate_alerts(favourites, shops, offers, links, base, "2026-09-10")
        assert rows(found, "user_id", "chain_id", "barcode", "unit_agorot", "store_id") == [(1, "A", "7290000000017", 500, "2")]
    # Other branches are dropped by the join that makes the pairs, before any shuffle of them.
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "array_contains(_marks" in line]
    assert joins and all("Join Inner" in line for line in joins)


def test_alerts_of_many_users_are_found_in_rounds(spark, monkeypatch):
    terms = "chain_id string, barcode string, club int, coupon int, min_qty decimal(10,3), unit_agorot bigint"
    codes = ["7290000000017", "7290000000024", "7290000000031"]
    at = lambda f: f.selectExpr("chain_id", "barcode", "0 AS club", "0 AS coupon", "cast(1 AS decimal(10,3)) AS min_qty", "unit_agorot", *[c for c in f.columns if c == "store_id"])
    links = at(spark.createDataFrame([("AB"[k % 2], codes[k % 3], 100 + k, str(s)) for k in range(6) for s in range(k + 2)], "chain_id string, barcode string, unit_agorot bigint, store_id string"))
    offers = links.drop("store_id").distinct().selectExpr("*", "unit_agorot AS agorot", "cast(null AS date) AS starts", "cast(null AS date) AS ends")
    assert offers.columns[:6] == [c.split()[0] for c in terms.split(", ")]
    favourites = spark.createDataFrame([(u, codes[(u + k) % 3]) for u in range(40) for k in range(2)], "user_id bigint, barcode string")
    shops = spark.createDataFrame([(u, c, str(u % 5)) for u in range(40) for c in "AB"], "user_id bigint, chain_id string, store_id string")
    base = spark.createDataFrame([("A", codes[0], 900)], "chain_id string, barcode string, agorot bigint")
    found = lambda: rows(alerts.candidate_alerts(favourites, shops, offers, links, base, "2026-09-10"), "user_id", "chain_id", "barcode", "unit_agorot", "store_id", "implausible")
    at_once, stored, kept = found(), [], alerts.cut_lineage
    monkeypatch.setattr(alerts, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(alerts, "cut_lineage", lambda df: stored.append(df) or kept(df))
    assert found() == at_once and len(at_once) > 40
    assert len(stored) == 3 + alerts.ROUNDS


def test_word_shards_read_their_words_once(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(shards, "cut_lineage", lambda df: kept.append(df) or df.localCheckpoint())
    words = spark.createDataFrame([("milk", "1", 9), ("milky", "2", 9), ("mi", "3", 9), ("x", "4", 9)], "term string, barcode string, chars int")
    found = shards.name_shards(words, (2, 3, 4), 20)
    assert rows(found) == [("mi", "3"), ("milk", "1"), ("milk", "2")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(kept) == 1 and "translate" not in plan
