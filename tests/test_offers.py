import datetime
import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import offers
from tests.conftest import rows

TODAY = "2026-09-10"
ROW = ("chain_id string, store_id string, barcode string, club int, coupon int, min_qty decimal(10,3), agorot long, "
       "promo_id string, description string, starts date, ends date")


def day(text):
    return datetime.date.fromisoformat(text) if text else None


def table(spark, *published):
    """(store, barcode, qty, agorot, ends, [starts, text, club, coupon])."""
    out = []
    for i, (store, code, qty, agorot, ends, *rest) in enumerate(published):
        starts, text, club, coupon = (*rest, *(None, "", 0, 0)[len(rest):])
        out.append(("A", store, code, club, coupon, Decimal(str(qty)), agorot, f"p{i}", text, day(starts), day(ends)))
    return spark.createDataFrame(out, ROW)


def mart(spark, published, base=(("X", 1000),)):
    data = table(spark, *published)
    merged, links, everywhere = offers.read_merge(offers.merge_offers(data), offers.offer_links(data), TODAY)
    kept, kept_links = offers.prune_dominated(merged, links)
    prices = spark.createDataFrame([("A", b, p) for b, p in base], "chain_id string, barcode string, agorot long")
    products = spark.createDataFrame([("X", "name x"), ("Y", "name y")], "barcode string, name string")
    own = spark.createDataFrame([("A", "Y", "own y")], "chain_id string, barcode string, name string")
    groups = spark.createDataFrame([("X", 7)], "barcode string, category_id int")
    deals = offers.build_deals(kept, prices, products, own, groups)
    return deals, kept_links, everywhere


def test_dominated_expired_and_repaired(spark):
    deals, links, everywhere = mart(spark, [
        ("1", "X", 1, 900, "2026-12-31"), ("2", "X", 1, 900, "2026-10-31"),   # same terms: branches join
        ("1", "X", 2, 1900, None),                                            # dearer at its only branch
        ("3", "X", 1, 950, None),                                             # dearer, but alone at branch 3
        ("9", "X", 1, 100, "2026-09-09"),                                     # over: branch still counts
        ("1", "Y", "0.01", 290, None),                                        # a weight
    ])
    got = deals.select("barcode", "unit_agorot", F.col("min_qty").cast("int"), "discount_tenths", "name", F.col("ends").cast("string"))
    assert rows(got) == [("X", 900, 1, 100, "name x", "2026-12-31"), ("X", 950, 1, 50, "name x", None), ("Y", 290, 1, None, "own y", None)]
    assert {r.store_id for r in everywhere.collect()} == {"1", "2", "3", "9"}
    assert sorted(r.deal_id for r in deals.collect()) == [1, 2, 3]
    assert {r.store_id for r in links.filter("unit_agorot = 900").collect()} == {"1", "2"}


def test_merge_keeps_widest_dates_and_shortest_text(spark):
    merged = offers.merge_offers(table(
        spark, ("1", "X", 1, 900, "2026-12-31", "2026-02-01", "long text"), ("2", "X", 1, 900, None, "2026-01-01", "text"),
        ("3", "X", 1, 900, "2026-11-30", None, "")))
    got = merged.select(F.col("starts").cast("string"), F.col("ends").cast("string"), "description", "promo_id")
    assert rows(got) == [("2026-01-01", "2026-12-31", "text", "p1")]


def test_club_and_coupon_do_not_compete(spark):
    deals, _, _ = mart(spark, [("1", "X", 1, 900, None), ("1", "X", 1, 800, None, None, "", 1, 0), ("1", "X", 1, 850, None, None, "", 0, 1)])
    assert rows(deals, "unit_agorot") == [(800,), (850,), (900,)]


def test_best_deal_is_the_lowest_unit_price(spark):
    deals, _, _ = mart(spark, [("1", "X", 1, 900, None), ("2", "X", 3, 2400, None), ("3", "X", 1, 1100, None)])
    best = offers.best_deal_per_product(deals)
    assert rows(best, "barcode", "unit_agorot", "discount_tenths", "chains_on_deal") == [("X", 800, 200, 1)]


def test_branch_listing_falls_back_to_its_own_best(spark):
    deals, links, _ = mart(spark, [("1", "X", 1, 800, None), ("2", "X", 1, 900, None), ("3", "X", 1, 1000, None)])
    at = offers.deal_branches(deals, links)
    show = lambda **k: rows(offers.list_chain_deals(deals, at, "A", **k), "unit_agorot")
    assert show() == [(800,)] and show(store_id="2") == [(900,)] and show(store_id="3") == []
    full = offers.list_chain_deals(deals, at, "A")
    assert full.first()["branches_on_deal"] == 1


def test_pages_cover_everything_once(spark):
    deals, _, _ = mart(spark, [("1", f"{i:06d}", 1, 500 + i % 4 * 10, None) for i in range(23)],
                       base=[(f"{i:06d}", 1000) for i in range(23)])
    best = offers.best_deal_per_product(deals).cache()
    seen, cursor = [], None
    while True:
        page = offers.list_deals(best, limit=5, cursor=cursor).collect()
        seen += [(r.discount_tenths, r.deal_id) for r in page[:5]]
        if len(page) <= 5:
            break
        cursor = offers.encode_cursor(page[4].discount_tenths, page[4].deal_id)
    assert len(seen) == 23 and seen == sorted(seen, key=lambda k: (-k[0], k[1]))


@pytest.mark.parametrize("bad", ["", "%%%", offers.encode_cursor(1), offers.encode_cursor("a", 1), offers.encode_cursor(True, 1)])
def test_bad_cursors_are_rejected(bad):
    with pytest.raises(ValueError):
        offers.decode_cursor(bad, int, int)


def test_branch_lists_say_the_shorter_side(spark):
    every = [str(i) for i in range(1, 6)]
    deals, links, everywhere = mart(spark, [
        *[(s, "X", 1, 900, None) for s in every], *[(s, "Y", 1, 500, None) for s in every[:4]],
        *[(s, "Z", 2, 500, None, "2026-10-01") for s in every[:2]]])
    modes = offers.branch_modes(links, everywhere)
    assert rows(modes, "barcode", "mode", "missing_at") == [("X", "all", 0), ("Y", "except", 1), ("Z", "only", 3)]
    entries = offers.promotion_entries(deals, modes, offers.branch_listing(links, everywhere, modes), TODAY)
    got = {r.barcode: r.offer.asDict() for r in entries.collect()}
    assert got["Y"]["x"] == ["5"] and got["Y"]["s"] is None and got["Z"]["s"] == ["1", "2"] and got["X"]["s"] is None
    assert got["Z"]["q"] == 2 and got["Z"]["t"] == 5 and got["Z"]["b"] == "2026-10-01" and got["X"]["q"] is None
    for store in every:
        runs = entries.filter(offers.runs_at(F.lit(store), F.col("offer.s"), F.col("offer.x")))
        assert {r.barcode for r in runs.collect()} == {r.barcode for r in links.filter(F.col("store_id") == store).collect()}


def test_pruning_equals_the_greedy_rule(spark):
    rng = random.Random(5)
    published, groups = [], {}
    for code in range(60):
        for _ in range(rng.randint(1, 6)):
            terms = (rng.randint(1, 3), rng.choice([300, 310, 320, 330]))
            at = {str(rng.randint(1, 5)) for _ in range(rng.randint(1, 4))}
            groups.setdefault(f"{code:06d}", {}).setdefault(terms, set()).update(at)
            published += [(s, f"{code:06d}", terms[0], terms[0] * terms[1], None) for s in at]
    expected = set()
    for code, terms in groups.items():
        covered = set()
        for (qty, unit), at in sorted(terms.items(), key=lambda kv: (kv[0][1], kv[0][0])):
            if not at <= covered:
                expected.add((code, qty, unit))
                covered |= at
    deals, _, _ = mart(spark, published)
    assert {(r.barcode, int(r.min_qty), r.unit_agorot) for r in deals.collect()} == expected


def test_store_bits_include_branches_known_only_from_offers(spark):
    stores = spark.createDataFrame([("A", "10"), ("A", "2")], "chain_id string, store_id string")
    links = spark.createDataFrame([("A", "3"), ("B", "1"), ("A", "2")], "chain_id string, store_id string")
    bits = offers.store_bits(stores, links)
    assert rows(bits, "chain_id", "store_id", "bit") == [("A", "10", 0), ("A", "2", 1), ("A", "3", 2), ("B", "1", 0)]
    assert offers.branches_without_bit(links, bits).count() == 0
    assert rows(offers.branches_without_bit(links, bits.filter("store_id <> '3'"))) == [("A", "3")]


def test_offers_follow_the_branch_to_its_brand(spark):
    data = table(spark, ("1", "X", 1, 900, None), ("2", "X", 1, 900, None))
    stores = spark.createDataFrame([("A-009", "1"), ("A", "2")], "chain_id string, store_id string")
    assert rows(offers.attribute_brands(data, stores), "store_id", "chain_id") == [("1", "A-009"), ("2", "A")]


TERMS_DDL = "chain_id string, barcode string, club int, coupon int, min_qty decimal(10,3), agorot bigint"


def test_live_offers_are_joined_to_their_links_once(spark, capsys):
    one = Decimal("1.000")
    built = spark.createDataFrame([("A", "1", 0, 0, one, 500, 500, "x", None, None), ("A", "2", 0, 0, one, 400, 400, "y", None, None)],
                                  TERMS_DDL + ", unit_agorot bigint, description string, starts date, ends date")
    links = spark.createDataFrame([("A", "1", 0, 0, one, 500, "s1"), ("A", "1", 0, 0, one, 500, "s2")], TERMS_DDL + ", store_id string")
    merged, live, everywhere = offers.read_merge(built, links, "1998-06-01")
    for table in (merged, live, everywhere):
        table.explain()
    assert "Join" not in capsys.readouterr().out
    assert rows(merged, "barcode", "agorot") == [("1", 500)] and rows(live, "store_id") == [("s1",), ("s2",)]
    kept, kept_links = offers.prune_dominated(merged, live)
    kept.explain()
    assert "min(struct" not in capsys.readouterr().out.replace("named_struct", "struct")
    assert rows(kept, "barcode") == [("1",)] and rows(kept_links, "store_id") == [("s1",), ("s2",)]


def test_no_bitmap_is_shuffled(spark, capsys):
    branches = spark.range(3000).select((F.col("id") % 7).alias("deal_id"), F.lit("A").alias("chain_id"), F.col("id").cast("string").alias("store_id"))
    bits = spark.range(40_000).select(F.lit("A").alias("chain_id"), F.col("id").cast("string").alias("store_id"), (F.col("id") * 13).alias("bit"))
    maps = offers.branch_bitmaps(branches, bits)
    sizes = maps.groupBy("deal_id").agg(F.sum(F.bitmap_count("bitmap")).alias("n"))
    sizes.explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning" not in plan[:plan.index("partial_bitmap_construct_agg")]
    assert sorted(r.n for r in sizes.collect()) == [428] * 3 + [429] * 4


def test_known_offers_are_made_once_when_shelf_priced_ones_are_added(spark, capsys):
    ddl = "chain_id string, barcode string, club int, coupon int, min_qty decimal(10,3), agorot bigint, promo_id string, description string, starts date, ends date, store_id string"
    one, on = Decimal("1.000"), datetime.date(2026, 1, 1)
    row = lambda code, agorot, promo, said, store="1": ("A", code, 0, 0, one, agorot, promo, said, on, None, store)
    known = offers.merge_offers(spark.createDataFrame([row("7290001", 500, "9", "long text"), row("7290001", 500, "8", "text"), row("7290002", 300, "7", None)], ddl))
    found = spark.createDataFrame([row("7290001", 500, "1", "a"), row("7290003", 100, "4", "z"), row("7290003", 100, "3", None, "2"), row("7290004", None, "5", "n")], ddl)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = offers.add_new_offers(known, found)
        # The known one keeps its own id and text; a new one has its least id and least text.
        assert got.columns == known.columns and rows(got, "barcode", "agorot", "unit_agorot", "promo_id", "description") == [
            ("7290001", 500, 500, "8", "text"), ("7290002", 300, 300, "7", None), ("7290003", 100, 100, "3", "z"), ("7290004", None, None, "5", "n")]
        got.explain()
        plan = capsys.readouterr().out.partition("Initial Plan")[0]
        assert plan.count("Exchange hashpartitioning") == 2  # one for the groups of each side, none for their meeting
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_steps_leave_no_shuffle_files(spark):
    from shelfwise.session import cut_lineage

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, held = spark.conf.get(key, None), spark._jsc.sc().env().blockManager().diskBlockManager()
    files = lambda: sum(f.getName().startswith("shuffle_") for f in [held.getAllFiles().apply(i) for i in range(held.getAllFiles().length())])
    here = files()
    stored = cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if files() <= here:
            break
        time.sleep(0.1)
    assert files() <= here and stored.count() == 7 and spark.conf.get(key, None) == before
