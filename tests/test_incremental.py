import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import incremental, mart
from shelfwise.streaming.latest import LatestTable
from shelfwise.streaming.jobs import merge_latest
from tests.conftest import rows

CHAINS = ["A", "B", "C"]


def sources(spark, prices):
    """``prices``: chain, store, barcode, agorot, at."""
    frame = lambda data, ddl: spark.createDataFrame(data, ddl)
    offered = [(c, s, code, 0, 0, Decimal(1), a - 10, a - 10, Decimal(0), f"p{s}", f"deal {code}", date(2025, 1, 1), date(2030, 1, 1)) for c, s, code, a, _ in prices if a % 3 == 0]
    return mart.Sources(
        prices=frame(prices, "chain_id string, store_id string, barcode string, agorot bigint, at int"),
        stores=frame(sorted({(c, s, f"shop {s}", "T") for c, s, *_ in prices}), "chain_id string, store_id string, store_name string, city string"),
        offers=frame(offered, "chain_id string, store_id string, barcode string, club int, coupon int, min_qty decimal(10,3), agorot bigint, known_agorot bigint, "
                              "unpriced_qty decimal(10,3), promo_id string, description string, starts date, ends date"),
        chains=frame([(c, f"chain {c}") for c in CHAINS], "chain_id string, name string"),
        products=frame([(f"{k}", f"item {k}", "", "", "kilo", "", 0) for k in range(20)],
                       "barcode string, name string, manufacturer string, unit_qty string, unit_of_measure string, quantity string, is_weighted int"),
        product_categories=frame([("1", 5), ("2", 5)], "barcode string, category_id int"), decided_names=frame([("2", "decided")], "barcode string, name string"),
        chain_products=frame([], "chain_id string, barcode string, name string"), order=["at"], today="2025-06-01")


def files_of(spark, prices):
    return spark.createDataFrame([(c, s, f"{s}-{at}", 100 + hash((code, a)) % 1000, f"{code}:{a}") for c, s, code, a, at in prices],
                                 "chain_id string, folder string, path string, size bigint, modified string")


def kinds(spark):
    return spark.createDataFrame([(1, "top", None), (5, "aisle", 1)], "id int, name_he string, parent_id int")


def prices_of(chains, shift=0):
    return [(c, f"s{s}", str(k), 300 + 7 * k + 30 * ((s + k + shift) % 2) + ord(c) % 3, 1) for c in chains for s in range(3) for k in range(12)]


TABLES = [*incremental.CHAIN_TABLES, *incremental.SHARED_TABLES]


def contents(run):
    """Rows of every table, deals by id."""
    found = {}
    for t in TABLES:
        df = run.table(t)
        found[t] = sorted((tuple(sorted(r.asDict(recursive=True).items(), key=lambda kv: kv[0])) for r in df.collect()), key=str)
    found["deals"], found["deal_branches"] = rows(run.deals().select("deal_id", "chain_id", "barcode", "unit_agorot")), rows(run.deal_branches().select("deal_id", "store_id"))
    return found


def test_changed_chain_alone_is_rebuilt_and_equals_a_full_build(spark, tmp_path):
    build = lambda run, data, previous: incremental.build(
        spark, str(tmp_path), run, sources(spark, data), files_of(spark, data), kinds(spark), f"2025-01-0{run[-1]}", previous, ("x",))
    first = build("r1", prices_of("ABC"), None)
    changed = prices_of("A") + prices_of("B", shift=1)[:-5]  # B changes and shrinks, C is gone
    second, full = build("r2", changed, "r1"), build("f2", changed, None)
    assert {c: r["run"] for c, r in second.chains().items()} == {"A": "r1", "B": "r2"}
    assert not (tmp_path / "run=r2" / "chain_prices" / "chain_id=A").exists() and (tmp_path / "run=r2" / "chain_prices" / "chain_id=B").exists()
    assert contents(second) == contents(full)
    ids = [i for i, *_ in contents(second)["deals"]]
    assert ids and sorted(ids) == list(range(1, len(ids) + 1))
    assert {r.chain_id for r in second.table("chain_prices").collect()} == {"A", "B"} == {r.chain_id for r in second.table("chains").collect()}
    meta = {r.key: r.value for r in second.table("meta").collect()}
    assert json.loads(meta["chain_as_of"]) == {"A": "2025-01-01", "B": "2025-01-02"} and json.loads(meta["sources"]) == ["x"]
    counts = json.loads(meta["counts"])
    assert counts["chain_prices"] == second.table("chain_prices").count() and counts["category_counts"] == 2
    assert rows(second.table("category_counts"), "category_id", "count") == [(1, 2), (5, 2)]
    # The first run is whole as before.
    assert {r.chain_id for r in first.table("chain_prices").collect()} == set("ABC")
    # Where nothing changed, no chain is built.
    third = build("r3", changed, "r2")
    assert {c: r["run"] for c, r in third.chains().items()} == {"A": "r1", "B": "r2"} and not (tmp_path / "run=r3" / "chain_prices").exists()
    assert rows(third.deals().select("deal_id", "chain_id", "barcode", "unit_agorot")) == rows(second.deals().select("deal_id", "chain_id", "barcode", "unit_agorot"))
    mart.publish(spark, str(tmp_path), "r2", {})
    assert mart.current_run(spark, str(tmp_path)) == "r2"


def test_broken_off_run_is_written_again_without_leftovers(spark, tmp_path):
    build = lambda chains: incremental.build(spark, str(tmp_path), "r1", sources(spark, prices_of(chains)), files_of(spark, prices_of(chains)), kinds(spark), "2025-01-01")
    build("ABC")
    assert {r.chain_id for r in build("A").table("chain_prices").collect()} == {"A"}


def test_digest_tells_content_not_order(spark):
    data = prices_of("AB")
    digest = lambda d: dict(rows(incremental.file_digests(files_of(spark, d))))
    assert digest(data) == digest(data[::-1])
    other = digest(data[:-1])
    assert other["A"] == digest(data)["A"] and other["B"] != digest(data)["B"]
    twice = digest(data + data[:1])
    assert twice["A"] != digest(data)["A"]


# --- latest rows in buckets --------------------------------------------------------


FEED = "user string, value double, ts timestamp"


def feed(spark, data):
    return spark.createDataFrame(data, "user string, value double, ts int").select("user", "value", F.timestamp_seconds("ts").alias("ts"))


@pytest.fixture
def table(spark, tmp_path):
    return LatestTable(spark, str(tmp_path / "t"), feed(spark, [("", 0.0, 0)]).schema, ["user"], "ts", buckets=8)


def test_a_batch_rewrites_only_the_buckets_of_its_keys(spark, table):
    everyone = [(f"u{k}", float(k), 10) for k in range(200)]
    assert len(table.merge(feed(spark, everyone), 0)) == 8
    one = table.merge(feed(spark, [("u7", 70.0, 20), ("u7", 60.0, 15)]), 1)
    assert len(one) == 1 and sorted(n for n in table.versions().values()) == [0] * 7 + [1]
    late = [("u7", 1.0, 5), ("u8", 9.5, 10), ("u9", 8.0, 10), (None, 1.0, None)]
    assert len(table.merge(feed(spark, late), 2)) <= 4
    want = merge_latest(feed(spark, []).select("user", "value", "ts"), feed(spark, everyone + [("u7", 70.0, 20)] + late), ["user"], "ts")
    assert rows(table.read(), "user", "value", "ts") == rows(want, "user", "value", "ts")
    found = dict(rows(table.read(), "user", "value"))
    assert found["u7"] == 70.0 and found["u8"] == 9.5 and found["u9"] == 9.0 and found[None] == 1.0


def test_a_batch_tried_again_replaces_itself(spark, table):
    table.merge(feed(spark, [("a", 1.0, 1), ("b", 1.0, 1)]), 0)
    table.merge(feed(spark, [("a", 2.0, 2), ("c", 2.0, 2)]), 1)
    before = rows(table.read())
    table.merge(feed(spark, [("a", 2.0, 2), ("c", 2.0, 2)]), 1)
    assert rows(table.read()) == before
    # Seen again with another content, the first try leaves nothing behind.
    table.merge(feed(spark, [("a", 3.0, 3)]), 1)
    assert dict(rows(table.read(), "user", "value")) == {"a": 3.0, "b": 1.0}


def test_vacuum_keeps_what_the_last_batches_need(spark, table):
    for n in range(4):
        table.merge(feed(spark, [(f"u{k}", float(n), n) for k in range(40 if n == 0 else 3)]), n)
    before = rows(table.read())
    assert table.vacuum(keep=2) > 0 and rows(table.read()) == before and table.batches() == [2, 3]
    assert table.vacuum(keep=2) == 0


def test_an_empty_table_reads_as_empty(table):
    assert table.read().count() == 0 and table.batches() == []


def test_rows_of_all_tables_and_chains_are_counted_by_one_job(spark):
    frame = lambda *chains: spark.createDataFrame([(c, k) for k, c in enumerate(chains)], "chain_id string, n int")
    spark.sparkContext.setJobGroup("counted", "")
    try:
        got = incremental._rows_by_chain({"a": frame("1", "1", "2"), "b": frame("2"), "c": frame("3").filter("false")})
        jobs = [spark.sparkContext.statusTracker().getJobInfo(j) for j in spark.sparkContext.statusTracker().getJobIdsForGroup("counted")]
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert got == {("a", "1"): 2, ("a", "2"): 1, ("b", "2"): 1} and incremental._rows_by_chain({}) == {}
    # One job without adaptive stages; a job a stage with them: never one a table.
    assert 1 <= len(jobs) <= 2
