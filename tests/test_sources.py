import csv as pycsv
import json

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import spread
from shelfwise.sources import csv, files, lookups, payload, xml
from tests.conftest import rows


def reference_fill(path):
    """The masking rule on one file, row after row."""
    with open(path, newline="", encoding="utf-8") as handle:
        lines = [r for r in pycsv.reader(handle) if r]
    head, carry, out = lines[0], {}, []
    for raw in lines[1:]:
        row = []
        for i, name in enumerate(head):
            cell = raw[i] if i < len(raw) else ""
            carry[name] = carry.get(name, "") if cell == "" else "" if cell == "''" else cell
            row.append(carry[name])
        out.append(tuple(row))
    return out


def test_masked_csv_over_many_splits(spark, tmp_path):
    lines = ["ChainId,StoreId,Price"]
    for i in range(400):
        lines.append(",".join(["7290" if i % 37 == 0 else "", str(i // 9) if i % 9 == 0 else "''" if i % 50 == 7 else "",
                               str(i) if i % 3 else ""]) if i % 11 else f"{i}")
        if i % 40 == 0:
            lines.append("")
    path = tmp_path / "price_full_file_x.csv"
    path.write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        found = csv.find_exports(spark, str(tmp_path), "PRICE_FULL_FILE")
        assert found.select("_block").distinct().count() > 3
        got = [tuple(r) for r in found.orderBy("_file", "_block", "_row").select("chainid", "storeid", "price").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == reference_fill(path)


def test_squashed_names_and_drifting_headers(spark, tmp_path):
    (tmp_path / "storefull_a.csv").write_text("ignored\n1\n")
    (tmp_path / "pricefull_a.csv").write_text("ItemCode,Price\n1,2\n")
    (tmp_path / "pricefull_b.csv").write_text("Price,Name\n3,x\n")
    found = csv.find_exports(spark, str(tmp_path), "PRICE_FULL_FILE")
    assert rows(found, "itemcode", "price", "name") == [("1", "2", None), (None, "3", "x")]
    assert csv.find_exports(spark, str(tmp_path), "STORE_FILE") is None


def described(spark, *names):
    return files.describe_names(spark.createDataFrame([(f"/d/{n}",) for n in names], "path string"))


@pytest.mark.parametrize("name, kind, stamp", [
    ("PriceFull7290000000001-001-20260824-184047.xml", "pricefull", "20260824184047"),
    ("PromoFull7290000000001-001-202608241840.xml", "promofull", "20260824184000"),
    ("Stores7290000000001-000-20260824_0700.xml", "stores", "20260824070000"),
    ("PriceFull729.xml", "pricefull", None), ("readme.txt", None, None)])
def test_names(spark, name, kind, stamp):
    row = described(spark, name).first()
    assert (row.kind, row.stamp) == (kind, stamp)


def test_newer_copies_replace_older_but_ties_and_unknowns_stay(spark):
    names = [f"PriceFull7290000000001-001-20260824-{t}.xml" for t in ("0100", "0200", "0200")]
    who = [("77", "1")] * 3 + [(None, None), ("77", "1"), ("77", "2")]
    names[2] = names[2].replace("-001-", "-01-")
    names += ["PriceFull7290000000001-001-20200101-0100.xml", "PriceFullx.xml", "PriceFull7290000000001-002-20200101-0100.xml"]
    data = spark.createDataFrame([(f"/d/{n}", *w) for n, w in zip(names, who)], "path string, chain_id string, store_id string")
    kept = {r.name for r in files.newest_per_branch(files.describe_names(data)).collect()}
    assert kept == set(names[1:])


def test_newest_per_name_keeps_one_and_misfits(spark):
    data = described(spark, "Stores1-000-20260824-0700.xml", "Stores1-000-20260825-0100.xml", "Stores1-001-20260824-0700.xml", "odd.xml")
    assert {r.name for r in files.newest_per_name(data).collect()} == {
        "Stores1-000-20260825-0100.xml", "Stores1-001-20260824-0700.xml", "odd.xml"}


def test_quarantine_gives_reasons(spark):
    good, bad = files.quarantine(described(spark, "PromoFull0000000000000-00-1-202411010501.xml",
                                           "PromoFull7290000000001-001-20260824-1840.xml", "x.xml"))
    assert good.count() == 1
    assert {r.name[:6]: r.reason for r in bad.collect()} == {"PromoF": "unexpected fields", "x.xml": "no file kind"}


def test_latest_day_reaches_back_and_says_so(spark):
    data = spark.createDataFrame(
        [("a", "2026-09-10", "price"), ("a", "2026-09-09", "pricefull"), ("b", "2026-09-10", "stores"), ("b", "2026-09-09", "stores"),
         ("c", "2026-09-01", "stores")], "source string, d string, kind string").withColumn("day", F.to_date("d"))
    got = files.latest_day(data, "2026-09-10")
    assert rows(got, "source", "d", "as_of") == [("a", "2026-09-09", "2026-09-09T12:00:00+00:00"), ("b", "2026-09-10", None)]


def test_backfill_takes_the_newest_usable_part(spark):
    history = spark.createDataFrame([("A", "3", False), ("A", "9", True), ("B", "9", False), ("A", "2", False)],
                                    "chain string, built_at string, expired boolean")
    notes = spark.createDataFrame([("B", "8"), ("A", "1")], "chain string, as_of string")
    assert rows(files.backfill(history, notes, run="9"), "chain", "built_at", "as_of") == [("A", "3", "3"), ("B", "9", "8")]


def test_lookup_files(spark, tmp_path):
    ids = tmp_path / "ids.json"
    ids.write_text(json.dumps({"ids": {"77|1": "u1"}}))
    assert rows(lookups.branch_ids(spark, str(ids))) == [("77", "1", "u1")]
    assert lookups.json_map(spark, str(tmp_path / "none.json"), "ids").count() == 0
    spots = tmp_path / "spots.json"
    spots.write_text(json.dumps({"locations": {"u1": {"lat": 1.0, "lon": 2.0, "precision": "city"}, "u2": None}}))
    assert rows(lookups.branch_locations(spark, str(spots)), "branch_uid", "lat", "resolved") == [("u1", 1.0, True), ("u2", None, False)]
    names = tmp_path / "names.json"
    names.write_text(json.dumps({"note": "x", "products": [{"barcode": 12, "name": " n "}, "junk", {"barcode": "", "name": "n"}, {"name": "n"}]}))
    assert rows(lookups.decided_names(spark, str(names))) == [("12", "n")]
    names.write_text(json.dumps(["no"]))
    with pytest.raises(Exception, match="products array"):
        lookups.decided_names(spark, str(names)).collect()
    fav = tmp_path / "fav.json"
    fav.write_text(json.dumps({"barcodes": ["1"], "stores": [["A", "2"]]}))
    codes, shops = lookups.favourites(spark, str(fav))
    assert rows(codes) == [("1",)] and rows(shops) == [("A", "2")]
    tax = tmp_path / "tax.json"
    tax.write_text(json.dumps({"chain": "one", "products": {"5": {"path": "a>b", "name": "n"}}}))
    assert rows(lookups.taxonomy(spark, str(tax))) == [("one", "5", "a>b", "n", None)]
    tsv = tmp_path / "c.tsv"
    tsv.write_text("111\t7\tone\n")
    assert rows(lookups.product_categories(spark, str(tsv))) == [("111", 7, "one")]
    snap = tmp_path / "snap.json"
    snap.write_text(json.dumps({"stores": {"i": {"_id": "i", "location": [34.5, 31.5], "city": " T "}}}))
    assert rows(lookups.snapshot_stores(spark, str(snap)), "id", "lat", "lon", "city") == [("i", 31.5, 34.5, "T")]


def test_flat_files(spark):
    text = ("<root><ChainID>77</ChainID><STOREID>1</STOREID><Items><Item><ItemCode>1</ItemCode><NewTag>x</NewTag></Item>"
            "<Item><ItemCode>2</ItemCode></Item></Items></root>")
    texts = spark.createDataFrame([("f", text)], "_file string, content string")
    assert rows(xml.flat_prices(texts), "chainid", "storeid", "itemcode") == [("77", "1", "1"), ("77", "1", "2")]
    assert rows(xml.unknown_columns(texts, "item", xml.PRICE_FIELDS)) == [("newtag", 1)]
    shops = ("<root><chainid>77</chainid><subchains><subchain><subchainid>1</subchainid><stores><store><storeid>5</storeid>"
             "<city>T</city></store></stores></subchain></subchains></root>")
    texts = spark.createDataFrame([("f", shops)], "_file string, content string")
    assert rows(xml.flat_stores(texts), "chainid", "subchainid", "storeid", "city") == [("77", "1", "5", "T")]
    head = "<r><ChainId>7-7</ChainId><x:StoreID xmlns:x='u'>005</x:StoreID><Items/></r>"
    assert rows(files.header_identity(spark.createDataFrame([("p", head), ("q", shops)], "_file string, content string"))) == [
        ("p", "77", "5"), ("q", None, None)]


def test_headers_travel_as_numbers_and_are_looked_for_once(spark, tmp_path, capsys, monkeypatch):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text("a,b\n1,\n,2\n" if k else "B,c\n3,4\n")
    monkeypatch.setattr(csv, "lookup_join", lambda big, small, on, by, how, *ways: spread.spread_join(big, small, on, by, how, *ways))
    found = csv.read_masked(spark, str(tmp_path))
    found.explain()
    plan = capsys.readouterr().out
    assert "min(" not in plan and ",62" not in plan.replace(" ", "")
    assert sorted((r.a or "", r.b, r.c or "") for r in found.collect()) == [("", "3", "4"), ("1", "", ""), ("1", "", ""), ("1", "2", ""), ("1", "2", "")]


def test_branch_files_are_parsed_over_all_partitions_in_large_frames(spark, monkeypatch):
    one = lambda k: f"<Root><ChainID>72</ChainID><Store><StoreID>{k}</StoreID></Store></Root>".encode()
    files = spark.createDataFrame([(f"f{k}", one(k) if k % 5 else b"<Root>") for k in range(40)], "_file string, content binary").coalesce(1)
    found = payload.store_branches(files)
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(int(r.store_id) for r in found.collect()) == [k for k in range(40) if k % 5]
