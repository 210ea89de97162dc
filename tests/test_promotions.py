import gzip

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import offers, promotions
from shelfwise.sources import payload, xml
from tests.conftest import rows

CODE, OTHER, NIL = "7290001", "7290002", "0000000000000"


def item(code, qty="1", price="", rate=""):
    extra = f"<DiscountRate>{rate}</DiscountRate>" if rate else ""
    return (f"<PromotionItem><ItemCode>{code}</ItemCode><MinQty>{qty}</MinQty>"
            f"<DiscountedPrice>{price}</DiscountedPrice>{extra}</PromotionItem>")


def group(*items):
    return f"<Group><PromotionItems>{''.join(items)}</PromotionItems></Group>"


def file(*groups, head="", pid="Id"):
    body = f"<Groups>{''.join(groups)}</Groups>" if groups else ""
    return (f"<Root><Chain{pid}>7290-0001</Chain{pid}><Store{pid}>007</Store{pid}><Promotions><Promotion>"
            f"<Promotion{pid}>0042</Promotion{pid}>{head}{body}</Promotion></Promotions></Root>")


def parse(spark, *texts):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "_file string, content string")
    return promotions.offer_rows(xml.parse_promotions(df))


def terms(spark, text):
    got = parse(spark, text).select("barcode", "min_qty", "agorot", "unit_agorot", "known_agorot", "unpriced_qty").collect()
    return sorted((r[0], float(r[1]), r[2], r[3], r[4], float(r[5])) for r in got)


@pytest.mark.parametrize("groups, expected", [
    # two priced legs are one offer
    ([group(item(CODE, "1", "28.90")), group(item(CODE, "1", "1.00"))], [(CODE, 2.0, 2990, 1495, 2990, 0.0)]),
    # a spending threshold is not a leg; a blank price waits for the shelf
    ([group(item(NIL)), group(item(CODE)), group(item(CODE, "1", "1.00"))], [(CODE, 2.0, None, None, 100, 1.0)]),
    # a gift of another product prices neither
    ([group(item(CODE, "1", "99")), group(item(OTHER, "1", "0"))], []),
    ([group(item(CODE, "1", "29.90"))], [(CODE, 1.0, 2990, 2990, 2990, 0.0)]),
    # buy two get one; the stated prices are ignored, either order
    ([group(item(CODE, "2", "0.02")), group(item(CODE, "1", "0", "100"))], [(CODE, 3.0, None, None, 0, 2.0)]),
    ([group(item(CODE, "1", "0", "100")), group(item(CODE, "1", "14.90"))], [(CODE, 2.0, None, None, 0, 1.0)]),
    # the second at half price
    ([group(item(CODE, "1", "21.90")), group(item(CODE, "1", "10.95", "50"))], [(CODE, 2.0, None, None, 0, 1.5)]),
    # a free leg that states a price is not a gift
    ([group(item(CODE, "1", "9")), group(item(CODE, "1", "4", "100"))], []),
    # a rate means nothing in a single group
    ([group(item(CODE, "1", "9.90", "-49400"))], [(CODE, 1.0, 990, 990, 990, 0.0)]),
    # a weight in one leg drops the row
    ([group(item(CODE, "0.5", "9")), group(item(CODE, "1", "4"))], []),
    # a repeated code in a group keeps its last row
    ([group(item(CODE, "1", "5"), item(CODE, "2", "7")), group(item(CODE, "1", "1"))], [(CODE, 3.0, 800, 267, 800, 0.0)]),
    # only one real leg left: an ordinary promotion
    ([group(item(NIL)), group(item(CODE, "2", "10"))], [(CODE, 2.0, 1000, 500, 1000, 0.0)]),
    # a fractional quantity is a weight: the price is already per kilo
    ([group(item(CODE, "0.01", "2.90"))], [(CODE, 1.0, 290, 290, 290, 0.0)]),
    # baskets, blankets and short codes are not prices
    ([group(item(CODE, "10000", "100"))], []), ([group(item(CODE, "1", "0"))], []), ([group(item("12345", "1", "5"))], []),
    # three legs
    ([group(item(CODE, "1", "5")), group(item(CODE, "1", "4")), group(item(CODE, "1", "3.01"))], [(CODE, 3.0, 1201, 400, 1201, 0.0)]),
])
def test_groups(spark, groups, expected):
    assert terms(spark, file(*groups)) == expected


def test_flat_dialect_and_header_spellings(spark):
    head = ("<MinQty>2</MinQty><DiscountedPrice>1,000.00</DiscountedPrice><ClubID>0=all</ClubID>"
            "<AdditionalIsCupon>true</AdditionalIsCupon><PromotionStartDate>2026-01-02</PromotionStartDate>"
            f"<PromotionEndDateTime>2026-02-03T00:00:00</PromotionEndDateTime><PromotionItems><Item><ItemCode>{CODE}</ItemCode></Item>"
            f"<Item><ItemCode>{OTHER}</ItemCode></Item></PromotionItems>")
    got = parse(spark, file(head=head, pid="ID"), "<broken").select(
        "chain_id", "store_id", "promo_id", "barcode", "club", "coupon", "agorot", F.col("starts").cast("string"), F.col("ends").cast("string"))
    same = ("72900001", "7", "42")
    assert rows(got) == [(*same, CODE, 0, 1, 100000, "2026-01-02", "2026-02-03"), (*same, OTHER, 0, 1, 100000, "2026-01-02", "2026-02-03")]


@pytest.mark.parametrize("club, flag", [("", 0), ("0", 0), ("1=", 1), ("1=friends", 1), ("(1=a)&(3=b)", 1), ("(0", 0)])
def test_club_flag(spark, club, flag):
    df = spark.createDataFrame([(club, None)], "c string, n string")
    assert df.select(promotions.club_flag(F.col("c"), F.col("n"))).first()[0] == flag


def test_nested_clubs_of_any_tag_count_when_the_id_is_blank(spark):
    nested = [None, "", "<ClubId>0</ClubId>", "<ClubId>4</ClubId>", "<Any a='1'>0=all</Any>", "<Any>1</Any><Other/>", "<Any><Deep/></Any>", "4"]
    df = spark.createDataFrame([(None, n) for n in nested], "c string, n string")
    assert [r[0] for r in df.select(promotions.club_flag(F.col("c"), F.col("n"))).collect()] == [0, 0, 0, 1, 0, 1, 0, 0]
    got = parse(spark, file(group(item(CODE, "1", "5")), head="<ClubID></ClubID><Clubs><Yellow>7 &amp; 8</Yellow></Clubs>"), file(group(item(CODE, "1", "5"))))
    assert rows(got, "club") == [(0,), (1,)]


def test_items_below_a_promotion_go_by_any_tag(spark):
    flat = f"<PromotionItems><Thing><ItemCode>{CODE}</ItemCode><Text>a &amp; b</Text></Thing><ItemX><ItemCode> {OTHER} </ItemCode></ItemX></PromotionItems>"
    priced = (f"<PromotionItems><PromotionItem><ItemCode>{CODE}</ItemCode><Text>a &amp; b</Text><MinQty>2</MinQty><DiscountedPrice>9</DiscountedPrice></PromotionItem>"
              "</PromotionItems>")
    terms_of = "<MinQty>3</MinQty><DiscountedPrice>12</DiscountedPrice>"
    assert [t[:3] for t in terms(spark, file(head=terms_of + flat))] == [(CODE, 3.0, 1200), (OTHER, 3.0, 1200)]
    assert [t[:3] for t in terms(spark, file(head=terms_of + priced))] == [(CODE, 2.0, 900)]


STAGED = ("chain_id string, store_id string, barcode string, club int, coupon int, min_qty decimal(10,3), known_agorot long, "
          "unpriced_qty decimal(10,3), promo_id string, description string, starts date, ends date")


def staged(spark, *branches):
    from decimal import Decimal as D

    return spark.createDataFrame(
        [("A", s, CODE, 0, 0, D(q), known, D(w), "p", "d", None, None) for s, q, known, w in branches], STAGED)


def shelf(spark):
    base = spark.createDataFrame([("A", CODE, 1990, 3)], "chain_id string, barcode string, agorot long, store_count long")
    exc = spark.createDataFrame([("A", "2", CODE, 2190)], "chain_id string, store_id string, barcode string, agorot long")
    return base, exc


def test_shelf_price_differs_by_branch(spark):
    base, exc = shelf(spark)
    done = offers.resolve_shelf_offers(staged(spark, ("1", 2, 100, 1), ("2", 2, 100, 1), ("3", 2, 100, 1)), base, exc)
    assert rows(done, "store_id", "agorot") == [("1", 2090), ("2", 2290), ("3", 2090)]
    assert rows(offers.group_resolved(done), "agorot", "unit_agorot") == [(2090, 1045), (2290, 1145)]


def test_reward_weights_and_missing_stock(spark):
    base, exc = shelf(spark)
    done = offers.resolve_shelf_offers(staged(spark, ("2", 2, 0, "1.5")), base, exc)
    assert rows(offers.group_resolved(done), "agorot", "unit_agorot") == [(3285, 1643)]
    none = base.filter("false")
    assert offers.resolve_shelf_offers(staged(spark, ("1", 2, 100, 1)), none, exc).count() == 0


def test_payloads_are_recognised_by_content(spark, tmp_path):
    text = file(group(item(CODE, "1", "5")))
    (tmp_path / "plain.GZ").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "wide").write_bytes(('<?xml version="1.0" encoding="utf-16"?>' + text).encode("utf-16"))
    (tmp_path / "marked.xml").write_bytes(b"\xef\xbb\xbf" + text.encode())
    (tmp_path / "junk.txt").write_bytes(b"not xml")
    texts = payload.sniffed_texts(payload.read_files(spark, str(tmp_path)))
    kinds = {r._file.rsplit("/", 1)[1]: r.kind for r in texts.collect()}
    assert kinds == {"plain.GZ": "gzip", "wide": "xml", "marked.xml": "xml", "junk.txt": "other"}
    good = promotions.offer_rows(xml.parse_promotions(texts.filter("content is not null")))
    assert good.count() == 3


def test_store_records_at_any_depth(spark, tmp_path):
    (tmp_path / "Stores1").write_text(
        "<Root><ChainID>77</ChainID><SubChains><SubChain><SubChainID>9</SubChainID><Stores><Store><StoreID>001</StoreID>"
        "<City>Old</City></Store></Stores></SubChain></SubChains></Root>")
    (tmp_path / "Stores2").write_text(
        '<r xmlns="urn:x"><ChainId>77</ChainId><Wrap><SubChain><SubChainId>9</SubChainId><Deeper><Rec><StoreId>1</StoreId>'
        "<City>New</City><Address>Main 5</Address></Rec><Rec><StoreId>000</StoreId></Rec></Deeper></SubChain></Wrap></r>")
    (tmp_path / "Stores3").write_text("<broken")
    found = payload.latest_branches(payload.store_branches(payload.read_files(spark, str(tmp_path), "Stores*")))
    assert rows(found, "chain_id", "store_id", "subchain_id", "city", "address") == [
        ("77", "0", "9", None, None), ("77", "1", "9", "New", "Main 5")]
