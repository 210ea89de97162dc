import random

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import money, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit(*values):
    return [F.lit(v) for v in values]


@pytest.mark.parametrize("raw, expected", [('חלב 3% "תנובה"', ["חלב", "תנובה"]), ('תפו"א  אדום', ["תפוא", "אדום"]), ("a bc_1 D-E2", ["bc_1", "e2"]), ("", [])])
def test_tokens(spark, raw, expected):
    assert one(spark, text.tokens(F.lit(raw))) == expected


def test_raw_tokens_cut_at_quotes(spark):
    assert one(spark, text.raw_tokens(F.lit('תפו"א אב אב'))) == ["תפו", "אב"]


def test_term_counts_equal_a_counter(spark):
    rng = random.Random(1)
    words = [rng.choice(["aa", "bb", "cc", "dd"]) for _ in range(50)]
    got = {r["token"]: r["tf"] for r in one(spark, text.term_counts(F.lit(" ".join(words))))}
    assert got == {w: words.count(w) for w in set(words)}
    assert one(spark, text.term_counts(F.lit(""))) == []


def test_name_terms(spark):
    assert sorted(one(spark, text.name_terms(F.lit('ק"ג 12 "x" מלח a1 a1 "קוטג')))) == sorted(['ק"ג', "מלח", "a1"])


@pytest.mark.parametrize("raw, expected", [('"מ""ל"', 'מ"ל'), ('ק"ג', 'ק"ג'), ('a """ b', 'a " b'), ('"', '"')])
def test_unescape(spark, raw, expected):
    assert one(spark, text.unescape_name(F.lit(raw))) == expected


@pytest.mark.parametrize("raw, expected", [
    ("7290001234567", ["7290001234567", "1234567"]), ("7290000001234", ["7290000001234", "0001234", "1234"]), ("0123456789012", ["0123456789012", "123456789012"]),
    ("abc", []), ("12-34", ["1234"])])
def test_barcode_candidates(spark, raw, expected):
    assert one(spark, text.barcode_candidates(F.lit(raw))) == expected


@pytest.mark.parametrize("raw, expected", [
    ("https://i/gs1-products/1062/s/7290001234567-12/7290001234567/a.jpg", "7290001234567"),
    ("https://i/gs1-products/1062/s/7290001234567-12/zzz/a.jpg", "7290001234567"), ("https://i/x.jpg", None)])
def test_image_barcode(spark, raw, expected):
    assert one(spark, text.image_barcode(F.lit(raw))) == expected


def test_url_path(spark):
    raw = "/%D7%A7%D7%98%D7%92%D7%95%D7%A8%D7%99%D7%95%D7%AA/root/dept/my-cheese/p/P_123"
    assert tuple(one(spark, text.url_path(F.lit(raw)))) == ("root>dept", "my cheese")
    assert tuple(one(spark, text.url_path(F.lit("")))) == ("", "")


@pytest.mark.parametrize("address, city, cleaned, rules", [
    ("רח' גולדה מאיר 20", "", "גולדה מאיר 20", ["strip_street_prefix"]),
    ("שד` רוטשילד14", "", "רוטשילד 14", ["normalize_punctuation", "strip_street_prefix"]),
    ("כישור 22, חולון, ישראל", "חולון", "כישור 22", ["drop_trailing_clause"]),
    ("צהל 77 חדרה", "חדרה", "צהל 77", ["drop_duplicate_city"]),
    ("אלונים 1", "אלונים", "אלונים 1", []), ("הרצל 1", "חדרה", "הרצל 1", [])])
def test_clean_address(spark, address, city, cleaned, rules):
    got = one(spark, text.clean_address(*lit(address, city)))
    assert (got["address"], got["rules"]) == (cleaned, rules)


@pytest.mark.parametrize("address, expected", [('הע"ל 7 עמק שרה', 'הע"ל 7'), ("שדרות בן גוריון", None), ("1 אורוגוואי", None)])
def test_street_number(spark, address, expected):
    assert one(spark, text.street_number(F.lit(address))) == expected


def test_attempts_do_not_repeat(spark):
    got = one(spark, text.address_attempts(*lit("רח' הרצל 5 מרכז", "חדרה")))
    assert [(a["stage"], a["query"]) for a in got] == [
        ("cleaned", "הרצל 5 מרכז, חדרה, ישראל"), ("street_number", "הרצל 5, חדרה, ישראל")]
    assert got[1]["rules"] == ["strip_street_prefix", "street_plus_number"]
    assert one(spark, text.address_attempts(*lit("הרצל 5", "חדרה"))) == []


@pytest.mark.parametrize("address, city, expected", [
    ("אבןגבירול157", None, "אבןגבירול 157"), ("רחוב הרצל 5, תל אביב-יפו", "תל אביב - יפו", "הרצל 5"), ('רח\' בן-גוריון 7א.', None, "בן-גוריון 7 א"),
    ("חדרה, הרצל 3", "חדרה", "הרצל 3")])
def test_address_key(spark, address, city, expected):
    assert one(spark, text.address_key(F.lit(address), None if city is None else F.lit(city))) == expected


@pytest.mark.parametrize("raw, expected", [("1,234.50", 123450), ("0.005", 1), ("x", None), ("", None), (" 7 ", 700)])
def test_agorot(spark, raw, expected):
    assert one(spark, money.to_agorot(F.lit(raw))) == expected


@pytest.mark.parametrize("raw, expected", [("1,5", 15.0), ("nan", None), ("inf", None), ("-2.5", -2.5), ("a", None)])
def test_number(spark, raw, expected):
    assert one(spark, text.number(F.lit(raw))) == expected


def test_discounts(spark):
    assert one(spark, money.discount_tenths(*lit(667, 1000))) == 333
    assert one(spark, money.discount_tenths(*lit(1100, 1000))) == -100
    assert one(spark, money.discount_tenths(F.lit(5), F.lit(None).cast("bigint"))) is None
    assert one(spark, money.implausible(*lit(99, 500))) is True and one(spark, money.implausible(*lit(10, 499))) is False


def test_labels_and_units(spark):
    label = lambda *a: one(spark, text.store_label(*[F.lit(x).cast("string") for x in a]))
    assert label("5", None, None) == "סניף 5" and label("5", "N", "70") == "N" and label("5", "N", "T") == "N · T"
    unit = lambda w, u: one(spark, text.display_unit(F.lit(w), F.lit(u).cast("string")))
    assert unit(1, " kg ") == "kg" and unit(0, "kg") is None and unit(1, "לא ידוע") is None and unit(1, "") is None
