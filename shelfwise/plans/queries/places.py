"""Places, identities, alerts and ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import money, text
from shelfwise.operators import alerts, identity, offers, places
from shelfwise.plans.bridge import TODAY, Bridge
from shelfwise.plans.registry import query

HAVERSINE = """12742.0 * asin(sqrt(least(1.0, pow(sin(radians({b}.lat - {a}.lat) / 2), 2)
    + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))"""


# --- nearby ----------------------------------------------------------------------


@query("nearby_stores", f"""
    , o AS (SELECT 31.5::DOUBLE AS lat, 34.9::DOUBLE AS lon)
    SELECT s.chain_id, s.store_id, lower(s.chain_id) AS chain_name, s.store_name, s.city, s.address AS raw_address
    FROM stores s, o WHERE "precision" = 'address' AND {HAVERSINE.format(a='o', b='s')} <= 15""", ("stores",))
def nearby_stores(b: Bridge):
    return places.nearby(b.stores(), b.chains(), 31.5, 34.9, 15.0)


CUSTOMERS = """
    cust AS (SELECT c_custkey, (c_custkey * 41 % 410) / 100.0::DOUBLE + 29.35::DOUBLE AS lat,
                  (c_custkey * 59 % 175) / 100.0::DOUBLE + 34.15::DOUBLE AS lon, n_name AS city
           FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _customers(b: Bridge):
    c = b.table("customer").join(b.table("nation"), F.expr("c_nationkey = n_nationkey"))
    key = F.col("c_custkey")
    return c.select("c_custkey", (key * 41 % 410 / 100 + 29.35).alias("lat"),
                    (key * 59 % 175 / 100 + 34.15).alias("lon"), F.col("n_name").alias("city"))


@query("stores_near_every_customer", f"""
    , {CUSTOMERS}
    SELECT c.c_custkey AS origin_id, s.chain_id, s.store_id FROM cust c, stores s
    WHERE "precision" = 'address' AND {HAVERSINE.format(a='c', b='s')} <= 5""", ("stores",))
def stores_near_every_customer(b: Bridge):
    origins = _customers(b).withColumnRenamed("c_custkey", "origin_id")
    return places.nearby_many(origins, b.stores(), 5.0).select("origin_id", "chain_id", "store_id")


@query("location_sanity", f"""
    , {CUSTOMERS},
    d AS (SELECT c.c_custkey, c.lat, c.lon, min({HAVERSINE.format(a='c', b='s')}) AS km FROM cust c JOIN stores s USING (city) GROUP BY ALL),
    k AS (SELECT c.*, km FROM cust c LEFT JOIN d USING (c_custkey))
    SELECT CAST(c_custkey AS VARCHAR) AS branch_uid, CASE WHEN lat < 29.3 OR lat > 33.5 OR lon < 34.1 OR lon > 35.9 THEN 'outside_country'
        ELSE 'far_from_city' END AS reason, CASE WHEN lat < 29.3 OR lat > 33.5 OR lon < 34.1 OR lon > 35.9 THEN -1
        ELSE round(km * 1000)::BIGINT END AS metres FROM k
    WHERE lat < 29.3 OR lat > 33.5 OR lon < 34.1 OR lon > 35.9 OR km > 20""", ("stores",))
def location_sanity(b: Bridge):
    spots = _customers(b).withColumn("branch_uid", F.col("c_custkey").cast("string"))
    flagged = places.sanity_check(spots, b.stores())
    return flagged.select("branch_uid", "reason", F.coalesce(F.round(F.col("km") * 1000), F.lit(-1.0)).cast("bigint").alias("metres"))


@query("withdrawn_locations", f"""
    WITH {CUSTOMERS}
    SELECT CAST(c_custkey AS VARCHAR) AS branch_uid, CASE WHEN c_custkey % 3 = 0 THEN -1 ELSE round(lat * 100)::BIGINT END AS lat100 FROM cust""")
def withdrawn_locations(b: Bridge):
    spots = _customers(b).withColumn("branch_uid", F.col("c_custkey").cast("string"))
    out = places.withdraw(spots, spots.filter("c_custkey % 3 = 0"))
    return out.select("branch_uid", F.coalesce(F.round(F.col("lat") * 100), F.lit(-1.0)).cast("bigint").alias("lat100"))


# --- addresses -------------------------------------------------------------------


def _branches(b: Bridge):
    """Customers as unplaced branches with addresses of several shapes."""
    c = b.table("customer").join(b.table("nation"), F.expr("c_nationkey = n_nationkey"))
    key, city = F.col("c_custkey"), F.col("n_name")
    number = key.cast("string")
    address = (F.when(key % 5 == 0, F.concat(F.lit("רח` ארלוזורוב"), number))
               .when(key % 5 == 1, F.concat(F.lit("שדרות בן גוריון "), number, F.lit(", ליד הבנק")))
               .when(key % 5 == 2, F.concat(F.lit("ויצמן "), number, F.lit(" "), city))
               .when(key % 5 == 3, F.concat(number, F.lit(" הרצל"))).otherwise("unknown"))
    return c.select(number.alias("branch_uid"), address.alias("address"), city.alias("city"), "c_custkey")


BRANCHES = """
    WITH br AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS n, n_name AS city FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


@query("cleaned_addresses", BRANCHES + """
    SELECT n AS branch_uid, CASE k % 5 WHEN 0 THEN 'ארלוזורוב ' || n WHEN 1 THEN 'בן גוריון ' || n WHEN 2 THEN 'ויצמן ' || n
        WHEN 3 THEN n || ' הרצל' ELSE 'unknown' END AS address,
        CASE k % 5 WHEN 0 THEN 'normalize_punctuation,strip_street_prefix' WHEN 1 THEN 'strip_street_prefix,drop_trailing_clause'
        WHEN 2 THEN 'drop_duplicate_city' ELSE '' END AS rules FROM br""")
def cleaned_addresses(b: Bridge):
    out = _branches(b).withColumn("c", text.clean_address(F.col("address"), F.col("city")))
    return out.select("branch_uid", "c.address", F.array_join("c.rules", ",").alias("rules"))


@query("address_query_attempts", BRANCHES + """
    SELECT n AS branch_uid, 'cleaned' AS stage, CASE k % 5 WHEN 0 THEN 'ארלוזורוב ' WHEN 1 THEN 'בן גוריון ' ELSE 'ויצמן ' END
        || n || ', ' || city || ', ישראל' AS query FROM br WHERE k % 5 < 3""")
def address_query_attempts(b: Bridge):
    rows = _branches(b).select("branch_uid", F.explode(text.address_attempts(F.col("address"), F.col("city"))).alias("a"))
    return rows.select("branch_uid", "a.stage", "a.query")


@query("address_rule_counts", BRANCHES + """
    SELECT 'rule' AS kind, rule AS name, count(*) AS count FROM (SELECT unnest(CASE k % 5 WHEN 0 THEN ['normalize_punctuation', 'strip_street_prefix']
        WHEN 1 THEN ['strip_street_prefix', 'drop_trailing_clause'] ELSE ['drop_duplicate_city'] END) AS rule FROM br WHERE k % 5 < 3) GROUP BY rule
    UNION ALL SELECT 'stage', 'cleaned', count(*) FROM br WHERE k % 5 < 3""")
def address_rule_counts(b: Bridge):
    rows = _branches(b).select(F.explode(text.address_attempts(F.col("address"), F.col("city"))).alias("a"))
    return places.rule_counts(rows.select("a.stage", "a.rules"))


@query("address_fill", """
    , ours AS (SELECT c_custkey AS k, 'הרצל ' || CAST(c_custkey % 400 AS VARCHAR) AS key, n_name AS city
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 7 <> 0),
    theirs AS (SELECT s_suppkey, 'הרצל ' || CAST(s_suppkey % 60 AS VARCHAR) AS key, city FROM stores),
    o AS (SELECT key, count(*) AS our_rows, min(k) AS k, min(city) AS city FROM ours GROUP BY key),
    t AS (SELECT key, count(*) AS their_rows, min(s_suppkey) AS s, min(city) AS city FROM theirs GROUP BY key)
    SELECT key, our_rows, their_rows, CASE WHEN our_rows > 1 OR their_rows > 1 THEN 'ambiguous' WHEN o.city = t.city THEN 'accepted' ELSE 'review' END AS status,
        CASE WHEN our_rows = 1 AND their_rows = 1 THEN CAST(k AS VARCHAR) END AS branch_uid,
        CASE WHEN our_rows = 1 AND their_rows = 1 THEN CAST(s AS VARCHAR) END AS their_id
    FROM o JOIN t USING (key)""", ("stores",))
def address_fill(b: Bridge):
    return places.fill_by_address(*_address_sides(b)).select("key", "our_rows", "their_rows", "status", "branch_uid", "their_id")


def _address_sides(b: Bridge):
    c = b.table("customer").join(b.table("nation"), F.expr("c_nationkey = n_nationkey"))
    number = (F.col("c_custkey") % 400).cast("string")
    address = F.when(F.col("c_custkey") % 7 == 0, " Unknown ").when(
        F.col("c_custkey") % 2 == 0, F.concat(F.lit("רחוב הר״צל"), number)).otherwise(F.concat(F.lit("הרצל  "), number, F.lit(".")))
    ours = c.select(F.col("c_custkey").cast("string").alias("branch_uid"), address.alias("address"), F.col("n_name").alias("city"))
    theirs = b.stores().select(F.col("store_id").alias("id"), "address", "city", "lat", "lon")
    return ours, theirs


@query("ambiguous_address_ids", """
    , sides AS (SELECT 'הרצל ' || CAST(c_custkey % 400 AS VARCHAR) AS key, 'ours' AS side, CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_custkey % 7 <> 0
        UNION ALL SELECT 'הרצל ' || CAST(s_suppkey % 60 AS VARCHAR), 'theirs', CAST(s_suppkey AS VARCHAR) FROM supplier)
    SELECT * FROM sides QUALIFY count(*) FILTER (side = 'ours') OVER (PARTITION BY key) > 0 AND count(*) FILTER (side = 'theirs') OVER (PARTITION BY key) > 0
        AND count(*) OVER (PARTITION BY key) > 2""", ("stores",))
def ambiguous_address_ids(b: Bridge):
    return places.ambiguous_addresses(*_address_sides(b))


@query("location_passes", BRANCHES + """
    SELECT n AS branch_uid, CASE WHEN k % 2 = 0 THEN 'first' WHEN k % 3 = 0 THEN 'second' ELSE '' END AS method FROM br""")
def location_passes(b: Bridge):
    rows = _branches(b)
    hit = lambda part, name: rows.select(
        "branch_uid", F.when(part, "geocoded").otherwise("no_result").alias("status"), F.lit(31.0).alias("lat"),
        F.lit(35.0).alias("lon"), "city", F.lit(name).alias("method"))
    merged = places.merge_passes(rows, [hit(F.col("c_custkey") % 2 == 0, "first"), hit(F.col("c_custkey") % 3 == 0, "second")])
    return merged.select("branch_uid", F.coalesce("method", F.lit("")).alias("method"))


@query("address_coverage", BRANCHES + """
    SELECT city AS chain_id, count(*) AS total, count(*) FILTER (k % 5 < 4 AND k % 2 = 0) AS resolved,
           count(*) FILTER (k % 5 < 4 AND k % 2 = 1) AS unresolved, count(*) FILTER (k % 5 = 4) AS no_address FROM br GROUP BY city""")
def address_coverage(b: Bridge):
    rows = _branches(b).withColumn("lat", F.when(F.col("c_custkey") % 2 == 0, 31.0))
    return places.chain_coverage(places.classify(rows.withColumnRenamed("city", "chain_id")))


# --- ids and snapshots -----------------------------------------------------------


@query("append_only_ids", """
    WITH old AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
    new AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT k FROM old)),
    h AS (SELECT k, md5('branch|' || k) AS h FROM new)
    SELECT k AS o_custkey, 'kept-' || k AS uid FROM old
    UNION ALL SELECT k, h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] FROM h""")
def append_only_ids(b: Bridge):
    o = b.table("orders")
    known = o.filter("o_orderdate < timestamp'1996-01-01'").select("o_custkey").distinct().withColumn(
        "uid", F.concat(F.lit("kept-"), F.col("o_custkey").cast("string")))
    return identity.append_ids(known, o, ["o_custkey"], "branch")


@query("resumable_worklist", BRANCHES + """
    SELECT n AS branch_uid, CASE WHEN k % 5 = 4 THEN 'no_address' ELSE 'pending' END AS status FROM br
    WHERE k NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def resumable_worklist(b: Bridge):
    done = b.table("orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").cast("string").alias("branch_uid"))
    rows = identity.worklist(_branches(b), done, "branch_uid", text.has_address(F.col("address")))
    return rows.select("branch_uid", "status")


@query("snapshot_union", """
    SELECT user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def snapshot_union(b: Bridge):
    probes = b.table("events").select("user_id", "event_type", "value", "ts", "event_id")
    return identity.union_snapshots(probes, "user_id", ["ts", "event_id"], ["value"])


@query("coverage_curve", """
    WITH e AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id FROM events),
    f AS (SELECT user_id, min(day) AS day FROM e GROUP BY user_id)
    SELECT day, returned, coalesce(n, 0) AS new_ids, (sum(coalesce(n, 0)) OVER (ORDER BY day))::BIGINT AS total_ids
    FROM (SELECT day, count(*) AS returned FROM e GROUP BY day) LEFT JOIN (SELECT day, count(*) AS n FROM f GROUP BY day) USING (day)""")
def coverage_curve(b: Bridge):
    e = b.table("events").select(F.to_date("ts").cast("string").alias("day"), "user_id")
    return identity.coverage_curve(e, "day", "user_id")


# --- alerts ----------------------------------------------------------------------


FAVOURITES = """
    , fav AS (SELECT DISTINCT o_custkey AS user_id, '729' || reverse(lpad(CAST(l_partkey AS VARCHAR), 9, '0')) AS barcode
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
    shop AS (SELECT DISTINCT o_custkey AS user_id, chain_id, store_id FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        JOIN stores ON l_suppkey = s_suppkey)"""


def _favourites(b: Bridge):
    """All buyers: what they bought, and the stores they bought it at."""
    buyers = b.table("orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"))
    rows = b.once("bought", lambda: b.lines().join(buyers, "l_orderkey").select("user_id", "barcode", "chain_id", "store_id"))
    return rows.select("user_id", "barcode").distinct(), rows.select("user_id", "chain_id", "store_id").distinct()


@query("favourite_alerts", FAVOURITES + f"""
    SELECT f.user_id, k.chain_id, k.barcode, k.club::BIGINT AS club, k.coupon::BIGINT AS coupon, k.qty_milli::BIGINT AS qty_milli,
           k.unit_agorot, min(l.store_id) AS store_id
    FROM fav f JOIN kept k ON f.barcode = k.barcode
    JOIN shop s ON s.user_id = f.user_id AND s.chain_id = k.chain_id
    JOIN klinks l ON l.chain_id = k.chain_id AND l.barcode = k.barcode AND l.club = k.club AND l.coupon = k.coupon
         AND l.qty_milli = k.qty_milli AND l.unit_agorot = k.unit_agorot AND l.store_id = s.store_id
    WHERE k.starts <= DATE '{TODAY}' GROUP BY ALL""", ("kept", "klinks", "stores"))
def favourite_alerts(b: Bridge):
    favourites, shops = _favourites(b)
    kept, links, _ = b.kept()
    rows = alerts.candidate_alerts(favourites, shops, kept, links, b.stored_base(), TODAY)
    return rows.select("user_id", *offers.READ_TERMS, "store_id")


@query("implausible_offers", """
    SELECT k.chain_id, k.barcode, k.unit_agorot, (b.agorot * 8 >= 500 AND k.unit_agorot * 5 < b.agorot * 8)::BIGINT AS implausible
    FROM kept k JOIN base b ON k.chain_id = b.chain_id AND k.barcode = b.barcode""", ("kept", "base"))
def implausible_offers(b: Bridge):
    shelf = b.baselines().select("chain_id", "barcode", (F.col("agorot") * 8).alias("shelf"))
    rows = b.kept()[0].join(shelf, ["chain_id", "barcode"])
    return rows.select("chain_id", "barcode", "unit_agorot", money.implausible(F.col("unit_agorot"), F.col("shelf")).cast("int").alias("implausible"))


LEDGER_KEY = ["chain_id", "barcode", "club", "coupon", "min_qty", "agorot"]
LEDGER = f"""
    , live AS (SELECT * FROM offers WHERE starts <= DATE '{TODAY}' AND ends >= DATE '{TODAY}'),
    old AS (SELECT * FROM offers WHERE starts <= DATE '1998-01-01' AND ends >= DATE '1998-01-01'),
    cmp AS (SELECT coalesce(l.chain_id, o.chain_id) AS chain_id, coalesce(l.barcode, o.barcode) AS barcode, coalesce(l.club, o.club) AS club,
            coalesce(l.coupon, o.coupon) AS coupon, coalesce(l.qty_milli, o.qty_milli) AS qty_milli, coalesce(l.agorot, o.agorot) AS agorot,
            CASE WHEN o.chain_id IS NULL THEN 'new' WHEN l.chain_id IS NOT NULL THEN 'seen' ELSE 'absent' END AS outcome,
            greatest(l.ends, o.ends) AS ends, CASE WHEN o.chain_id IS NULL THEN DATE '{TODAY}' ELSE DATE '1998-01-01' END AS first_seen,
            CASE WHEN l.chain_id IS NOT NULL THEN DATE '{TODAY}' ELSE DATE '1998-01-01' END AS last_seen
        FROM live l FULL JOIN old o ON l.chain_id = o.chain_id AND l.barcode = o.barcode AND l.club = o.club AND l.coupon = o.coupon
             AND l.qty_milli = o.qty_milli AND l.agorot = o.agorot)"""
KEYS_SQL = "chain_id, barcode, club::BIGINT AS club, coupon::BIGINT AS coupon, qty_milli::BIGINT AS qty_milli, agorot"
DATES = "CAST(ends AS VARCHAR) AS ends, CAST(first_seen AS VARCHAR) AS first_seen, CAST(last_seen AS VARCHAR) AS last_seen"


def _ledger(b: Bridge):
    every = b.offer_tables()[0]
    running = lambda day: every.filter(F.lit(day).cast("date").between(F.col("starts"), F.col("ends")))
    first = F.lit("1998-01-01").cast("date")
    old = running("1998-01-01").select(*LEDGER_KEY, "ends", first.alias("first_seen"), first.alias("last_seen"))
    live = running(TODAY)
    return live, old, alerts.compare_ledger(live, old, TODAY, LEDGER_KEY)


@query("ledger_comparison", LEDGER + f"SELECT {KEYS_SQL}, outcome, {DATES} FROM cmp", ("offers",))
def ledger_comparison(b: Bridge):
    return _ledger(b)[2]


@query("new_offer_alerts", LEDGER + f"SELECT {KEYS_SQL}, unit_agorot FROM cmp JOIN live USING (chain_id, barcode, club, coupon, qty_milli, agorot) WHERE outcome = 'new'",
       ("offers",))
def new_offer_alerts(b: Bridge):
    live, _, compared = _ledger(b)
    return alerts.new_alerts(compared, live, LEDGER_KEY).select(*LEDGER_KEY, "unit_agorot")


@query("ledger_after_sweep", LEDGER + f"SELECT {KEYS_SQL}, {DATES} FROM cmp WHERE ends >= DATE '{TODAY}'", ("offers",))
def ledger_after_sweep(b: Bridge):
    return alerts.next_ledger(_ledger(b)[2], TODAY, LEDGER_KEY)


@query("alert_display_order", """
    SELECT chain_id, barcode, unit_agorot, row_number() OVER (ORDER BY least, chain_id, unit_agorot, barcode, club, coupon, qty_milli) AS position
    FROM (SELECT *, min(unit_agorot) OVER (PARTITION BY chain_id) AS least FROM kept)""", ("kept",))
def alert_display_order(b: Bridge):
    ordered = alerts.display_order(b.kept()[0], ["club", "coupon", "min_qty"])
    return ordered.select("chain_id", "barcode", "unit_agorot", "position")

