"""Published documents, compared as whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.operators import documents, offers, prices
from shelfwise.plans.bridge import TODAY, Bridge
from shelfwise.plans.queries.offers import COARSE, KEY, _coarse, _modes
from shelfwise.plans.registry import query

# Budgets small enough that the smallest data have keys with several parts and shards of every level.
DOC_BYTES, FILE_BYTES, LEVELS = 60, 400, (3, 5, 8, 12)


def _money(agorot: str) -> str:
    return rf"regexp_replace(({agorot}) // 100 || '.' || lpad(CAST(({agorot}) % 100 AS VARCHAR), 2, '0'), '\.?0+$', '')"


def _quantity(milli: str) -> str:
    return rf"regexp_replace(({milli}) // 1000 || '.' || lpad(CAST(({milli}) % 1000 AS VARCHAR), 3, '0'), '\.?0+$', '')"


def _nested(order: str, budget: int) -> str:
    """``docs`` (barcode, part, json) from ``entries`` (barcode, chain_id, text and the columns of ``order``)."""
    return f"""
    cut AS (SELECT *, CAST((sum(strlen(text) + 1) OVER (PARTITION BY barcode ORDER BY chain_id, {order} ROWS UNBOUNDED PRECEDING)
                - strlen(text) - 1) // {budget} + 1 AS INTEGER) AS part FROM entries),
    lists AS (SELECT barcode, part, chain_id, string_agg(text, ',' ORDER BY {order}) AS l FROM cut GROUP BY ALL),
    docs AS (SELECT barcode, part, '{{' || string_agg('"' || chain_id || '":[' || l || ']', ',' ORDER BY chain_id) || '}}' AS json
        FROM lists GROUP BY barcode, part)"""


def _files(levels: tuple[int, ...], budget: int) -> str:
    """``files`` (shard, file, text) from ``docs``."""
    sums = ", ".join(f"sum(strlen(barcode) + strlen(json) + 4) OVER (PARTITION BY barcode[1:{n}]) + 1 AS s{n}" for n in levels[:-1])
    cases = " ".join(f"WHEN s{n} <= {budget} THEN barcode[1:{n}]" for n in levels[:-1])
    return f"""
    sized AS (SELECT *, {sums} FROM docs),
    placed AS (SELECT barcode, part, CASE {cases} ELSE barcode[1:{levels[-1]}] END AS shard,
        '"' || barcode || CASE WHEN part = 1 THEN '' ELSE '/' || part END || '":' || json AS text FROM sized),
    numbered AS (SELECT *, CAST((sum(strlen(text) + 1) OVER (PARTITION BY shard ORDER BY barcode, part ROWS UNBOUNDED PRECEDING)
        - strlen(text) - 1) // {budget} + 1 AS INTEGER) AS file FROM placed),
    files AS (SELECT shard, file, '{{' || string_agg(text, ',' ORDER BY barcode, part) || '}}' AS text FROM numbered GROUP BY shard, file)"""


DETAIL = f""", entries AS (SELECT barcode, chain_id, store_id, '["' || store_id || '",' || {_money('agorot')} || ']' AS text FROM exc),"""


@query("detail_documents", DETAIL + _nested("store_id", DOC_BYTES) + "SELECT barcode, part::BIGINT AS part, json FROM docs", ("exc",))
def detail_documents(b: Bridge):
    return documents.detail_documents(b.prices()[2], DOC_BYTES)


@query("detail_files", DETAIL + _nested("store_id", FILE_BYTES) + "," + _files(LEVELS, FILE_BYTES) + "SELECT shard, file::BIGINT AS file, text FROM files", ("exc",))
def detail_files(b: Bridge):
    return documents.detail_files(b.prices()[2], LEVELS, FILE_BYTES)


STORES = """
    , priced AS (SELECT s.chain_id, s.store_id, store_name, city, count(l.barcode) AS n FROM stores s
        LEFT JOIN latest l ON s.chain_id = l.chain_id AND s.store_id = l.store_id GROUP BY ALL),
    lines AS (SELECT chain_id, store_id, '"' || store_id || '":["' || store_name || '","' || city || '",' || n || ']' AS text FROM priced)"""


def _stores(b: Bridge) -> DataFrame:
    return prices.priced_items(b.latest(), b.stores())


@query("store_side_documents", STORES + f"""
    , cut AS (SELECT *, (sum(strlen(text) + 1) OVER (PARTITION BY chain_id ORDER BY store_id ROWS UNBOUNDED PRECEDING)
        - strlen(text) - 1) // {FILE_BYTES} + 1 AS part FROM lines)
    SELECT chain_id, part::BIGINT AS part, '{{' || string_agg(text, ',' ORDER BY store_id) || '}}' AS json FROM cut GROUP BY chain_id, part""",
       ("stores", "latest"))
def store_side_documents(b: Bridge):
    return documents.store_documents(_stores(b), FILE_BYTES)


PROMO = COARSE + f"""
    , slists AS (SELECT {KEY}, unit_agorot, '["' || string_agg(store_id, '","' ORDER BY store_id) || '"]' AS stores FROM listing GROUP BY ALL),
    entries AS (SELECT barcode, chain_id, club, coupon, unit_agorot, qty_milli, '{{"u":' || {_money('unit_agorot')} || ',"d":"' || coalesce(description, '')
        || '","e":"' || coalesce(CAST(ends AS VARCHAR), '') || '"' || CASE WHEN qty_milli <> 1000 THEN ',"q":' || {_quantity('qty_milli')}
        || ',"t":' || {_money('agorot')} ELSE '' END || CASE WHEN club = 1 THEN ',"c":1' ELSE '' END || CASE WHEN coupon = 1 THEN ',"k":1' ELSE '' END
        || CASE WHEN starts > DATE '{TODAY}' THEN ',"b":"' || CAST(starts AS VARCHAR) || '"' ELSE '' END
        || CASE mode WHEN 'only' THEN ',"s":' || stores WHEN 'except' THEN ',"x":' || stores ELSE '' END || '}}' AS text
        FROM kept JOIN modes USING ({KEY}, unit_agorot) LEFT JOIN slists USING ({KEY}, unit_agorot)),"""
OFFER_ORDER = "club, coupon, unit_agorot, qty_milli"


def _entries(b: Bridge) -> DataFrame:
    kept, links, everywhere = _coarse(b)
    modes = _modes(b, links, everywhere)
    return offers.promotion_entries(kept, modes, offers.branch_listing(links, everywhere, modes), TODAY)


@query("promotion_files", PROMO + _nested(OFFER_ORDER, 1000) + "," + _files((3, 6, 8, 10), 3000) + "SELECT shard, file::BIGINT AS file, text FROM files",
       ("kept", "klinks", "everywhere", "stores"))
def promotion_files(b: Bridge):
    return documents.files(documents.promotion_documents(_entries(b), 1000), (3, 6, 8, 10), 3000)


@query("promotions_of_asked_products", PROMO + _nested(OFFER_ORDER, 250_000) + """
    SELECT barcode, part::BIGINT AS part, json FROM docs JOIN products USING (barcode) WHERE is_weighted = 0""",
       ("kept", "klinks", "everywhere", "stores", "products"))
def promotions_of_asked_products(b: Bridge):
    return documents.promotions_for(b.products().filter("is_weighted = 0"), _entries(b))


NAME_LIMIT, NAME_LEVELS, PER_TERM, SHARE, FLOOR = 900, (2, 3, 4), 5, 0.5, 3
NAMES = rf"""
    , t AS (SELECT barcode, unnest(list_distinct(list_filter(regexp_extract_all(lower(name), '[\p{{L}}\p{{N}}_"''״׳]+'),
          lambda w: length(w) >= 2 AND NOT regexp_matches(w, '^\p{{Nd}}+$') AND regexp_matches(w, '^[\p{{L}}\p{{N}}]')))) AS term FROM products),
    f AS (SELECT term FROM t GROUP BY term HAVING count(*) >= greatest({FLOOR}.0, {SHARE} * (SELECT count(*) FROM products))),
    sold AS (SELECT barcode, count(*) AS n FROM base GROUP BY barcode),
    ranked AS (SELECT term, barcode FROM t LEFT JOIN sold USING (barcode) WHERE term NOT IN (SELECT term FROM f)
        QUALIFY row_number() OVER (PARTITION BY term ORDER BY coalesce(n, 0) DESC, barcode) <= {PER_TERM}),
    rows AS (SELECT barcode, length(name) AS nc, '["' || barcode || '","' || name || '",' || is_weighted || ']' AS text FROM products),
    w AS (SELECT translate(term, '"''״׳', '') AS w, barcode, length(text) AS chars FROM ranked JOIN rows USING (barcode)),
    p2 AS (SELECT w[1:2] AS p, barcode, max(chars) AS chars, max(length(w)) AS longest FROM w WHERE length(w) >= 2 GROUP BY ALL),
    b2 AS (SELECT p FROM p2 GROUP BY p HAVING sum(chars) + count(*) + 1 > {NAME_LIMIT}),
    p3 AS (SELECT w[1:3] AS p, barcode, max(chars) AS chars, max(length(w)) AS longest FROM w
           WHERE length(w) > 2 AND w[1:2] IN (SELECT p FROM b2) GROUP BY ALL),
    b3 AS (SELECT p FROM p3 GROUP BY p HAVING sum(chars) + count(*) + 1 > {NAME_LIMIT}),
    p4 AS (SELECT w[1:4] AS p, barcode FROM w WHERE length(w) > 3 AND w[1:3] IN (SELECT p FROM b3) GROUP BY ALL),
    members AS (SELECT p AS shard, barcode FROM p2 WHERE p NOT IN (SELECT p FROM b2) OR longest <= 2
    UNION SELECT p, barcode FROM p3 WHERE p NOT IN (SELECT p FROM b3) OR longest <= 3
    UNION SELECT p, barcode FROM p4)"""


@query("name_files", NAMES + """
    SELECT shard, '[' || string_agg(text, ',' ORDER BY nc, barcode) || ']' AS text FROM members JOIN rows USING (barcode) GROUP BY shard""",
       ("products", "base"))
def name_files(b: Bridge):
    return documents.name_files(b.products(), b.baselines(), NAME_LEVELS, NAME_LIMIT, PER_TERM, SHARE, FLOOR)


HEAD = f"""
    , as_of AS (SELECT chain_id, CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS d FROM obs GROUP BY chain_id),
    maps AS (SELECT (SELECT '{{' || string_agg('"' || r_name || '":"' || lower(r_name) || '"', ',' ORDER BY r_name) || '}}' FROM region) AS chains,
        (SELECT '{{' || string_agg('"' || chain_id || '":"' || d || '"', ',' ORDER BY chain_id) || '}}' FROM as_of) AS chain_as_of,
        (SELECT count(*) FROM products) AS n, (SELECT count(DISTINCT barcode) FROM kept) AS promo)"""


def _as_of(b: Bridge) -> DataFrame:
    return b.observations("l_shipdate").groupBy("chain_id").agg(F.to_date(F.max("l_shipdate")).cast("string").alias("as_of"))


@query("catalog_index", HEAD + DETAIL + _nested("store_id", FILE_BYTES) + "," + _files(LEVELS, FILE_BYTES) + f"""
    , k AS (SELECT barcode, count(*) OVER (PARTITION BY barcode[1:3]) AS na, count(*) OVER (PARTITION BY barcode[1:5]) AS nb FROM products),
    s AS (SELECT DISTINCT CASE WHEN na <= 25 THEN barcode[1:3] WHEN nb <= 25 THEN barcode[1:5] ELSE barcode[1:7] END AS shard FROM k)
    SELECT (SELECT count(*) FROM s) + (SELECT count(*) FROM files) + 5 AS files, '{{"levels":[3,5,7],"shards":['
        || (SELECT string_agg('"' || shard || '"', ',' ORDER BY shard) FROM s) || '],"chains":' || chains || ',"built_at":"{TODAY}","chain_as_of":' || chain_as_of
        || ',"products":' || n || ',"promo_products":' || promo || '}}' AS json FROM maps""", ("obs", "exc", "kept", "products"))
def catalog_index(b: Bridge):
    """The whole index; whether a host takes that many files is asked before publishing (``shards.over_limit``)."""
    detail = documents.count_of(documents.detail_files(b.prices()[2], LEVELS, FILE_BYTES))
    return documents.catalog_index(b.products(), b.chains(), _as_of(b), b.kept()[0], TODAY, detail, (3, 5, 7), 25, strict=False)


@query("meta_documents", HEAD + STORES + f"""
    , cut AS (SELECT *, (sum(strlen(text) + 1) OVER (ORDER BY chain_id, store_id ROWS UNBOUNDED PRECEDING)
        - strlen(text) - 1) // {FILE_BYTES} + 1 AS part FROM lines),
    c AS (SELECT part, chain_id, '"' || chain_id || '":{{' || string_agg(text, ',' ORDER BY store_id) || '}}' AS t FROM cut GROUP BY part, chain_id)
    SELECT part::BIGINT AS part, '{{"built_at":"{TODAY}","chain_as_of":' || chain_as_of || ',"chains":' || chains || ',"products":' || n || ',"promo_products":'
        || promo || ',"stores":{{' || string_agg(t, ',' ORDER BY chain_id) || '}}}}' AS json FROM c, maps GROUP BY part, chains, chain_as_of, n, promo""",
       ("obs", "stores", "latest", "kept", "products"))
def meta_documents(b: Bridge):
    return documents.meta_documents(b.products(), b.kept()[0], b.chains(), _as_of(b), _stores(b), TODAY, FILE_BYTES)
