"""The driver's tables seen as retail tables, in Spark and in SQL.

Each logical table is defined twice: as a DataFrame for the queries, and as a
common table expression (``CTES``) that their check queries repeat literally.
All money is integer agorot, so both sides compute exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from shelfwise.operators import offers as offer_ops
from shelfwise.operators import prices as price_ops
from shelfwise.operators import search as search_ops
from shelfwise.operators.spread import lookup_join, widen
from shelfwise.session import cut_lineage

TODAY = "1998-06-01"
ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "agorot"]
TYPE_ID = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6}


def ean(key: str | Column) -> Column:
    """Barcode text of a part key."""
    c = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit("729"), F.reverse(F.lpad(c.cast("string"), 9, "0")))


_SCHEMAS: dict[str, T.StructType] = {}


class Bridge:
    """Logical tables over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._once: dict[str, DataFrame] = {}

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table that one query reads several times: built and stored at its first use, as the mart stores it."""
        if name not in self._once:
            self._once[name] = cut_lineage(build())
        return self._once[name]

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # --- dimensions

    def chains(self) -> DataFrame:
        return self.table("region").select(F.col("r_name").alias("chain_id"), F.lower("r_name").alias("name"))

    def suppliers(self) -> DataFrame:
        s = self.table("supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
        n = self.table("nation")
        r = self.table("region")
        joined = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
        key = F.col("s_suppkey")
        return joined.select(
            "s_suppkey", "s_nationkey", F.col("r_name").alias("chain_id"),
            key.cast("string").alias("store_id"), F.col("n_name").alias("city"),
            F.col("s_name").alias("store_name"), F.col("n_name").alias("city_name"),
            F.concat(F.lit("רח' הרצל"), (key % 60).cast("string"), F.lit(", "), F.col("n_name")).alias("address"),
            ((key * 37 % 400) / 100 + 29.4).alias("lat"), ((key * 53 % 160) / 100 + 34.2).alias("lon"),
            F.when(key % 5 == 0, "city").otherwise("address").alias("precision"))

    def stores(self) -> DataFrame:
        return self.suppliers().drop("s_suppkey", "s_nationkey")

    def products(self) -> DataFrame:
        return self.table("part").select(
            ean("p_partkey").alias("barcode"), F.col("p_name").alias("name"),
            F.col("p_brand").alias("manufacturer"),
            F.when(F.col("p_size") % 3 == 0, "kilo").when(F.col("p_size") % 3 == 1, "לא ידוע").otherwise("").alias("unit_qty"),
            F.col("p_type").alias("unit_of_measure"),
            (F.col("p_size") % 8 == 0).cast("int").alias("is_weighted"))

    def product_categories(self) -> DataFrame:
        """Placed products; sizes that divide by seven are not placed."""
        number = F.substring("p_brand", 7, 9).cast("int")
        return self.table("part").filter("p_size % 7 <> 0").select(
            ean("p_partkey").alias("barcode"), (number + 100).alias("category_id"))

    def categories(self) -> DataFrame:
        """Brands as aisles under the type of their first part, types on top."""
        first = self.table("part").groupBy("p_brand").agg(F.min_by("p_type", "p_partkey").alias("t"))
        number = F.substring("p_brand", 7, 9).cast("int")
        type_id = F.create_map(*[F.lit(x) for kv in TYPE_ID.items() for x in kv])
        subs = first.select((number + 100).alias("id"), F.col("p_brand").alias("slug"),
                            F.lower("p_brand").alias("name_he"), type_id[F.col("t")].alias("parent_id"))
        tops = self.table("part").select("p_type").distinct().select(
            type_id[F.col("p_type")].alias("id"), F.col("p_type").alias("slug"),
            F.lower("p_type").alias("name_he"), F.lit(None).cast("int").alias("parent_id"))
        return tops.unionByName(subs)

    def mart_products(self) -> DataFrame:
        placed = self.products().join(self.product_categories(), "barcode", "left")
        return placed.withColumn("sort_key", F.col("name"))

    # --- prices

    def lines(self, *columns: str) -> DataFrame:
        """Order lines with their store and barcode; ``columns`` are extra."""
        wanted = {"l_suppkey", "l_partkey", "l_discount", "l_shipdate", "l_orderkey", "l_linenumber", *columns}
        rows = self.table("lineitem").select(*sorted(wanted))
        shops = self.suppliers().select(F.col("s_suppkey").alias("l_suppkey"), "chain_id", "store_id", "city")
        percent = F.floor(F.col("l_discount") * 100 + 0.5)
        placed = lookup_join(rows, shops, ["l_suppkey"], ["l_orderkey", "l_linenumber"], "inner")
        return placed.withColumns({
            "barcode": ean("l_partkey"), "agorot": (F.col("l_partkey") % 500 + 100) * (100 - percent),
            "percent": percent})

    def observations(self, *columns: str) -> DataFrame:
        return self.lines(*columns)

    def latest(self) -> DataFrame:
        return price_ops.latest_prices(self.observations(), ORDER)

    def baselines(self) -> DataFrame:
        return price_ops.baselines(self.latest())

    def stored_base(self) -> DataFrame:
        """The baselines, written once, from latest prices that are: so the shuffles of one are gone before those of the other."""
        return self.once("base", lambda: price_ops.baselines(self.once("latest", self.latest)))

    def prices(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        latest, base = self.once("latest", self.latest), self.stored_base()
        return latest, base, price_ops.exceptions(latest, base)

    # --- offers

    def offer_rows(self) -> DataFrame:
        """Published offers: priced from five percent up, else at the shelf."""
        rows = self.lines("l_returnflag", "l_linestatus", "l_quantity")
        qty = F.col("l_quantity").cast("int")
        priced = F.col("percent") >= 5
        count = F.when(qty >= 49, F.lit("0.5")).otherwise((qty % 3 + 1).cast("string")).cast("decimal(10,3)")
        total = F.when(qty >= 49, F.col("agorot")).otherwise(F.col("agorot") * (qty % 3 + 1))
        return rows.select(
            "chain_id", "store_id", "barcode",
            (F.col("l_returnflag") == "R").cast("int").alias("club"),
            (F.col("l_linestatus") == "F").cast("int").alias("coupon"),
            F.when(priced, count).otherwise(F.lit("2").cast("decimal(10,3)")).alias("min_qty"),
            F.when(priced, total).alias("agorot"),
            F.when(priced, total).otherwise(100).cast("bigint").alias("known_agorot"),
            F.when(priced, 0).otherwise(1).cast("decimal(10,3)").alias("unpriced_qty"),
            F.col("l_orderkey").cast("string").alias("promo_id"),
            F.concat(F.lit("save "), (F.col("l_orderkey") % 1000).cast("string")).alias("description"),
            F.to_date("l_shipdate").alias("starts"),
            F.date_add(F.to_date("l_shipdate"), (F.col("l_orderkey") % 400 + 200).cast("int")).alias("ends"))

    def offer_tables(self) -> tuple[DataFrame, DataFrame]:
        """Merged priced offers and their links."""
        priced, _ = offer_ops.split_priced(self.offer_rows())
        return offer_ops.merge_offers(priced), offer_ops.offer_links(priced)

    def stored_links(self) -> DataFrame:
        """The links, written once: queries of branches read them again. The offers are read once, by the read merge."""
        return self.once("links", lambda: self.offer_tables()[1])

    def read_tables(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return offer_ops.read_merge(self.offer_tables()[0], self.stored_links(), TODAY)

    def kept(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        merged, links, everywhere = self.read_tables()
        live = self.once("live_links", lambda: links)
        kept, kept_links = offer_ops.prune_dominated(merged, live)
        return self.once("kept", lambda: kept), kept_links, everywhere

    def chain_products(self) -> DataFrame:
        """Weighed items under the name that each chain gives them."""
        weighed = self.products().filter("is_weighted = 1").select("barcode", "name", "unit_qty", "unit_of_measure", "is_weighted")
        sold = self.stored_base().select("chain_id", "barcode").join(weighed, "barcode")
        return sold.withColumn("name", F.concat_ws(" ", "name", F.lower("chain_id")))

    def deals(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Deals, their branch links and every chain's branches on offer."""
        kept, links, everywhere = self.kept()
        deals = offer_ops.build_deals(
            kept, self.stored_base(), self.products(), self.chain_products(), self.product_categories())
        return deals, links, everywhere

    # --- texts

    def documents(self) -> DataFrame:
        texts = widen(self.table("documents").select("doc_id", "text"))
        return texts.select(F.col("doc_id").cast("string").alias("barcode"), F.col("text").alias("name"))

    def search_index(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        docs = search_ops.index_docs(self.documents())
        return docs, search_ops.postings(docs), search_ops.corpus_stats(docs)


# --- the same tables in SQL -----------------------------------------------------

_EAN = "'729' || reverse(lpad(CAST({} AS VARCHAR), 9, '0'))"

CTES: dict[str, tuple[list[str], str]] = {
    "stores": ([], """
        SELECT s_suppkey, s_nationkey, r_name AS chain_id, CAST(s_suppkey AS VARCHAR) AS store_id, n_name AS city,
               s_name AS store_name,
               'רח'' הרצל' || CAST(s_suppkey % 60 AS VARCHAR) || ', ' || n_name AS address,
               (s_suppkey * 37 % 400) / 100.0 + 29.4 AS lat, (s_suppkey * 53 % 160) / 100.0 + 34.2 AS lon,
               CASE WHEN s_suppkey % 5 = 0 THEN 'city' ELSE 'address' END AS "precision"
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "products": ([], f"""
        SELECT {_EAN.format('p_partkey')} AS barcode, p_name AS name, p_brand AS manufacturer,
               CASE p_size % 3 WHEN 0 THEN 'kilo' WHEN 1 THEN 'לא ידוע' ELSE '' END AS unit_qty,
               p_type AS unit_of_measure, CASE WHEN p_size % 8 = 0 THEN 1 ELSE 0 END AS is_weighted,
               CASE WHEN p_size % 7 <> 0 THEN 100 + CAST(substr(p_brand, 7) AS INT) END AS category_id, p_name AS sort_key
        FROM part"""),
    "categories": ([], """
        SELECT DISTINCT CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 4
                        WHEN 'SMALL' THEN 5 ELSE 6 END AS id, p_type AS slug, lower(p_type) AS name_he, NULL AS parent_id
        FROM part
        UNION ALL
        SELECT 100 + CAST(substr(p_brand, 7) AS INT), p_brand, lower(p_brand),
               CASE arg_min(p_type, p_partkey) WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                    WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END
        FROM part GROUP BY p_brand"""),
    "obs": (["stores"], f"""
        SELECT chain_id, store_id, city, {_EAN.format('l_partkey')} AS barcode, l_partkey,
               (100 + l_partkey % 500) * (100 - CAST(round(l_discount * 100) AS BIGINT)) AS agorot,
               CAST(round(l_discount * 100) AS BIGINT) AS "percent",
               l_shipdate, l_orderkey, l_linenumber, l_returnflag, l_linestatus, CAST(l_quantity AS INT) AS qty
        FROM lineitem JOIN stores ON l_suppkey = s_suppkey"""),
    "latest": (["obs"], """
        SELECT chain_id, store_id, barcode, agorot FROM obs
        QUALIFY row_number() OVER (PARTITION BY chain_id, store_id, barcode
                ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, agorot DESC) = 1"""),
    "support": (["latest"], """
        SELECT chain_id, barcode, agorot, count(*) AS store_count FROM latest GROUP BY ALL"""),
    "base": (["support"], """
        SELECT chain_id, barcode, agorot, store_count FROM support
        QUALIFY row_number() OVER (PARTITION BY chain_id, barcode ORDER BY store_count DESC, agorot) = 1"""),
    "exc": (["latest", "base"], """
        SELECT l.chain_id, l.store_id, l.barcode, l.agorot FROM latest l
        JOIN base b ON l.chain_id = b.chain_id AND l.barcode = b.barcode WHERE l.agorot <> b.agorot"""),
    "effective": (["stores", "base", "exc"], """
        SELECT s.chain_id, s.store_id, s.city, s.store_name, b.barcode, coalesce(e.agorot, b.agorot) AS agorot
        FROM stores s JOIN base b ON s.chain_id = b.chain_id
        LEFT JOIN exc e ON e.chain_id = s.chain_id AND e.store_id = s.store_id AND e.barcode = b.barcode"""),
    "offer_rows": (["obs"], """
        SELECT chain_id, store_id, barcode,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS club,
               CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS coupon,
               CASE WHEN "percent" < 5 THEN 2000 WHEN qty >= 49 THEN 500 ELSE 1000 * (qty % 3 + 1) END AS qty_milli,
               CASE WHEN "percent" >= 5 THEN CASE WHEN qty >= 49 THEN agorot ELSE agorot * (qty % 3 + 1) END END AS agorot,
               CAST(l_orderkey AS VARCHAR) AS promo_id,
               'save ' || CAST(l_orderkey % 1000 AS VARCHAR) AS description,
               CAST(l_shipdate AS DATE) AS starts,
               CAST(l_shipdate AS DATE) + CAST(l_orderkey % 400 + 200 AS INT) AS ends
        FROM obs"""),
    "offers": (["offer_rows"], """
        SELECT chain_id, barcode, club, coupon, qty_milli, agorot,
               (agorot * 1000 * 2 + qty_milli) // (2 * qty_milli) AS unit_agorot,
               arg_min(promo_id, (length(description), description, promo_id)) AS promo_id,
               arg_min(description, (length(description), description, promo_id)) AS description,
               min(starts) AS starts, max(ends) AS ends
        FROM offer_rows WHERE agorot IS NOT NULL GROUP BY chain_id, barcode, club, coupon, qty_milli, agorot"""),
    "links": (["offer_rows"], """
        SELECT DISTINCT chain_id, barcode, club, coupon, qty_milli, agorot, store_id
        FROM offer_rows WHERE agorot IS NOT NULL"""),
    "linked": (["offers", "links"], f"""
        SELECT o.*, l.store_id, CASE WHEN o.qty_milli < 1000 THEN 1000 ELSE o.qty_milli END AS rq,
               CASE WHEN o.qty_milli < 1000 THEN o.agorot ELSE o.unit_agorot END AS ru
        FROM offers o JOIN links l USING (chain_id, barcode, club, coupon, qty_milli, agorot)"""),
    "everywhere": (["linked"], "SELECT DISTINCT chain_id, store_id FROM linked"),
    "merged": (["linked"], f"""
        SELECT chain_id, barcode, club, coupon, rq AS qty_milli, ru AS unit_agorot, min(agorot) AS agorot,
               min(starts) AS starts, max(ends) AS ends,
               arg_min(description, (length(description), description)) AS description
        FROM linked WHERE ends >= DATE '{TODAY}' GROUP BY ALL"""),
    "mlinks": (["linked"], f"""
        SELECT DISTINCT chain_id, barcode, club, coupon, rq AS qty_milli, ru AS unit_agorot, store_id
        FROM linked WHERE ends >= DATE '{TODAY}'"""),
    "winners": (["mlinks"], """
        SELECT DISTINCT chain_id, barcode, club, coupon, qty_milli, unit_agorot FROM (
            SELECT *, row_number() OVER (PARTITION BY chain_id, barcode, club, coupon, store_id
                                         ORDER BY unit_agorot, qty_milli) AS rn FROM mlinks) WHERE rn = 1"""),
    "kept": (["merged", "winners"], """
        SELECT m.* FROM merged m JOIN winners w USING (chain_id, barcode, club, coupon, qty_milli, unit_agorot)"""),
    "klinks": (["mlinks", "winners"], """
        SELECT m.* FROM mlinks m JOIN winners w USING (chain_id, barcode, club, coupon, qty_milli, unit_agorot)"""),
    "chain_products": (["base", "products"], """
        SELECT b.chain_id, p.barcode, p.name || ' ' || lower(b.chain_id) AS name, p.unit_qty, p.unit_of_measure, 1 AS is_weighted
        FROM base b JOIN products p USING (barcode) WHERE p.is_weighted = 1"""),
    "deals": (["kept", "base", "chain_products", "products"], """
        SELECT k.*, row_number() OVER (ORDER BY k.chain_id, k.barcode, k.club, k.coupon, k.unit_agorot, k.qty_milli) AS deal_id,
               b.agorot AS base_agorot, p.category_id, coalesce(c.name, p.name) AS name,
               CASE WHEN b.agorot > 0 THEN CAST(floor(CAST(2000 * (b.agorot - k.unit_agorot) + b.agorot AS DOUBLE)
                    / CAST(2 * b.agorot AS DOUBLE)) AS BIGINT) END AS discount_tenths
        FROM kept k LEFT JOIN base b ON k.chain_id = b.chain_id AND k.barcode = b.barcode
        LEFT JOIN chain_products c ON k.chain_id = c.chain_id AND k.barcode = c.barcode
        LEFT JOIN products p ON k.barcode = p.barcode"""),
    "real_deals": (["deals"], "SELECT * FROM deals WHERE discount_tenths > 0"),
    "best_deals": (["real_deals"], """
        SELECT r.*, n.chains_on_deal FROM real_deals r JOIN (
            SELECT barcode, count(DISTINCT chain_id) AS chains_on_deal FROM real_deals GROUP BY barcode) n USING (barcode)
        QUALIFY row_number() OVER (PARTITION BY barcode ORDER BY unit_agorot, deal_id) = 1"""),
    "words": ([], r"""
        SELECT CAST(doc_id AS VARCHAR) AS barcode, list_filter(regexp_split_to_array(
                   lower(translate(text, '"''״׳', '')), '[^\p{L}\p{N}_\x{0590}-\x{05FF}]+'), lambda w: length(w) >= 2) AS ws
        FROM documents WHERE text <> ''"""),
    "postings": (["words"], """
        SELECT token, barcode, count(*) AS tf, any_value(dl) AS dl FROM (
            SELECT barcode, len(ws) AS dl, unnest(ws) AS token FROM words) GROUP BY token, barcode"""),
}


def with_ctes(body: str, *names: str) -> str:
    """``body`` with the named tables, and what they need, defined before it."""
    ordered: list[str] = []

    def add(name: str) -> None:
        needs, _ = CTES[name]
        for need in needs:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body
    defined = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered)
    return f"WITH {defined}\n{body}"
