"""Products: names, categories, summaries, documents and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions import money, text
from shelfwise.operators.offers import decode_cursor
from shelfwise.operators.prices import ITEM_KEY
from shelfwise.operators.spread import exists_join, lookup_join, max_by_order, min_by_order


# --- merging parts -----------------------------------------------------------


def union_parts(parts: list[DataFrame], defaults: dict[str, object] | None = None) -> DataFrame:
    """Union of parts with drifting columns: absent is null, or a default."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.fillna(defaults) if defaults else out


def replace_rows(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last written row per key."""
    values = [c for c in rows.columns if c not in keys and c not in order]
    return max_by_order(rows, keys, [F.col(c) for c in order], values)


def ignore_rows(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add rows whose key the table does not have."""
    values = [c for c in table.columns if c not in keys]
    new = min_by_order(rows.select(*table.columns), keys, [F.col(v) for v in values], values)
    return table.unionByName(new.join(table.select(*keys), keys, "left_anti").select(*table.columns))


def weighed_products(products: DataFrame, base: DataFrame) -> DataFrame:
    """What each chain calls the weighed items it prices.

    ``products``: part, barcode, name, unit_qty, unit_of_measure, is_weighted;
    ``base`` carries the same ``part``.
    """
    named = products.filter((F.col("is_weighted") == 1) & (F.coalesce("name", F.lit("")) != ""))
    sold = base.select("part", *ITEM_KEY).join(named, ["part", "barcode"])
    return sold.select(*ITEM_KEY, "name", "unit_qty", "unit_of_measure", "is_weighted")


def claim_disagreements(claimed: DataFrame, products: DataFrame, base: DataFrame) -> DataFrame:
    """Also what the other chains call those barcodes; existing rows stay."""
    named = products.filter(F.coalesce("name", F.lit("")) != "")
    sold = base.select("part", *ITEM_KEY).join(named, ["part", "barcode"])
    others = exists_join(sold, claimed, ["barcode"], ["chain_id"])
    return ignore_rows(claimed, others, ITEM_KEY)


def mart_products(products: DataFrame, categories: DataFrame, decided: DataFrame) -> DataFrame:
    """Products with a decided name first, a category and a sort key."""
    names = decided.select("barcode", F.col("name").alias("_decided"))
    out = products.join(names, "barcode", "left").join(
        categories.select("barcode", "category_id"), "barcode", "left")
    name = F.coalesce("_decided", "name")
    return out.withColumns({"name": name, "sort_key": text.squeeze(name)}).drop("_decided")


# --- categories --------------------------------------------------------------


def category_counts(categories: DataFrame, products: DataFrame) -> DataFrame:
    """Products per sub-category; a department is the sum of its children."""
    counted = products.filter("category_id is not null").groupBy(F.col("category_id").alias("id")).agg(
        F.count(F.lit(1)).alias("n"))
    subs = categories.filter("parent_id is not null").join(counted, "id", "left").select(
        F.col("id").alias("category_id"), "parent_id", F.coalesce("n", F.lit(0).cast("bigint")).alias("count"))
    sums = subs.groupBy("parent_id").agg(F.sum("count").alias("count"))
    tops = categories.filter("parent_id is null").select(F.col("id").alias("parent_id")).join(
        sums, "parent_id", "left")
    return subs.select("category_id", "count").unionByName(
        tops.select(F.col("parent_id").alias("category_id"), F.coalesce("count", F.lit(0).cast("bigint")).alias("count")))


def visible_categories(categories: DataFrame, counts: DataFrame) -> DataFrame:
    """Tree rows with products: aisles first, departments of what is left."""
    counted = categories.join(counts, categories["id"] == counts["category_id"]).drop("category_id")
    aisles = counted.filter("parent_id is not null and count > 0")
    sums = aisles.groupBy(F.col("parent_id").alias("id")).agg(F.sum("count").alias("count"))
    tops = categories.filter("parent_id is null").join(sums, "id")
    cols = ["id", "name_he", "parent_id", "count"]
    return tops.select(*cols).unionByName(aisles.select(*cols))


def category_tree(visible: DataFrame) -> DataFrame:
    """One row per department with its aisles nested (the taxonomy is small)."""
    children = visible.filter("parent_id is not null").groupBy(F.col("parent_id").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("id", "name_he", "count"))).alias("children"))
    tops = visible.filter("parent_id is null").select("id", "name_he", "count")
    return tops.join(children, "id").orderBy("id")


# --- summaries and pages -----------------------------------------------------


def product_summaries(products: DataFrame, base: DataFrame, deals: DataFrame) -> DataFrame:
    """Lowest chain price, chains selling, on-deal and weighed flags."""
    priced = base.groupBy("barcode").agg(
        F.min("agorot").alias("min_agorot"), F.count(F.lit(1)).alias("chains"))
    on_deal = deals.filter("discount_tenths > 0").select("barcode").distinct().withColumn("on_deal", F.lit(1))
    out = products.join(priced, "barcode", "left").join(on_deal, "barcode", "left")
    return out.select(
        "barcode", "name", "category_id", "sort_key", "min_agorot",
        F.coalesce("chains", F.lit(0).cast("bigint")).alias("chains"),
        F.coalesce("on_deal", F.lit(0)).alias("on_deal"), F.col("is_weighted").alias("weighted"))


def category_page(products: DataFrame, category_id: int, limit: int, cursor: str | None = None) -> DataFrame:
    """Next products of a category by (sort key, barcode), one row over."""
    rows = products.filter(F.col("category_id") == category_id)
    if cursor is not None:
        sort_key, barcode = decode_cursor(cursor, str, str)
        rows = rows.filter((F.col("sort_key") > sort_key)
                           | ((F.col("sort_key") == sort_key) & (F.col("barcode") > barcode)))
    return rows.orderBy("sort_key", "barcode").limit(limit + 1)


def resolve_scans(scans: DataFrame, products: DataFrame, variants: bool = False) -> DataFrame:
    """First candidate code of each scan that exists; null when none does."""
    forms = text.barcode_variants if variants else text.barcode_candidates
    asked = scans.select("raw").distinct()
    tries = asked.select("raw", F.posexplode(forms(F.col("raw"))).alias("pos", "barcode"))
    found = lookup_join(tries, products.select("barcode").distinct(), ["barcode"], ["raw"], "inner")
    first = min_by_order(found, ["raw"], [F.col("pos")], ["barcode"])
    return asked.join(first, "raw", "left")


def store_pairs(values: DataFrame) -> DataFrame:
    """(chain, store) pairs of ``chain:store`` texts; malformed ones ignored."""
    rows = values.select(F.explode(F.split("value", ",")).alias("p")).withColumn("p", F.trim("p")).select(
        F.substring_index("p", ":", 1).alias("chain_id"),
        F.regexp_extract("p", "^[^:]*:(.*)$", 1).alias("store_id"))
    return rows.filter("chain_id <> '' and store_id <> ''").distinct()


def exceptions_for(exc: DataFrame, pairs: DataFrame | None) -> DataFrame:
    """Exceptions at the wanted stores; no valid pair means all of them."""
    if pairs is None:
        return exc
    wanted = pairs.select("chain_id", "store_id").distinct()
    none = wanted.agg((F.count(F.lit(1)) == 0).alias("none")).scalar()
    marked = lookup_join(exc, wanted.withColumn("_asked", F.lit(True)), ["chain_id", "store_id"], ["barcode"])
    return marked.filter(F.col("_asked").isNotNull() | none).drop("_asked").select(*exc.columns)


def price_documents(products: DataFrame, base: DataFrame) -> DataFrame:
    """Product document: name, chain prices, weighed mark and real unit.

    The map holds one entry per chain, so its size is that of the chain list.
    """
    entry = F.struct(F.col("chain_id"), F.struct(
        money.to_shekels(F.col("agorot")).alias("price"), F.col("store_count").alias("stores")).alias("v"))
    prices = base.groupBy("barcode").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("p"))
    out = products.join(prices, "barcode", "left")
    return out.select(
        "barcode", F.struct(
            F.col("name").alias("n"), F.col("p"),
            F.when(F.col("is_weighted") == 1, 1).alias("w"),
            text.display_unit(F.col("is_weighted"), F.col("unit_qty")).alias("u")).alias("doc"))


def product_lookup(requests: DataFrame, products: DataFrame, base: DataFrame, exc: DataFrame,
                   entries: DataFrame, pairs: DataFrame | None = None) -> dict[str, DataFrame]:
    """Batch product lookup, keyed by the raw code asked for.

    ``documents`` has one row per request, null when unknown. Store prices and
    offers come as rows of their own, so that no request grows without bound;
    ``documents.py`` makes published texts of them.
    """
    resolved = resolve_scans(requests, products)
    wanted = resolved.filter("barcode is not null").select("barcode").distinct()
    only = lambda df, spread: exists_join(df, wanted, ["barcode"], [spread])
    docs = price_documents(only(products, "name"), only(base, "chain_id"))
    detail = exceptions_for(only(exc, "store_id"), pairs).select(
        *ITEM_KEY, "store_id", money.to_shekels(F.col("agorot")).alias("price"))
    asked = resolved.filter("barcode is not null")
    return {
        "documents": resolved.join(docs, "barcode", "left"),
        "detail": asked.join(detail, "barcode"),
        "offers": asked.join(only(entries, "unit_agorot"), "barcode"),
    }


def meta_summary(products: DataFrame, deals: DataFrame, chains: DataFrame, stores: DataFrame) -> DataFrame:
    """Counts behind the meta document, in one row."""
    one = lambda df: df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return products.agg(F.count(F.lit(1)).alias("products")).select(
        "products", one(deals.select("barcode").distinct()).alias("promo_products"),
        one(chains).alias("chains"), one(stores).alias("stores"))


def store_directory(stores: DataFrame) -> DataFrame:
    """Name, city and priced items of every store; blanks for absent text."""
    return stores.select(
        "chain_id", "store_id", F.coalesce("store_name", F.lit("")).alias("name"),
        F.coalesce("city", F.lit("")).alias("city"), "priced_items")
