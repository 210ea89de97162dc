"""Price observations, the modal baseline, exceptions and effective prices.

Tables used here (money in agorot):
  observations  chain_id, store_id, barcode, agorot, arrival columns
  baselines     chain_id, barcode, agorot, store_count
  exceptions    chain_id, store_id, barcode, agorot
  stores        chain_id, store_id, ...
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions import money, text
from shelfwise.operators.spread import (
    FEW_KEYS_WAYS, exists_join, fits_broadcast, hashed_join, lookup_join, max_by_order, spread_join,
)
from shelfwise.session import cut_lineage

STORE_KEY = ["chain_id", "store_id"]
ITEM_KEY = ["chain_id", "barcode"]
PRICE_KEY = ["chain_id", "store_id", "barcode"]


# --- from raw rows -----------------------------------------------------------


def price_rows(raw: DataFrame) -> DataFrame:
    """Raw price rows (any known spelling) to typed, valid observations."""
    keep = [c for c in raw.columns if c.startswith("_")]
    rows = raw.select(
        text.digits(F.coalesce(text.pick(raw, "chainid", "chain_id"), F.lit(""))).alias("chain_id"),
        F.coalesce(text.pick(raw, "subchainid", "subchain_id"), F.lit("")).alias("subchain_id"),
        text.store_code(F.coalesce(text.pick(raw, "storeid", "store_id"), F.lit(""))).alias("store_id"),
        text.digits(F.coalesce(text.pick(raw, "itemcode", "item_code"), F.lit(""))).alias("barcode"),
        money.to_agorot(text.pick(raw, "itemprice", "item_price")).alias("agorot"),
        F.trim(text.pick(raw, "itemname", "item_name", "manufactureitemdescription")).alias("name"),
        text.pick(raw, "manufacturername", "manufacturename").alias("manufacturer"),
        text.pick(raw, "unitqty", "unit_qty").alias("unit_qty"),
        text.number(text.pick(raw, "quantity")).cast("decimal(10,3)").alias("quantity"),
        text.pick(raw, "unitofmeasure", "unit_of_measure").alias("unit_of_measure"),
        text.flag(text.pick(raw, "bisweighted", "isweighted")).alias("is_weighted"),
        *keep,
    )
    return valid_prices(rows)


def valid_prices(rows: DataFrame) -> DataFrame:
    return rows.filter(
        (F.length("barcode") >= 6) & (F.col("agorot") > 0) & (F.col("chain_id") != "")
    )


def store_rows(raw: DataFrame) -> DataFrame:
    """Raw store rows to typed rows; chain and branch must be present."""
    keep = [c for c in raw.columns if c.startswith("_")]
    store = text.pick(raw, "storeid", "store_id")
    city = text.pick(raw, "city", "cityname")
    rows = raw.select(
        text.digits(F.coalesce(text.pick(raw, "chainid", "chain_id"), F.lit(""))).alias("chain_id"),
        F.when(store.isNotNull(), text.store_code(store)).alias("store_id"),
        F.coalesce(text.pick(raw, "subchainid", "subchain_id"), F.lit("")).alias("subchain_id"),
        text.pick(raw, "chainname", "chain_name").alias("chain_name"),
        text.pick(raw, "storename", "store_name").alias("store_name"),
        city.alias("city"),
        text.pick(raw, "address").alias("address"),
        *keep,
    )
    return rows.filter((F.col("chain_id") != "") & F.col("store_id").isNotNull())


def product_rows(observations: DataFrame, order: list[str]) -> DataFrame:
    """Last named row per barcode in arrival order."""
    named = observations.filter(F.coalesce(F.col("name"), F.lit("")) != "")
    cols = ["name", "manufacturer", "unit_qty", "quantity", "unit_of_measure", "is_weighted"]
    return max_by_order(named, ["barcode"], [F.col(c) for c in order], cols)


# --- chain identity ----------------------------------------------------------


def split_chains(rows: DataFrame, brands: DataFrame) -> DataFrame:
    """Give rows of a listed sub-brand the id ``<chain>-<sub>``.

    ``brands``: chain_id, sub (three digits), brand_name. Unlisted sub-brands
    keep the parent id.
    """
    listed = brands.select("chain_id", F.col("sub").alias("_sub"), "brand_name").distinct()
    keyed = rows.withColumn(
        "_sub", F.lpad(F.trim(F.coalesce(F.col("subchain_id"), F.lit(""))), 3, "0")
    )
    spread = "barcode" if "barcode" in rows.columns else "store_id"
    joined = lookup_join(keyed, listed, ["chain_id", "_sub"], [spread])
    split = F.when(F.col("brand_name").isNotNull(), F.concat_ws("-", "chain_id", "_sub"))
    return joined.withColumn("chain_id", F.coalesce(split, F.col("chain_id"))).drop("_sub")


def correct_chain_ids(rows: DataFrame, aliases: DataFrame, spread_by: list[str]) -> DataFrame:
    """Replace ids published by mistake. ``aliases``: source, wrong_id, right_id.

    A row with a ``source`` column is corrected only by aliases of its source.
    """
    keys = ["source", "chain_id"] if "source" in rows.columns else ["chain_id"]
    fixes = aliases.withColumnRenamed("wrong_id", "chain_id").select(*keys, "right_id").distinct()
    joined = lookup_join(rows, fixes, keys, spread_by)
    return joined.withColumn("chain_id", F.coalesce("right_id", "chain_id")).drop("right_id")


def drop_aliased(dimension: DataFrame, aliases: DataFrame) -> DataFrame:
    """Chain and store rows of a mistaken id are removed, not renamed."""
    keys = ["source", "chain_id"] if "source" in dimension.columns else ["chain_id"]
    wrong = aliases.withColumnRenamed("wrong_id", "chain_id").select(*keys).distinct()
    return dimension.join(wrong, keys, "left_anti")


def chain_names(chains: DataFrame, brands: DataFrame, display: DataFrame) -> DataFrame:
    """Brand name, else the file's name, else a display name, else the source.

    ``chains``: chain_id, file_name, source. ``brands``: chain_id, brand_name.
    ``display``: chain_id, display_name.
    """
    out = chains.join(brands.select("chain_id", "brand_name"), "chain_id", "left")
    out = out.join(display.select("chain_id", "display_name"), "chain_id", "left")
    return out.select(
        "chain_id",
        F.coalesce(*[text.blank_to_null(F.col(c)) for c in
                     ("brand_name", "file_name", "display_name", "source")]).alias("name"),
    )


def resolve_cities(stores: DataFrame, city_codes: DataFrame) -> DataFrame:
    """Add ``city_name``: code looked up, name squeezed, placeholders null.

    ``city_codes``: code, city_name.
    """
    raw = F.trim(F.coalesce(F.col("city"), F.lit("")))
    is_code = raw.rlike("^[0-9]+$")
    coded = stores.withColumn("_code", F.when(is_code, text.store_code(raw)))
    names = city_codes.select(F.col("code").alias("_code"), F.col("city_name").alias("_named"))
    joined = lookup_join(coded, names, ["_code"], ["store_id"])
    empty = F.lower(raw).isin(*text.NO_CITY)
    return joined.withColumn(
        "city_name", F.when(empty, None).when(is_code, F.col("_named")).otherwise(text.squeeze(raw))
    ).drop("_code", "_named")


def locate_stores(stores: DataFrame, branch_ids: DataFrame, locations: DataFrame) -> DataFrame:
    """Add branch_uid and its coordinates; absent means null.

    ``branch_ids``: chain_id, store_id, branch_uid. ``locations``: branch_uid,
    lat, lon, precision.
    """
    with_uid = stores.join(branch_ids, STORE_KEY, "left")
    return with_uid.join(locations.select("branch_uid", "lat", "lon", "precision"), "branch_uid", "left")


# --- collapse ----------------------------------------------------------------


def latest_prices(observations: DataFrame, order: list[str]) -> DataFrame:
    """Last observation per (chain, store, barcode) in arrival order."""
    return max_by_order(observations, PRICE_KEY, [F.col(c) for c in order], ["agorot"])


def price_support(latest: DataFrame) -> DataFrame:
    """Number of stores charging each price of an item."""
    return latest.groupBy(*ITEM_KEY, "agorot").agg(F.count(F.lit(1)).alias("store_count"))


def baselines(latest: DataFrame) -> DataFrame:
    """Price charged by most stores; on a tie the lower price."""
    return max_by_order(
        price_support(latest), ITEM_KEY,
        [F.col("store_count"), -F.col("agorot")], ["agorot", "store_count"],
    )


def exceptions(latest: DataFrame, base: DataFrame) -> DataFrame:
    """Observations that differ from their item's baseline.

    An item has at most one row per store of its chain, so the baselines need no copies under salts.
    """
    unique = base.select(*ITEM_KEY, F.col("agorot").alias("_base"))
    joined = lookup_join(latest, unique, ITEM_KEY, ["store_id"], "inner", ways=1)
    return joined.filter(F.col("agorot") != F.col("_base")).select(*PRICE_KEY, "agorot")


def priced_items(latest: DataFrame, stores: DataFrame) -> DataFrame:
    """Add ``priced_items`` to stores; none published is 0."""
    counts = latest.groupBy(*STORE_KEY).agg(F.count(F.lit(1)).alias("priced_items"))
    return stores.join(counts, STORE_KEY, "left").withColumn(
        "priced_items", F.coalesce("priced_items", F.lit(0).cast("bigint"))
    )


def drop_priceless(table: DataFrame, base: DataFrame, spread_by: list[str]) -> DataFrame:
    """Rows of chains that have at least one baseline price."""
    return lookup_join(table, base.select("chain_id").distinct(), ["chain_id"], spread_by, "left_semi", FEW_KEYS_WAYS)


# --- effective prices --------------------------------------------------------


def effective_prices(stores: DataFrame, base: DataFrame, exc: DataFrame) -> DataFrame:
    """Every store of a chain with every baseline item, exception first.

    The fan-out is the result itself. While the store list is small enough to send to every task, an item's rows are made
    where its baseline is, less the stores that price it apart, and never move again; what an item can have of these
    is bounded by that list. With a longer list the baselines meet the stores by chain, spread by item.
    """
    shops = stores.select(*STORE_KEY, *[c for c in ("city", "store_name", "priced_items") if c in stores.columns])
    if not fits_broadcast(shops):
        items = base.select(*ITEM_KEY, F.col("agorot").alias("_base"))
        fanned = spread_join(items, shops, ["chain_id"], ["barcode"], "inner", FEW_KEYS_WAYS)
        own = exc.select(*PRICE_KEY, F.col("agorot").alias("_own"))
        priced = hashed_join(fanned, own, PRICE_KEY, "left")
        return priced.withColumn("agorot", F.coalesce("_own", "_base")).drop("_own", "_base")
    rest, order = [c for c in shops.columns if c not in STORE_KEY], [*STORE_KEY, *[c for c in shops.columns if c not in STORE_KEY], "barcode", "agorot"]
    listed = shops.groupBy("chain_id").agg(F.collect_set("store_id").alias("_all"))
    apart = exc.groupBy(*ITEM_KEY).agg(F.collect_list(F.struct("store_id", "agorot")).alias("_apart"))
    items = base.select(*ITEM_KEY, "agorot").join(apart, ITEM_KEY, "left").join(F.broadcast(listed), "chain_id")
    own = F.coalesce("_apart", F.array().cast("array<struct<store_id:string,agorot:bigint>>"))
    at_base = F.transform(F.array_except("_all", F.transform(own, lambda e: e["store_id"])), lambda s: F.struct(s.alias("store_id"), F.col("agorot")))
    rows = items.select(*ITEM_KEY, F.explode(F.concat(own, at_base)).alias("_r")).select(*ITEM_KEY, "_r.store_id", "_r.agorot")
    # Exceptions of stores that are not asked for go here.
    return rows.join(F.broadcast(shops), STORE_KEY).select(*order) if rest else rows.join(F.broadcast(shops), STORE_KEY, "left_semi").select(*order)


def observed_prices(latest: DataFrame, stores: DataFrame) -> DataFrame:
    """Strict form: only prices that the store itself published."""
    return exists_join(latest, stores, STORE_KEY, ["barcode"])


def cheapest_by_barcode(stores: DataFrame, base: DataFrame, exc: DataFrame) -> DataFrame:
    """Lowest effective price of each barcode and how many chains sell it.

    Same answer as the minimum over :func:`effective_prices` without the
    fan-out: a baseline counts where some store of the chain has no exception.
    """
    shop_counts = stores.groupBy("chain_id").agg(F.count(F.lit(1)).alias("_shops"))
    own = exists_join(exc, stores, STORE_KEY, ["barcode"])
    per_item = own.groupBy(*ITEM_KEY).agg(
        F.count(F.lit(1)).alias("_own_shops"), F.min("agorot").alias("_own_min")
    )
    items = lookup_join(base, shop_counts, ["chain_id"], ["barcode"], "inner", FEW_KEYS_WAYS)
    joined = items.join(per_item, ITEM_KEY, "left")
    at_base = F.when(F.coalesce("_own_shops", F.lit(0)) < F.col("_shops"), F.col("agorot"))
    return (
        joined.withColumn("_low", F.least(at_base, F.col("_own_min")))
        .groupBy("barcode")
        .agg(F.min("_low").alias("cheapest_agorot"), F.count(F.lit(1)).alias("chains"))
    )


def cheapest_rows(stores: DataFrame, base: DataFrame, exc: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` cheapest effective prices by price, item, chain and store, without the fan-out.

    A row at its chain's price is among them only if its item is among the first ``limit`` items that some store sells at
    that price, since each of these has a row before it. So only that many items are paired with their stores.
    """
    order = ["agorot", "barcode", "chain_id"]
    shops = stores.select(*STORE_KEY).distinct()
    own = cut_lineage(exists_join(exc, shops, STORE_KEY, ["barcode"]))
    apart = own.orderBy(*order, "store_id").limit(limit).select(*ITEM_KEY, "store_id", "agorot")
    counts = shops.groupBy("chain_id").agg(F.count(F.lit(1)).alias("_shops"))
    taken = own.groupBy(*ITEM_KEY).agg(F.count(F.lit(1)).alias("_apart"))
    items = lookup_join(base, counts, ["chain_id"], ["barcode"], "inner", FEW_KEYS_WAYS).join(taken, ITEM_KEY, "left")
    open_items = items.filter(F.coalesce("_apart", F.lit(0)) < F.col("_shops")).orderBy(*order).limit(limit).select(*ITEM_KEY, "agorot")
    at_base = shops.join(F.broadcast(open_items), "chain_id").join(own.select(*ITEM_KEY, "store_id"), [*ITEM_KEY, "store_id"], "left_anti")
    return at_base.select(*apart.columns).unionByName(apart).orderBy(*order, "store_id").limit(limit)


def cheapest_in_city(word: str, city: str, products: DataFrame, tokens: DataFrame, chains: DataFrame,
                     stores: DataFrame, base: DataFrame, exc: DataFrame, limit: int = 50) -> DataFrame:
    """Cheapest items with a word in the name at the stores of one city."""
    hits = tokens.filter(F.col("token") == word).select("barcode").distinct()
    items = lookup_join(base, hits, ["barcode"], ["chain_id"], "left_semi")
    shops = stores.filter(F.col("city") == city)
    prices = effective_prices(shops, items, lookup_join(exc, hits, ["barcode"], ["store_id"], "left_semi"))
    named = lookup_join(prices, products.select("barcode", "name"), ["barcode"], ["store_id"], "inner")
    labels = chains.select("chain_id", F.col("name").alias("chain"))
    return (
        lookup_join(named, labels, ["chain_id"], ["barcode"], "inner", FEW_KEYS_WAYS)
        .select("name", "chain", "store_name", "store_id", "barcode", "agorot")
        .orderBy("agorot", "barcode", "chain", "store_id")
        .limit(limit)
    )


def barcode_across_chains(barcode: str, base: DataFrame, chains: DataFrame) -> DataFrame:
    labels = chains.select("chain_id", F.col("name").alias("chain"))
    return (
        base.filter(F.col("barcode") == barcode).join(labels, "chain_id")
        .select("chain", "agorot", "store_count").orderBy("agorot", "chain")
    )


def price_gaps(base: DataFrame) -> DataFrame:
    """Each chain's price of a barcode over the cheapest chain's."""
    lowest = base.groupBy("barcode").agg(F.min("agorot").alias("_low"))
    joined = base.join(lowest, "barcode")
    return joined.select(
        "barcode", "chain_id", "agorot", (F.col("agorot") - F.col("_low")).alias("gap_agorot")
    )


def price_tiers(base: DataFrame, exc: DataFrame) -> DataFrame:
    """Stores per price of an item: one row per exception price, one baseline."""
    own = exc.groupBy(*ITEM_KEY, "agorot").agg(F.count(F.lit(1)).alias("branches")).withColumn(
        "is_baseline", F.lit(0)
    )
    usual = base.filter("store_count > 0").select(
        *ITEM_KEY, "agorot", F.col("store_count").alias("branches"), F.lit(1).alias("is_baseline")
    )
    return own.unionByName(usual)


def tier_stores(exc: DataFrame) -> DataFrame:
    """The stores behind each exception tier, one row per store."""
    return exc.select(*ITEM_KEY, "agorot", "store_id")


def shelf_prices(rows: DataFrame, base: DataFrame, exc: DataFrame) -> DataFrame:
    """Add ``shelf``: the store's own price, else its chain's, else null.

    Several rows may ask for one store and item, so both lookups are unique on
    their keys and the asking side is spread.
    """
    own = exc.select(*PRICE_KEY, F.col("agorot").alias("_own"))
    usual = base.select(*ITEM_KEY, F.col("agorot").alias("_base"))
    priced = hashed_join(rows, own, PRICE_KEY, "left")
    if fits_broadcast(usual):
        priced = priced.join(F.broadcast(usual), ITEM_KEY, "left")
    else:
        # Stored, so that the shuffles of the one join are gone before those of the other.
        priced = spread_join(cut_lineage(priced), usual, ITEM_KEY, ["store_id"], "left")
    return priced.withColumn("shelf", F.coalesce("_own", "_base")).drop("_own", "_base")
