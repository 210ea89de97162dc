"""Offers: merging on terms, pruning dominated ones, deals and listings.

An offer is identified by its terms. Which branches honour it is a separate
link table (terms, store_id), so no task ever holds a whole branch list unless
a published document asks for one.
"""

from __future__ import annotations

import base64
import json

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions import money, text
from shelfwise.operators.numbering import number_rows
from shelfwise.operators.prices import ITEM_KEY, shelf_prices
from shelfwise.operators.spread import (
    FEW_KEYS_WAYS, exists_join, grouped, hashed_join, lookup_join, many_first, min_by_order, spread_join,
)
from shelfwise.session import cut_lineage

BUILD_TERMS = ["chain_id", "barcode", "club", "coupon", "min_qty", "agorot"]
READ_TERMS = ["chain_id", "barcode", "club", "coupon", "min_qty", "unit_agorot"]
CONTEST = ["chain_id", "barcode", "club", "coupon"]


# --- build side --------------------------------------------------------------


def attribute_brands(offers: DataFrame, stores: DataFrame) -> DataFrame:
    """Replace a parent chain id by the split id of the branch it names."""
    split = stores.filter(F.col("chain_id").rlike("^.+-.+$")).select(
        F.regexp_extract("chain_id", "^(.+)-[^-]+$", 1).alias("_parent"),
        F.col("store_id").alias("_store"), F.col("chain_id").alias("_brand"),
    ).distinct()
    keyed = offers.withColumns({"_parent": F.col("chain_id"), "_store": F.col("store_id")})
    joined = lookup_join(keyed, split, ["_parent", "_store"], ["barcode"])
    return joined.withColumn("chain_id", F.coalesce("_brand", "chain_id")).drop("_parent", "_store", "_brand")


def split_priced(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Offers with a known total, and those waiting for a shelf price."""
    waiting = F.coalesce(F.col("unpriced_qty") > 0, F.lit(False))
    return rows.filter(~waiting), rows.filter(waiting)


def merge_offers(rows: DataFrame) -> DataFrame:
    """One offer per terms: widest dates, shortest text and its promotion id."""
    worded = text.blank_to_null(F.col("description"))
    wording = F.min(F.when(worded.isNotNull(), F.struct(
        F.length(worded).alias("n"), worded.alias("description"), F.col("promo_id"))))
    merged = rows.groupBy(*many_first(BUILD_TERMS)).agg(
        F.min("starts").alias("starts"), F.max("ends").alias("ends"),
        wording.alias("_w"), F.min("promo_id").alias("_p"),
    )
    return merged.select(
        *BUILD_TERMS,
        money.per_unit(F.col("agorot"), F.col("min_qty")).alias("unit_agorot"),
        F.coalesce("_w.promo_id", "_p").alias("promo_id"),
        F.col("_w.description").alias("description"), "starts", "ends",
    )


def offer_links(rows: DataFrame, terms: list[str] = BUILD_TERMS) -> DataFrame:
    return rows.select(*terms, "store_id").distinct()


def resolve_shelf_offers(staged: DataFrame, base: DataFrame, exc: DataFrame) -> DataFrame:
    """Finish staged offers with the branch's own shelf price.

    Total = known + quantity at shelf, to an agora. A branch that does not
    stock the item drops out; one campaign may become several offers.
    """
    priced = shelf_prices(staged, base, exc).filter(F.col("shelf").isNotNull())
    total = F.round(
        F.col("known_agorot").cast("decimal(18,3)")
        + F.col("unpriced_qty").cast("decimal(10,3)") * F.col("shelf").cast("decimal(12,0)"), 0,
    )
    return priced.withColumn("agorot", total.cast("bigint")).drop("shelf")


def group_resolved(resolved: DataFrame) -> DataFrame:
    """Resolved rows as offers: least id, least text, widest dates."""
    out = resolved.groupBy(*many_first(BUILD_TERMS)).agg(
        F.min("promo_id").alias("promo_id"), F.min("description").alias("description"),
        F.min("starts").alias("starts"), F.max("ends").alias("ends"),
    ).select(*BUILD_TERMS, "promo_id", "description", "starts", "ends")
    return out.withColumn("unit_agorot", money.per_unit(F.col("agorot"), F.col("min_qty")))


def add_new_offers(offers: DataFrame, resolved: DataFrame) -> DataFrame:
    """Add offers whose terms are not known yet; known ones stay as they are.

    Both sides meet once by their terms: with a test of absence before a union, the known offers would be made twice.
    """
    said = [c for c in offers.columns if c not in BUILD_TERMS]
    new = group_resolved(resolved).select(*BUILD_TERMS, *[F.col(c).alias(f"_new_{c}") for c in said])
    both = offers.withColumn("_known", F.lit(True)).join(new, many_first(BUILD_TERMS), "full_outer")
    known = F.coalesce("_known", F.lit(False))
    return both.select(*[c if c in BUILD_TERMS else F.when(known, F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c) for c in offers.columns])


def relink(links: DataFrame, resolved: DataFrame) -> DataFrame:
    return links.unionByName(offer_links(resolved)).distinct()


def build_offers(rows: DataFrame, base: DataFrame, exc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Offer rows of every branch to (offers, links)."""
    # The rows and what they resolve to are read for the offers and again for the links, so they are made once.
    priced, staged = split_priced(cut_lineage(rows))
    resolved = cut_lineage(resolve_shelf_offers(staged, base, exc))
    offers = add_new_offers(merge_offers(priced), resolved)
    return offers, relink(offer_links(priced), resolved)


def compression(rows: DataFrame) -> DataFrame:
    """Published rows, distinct promotion ids and distinct offers."""
    by_terms = rows.groupBy(*BUILD_TERMS).agg(F.count(F.lit(1)).alias("n"))
    ids = rows.select("chain_id", "promo_id").distinct().agg(F.count(F.lit(1)).alias("promo_ids"))
    return by_terms.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("published_rows"),
        F.count(F.lit(1)).alias("distinct_offers"),
    ).withColumn("promo_ids", ids.scalar())


# --- read side ---------------------------------------------------------------


def read_merge(offers: DataFrame, links: DataFrame, today: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Merge live offers on unit price.

    Returns (merged offers, their links, branches with any offer at all).
    Expired offers count only for the last of these.
    """
    # Read three times, so it is joined once.
    said = [*BUILD_TERMS, "unit_agorot", "description", "starts", "ends"]
    linked = cut_lineage(links.join(offers.select(*said), many_first(BUILD_TERMS)).select(*said, "store_id"))
    everywhere = linked.select("chain_id", "store_id").distinct()
    qty, unit = money.effective_terms(F.col("min_qty"), F.col("agorot"))
    # An offer whose quantity is not a weight keeps its own unit price.
    unit = F.when(F.col("min_qty") < 1, unit).otherwise(F.col("unit_agorot"))
    live = F.col("ends").isNull() | (F.col("ends") >= F.lit(today).cast("date"))
    repaired = linked.filter(live).withColumns({"_qty": qty, "_unit": unit})
    repaired = repaired.drop("min_qty", "unit_agorot").withColumnsRenamed(
        {"_qty": "min_qty", "_unit": "unit_agorot"})
    worded = text.blank_to_null(F.col("description"))
    merged = grouped(repaired, READ_TERMS).agg(
        F.min("agorot").alias("agorot"), F.min("starts").alias("starts"), F.max("ends").alias("ends"),
        F.min(F.when(worded.isNotNull(), F.struct(F.length(worded).alias("n"), worded.alias("d")))).alias("_w"),
    ).withColumn("description", F.col("_w.d")).drop("_w", "_key")
    return merged, repaired.select(*READ_TERMS, "store_id").distinct(), everywhere


def best_somewhere(links: DataFrame) -> DataFrame:
    """Terms that no other offer undercuts at some branch (survivors).

    Per branch the least (unit price, quantity) wins; an offer survives when it
    wins anywhere.
    """
    order = [F.col("unit_agorot"), F.col("min_qty")]
    winners = min_by_order(links, [*CONTEST, "store_id"], order, ["unit_agorot", "min_qty"])
    return winners.select(*READ_TERMS).distinct()


def prune_dominated(merged: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Survivors with their full branch lists."""
    kept = cut_lineage(best_somewhere(links))
    return hashed_join(merged, kept, READ_TERMS, "left_semi"), hashed_join(links, kept, READ_TERMS, "left_semi")


def build_deals(kept: DataFrame, base: DataFrame, products: DataFrame, chain_products: DataFrame,
                categories: DataFrame, group: list[str] | None = None,
                out: str = "deal_id") -> DataFrame:
    """Survivors with base price, category, name, discount and ``out``, numbered over all chains or within ``group``."""
    prices = base.select(*ITEM_KEY, F.col("agorot").alias("base_agorot"))
    own = chain_products.select(*ITEM_KEY, F.col("name").alias("_own"))
    common = products.select("barcode", F.col("name").alias("_common"))
    named = hashed_join(hashed_join(kept, prices, ITEM_KEY, "left"), own, ITEM_KEY, "left")
    named = lookup_join(named, common, ["barcode"], ["chain_id", "unit_agorot"])
    named = lookup_join(named, categories.select("barcode", "category_id"), ["barcode"], ["chain_id", "unit_agorot"])
    deals = named.withColumns({
        "name": F.coalesce(text.blank_to_null(F.col("_own")), F.col("_common")),
        "discount_tenths": money.discount_tenths(F.col("unit_agorot"), F.col("base_agorot")),
    }).drop("_own", "_common")
    order = [c for c in ("chain_id", "barcode", "club", "coupon", "unit_agorot", "min_qty") if c not in (group or [])]
    return number_rows(deals, group or [], order, out)


def deal_branches(deals: DataFrame, links: DataFrame) -> DataFrame:
    return links.join(deals.select("deal_id", *READ_TERMS), READ_TERMS).select("deal_id", "chain_id", "store_id")


def best_deal_per_product(deals: DataFrame) -> DataFrame:
    """Lowest unit price per barcode among real discounts, and its chain count."""
    real = deals.filter("discount_tenths > 0")
    per_chain = min_by_order(
        real, ITEM_KEY, [F.col("unit_agorot"), F.col("deal_id")],
        ["deal_id", "category_id", "name", "base_agorot", "unit_agorot", "agorot", "min_qty",
         "club", "coupon", "ends", "description", "discount_tenths"],
    )
    cols = [c for c in per_chain.columns if c not in ("barcode", "unit_agorot", "deal_id")]
    best = per_chain.groupBy("barcode").agg(
        F.min(F.struct("unit_agorot", "deal_id", *cols)).alias("b"),
        F.count(F.lit(1)).alias("chains_on_deal"),
    )
    return best.select("barcode", "b.*", "chains_on_deal")


# --- listings ----------------------------------------------------------------


def encode_cursor(*values) -> str:
    raw = json.dumps(list(values), ensure_ascii=False).encode()
    return base64.urlsafe_b64encode(raw).decode().rstrip("=")


def decode_cursor(cursor: str, *types: type) -> list:
    """Values of a cursor; ``ValueError`` unless it has just these types."""
    try:
        values = json.loads(base64.urlsafe_b64decode(cursor + "=" * (-len(cursor) % 4)))
    except (ValueError, UnicodeDecodeError) as err:
        raise ValueError(f"bad cursor: {err}") from err
    if not isinstance(values, list) or [type(v) for v in values] != list(types):
        raise ValueError("bad cursor: unexpected content")
    return values


def after(discount: Column, deal: Column, cursor: str | None) -> Column:
    if cursor is None:
        return F.lit(True)
    tenths, deal_id = decode_cursor(cursor, int, int)
    return (discount < tenths) | ((discount == tenths) & (deal > deal_id))


def list_deals(best: DataFrame, limit: int = 24, cursor: str | None = None,
               category_id: int | None = None, matching: DataFrame | None = None) -> DataFrame:
    """A page over best deals of all chains, one row more than ``limit``."""
    rows = best
    if category_id is not None:
        rows = rows.filter(F.col("category_id") == category_id)
    if matching is not None:
        rows = exists_join(rows, matching, ["barcode"], ["deal_id"])
    rows = rows.filter(after(F.col("discount_tenths"), F.col("deal_id"), cursor))
    return rows.orderBy(F.desc("discount_tenths"), "deal_id").limit(limit + 1)


def list_chain_deals(deals: DataFrame, branches: DataFrame, chain_id: str, store_id: str | None = None,
                     category_id: int | None = None, matching: DataFrame | None = None,
                     limit: int | None = 24, cursor: str | None = None, bits: DataFrame | None = None) -> DataFrame:
    """Best offer per product of a chain, or of one branch of it.

    At a branch only offers that run there compete. Without a branch the number
    of branches of the shown offer is added, and with ``bits`` (:func:`store_bits`)
    that of all branches of the chain.
    """
    rows = deals.filter((F.col("chain_id") == chain_id) & (F.col("discount_tenths") > 0))
    if category_id is not None:
        rows = rows.filter(F.col("category_id") == category_id)
    here = branches.filter(F.col("chain_id") == chain_id)
    if store_id is not None:
        here = here.filter(F.col("store_id") == store_id)
        rows = rows.join(here.select("deal_id"), "deal_id", "left_semi")
    if matching is not None:
        rows = exists_join(rows, matching, ["barcode"], ["deal_id"])
    cols = [c for c in rows.columns if c != "barcode"]
    best = min_by_order(rows, ["barcode"], [F.col("unit_agorot"), F.col("deal_id")], cols)
    best = best.filter(after(F.col("discount_tenths"), F.col("deal_id"), cursor))
    ordered = [F.desc("discount_tenths"), F.col("deal_id")]
    if limit is not None:
        best = best.orderBy(*ordered).limit(limit + 1)
    if store_id is None:
        counts = here.join(best.select("deal_id"), "deal_id", "left_semi").groupBy("deal_id").agg(
            F.count(F.lit(1)).alias("branches_on_deal"))
        best = best.join(counts, "deal_id", "left")
        if bits is not None:
            best = best.withColumn("branches_total", bits.filter(F.col("chain_id") == chain_id).agg(F.count(F.lit(1)).alias("n")).scalar())
    return best.orderBy(*ordered)


def chain_deals_every_chain(deals: DataFrame) -> DataFrame:
    """The chain listing for all chains at once."""
    real = deals.filter("discount_tenths > 0")
    cols = [c for c in real.columns if c not in ITEM_KEY]
    return min_by_order(real, ITEM_KEY, [F.col("unit_agorot"), F.col("deal_id")], cols)


def branch_deals_every_branch(deals: DataFrame, branches: DataFrame) -> DataFrame:
    """The branch listing for all branches at once."""
    real = deals.filter("discount_tenths > 0")
    at = branches.select("deal_id", "store_id").join(
        real.select("deal_id", *ITEM_KEY, "unit_agorot", "discount_tenths"), "deal_id")
    return min_by_order(
        at, [*ITEM_KEY, "store_id"], [F.col("unit_agorot"), F.col("deal_id")],
        ["deal_id", "unit_agorot", "discount_tenths"])


def live_promotions(chain_id: str, today: str, offers: DataFrame, products: DataFrame) -> DataFrame:
    """Open promotions of one chain with product names, cheapest first."""
    open_now = offers.filter(
        (F.col("chain_id") == chain_id) & (F.col("ends").isNull() | (F.col("ends") >= F.lit(today).cast("date"))))
    named = lookup_join(open_now, products.select("barcode", "name"), ["barcode"], ["agorot"], "inner")
    return named.select("description", "name", "barcode", "agorot", "min_qty").orderBy("agorot", "barcode")


# --- published branch lists --------------------------------------------------


def branch_modes(links: DataFrame, everywhere: DataFrame) -> DataFrame:
    """How each offer's branches are said: ``all``, ``only`` or ``except``.

    The shorter list is the one to write; none when it runs everywhere.
    """
    reach = everywhere.groupBy("chain_id").agg(F.count(F.lit(1)).alias("_all"))
    runs = links.groupBy(*READ_TERMS).agg(F.count(F.lit(1)).alias("runs_at"))
    sized = lookup_join(runs, reach, ["chain_id"], ["barcode"], "inner", FEW_KEYS_WAYS)
    missing = F.col("_all") - F.col("runs_at")
    mode = F.when(missing == 0, "all").when(missing < F.col("runs_at"), "except").otherwise("only")
    return sized.select(*READ_TERMS, "runs_at", missing.alias("missing_at"), mode.alias("mode"))


def branch_listing(links: DataFrame, everywhere: DataFrame, modes: DataFrame) -> DataFrame:
    """One row per listed branch of each offer.

    An ``except`` offer misses fewer branches than it has, so pairing it with
    its chain's branches gives less than twice its own link rows.
    """
    said = modes.select(*READ_TERMS, "mode").filter("mode <> 'all'")
    only = links.join(said.filter("mode = 'only'"), READ_TERMS).select(*READ_TERMS, "mode", "store_id")
    absent = said.filter("mode = 'except'")
    pairs = spread_join(absent, everywhere, ["chain_id"], ["barcode", "unit_agorot", "club", "coupon"], "inner",
                        FEW_KEYS_WAYS)
    missing = pairs.join(links, [*READ_TERMS, "store_id"], "left_anti")
    return only.unionByName(missing.select(*READ_TERMS, "mode", "store_id"))


def runs_at(store_id: Column, only: Column, excluded: Column) -> Column:
    """Does a published offer run at a branch? Lists may be null."""
    return F.coalesce(F.array_contains(only, store_id), ~F.array_contains(excluded, store_id), F.lit(True))


def promotion_entries(kept: DataFrame, modes: DataFrame, listing: DataFrame, today: str) -> DataFrame:
    """Published form of each offer: keys that say nothing are null."""
    lists = listing.groupBy(*READ_TERMS).agg(F.sort_array(F.collect_list("store_id")).alias("_stores"))
    rows = kept.join(modes, READ_TERMS).join(lists, READ_TERMS, "left")
    many = F.col("min_qty") != 1
    return rows.select(
        "chain_id", "barcode", *[c for c in ("club", "coupon") if c in rows.columns], "min_qty", "unit_agorot",
        F.struct(
            money.to_shekels(F.col("unit_agorot")).alias("u"),
            F.coalesce("description", F.lit("")).alias("d"),
            F.coalesce(F.col("ends").cast("string"), F.lit("")).alias("e"),
            F.when(many, F.col("min_qty")).alias("q"),
            F.when(many, money.to_shekels(F.col("agorot"))).alias("t"),
            F.when(F.col("club") == 1, 1).alias("c"),
            F.when(F.col("coupon") == 1, 1).alias("k"),
            F.when(F.col("starts") > F.lit(today).cast("date"), F.col("starts").cast("string")).alias("b"),
            F.when(F.col("mode") == "only", F.col("_stores")).alias("s"),
            F.when(F.col("mode") == "except", F.col("_stores")).alias("x"),
        ).alias("offer"),
    )


# --- branch numbers ----------------------------------------------------------


def store_bits(stores: DataFrame, offer_stores: DataFrame) -> DataFrame:
    """Dense numbers 0..n-1 per chain over every branch known from anywhere."""
    known = stores.select("chain_id", "store_id").union(offer_stores.select("chain_id", "store_id")).distinct()
    return number_rows(known, ["chain_id"], ["store_id"], "bit", start=0)


def branches_without_bit(branches: DataFrame, bits: DataFrame) -> DataFrame:
    """Must be empty: a branch that the numbering does not cover."""
    return branches.select("chain_id", "store_id").distinct().join(bits, ["chain_id", "store_id"], "left_anti")


def branch_bitmaps(branches: DataFrame, bits: DataFrame) -> DataFrame:
    """Export form: bitmap chunks per deal, 32,768 branches to a chunk.

    The numbers of a deal meet before its bitmaps are made: a bitmap has four kilobytes whatever is in it, so none is shuffled or sorted.
    """
    numbered = lookup_join(branches, bits, ["chain_id", "store_id"], ["deal_id"], "inner").repartition("deal_id")
    return numbered.groupBy("deal_id", F.bitmap_bucket_number(F.col("bit")).alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit"))).alias("bitmap"))
