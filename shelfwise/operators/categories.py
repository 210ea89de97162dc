"""Placing products in the taxonomy from the chains' own category paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.functions import text
from shelfwise.operators.numbering import number_rows
from shelfwise.operators.spread import FEW_KEYS_WAYS, lookup_join, min_by_order

# Most specific first: the keys a rule of each level is looked up by.
LADDER = [
    ("leaf", ["dept", "cat", "leaf"]),
    ("pair_override", ["dept", "cat"]),
    ("pair", ["dept", "cat"]),
    ("department", ["dept"]),
    ("category_as_department", ["cat"]),
    ("root", ["root"]),
    ("fallback", ["second_level"]),
]


def split_path(products: DataFrame, roots: DataFrame) -> DataFrame:
    """Add root, dept, cat and leaf; a first part listed in ``roots`` is a root."""
    parts = text.path_parts(F.col("path"))
    first = products.withColumn("_parts", parts).withColumn("_first", F.get("_parts", F.lit(0)))
    known = roots.select(F.col("root").alias("_first"), F.lit(1).alias("_is_root")).distinct()
    marked = lookup_join(first, known, ["_first"], ["barcode"])
    shift = F.coalesce("_is_root", F.lit(0))
    at = lambda i: F.coalesce(F.get("_parts", shift + i), F.lit(""))
    return marked.withColumns({
        "root": F.when(shift == 1, F.col("_first")).otherwise(""),
        "dept": at(0), "cat": at(1), "leaf": at(2),
    }).drop("_parts", "_first", "_is_root")


def place(products: DataFrame, rules: DataFrame) -> DataFrame:
    """Add the ``slug`` of the most specific rule that speaks, else null.

    ``rules``: level, dept, cat, leaf, root, second_level, slug. The level
    ``category_as_department`` reuses the department rules on the category.
    """
    out, found = products, []
    for level, keys in LADDER:
        source = "department" if level == "category_as_department" else level
        own = ["dept"] if level == "category_as_department" else keys
        table = rules.filter(F.col("level") == source).select(
            *[F.col(o).alias(k) for o, k in zip(own, keys)], F.col("slug").alias(f"_{level}"))
        out = lookup_join(out, table.dropDuplicates(keys), keys, ["barcode"])
        found.append(F.col(f"_{level}"))
    return out.withColumn("slug", F.coalesce(*found)).drop(*[f"_{level}" for level, _ in LADDER])


def place_by_pair(products: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Products whose (chain, dept, cat) is mapped, and counts of misses."""
    part = lambda i: F.coalesce(F.trim(F.get(F.split("path", ">"), F.lit(i))), F.lit(""))
    keyed = products.withColumns({"dept": part(0), "cat": part(1)})
    table = pairs.select("chain", "dept", "cat", "slug").dropDuplicates(["chain", "dept", "cat"])
    joined = lookup_join(keyed, table, ["chain", "dept", "cat"], ["barcode"])
    misses = joined.filter("slug is null").groupBy("chain", "dept", "cat").agg(F.count(F.lit(1)).alias("products"))
    return joined.filter("slug is not null"), misses


def merge_sources(placed: DataFrame, priority: DataFrame) -> DataFrame:
    """One placement per barcode: the source with the least rank wins."""
    ranked = lookup_join(placed, priority.select("source", "rank"), ["source"], ["barcode"], "inner", FEW_KEYS_WAYS)
    return min_by_order(ranked, ["barcode"], [F.col("rank"), F.col("source")], ["slug", "source"])


def flatten_taxonomy(departments: DataFrame) -> DataFrame:
    """Ids in listed order: each department is followed by its aisles.

    ``departments``: position, slug, name_he, subs array<struct<slug, name_he>>.
    """
    tops = departments.select("position", F.lit(0).alias("at"), "slug", "name_he")
    subs = departments.select("position", F.posexplode("subs").alias("at", "s")).select(
        "position", (F.col("at") + 1).alias("at"), "s.slug", "s.name_he")
    rows = number_rows(tops.unionByName(subs), [], ["position", "at"], "id")
    heads = rows.filter("at = 0").select("position", F.col("id").alias("_top"))
    parent = F.when(F.col("at") > 0, F.col("_top"))
    return rows.join(heads, "position").select("id", "slug", "name_he", parent.alias("parent_id"))


def audit(rules: DataFrame, dumps: DataFrame, slugs: DataFrame) -> DataFrame:
    """Mapping keys with an unknown slug, or that no dump has any more.

    ``rules``: map_name, dept, cat, slug. ``dumps``: map_name, dept, cat — the
    union of the dumps of all chains that share the mapping.
    """
    unknown = rules.join(slugs.select("slug").distinct(), "slug", "left_anti")
    known = rules.join(slugs.select("slug").distinct(), "slug", "left_semi")
    key = ["map_name", "dept", "cat"]
    seen_maps = dumps.select("map_name").distinct()
    gone = known.join(seen_maps, "map_name", "left_semi").join(dumps.select(*key).distinct(), key, "left_anti")
    cols = [*key, "slug"]
    return unknown.select(*cols, F.lit("unknown slug").alias("problem")).unionByName(
        gone.select(*cols, F.lit("no longer in any dump").alias("problem")))


def totals(placed: DataFrame, categories: DataFrame) -> DataFrame:
    """Placed products per department and per source."""
    tops = categories.select(F.col("slug"), F.col("top_slug"))
    named = lookup_join(placed, tops, ["slug"], ["barcode"], "inner")
    count = F.count(F.lit(1)).alias("products")
    by_top = named.groupBy(F.col("top_slug").alias("name")).agg(count).withColumn("kind", F.lit("department"))
    by_source = placed.groupBy(F.col("source").alias("name")).agg(count).withColumn("kind", F.lit("source"))
    return by_top.unionByName(by_source)


def top_misses(misses: DataFrame, limit: int) -> DataFrame:
    return misses.orderBy(F.desc("products"), "chain", "dept", "cat").limit(limit)


def path_examples(products: DataFrame, examples: int = 8) -> DataFrame:
    """Products per category path with a few names, lowest barcodes first."""
    pathed = products.filter(F.coalesce("path", F.lit("")) != "")
    counts = pathed.groupBy("path").agg(F.count(F.lit(1)).alias("products"))
    order = Window.partitionBy("path").orderBy("barcode", "name")
    few = pathed.filter(F.coalesce("name", F.lit("")) != "").withColumn("_rn", F.row_number().over(order)).filter(
        F.col("_rn") <= examples)
    names = few.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("_rn", "name"))).alias("_n"))
    shown = F.transform("_n", lambda x: x["name"])
    return counts.join(names, "path", "left").select("path", "products", shown.alias("names"))


def coverage(base: DataFrame, dump: DataFrame) -> DataFrame:
    """Share of a chain's priced barcodes that a taxonomy dump covers."""
    priced = base.select("chain_id", "barcode").distinct()
    known = dump.select("barcode").distinct().withColumn("_hit", F.lit(1))
    joined = priced.join(known, "barcode", "left")
    out = joined.groupBy("chain_id").agg(
        F.count(F.lit(1)).alias("priced"), F.count("_hit").alias("matched"))
    return out.withColumn("coverage_tenths", F.floor(F.col("matched") * 1000 / F.col("priced")).cast("bigint"))


def shape_drift(current: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Counts that moved more than their kind allows.

    Both have kind (``rows``, ``department``, ``source``), name and products.
    """
    now = current.select("kind", "name", F.col("products").alias("now"))
    joined = snapshot.select("kind", "name", F.col("products").alias("was")).join(now, ["kind", "name"], "left")
    got = F.coalesce("now", F.lit(0).cast("bigint"))
    broken = (
        ((F.col("kind") == "rows") & (got * 10 <= F.col("was") * 9))
        | ((F.col("kind") == "department")
           & (F.abs(got - F.col("was")) > F.greatest(F.lit(50.0), F.col("was") * 0.2)))
        | ((F.col("kind") == "source") & (got * 10 < F.col("was") * 8)))
    return joined.withColumn("now", got).filter(broken)
