"""Published documents: nested texts built inside a byte budget.

Every document is a list of entries under one key. Running byte totals in entry order cut it into numbered parts, and only
then are lists made, each inside its part: a key with few entries has one part, a key with a third of all rows has many,
and both follow the same rule. Files are cut in the same way inside their shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions import money, text
from shelfwise.operators import shards
from shelfwise.operators.numbering import running_total
from shelfwise.operators.spread import exists_join, lookup_join
from shelfwise.session import cut_lineage

# Files beside the shards: the index of each kind, the stores and the catalog's own.
SIDE_FILES = 5


# --- JSON texts ----------------------------------------------------------------


def quoted(c: Column) -> Column:
    """A JSON string; null is the empty one."""
    whole = F.to_json(F.struct(F.coalesce(c, F.lit("")).alias("v")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def number(c: Column) -> Column:
    """A decimal without trailing zeros."""
    digits = c.cast("string")
    return F.when(F.contains(digits, F.lit(".")), F.rtrim(F.rtrim(digits, F.lit("0")), F.lit("."))).otherwise(digits)


def shekels(agorot: Column) -> Column:
    return number(money.to_shekels(agorot))


def joined(ordered: Column, opening: str, closing: str) -> Column:
    """Texts of the collected (order…, text) structs in order, between brackets."""
    return F.concat(F.lit(opening), F.array_join(F.transform(F.sort_array(ordered), lambda e: e["text"]), ","), F.lit(closing))


# --- parts ---------------------------------------------------------------------


def in_parts(entries: DataFrame, key: list[str], order: list[str], budget: int, size: Column | None = None,
             out: str = "part") -> DataFrame:
    """Add ``out``: 1, 2, … by the bytes of the entries before one; ``key + order`` are non-null and identify an entry.

    The entries are kept, since they are read for the totals and the parts.
    """
    sized = cut_lineage(entries.withColumn("_size", (F.octet_length("text") + 1 if size is None else size).cast("bigint")))
    summed = running_total(sized, key, order, "_size", "_upto")
    return summed.withColumn(out, (F.floor((F.col("_upto") - F.col("_size")) / budget) + 1).cast("int")).drop("_size", "_upto")


def nested(entries: DataFrame, outer: str, inner: str, order: list[str], budget: int) -> DataFrame:
    """``outer``, ``part`` and ``json``: ``{inner: [entry, …], …}`` of the entries of one part."""
    parts = in_parts(entries, [outer], [inner, *order], budget)
    lists = parts.groupBy(outer, "part", inner).agg(joined(F.collect_list(F.struct(*order, "text")), "[", "]").alias("_list"))
    named = lists.withColumn("text", F.concat(quoted(F.col(inner)), F.lit(":"), "_list"))
    return named.groupBy(outer, "part").agg(joined(F.collect_list(F.struct(inner, "text")), "{", "}").alias("json"))


def part_key(key: Column, part: Column) -> Column:
    """Key of a part in its file: the first goes by the plain key."""
    return F.when(part == 1, key).otherwise(F.concat(key, F.lit("/"), part.cast("string")))


def files(docs: DataFrame, levels: tuple[int, ...], budget: int) -> DataFrame:
    """``shard``, ``file`` and ``text`` of the documents (``barcode``, ``part``, ``json``).

    A shard within the budget is one file. A deepest shard beyond it is cut by running bytes like a document.
    """
    placed = shards.by_bytes(cut_lineage(docs), levels, budget)
    entry = F.concat(quoted(part_key(F.col("barcode"), F.col("part"))), F.lit(":"), "json")
    cut = in_parts(placed.withColumn("text", entry), ["shard"], ["barcode", "part"], budget, out="file")
    return cut.groupBy("shard", "file").agg(joined(F.collect_list(F.struct("barcode", "part", "text")), "{", "}").alias("text"))


def write_files(found: DataFrame, path: str) -> None:
    """One text file per shard and file number; files of an earlier write go."""
    found.repartition("shard", "file").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("shard", "file").text(path)


# --- store prices and stores -----------------------------------------------------


def detail_documents(exc: DataFrame, budget: int = shards.DETAIL_BYTES) -> DataFrame:
    """``barcode``, ``part``, ``json``: ``{chain: [[store, price], …], …}`` for prices that differ from the chain's."""
    entry = F.concat(F.lit("["), quoted(F.col("store_id")), F.lit(","), shekels(F.col("agorot")), F.lit("]"))
    return nested(exc.select("barcode", "chain_id", "store_id", entry.alias("text")), "barcode", "chain_id", ["store_id"], budget)


def detail_files(exc: DataFrame, levels=shards.DETAIL_LEVELS, budget: int = shards.DETAIL_BYTES) -> DataFrame:
    return files(detail_documents(exc, budget), levels, budget)


def store_entries(stores: DataFrame) -> DataFrame:
    """``"id":[name, city, priced items]`` of every store."""
    entry = F.concat(quoted(F.col("store_id")), F.lit(":["), quoted(F.col("store_name")), F.lit(","), quoted(F.col("city")), F.lit(","),
                     F.col("priced_items").cast("string"), F.lit("]"))
    return stores.select("chain_id", "store_id", entry.alias("text"))


def store_documents(stores: DataFrame, budget: int = shards.DETAIL_BYTES) -> DataFrame:
    """The stores beside the store prices: ``chain_id``, ``part``, ``json``: ``{store: [name, city, priced items], …}``."""
    parts = in_parts(store_entries(stores), ["chain_id"], ["store_id"], budget)
    return parts.groupBy("chain_id", "part").agg(joined(F.collect_list(F.struct("store_id", "text")), "{", "}").alias("json"))


# --- promotions ------------------------------------------------------------------


def promotion_texts(entries: DataFrame) -> DataFrame:
    """The rows of :func:`offers.promotion_entries` as ``text``; keys that say nothing are left out."""
    o = F.col("offer")
    key = lambda name, value: F.concat(F.lit(f'"{name}":'), value)
    listed = lambda c: F.concat(F.lit("["), F.array_join(F.transform(c, quoted), ","), F.lit("]"))
    fields = F.concat_ws(
        ",", key("u", number(o["u"])), key("d", quoted(o["d"])), key("e", quoted(o["e"])), key("q", number(o["q"])), key("t", number(o["t"])),
        key("c", o["c"].cast("string")), key("k", o["k"].cast("string")), F.when(o["b"].isNotNull(), key("b", quoted(o["b"]))),
        key("s", listed(o["s"])), key("x", listed(o["x"])))
    return entries.select("barcode", "chain_id", "club", "coupon", "unit_agorot", "min_qty", F.concat(F.lit("{"), fields, F.lit("}")).alias("text"))


OFFER_ORDER = ["club", "coupon", "unit_agorot", "min_qty"]


def promotion_documents(entries: DataFrame, budget: int = shards.PROMO_BYTES) -> DataFrame:
    """``barcode``, ``part``, ``json``: ``{chain: [offer, …], …}``, each chain's offers cheapest first within card and coupon."""
    return nested(promotion_texts(entries), "barcode", "chain_id", OFFER_ORDER, budget)


def promotion_files(entries: DataFrame, levels=shards.PROMO_LEVELS, budget: int = shards.PROMO_BYTES) -> DataFrame:
    return files(promotion_documents(entries, budget), levels, budget)


def promotions_for(barcodes: DataFrame, entries: DataFrame, budget: int = shards.PROMO_BYTES) -> DataFrame:
    """The promotion documents of some barcodes; those without an offer have none."""
    asked = barcodes.select("barcode").filter("barcode is not null").distinct()
    return promotion_documents(exists_join(entries, asked, ["barcode"], ["unit_agorot"]), budget)


# --- names -----------------------------------------------------------------------


def name_entries(products: DataFrame) -> DataFrame:
    """The row ``[barcode, name, weighed]`` of every product, as a word shard holds it."""
    weighed = F.when(F.col("is_weighted") == 1, "1").otherwise("0")
    row = F.concat(F.lit("["), quoted(F.col("barcode")), F.lit(","), quoted(F.col("name")), F.lit(","), weighed, F.lit("]"))
    return products.select("barcode", F.length("name").alias("name_chars"), row.alias("text"))


def filler_terms(products: DataFrame, share: float, floor: int) -> DataFrame:
    """Terms on too many names to be worth a posting list, as ``token``."""
    total = products.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = products.select(F.explode(text.name_terms(F.col("name"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= F.greatest(F.lit(float(floor)), total * share)).select("token")


def name_files(products: DataFrame, base: DataFrame, levels=shards.NAME_LEVELS, limit: int = shards.NAME_CHARS,
               per_term: int = 30, share: float = 0.01, floor: int = 50) -> DataFrame:
    """``shard`` and ``text``: the rows found under the words that begin with the shard, shortest name first.

    A word leads to the ``per_term`` products that most chains sell; a task sends no more than these of any word.
    """
    from shelfwise.operators import search

    sold = base.groupBy("barcode").agg(F.count(F.lit(1)).alias("chains"))
    postings = search.search_term_products(products.select("barcode", "name"), sold, filler_terms(products, share, floor), per_term)
    postings, rows = cut_lineage(postings), name_entries(products)
    # Characters of a row and the comma after it; the limit counts characters, not bytes.
    sized = lookup_join(postings.select("term", "barcode"), rows.select("barcode", F.length("text").alias("chars")), ["barcode"], ["term"], "inner")
    placed = shards.name_shards(sized, levels, limit)
    full = lookup_join(placed, rows, ["barcode"], ["shard"], "inner")
    return full.groupBy("shard").agg(joined(F.collect_list(F.struct("name_chars", "barcode", "text")), "[", "]").alias("text"))


# --- index and meta ----------------------------------------------------------------


def json_map(rows: DataFrame, key: str, value: str) -> Column:
    """``{key: value, …}`` of a small table in key order, as a scalar; for tables of the size of the chain list."""
    return rows.agg(joined(F.collect_list(F.struct(
        F.col(key).alias("k"), F.concat(quoted(F.col(key)), F.lit(":"), quoted(F.col(value))).alias("text"))), "{", "}").alias("m")).scalar()


def count_of(rows: DataFrame) -> Column:
    return rows.agg(F.count(F.lit(1)).alias("n")).scalar()


def catalog_index(products: DataFrame, chains: DataFrame, chain_as_of: DataFrame, promo_barcodes: DataFrame, built_at: str,
                  other_files: Column, levels=shards.COUNT_LEVELS, max_items: int = shards.MAX_ITEMS, strict: bool = True) -> DataFrame:
    """The catalog's index in one row: ``files`` of the whole catalog, checked against the host's limit, and ``json``.

    ``other_files`` counts the files of the other kinds (:func:`count_of`). With ``strict`` off an index beyond the limit is
    made all the same, and ``shards.over_limit`` reports it.
    """
    placed = shards.by_count(products.select("barcode"), levels, max_items).groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    one = placed.agg(F.sort_array(F.collect_list("shard")).alias("shards"), F.sum("n").alias("products"), F.count(F.lit(1)).alias("own"))
    total = F.col("own") + other_files + SIDE_FILES
    message = F.concat(total.cast("string"), F.lit(f" files exceed the limit of {shards.MAX_FILES}"))
    files_checked = shards.limited(total, strict, message).cast("bigint")
    body = F.concat(
        F.lit(f'{{"levels":[{",".join(map(str, levels))}],"shards":['), F.array_join(F.transform("shards", quoted), ","),
        F.lit('],"chains":'), json_map(chains, "chain_id", "name"), F.lit(',"built_at":'), quoted(F.lit(built_at)),
        F.lit(',"chain_as_of":'), json_map(chain_as_of, "chain_id", "as_of"), F.lit(',"products":'), F.coalesce("products", F.lit(0)).cast("string"),
        F.lit(',"promo_products":'), count_of(promo_barcodes.select("barcode").distinct()).cast("string"), F.lit("}"))
    return one.select(files_checked.alias("files"), body.alias("json"))


def meta_documents(products: DataFrame, promo_barcodes: DataFrame, chains: DataFrame, chain_as_of: DataFrame, stores: DataFrame,
                   built_at: str, budget: int = shards.DETAIL_BYTES) -> DataFrame:
    """The meta document in numbered parts: each has the head and its stretch of the stores by chain."""
    head = F.concat(
        F.lit('{"built_at":'), quoted(F.lit(built_at)), F.lit(',"chain_as_of":'), json_map(chain_as_of, "chain_id", "as_of"),
        F.lit(',"chains":'), json_map(chains, "chain_id", "name"), F.lit(',"products":'), count_of(products).cast("string"),
        F.lit(',"promo_products":'), count_of(promo_barcodes.select("barcode").distinct()).cast("string"), F.lit(',"stores":'))
    parts = in_parts(store_entries(stores).withColumn("doc", F.lit("meta")), ["doc"], ["chain_id", "store_id"], budget)
    by_chain = parts.groupBy("part", "chain_id").agg(joined(F.collect_list(F.struct("store_id", "text")), "{", "}").alias("_stores"))
    named = by_chain.withColumn("text", F.concat(quoted(F.col("chain_id")), F.lit(":"), "_stores"))
    bodies = named.groupBy("part").agg(joined(F.collect_list(F.struct("chain_id", "text")), "{", "}").alias("_body"))
    return bodies.select("part", F.concat(head, F.col("_body"), F.lit("}")).alias("json"))
