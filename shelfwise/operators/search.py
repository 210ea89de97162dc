"""Word index, filler words, BM25 ranking and tiered product search.

The index has two tables: ``docs`` (barcode, indexed, dl) and ``postings``
(token, barcode, tf, dl). Stored by token, a query reads only its own words.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions import text
from shelfwise.operators.spread import exists_join, fits_broadcast, spread_join
from shelfwise.session import cut_lineage

# Published BM25 parameters and the filler rule.
K1, B, MIN_IDF = 1.2, 0.75, 1e-6
FILLER_SHARE, FILLER_FLOOR = 0.01, 50
OVERFETCH = 4


def product_tokens(products: DataFrame) -> DataFrame:
    """Distinct (token, barcode) of names."""
    named = products.filter(F.coalesce("name", F.lit("")) != "")
    return named.select(F.explode(text.raw_tokens(F.col("name"))).alias("token"), "barcode")


def index_docs(products: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Indexed text and length of every named product (or of ``only``)."""
    named = products.filter(F.coalesce("name", F.lit("")) != "").select("barcode", "name")
    if only is not None:
        named = exists_join(named, only, ["barcode"], ["name"])
    words = text.tokens(F.col("name"))
    return named.select("barcode", "name", F.array_join(words, " ").alias("indexed"),
                        F.size(words).cast("bigint").alias("dl"))


def postings(docs: DataFrame) -> DataFrame:
    """(token, barcode, tf, dl), counted inside each text's own row."""
    return docs.select("barcode", "dl", F.explode(text.term_counts(F.col("name"))).alias("t")).select(
        "t.token", "barcode", F.col("t.tf").cast("bigint").alias("tf"), "dl")


def query_index(docs: DataFrame, words: list[str]) -> tuple[DataFrame, DataFrame]:
    """Postings of just these words, and the corpus totals, for texts without a stored index.

    Each text is cut once and reduced in its own row to its length and the counts of the asked words. These are stored,
    because ranking reads them three times: for the totals, the words' frequencies and the scores.
    """
    asked = F.array(*[F.lit(w) for w in sorted(set(words))])
    cut = docs.select("barcode", F.explode(F.array(text.tokens(F.col("name")))).alias("_all"))
    found = F.transform(F.array_intersect(asked, "_all"), lambda t: F.struct(
        t.alias("token"), F.size(F.filter("_all", lambda w: w == t)).cast("bigint").alias("tf")))
    counted = cut_lineage(cut.select("barcode", F.size("_all").cast("bigint").alias("dl"), found.alias("_found")))
    posts = counted.select("barcode", "dl", F.explode("_found").alias("t")).select("t.token", "barcode", "t.tf", "dl")
    return posts, corpus_stats(counted)


def corpus_stats(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).cast("bigint").alias("total_dl"))


def document_frequency(docs: DataFrame) -> DataFrame:
    """Names carrying each token, a name counted once."""
    words = F.array_distinct(text.tokens(F.col("name")))
    return docs.select(F.explode(words).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("names"))


def filler_words(docs: DataFrame, share: float = FILLER_SHARE, floor: int = FILLER_FLOOR) -> DataFrame:
    """Tokens on at least ``share`` of the names and never under ``floor``."""
    total = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    limit = F.greatest(F.lit(float(floor)), total * share)
    return document_frequency(docs).filter(F.col("names") >= limit)


def query_tokens(spark, query: str) -> list[str]:
    """The words of a query, cut by the same rule as the index."""
    row = spark.range(1).select(text.tokens(F.lit(query)).alias("t")).first()
    return list(row["t"])


def idf(n_docs: Column, n_with: Column) -> Column:
    value = F.ln((n_docs - n_with + 0.5) / (n_with + 0.5))
    return F.when(value <= 0, F.lit(MIN_IDF)).otherwise(value)


def bm25(posts: DataFrame, stats: DataFrame, words: list[str]) -> DataFrame:
    """(barcode, score) of every document with any of the words."""
    times = Counter(words)
    hits = posts.filter(F.col("token").isin(*times))
    # One row per distinct query word.
    found = hits.groupBy("token").agg(F.count(F.lit(1)).cast("double").alias("df"))
    weighted = hits.join(F.broadcast(found), "token")
    corpus = stats.select(F.struct(
        F.col("n").cast("double").alias("n"), (F.col("total_dl") / F.col("n")).cast("double").alias("avgdl"))).scalar()
    n, avgdl = corpus["n"], corpus["avgdl"]
    repeat = F.lit(1.0)
    for word, count in times.items():
        if count > 1:
            repeat = F.when(F.col("token") == word, float(count)).otherwise(repeat)
    tf = F.col("tf").cast("double")
    part = idf(n, F.col("df")) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("dl") / avgdl))
    return weighted.groupBy("barcode").agg(F.sum(repeat * part).alias("score"))


def match_tier(indexed: Column, words: list[str]) -> Column:
    """0 the whole name, 1 its beginning, 2 anything else."""
    joined = " ".join(words)
    return F.when(indexed == joined, 0).when(indexed.startswith(joined + " "), 1).otherwise(2)


def matching_barcodes(posts: DataFrame, words: list[str]) -> DataFrame:
    return posts.filter(F.col("token").isin(*words)).select("barcode").distinct()


def tiered_search(docs: DataFrame, posts: DataFrame, stats: DataFrame, summaries: DataFrame,
                  words: list[str], limit: int = 20) -> DataFrame:
    """Best products for a query: tier, then chains selling, then BM25.

    Considered are the best ``4 * limit`` by BM25 and every whole-name or
    leading match at any depth. Products without a price are left out.
    """
    scored = bm25(posts, stats, words)
    candidates = docs.select("barcode", "indexed")
    ranked = candidates.join(scored, "barcode").withColumn("tier", match_tier(F.col("indexed"), words))
    window = ranked.orderBy(F.desc("score"), "barcode").limit(OVERFETCH * limit)
    chosen = window.union(ranked.filter("tier < 2")).distinct()
    priced = summaries.filter("min_agorot is not null")
    rows = chosen.join(priced, "barcode")
    return rows.select(
        "barcode", "name", "category_id", "chains", "min_agorot", "on_deal", "tier", "score"
    ).orderBy("tier", F.desc("chains"), F.desc("score"), "barcode").limit(limit)


def search_term_products(docs: DataFrame, chains: DataFrame, filler: DataFrame, per_term: int = 30) -> DataFrame:
    """Up to ``per_term`` products per name term, most widely sold first.

    Ranks are limited before the shuffle, so a term on very many names sends
    only a few rows per task.
    """
    from pyspark.sql import Window

    terms = docs.select("barcode", "name", F.explode(text.name_terms(F.col("name"))).alias("term"))
    common = filler.select(F.col("token").alias("term"))
    if fits_broadcast(common):
        kept = terms.join(F.broadcast(common), "term", "left_anti")
    else:
        kept = spread_join(terms, common, ["term"], ["barcode"], "left_anti")
    sold = kept.join(chains.select("barcode", "chains"), "barcode", "left")
    order = Window.partitionBy("term").orderBy(F.desc(F.coalesce("chains", F.lit(0))), "barcode")
    return sold.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_term).select(
        "term", "barcode", "name", F.col("rank").cast("bigint").alias("rank"))
