"""Word index, ranking and word shards over all documents and products."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import offers, search, shards
from shelfwise.operators.catalog import product_summaries
from shelfwise.plans.bridge import Bridge
from shelfwise.plans.registry import query

WORDS = ["with", "that", "der", "les", "with"]
LIST = "('with', 'that', 'der', 'les')"
NAME_WORDS = ["red", "ring"]


@query("token_index", """
    SELECT DISTINCT token, barcode FROM (SELECT barcode, unnest(string_split(lower(name), ' ')) AS token FROM products)
    WHERE length(token) >= 2""", ("products",))
def token_index(b: Bridge):
    return search.product_tokens(b.products())


@query("document_token_index", r"""
    SELECT DISTINCT token, barcode FROM (SELECT CAST(doc_id AS VARCHAR) AS barcode,
        unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_\x{0590}-\x{05FF}]+')) AS token FROM documents)
    WHERE length(token) >= 2""")
def document_token_index(b: Bridge):
    return search.product_tokens(b.documents())


@query("document_frequency", """
    SELECT token, count(*) AS names FROM (SELECT DISTINCT barcode, unnest(ws) AS token FROM words) GROUP BY token""", ("words",))
def document_frequency(b: Bridge):
    return search.document_frequency(b.search_index()[0])


@query("filler_words", """
    SELECT token, count(*) AS names FROM (SELECT DISTINCT barcode, unnest(ws) AS token FROM words) GROUP BY token
    HAVING count(*) >= greatest(50.0, 0.01 * (SELECT count(*) FROM words))""", ("words",))
def filler_words(b: Bridge):
    return search.filler_words(b.search_index()[0])


@query("postings", "SELECT token, barcode, tf, dl FROM postings", ("postings",))
def postings(b: Bridge):
    return b.search_index()[1]


@query("corpus_stats", "SELECT count(*) AS n, sum(len(ws))::BIGINT AS total_dl FROM words", ("words",))
def corpus_stats(b: Bridge):
    return b.search_index()[2]


SCORED = f"""
    , hits AS (SELECT * FROM postings WHERE token IN {LIST}),
    df AS (SELECT token, count(*)::DOUBLE AS df, (SELECT count(*) FROM words)::DOUBLE AS n,
                  (SELECT avg(len(ws)) FROM words)::DOUBLE AS avgdl FROM hits GROUP BY token),
    scored AS (SELECT barcode, sum(CASE token WHEN 'with' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END * greatest(ln((n - df + 0.5) / (df + 0.5)), 1e-6)
        * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))) AS score FROM hits JOIN df USING (token) GROUP BY barcode)"""


@query("bm25_scores", SCORED + "SELECT barcode, round(score * 10000)::BIGINT AS score FROM scored", ("words", "postings"))
def bm25_scores(b: Bridge):
    _, posts, stats = b.search_index()
    return search.bm25(posts, stats, WORDS).select("barcode", F.round(F.col("score") * 10000).cast("bigint").alias("score"))


@query("bm25_top_documents", SCORED + """
    SELECT barcode, round(score * 10000)::BIGINT AS score FROM scored ORDER BY round(score * 10000) DESC, barcode LIMIT 20""",
       ("words", "postings"))
def bm25_top_documents(b: Bridge):
    """The same scores without a stored index: only the asked words are kept."""
    posts, stats = search.query_index(search.index_docs(b.documents()), WORDS)
    score = F.round(F.col("score") * 10000).cast("bigint")
    return search.bm25(posts, stats, WORDS).select("barcode", score.alias("score")).orderBy(
        F.desc("score"), "barcode").limit(20)


@query("tiered_product_search", """
    , m AS (SELECT p.*, string_split(name, ' ') AS ws FROM products p WHERE list_contains(string_split(name, ' '), 'red')
            OR list_contains(string_split(name, ' '), 'ring')),
    s AS (SELECT *, (list_contains(ws, 'red')::INT * ln(((SELECT count(*) FROM products) - (SELECT count(*) FROM m WHERE list_contains(ws, 'red')) + 0.5)
                        / ((SELECT count(*) FROM m WHERE list_contains(ws, 'red')) + 0.5))
                   + list_contains(ws, 'ring')::INT * ln(((SELECT count(*) FROM products) - (SELECT count(*) FROM m WHERE list_contains(ws, 'ring')) + 0.5)
                        / ((SELECT count(*) FROM m WHERE list_contains(ws, 'ring')) + 0.5))) AS score,
             CASE WHEN name = 'red ring' THEN 0 WHEN name LIKE 'red ring %' THEN 1 ELSE 2 END AS tier FROM m),
    c AS (SELECT * FROM s QUALIFY row_number() OVER (ORDER BY round(score, 9) DESC, barcode) <= 80 OR tier < 2),
    x AS (SELECT barcode, min(agorot) AS min_agorot, count(*) AS chains FROM base GROUP BY barcode)
    SELECT c.barcode, c.name, x.chains, x.min_agorot, tier::BIGINT AS tier FROM c JOIN x USING (barcode)
    ORDER BY tier, chains DESC, round(score, 9) DESC, barcode LIMIT 20""", ("products", "base"))
def tiered_product_search(b: Bridge):
    docs = search.index_docs(b.products())
    none = b.products().select("barcode", F.lit(0).alias("discount_tenths")).filter("false")
    summaries = product_summaries(b.mart_products(), b.baselines(), none)
    found = search.tiered_search(docs, search.postings(docs), search.corpus_stats(docs), summaries, NAME_WORDS)
    return found.select("barcode", "name", "chains", "min_agorot", "tier")


@query("search_discounted_only", """
    SELECT DISTINCT barcode FROM real_deals JOIN products p USING (barcode)
    WHERE list_contains(string_split(p.name, ' '), 'red') OR list_contains(string_split(p.name, ' '), 'ring')""",
       ("real_deals", "products"))
def search_discounted_only(b: Bridge):
    docs = search.index_docs(b.products(), b.deals()[0].filter("discount_tenths > 0"))
    return search.matching_barcodes(search.postings(docs), NAME_WORDS)


@query("deals_matching_words", """
    SELECT d.deal_id, d.barcode, d.discount_tenths FROM best_deals d JOIN products p USING (barcode)
    WHERE list_contains(string_split(p.name, ' '), 'red') OR list_contains(string_split(p.name, ' '), 'ring')
    ORDER BY d.discount_tenths DESC, d.deal_id LIMIT 25""", ("best_deals", "products"))
def deals_matching_words(b: Bridge):
    docs = search.index_docs(b.products())
    hits = search.matching_barcodes(search.postings(docs), NAME_WORDS)
    best = offers.best_deal_per_product(b.deals()[0])
    return offers.list_deals(best, matching=hits).select("deal_id", "barcode", "discount_tenths")


TERMS = r"""
    , t AS (SELECT CAST(doc_id AS VARCHAR) AS barcode, n_chars, unnest(list_distinct(list_filter(
          regexp_extract_all(lower(text), '[\p{L}\p{N}_"''״׳]+'),
          lambda w: length(w) >= 2 AND NOT regexp_matches(w, '^\p{Nd}+$') AND regexp_matches(w, '^[\p{L}\p{N}]')))) AS term FROM documents),
    f AS (SELECT token FROM (SELECT DISTINCT barcode, unnest(ws) AS token FROM words) GROUP BY token
          HAVING count(*) >= greatest(50.0, 0.01 * (SELECT count(*) FROM words))),
    ranked AS (SELECT term, barcode, row_number() OVER (PARTITION BY term ORDER BY n_chars DESC, barcode) AS rank
               FROM t WHERE term NOT IN (SELECT token FROM f))"""


def _term_rows(b: Bridge):
    docs, _, _ = b.search_index()
    sold = b.table("documents").select(F.col("doc_id").cast("string").alias("barcode"), F.col("n_chars").alias("chains"))
    return docs, search.search_term_products(docs, sold, search.filler_words(docs))


@query("top_documents_per_term", TERMS + "SELECT term, barcode, rank FROM ranked WHERE rank <= 30", ("words",))
def top_documents_per_term(b: Bridge):
    return _term_rows(b)[1].select("term", "barcode", "rank")


@query("name_shards", TERMS + r"""
    , w AS (SELECT translate(term, '"''״׳', '') AS w, barcode, length(barcode) + 6 AS chars FROM ranked WHERE rank <= 30),
    p2 AS (SELECT w[1:2] AS p, barcode, max(chars) AS chars, max(length(w)) AS longest FROM w WHERE length(w) >= 2 GROUP BY ALL),
    b2 AS (SELECT p FROM p2 GROUP BY p HAVING sum(chars) + count(*) + 1 > 400),
    p3 AS (SELECT w[1:3] AS p, barcode, max(chars) AS chars, max(length(w)) AS longest FROM w
           WHERE length(w) > 2 AND w[1:2] IN (SELECT p FROM b2) GROUP BY ALL),
    b3 AS (SELECT p FROM p3 GROUP BY p HAVING sum(chars) + count(*) + 1 > 400),
    p4 AS (SELECT w[1:4] AS p, barcode FROM w WHERE length(w) > 3 AND w[1:3] IN (SELECT p FROM b3) GROUP BY ALL)
    SELECT p AS shard, barcode FROM p2 WHERE p NOT IN (SELECT p FROM b2) OR longest <= 2
    UNION SELECT p, barcode FROM p3 WHERE p NOT IN (SELECT p FROM b3) OR longest <= 3
    UNION SELECT p, barcode FROM p4""", ("words",))
def name_shards(b: Bridge):
    _, terms = _term_rows(b)
    rows = terms.select("term", "barcode", (F.length("barcode") + 6).alias("chars"))
    return shards.name_shards(rows, limit=400)
