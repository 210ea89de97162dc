"""Quality rules whose cut-offs come from quantile sketches per language and source, in DataFrame functions only.

A sketch is a table of counts per bucket, where buckets are exact up to 127 and 1/64 of the value wide above: it is
merged by adding counts, in any order, with the same result. Counts of a source's language, or of all documents,
are sums of the sources' counts; they stand in where a group has fewer documents than a sketch needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm import tables
from shelfwise.operators.spread import FEW_KEYS_WAYS, lookup_join

SYMBOLS = "#*$%&|<>"
BLANK = r"[\x20\x09-\x0D]+"
ENOUGH = 100
# Feature: (least distance of the upper fence from the third quartile, whether there is a lower fence as far out).
FENCES = {"word_length": (150, True), "symbols": (30, False), "dup_lines": (350, False), "repeats": (300, False)}
REACH = 5


def _counts(docs: DataFrame) -> DataFrame:
    """Base counts of every text; arrays never leave their row."""
    text = F.col("text")
    first = docs.select("*", F.array_remove(F.split(text, BLANK), "").alias("_w"),
                        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    bare = text
    for c in SYMBOLS:
        bare = F.replace(bare, F.lit(c), F.lit(""))
    counted = first.select(
        "*", F.size("_w").cast("bigint").alias("n_words"), F.char_length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        (F.char_length(text) - F.char_length(bare)).cast("bigint").alias("n_symbols"), F.size("_l").cast("bigint").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        F.length(F.bin(F.size("_w"))).alias("_bits"))
    # Windows of three words as (hash, position) in one number, so that sorting brings equal ones side by side.
    windows = F.expr("""transform(slice(_w, 1, greatest(size(_w) - 2, 0)),
        (w, i) -> coalesce(shiftleft(xxhash64(w, _w[i + 1], _w[i + 2]), _bits) | cast(i AS bigint), 0L))""")
    ordered = counted.select("*", F.sort_array(windows).alias("_s"))
    at = "cast({0} & (shiftleft(1L, _bits) - 1) AS int)"
    same = " AND ".join(["shiftright({1}, _bits) = shiftright({0}, _bits)"] + [
        f"_w[{at.format('{0}')} + {k}] = _w[{at.format('{1}')} + {k}]" for k in range(3)])
    twice = F.expr(f"""filter(_s, (x, i) -> (i > 0 AND {same.format('x', '_s[i - 1]')})
        OR (i < size(_s) - 1 AND {same.format('x', '_s[i + 1]')}))""")
    found = ordered.select("*", twice.alias("_t")).select(
        "*", F.sort_array(F.expr(f"transform(_t, x -> {at.format('x')})")).alias("_p"))
    covered = F.expr("""aggregate(_p, named_struct('n', 0L, 'to', 0),
        (a, p) -> named_struct('n', a.n + p + 3 - greatest(p, a.to), 'to', p + 3)).n""")
    return found.select(*[f"`{c}`" for c in docs.columns if c != "text"], "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                        covered.alias("n_repeat_words"))


def _features() -> dict[str, Column]:
    part = lambda a, b, of: F.floor(F.col(a) * of / F.greatest(F.col(b), F.lit(1))).cast("bigint")
    return {"word_length": part("word_chars", "n_words", 100), "symbols": part("n_symbols", "word_chars", 1000),
            "dup_lines": part("n_dup_lines", "n_lines", 1000), "repeats": part("n_repeat_words", "n_words", 1000)}


def bucket(value: Column) -> Column:
    """Lower end of a value's bucket."""
    width = F.pow(F.lit(2), F.greatest(F.length(F.bin(value)) - 7, F.lit(0))).cast("bigint")
    return value - value % width


def _sketches(measured: DataFrame) -> DataFrame:
    """Counts per group, feature and bucket, for the groups of all three levels."""
    long = measured.where("n_words > 0").select("lang", "source", F.explode(F.map_from_arrays(
        F.array(*[F.lit(f) for f in FENCES]), F.array(*[bucket(F.col(f)) for f in FENCES]))).alias("feature", "bucket"))
    by_source = long.groupBy("lang", "source", "feature", "bucket").agg(F.count(F.lit(1)).alias("n"))
    levels = F.array(*[F.struct(F.lit(k).alias("level"), lang.alias("lang"), source.alias("source")) for k, (lang, source) in enumerate([
        (F.col("lang"), F.col("source")), (F.col("lang"), F.lit("")), (F.lit(""), F.lit(""))])])
    return by_source.select(F.explode(levels).alias("g"), "feature", "bucket", "n").groupBy(
        "g.level", "g.lang", "g.source", "feature", "bucket").agg(F.sum("n").alias("n"))


def fences(measured: DataFrame) -> DataFrame:
    """Level, language, source, number of documents, and ``low`` and ``high`` of every feature in two maps.

    Quartiles are nearest ranks; a fence is ``REACH`` times the distance of the quartiles beyond them, or the
    feature's least distance if that is more.
    """
    group = ["level", "lang", "source", "feature"]
    so_far = Window.partitionBy(*group).orderBy("bucket")
    ranked = _sketches(measured).select(
        *group, "bucket", F.sum("n").over(so_far).alias("upto"), F.sum("n").over(Window.partitionBy(*group)).alias("all"))
    quartile = lambda k: F.min(F.when(F.col("upto") * 4 >= F.col("all") * k, F.col("bucket")))
    cut = ranked.groupBy(*group).agg(quartile(1).alias("q1"), quartile(3).alias("q3"), F.max("all").alias("n"))
    apart = F.greatest((F.col("q3") - F.col("q1")) * REACH, F.element_at(
        F.create_map(*[F.lit(x) for f, (least, _) in FENCES.items() for x in (f, least)]), F.col("feature")))
    has_low = F.col("feature").isin([f for f, (_, low) in FENCES.items() if low])
    pair = lambda c: F.map_from_entries(F.collect_list(F.struct("feature", c.cast("bigint"))))
    return cut.groupBy("level", "lang", "source").agg(
        F.max("n").alias("n"), pair(F.when(has_low, F.col("q1") - apart).otherwise(F.lit(0))).alias("low"), pair(F.col("q3") + apart).alias("high"))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
            keep: Sequence[str] = ()) -> DataFrame:
    """Per row ``doc_id``, the base counts, ``base_failed``, ``kept``, the features and a ``text_key``.

    A row fails the base rules with fewer than 50 words, or with more than half of its words in three-word windows
    that the text repeats. Of the others, those within all fences of their group are kept: of their language and
    source if that group has ``ENOUGH`` documents with words, else of their language, else of all documents.
    A null text is empty and fails. Null languages and sources form groups of their own. Ids may be null or repeat,
    an empty table gives an empty result. ``keep`` names columns of ``docs`` to carry along instead, as ``_keep_`` and
    their name; other columns are ignored.
    """
    tagged = lambda c: F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-"))
    base = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
                       tagged(lang_col).alias("lang"), tagged(source_col).alias("source"), tables.text_key(text_col).alias("text_key"),
                       *[F.col(f"`{c}`").alias(f"_keep_{c}") for c in keep])
    measured = tables.stage(_counts(base).withColumns(_features()), "quality")
    limits = fences(measured)
    # One row per pair of language and source, each with the fences that judge it.
    pairs = measured.where("n_words > 0").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_own"))
    of_lang = limits.where("level = 1").select("lang", F.col("n").alias("n_lang"), F.col("low").alias("low1"), F.col("high").alias("high1"))
    of_all = limits.where("level = 2").select(F.col("low").alias("low2"), F.col("high").alias("high2"), F.lit(1).alias("one"))
    chosen = pairs.join(limits.where("level = 0").select("lang", "source", "low", "high"), ["lang", "source"]).join(of_lang, "lang")
    chosen = chosen.withColumn("one", F.lit(1)).join(of_all, "one")
    pick = lambda c: F.when(F.col("n_own") >= ENOUGH, F.col(c)).when(F.col("n_lang") >= ENOUGH, F.col(f"{c}1")).otherwise(F.col(f"{c}2"))
    # Stored, so that its real size decides whether it is broadcast; rows with their texts are then not shuffled.
    chosen = tables.stage(chosen.select("lang", "source", pick("low").alias("low"), pick("high").alias("high")), "fences")
    judged = lookup_join(measured, chosen, ["lang", "source"], ["doc_id"], "left", FEW_KEYS_WAYS)
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    within = F.lit(True)
    for f in FENCES:
        within &= F.col(f).between(F.col("low")[f], F.col("high")[f])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), F.coalesce(~failed & within, F.lit(False)).alias("kept"), *FENCES, "text_key",
                         *[f"`_keep_{c}`" for c in keep])


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') t, coalesce('=' || lang, '-') lang, coalesce('=' || source, '-') source FROM documents),
w AS (SELECT *, [x FOR x IN regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+') IF x <> ''] w,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] l FROM d),
tri AS (SELECT doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) i FROM w)),
again AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) p FROM again) GROUP BY 1),
c AS (SELECT w.doc_id, lang, source, len(w)::BIGINT n_words, length(list_aggregate(list_prepend('', w), 'string_agg', ''))::BIGINT word_chars,
             (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT n_symbols, len(l)::BIGINT n_lines,
             (len(l) - len(list_distinct(l)))::BIGINT n_dup_lines, coalesce(rep.n, 0)::BIGINT n_repeat_words
      FROM w LEFT JOIN rep USING (doc_id)),
m AS (SELECT *, word_chars * 100 // greatest(n_words, 1) word_length, n_symbols * 1000 // greatest(word_chars, 1) symbols,
             n_dup_lines * 1000 // greatest(n_lines, 1) dup_lines, n_repeat_words * 1000 // greatest(n_words, 1) repeats FROM c),
long AS (UNPIVOT (SELECT doc_id, lang, source, n_words, word_length, symbols, dup_lines, repeats FROM m WHERE n_words > 0)
         ON word_length, symbols, dup_lines, repeats INTO NAME feature VALUE v),
b AS (SELECT lang, source, feature, v - v % (1::BIGINT << greatest(length(bin(v)) - 7, 0)::BIGINT) bucket FROM long),
g AS (SELECT 0 level, lang, source, feature, bucket FROM b UNION ALL SELECT 1, lang, '', feature, bucket FROM b
      UNION ALL SELECT 2, '', '', feature, bucket FROM b),
q AS (SELECT level, lang, source, feature, bucket, sum(n) OVER (PARTITION BY level, lang, source, feature ORDER BY bucket) upto,
             sum(n) OVER (PARTITION BY level, lang, source, feature) alln
      FROM (SELECT level, lang, source, feature, bucket, count(*) n FROM g GROUP BY ALL)),
f AS (SELECT level, lang, source, feature, min(bucket) FILTER (upto * 4 >= alln) q1, min(bucket) FILTER (upto * 4 >= alln * 3) q3, max(alln) n
      FROM q GROUP BY ALL),
e AS (SELECT *, greatest((q3 - q1) * 5, CASE feature WHEN 'word_length' THEN 150 WHEN 'symbols' THEN 30 WHEN 'dup_lines' THEN 350 ELSE 300 END) apart FROM f),
lim AS (SELECT level, lang, source, feature, n, CASE WHEN feature = 'word_length' THEN q1 - apart ELSE 0 END low, q3 + apart high FROM e),
j AS (SELECT long.doc_id, bool_and(v BETWEEN CASE WHEN a.n >= 100 THEN a.low WHEN s.n >= 100 THEN s.low ELSE z.low END
                                         AND CASE WHEN a.n >= 100 THEN a.high WHEN s.n >= 100 THEN s.high ELSE z.high END) fine
      FROM long JOIN lim a ON a.level = 0 AND a.lang = long.lang AND a.source = long.source AND a.feature = long.feature
      JOIN lim s ON s.level = 1 AND s.lang = long.lang AND s.feature = long.feature JOIN lim z ON z.level = 2 AND z.feature = long.feature GROUP BY 1)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
       NOT (n_words < 50 OR n_repeat_words * 100 > n_words * 50) AND coalesce(fine, false) AS kept
FROM m LEFT JOIN j USING (doc_id)
"""
