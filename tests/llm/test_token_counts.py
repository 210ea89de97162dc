import random

import public_tokenizers
from pyspark.sql import types as T

from shelfwise.llm.queries import op9_token_counts
from shelfwise.llm.token_counts import SCALE, Trie, token_counts, zipf_vocabulary

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_tokens", T.StringType())])
SCORES = {"▁": -9, "▁a": -3, "a": -4, "b": -4, "ab": -5, "bab": -6, "é": -5, "▁ab": -7, "aaaa": -4}
SCORES = {k: v * SCALE for k, v in SCORES.items()}


def brute(word, scores):
    """Best segmentation of one word by itself, over all cuts."""
    low = min(scores.values()) - 10 * SCALE
    best = [(0, 0)]
    for i in range(1, len(word) + 1):
        n = len(word[i - 1].encode())
        options = [(best[i - 1][0] + n * low, best[i - 1][1] - n)]
        options += [(best[j][0] + scores[word[j:i]], best[j][1] - 1) for j in range(i) if word[j:i] in scores]
        best.append(max(options))
    return -best[-1][1]


def total(text, scores):
    return sum(brute("▁" + w.decode(), scores) for w in (text or "").encode().split())


def test_trie_equals_every_cut():
    rng, trie = random.Random(3), Trie(SCORES)
    for _ in range(500):
        word = "▁" + "".join(rng.choices("abéx日", k=rng.randint(0, 9)))
        assert trie.insert(word) == brute(word, SCORES)


def test_table(spark):
    rows = [(1, "a ab  bab\tx"), (2, None), (3, ""), (None, "aaaaaaaa é"), (1, "a"), (5, "ab " * 3000), (6, "b" * 3000)]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], DOCS).repartition(2)
    got = sorted(((r.doc_id, r.n_pretokens, r.n_tokens) for r in token_counts(df, SCORES).collect()), key=str)
    assert got == sorted(((i, len((t or "").split()), total(t, SCORES)) for i, t in rows), key=str)
    assert token_counts(spark.createDataFrame([], DOCS), SCORES).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    scores = zipf_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r.n_tokens for r in op9_token_counts(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows[:40]:
        assert got[r.doc_id] == total(r.text, scores)
