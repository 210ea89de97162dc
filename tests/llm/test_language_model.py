import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from shelfwise.llm import language_model as lm
from shelfwise.llm.queries import op10_language_model

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


class Brute:
    def __init__(self, texts):
        self.c = Counter()
        for t in texts:
            prev = "<s>"
            for w in tokens(t):
                self.c[prev, w] += 1
                prev = w
        self.uni = Counter()
        self.followed, self.conts = defaultdict(list), Counter()
        for (h, w), n in self.c.items():
            self.uni[w] += n
            self.followed[h].append(n)
            self.conts[w] += 1
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.d2 = lm.discounts(*[sum(1 for x in self.c.values() if x == k) for k in (1, 2, 3, 4)])
        self.total = sum(self.conts.values())
        self.d1 = lm.discounts(*[sum(1 for x in self.conts.values() if x == k) for k in (1, 2, 3, 4)])

        self.left = sum(self.d1[min(x, 3) - 1] for x in self.conts.values()) / self.total if self.total else 1.0

    def p(self, h, w):
        total, left = self.total, self.left
        low = left / (self.v + 1) + (max(self.conts[w] - self.d1[min(self.conts[w], 3) - 1], 0) / total if self.conts[w] else 0)
        ns = self.followed.get(h)
        if not ns:
            return low
        n = self.c[h, w]
        return (max(n - self.d2[min(n, 3) - 1], 0) if n else 0) / sum(ns) + sum(self.d2[min(x, 3) - 1] for x in ns) / sum(ns) * low

    def row(self, text):
        ts = tokens(text)
        score = sum(math.log10(self.p(h, w)) for h, w in zip(["<s>", *ts], ts))
        base = sum(math.log10((self.uni[w] + 1) / (self.n + self.v + 1)) for w in ts)
        return len(ts), sum(self.uni[w] > 0 for w in ts), base, score


TEXTS = ["a b a c", "A b\ta  d", "", None, "é b a É", "a a a a a b", "c d e f g", "b a c a b a"]


def test_equals_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "zz a", "y"), (3, "b b", "y")], DOCS).repartition(3)
    train = df.where("doc_id < 6")
    brute = Brute(TEXTS[:6] + ["b b"])
    model = lm.train(train)
    assert (model.tokens, model.types) == (brute.n, brute.v)
    got = lm.score(df, model).collect()
    assert len(got) == 10
    want = sorted((i, *brute.row(t)) for i, t in [*enumerate(TEXTS), (3, "b b"), (-1, "zz a")])
    for g, w in zip(sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in got), want):
        assert g == pytest.approx(w, rel=1e-9)


def test_probabilities_add_up(spark):
    brute = Brute(TEXTS)
    for h in ["<s>", "a", "b", "never"]:
        assert sum(brute.p(h, w) for w in [*brute.uni, "unknown"]) == pytest.approx(1)


def test_empty_training_and_empty_input(spark):
    none = spark.createDataFrame([], DOCS)
    model = lm.train(none)
    assert lm.score(none, model).collect() == []
    row = lm.score(spark.createDataFrame([(1, "a b", "")], DOCS), model).collect()[0]
    assert row.score == 0 and row.n_known == 0 and row.n_tokens == 3


def test_query_equals_brute_force_and_beats_unigrams(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows}
    brute = Brute([r.text for r in rows if not held[r.doc_id]])
    got = {r.doc_id: r for r in op10_language_model(spark, folder).collect()}
    assert len(got) == len(rows)
    for r in rows[:60]:
        g = got[r.doc_id]
        assert g.held_out == held[r.doc_id] and g.train_tokens == brute.n
        assert (g.n_tokens, g.n_known, g.base_score, g.score) == pytest.approx(brute.row(r.text), rel=1e-9)
    assert sum(g.score for g in got.values() if g.held_out) > sum(g.base_score for g in got.values() if g.held_out)
