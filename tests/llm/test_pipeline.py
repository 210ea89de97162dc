import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline as cp
from shelfwise.llm import decontamination as dc, mixing
from shelfwise.llm.queries import ORACLES
from tests.harness import connect
from tests.llm.test_near_duplicates import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage was given and what it returned."""
    docs, found = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, f in cp.STAGES:
        out = f(spark, docs, FOLDER).cache()
        found.append((docs.collect(), out.collect()))
        docs = out
    return found


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_quality_keeps_what_the_sql_keeps(stages):
    kept = connect(FOLDER).execute(f"SELECT doc_id FROM ({ORACLES['op7_quality']}) WHERE kept").fetchall()
    assert ids(stages[0][1]) == sorted(i for (i,) in kept)
    assert {tuple(r) for r in stages[0][1]} <= {tuple(r) for r in stages[0][0]}


def test_quality_rules_do_not_shuffle_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = cp.quality_rules(spark, docs, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "_keep_text" in plan and "LeftSemi" not in plan and "rightHint=(strategy=broadcast)" in plan


def test_one_of_each_group_stays(stages):
    given, out = stages[1]
    assert ids(out) == sorted({c for _, c, _ in brute([(r.doc_id, r.text) for r in given]).values()})


def test_no_benchmark_passage_stays(spark, stages):
    given, out = stages[2]
    plain = lambda t: f" {b' '.join(dc.normal(t.encode())).decode()} "
    items = [plain(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    dirty = {r.doc_id for r in given if any(s in plain(r.text) for s in items)}
    assert not dirty & set(ids(out)) and len(out) >= len(given) - len(dirty) - 1


def test_mix_comes_near_targets(stages):
    given, out = stages[3]
    own, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in given:
        n = len(r.text.encode().split())
        own[r.source] += n
        longest[r.source] = max(longest[r.source], n)
    for r in out:
        taken[r.source] += len(r.text.encode().split())
    names = sorted(own)
    want = mixing.targets([own[n] for n in names], [(3, 1, 2)[k % 3] for k in range(len(names))], 1.5 * sum(own.values()))
    assert all(abs(taken[n] - w) <= longest[n] / 2 + 1 for n, w in zip(names, want))


def test_token_files_hold_the_mix(stages):
    given, out = stages[4]
    tok, want, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), [], 0
    for r in sorted(given, key=lambda r: (r.doc_id, r.text)):
        tokens = [*tok.encode(r.text, add_special_tokens=False).ids, 2]
        want.append((r.doc_id, start, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())))
        start += len(tokens)
    assert sorted(tuple(r) for r in out) == want


def test_run_is_its_stages(spark, stages):
    assert sorted(map(tuple, cp.run(spark, FOLDER).collect())) == sorted(map(tuple, stages[-1][1]))


def test_rows_without_ids_and_empty_table(spark, tmp_path):
    shape = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    text = " ".join(f"w{k}" for k in range(80))
    docs = spark.createDataFrame([(None, text, None, None, None), (None, None, "en", "s", 1), (3, text, None, None, 5), (3, text, None, None, 5)], shape)
    for _, f in cp.STAGES[:-1]:
        docs = f(spark, docs, FOLDER).cache()
        assert docs.columns == shape.names
    assert all(r.text == text for r in docs.collect())
    empty = spark.createDataFrame([], shape)
    for _, f in cp.STAGES:
        empty = f(spark, empty, FOLDER).cache()
        assert empty.collect() == []
