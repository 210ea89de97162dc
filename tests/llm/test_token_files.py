import heapq
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from shelfwise.llm import huffman
from shelfwise.llm.queries import op6_token_files
from shelfwise.llm.token_files import Encoder, read_token_files, write_token_files

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ids", T.StringType())])
PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["It's The cat's, we'll isn't 'sabc \"'s x'", "", None, "É été ÀÉÎ é İstanbul ΣΑΣ  x y", "a\x1cb\x85c 123 ４٣ <|endoftext|> a<|startoftext|>b",
         "日本語 ﬁ‍ $$$***", "\t\n", "x" * 3000, "don't DON'T 'RE re're"]


@pytest.mark.parametrize("n,size", [(1, 5), (2, 100), (300, 10_000), (5000, 50_000), (5, 0)])
def test_round_trip_and_best_length(n, size):
    rng = np.random.default_rng(1)
    symbols = np.minimum(rng.zipf(1.3, size) - 1, n - 1) if size else np.empty(0, np.int64)
    counts = np.bincount(symbols, minlength=n)
    lengths = huffman.code_lengths(counts)
    for every in (1, 7, 256):
        raw, checkpoints = huffman.pack(symbols, lengths, huffman.codes(lengths), every)
        assert (huffman.unpack(raw, checkpoints, size, every, huffman.decode_table(lengths)) == symbols).all()
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    if total and lengths.max() < huffman.LIMIT:
        assert int((counts * lengths).sum()) == total


def test_limit_holds():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144])
    lengths = huffman.code_lengths(counts, limit=5)
    assert lengths.max() == 5 and (2.0 ** -lengths.astype(float)).sum() <= 1
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5, int), limit=2)


def want(rows):
    tok, out, start = Tokenizer.from_file(PATH), [], 0
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_word_by_word_is_the_library(spark):
    encoder = Encoder(open(PATH, encoding="utf-8").read())
    assert encoder.by_word
    rows = [(None, "first"), *enumerate(TEXTS), (100, "a b"), (100, "b a")]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], DOCS).repartition(3)
    path = write_token_files(df, PATH, 2)
    got = read_token_files(spark, path, keep_ids=True).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == want(rows)
    assert got[0].ids == [*Tokenizer.from_file(PATH).encode("first", add_special_tokens=False).ids, 2]


def test_other_tokenizer_takes_whole_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not Encoder(open(path, encoding="utf-8").read()).by_word
    df = spark.createDataFrame([(1, " two  words\n", "")], DOCS)
    got = read_token_files(spark, write_token_files(df, path, 50256), keep_ids=True).collect()
    assert got[0].ids == [*Tokenizer.from_file(path).encode(" two  words\n", add_special_tokens=False).ids, 50256]


def test_empty_table(spark):
    assert read_token_files(spark, write_token_files(spark.createDataFrame([], DOCS), PATH, 2)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()]
    assert [tuple(r) for r in op6_token_files(spark, folder).orderBy("start").collect()] == want(rows)


def test_words_equal_the_library_letter_by_letter():
    """Random words of printable ASCII, Latin-1 and beyond, special marks and broken bytes included."""
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    from shelfwise.llm.token_files import Encoder

    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(4)
    with open(path) as file:
        encoder = Encoder(file.read())
    whole = Tokenizer.from_file(path)
    marks = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x180))] + ["İ", "Σ", "ς", "ﬁ", "e\u0301", "中", "٣", "<|endoftext|>", "\u00ad", "\u00a0", "'s"]
    found = list(dict.fromkeys("".join(rng.choice(marks) for _ in range(rng.randrange(1, 9))).encode() for _ in range(20_000)))
    encoder.learn(found)
    for w, e in zip(found, whole.encode_batch([w.decode() for w in found], add_special_tokens=False)):
        assert np.frombuffer(encoder.words[w], encoder.kind).tolist() == e.ids, w
