"""Token ids of texts in compressed binary blocks, in ascending id order.

Texts are put in order by ranges of their ids, encoded once, and kept in the shared folder as plain ids. Global
counts of the ids give one canonical length-limited Huffman code. The file format is a Parquet folder ``blocks``, a
row a block of about a million ids: its documents, its bits, and the bit offset of every 256th id, from which that
run of ids can be decoded by itself; and a folder ``code`` with the length of each id's code. Spark's committer
writes both, so a repeated task leaves nothing twice.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfwise.llm import huffman, tables, words

GROUP_BYTES = 8 << 20
BLOCK_IDS = 1 << 20
RANGE_BYTES = 16 << 20
EVERY = 256
KEPT_WORDS = 600_000
_RAW = "part int, seq int, docs binary, sizes binary, ids binary, counts binary"
_RAW_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("docs", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary()), ("counts", pa.binary())])
_BLOCK = "part int, seq int, n_ids bigint, docs binary, sizes binary, checkpoints binary, bits binary"
_BLOCK_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_ids", pa.int64()), ("docs", pa.binary()), ("sizes", pa.binary()), ("checkpoints", pa.binary()), ("bits", pa.binary())])
# How the file that words are cut by says that it drops white space, folds case and splits.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\n]+")
# Printable ASCII and the letters of Latin-1 in UTF-8: lower case goes letter by letter there, and nothing is composed.
_LATIN = re.compile(rb"(?:[!-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
# Byte-level files write the bytes that do not print as the characters from 256 on, in order.
_BYTES = {b: chr(b) for b in (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))}
_BYTES.update({b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _BYTES)})
_NO_ID = np.iinfo(np.int64).min


def _by_word(spec: dict) -> bool:
    """Whether a text's ids are those of its white-space-separated words, one after another."""
    steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    level = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[-1]
    return (steps == ["NFC", "Replace", "Lowercase"] and level.get("type") == "ByteLevel" and level.get("add_prefix_space") is False
            and level.get("use_regex") is False and split.get("type") == "Split" and split.get("behavior") == "Removed"
            and split.get("invert") is True and split.get("pattern") == {"Regex": _SPLIT})


def _distinct(parts: list[words.Slice]) -> tuple[list[bytes], np.ndarray]:
    """As :func:`words.distinct`, in order of appearance: a hash table instead of a sort."""
    index, _ = pd.factorize(np.concatenate([p.word_hashes() for p in parts]))
    first = np.flatnonzero(np.diff(np.maximum.accumulate(index), prepend=-1))
    begin = np.concatenate([[0], np.cumsum([len(p.starts) for p in parts])])
    found = []
    for p, a, b in zip(parts, begin, begin[1:]):
        own = first[np.searchsorted(first, a):np.searchsorted(first, b)] - a
        raw = p.data.tobytes()
        found += [raw[s:e] for s, e in zip(p.starts[own].tolist(), p.ends[own].tolist())]
    return found, index


class Encoder:
    """Ids of words by the tokenizers library, each different word once while it is remembered."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.by_word = _by_word(json.loads(spec))
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() < 1 << 16 else np.uint32
        self.code = np.dtype(self.kind).char

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, piece: str) -> bytes:
        written = piece if piece.isascii() else "".join([_BYTES[b] for b in piece.encode()])
        ids = self.pieces[piece] = array(self.code, [t.id for t in self.tokenizer.model.tokenize(written)]).tobytes()
        return ids

    def learn(self, found: list[bytes]) -> None:
        """Remember the ids of ``found``.

        Printable ASCII and Latin-1 letters need no normalisation but case, and their pieces are those of the file's
        pattern, so the library's model is asked for them piece by piece; everything else goes through the whole library.
        """
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        if len(self.pieces) > KEPT_WORDS:
            self.pieces.clear()
        # No word holds a line end, so it can part the words of one long text; an id that no piece has stands for it.
        mark = np.iinfo(self.kind).max
        self.pieces["\n"] = array(self.code, [mark]).tobytes()
        plain, others, latin = [], [], _LATIN.fullmatch
        for w in found:
            if w not in self.words:
                (plain if latin(w) and b"<|" not in w else others).append(w)
        if plain:
            pieces = _PLAIN.findall(b"\n".join(plain).decode().lower() + "\n")
            for p in set(pieces).difference(self.pieces):
                self._piece(p)
            raw = b"".join(map(self.pieces.__getitem__, pieces))
            ends = np.flatnonzero(np.frombuffer(raw, self.kind) == mark) * self.kind().itemsize
            starts = np.concatenate([[0], ends[:-1] + self.kind().itemsize])
            self.words.update(zip(plain, [raw[x:y] for x, y in zip(starts.tolist(), ends.tolist())]))
        for w, ids in zip(others, self.whole([w.decode("utf-8", "replace") for w in others])):
            self.words[w] = array(self.code, ids).tobytes()

    def texts(self, parts: list[words.Slice], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, ``end`` after each, and how many each has."""
        n = sum(p.n for p in parts)
        if not self.by_word:
            each = self.whole([p.text(i).decode("utf-8", "replace") for p in parts for i in range(p.n)])
            return np.array([i for ids in each for i in [*ids, end]], np.int64), np.array([len(ids) + 1 for ids in each], np.int64)
        found, index = _distinct(parts)
        self.learn(found)
        raw = [self.words[w] for w in found]
        flat = np.frombuffer(b"".join(raw), self.kind)
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // self.kind().itemsize
        begin = np.cumsum(size) - size
        rows = np.concatenate([p.row + b for p, b in zip(parts, np.cumsum([0, *(p.n for p in parts)]))])
        per_word = size[index]
        sizes = np.bincount(rows, weights=per_word, minlength=n).astype(np.int64) + 1
        out = np.empty(int(sizes.sum()), np.int64)
        stop = np.cumsum(sizes) - 1
        out[stop] = end
        target = np.cumsum(per_word) - per_word + rows
        inner = np.arange(int(per_word.sum())) - np.repeat(np.cumsum(per_word) - per_word, per_word)
        out[np.repeat(target, per_word) + inner] = flat[np.repeat(begin[index], per_word) + inner]
        return out, sizes


@lru_cache(maxsize=1)
def _remembering(spec: str) -> Encoder:
    """One encoder per Python worker: what it has learned serves all tasks that the worker runs."""
    return Encoder(spec)


def _encoder(spec, end: int, vocabulary: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = _remembering(spec.value), TaskContext.get().partitionId(), 0
        counts = np.zeros(vocabulary, np.int64)
        held: list[tuple] = []
        size = 0

        def row(nothing: bool = False):
            docs, sizes, ids = (np.concatenate([h[k] for h in held]) for k in range(3))
            values = (part, seq, docs.tobytes(), sizes.astype(np.uint32).tobytes(), ids.astype(encoder.kind).tobytes(), None)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _RAW_ARROW)], schema=_RAW_ARROW)

        for batch in batches:
            doc_ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            for parts in words.groups(batch.column("text"), GROUP_BYTES):
                ids, sizes = encoder.texts(parts, end)
                counts += np.bincount(ids, minlength=vocabulary)
                held.append((doc_ids[parts[0].first:parts[0].first + len(sizes)], sizes, ids))
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield row()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield row()
        if counts.any():
            values = (part, -1, None, None, None, counts.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _RAW_ARROW)], schema=_RAW_ARROW)

    return encode


def _each_count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per id of all count rows of a task."""
    total = None
    for batch in batches:
        for raw in batch.column("counts"):
            own = np.frombuffer(raw.as_py(), np.int64)
            total = own.copy() if total is None else total + own
    if total is not None:
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])


def _packer(lengths, kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = lengths.value
        code = huffman.codes(size)
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], kind).astype(np.int64)
                bits, checkpoints = huffman.pack(ids, size, code, EVERY)
                values = (r["part"], r["seq"], len(ids), r["docs"], r["sizes"], words.pack_sorted(checkpoints), bits)
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _BLOCK_ARROW)], schema=_BLOCK_ARROW)

    return run


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode every text, append ``end_id``, write the files and return their folder.

    ``tokenizer_path`` is a file of the tokenizers library on the driver; its contents go to the tasks. A null text is
    empty and has the end id alone. Rows without an id come first, rows that repeat one follow each other by text.
    An empty table writes no blocks.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    path = path or tables.run_folder(spark, "tokens")
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    vocabulary = max([end_id, *Tokenizer.from_str(text).get_vocab(with_added_tokens=True).values()]) + 1
    spec = spark.sparkContext.broadcast(text)
    base = tables.texts(docs, id_col, text_col)
    ranges = max(4, -(-tables.text_bytes(base) // RANGE_BYTES))
    ordered = base.repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", "text")
    raw = tables.stage(ordered.mapInArrow(_encoder(spec, end_id, vocabulary), _RAW), "ids")
    each = raw.where("seq < 0").select("counts").mapInArrow(_each_count, "id bigint, n bigint")
    counts = np.zeros(vocabulary, np.int64)
    for r in each.groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most a row per id of the vocabulary
        counts[r.id] = r.n
    lengths = huffman.code_lengths(counts)
    kind = np.uint16 if vocabulary < 1 << 16 else np.uint32
    code = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(code, "id int, length int").coalesce(1).write.parquet(f"{path}/code")
    packed = raw.where("seq >= 0").select("part", "seq", "docs", "sizes", "ids").mapInArrow(_packer(spark.sparkContext.broadcast(lengths), kind), _BLOCK)
    packed.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    return path


def _unpacker(lengths, keep_ids: bool):
    names = ["part", "seq", "doc_id", "before", "n_tokens", "ids_crc32", *["ids"] * keep_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = huffman.decode_table(lengths.value)
        for batch in batches:
            for r in batch.to_pylist():
                ids = huffman.unpack(r["bits"], words.unpack_sorted(r["checkpoints"]), r["n_ids"], EVERY, table).astype("<u4")
                sizes = np.frombuffer(r["sizes"], np.uint32).astype(np.int64)
                docs = np.frombuffer(r["docs"], np.int64)
                raw, stop = memoryview(ids.tobytes()), np.cumsum(sizes)
                parts = [raw[4 * (b - n):4 * b] for n, b in zip(sizes.tolist(), stop.tolist())]
                n = len(docs)
                columns = [pa.array(np.full(n, r["part"], np.int32)), pa.array(np.full(n, r["seq"], np.int32)),
                           pa.array(docs, mask=docs == _NO_ID), pa.array(stop - sizes), pa.array(sizes),
                           pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                if keep_ids:
                    columns.append(pa.array([np.frombuffer(p, np.uint32).tolist() for p in parts], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_token_files(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """Per document of the files, in no order: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, if asked, ``ids``."""
    code = spark.read.parquet(f"{path}/code").collect()  # at most a row per id of the vocabulary
    lengths = np.zeros(max([r.id for r in code], default=0) + 1, np.uint8)
    for r in code:
        lengths[r.id] = r.length
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    # A number per block is added up inside its part, and a number per part over all parts.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", earlier(Window.orderBy("part")).alias("_parts"))
    inside = blocks.select("part", "seq", F.col("n_ids").alias("n")).select(
        "part", "seq", earlier(Window.partitionBy("part").orderBy("seq")).alias("_blocks"))
    shape = "part int, seq int, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * keep_ids
    rows = blocks.mapInArrow(_unpacker(spark.sparkContext.broadcast(lengths), keep_ids), shape)
    placed = rows.join(inside.join(parts, "part"), ["part", "seq"])
    return placed.select("doc_id", (F.col("before") + F.col("_blocks") + F.col("_parts")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * keep_ids)
