"""Remove passages that repeat across documents: Rabin-Karp hashes of every fixed-length word window.

Each task hashes all windows of its texts and sorts them in blocks. Inside a block a window seen in several
documents is settled at once and goes on with its smallest document only, so a window that a third of all
documents share sends one entry per block. The entries meet by hash range, where the smallest document of each
window is known; what returns to a document are the hashes of its windows that start in a smaller one. Covered
windows are then merged into maximal intervals of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm import tables, words

WIDTH = 50
# Windows held by a task before they are sorted and sent, and text bytes a hash range stands for.
BLOCK = 3_000_000
RANGE_BYTES = 8 << 20
_SENT = pa.schema([("range", pa.int32()), ("part", pa.int32()), ("hashes", pa.binary()), ("docs", pa.binary()), ("ids", pa.binary())])
_COVERED = pa.schema([("part", pa.int32()), ("hashes", pa.binary()), ("docs", pa.binary())])
_DOCUMENT = pa.schema([("doc_id", pa.int64()), ("hashes", pa.binary())])


def _by_part(hashes: np.ndarray, docs: np.ndarray, parts: int) -> pa.RecordBatch:
    """A row for each part of the documents: hashes and ids side by side, by document."""
    part = (words.mix(docs.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int32)
    order = np.lexsort((docs, part))
    first, lengths = words.runs(part[order])
    return pa.RecordBatch.from_arrays(
        [pa.array(part[order][first], pa.int32()), words.binaries(hashes[order], lengths).cast(pa.binary()),
         words.binaries(docs[order].astype(np.int64), lengths).cast(pa.binary())], schema=_COVERED)


def _block(hashes: list[np.ndarray], docs: list[np.ndarray], ranges: int, parts: int) -> Iterator[pa.RecordBatch]:
    if not hashes:
        return
    h, d = np.concatenate(hashes), np.concatenate(docs)
    ids, rank = np.unique(d, return_inverse=True)
    order = np.argsort(h)
    h, rank = h[order], rank[order].astype(np.uint32)
    first, lengths = words.runs(h)
    least = np.minimum.reduceat(rank, first)
    later = rank > np.repeat(least, lengths)
    if later.any():
        part, packed, docs_of = _by_part(h[later], ids[rank[later]], parts).columns
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.to_numpy() % ranges, pa.int32()), part, packed, docs_of, pa.nulls(len(part), pa.binary())], schema=_SENT)
    h = h[first]
    # Ranges of the top 32 bits, so that any number of ranges is even.
    where = ((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    at, n = words.runs(where)
    small = np.uint16 if len(ids) <= 1 << 16 else np.uint32
    rows = []
    for a, m in zip(at, n):
        used, local = np.unique(least[a:a + m], return_inverse=True)
        rows.append((int(where[a]), None, words.pack_sorted(h[a:a + m]),
                     bytes([small().itemsize]) + local.astype(small).tobytes(), words.pack_sorted(ids[used].astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63))))
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SENT)], schema=_SENT)


def _sender(width: int, ranges: int, parts: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, docs, held = [], [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for part in words.slices(batch.column("text")):
                h, first = words.window_hashes(part.word_hashes(), part.row, width)
                if len(h):
                    hashes.append(h)
                    docs.append(ids[part.first + part.row[first]])
                    held += len(h)
                if held >= BLOCK:
                    yield from _block(hashes, docs, ranges, parts)
                    hashes, docs, held = [], [], 0
        yield from _block(hashes, docs, ranges, parts)

    return send


def _settler(parts: int):
    def settle(table: pa.Table) -> pa.Table:
        """Of one hash range: for each document the hashes that a smaller document has as well."""
        passed = table.filter(table["part"].is_valid()).select(_COVERED.names)
        blocks = table.filter(table["part"].is_null())
        hashes, docs = [], []
        for h, d, ids in zip(*(blocks[c].to_pylist() for c in ("hashes", "docs", "ids"))):
            hashes.append(words.unpack_sorted(h))
            known = (words.unpack_sorted(ids) ^ np.uint64(1 << 63)).view(np.int64)
            docs.append(known[np.frombuffer(d, np.uint16 if d[0] == 2 else np.uint32, offset=1)])
        if not hashes:
            return passed.cast(_COVERED)
        h, d = np.concatenate(hashes), np.concatenate(docs)
        order = np.argsort(h)
        h, d = h[order], d[order]
        first, lengths = words.runs(h)
        later = d > np.repeat(np.minimum.reduceat(d, first), lengths)
        return pa.concat_tables([passed.cast(_COVERED), pa.Table.from_batches([_by_part(h[later], d[later], parts)])])

    return settle


def _gather(table: pa.Table) -> pa.Table:
    """Of one part of the documents: one row each, with all its covered hashes."""
    h = np.frombuffer(b"".join(table["hashes"].to_pylist()), np.uint64)
    d = np.frombuffer(b"".join(table["docs"].to_pylist()), np.int64)
    order = np.argsort(d)
    first, lengths = words.runs(d[order])
    return pa.Table.from_arrays([pa.array(d[order][first], pa.int64()), words.binaries(h[order], lengths).cast(pa.binary())], schema=_DOCUMENT)


def _remover(width: int):
    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered, rows = batch.column("hashes"), []
            ids = batch.column("doc_id").to_pylist()
            for part in words.slices(batch.column("text")):
                hashed = None
                for i in range(part.n):
                    tokens, spans = part.text(i).split(), []
                    known = covered[part.first + i].as_py()
                    if known:
                        if hashed is None:
                            hashed, begin = part.word_hashes(), np.concatenate([[0], np.cumsum(part.counts)])
                        own = hashed[begin[i]:begin[i + 1]]
                        h, first = words.window_hashes(own, np.zeros(len(own), np.int8), width)
                        hit = first[np.isin(h, np.frombuffer(known, np.uint64))]
                        if len(hit):
                            cut = np.flatnonzero(hit[1:] > hit[:-1] + width)
                            lo, hi = hit[np.concatenate([[0], cut + 1])], hit[np.concatenate([cut, [-1]])] + width
                            spans = [{"start": int(a), "end": int(b)} for a, b in zip(lo, hi)]
                    n = len(tokens)
                    for s in reversed(spans):
                        del tokens[s["start"]:s["end"]]
                    rows.append((ids[part.first + i], n, spans, b" ".join(tokens).decode("utf-8", "replace")))
                if len(rows) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

    return remove


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, ``removed`` (word intervals ``[start, end)``) and ``kept_text``.

    A word goes when a window of ``width`` words that covers it also starts in a row with a smaller id, judged on
    the input. A null text has no words. A null id is smaller than none and has none smaller: its row stays whole.
    Rows that repeat an id count as one document, none of them smaller. Texts under ``width`` words stay whole.
    An empty table gives an empty result; other columns are ignored, whatever their names. Windows are equal when
    their 64-bit hashes are: among n windows about n^2 / 2^65 pairs collide.
    """
    base = tables.texts(docs, id_col, text_col)
    ranges = max(4, -(-tables.text_bytes(base) // RANGE_BYTES))
    parts = max(4, ranges // 4)
    sent = base.where("doc_id is not null").mapInArrow(
        _sender(width, ranges, parts), "range int, part int, hashes binary, docs binary, ids binary")
    covered = sent.repartition(ranges, "range").groupBy("range").applyInArrow(
        _settler(parts), "part int, hashes binary, docs binary")
    per_doc = covered.repartition(parts, "part").groupBy("part").applyInArrow(_gather, "doc_id bigint, hashes binary")
    joined = base.join(per_doc.hint("merge"), "doc_id", "left").select("doc_id", "text", "hashes")
    return joined.mapInArrow(
        _remover(width), "doc_id bigint, n_words bigint, removed array<struct<start:bigint,end:bigint>>, kept_text string")
