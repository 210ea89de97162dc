"""Remove byte strings that repeat, within a document and across documents: intervals of a Burrows-Wheeler transform.

Equal strings must meet in one task before a transform can find them. So every string of ``WIDTH`` bytes names as its anchor
the :data:`GRAM`-byte substring of least hash in it; strings next to each other that share an anchor form a stretch of
text. Anchors are counted first, and stretches travel only if their anchor is found more than once. A task joins the stretches
of many anchors into one text, transforms it and expands intervals up to the threshold (``transform.py``): in each class of equal
strings all but the earliest are covered. Covered strings return to their document and merge into maximal runs of bytes.

Equal stretches are one text with several places, of which only the earliest is transformed: the others are covered, string by
string, by it. Groups of copies are so thinned where they are read, block by block, and again where their anchors meet. The anchors found most often (a bounded list) send single strings instead of stretches,
keyed by the whole string, so that one common phrase in many contexts spreads over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm import tables, transform, words

WIDTH = 100
GRAM = 24
# Bytes hashed at once, bytes of a block of documents, and symbols of one transform.
PIECE, BLOCK, SYMBOLS = 1 << 18, 16 << 20, 1_000_000
# An anchor found more often than this may send single strings; the list of such anchors is sent to every task.
OFTEN, MOST_OFTEN = 1 << 16, 1 << 16
# Anchors of a group with more text than a transform holds are made longer, step by step.
LONGER = (64, 92)
_SENT = pa.schema([("key", pa.int64()), ("rid", pa.int64()), ("n", pa.int64()), ("known", pa.bool_())])
_ROUTED = pa.schema([("key", pa.int64()), ("rid", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("text", pa.binary())])
_COVERED = pa.schema([("rid", pa.int64()), ("at", pa.int64()), ("n", pa.int64())])


def _pieces(column: pa.Array, overlap: int, limit: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, offsets, rows and bases of runs of texts; a longer text comes in pieces that share ``overlap`` bytes."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offs, values = column.buffers()
    offsets = np.frombuffer(offs, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        first, size = int(offsets[at]), int(offsets[at + 1] - offsets[at])
        if size > limit:
            for s in range(0, size - overlap, limit):
                e = min(s + limit + overlap, size)
                yield data[first + s:first + e], np.array([0, e - s]), np.array([at]), np.array([s])
            at += 1
        else:
            to = max(at + 1, int(np.searchsorted(offsets, first + limit, side="right")) - 1)
            yield data[first:offsets[to]], offsets[at:to + 1] - first, np.arange(at, to), np.zeros(to - at, np.int64)
            at = to


def anchors(data: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each stretch its first string, how many strings it has (as many as fit around one anchor), its anchor's hash and
    whether the anchor stands in it more than once, as it must where two of its own strings are equal."""
    n, span = len(data), width - gram + 1
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
    if n < width:
        return none
    grams, size = words.rolling_hashes(data, gram), 1
    least = grams
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[:size - span], least[span - size:])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    string = np.flatnonzero(row[:n - width + 1] == row[width - 1:])
    if not len(string):
        return none
    least = least[string]
    # A string that begins with the anchor and is followed by one of the same stretch: that one has the anchor again.
    begins = grams[string] == least
    new = np.ones(len(string), bool)
    new[1:] = (least[1:] != least[:-1]) | (string[1:] != string[:-1] + 1)
    begin = np.maximum.accumulate(np.where(new, np.arange(len(string)), 0))
    first = np.flatnonzero((np.arange(len(string)) - begin) % span == 0)
    size = np.diff(np.append(first, len(string)))
    again = np.add.reduceat(begins, first, dtype=np.int64) > begins[first + size - 1]
    return string[first], size, least[first], again


def _batch(columns, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _counter(width: int, gram: int):
    def block(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        h, r, n = (np.concatenate(c) for c in zip(*held)) if held else (np.empty(0, np.uint64),) * 3
        if not len(h):
            return
        order = np.lexsort((r, h))
        h, r = h[order], r[order]
        first, _ = words.runs(h)
        n = np.add.reduceat(n[order], first)
        yield _batch([h[first].view(np.int64), r[first], n, np.zeros(len(first), bool)], _SENT)
        # Found twice in the block: known to repeat, so the other documents need not ask.
        other = np.ones(len(h), bool)
        other[first] = False
        other[1:] &= (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        yield _batch([h[other].view(np.int64), r[other], np.full(int(other.sum()), 2), np.ones(int(other.sum()), bool)], _SENT)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            rid = batch.column("rid").to_numpy(zero_copy_only=False)
            for data, offsets, rows, _ in _pieces(batch.column("text"), width - 1):
                at, _, h, again = anchors(data, offsets, width, gram)
                held.append((h, rid[rows[np.searchsorted(offsets, at, side="right") - 1]], 1 + again.astype(np.int64)))
                size += len(data)
                if size >= BLOCK:
                    yield from block(held)
                    held, size = [], 0
        yield from block(held)

    return count


def _member(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def _gathered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The bytes of the ranges, one after another."""
    lengths = end - start
    return data[np.repeat(start - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())]


def _earliest(same: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of texts with equal hashes the earliest, and all others."""
    order = np.lexsort((at, doc, same))
    first, lengths = words.runs(same[order])
    head = np.repeat(order[first], lengths)
    # Rows that share id and place count as one and are not covered by each other.
    go = (doc[order] == doc[head]) & (at[order] == at[head])
    return order[go], order[~go]


def _text_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the ranges, some at a time: memory does not follow the data."""
    some = max(1, PIECE // max(1, int((end - start).max(initial=1))))
    found = [np.empty(0, np.uint64)]
    for k in range(0, len(start), some):
        size = np.cumsum(end[k:k + some] - start[k:k + some])
        found.append(words.range_hashes(_gathered(data, start[k:k + some], end[k:k + some]), np.concatenate([[0], size[:-1]]), size))
    return np.concatenate(found)


def _longer(data, start, end, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of the ranges by a longer anchor, in order of it: range, first string, strings and key."""
    some, parts = max(1, PIECE // max(1, int((end - start).max(initial=1)))), []
    for k in range(0, len(start), some):
        offsets = np.concatenate([[0], np.cumsum(end[k:k + some] - start[k:k + some])])
        at, n, key, _ = anchors(_gathered(data, start[k:k + some], end[k:k + some]), offsets, width, gram)
        which = np.searchsorted(offsets, at, side="right") - 1
        parts.append((which + k, at - offsets[which], n, key))
    which, at, n, key = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(key, kind="stable")
    return which[order], at[order], n[order], key[order]


class _Held:
    """Stretches of one block of documents."""

    def __init__(self):
        self.data, self.size, self.columns = [], 0, []

    def add(self, data, start, n, key, rid, doc, at, width):
        self.columns.append((start + self.size, n, key, rid, doc, at, words.range_hashes(data, start, start + n + width - 1)))
        self.data.append(data)
        self.size += len(data)

    def send(self, width: int, often: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not self.columns:
            return
        data = np.concatenate(self.data)
        start, n, key, rid, doc, at, same = (np.concatenate(c) for c in zip(*self.columns))
        go, covered = _earliest(same, doc, at)
        yield from self._covered(rid[covered], at[covered], n[covered])
        single = _member(key[go], often)
        split, go = go[single], go[~single]
        yield from self._stretches(data, start[go], start[go] + n[go] + width - 1, key[go], rid[go], doc[go], at[go])
        for k in range(0, len(split), 2000):
            # Single strings of the most frequent anchors, keyed by the whole string.
            some = split[k:k + 2000]
            own = _gathered(data, start[some], start[some] + n[some] + width - 1)
            begin = np.cumsum(n[some] + width - 1) - (n[some] + width - 1)
            which = np.repeat(np.arange(len(some)), n[some])
            step = np.arange(len(which)) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
            s, a, r, d = begin[which] + step, at[some][which] + step, rid[some][which], doc[some][which]
            whole = words.range_hashes(own, s, s + width)
            go, covered = _earliest(whole, d, a)
            yield from self._covered(r[covered], a[covered], np.ones(len(covered), np.int64))
            yield from self._stretches(own, s[go], s[go] + width, whole[go].view(np.int64), r[go], d[go], a[go])

    @staticmethod
    def _covered(rid, at, n) -> Iterator[pa.RecordBatch]:
        if len(rid):
            yield _batch([pa.nulls(len(rid), pa.int64()), rid, pa.nulls(len(rid), pa.int64()), at, n, pa.nulls(len(rid), pa.binary())], _ROUTED)

    @staticmethod
    def _stretches(data, start, end, key, rid, doc, at) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(key), 10_000):
            cut = slice(k, k + 10_000)
            lengths = end[cut] - start[cut]
            yield _batch([key[cut], rid[cut], doc[cut], at[cut], lengths, words.binaries(_gathered(data, start[cut], end[cut]), lengths)], _ROUTED)


def _router(width: int, gram: int, often: np.ndarray):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for batch in batches:
            rid, doc = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rid", "doc_id"))
            repeated = np.unique(batch.column("hashes").flatten().to_numpy(zero_copy_only=False))
            for data, offsets, rows, base in _pieces(batch.column("text"), width - 1):
                start, n, h, _ = anchors(data, offsets, width, gram)
                key = h.view(np.int64)
                found = np.flatnonzero(_member(key, repeated))
                if not len(found):
                    continue
                start, piece = start[found], np.searchsorted(offsets, start[found], side="right") - 1
                held.add(data, start, n[found], key[found], rid[rows[piece]], doc[rows[piece]].astype(np.int64), start - offsets[piece] + base[piece], width)
                if held.size >= BLOCK:
                    yield from held.send(width, often)
                    held = _Held()
        yield from held.send(width, often)

    return route


def _later(number, doc, at) -> np.ndarray:
    """Strings that are not the earliest of their class; classes stand together."""
    first, lengths = words.runs(number)
    if not len(first):
        return np.empty(0, bool)
    least = np.repeat(np.minimum.reduceat(doc, first), lengths)
    place = np.repeat(np.minimum.reduceat(np.where(doc == least, at, np.iinfo(np.int64).max), first), lengths)
    return (doc > least) | (at > place)


def _runs_of(rid: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(rid):
        order = np.lexsort((at, rid))
        rid, at = rid[order], at[order]
        new = np.ones(len(rid), bool)
        new[1:] = (rid[1:] != rid[:-1]) | (at[1:] > at[:-1] + 1)
        first = np.flatnonzero(new)
        # Equal rows give the same place more than once.
        yield _batch([rid[first], at[first], at[np.append(first[1:], len(rid)) - 1] - at[first] + 1], _COVERED)


def _units(key: np.ndarray, sizes: np.ndarray, symbols: int) -> Iterator[tuple[int, int]]:
    """Whole runs of equal keys, together up to about so many symbols."""
    first, _ = words.runs(key)
    begin, held = 0, 0
    for at, size in zip(first.tolist(), np.add.reduceat(sizes, first).tolist() if len(first) else []):
        if held and held + size > symbols:
            yield begin, at
            begin, held = at, 0
        held += size
    if held:
        yield begin, len(key)


def _expander(width: int, symbols: int, longer: tuple[int, ...]):
    def solve(rid, doc, at, data, starts, ends, grams) -> Iterator[pa.RecordBatch]:
        # Equal stretches are one text with several places: whatever the classes of its strings, its later places are covered.
        go, covered = _earliest(_text_hashes(data, starts, ends), doc, at)
        if len(covered):
            yield _batch([rid[covered], at[covered], (ends - starts)[covered] - width + 1], _COVERED)
        rid, doc, at, starts, ends = rid[go], doc[go], at[go], starts[go], ends[go]
        if (ends - starts + 1).sum() <= transform.MOST:
            number, which, offset = transform.classes(data, starts, ends, width)
            place = at[which] + offset
            late = _later(number, doc[which], place)
            yield from _runs_of(rid[which[late]], place[late])
            return
        # One anchor in more text than a transform holds: its strings are dealt by longer anchors, at last by themselves.
        text, first, n, key = _longer(data, starts, ends, width, grams[0])
        rid, doc, at, start = rid[text], doc[text], at[text] + first, starts[text] + first
        end = start + n + width - 1
        for a, b in _units(key, end - start + 1, symbols):
            if len(grams) > 1:
                yield from solve(rid[a:b], doc[a:b], at[a:b], data, start[a:b], end[a:b], grams[1:])
            else:
                late = _later(np.cumsum(np.concatenate([[0], key[a + 1:b] != key[a:b - 1]])), doc[a:b], at[a:b])
                yield from _runs_of(rid[a:b][late], at[a:b][late])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            own = batch.column("text").is_null().to_numpy(zero_copy_only=False)
            if own.any():
                done = batch.filter(pa.array(own))
                yield _batch([done.column(c) for c in _COVERED.names], _COVERED)
                batch = batch.filter(pa.array(~own))
            if not len(batch):
                continue
            key = batch.column("key").to_numpy(zero_copy_only=False)
            # The last anchor may go on in the next batch.
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
            if cut == 0 and held and held[-1].column("key")[-1].as_py() != key[0]:
                yield from unit(held)
                held, size = [], 0
            if cut:
                held.append(batch.slice(0, cut))
                size += batch.column("n").slice(0, cut).to_numpy(zero_copy_only=False).sum() + cut
                if size >= symbols:
                    yield from unit(held)
                    held, size = [], 0
            held.append(batch.slice(cut))
            size += batch.column("n").slice(cut).to_numpy(zero_copy_only=False).sum() + len(batch) - cut
        yield from unit(held)

    def unit(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        table = pa.Table.from_batches(held)
        rid, doc, at, key = (table[c].to_numpy() for c in ("rid", "doc_id", "at", "key"))
        texts, n = table["text"].to_pylist(), table["n"].to_numpy()
        data, end = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(n)
        for a, b in _units(key, n + 1, symbols):
            yield from solve(rid[a:b], doc[a:b], at[a:b], data, end[a:b] - n[a:b], end[a:b], (*longer, width))

    return expand


def _remover(width: int):
    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            spans, texts, ids = batch.column("spans"), batch.column("text"), batch.column("doc_id").to_pylist()
            for i in range(len(batch)):
                text, own = texts[i].as_py(), spans[i]
                cuts = []
                if own.is_valid and len(own):
                    flat = own.values
                    at, n = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("at", "n"))
                    order = np.argsort(at)
                    lo, hi = at[order], np.maximum.accumulate((at + n - 1 + width)[order])
                    new = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]]))
                    cuts = [{"start": a, "end": b} for a, b in zip(lo[new].tolist(), hi[np.append(new[1:], len(hi)) - 1].tolist())]
                parts, end = [], 0
                for c in cuts:
                    parts.append(text[end:c["start"]])
                    end = c["end"]
                kept = b"".join([*parts, text[end:]])
                rows.append((ids[i], len(text), cuts, hashlib.sha256(kept).hexdigest(), kept))
                size += len(kept)
                if size >= PIECE:
                    yield _batch(list(zip(*rows)), out)
                    rows, size = [], 0
            if rows:
                yield _batch(list(zip(*rows)), out)

    return remove


def interval_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM,
                   often: int = OFTEN, symbols: int = SYMBOLS, longer: tuple[int, ...] = LONGER) -> DataFrame:
    """Per row ``doc_id``, ``n_bytes``, ``removed`` (byte intervals ``[start, end)``), ``kept_sha256`` and ``kept`` (bytes).

    A byte goes when a string of ``width`` bytes that covers it also starts earlier: in a row of smaller id, or before in the same
    id; strings may overlap and are judged on the input. A null text is empty; texts under ``width`` bytes stay whole. A row
    without an id stays whole and covers nothing. Rows that repeat an id are one document: the same place in two of them is not
    earlier than itself, so equal rows cover each other no more than one row covers itself. An empty table gives an empty
    result; other columns are ignored, whatever their names. Equal stretches in a block, and the strings of the most frequent
    anchors, are told apart by 64-bit hashes: among n of them about n^2 / 2^65 pairs collide.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = tables.texts(docs, id_col, text_col).withColumn("rid", F.xxhash64("doc_id", "text"))
    sent = base.where("doc_id IS NOT NULL").select("rid", "text").mapInArrow(_counter(width, gram), "key bigint, rid bigint, n bigint, known boolean")
    # One shuffle for both: anchors meet by their hash, what is known already goes to its document.
    dealt = sent.withColumn("to", F.when(F.col("known"), F.col("rid")).otherwise(F.col("key"))).repartition(parts, "known", "to")
    counted = dealt.withColumn("total", F.sum("n").over(Window.partitionBy("known", "to")))
    repeated = tables.stage(counted.where("known OR total > 1").select("key", "rid", F.when(~F.col("known"), F.col("total")).alias("total")), "anchors")
    common = repeated.where(F.col("total") > often).groupBy("key").agg(F.max("total").alias("total")).orderBy(F.desc("total"), "key").limit(MOST_OFTEN)
    often_keys = np.sort(np.array([r["key"] for r in common.collect()], np.int64))
    hashes = repeated.groupBy("rid").agg(F.collect_set("key").alias("hashes"))
    text = base.repartition(parts, "rid")
    found = text.join(hashes.hint("merge"), "rid").mapInArrow(
        _router(width, gram, often_keys), "key bigint, rid bigint, doc_id bigint, at bigint, n bigint, text binary")
    routed = found.repartition(parts, F.coalesce("key", "rid")).sortWithinPartitions("key")
    covered = routed.mapInArrow(_expander(width, symbols, longer), "rid bigint, at bigint, n bigint")
    spans = covered.groupBy("rid").agg(F.collect_list(F.struct("at", "n")).alias("spans"))
    return text.join(spans.hint("merge"), "rid", "left").select("doc_id", "text", "spans").mapInArrow(
        _remover(width), "doc_id bigint, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept_sha256 string, kept binary")
