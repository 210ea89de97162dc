"""Find benchmark passages in documents, verbatim or reworded: latent semantic search, then word order and answer.

The vocabulary is the benchmark's words. Passages are windows of a text, weighed by TF-IDF with document frequencies
counted over all documents; a randomised singular value decomposition of all passages and all
benchmark items gives the latent space, in passes that Spark adds up. Every window of every document is then placed
in that space and compared with every part of every item, in blocks of items. Candidates are confirmed by the longest
common subsequence of words around the window; a weak one also by the item's answer, its last words, or by a long
unbroken run of the item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm import tables, words

STEP = 8
WINDOW = 4 * STEP
RANK = 48
POWER_ROUNDS = 2
# Passages multiplied at a time, as a matrix over the words that they have, and words whose sums travel together.
PASSAGES = 128
BLOCK = 64
COSINE = 0.6
# Least share of an item part's summed idf that a window must have to be a candidate for it: far below COMMON.
MASS = 0.4
# How much more an item's passage weighs in the decomposition than a document's.
ITEM_WEIGHT = 10
COMMON = 0.7
# From this share of an item's words in order, or of them in one unbroken run, an item is found without its answer.
STRONG = 0.85
UNBROKEN = 0.5
ANSWER_WORDS = 4
ANSWER_COMMON = 0.5
# Items searched at a time, so that what is broadcast stays bounded however many items there are.
ITEMS = 5_000


MARKS = b".,;:!?\"'()[]{}*_#|<>-"
_MARK = np.isin(np.arange(256), list(MARKS))


def folded(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes in lower case, for the letters of ASCII and Latin-1."""
    low = words.LOWER[data]
    if len(data) > 1:
        after = data[1:]
        low[1:][(data[:-1] == 0xC3) & (after >= 0x80) & (after <= 0x9E) & (after != 0x97)] += 0x20
    return low


def pieces(text: bytes) -> list[bytes]:
    """Lower-case words without punctuation around them, an empty one for a word of punctuation alone."""
    return [w.strip(MARKS) for w in folded(np.frombuffer(text, np.uint8)).tobytes().split()]


def normal(text: bytes) -> list[bytes]:
    """:func:`pieces` without the empty ones."""
    return [w for w in pieces(text) if w]


@dataclass(frozen=True)
class Space:
    """Words with their place, and their latent vectors times inverse document frequencies."""

    place: dict[bytes, int]
    idf: np.ndarray
    vectors: np.ndarray


class Lookup:
    """Places of a slice's words in a vocabulary, by hash: a mistaken word can only propose, not confirm."""

    def __init__(self, place: dict[bytes, int]):
        data = np.frombuffer(b"".join(place), np.uint8)
        ends = np.cumsum([len(w) for w in place])
        hashes = words.range_hashes(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)
        order = np.argsort(hashes)
        self.hashes, self.place = hashes[order], np.fromiter(place.values(), np.int64, len(place))[order]

    def __call__(self, part: words.Slice) -> np.ndarray:
        data = folded(part.data)
        start, end = part.starts.copy(), part.ends.copy()
        for edge, step, look in ((start, 1, 0), (end, -1, -1)):
            todo = np.arange(len(edge))
            while len(todo):
                todo = todo[start[todo] < end[todo]]
                todo = todo[_MARK[data[edge[todo] + look]]]
                edge[todo] += step
        hashes = words.range_hashes(data, start, end)
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where((self.hashes[at] == hashes) & (start < end), self.place[at], -1)


def _places(tokens: list[bytes], place: dict[bytes, int]) -> np.ndarray:
    get = place.get
    return np.fromiter((get(w, -1) for w in tokens), np.int64, len(tokens))


def _steps(at: np.ndarray, counts: np.ndarray, size: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word's step of ``size`` words, steps not crossing texts, and the first step of each text."""
    per_text = -(-counts // size)
    first = np.cumsum(per_text) - per_text
    inside = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(first, counts) + inside // size, first


def _passages(groups: np.ndarray, terms: np.ndarray) -> tuple[bytes, bytes]:
    """Words of consecutive passages and the number of each passage's words."""
    _, length = words.runs(groups)
    return terms.astype(np.int32).tobytes(), length.astype(np.uint8).tobytes()


def _frequencies(place):
    """Per slice of texts its passages; per task the number of passages of each word, and under -1 of all."""
    out = pa.schema([("term", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("lengths", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, look = len(place.value), Lookup(place.value)
        total, passages = np.zeros(size, np.int64), 0
        for batch in batches:
            for part in words.slices(batch.column("text")):
                at = look(part)
                window, _ = _steps(at, part.counts, WINDOW)
                known = at >= 0
                pair = np.unique(window[known] * size + at[known])
                total += np.bincount(pair % size, minlength=size)
                passages += int(window[-1]) + 1 if len(window) else 0
                if len(pair):
                    columns = zip((None, None, *_passages(pair // size, pair % size)))
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)
        used = np.append(np.flatnonzero(total), -1)
        none = pa.nulls(len(used), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(np.append(total[used[:-1]], passages)), none, none], schema=out)

    return run


def _product(right, idf):
    """Per task the share of A'(A R) in billionths, ``BLOCK`` words a row; A has a row for each passage, of its weight's length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, weights = right.value.astype(np.float32), idf.value.astype(np.float32)
        total, local = np.zeros(right.value.shape), np.empty(len(right.value), np.int64)
        for batch in batches:
            for raw, sizes, heavy in zip(*[batch.column(c) for c in ("terms", "lengths", "weight")]):
                terms, length = np.frombuffer(raw.as_buffer(), np.int32), np.frombuffer(sizes.as_buffer(), np.uint8).astype(np.int64)
                ends = np.cumsum(length)
                for low in range(0, len(length), PASSAGES):
                    own = length[low:low + PASSAGES]
                    some = terms[ends[low] - own[0]:ends[low + len(own) - 1]]
                    used = np.flatnonzero(np.bincount(some, minlength=len(local)))
                    local[used] = np.arange(len(used))
                    a = np.zeros((len(own), len(used)), np.float32)
                    a[np.repeat(np.arange(len(own)), own), local[some]] = weights[some]
                    a *= heavy.as_py() / np.maximum(np.sqrt(np.einsum("ij,ij->i", a, a)), 1e-12)[:, None]
                    total[used] += a.T @ (a @ r[used])
        whole = np.rint(total * 1e9).astype(np.int64)
        blocks = [k for k in range(0, len(whole), BLOCK) if whole[k:k + BLOCK].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int64()), pa.array([whole[k:k + BLOCK].tobytes() for k in blocks], pa.binary())], names=["first", "x"])

    return run


def _added(table: pa.Table) -> pa.Table:
    """The sum of the tasks' shares of one block: of whole numbers, so their order does not matter."""
    total = sum(np.frombuffer(x.as_buffer(), np.int64) for x in table.column("x"))
    return pa.table({"first": table.column("first")[:1], "x": pa.array([total.tobytes()], pa.binary())})


def fit(docs: DataFrame, items: list[list[bytes]], rank: int = RANK) -> Space:
    """Latent space of the items' words from all passages (``docs``: the output of :func:`tables.texts`)."""
    spark = docs.sparkSession
    vocabulary = sorted({w for tokens in items for w in tokens})
    place = {w: k for k, w in enumerate(vocabulary)}
    size = len(vocabulary)
    shared = spark.sparkContext.broadcast(place)
    counted = tables.stage(docs.mapInArrow(_frequencies(shared), "term bigint, n bigint, terms binary, lengths binary"), "frequencies")
    # At most a row per word of the items, and one for the number of passages.
    n = {r.term: r.n for r in counted.where("term is not null").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    idf = np.array([math.log((1 + n.get(-1, 0)) / (1 + n.get(k, 0))) + 0.1 for k in range(size)])
    own = [np.unique(_places(t[a:a + WINDOW], place)) for t in items for a in range(0, len(t), WINDOW)]
    own = _passages(np.repeat(np.arange(len(own)), [len(x) for x in own]), np.concatenate(own))
    own = spark.createDataFrame([(*map(bytearray, own), ITEM_WEIGHT)], "terms binary, lengths binary, weight int")
    passages = counted.where("terms is not null").select("terms", "lengths", F.lit(1).alias("weight")).union(own)
    weights = spark.sparkContext.broadcast(idf)
    basis = np.random.default_rng(0).standard_normal((size, min(rank + 8, size)))
    for _ in range(POWER_ROUNDS + 1):
        basis = np.linalg.qr(basis)[0]
        # A sum of at most (words of the items) x (rank + 8) numbers a task; one such sum comes back.
        parts = passages.mapInArrow(_product(spark.sparkContext.broadcast(basis), weights), "first bigint, x binary")
        sums = parts.groupBy("first").applyInArrow(_added, "first bigint, x binary").toArrow()
        following = np.zeros_like(basis)
        for k, x in zip(sums["first"].to_pylist(), sums["x"].to_pylist()):
            following[k:k + BLOCK] = np.frombuffer(x, np.int64).reshape(-1, basis.shape[1]) / 1e9
        basis = following
    left, strength, _ = np.linalg.svd(basis, full_matrices=False)
    kept = left[:, : min(rank, int((strength > strength.max(initial=0) * 1e-9).sum()) or 1)]
    return Space(place, idf.astype(np.float32), (kept * idf[:, None]).astype(np.float32))


def longest_common(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, a machine word at a time (Hyyro's bit-parallel form)."""
    masks: dict[bytes, int] = {}
    for k, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & masks.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def longest_run(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest run of words in both; empty words of ``b`` do not break it."""
    places: dict[bytes, list[int]] = {}
    for k, w in enumerate(a):
        places.setdefault(w, []).append(k)
    best, ending = 0, {}
    for w in b:
        if w:
            ending = {k: ending.get(k - 1, 0) + 1 for k in places.get(w, ())}
            best = max(best, *ending.values(), 0)
    return best


def _searcher(space, shared_items):
    out = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("common", pa.float64()), ("answer", pa.float64()), ("word", pa.int64()), ("text_key", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, vectors = space.value.place, space.value.vectors
        look = Lookup(place)
        items = shared_items.value
        parts, owner, heavy = [], [], []
        for k, (_, tokens) in enumerate(items):
            at = _places(tokens, place)
            for a in range(0, max(1, len(tokens) - WINDOW + STEP), STEP):
                parts.append(vectors[at[a:a + WINDOW]].sum(0))
                owner.append(k)
                heavy.append(float(space.value.idf[at[a:a + WINDOW]].sum()))
        query = np.array(parts)
        query /= np.maximum(np.linalg.norm(query, axis=1, keepdims=True), 1e-9)
        owner, heavy = np.array(owner), np.array(heavy) * MASS
        # A text that lacks more of an item's different words than may be missing from it cannot reach COMMON.
        needed = [(set(t), len(set(t)) - (1 - COMMON) * len(t) - 1e-9) for _, t in items]
        least = np.array([n for _, n in needed])
        own_words = np.concatenate([_places(list(w), place) for w, _ in needed])
        own_first = np.cumsum([len(w) for w, _ in needed]) - [len(w) for w, _ in needed]
        # A place for unknown words, which add nothing.
        none, vectors = len(vectors), np.vstack([vectors, np.zeros((1, vectors.shape[1]), vectors.dtype)])
        idf = np.append(space.value.idf.astype(np.float64), 0.0)
        gap = WINDOW // STEP - 1
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("text_key")
            for part in words.slices(batch.column("text")):
                if not len(part.starts):
                    continue
                at = look(part)
                at[at < 0] = none
                step, first = _steps(at, part.counts)
                # Empty steps after each text, so that no window reaches into the next one.
                per_text = -(-part.counts // STEP)
                first = first + np.arange(part.n) * gap
                n = int(per_text.sum()) + part.n * gap
                begin = np.cumsum(part.counts) - part.counts
                cells = np.full((n, STEP), none)
                cells[step + part.row * gap, (np.arange(len(at)) - begin[part.row]) % STEP] = at
                sums, filled = np.zeros((n, vectors.shape[1]), np.float32), np.zeros(n)
                for k in range(STEP):
                    sums += vectors[cells[:, k]]
                    filled += idf[cells[:, k]]
                text_of = np.repeat(np.arange(part.n), per_text + gap)
                window, mass = sums.copy(), filled.copy()
                for k in range(1, gap + 1):
                    window[:-k] += sums[k:]
                    mass[:-k] += filled[k:]
                starts = np.arange(n) - first[text_of] < per_text[text_of]
                some = np.flatnonzero(starts & (mass >= heavy.min()))
                norm = np.linalg.norm(window[some], axis=1)
                hits_at = []
                for low in range(0, len(some), 4096):
                    now = some[low:low + 4096]
                    cosine = (window[now] / np.maximum(norm[low:low + 4096, None], 1e-9)) @ query.T
                    near = np.flatnonzero((cosine >= COSINE) & (mass[now, None] >= heavy))
                    hits_at.append((now[near // len(query)], owner[near % len(query)], cosine.ravel()[near]))
                if not hits_at:
                    continue
                where, which, close = (np.concatenate(x) for x in zip(*hits_at))
                found: dict[tuple[int, int], list[tuple[float, int]]] = {}
                cut, length = words.runs(text_of[where])
                for low, m in zip(cut.tolist(), length.tolist()):
                    t = int(text_of[where[low]])
                    has = np.zeros(none + 1, np.uint8)
                    has[at[begin[t]:begin[t] + part.counts[t]]] = 1
                    enough = np.add.reduceat(has[own_words], own_first, dtype=np.int64) >= least
                    for h in (low + np.flatnonzero(enough[which[low:low + m]])).tolist():
                        found.setdefault((t, int(which[h])), []).append((float(close[h]), int(where[h] - first[t]) * STEP))
                rows, split = [], {}
                for (t, k), hits in found.items():
                    if t not in split:
                        split[t] = pieces(part.text(t))
                    item_id, tokens = items[k]
                    best = None
                    for cosine, word in sorted(hits, reverse=True):
                        around = split[t][max(0, word - len(tokens)):word + WINDOW + len(tokens)]
                        if len(needed[k][0].intersection(around)) < needed[k][1]:
                            continue
                        common = longest_common(tokens, around) / len(tokens)
                        if common >= COMMON and (best is None or common > best[1]):
                            answer = longest_common(tokens[-ANSWER_WORDS:], around) / len(tokens[-ANSWER_WORDS:])
                            if common >= STRONG or answer >= ANSWER_COMMON or longest_run(tokens, around) >= UNBROKEN * len(tokens):
                                best = (cosine, common, answer, word)
                                if common == 1.0:
                                    break
                    if best:
                        rows.append((ids[part.first + t].as_py(), item_id, *best, keys[part.first + t].as_py()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

    return search


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row per document and benchmark item found in it: ``doc_id``, ``item_id``, ``cosine``, ``common``, ``answer``, ``word``
    and a ``text_key``.

    ``common`` is the share of the item's words, in order, around the window at ``word``; it reaches ``COMMON``. Below
    ``STRONG``, ``ANSWER_COMMON`` of the item's last words are there too, or ``UNBROKEN`` of its words in one run. Case and punctuation around words do not count. Items without
    words (or null) match nothing, items that repeat each match by themselves. A null text has no windows. Rows that
    repeat an id, or have none, are searched each by itself and may give equal rows. Empty tables on either side give an
    empty result, other columns are ignored.
    """
    spark = docs.sparkSession
    base = tables.texts(docs, id_col, text_col)
    queries = benchmark.select(F.col(f"`{item_col}`").cast("bigint").alias("i"), F.col(f"`{item_text_col}`").cast("binary").alias("t")).where("t is not null")
    shape = "doc_id bigint, item_id bigint, cosine double, common double, answer double, word bigint, text_key bigint"
    result, held = None, []

    def searched(block):
        space = spark.sparkContext.broadcast(fit(base, [t for _, t in block]))
        return base.withColumn("text_key", tables.text_key()).mapInArrow(_searcher(space, spark.sparkContext.broadcast(block)), shape)

    # The benchmark is the stated query set; it streams to the driver and is searched in blocks of ``ITEMS``.
    for r in queries.orderBy("i", "t").toLocalIterator():
        tokens = normal(bytes(r.t))
        if tokens:
            held.append((r.i, tokens))
        if len(held) >= ITEMS:
            block = searched(held)
            result, held = block if result is None else result.union(block), []
    if held:
        block = searched(held)
        result = block if result is None else result.union(block)
    return spark.createDataFrame([], shape) if result is None else result
