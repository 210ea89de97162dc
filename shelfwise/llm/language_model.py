"""Interpolated modified Kneser-Ney bigram model, counted in Spark and stored as sorted hash arrays.

Counting: tasks count the word pairs of their texts in sorted blocks, the blocks meet by range of the history's
hash, and each range becomes one shard of sorted arrays in the shared folder. A history and all that follows it lie
in one shard, pre-counted per block, so a frequent pair sends one entry per block. Continuation counts (in how many
different histories a word follows) are added up by range of the word's hash.

Scoring: workers map the shards they need into memory and look up the sorted pairs of a batch in them. The
shared folder must be one that executors see as a file system; shards are written under a temporary name and
renamed, so a repeated task leaves the same files.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm import tables, words

BLOCK = 3_000_000
RANGE_BYTES = 16 << 20
MOST_RANGES = 1 << 16
START, END = (np.uint64(x) for x in words.sequence(2, 99))
_U = np.uint64
_PIECE = pa.schema([("range", pa.int32()), ("histories", pa.binary()), ("lengths", pa.binary()), ("tokens", pa.binary()), ("counts", pa.binary())])
_PIECE_SQL = "range int, histories binary, lengths binary, tokens binary, counts binary"
_STATS = "kind string, range int, figures array<bigint>, tokens binary, counts binary"
_STATS_ARROW = pa.schema([("kind", pa.string()), ("range", pa.int32()), ("figures", pa.list_(pa.int64())), ("tokens", pa.binary()), ("counts", pa.binary())])


def mounted(path: str) -> str:
    """The shared folder as a path of the file system."""
    scheme, colon, rest = path.partition(":")
    if not colon:
        return path
    if scheme == "file":
        return "/" + rest.lstrip("/")
    raise ValueError(f"memory-mapped shards need a shared folder that is mounted as a file system, not {path}")


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return (((hashes >> _U(32)) * _U(ranges)) >> _U(32)).astype(np.int32)


def pair_key(history: np.ndarray, token: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return words.mix(history * _U(0x9E3779B97F4A7C15) + token)


def sentences(part: words.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Histories and tokens of all texts of a slice, an end after each text, and the first position of each text."""
    h = part.word_hashes(lower=True)
    first = np.concatenate([[0], np.cumsum(part.counts + 1)])
    token = np.empty(first[-1], _U)
    token[first[1:] - 1] = END
    token[np.arange(len(h)) + part.row] = h
    history = np.empty_like(token)
    history[1:] = token[:-1]
    history[first[:-1]] = START
    return history, token, first[:-1]


def _summed(history: np.ndarray, token: np.ndarray, count: np.ndarray | None):
    """Distinct pairs in order, with their counts."""
    order = np.lexsort((token, history))
    history, token = history[order], token[order]
    new = np.ones(len(order), bool)
    new[1:] = (history[1:] != history[:-1]) | (token[1:] != token[:-1])
    first = np.flatnonzero(new)
    if count is None:
        total = np.diff(np.append(first, len(order)))
    else:
        total = np.add.reduceat(count[order], first)
    return history[first], token[first], total.astype(np.int64)


def _narrow(counts: np.ndarray) -> bytes:
    kind = next(k for k in (np.uint8, np.uint32, np.uint64) if not len(counts) or counts.max() <= np.iinfo(k).max)
    return bytes([kind().itemsize]) + counts.astype(kind).tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, {1: np.uint8, 4: np.uint32, 8: np.uint64}[raw[0]], offset=1).astype(np.int64)


def _counter(ranges: int):
    def block(histories, tokens) -> Iterator[pa.RecordBatch]:
        if not histories:
            return
        h, t, c = _summed(np.concatenate(histories), np.concatenate(tokens), None)
        at, n = words.runs(range_of(h, ranges))
        rows = []
        for a, m in zip(at, n):
            first, length = words.runs(h[a:a + m])
            rows.append((int(range_of(h[a:a + 1], ranges)[0]), words.pack_sorted(h[a:a + m][first]), _narrow(length),
                         t[a:a + m].tobytes(), _narrow(c[a:a + m])))
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _PIECE)], schema=_PIECE)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        histories, tokens, held = [], [], 0
        for batch in batches:
            for part in words.slices(batch.column("text")):
                h, t, _ = sentences(part)
                histories.append(h)
                tokens.append(t)
                held += len(t)
                if held >= BLOCK:
                    yield from block(histories, tokens)
                    histories, tokens, held = [], [], 0
        yield from block(histories, tokens)

    return count


def _save(folder: str, name: str, array: np.ndarray) -> None:
    os.makedirs(folder, exist_ok=True)
    temporary = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(temporary, "wb") as out:
        np.save(out, array)
    os.replace(temporary, f"{folder}/{name}.npy")


def _tally(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _pair_shard(folder: str, ranges: int):
    def store(table: pa.Table) -> pa.Table:
        shard = table["range"][0].as_py()
        histories, tokens, counts = [], [], []
        for h, n, t, c in zip(*(table[x].to_pylist() for x in ("histories", "lengths", "tokens", "counts"))):
            histories.append(np.repeat(words.unpack_sorted(h), _wide(n)))
            tokens.append(np.frombuffer(t, _U))
            counts.append(_wide(c))
        h, t, c = _summed(np.concatenate(histories), np.concatenate(tokens), np.concatenate(counts))
        first, length = words.runs(h)
        totals = np.stack([np.add.reduceat(x, first) for x in (c, c == 1, c == 2, c >= 3)]).astype(np.int64)
        k = pair_key(h, t)
        order = np.argsort(k)
        _save(folder, f"pairs-{shard}", k[order])
        _save(folder, f"pair_counts-{shard}", c[order].astype(np.uint32 if c.max() < 1 << 32 else np.uint64))
        _save(folder, f"histories-{shard}", h[first])
        _save(folder, f"history_totals-{shard}", totals)
        u, n = np.unique(t, return_counts=True)
        rows = [("pairs", shard, [*_tally(c), int(c.sum()), int((h[first] != START).sum()), int(c[t == END].sum())], None, None)]
        at, m = words.runs(range_of(u, ranges))
        rows += [("words", int(range_of(u[a:a + 1], ranges)[0]), [], words.pack_sorted(u[a:a + b]), _narrow(n[a:a + b])) for a, b in zip(at, m)]
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _STATS_ARROW)], schema=_STATS_ARROW)

    return store


def _word_shard(folder: str):
    def store(table: pa.Table) -> pa.Table:
        shard = table["range"][0].as_py()
        t = np.concatenate([words.unpack_sorted(x) for x in table["tokens"].to_pylist()])
        c = np.concatenate([_wide(x) for x in table["counts"].to_pylist()])
        order = np.argsort(t, kind="stable")
        first, _ = words.runs(t[order])
        total = np.add.reduceat(c[order], first)
        _save(folder, f"words-{shard}", t[order][first])
        _save(folder, f"continuations-{shard}", total.astype(np.int64))
        figures = [*_tally(total), int(total.sum()), int((total >= 3).sum())]
        return pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip(("words", shard, figures, None, None), _STATS_ARROW)], schema=_STATS_ARROW)

    return store


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more; 0.5 where the counts of counts are too few."""
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2]
    return tuple(min(max(d, 0.0), float(k)) for k, d in enumerate(found, 1))


@dataclass
class Model:
    """Where the shards are, and the few figures that scoring needs besides."""

    folder: str
    ranges: int
    tokens: int = 0
    types: int = 0
    ends: int = 0
    pair_discounts: tuple[float, float, float] = (0.5, 0.5, 0.5)
    word_discounts: tuple[float, float, float] = (0.5, 0.5, 0.5)
    continuations: int = 0
    left_over: float = 1.0
    _open: dict = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_open"} | {"_open": {}}

    def _map(self, name: str) -> np.ndarray:
        if name not in self._open:
            path = f"{self.folder}/{name}.npy"
            # A range that got no pairs has no shard; only then is the file missing.
            self._open[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
        return self._open[name]

    def _found(self, keys: np.ndarray, shards: np.ndarray, name: str, values: str) -> np.ndarray:
        """Values of ``keys`` in the shards' sorted arrays, a column a key; 0 where there is none."""
        order = np.lexsort((keys, shards))
        first, length = words.runs(shards[order])
        out = None
        for a, n in zip(first, length):
            mine = order[a:a + n]
            shard = int(shards[mine[0]])
            known = self._map(f"{name}-{shard}")
            if known is None:
                continue
            stored = self._map(f"{values}-{shard}")
            at = np.searchsorted(known, keys[mine])
            at[at == len(known)] = 0
            hit = known[at] == keys[mine]
            if out is None:
                out = np.zeros(stored.shape[:-1] + (len(keys),), np.int64)
            out[..., mine[hit]] = stored[..., at[hit]]
        return out if out is not None else np.zeros((4, len(keys)) if values == "history_totals" else len(keys), np.int64)

    def score(self, history: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each token after its history, and its count in the training tokens."""
        kinds, index = np.unique(np.concatenate([history, token]), return_inverse=True)
        h, t = index[: len(history)], index[len(history):]
        shard = range_of(kinds, self.ranges)
        totals = self._found(kinds, shard, "histories", "history_totals")
        seen = self._found(kinds, shard, "words", "continuations")
        count = totals[0].copy()
        count[kinds == START] = 0
        count[kinds == END] = self.ends
        d = np.array([0.0, *self.word_discounts])
        lower = np.full(len(kinds), self.left_over / (self.types + 1))
        if self.continuations:
            lower += np.maximum(seen - d[np.minimum(seen, 3)], 0) / self.continuations
        d = np.array([0.0, *self.pair_discounts])
        with np.errstate(divide="ignore", invalid="ignore"):
            weight = np.where(totals[0] > 0, (d[1:, None] * totals[1:]).sum(0) / totals[0], 1.0)
        pairs = self._found(pair_key(history, token), range_of(history, self.ranges), "pairs", "pair_counts")
        own = np.maximum(pairs - d[np.minimum(pairs, 3)], 0) / np.maximum(totals[0], 1)[h]
        return np.log10(own + weight[h] * lower[t]), count[t]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "lm") -> Model:
    """Count the pairs of all ``docs`` and write the model's shards below the shared folder."""
    base = tables.texts(docs, id_col, text_col)
    ranges = min(MOST_RANGES, max(4, -(-tables.text_bytes(base) // RANGE_BYTES)))
    spark = docs.sparkSession
    path = tables.run_folder(spark, name)
    model = Model(mounted(path) + "/shards", ranges)
    pieces = base.select("text").mapInArrow(_counter(ranges), _PIECE_SQL)
    stored = tables.stage(pieces.repartition(ranges, "range").groupBy("range").applyInArrow(_pair_shard(model.folder, ranges), _STATS), name)
    by_word = stored.where("kind = 'words'").repartition(ranges, "range").groupBy("range").applyInArrow(_word_shard(model.folder), _STATS)
    # A row of seven or six numbers per range: bounded by MOST_RANGES.
    pair = [r.figures for r in stored.where("kind = 'pairs'").select("figures").collect()]
    word = [r.figures for r in by_word.select("figures").collect()]
    if pair:
        n = np.array(pair).sum(0)
        model.pair_discounts, model.tokens = discounts(*map(int, n[:4])), int(n[4])
        model.types, model.ends = int(n[5]) + 1, int(n[6])
        n = np.array(word).sum(0)
        model.word_discounts, model.continuations = discounts(*map(int, n[:4])), int(n[4])
        model.left_over = float(sum(d * k for d, k in zip(model.word_discounts, (n[0], n[1], n[5]))) / n[4])
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, ``n_tokens``, ``n_known``, ``base_score`` (add-one unigrams), ``score`` and ``perplexity``.

    A null or empty text is one end token. Ids may be null or repeat: every row is scored by itself. Words never
    seen in training share what the lowest order leaves over. Other columns are ignored.
    """
    out = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            # Several slices together, so that sorted look-ups share pages; a long text is a slice of its own.
            held, size = [], 0
            for part in [*words.slices(batch.column("text")), None]:
                if held and (part is None or size >= 1 << 20):
                    parts = [sentences(p) for p in held]
                    history, token = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
                    shift = np.cumsum([0, *(len(p[1]) for p in parts)])
                    first = np.concatenate([p[2] + s for p, s in zip(parts, shift)])
                    logs, count = model.score(history, token)
                    base = np.log10((count + 1) / (model.tokens + model.types + 1))
                    sums = [np.add.reduceat(x, first) for x in (np.ones(len(token), np.int64), (count > 0).astype(np.int64), base, logs)]
                    lo, n = held[0].first, len(first)
                    yield pa.RecordBatch.from_arrays([ids.slice(lo, n), *(pa.array(s, f.type) for s, f in zip(sums, list(out)[1:]))], schema=out)
                    held, size = [], 0
                if part is not None:
                    held.append(part)
                    size += len(part.starts)

    scored = tables.texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def is_held_out(doc_id: Column) -> Column:
    """Documents kept out of training: crc32 of the id as text leaves 2 modulo 7. A null id is trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))
