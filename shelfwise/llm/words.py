"""Words, word hashes and rolling hashes of Arrow text batches, without a Python object per word.

A word is ``[^\\x20\\x09-\\x0D]+`` on the UTF-8 bytes. Hashes are polynomials
modulo 2^64 with fixed coefficients, finished by a bijective mix, so they are the
same in every task and on every run. Two given words or windows collide with a
chance of about 2^-57 at worst.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64: a bijection of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def sequence(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=_U) + _U(seed)) * _U(0x9E3779B97F4A7C15))


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = sequence(256, 17)


class Powers:
    """Powers of an odd base and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(n - 1, 1).bit_length()
            with np.errstate(over="ignore"):
                for name, b in (("up", self.base), ("down", self.inverse)):
                    steps = np.full(size, b, _U)
                    steps[0] = 1
                    setattr(self, name, np.cumprod(steps, dtype=_U))
        return self.up[:n], self.down[:n]


_IN_WORD, _IN_WINDOW = Powers(0xD1342543DE82EF95), Powers(0xAF251AF3B0F025B5)


def _ranges_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    up, down = powers.get(len(values) + 1)
    with np.errstate(over="ignore"):
        total = np.empty(len(values) + 1, _U)
        total[0] = 0
        np.cumsum(values * up[: len(values)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))


class Slice:
    """Consecutive texts of a batch: their bytes, words and word hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first, self.n = data, offsets, first, len(offsets) - 1
        inside = ~SPACE[data]
        before, after = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        before[1:] = inside
        before[offsets] = False
        after[: len(data)] = inside
        after[offsets] = False
        self.starts = np.flatnonzero(inside & ~before[:-1])
        self.ends = np.flatnonzero(inside & ~after[1:]) + 1
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.row, minlength=self.n)

    def word_hashes(self, lower: bool = False) -> np.ndarray:
        data = LOWER[self.data] if lower else self.data
        return _ranges_hash(_BYTE[data], self.starts, self.ends, _IN_WORD)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges, as :meth:`Slice.word_hashes` gives them for words."""
    return _ranges_hash(_BYTE[data], starts, ends, _IN_WORD)


def rolling_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ranges of ``width`` bytes, in place order; for other uses than :func:`range_hashes`."""
    up, down = _IN_WORD.get(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.empty(len(data) + 1, _U)
        total[0] = 0
        np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
        return mix((total[width:] - total[:-width]) * down[: len(data) - width + 1])


def window_hashes(words: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of all ``width`` consecutive words of one row, and each window's first word."""
    if len(words) < width:
        return np.empty(0, _U), np.empty(0, np.int64)
    first = np.flatnonzero(row[: len(words) - width + 1] == row[width - 1:])
    return _ranges_hash(words, first, first + width, _IN_WINDOW), first


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a binary column without nulls into runs of rows of about ``limit`` bytes, at least a row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offs, values = column.buffers()
    offsets = np.frombuffer(offs, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield Slice(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at], at)
        at = to


def binaries(parts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column whose i-th value is the next ``lengths[i]`` items of ``parts``, as bytes."""
    raw = np.ascontiguousarray(parts)
    offsets = np.concatenate([[0], np.cumsum(lengths * raw.itemsize)])
    if offsets[-1] >= 1 << 31:
        return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of equal values."""
    if not len(sorted_values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1])
    return first, np.diff(np.concatenate([first, [len(sorted_values)]]))


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as differences of as few whole bytes as the largest needs."""
    if not len(values):
        return b""
    steps = np.diff(values, prepend=_U(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_sorted(raw: bytes) -> np.ndarray:
    if not raw:
        return np.empty(0, _U)
    parts = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, raw[0])
    whole = np.zeros((len(parts), 8), np.uint8)
    whole[:, : raw[0]] = parts
    return np.cumsum(whole.view("<u8").ravel(), dtype=_U)


def distinct(parts: list[Slice]) -> tuple[list[bytes], np.ndarray]:
    """The different words of some slices, and for every occurrence, slice after slice, which one it is."""
    hashes = np.concatenate([p.word_hashes() for p in parts])
    _, first, index = np.unique(hashes, return_index=True, return_inverse=True)
    begin = np.concatenate([[0], np.cumsum([len(p.starts) for p in parts])])
    which = np.searchsorted(begin, first, side="right") - 1
    found = []
    for p, k in zip(which.tolist(), (first - begin[which]).tolist()):
        part = parts[p]
        found.append(part.data[part.starts[k]:part.ends[k]].tobytes())
    return found, index


def groups(column: pa.Array, limit: int) -> Iterator[list[Slice]]:
    """Consecutive slices of about ``limit`` bytes together."""
    held, size = [], 0
    for part in slices(column):
        held.append(part)
        size += len(part.data)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def shingle_hashes(part: Slice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of each row, in row order, and their rows; a shorter row is one shingle."""
    own = part.word_hashes()
    found, first = window_hashes(own, part.row, width)
    row = part.row[first]
    short = np.flatnonzero((part.counts > 0) & (part.counts < width))
    if len(short):
        begin = (np.cumsum(part.counts) - part.counts)[short]
        found = np.concatenate([found, _ranges_hash(own, begin, begin + part.counts[short], _IN_WINDOW)])
        row = np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        found, row = found[order], row[order]
    return found, row
