"""Canonical length-limited Huffman codes, packed and unpacked with array operations."""

from __future__ import annotations

import numpy as np

LIMIT = 18


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Length of each symbol's code, 0 for a count of 0; package-merge, so the best under ``limit``.

    Raises ValueError when there are more symbols than codes of ``limit`` bits.
    """
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    if n < 2:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    coins = counts[used].astype(np.float64)
    merged, coin_at = coins, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([coins, pairs])
        order = np.argsort(both, kind="stable")
        merged = both[order]
        coin_at.append(order < n)
    take = 2 * n - 2
    for is_coin in reversed(coin_at):
        own = int(is_coin[:take].sum())
        lengths[used[:own]] += 1
        take = 2 * (take - own)
    return lengths


def codes(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes: by length, then by symbol."""
    found = np.zeros(len(lengths), np.uint64)
    code = last = 0
    for length in range(1, int(lengths.max(initial=0)) + 1):
        code <<= length - last
        last = length
        mine = np.flatnonzero(lengths == length)
        found[mine] = code + np.arange(len(mine), dtype=np.uint64)
        code += len(mine)
    return found


def pack(symbols: np.ndarray, lengths: np.ndarray, words: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
    """The bits of ``symbols`` and the bit offset of each ``every``-th one."""
    size = lengths[symbols].astype(np.int64)
    offset = np.cumsum(size) - size
    total = int(offset[-1] + size[-1]) if len(size) else 0
    shifted = words[symbols] << (64 - (offset & 31) - size).astype(np.uint64)
    at, n = offset >> 5, (total >> 5) + 2
    # The bits of different symbols never meet, so sums of halves below 2^32 are exact.
    high = np.bincount(at, (shifted >> np.uint64(32)).astype(np.float64), n + 1)
    low = np.bincount(at + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), n + 1)
    return (high + low)[:n].astype(">u4").tobytes()[: (total + 7) // 8], offset[::every].astype(np.uint64)


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbol and length for every start of as many bits as the longest code has."""
    width = max(1, int(lengths.max(initial=0)))
    symbol, size = np.zeros(1 << width, np.int64), np.ones(1 << width, np.int64)
    for s, code in zip(np.flatnonzero(lengths), codes(lengths)[np.flatnonzero(lengths)]):
        free = width - int(lengths[s])
        first = int(code) << free
        symbol[first:first + (1 << free)] = s
        size[first:first + (1 << free)] = lengths[s]
    return symbol, size, width


def unpack(raw: bytes, checkpoints: np.ndarray, n: int, every: int, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """``n`` symbols; all blocks between checkpoints are decoded side by side."""
    symbol, size, width = table
    # The last block runs on past its symbols, so there is room for a whole block of the longest codes.
    room = 16 + every * width // 8
    whole = np.frombuffer(raw + bytes(room + (-(len(raw) + room)) % 4), ">u4").astype(np.uint64)
    two = (whole[:-1] << np.uint64(32)) | whole[1:]
    at = checkpoints.astype(np.int64)
    out = np.empty((min(every, n), len(at)), np.int64)
    for step in range(len(out)):
        window = (two[at >> 5] >> (64 - width - (at & 31)).astype(np.uint64)) & np.uint64((1 << width) - 1)
        out[step] = symbol[window]
        at += size[window]
    return out.T.ravel()[:n] if len(at) else np.empty(0, np.int64)
