"""Burrows-Wheeler transform of a byte collection and threshold-bounded interval expansion, in arrays.

Texts stand one after another, each closed by a mark that is smaller than every byte. Suffixes are ordered by their first
``depth`` symbols at least, which is all that intervals of strings of that length need.
"""

from __future__ import annotations

import numpy as np

INDEX_BITS = 21
# Symbols of one transform: they and their positions share 64 bits, and a task needs about 120 bytes for each.
MOST = 1 << 20
MARK = 0


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the byte ranges, each followed by the mark, and where each range begins. Bytes keep their order."""
    used = np.zeros(256, bool)
    used[data] = True
    symbol = np.zeros(256, np.uint16)
    symbol[used] = np.arange(1, used.sum() + 1)
    lengths = ends - starts
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.zeros(begin[-1], np.uint16)
    text = np.ones(begin[-1], bool)
    text[begin[1:] - 1] = False
    out[text] = symbol[data[np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())]]
    return out, begin[:-1]


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first ``depth`` symbols or more, by prefix doubling over the groups that are still undecided."""
    n, mask = len(symbols), (1 << INDEX_BITS) - 1
    bits = max(1, int(symbols.max()).bit_length())
    known = min(depth, 2 * INDEX_BITS // bits)
    padded = np.concatenate([symbols, np.zeros(known, symbols.dtype)]).astype(np.uint64)
    keys = np.zeros(n, np.uint64)
    for k in range(known):
        keys = keys << np.uint64(bits) | padded[k:k + n]
    packed = np.sort(keys << np.uint64(INDEX_BITS) | np.arange(n, dtype=np.uint64))
    order = (packed & np.uint64(mask)).astype(np.int64)
    new = np.ones(n, bool)
    new[1:] = packed[1:] >> np.uint64(INDEX_BITS) != packed[:-1] >> np.uint64(INDEX_BITS)
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.zeros(n + depth, np.int64)  # 0: beyond the end
    rank[order] = head + 1
    slots = np.arange(n)
    while known < depth:
        alone = new.copy()
        alone[:-1] &= new[1:]
        slots, head = slots[~alone], head[~alone]
        if not len(slots):
            break
        at = order[slots]
        packed = np.sort((head.astype(np.uint64) << np.uint64(2 * INDEX_BITS)) | (rank[at + known].astype(np.uint64) << np.uint64(INDEX_BITS))
                         | np.arange(len(slots), dtype=np.uint64))
        at = at[(packed & np.uint64(mask)).astype(np.int64)]
        order[slots] = at
        new = np.ones(len(slots), bool)
        new[1:] = packed[1:] >> np.uint64(INDEX_BITS) != packed[:-1] >> np.uint64(INDEX_BITS)
        head = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        rank[at] = head + 1
        known *= 2
    return order


def boundaries(symbols: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Where a suffix shares fewer than ``depth`` symbols with the one before it, as far as suffixes without a mark in these go.

    Breadth first: an interval holds the suffixes that begin with one string. Each is extended to the left by every
    symbol of its transform; where an extension ends at a place without a value, the common prefix there is as long as the
    string before the extension, and only then is the extension followed up. Values appear in ascending order, so the
    search stops at ``depth``; places without a value share that much or more.
    """
    n = len(symbols)
    before = symbols[order - 1]
    step = np.empty(n, np.int32)
    step[np.argsort(before, kind="stable")] = np.arange(n, dtype=np.int32)
    # An interval whose transform is one symbol moves as a whole; its run of equal symbols tells.
    last = np.flatnonzero(np.append(before[1:] != before[:-1], True)).astype(np.int32)
    run_end = np.repeat(last + 1, np.diff(last, prepend=-1))
    counts = np.bincount(before)
    new_symbol = np.zeros(n + 2, bool)
    new_symbol[np.cumsum(counts)[:-1][counts[1:] > 0] + 1] = True  # one place of room on either side, as in owner
    found = np.zeros(n + 1, bool)
    found[[0, n]] = True
    owner, stamp = np.full(n + 2, -1, np.int32), 0
    low, high = np.array([0], np.int32), np.array([n], np.int32)
    for _ in range(depth):
        whole = run_end[low] >= high
        own_low, own_high = low[whole], high[whole]
        real = before[own_low] != MARK
        own_low, size = step[own_low[real]], (own_high - own_low)[real]
        low, high = low[~whole], high[~whole]
        sizes = high - low
        own = np.repeat(np.arange(stamp, stamp + len(low), dtype=np.int32), sizes)
        at = np.arange(len(own), dtype=np.int32) + np.repeat(low - (np.cumsum(sizes, dtype=np.int32) - sizes), sizes)
        real = before[at] != MARK
        own, at = own[real], step[at[real]] + 1
        stamp += len(low)
        owner[at] = own
        begins = (owner[at - 1] != own) | new_symbol[at]
        ends = (owner[at + 1] != own) | new_symbol[at + 1]
        low = np.concatenate([own_low, np.sort(at[begins]) - 1])
        high = np.concatenate([own_low + size, np.sort(at[ends])])
        fresh = ~found[high]
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
        found[high] = True
    return found[:-1]


def classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every ``depth``-byte string of the ranges: its class, its range and its offset there; equal strings share a class.

    Strings of one class stand together. At most :data:`MOST` symbols, one a byte and one a range.
    """
    symbols, begin = joined(data, starts, ends)
    order = suffix_order(symbols, depth)
    number = np.cumsum(boundaries(symbols, order, depth))
    which = np.searchsorted(begin, order, side="right") - 1
    offset = order - begin[which]
    whole = offset <= (ends - starts)[which] - depth
    return number[whole], which[whole], offset[whole]
