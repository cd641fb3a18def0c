"""Burrows-Wheeler transforms of string collections and their merge by interleave refinement.

A shard's transform comes from one sort of its own suffixes. Shards are merged without sorting
suffixes again: an interleave says from which shard each row of the merged transform comes;
refined once, it is right for one symbol more. After ``depth`` rounds the rows stand in blocks of
suffixes that agree on ``depth`` symbols: the repeated intervals. The round in which two rows are
first told apart gives their common prefix.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sorted suffix positions of strings laid end to end, symbol 0 closing each string.

    Equal suffixes stand in the order of their strings. Prefix doubling from eight symbols.
    """
    n = len(text)
    first = np.zeros(n, np.uint64)
    padded = np.append(text, np.zeros(8, np.uint8)).astype(np.uint64)
    live = np.ones(n, bool)  # no closing symbol before this one
    for k in range(8):
        first = first << np.uint64(8) | np.where(live, padded[k:n + k], 0).astype(np.uint64)
        live &= padded[k:n + k] != 0
    rank = np.unique(first, return_inverse=True)[1].astype(np.int64) + 1
    string = np.searchsorted(ends, np.arange(n), "left")
    left = ends[string] - np.arange(n) + 1  # symbols to the string's end
    size, longest = 8, int(left.max(initial=0))
    while size < longest:
        after = np.zeros(n, np.int64)
        far = left > size
        after[far] = rank[np.flatnonzero(far) + size]
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        size *= 2
    return np.argsort(rank, kind="stable")


def transform(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The symbol before each sorted suffix (0 before a string's first symbol)."""
    before = np.append(np.uint8(0), text[:-1])
    return before[order]


def merge(transforms: list[np.ndarray], strings: list[int], depth: int, prefixes: bool = True):
    """Merged order of the shards' rows and its blocks after ``depth`` rounds of refinement.

    ``transforms``: each shard's transform; ``strings``: how many strings it has. Returns the
    row (numbered through all shards) at each merged place, the block of each place, and, if asked
    for, the common prefix with the place before (``depth`` if it is at least that).
    """
    sizes = np.array([len(t) for t in transforms], np.int64)
    symbols = np.concatenate(transforms)
    n, closing = len(symbols), int(sum(strings))
    small = np.uint8 if len(transforms) < 256 else np.uint16 if len(transforms) < 65536 else np.int64
    source = np.repeat(np.arange(len(sizes)), sizes).astype(small)
    heads = np.repeat(np.arange(len(strings)), strings).astype(small)
    places = np.arange(n)
    row = places.copy()
    block = np.zeros(n, np.int32)
    prefix = np.full(n, depth, np.int32)
    for done in range(depth):
        symbol = symbols[row]
        order = np.argsort(symbol, kind="stable")
        source = source[order]
        source[:closing] = heads  # suffixes of the closing symbol alone: in string order
        symbol, block = symbol[order], block[order]
        border = np.empty(n, bool)
        border[0] = True
        border[1:] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        border[:closing + 1] = True
        if prefixes:
            prefix[border & (prefix == depth)] = done
        block = np.cumsum(border, dtype=np.int32)
        row = np.empty(n, np.int64)
        row[np.argsort(source, kind="stable")] = places
    return row, block, prefix


def repeats(strings: list[bytes], depth: int, shard_bytes: int = 1 << 15):
    """Groups of positions whose next ``depth`` bytes are equal, over distinct strings.

    Returns (group, string, offset) arrays of all positions with ``depth`` bytes in their string
    whose bytes occur at another position too. Bytes must be below 255 (UTF-8 always is).
    """
    lengths = np.array([len(s) for s in strings], np.int64)
    shards, counts, orders, bases = [], [], [], []
    at = 0
    while at < len(strings):
        to = at + max(1, int(np.searchsorted(np.cumsum(lengths[at:]), shard_bytes, "right")))
        part = np.frombuffer(b"\xff".join(strings[at:to]) + b"\xff", np.uint8) + np.uint8(1)
        ends = np.flatnonzero(part == 0)
        order = suffix_order(part, ends)
        shards.append(transform(part, order))
        counts.append(to - at)
        orders.append(order)
        bases.append(at)
        at = to
    row, block, _ = merge(shards, counts, depth, prefixes=False)
    base = np.cumsum([0, *(len(s) for s in shards)])
    order = np.concatenate(orders)[row]  # position in its shard's text
    shard = np.searchsorted(base, row, "right") - 1
    begins = np.cumsum(lengths + 1) - lengths - 1
    whole = order + begins[np.array(bases)][shard]
    string = np.searchsorted(begins, whole, "right") - 1
    offset = whole - begins[string]
    full = offset + depth <= lengths[string]
    block, string, offset = block[full], string[full], offset[full]
    many = np.bincount(block)[block] > 1 if len(block) else np.zeros(0, bool)
    return block[many], string[many], offset[many]
