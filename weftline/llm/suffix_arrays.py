"""Suffix arrays by multiplied ranks and permuted common prefixes, in numpy.

Suffixes are sorted by as many first symbols as fit into 64 bits. From then on each has a rank, that of the symbols it
was sorted by so far; those that share theirs are sorted by their ranks and those that stand a depth, two depths and so
on after them, as many as fit into 64 bits (three for up to two million symbols), until all differ. A round is one sort
of whole numbers, only of what still shares a rank, and the depth grows at least twofold: n log(n)^2 work at worst.
"""

from __future__ import annotations

import numpy as np


def suffix_array(t: np.ndarray, kinds: int) -> np.ndarray:
    """Start positions of the suffixes of t (whole numbers under kinds) in order; an end is less than any symbol."""
    n = len(t)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    # A symbol and a rank take one more value, zero: the end.
    symbol, size = int(kinds).bit_length(), n.bit_length()
    depth, ranks = 64 // symbol, 64 // size
    padded = np.zeros(n + depth - 1, np.uint64)
    padded[:n] = t
    padded[:n] += np.uint64(1)
    key = padded[:n].copy()
    for k in range(1, depth):
        key <<= np.uint64(symbol)
        key |= padded[k : k + n]
    sa, rank = np.empty(n, np.int32), np.zeros(n + 1, np.uint64)
    # Open slots of the array and the suffixes in them: those of one rank stand together.
    slots = at = np.arange(n, dtype=np.int32)
    while True:
        order = key.argsort()
        at, key = at[order], key[order]
        sa[slots] = at
        new = np.ones(len(at) + 1, bool)
        np.not_equal(key[1:], key[:-1], out=new[1:-1])
        first = np.flatnonzero(new)
        rank[at] = np.repeat(slots[first[:-1]] + 1, np.diff(first))
        shared = ~(new[:-1] & new[1:])
        slots, at = slots[shared], at[shared]
        if not len(at):
            return sa
        key = rank[at]
        for k in range(1, ranks):
            key <<= np.uint64(size)
            # Beyond the end: the last rank, which is zero.
            key |= rank.take(at + k * depth, mode="clip")
        depth *= ranks


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position, how many symbols its suffix shares with the one before it in the array.

    Where the symbols before both are equal, the value is one less than at the position before; the others are compared.
    """
    n, block = len(t), 16
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    alone = np.ones(n, bool)
    inner = np.flatnonzero(before[1:] > 0) + 1
    alone[inner] = t[inner - 1] != t[before[inner] - 1]
    out = np.zeros(n, np.int32)
    padded = np.append(t.astype(np.int32), np.full(block, -1, np.int32))
    windows = np.lib.stride_tricks.sliding_window_view(padded, block)
    live = np.flatnonzero(alone & (before >= 0))
    while len(live):
        # Of two suffixes one meets the end first, where the other still has a symbol.
        differ = windows[live + out[live]] != windows[before[live] + out[live]]
        some = differ.any(axis=1)
        out[live] += np.where(some, differ.argmax(axis=1), block)
        live = live[~some]
    source = np.maximum.accumulate(np.where(alone, np.arange(n), 0))
    return out[source] - (np.arange(n) - source).astype(np.int32)
