"""Simple-8b: unsigned integers packed word-aligned into 64-bit words.

A word holds a 4-bit selector (top bits) and as many equally wide integers
as the selector says, lowest first.  Integers of more than 60 bits escape:
selector 0, whose payload is the place in a side table of raw values.

Integers are coded in blocks of ``BLOCK``; no word crosses a block, and the
word offset of every block is kept, so that any block can be decoded alone
and all of them with a few array operations.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
# fixed values: integers per word and bits of each, by selector; 0 is the escape
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])


def _runs(wide: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each place, how many integers follow (itself included) before a too wide one or the block's end."""
    bounds = np.append(wide, len(at)).astype(np.int32)
    return np.minimum(np.repeat(bounds, np.diff(bounds, prepend=-1))[:len(at)], ends) - at


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, block_offsets, escapes), all unsigned 64-bit, of unsigned integers."""
    v = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(v)
    if not n:
        return np.empty(0, np.uint64), np.zeros(1, np.uint64), np.empty(0, np.uint64)
    at = np.arange(n, dtype=np.int32)
    ends = np.minimum((at // BLOCK + 1) * BLOCK, n).astype(np.int32)
    bits = np.frexp(v.astype(float))[1].astype(np.uint8)
    large = np.flatnonzero(v >> np.uint64(53))    # where a float rounds
    bits[large] = [int(x).bit_length() for x in v[large]]
    chosen, apart = np.zeros(n, np.uint8), n + 1
    for s in range(15, 0, -1):                    # a later selector with more integers wins
        count = int(COUNTS[s])
        if apart <= count:                        # too wide ones are no further apart for narrower integers
            break
        places = np.flatnonzero(bits > int(BITS[s]))
        if not len(places):
            fits = at <= ends - count
        else:
            apart = int(np.diff(places, prepend=-1, append=n).max())
            if apart <= count:
                break
            fits = _runs(places, at, ends) >= count
        np.copyto(chosen, s, where=fits)
    step, starts, i = COUNTS[chosen].tolist(), [], 0
    while i < n:
        starts.append(i)
        i += step[i]
    starts = np.array(starts)
    sel = chosen[starts].astype(np.int64)
    words = sel.astype(np.uint64) << np.uint64(60)
    for s in np.unique(sel):
        own = np.flatnonzero(sel == s)
        if s == 0:
            words[own] |= np.arange(len(own), dtype=np.uint64)
            continue
        lanes = np.arange(COUNTS[s])
        parts = v[starts[own][:, None] + lanes] << (lanes * BITS[s]).astype(np.uint64)
        words[own] |= np.bitwise_or.reduce(parts, axis=1)
    offsets = np.searchsorted(starts, np.arange(0, n + BLOCK, BLOCK).clip(max=n)).astype(np.uint64)
    return words, offsets, v[starts[sel == 0]]


def decode(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The integers of ``words``, in order."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[sel]
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    payload = words & np.uint64((1 << 60) - 1)
    for s in np.unique(sel):
        own = np.flatnonzero(sel == s)
        if s == 0:
            out[first[own]] = escapes[payload[own].astype(np.int64)]
            continue
        lanes = np.arange(COUNTS[s])
        mask = np.uint64((1 << int(BITS[s])) - 1)
        out[first[own][:, None] + lanes] = (payload[own][:, None] >> (lanes * BITS[s]).astype(np.uint64)) & mask
    return out


def decode_block(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, block: int) -> np.ndarray:
    """Only the integers of one block."""
    return decode(words[int(offsets[block]):int(offsets[block + 1])], escapes)


def decode_range(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, start: int, end: int) -> np.ndarray:
    """The integers at places ``start`` to ``end`` (exclusive), decoding only their blocks."""
    if end <= start:
        return np.empty(0, np.uint64)
    first, last = start // BLOCK, (end - 1) // BLOCK
    part = decode(words[int(offsets[first]):int(offsets[last + 1])], escapes)
    return part[start - first * BLOCK:end - first * BLOCK]
