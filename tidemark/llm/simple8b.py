"""Simple-8b word-aligned coding of token ids, vectorised over blocks.

A 64-bit word holds a 4-bit selector (low bits) and 60 bits of data: as many
ids of equal width as fit.  Selector 0 is the escape: it says that the next
word is one raw 64-bit value.  Blocks of ``BLOCK`` ids start on a word of their
own, so a table of word offsets lets any block be decoded alone and all blocks
be decoded side by side.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BLOCK = 256
#: ids a word by selector, widest first; a width is 60 // count bits. Selector = place + 1.
COUNTS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
WIDTHS = 60 // COUNTS
#: ids a word by place, -1: escape
_HOLD = np.append(COUNTS, 1)


CHUNK = 256 * BLOCK  # ids encoded at a time: arrays stay in the processor's cache
#: bits of every value of two bytes, 1 at least
_SHORT = np.maximum(np.frexp(np.arange(1 << 16, dtype=np.float64))[1], 1).astype(np.int8)


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs, 1 at least."""
    n = np.ones(len(x), np.int8)
    if not len(x):
        return n
    if x.max() < U(1 << 16):
        return _SHORT[x]
    if x.max() < U(1 << 52):  # a double holds it
        return np.maximum(np.frexp(x.astype(np.float64))[1], 1).astype(np.int8)
    for w in range(1, int(x.max()).bit_length()):
        n += (x >> U(w)) > 0
    return n


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, word offset of every block + total) of unsigned values, up to 64 bits wide."""
    ids = np.ascontiguousarray(ids)
    if ids.dtype.kind != "u":
        ids = ids.astype(U)
    words, blocks, at = [], [np.zeros(1, np.int64)], 0
    for i in range(0, len(ids), CHUNK):
        w, b = _encode(ids[i:i + CHUNK])
        words.append(w)
        blocks.append(b + at)
        at += len(w)
    return np.concatenate(words) if words else np.zeros(0, U), np.concatenate(blocks)


def _encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, end of every block in words) of a few blocks."""
    n = len(ids)
    bits = _bits(ids)
    nb = -(-n // BLOCK)
    # absent ids behind a block's end need no bits, so its last word may be part full
    wide = np.zeros((nb, BLOCK + 64), np.int8)
    wide[:, :BLOCK].flat[:n] = bits
    left = np.minimum(BLOCK - np.arange(nb * BLOCK) % BLOCK, np.maximum(0, n - np.arange(nb * BLOCK)))
    place = np.full((nb, BLOCK), -1, np.int8)   # -1: escape
    top, have = wide[:, :BLOCK].copy(), 1       # widest of the next `have` ids
    for c, w in zip(COUNTS, WIDTHS, strict=True):
        while have < c:
            np.maximum(top, wide[:, have:have + BLOCK], out=top)
            have += 1
        ok = top <= w
        if not ok.any():
            break
        np.add(place, ok, out=place, casting="unsafe")  # what fits a narrower width fits all wider ones
    place = place.ravel()
    hold = np.minimum(_HOLD[place], left)
    # walk all blocks side by side from word to word
    at = np.arange(0, n, BLOCK)
    ends = np.minimum(at + BLOCK, n)
    heads = []
    while len(at):
        heads.append(at)
        at = at + hold[at]
        on = at < ends
        at, ends = at[on], ends[on]
    head = np.sort(np.concatenate(heads))
    kind = place[head]
    esc = kind < 0
    where = np.concatenate([[0], np.cumsum(np.where(esc, 2, 1))])
    out = np.zeros(where[-1], U)
    # zeros stand behind a block's end, so a part full word reads them like ids
    pad = np.zeros((nb, BLOCK + 64), ids.dtype)
    pad[:, :BLOCK].flat[:n] = ids
    pad = pad.ravel()
    inside = head + head // BLOCK * 64
    for k, (c, w) in enumerate(zip(COUNTS, WIDTHS, strict=True)):
        sel = np.flatnonzero(kind == k)
        if not len(sel):
            continue
        h = inside[sel]
        word = np.full(len(sel), k + 1, U)
        for j in range(c):
            word |= pad[h + j].astype(U) << U(4 + j * int(w))
        out[where[sel]] = word
    out[where[:-1][esc] + 1] = ids[head[esc]]
    return out, where[np.append(np.searchsorted(head, np.arange(BLOCK, n, BLOCK)), len(head))].astype(np.int64)


def decode(words: np.ndarray, blocks: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of whole blocks; ``blocks``: word offset of each block + total."""
    out = np.zeros(n, U)
    if not n:
        return out
    words = np.ascontiguousarray(words, U)
    sel = (words & U(15)).astype(np.int64)
    if (sel == 0).any():  # a raw value follows an escape, and may look like one itself
        skip = -1
        for i in np.flatnonzero(sel == 0).tolist():
            if i != skip:
                skip = i + 1
                sel[skip] = -1
    count = np.where(sel > 0, COUNTS[np.maximum(sel - 1, 0)], (sel < 0).astype(np.int64))
    # the last word of a block may be part full: it holds what the block lacks
    size = np.minimum(BLOCK, n - np.arange(len(blocks) - 1) * BLOCK)
    got = np.add.reduceat(count, blocks[:-1])
    count[blocks[1:] - 1] -= got - size
    begin = np.cumsum(count) - count
    for k, (c, w) in enumerate(zip(COUNTS, WIDTHS, strict=True)):
        i = np.flatnonzero(sel == k + 1)
        mask = U((1 << int(w)) - 1)
        for j in range(c if len(i) else 0):
            on = i[j < count[i]]
            out[begin[on] + j] = (words[on] >> U(4 + j * int(w))) & mask
    r = np.flatnonzero(sel == -1)
    out[begin[r]] = words[r]
    return out
