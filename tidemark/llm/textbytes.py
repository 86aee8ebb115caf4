"""Vectorised work on the UTF-8 bytes of a batch of texts (numpy inside tasks).

Words are ``[^\\x20\\x09-\\x0D]+``; a byte below 0x80 is never part of a longer
code point, so words can be found on bytes.  A span's hash is two sums of
random per-byte values times powers of a random base, modulo two primes near
2^31, side by side and finished by a bit mixer.  (Modulo 2^64 some texts of
two letters collide whatever the base.)  Two spans of n bytes collide with
probability (n / 2^31)^2 at most over the choice of bases, about 2^-62 where
their bytes are not made from the bases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CHUNK = 1 << 20
PRIMES = (2**31 - 1, 2**31 - 19)
_RNG = np.random.default_rng(20240229)
BYTE_VALUE = [_RNG.integers(1, p, 256, dtype=np.uint64) for p in PRIMES]
BASES = [int(_RNG.integers(2**16, p - 1)) for p in PRIMES]
INVERSES = [pow(b, -1, p) for b, p in zip(BASES, PRIMES, strict=True)]
_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _mod(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p, in place (a division by a fixed number is much faster than the remainder)."""
    q = x // U(p)
    q *= U(p)
    x -= q
    return x


def powers(base: int, p: int, n: int) -> np.ndarray:
    """base^0 .. base^(n - 1) modulo p."""
    have = _POWERS.get((base, p))
    if have is None or len(have) < n:
        size = max(n, CHUNK + 1)
        full = np.ones(size, np.uint32)
        k = 1
        while k < size:
            m = min(k, size - k)
            full[k:k + m] = _mod(full[:m].astype(U) * U(pow(base, k, p)), p)
            k *= 2
        if n > 4 * CHUNK:  # a very long text: don't keep its table
            return full
        _POWERS[base, p] = have = full
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finisher (xor-shift, multiply)."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def binary(arr: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array, null as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type) else "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = arr.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offs


def chunks(offs: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer text is a range of its own, never cut."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = int(np.searchsorted(offs, offs[a] + most, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row + total) for rows ``offs`` of ``buf``; words never cross rows."""
    ns = ~SPACE[buf]
    start, end = ns.copy(), ns.copy()
    start[1:] &= ~ns[:-1]
    end[:-1] &= ~ns[1:]
    filled = offs[1:] > offs[:-1]
    first, last = offs[:-1][filled], offs[1:][filled] - 1
    start[first] = ns[first]
    end[last] = ns[last]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(s, offs)


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running sums of both moduli, a row each."""
    c = np.zeros((len(PRIMES), len(buf) + 1), np.uint32)
    for k, p in enumerate(PRIMES):
        x = BYTE_VALUE[k][buf]
        x *= powers(BASES[k], p, len(buf))
        _mod(x, p)
        np.cumsum(x, out=x)  # below 2^64 for any text that Arrow holds
        c[k, 1:] = _mod(x, p)
    return c


def span_hash(prefix: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [s, e): equal bytes, equal hash, wherever they stand."""
    h = np.zeros(len(s), U)
    for k, p in enumerate(PRIMES):
        x = prefix[k][e].astype(U)
        x += U(p)
        x -= prefix[k][s]
        x *= powers(INVERSES[k], p, prefix.shape[1])[s]  # below 2^32 * 2^31
        h = (h << U(32)) | _mod(x, p)
    return mix(h + (e - s).astype(U) * U(0xD6E8FEB86659FD93))


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """Ordered combination of hash arrays."""
    h = np.zeros_like(parts[0])
    for p in parts:
        h = mix(h * U(0x9FB21C651E98DF25) + p)
    return h
