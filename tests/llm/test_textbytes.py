import numpy as np

from tidemark.llm import textbytes as tb


def test_equal_spans_have_equal_hashes_and_others_do_not():
    rnd = np.random.default_rng(1)
    buf = rnd.integers(0, 4, 20_000).astype(np.uint8)
    s = rnd.integers(0, 19_000, 30_000)
    e = s + rnd.integers(0, 7, len(s))
    h = tb.span_hash(tb.prefix_hash(buf), s, e)
    seen = {}
    for a, b, x in zip(s, e, h, strict=True):
        assert seen.setdefault(buf[a:b].tobytes(), x) == x
    assert len(set(seen.values())) == len(seen)


def test_words_that_collide_modulo_powers_of_two():
    """The Thue-Morse word and its complement collide for every base modulo 2^64 from 1,024 letters on."""
    for n in (10, 11, 12, 13):
        x = [97]
        for _ in range(n):
            x += [195 - v for v in x]
        w, v = bytes(x), bytes(195 - c for c in x)
        buf, k = np.frombuffer(w + b" " + v + b" " + w, np.uint8), len(w)
        at = np.array([0, k + 1, 2 * k + 2])
        h = tb.span_hash(tb.prefix_hash(buf), at, at + k)
        assert h[0] == h[2] != h[1]


def test_very_long_text():
    buf = np.tile(np.arange(251, dtype=np.uint8), 20_000)     # above the length up to which powers are kept
    at = np.array([0, 251, 251 * 19_000, 1])
    h = tb.span_hash(tb.prefix_hash(buf), at, at + 200)
    assert h[0] == h[1] == h[2] != h[3]
