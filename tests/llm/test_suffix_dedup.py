import hashlib

import brute
import numpy as np

from tidemark.llm import suffix_dedup as sd


def check(got, rows, length):
    rows = sorted(rows)
    texts = [(t or "").encode() for _, t in rows]
    for (i, _), t, m in zip(rows, texts, brute.covered(texts, length), strict=True):
        mask = np.frombuffer(m, np.uint8)
        kept = bytes(b for b, x in zip(t, m, strict=True) if not x)
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(t), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()), i


def test_equals_brute_force(docs, rows):
    check({r.doc_id: r for r in sd.repeat_digests(docs).collect()}, rows, 100)


def test_random_strings(spark):
    """Few letters, periods and many repeats, short strings: all ties and overlaps occur."""
    import random
    rnd = random.Random(3)
    out = []
    for i in range(120):
        t = "".join(rnd.choice("ab") for _ in range(rnd.randrange(60)))
        if i % 3 == 0:
            t += rnd.choice(["ab", "a", "aab"]) * rnd.randrange(40)
        if i % 5 == 0 and out:
            t += out[rnd.randrange(len(out))][1]
        out.append((i, t))
    d = spark.createDataFrame(out, "doc_id long, text string")
    check({r.doc_id: r for r in sd.repeat_digests(d, sd.Repeats(length=12, q=5)).collect()}, out, 12)


def test_remove_keeps_valid_text(docs, rows):
    got = {r.doc_id: r for r in sd.remove_repeats(docs).select("doc_id", "text", "n_chars").collect()}
    rows = sorted(rows)
    masks = brute.covered([(t or "").encode() for _, t in rows], 100)
    for (i, t), m in zip(rows, masks, strict=True):
        if t is None:
            assert got[i].text is None
            continue
        at, want = 0, []
        for c in t:
            n = len(c.encode())
            if not all(m[at:at + n]):
                want.append(c)
            at += n
        assert got[i].text == "".join(want), i
    assert sd.remove_repeats(docs).schema.names == docs.schema.names


def test_odd_tables(none, repeated):
    assert sd.repeat_digests(none).count() == 0 and sd.remove_repeats(none).count() == 0
    got = sd.repeat_digests(repeated).collect()
    assert len(got) == repeated.count()
    one = sorted(r.n_removed for r in got if r.doc_id == 1)
    assert one[0] == 0 and one[-1] > 0  # of equal rows the first stays whole
    assert sd.remove_repeats(repeated).count() == repeated.count()
