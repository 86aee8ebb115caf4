"""Every stage of corpus_pipeline against a plain version on what the stage before it kept, and odd tables through all of them."""

from collections import Counter, defaultdict

import brute
import corpus_pipeline
import pytest
from tokenizers import Tokenizer

from tidemark.llm import mixing, packing
from tidemark.llm.common import cut


@pytest.fixture(scope="module")
def steps(spark, docs):
    """The input and every stage's result, reread."""
    out, d = [docs], docs
    for name, stage in corpus_pipeline.STAGES:
        d = cut(stage(spark, d, ""), f"test-{name.replace(' ', '-')}")
        out.append(d)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_all_but_the_last_keep_the_columns(steps):
    for d in steps[1:-1]:
        assert d.dtypes == steps[0].dtypes


def test_quality_stage(steps):
    was, now = texts(steps[0]), texts(steps[1])
    assert 0 < len(now) < len(was)
    for i, t in now.items():
        n, _, _, _, rep = brute.base_counts(was[i])
        assert n >= 50 and 100 * rep <= 50 * n
        lines = iter(was[i].split("\n"))
        assert all(line in lines for line in t.split("\n"))     # lines go, in order, and nothing else


def test_near_duplicate_stage(steps):
    was = [(r.doc_id, r.text) for r in steps[1].select("doc_id", "text").collect()]
    want = {i for i, (_, c) in brute.near_duplicates(was, 5, 80).items() if i == c}
    now = texts(steps[2])
    assert set(now) == want and all(now[i] == t for i, t in was if i in want)


def test_repeats_stage(steps):
    was, now = texts(steps[2]), texts(steps[3])
    ids = sorted(was)
    raw = [(was[i] or "").encode() for i in ids]
    want = {}
    for i, t, gone in zip(ids, raw, brute.covered(raw, 100), strict=True):
        at, kept = 0, []
        for ch in t.decode():
            n = len(ch.encode())
            if not all(gone[at:at + n]):
                kept.append(ch)
            at += n
        want[i] = "".join(kept)
    assert now == want


def test_mixing_stage(steps):
    m, rows = mixing.Mix(), steps[3].select("doc_id", "source", "text").collect()
    size = {r.doc_id: len(brute.WORD.findall(r.text or "")) for r in rows}
    of, total, most = {r.doc_id: r.source for r in rows}, defaultdict(int), defaultdict(int)
    for i, n in size.items():
        total[of[i]] += n
        most[of[i]] = max(most[of[i]], n)
    order = sorted(total.items(), key=lambda x: (x[0] is None, x[0] or ""))
    target = brute.water(order, m.weights, m.budget, m.most)
    copies = Counter(r.doc_id for r in steps[4].select("doc_id").collect())
    assert set(copies) <= set(size) and max(copies.values()) <= m.most
    for s in total:
        assert abs(sum(n * size[i] for i, n in copies.items() if of[i] == s) - target[s]) <= most[s]


def test_packing_stage(steps):
    import public_tokenizers
    tok, limit = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json"))), packing.Packing().tokens
    want = Counter()
    for r in steps[4].select("doc_id", "text").collect():
        want[r.doc_id] += len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1
    got, seqs = Counter(), defaultdict(list)
    for r in steps[5].collect():
        got[r.doc_id] += r.length
        seqs[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= limit


def test_odd_tables(spark, none, tmp_path):
    """An empty table, and rows that repeat ids or lack them, with a column whose name clashes."""
    from pyspark.sql import functions as F
    prose = lambda k: "\n".join(f"Sentence {k}x{i} tells of thing{i * i % 97} and ends here." for i in range(30))
    t = prose(1)
    rows = [(1, t, "en", "s", 1), (1, t, "en", "s", 1), (1, prose(2), "en", "s", 1), (None, t, "en", "s", 1), (None, None, None, None, None),
            (2, t + "\nA last line.", "en", None, 1), (3, "", "en", "s", 0)]
    for k, d in enumerate((none, spark.createDataFrame(rows, none.schema).withColumn("uid", F.lit("clash")))):
        d.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{k}")
        assert {r.doc_id for r in out.collect()} == ({1, None} if k else set())
