import re
from collections import Counter, defaultdict

import brute
import pytest

from tidemark.llm import mixing, packing


def test_mix_meets_targets(docs):
    got = mixing.take(docs).collect()
    src = {r.doc_id: (r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()}
    sizes = Counter()
    for s, t in src.values():
        sizes[s] += len(brute.WORD.findall(t or ""))
    order = sorted((s for s in sizes), key=lambda s: (s is None, s))
    want = brute.water([(s, sizes[s]) for s in order], (5, 2, 1), 1.5, 2)
    taken = Counter()
    for r in got:
        s, t = src[r.doc_id]
        assert r.source == s and r.size == len(brute.WORD.findall(t or "")) and r.source_size == sizes[s]
        assert r.target == pytest.approx(want[s], rel=1e-9) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert len(got) == len(src)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    again = {r.doc_id: r.taken for r in mixing.take(docs).collect()}
    assert again == {r.doc_id: r.taken for r in got}


def test_mixed_rows(docs, none, repeated):
    t = {r.doc_id: r for r in mixing.take(docs).collect()}
    n = Counter(r.doc_id for r in mixing.mixed_documents(docs).select("doc_id").collect())
    for i, r in t.items():
        assert n[i] == r.epochs + (r.part > 0 and 2 * r.part >= r.size)
    assert mixing.mixed_documents(docs).schema.names == docs.schema.names
    assert mixing.take(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    assert mixing.take(repeated).count() == repeated.count()
    mixing.mixed_documents(repeated).collect()


def bins_ok(got, tokens=4096):
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for b in by.values():
        at = 0
        for off, n in sorted(b):
            assert off == at
            at += n
        assert at <= tokens
    return by


def test_packing_against_the_tokenizer(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.pack_documents(docs).collect()
    have = {(r.doc_id, r.piece): r for r in got}
    want = {}
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            want[i, k] = (a, len(ids[a:a + 4096]), brute.crc(ids[a:a + 4096]))
    assert {k: (r.start, r.length, r.ids_crc32) for k, r in have.items()} == want and len(got) == len(want)
    by = bins_ok(got)
    assert len(by) <= 1.05 * -(-sum(r.length for r in got) // 4096) + 1


@pytest.mark.parametrize("score", ["residual", "dot"])
def test_every_constraint_holds(spark, score):
    import random
    rnd = random.Random(2)
    rows = [(i, 0, 0, rnd.choice([5, 20, 60, 100]), i) for i in range(700)]
    d = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    p = packing.Packing(tokens=100, documents=4, cost=5500 * 2.0, weights=(1, 1, 1), score=score, shard=100)
    got = packing.pack(d, p).collect()
    by = bins_ok(got, 100)
    assert len(got) == 700 and all(len(b) <= 4 and sum(n * n for _, n in b) <= 11000 for b in by.values())


def test_odd_tables(none, repeated):
    assert packing.pack_documents(none).count() == 0
    got = packing.pack_documents(repeated).collect()
    bins_ok(got)
    assert len(got) == repeated.count()


def test_the_mix_shuffles_no_texts(spark):
    """Documents meet their copies by their source's cut, not by a join on every id; those without words come once per epoch."""
    rows = [(i, " ".join(["word"] * (i % 7)) or None, "en", None if i % 3 == 0 else f"s{i % 3}", 0) for i in range(3000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    t = {r.doc_id: r.epochs + (r.part > 0 and 2 * r.part >= r.size) for r in mixing.take(d).collect()}
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")
    try:
        out = mixing.mixed_documents(d)
        got = Counter(r.doc_id for r in out.collect())
        plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    assert got == {i: n for i, n in t.items() if n} and len(set(t.values())) > 1
    assert not re.search(r"\) Exchange\nInput", plan)
