"""Phrase mining against counting by hand and against its SQL."""

import re
from collections import Counter

import pytest

from tidemark.llm import phrases
from tidemark.llm.phrases import SQL, Mining

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def by_hand(rows, least, top=2000, longest=5):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i:i + size])] += 1
    f = {k: v for k, v in f.items() if v >= least}
    inside = {}
    for (lang, w), c in f.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                key = lang, w[i:i + m]
                inside[key] = max(inside.get(key, 0), c)
    out = {}
    for (lang, w), a in f.items():
        if len(w) < 2 or inside.get((lang, w), 0) >= a:
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return {(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for lang, xs in out.items() for i, x in enumerate(sorted(xs)[:top])}


def got(df):
    rows = [tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


ODD = [("en", None), (None, "Ab cd ef. " * 9), ("und", "ab CD\tef"), ("en", ""), ("en", " \t\n"), ("en", "a a a a a a a a a"), ("fr", "é è, é è; é  è"),
       ("en", "x\x0by\x0cz w x y"), ("en", "one two three four five six seven. " * 40), ("en", "one two three four five" * 1), ("zz", "." * 500),
       ("en", "two three four five six " * 30)]


@pytest.mark.parametrize("p", [Mining(least=4, shards=2), Mining(least=4, shards=5, stretch=64, cells=97, probes=2), Mining(least=2, shards=1, longest=3)])
def test_odd_rows(spark, p):
    t = spark.createDataFrame([(lang, text, "clash", 1) for lang, text in ODD * 3], "lang string, text string, phrase string, shard int").repartition(3)
    assert got(phrases.collocations(t, p)) == by_hand(ODD * 3, p.least, longest=p.longest)


@pytest.mark.parametrize("least, cells", [(20, 1 << 24), (100, 64), (6, 1 << 16)])
def test_documents(spark, docs, least, cells):
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert got(phrases.collocations(docs, Mining(least=least, cells=cells, top=500))) == by_hand(rows, least, 500)


def test_sql(spark, docs):
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.01/documents.parquet')")
    t = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got(phrases.collocations(t)) == set(con.execute(SQL).fetchall())


def test_empty(spark, none):
    assert phrases.collocations(none).count() == 0
