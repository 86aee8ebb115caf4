import re

from tidemark.llm import license_scan as ls


def brute(rows, s, templates):
    """Every window of every class against every template of it, exactly."""
    out = {}
    for i, t in rows:
        w = [x for x in re.sub(r"[\W_]+", " ", (t or "").lower()).split(" ") if x]
        for name, text in templates.items():
            tw = ls.template_words(text)
            c, want = ls.size_class(len(tw), s), set(ls.template_shingles(tw, s.shingle))
            best = 0
            for a in range(0, max(1, len(w) - c // 2), c // 2):
                best = max(best, len(want & set(ls.template_shingles(w[a:a + 3 * c // 2], s.shingle))))
            if best >= s.threshold * len(want):
                out[i, name] = best
    return out


def test_equals_exhaustive_windows(docs, rows, spark):
    s = ls.Scan()
    planted = []
    for n, (name, t) in enumerate(ls.TEMPLATES.items()):
        fill = " ".join(f"filler{k}" for k in range(37))
        planted += [(20_000 + n, f"{fill}, {t.upper()} {fill}"), (21_000 + n, t.replace(" ", "\n* ")),
                    (22_000 + n, " ".join(x for k, x in enumerate(t.split()) if k % 30 != 17))]
    d = spark.createDataFrame(planted, "doc_id long, text string")
    d = docs.select("doc_id", "text").unionByName(d)
    got = {(r.doc_id, r.license_id): r.matched for r in ls.scan(d).collect()}
    assert got == brute(rows + planted, s, ls.TEMPLATES)
    for n, name in enumerate(ls.TEMPLATES):
        assert (20_000 + n, name) in got and (21_000 + n, name) in got


def test_key_words_are_needed():
    s = ls.Scan()
    t = [ls.template_words(x) for x in ls.TEMPLATES.values()]
    keys = set(ls.key_words(t, s))
    for w in t:
        sh = ls.template_shingles(w, s.shingle)
        assert sum(not keys & set(x.split()) for x in sh) < s.threshold * len(sh)


def test_odd_tables(none, repeated, docs):
    assert ls.scan(none).count() == 0 and ls.scan(repeated).count() == 0
    assert ls.scan(docs, templates={}).count() == 0


def test_no_python_in_the_plan(docs):
    plan = ls.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_short_notices_are_not_lost(spark):
    """Exact copies of the shortest notice at the start of a text, where it lies in one window only."""
    import random
    rnd = random.Random(3)
    texts = [(i, "All rights reserved. " + " ".join(f"w{rnd.randrange(10 ** 9)}" for _ in range(30))) for i in range(3000)]
    got = ls.scan(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {r.doc_id for r in got.where("license_id = 'all-rights-reserved' and containment = 1").collect()} == set(range(3000))


def test_worst_miss_of_an_exact_copy():
    s = ls.Scan()
    for name, t in ls.TEMPLATES.items():
        w = ls.template_words(t)
        share = len(ls.template_shingles(w, s.shingle)) / (3 * ls.size_class(len(w), s) // 2 - s.shingle + 1)
        assert (1 - share) ** s.bands < 2e-6, name
