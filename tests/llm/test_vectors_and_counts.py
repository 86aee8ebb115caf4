import brute
import numpy as np

from tidemark.llm import vector_dedup as vd
from tidemark.llm import wordpiece as wp


def test_links_equal_brute_force(spark):
    """Groups larger than the window, copies, chains, and vectors that can't link."""
    rng = np.random.default_rng(4)
    rows = []
    for g in range(6):
        c = rng.standard_normal(16)
        for _ in range((150, 3, 40, 2, 2, 1)[g]):
            rows.append(c + rng.standard_normal(16) * 0.08)
    rows += [rng.standard_normal(16) for _ in range(100)] + [rows[0]] * 5 + [rows[0] * 3, rows[190] * 1e-30]
    rows = [list(map(float, np.float32(r))) for r in rows]
    rows += [None, [], [0.0] * 16, [1.0] * 15 + [None], [float("nan")] * 16, [float("inf")] + [0.0] * 15, [1.0] * 3, [1.0] * 3]
    d = spark.createDataFrame([(i, v, "x", 0) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, cls string, dim int")
    got = {r.vec_id: r for r in vd.link(d, vd.Passes(window=48, passes=12)).collect()}
    ok = [i for i, v in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    n, u = dict.fromkeys(range(len(rows)), 0), brute.Union()
    for i in ok:
        for j in ok:
            if i != j and len(rows[i]) == len(rows[j]):
                a, b = np.array(rows[i]), np.array(rows[j])
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9:
                    n[i] += 1
                    u.join(i, j)
    assert all(got[i].n_links <= n[i] for i in n)                      # none below the threshold
    assert sum(r.n_links for r in got.values()) >= 0.98 * sum(n.values())
    assert {i: r.component_id for i, r in got.items()} == {i: u.find(i) for i in n}
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_no_group_is_cut_at_a_segment(spark):
    """A tight group of many segments, far beyond window and segment, beside other vectors: every link of it counts, also where rounds go on."""
    rng = np.random.default_rng(11)
    c = rng.standard_normal(16)
    rows = [c + rng.standard_normal(16) * 0.003 for _ in range(900)] + [rng.standard_normal(16) for _ in range(300)]
    d = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    x = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    links = (x @ x.T >= 0.9).sum(axis=1) - 1
    got = {r.vec_id: r for r in vd.link(d, vd.Passes(window=16, segment=2, passes=4)).collect()}
    assert all(got[i].n_links == links[i] for i in range(900))
    assert {got[i].component_id for i in range(900)} == {0}
    assert all(got[i].n_links <= links[i] for i in range(900, 1200))


def test_planted_pairs_at_the_threshold(spark):
    """Pairs at 0.9 to 0.92 among many vectors for the window: the passes that the row count asks for find them, the floor alone doesn't."""
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = unit(rng.standard_normal((500, 64)))
    off = rng.standard_normal((500, 64))
    off = unit(off - (off * x).sum(axis=1, keepdims=True) * x)
    cos = rng.uniform(0.9001, 0.92, (500, 1))
    rows = np.concatenate([x, cos * x + np.sqrt(1 - cos * cos) * off, rng.standard_normal((1000, 64))])
    p = vd.Passes(window=64, passes=2, recall=0.999)
    assert vd.passes_for(p, len(rows)) > p.passes
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in vd.link(d, p).collect()}
    found = sum(got[i].n_links == 1 == got[500 + i].n_links and got[500 + i].component_id == i for i in range(500))
    assert found >= 0.99 * 500


def test_passes_grow_with_the_rows():
    n = [vd.passes_for(vd.Passes(), 10 ** k) for k in range(9)]
    assert n == sorted(n) and n[:4] == [12] * 4 and n[7] > n[6] > n[5] > 12
    assert vd.passes_for(vd.Passes(passes=100), 10 ** 7) == 100


def test_pairs_meet_whatever_the_partitions(spark):
    """Segments of one window: a single pass over one line of vectors finds the neighbours across every border, at any partition count."""
    rng = np.random.default_rng(7)
    turn = np.linspace(0, np.pi, 400)
    rows = [(i, [float(np.cos(t)), float(np.sin(t))]) for i, t in enumerate(turn)]
    rng.shuffle(rows)
    d = spark.createDataFrame([(int(i), v) for i, v in rows], "vec_id long, embedding array<double>")
    found = []
    for n in ("1", "7", "64"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            found.append(sorted((r.vec_id, r.n_links, r.component_id) for r in vd.link(d, vd.Passes(window=20, segment=2, passes=3)).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    assert found[0] == found[1] == found[2]
    assert {c for _, _, c in found[0]} == {0}


def test_vectors_odd_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert vd.link(spark.createDataFrame([], kind)).count() == 0
    got = vd.link(spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [0.0, 1.0]), (None, None)], kind)).collect()
    assert sorted(((r.vec_id or -1), r.n_links) for r in got) == [(-1, 0), (-1, 2), (1, 2), (1, 2), (2, 0)]


def greedy(word, initial, inner, most=100):
    i = n = 0
    while i < len(word) <= most:
        j = next((j for j in range(len(word), i, -1) if word[i:j] in (inner if i else initial)), None)
        if j is None:
            return 1
        i, n = j, n + 1
    return n if len(word) <= most else 1


def test_automaton_equals_greedy_matching():
    import random
    rnd = random.Random(1)
    for _ in range(60):
        words = lambda k: {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 6))) for _ in range(k)}
        initial, inner = words(rnd.randint(1, 12)), words(rnd.randint(1, 12))
        a = wp.Automaton(sorted(initial), sorted(inner), 30)
        for _ in range(300):
            w = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14)))
            assert a.count(w) == greedy(w, initial, inner, 30), (w, initial, inner)


def test_counts_of_documents(docs, rows, none, repeated):
    initial, inner = map(set, wp.load(wp.Vocabulary()))
    got = {r.doc_id: r for r in wp.token_counts(docs).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        w = brute.WORD.findall(t or "")
        assert (got[i].n_words, got[i].n_tokens) == (len(w), sum(greedy(x, initial, inner) for x in w)), i
    assert wp.token_counts(none).count() == 0 and wp.token_counts(repeated).count() == repeated.count()


def test_long_words_are_counted_whole(spark, scratch):
    """op10_token_counts splits words of 101 and 1,000,000 characters, texts without spaces and blobs; an option still caps them."""
    from tidemark.llm.queries import op10_token_counts
    initial, inner = map(set, wp.load(wp.Vocabulary()))
    most = max(map(len, initial | inner))

    def pieces(word):
        i = n = 0
        while i < len(word):
            j = next((j for j in range(min(len(word), i + most), i, -1) if word[i:j] in (inner if i else initial)), None)
            if j is None:
                return 1
            i, n = j, n + 1
        return n

    words = ["a" * 100, "a" * 101, "international" * 8, "abcde" * 200_000, "deadbeef" * 40, "https://example.org/" + "path/" * 40]
    texts = [*words, " ".join(words), "a" * 101 + " " + "a" * 101, "a" * 5000 + "\ue000"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{scratch}/documents.parquet")
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in op10_token_counts(spark, scratch).collect()}
    assert got == {i: (len(t.split()), sum(map(pieces, t.split()))) for i, t in enumerate(texts)}
    assert got[1][1] > 1 and got[3][1] > 1000
    capped = {r.doc_id: r.n_tokens for r in wp.token_counts(spark.read.parquet(f"{scratch}/documents.parquet"), wp.Vocabulary(max_chars=100)).collect()}
    assert capped[1] == capped[3] == 1


def test_classes_whose_rows_all_lack_an_id(spark):
    """They count as links of others and join them; a component is named by the least id there is."""
    a, b = [1.0, 0.0, 0.0], [0.98, 0.199, 0.0]
    far = [0.9, 0.0, 0.4358]                       # near a, not near b
    rows = [(5, b), (None, a), (None, a), (3, far), (9, [0.0, 0.0, 1.0]), (None, [0.0, -1.0, 0.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in vd.link(d).collect())
    assert got == [(0, 0, None, True), (0, 3, None, True), (0, 3, None, True), (3, 2, 3, True), (5, 2, 3, False), (9, 0, 9, True)]
