import brute
import pytest

from tidemark.llm import near_dup as nd


@pytest.mark.parametrize("k", [4, 5])
def test_equals_brute_force(docs, rows, k):
    want = brute.near_duplicates(rows, k, 80)
    got = {r.doc_id: r for r in nd.link(docs, nd.ChosenPath(words=k)).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_branching_loses_no_link(spark):
    """A dense group far above the node size, a chain across it, and documents that share a long passage."""
    import random
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randrange(10**6)}"
    base = [word() for _ in range(80)]
    common = [word() for _ in range(30)]
    out = []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(80)] = word()
        out.append((i, " ".join(w)))
    for i in range(150, 260):
        out.append((i, " ".join(common + [word() for _ in range(15)])))
    chain = [word() for _ in range(60)]
    for i in range(260, 290):
        chain = chain[2:] + [word(), word()]
        out.append((i, " ".join(chain)))
    d = spark.createDataFrame(out, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.link(d, nd.ChosenPath(words=4, depth=3)).collect()}
    assert got == brute.near_duplicates(out, 4, 80)


def test_odd_tables(none, repeated):
    assert nd.link(none).count() == 0
    got = nd.link(repeated).collect()
    assert len(got) == repeated.count()
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert {r.component_id for r in got if r.doc_id == 1} == {1}


def test_keep_one(docs):
    kept = nd.keep_one(docs, nd.ChosenPath(words=5))
    assert kept.schema.names == docs.schema.names
    want = {i for i, (n, c) in brute.near_duplicates([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 5, 80).items() if i == c}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == want


def test_shared_counts_and_forest():
    """Few and many holders of an element, one matrix column at a time, against sets."""
    import numpy as np
    rnd = np.random.default_rng(3)
    sets = [np.unique(rnd.integers(0, 60, rnd.integers(0, 40)).astype(np.uint64)) for _ in range(70)]
    want = np.array([[len(np.intersect1d(x, y)) if i < j else 0 for j, y in enumerate(sets)] for i, x in enumerate(sets)])
    for few, width, most in ((1, 3, 8), (5, 2048, 8), (128, 2048, 1 << 22)):
        assert (nd.shared(sets, few, width, most) == want).all()
    assert nd.shared([]).shape == (0, 0)
    rep, comp = np.arange(70), np.arange(70) % 66
    for side in (np.full(70, -1), np.arange(70) % 2):
        u, n = brute.Union(), [len(x) for x in sets]
        for i in range(70):
            u.join(f"c{comp[i]}", f"r{i}")
        all_pairs = [(i, j) for i in range(70) for j in range(i + 1, 70) if (side[i] < 0 or side[i] != side[j])
                     and 100 * want[i, j] >= 45 * (n[i] + n[j] - want[i, j])]
        got = nd.forest(rep, comp, side, sets, 45)
        assert len(got) < 70 and {tuple(sorted(x)) for x in got} <= set(all_pairs)
        v = brute.Union()
        v.p = dict(u.p)
        for i, j in all_pairs:
            u.join(f"r{i}", f"r{j}")
        for i, j in got:
            v.join(f"r{i}", f"r{j}")
        groups = lambda w: [[w.find(f"r{i}") == w.find(f"r{j}") for j in range(70)] for i in range(70)]
        assert groups(u) == groups(v)


def dense(n, seed):
    """A group whose members share most words and mostly lie below the threshold, so tokens do not divide it."""
    import random
    rnd = random.Random(seed)
    base = [f"b{i}" for i in range(200)]
    out = []
    for i in range(n):
        w = list(base)
        for k in rnd.sample(range(200), rnd.randrange(1, 12)):
            w[k] = f"x{rnd.randrange(10**6)}"
        out.append((i, " ".join(w)))
    return out


def test_full_comparison_in_many_cells(spark):
    """Blocks of 16 members, or of few bytes: the result is that of one cell, and a cell returns less than its members."""
    out = dense(180, 11)
    d = spark.createDataFrame(out, "doc_id long, text string")
    want = brute.near_duplicates(out, 4, 80)
    assert 1 < len({c for _, c in want.values()}) < 180
    for p in (nd.ChosenPath(words=4, block=16), nd.ChosenPath(words=4, block_bytes=20_000, depth=1)):
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in nd.link(d, p).collect()} == want


def test_repeated_ids_are_judged_by_their_own_text(spark):
    """Id 1 has two unlike texts, each with a near copy: two components, and the id stays as one of its rows is kept."""
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    d = spark.createDataFrame([(1, a), (1, b), (2, a + " tail"), (0, b + " tail"), (3, b)], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in nd.link(d).collect())
    assert got == [(0, 0), (1, 0), (1, 1), (2, 1), (3, 0)]
    assert sorted(r.doc_id for r in nd.keep_one(d).collect()) == [0, 1, 1]


def test_recall_of_the_branched_path():
    """A pair at the threshold: the share of trees that keep it together through many levels, by the stated formula."""
    import numpy as np
    t, q = 0.8, 1 / 16
    rnd, alive, n = np.random.default_rng(9), 0, 4000
    for _ in range(n):
        nodes = int(rnd.random() < t)
        for _ in range(12):
            nodes = rnd.binomial(2 * min(nodes, 1000), t)
        alive += nodes > 0
    assert abs(alive / n - t * (1 - q)) < 0.03
    assert abs(q - (1 - t + t * q) ** 2) < 1e-12
