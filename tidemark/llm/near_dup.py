"""MinHash near-dedup (2): chosen-path set similarity join over word shingles.

Each document's set is its distinct word shingles.  Documents with equal sets
form a class, and one member stands for it.  Independent trees branch the
classes by minwise tokens (level 1: one token per tree).  A node of at most
``small`` classes is compared exhaustively; a larger one first links its
members to a pivot, then to ``stars`` fresh pivots those that are not
connected yet, and then branches again: two tokens, drawn anew for every tree
and level, until its nodes are small or all of their members are connected
anyway.  A node whose children would together hold more than ``pays`` of its
comparisons is a dense group that tokens do not divide: it is compared in
full, with its whole sets, in cells of two blocks of members, and a cell
returns only links that join two groups there, fewer than it has members.
Pairs of small nodes pass a signature estimate and are confirmed on full sets.

A pair at the threshold t meets in a tree's first node with probability t.
Two further tokens a level keep it together at every depth with probability
1 - q at least, q = (1 - t + t q)**2 (a branching process): q = 1/16 for 0.8.
So ``trees`` independent trees miss it with (1 - t (1 - q))**trees at most:
8 trees give 1.6e-5 however deep they go (2.6e-6 where a node is small or
compared in full at once), and the estimate's margin of 4.5 standard
deviations adds about 3e-6.

Defined cases: null or wordless text: empty set, linked with nothing.  Fewer
words than ``words``: the whole sequence is the one shingle.  A null id is not
compared: its component is null and it is kept.  Rows that repeat an id are
judged each by their own text.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import cut, dealt, drop, give_back, only, tune
from .components import components

U = np.uint64
#: a row of a node that is compared in full
FULL = ("node", "rep", "comp", "size", "weight")


@dataclass(frozen=True)
class ChosenPath:
    """Parameters of the join."""
    words: int = 5
    threshold_pct: int = 80   # link if 100 * intersection >= threshold_pct * union
    trees: int = 8
    sketch: int = 128         # minwise bytes of the estimate
    margin: float = 4.5       # standard deviations below the threshold that an estimate may lie
    stars: int = 3            # stars from fresh pivots in large nodes that hold several components
    small: int = 8            # classes in a node that is compared exhaustively
    pays: float = 0.8         # share of a node's comparisons that its children may hold together; below 1, so that branching ends
    block: int = 1024         # members of a block of a node that is compared in full
    block_bytes: int = 4 << 20  # bytes of the sets of a block
    depth: int = 64           # levels; what is large below is compared in full

    def __post_init__(self):
        if not 0 <= self.pays < 1:
            raise ValueError("pays must be at least 0 and below 1")

    @property
    def least_equal(self) -> int:
        """Equal sketch bytes that a pair needs to be confirmed."""
        t = self.threshold_pct / 100
        return max(1, int(self.sketch * (t - self.margin * (t * (1 - t) / self.sketch) ** 0.5)))


# --- sets and signatures -----------------------------------------------------------------

def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int):
    """Sorted distinct 64-bit shingle hashes of every row, in order (generator)."""
    for a, b in tb.chunks(offs):
        o = offs[a:b + 1] - offs[a]
        buf = tb.LOWER[data[offs[a]:offs[b]]]
        s, e, first = tb.word_spans(buf, o)
        h = tb.span_hash(tb.prefix_hash(buf), s, e)
        n = len(h) - k + 1
        w = tb.combine([h[i:i + n] for i in range(k)]) if n > 0 else np.zeros(0, U)
        for i in range(b - a):
            lo, hi = first[i], first[i + 1]
            if hi - lo >= k:
                yield np.unique(w[lo:hi - k + 1])
            elif hi > lo:
                yield tb.combine([h[j:j + 1] for j in range(lo, hi)])
            else:
                yield np.zeros(0, U)


def _minwise(u: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """The least element of the set under every multiplier."""
    low = np.full(len(odd), 2**64 - 1, U)
    for i in range(0, len(u), 4096):
        np.minimum(low, (u[i:i + 4096, None] * odd[None, :]).min(axis=0), out=low)
    return tb.mix(low)


def _signer(p: ChosenPath):
    rng = np.random.default_rng(41)
    paths = p.trees
    odd = rng.integers(0, 2**63 - 1, paths + p.sketch, dtype=U) * U(2) + U(1)

    def sign(u: np.ndarray) -> tuple[bytes, bytes]:
        low = _minwise(u, odd)
        return low[:paths].astype("<u4").tobytes(), (low[paths:] & U(255)).astype(np.uint8).tobytes()
    return sign


def _fingerprint(u: np.ndarray) -> bytes:
    v = tb.mix(u ^ U(0xA5A5A5A5DEADBEEF))
    return int(u.sum(dtype=U)).to_bytes(8, "little") + int(v.sum(dtype=U)).to_bytes(8, "little")


def _signatures(p: ChosenPath):
    def run(batches):
        sign = _signer(p)
        for batch in batches:
            n, fp, path, sketch = [], [], [], []
            for u in shingle_sets(*tb.binary(batch.column(1)), p.words):
                n.append(len(u))
                if len(u):
                    fp.append(_fingerprint(u))
                    x, y = sign(u)
                else:
                    fp, x, y = fp + [None], None, None
                path.append(x)
                sketch.append(y)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(path, pa.binary()),
                 pa.array(sketch, pa.binary())], names=["doc_id", "n_shingles", "fp", "path", "sketch"])
    return run


def _sets(k: int):
    """(rep, fp, shingles) of rows (rep, text); the fingerprint tells rows of another text under the same id."""
    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(*tb.binary(batch.column(1)), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([_fingerprint(u) if len(u) else None for u in sets], pa.binary()),
                 pa.array([u.tobytes() for u in sets], pa.large_binary()).cast(pa.binary())], names=["rep", "fp", "shingles"])
    return run


def _tokens(p: ChosenPath, level: int):
    """(rep, deep): two minwise tokens of 8 bytes for every tree, drawn for this level alone."""
    def run(batches):
        odd = np.random.default_rng([43, level]).integers(0, 2**63 - 1, 2 * p.trees, dtype=U) * U(2) + U(1)
        for batch in batches:
            deep = [_minwise(np.frombuffer(x, U), odd).astype("<u8").tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deep, pa.binary())], names=["rep", "deep"])
    return run


# --- candidates and their confirmation ------------------------------------------------------

def _alike(least: int):
    """Pairs (a, b, sa, sb) whose sketches agree in ``least`` bytes or more."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (2, 3))
            ok = (x == y).sum(axis=1) >= least
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], names=["a", "b"])
    return run


def _exhaustive(least: int):
    """Small nodes (list of rep, comp, sketch): pairs of unconnected members that look alike."""
    def run(batches):
        for batch in batches:
            out = []
            for members in batch.column(0).to_pylist():
                sk = np.frombuffer(b"".join(m["sketch"] for m in members), np.uint8).reshape(len(members), -1)
                same = (sk[:, None, :] == sk[None, :, :]).sum(axis=2)
                for i, j in zip(*np.nonzero(np.triu(same >= least, 1)), strict=True):
                    x, y = members[i], members[j]
                    if x["comp"] != y["comp"] and x["rep"] != y["rep"]:
                        out.append((min(x["rep"], y["rep"]), max(x["rep"], y["rep"])))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
    return run


def shared(sets: list[np.ndarray], few: int = 128, width: int = 2048, most: int = 1 << 22) -> np.ndarray:
    """Intersection sizes of all pairs i < j of sets: elements of few sets by their pairs, the others by matrix products."""
    n = len(sets)
    who = np.repeat(np.arange(n), [len(x) for x in sets])
    h = np.concatenate(sets) if n else np.zeros(0, U)
    order = np.argsort(h, kind="stable")
    h, who = h[order], who[order]
    start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    count = np.diff(np.append(start, len(h)))
    both = np.zeros(n * n, np.int64)
    held, size = [], 0
    for c in range(2, min(few, n) + 1):
        cols = start[count == c]
        x, y = np.triu_indices(c, 1)
        step = max(1, most // len(x))
        for k in range(0, len(cols), step):
            rows = who[cols[k:k + step, None] + np.arange(c)]
            held.append((rows[:, x] * n + rows[:, y]).ravel())
            size += len(held[-1])
            if size >= most:
                both += np.bincount(np.concatenate(held), minlength=n * n)
                held, size = [], 0
    if held:
        both += np.bincount(np.concatenate(held), minlength=n * n)
    both = both.reshape(n, n)
    many = np.flatnonzero(count > few)
    for k in range(0, len(many), width):
        cols = many[k:k + width]
        dense = np.zeros((n, len(cols)), np.float32)
        for j, c in enumerate(cols):
            dense[who[start[c]:start[c] + count[c]], j] = 1
        both += (dense @ dense.T).astype(np.int64)
    return np.triu(both, 1)


def forest(rep: np.ndarray, comp: np.ndarray, side: np.ndarray, sets: list[np.ndarray], pct: int) -> list[tuple[int, int]]:
    """Links of one cell that join two of its groups. ``side`` -1: all pairs; else pairs across the two sides."""
    both = shared(sets)
    both += both.T
    n = np.array([len(x) for x in sets], np.int64)
    link = 100 * both >= pct * (n[:, None] + n[None, :] - both)
    link &= (side[:, None] < 0) | (side[:, None] != side[None, :])
    comp, out = comp.copy(), []
    for i in range(len(rep)):
        near = np.flatnonzero(link[i] & (comp != comp[i]))
        labels, first = np.unique(comp[near], return_index=True)
        if len(labels):
            out += [(int(rep[i]), int(rep[near[k]])) for k in first]
            comp[np.isin(comp, labels)] = comp[i]
    return out


def _cells(pct: int):
    """Cells (list of rep, comp, side, shingles): links that join two groups of the cell."""
    def run(batches):
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                members = batch.column(0)[i].values
                rep, comp, side = (np.asarray(members.field(k)) for k in (0, 1, 2))
                data = members.field(3)
                out += forest(rep, comp, side, [np.frombuffer(data[k].as_buffer(), U) for k in range(len(rep))], pct)
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
    return run


def _in_full(rows: DataFrame, sets: DataFrame, p: ChosenPath) -> DataFrame:
    """Links (a, b) of nodes that tokens do not divide, compared in full: a node of w blocks makes w (w + 1) / 2 cells.

    A cell holds two blocks at most, bounded in members and bytes, so the size of a node adds tasks and not memory.
    """
    width = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(p.block)), F.ceil(F.col("weight") / F.lit(p.block_bytes))).cast("int")
    own = F.pmod(F.xxhash64(F.lit(7), "rep"), width).cast("int")
    cells = (rows.select("level", "node", "rep", "comp", own.alias("i"), F.explode(F.sequence(F.lit(0), width - 1)).alias("j"))
             .select(F.xxhash64("level", "node", F.least("i", "j"), F.greatest("i", "j")).alias("cell"), "rep", "comp",
                     F.when(F.col("i") == F.col("j"), -1).otherwise((F.col("i") > F.col("j")).cast("int")).alias("side")))
    return (cells.join(sets, "rep").groupBy("cell").agg(F.collect_list(F.struct("rep", "comp", "side", "shingles")).alias("m"))
            .select("m").mapInArrow(give_back(_cells(p.threshold_pct)), "a long, b long"))


def _confirm(pct: int):
    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= pct * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok, pa.bool_())) for c in (0, 1)], names=["a", "b"])
    return run


def _ends(sets: DataFrame, pairs: DataFrame, end: str) -> DataFrame:
    """The sets of one end of the pairs alone."""
    return sets.join(pairs.select(F.col(end).alias("rep")).distinct(), "rep", "left_semi")


def _attach(pairs: DataFrame, of_a: DataFrame, of_b: DataFrame, col: str) -> DataFrame:
    """(a, b, value of a, value of b) by two key joins; an ``a`` of very many pairs is met last, with rows that AQE can split."""
    one = pairs.join(of_b.select(F.col("rep").alias("b"), F.col(col).alias("vb")), "b")
    return one.join(of_a.select(F.col("rep").alias("a"), F.col(col).alias("va")), "a").select("a", "b", "va", "vb")


def _confirmed(pairs: DataFrame, of_a: DataFrame, of_b: DataFrame, p: ChosenPath, name: str) -> DataFrame:
    """The pairs that are links by the full sets of their ends."""
    return cut(_attach(pairs, of_a, of_b, "shingles").mapInArrow(give_back(_confirm(p.threshold_pct)), "a long, b long"), name)


def _links(pairs: DataFrame, sets: DataFrame, p: ChosenPath) -> DataFrame:
    """The pairs that are links. The sets of the first ends are written, those of the second ends stay in their buckets."""
    of_a = cut(_ends(sets, pairs, "a"), "nd-ends")
    out = _confirmed(pairs, of_a, _ends(sets, pairs, "b"), p, "nd-links")
    drop(of_a)
    return out


def _per_node(rows: DataFrame, *more: str) -> DataFrame:
    """Nodes that hold two components or more, with their size and the bytes of their sets."""
    return (rows.groupBy("node", *more).agg(F.count(F.lit(1)).alias("size"), F.sum(8 * F.col("n")).alias("weight"),
                                            F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            .where("lo < hi").drop("lo", "hi"))


def _union(tables: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, tables)


def _open_nodes(rows: DataFrame, name: str) -> DataFrame:
    """Rows of nodes that hold two components or more, with the node's size and weight."""
    per = cut(_per_node(rows), f"{name}-per")
    out = cut(rows.join(per, "node"), name)
    drop(per)
    return out


def _branch(large: DataFrame, sets: DataFrame, p: ChosenPath, level: int) -> tuple[DataFrame, DataFrame]:
    """(open rows of the children, rows of the nodes that tokens do not divide). Two written tables."""
    deep = cut(sets.join(large.select("rep").distinct(), "rep").select("rep", "shingles").mapInArrow(_tokens(p, level), "rep long, deep binary"), "nd-deep")
    token = lambda j: F.xxhash64("node", F.lit(j), F.substring("deep", F.col("tree") * 16 + (8 * j + 1), F.lit(8)))
    child = cut(large.join(deep, "rep").select("tree", "rep", "n", "comp", "sketch", F.col("node").alias("parent"), F.col("size").alias("parent_size"),
                                               F.explode(F.array(token(0), token(1))).alias("node")), "nd-child")
    per = cut(_per_node(child, "parent", "parent_size"), "nd-per")
    stuck = cut(per.groupBy("parent", "parent_size").agg(F.sum(F.col("size").cast("double") * F.col("size")).alias("work"))
                .where(F.col("work") > p.pays * F.col("parent_size").cast("double") * F.col("parent_size")).select("parent"), "nd-stuck")
    rows = cut(child.drop("parent", "parent_size").join(per.join(stuck, "parent", "left_anti").select("node", "size", "weight"), "node"), "nd-open")
    full = cut(large.join(stuck.withColumnRenamed("parent", "node"), "node", "left_semi").select(*FULL), "nd-full")
    drop(deep, child, per, stuck)
    return rows, full


def token(col: str, i: int) -> Column:
    return F.substring(col, 4 * i + 1, 4)


def link(docs: DataFrame, p: ChosenPath = ChosenPath(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept. A written table."""
    tune(docs.sparkSession)
    d = only(docs, **{"doc_id": id_col, "text": text}).withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = cut(d.mapInArrow(give_back(_signatures(p)), "doc_id long, n_shingles long, fp binary, path binary, sketch binary"), "nd-signed")
    filled = signed.where("n_shingles > 0 and doc_id is not null")
    # one row stands for each class, named by a hash of its set; ids may repeat
    stand = cut(filled.groupBy("fp").agg(F.min(F.struct("doc_id", "n_shingles", "path", "sketch")).alias("s"))
                .select("fp", F.xxhash64("fp").alias("rep"), F.col("s.doc_id").alias("id"), F.col("s.n_shingles").alias("n"), "s.path", "s.sketch"), "nd-stand")
    alike = _alike(p.least_equal)

    # level 1: a node per tree and token value; rows carry their sketches, so that stars need no further join
    rows = stand.select("rep", "n", "sketch", F.posexplode(F.array(*[F.xxhash64(F.lit(t), token("path", t)) for t in range(p.trees)]))
                        .alias("tree", "node")).select("node", "tree", "rep", "n", "sketch")
    per = cut(rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("rep", "sketch")).alias("pivot")).where("size > 1"), "nd-per")
    nodes = cut(rows.join(per.select("node"), "node"), "nd-nodes")
    star = cut(nodes.join(per, "node").where("rep != pivot.rep")
               .select(F.col("pivot.rep").alias("a"), F.col("rep").alias("b"), F.col("pivot.sketch").alias("va"), F.col("sketch").alias("vb"))
               .mapInArrow(alike, "a long, b long").distinct(), "nd-star")
    # texts of every class that shares a node with another one: read and shuffled once
    some = nodes.select("rep").distinct().join(stand.select("rep", "id"), "rep")
    read = cut(d.join(some, d.doc_id == some.id).select("rep", "text").mapInArrow(give_back(_sets(p.words)), "rep long, fp binary, shingles binary")
               .where(F.xxhash64("fp") == F.col("rep")).select("rep", "shingles"), "nd-read")
    # the sets are dealt out by class once: no later join moves those that it does not need
    sets = dealt(read, "rep", "nd-sets")
    drop(read)
    made = [sets]
    linked = _links(star, sets, p)
    label = components(linked)

    def open_rows(label):
        named = label.select(F.col("node").alias("rep"), "component")
        rows = nodes.join(named, "rep", "left").select("node", "tree", "rep", "n", "sketch", F.coalesce("component", "rep").alias("comp"))
        return _open_nodes(rows, "nd-open")
    rows = open_rows(label)
    # large nodes of several components: stars from fresh pivots, so that dense groups grow together
    # by a few links a member before anything is compared in full
    large = rows.where(F.col("size") > p.small)
    picks = [F.min(F.struct(F.xxhash64("node", "rep", F.lit(k)).alias("h"), "rep", "comp", "sketch")) for k in range(p.stars)]
    fresh = cut(large.groupBy("node").agg(F.array(*picks).alias("p")).select("node", F.explode("p").alias("p")), "nd-fresh")
    fresh_pairs = (large.join(fresh, "node").where("comp != p.comp and rep != p.rep")
                   .select(F.col("p.rep").alias("a"), F.col("rep").alias("b"), F.col("p.sketch").alias("va"), F.col("sketch").alias("vb")))
    second = cut(fresh_pairs.mapInArrow(alike, "a long, b long").distinct(), "nd-star")
    new = _links(second, sets, p)
    if not new.isEmpty():
        old, before = label, rows
        label = components(label.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(new))
        rows = open_rows(label)
        drop(old, before)
    drop(fresh, second, new)
    # the rest: branched until small, or compared in full where tokens do not divide a node
    # a level only writes its rows: both kinds of nodes are compared once, over the rows of all levels
    few, undivided = [], []
    for level in range(1, p.depth + 1):
        made.append(rows)
        few.append(rows.where(F.col("size") <= p.small).select(F.lit(level).alias("level"), "node", "rep", "comp", "sketch"))
        large = rows.where(F.col("size") > p.small)
        if large.isEmpty():
            break
        if level == p.depth:
            undivided.append(large.select(F.lit(level).alias("level"), *FULL))
            break
        rows, full = _branch(large, sets, p, level)
        undivided.append(full.select(F.lit(level).alias("level"), *FULL))
        made.append(full)
    found = (_union(few).groupBy("level", "node").agg(F.collect_list(F.struct("rep", "comp", "sketch")).alias("members"))
             .select("members").mapInArrow(_exhaustive(p.least_equal), "a long, b long"))
    pairs = cut(found.distinct(), "nd-pairs")
    more = _links(pairs, sets, p)
    edges = label.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    if undivided:
        edges = edges.unionByName(_in_full(_union(undivided), sets, p))
    final = components(edges)

    # a component is named by the least id of its classes
    member = stand.select("fp", "rep", "id").join(final.withColumnRenamed("node", "rep"), "rep", "left")
    least = member.where("component is not null").groupBy("component").agg(F.min("id").alias("least"))
    named = member.join(least, "component", "left").select("fp", F.coalesce("least", "id").alias("least"))
    rows = signed.select("doc_id", "n_shingles", "fp").join(named, "fp", "left")
    out = cut(rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id")), "nd-result")
    drop(signed, stand, per, nodes, star, linked, label, pairs, more, final, *made)
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept"))


def keep_one(docs: DataFrame, p: ChosenPath = ChosenPath()) -> DataFrame:
    """The documents of which one stays per component; columns of the input. An id goes only if none of its rows is kept."""
    gone = link(docs, p).groupBy("doc_id").agg(F.max("kept").alias("any")).where("not any").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
