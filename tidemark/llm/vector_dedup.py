"""Embedding near-dedup (7): sorted projection passes.

Every pass draws random hyperplanes, concatenates their signs to a code and
ranks the vectors by the code (a range sort of codes and hashes, without the
vectors; equal codes stand in an order of their own in every pass).  The order
is dealt out in segments of fixed length by rank, each with the window that
stands before it, so every vector meets its next ``window`` neighbours
whatever the number of partitions.  A vector that links within a whole block
goes on to the next block until one holds no link of it.  Vectors that still
link where their segment ends go on in rounds: cells (segment, later segment)
are dealt to tasks, a cell holds at most two segments, and every round reaches
twice as far as the last one, so no size of a group cuts its links.  Cosines
are computed in double precision from the whole vectors.  Equal vectors are
compared once and counted with their number.

No pair is ever written.  A vector keeps its block and the last block it was
compared with for every pass, which tells whether an earlier pass compared two
vectors; a pass counts the links that are new and keeps edges that span them.
The number of passes follows from the number of vectors and the recall that is
asked for at the threshold (:func:`passes_for`).

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different length are never compared;
rows that repeat an id are vectors of their own that share a node; rows
without id count as links of others, and their component is null.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop, only, tune
from .components import components
from .order import prefix_sums


@dataclass(frozen=True)
class Passes:
    cosine: float = 0.9
    passes: int = 12             # at least; more as ``recall`` asks for
    recall: float = 0.999        # of pairs exactly at the threshold, among evenly spread vectors
    bits: int = 32
    window: int = 512
    segment: int = 16            # in windows: what one task holds in order at a time
    seed: int = 23


def passes_for(p: Passes, rows: int) -> int:
    """Passes that find a pair at the threshold with probability ``recall``.

    Two such vectors agree in a sign with probability 1 - angle / pi, and meet
    in a pass if they share about log2(rows / window) leading signs.
    """
    agree = 1 - np.arccos(np.clip(p.cosine, -1, 1)) / np.pi
    meet = agree ** min(max(np.log2(max(rows, 1) / p.window), 0), p.bits)
    if meet >= p.recall or p.recall <= 0:
        return p.passes
    if meet == 0 or p.recall >= 1:
        raise ValueError(f"no number of passes finds pairs at cosine {p.cosine} with probability {p.recall}")
    return max(p.passes, int(np.ceil(np.log1p(-p.recall) / np.log1p(-meet))))


def _planes(p: Passes, k: int, dim: int) -> np.ndarray:
    return np.random.default_rng([p.seed, k, dim]).standard_normal((dim, p.bits))


def _vectors(batch: pa.RecordBatch, i: int) -> list:
    return [np.asarray(v, np.float64) if v is not None else None for v in batch.column(i).to_numpy(zero_copy_only=False)]


def _normal():
    """(vec_id, list) -> vec_id, dim, unit vector as doubles (null if it can't link)."""
    def run(batches):
        for batch in batches:
            dim, raw = [], []
            for v in batch.column(1).to_pylist():
                ok = bool(v) and not any(x is None for x in v)
                x = np.asarray(v, np.float64) if ok else np.zeros(0)
                ok = ok and bool(np.isfinite(x).all()) and bool(np.any(x))
                dim.append(len(x) if ok else 0)
                raw.append(x.astype("<f4" if (x == x.astype("<f4")).all() else "<f8").tobytes() if ok else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dim, pa.int32()), pa.array(raw, pa.binary())], names=["vec_id", "dim", "vec"])
    return run


def _unit(raw: list, dim: int) -> np.ndarray:
    """Unit rows; a value's bytes are floats where those hold it exactly, else doubles."""
    x = np.empty((len(raw), dim))
    for i, b in enumerate(raw):
        x[i] = np.frombuffer(b, "<f4" if len(b) == 4 * dim else "<f8")
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _codes(p: Passes, k: int):
    def run(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            raw = batch.column(2).to_pylist()
            code = np.zeros(len(dims), np.int64)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                sign = _unit([raw[i] for i in at], d) @ _planes(p, k, d) > 0
                code[at] = sign @ (1 << np.arange(p.bits - 1, -1, -1, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code)], names=["h", "dim", "code"])
    return run


#: rows of a pass: new links and the last block compared of a vector (where it ends still open: the last segment), or an edge
FOUND = "h binary, n long, reach int, open long, a long, b long"


def _unite(lab: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite pairs in ``lab``, which names the least row of every row's group."""
    a, b = lab[i], lab[j]
    while True:
        lo, hi = np.minimum(lab[a], lab[b]), np.maximum(lab[a], lab[b])
        on = lo != hi
        if not on.any():
            return
        a, b = a[on], b[on]
        np.minimum.at(lab, hi[on], lo[on])
        while True:
            up = lab[lab]
            if (up == lab).all():
                break
            lab[:] = up


class _Rows:
    """Rows that a task compares: links that no earlier pass compared are counted and united."""

    def __init__(self, rows: list[tuple]):
        self.h, cls, members, dim, raw, seen, rank = (list(c) for c in zip(*rows, strict=True))
        self.cls, self.members, self.dim = np.array(cls, np.int64), np.array(members, np.float64), np.array(dim)
        self.rank, self.raw = np.array(rank, np.int64), raw
        self.seen = np.array([np.asarray(x, np.int32) for x in seen], np.int32).reshape(len(rows), -1)
        self.n, self.lab = np.zeros(len(rows), np.int64), np.arange(len(rows))

    def units(self, at: np.ndarray) -> np.ndarray:
        return _unit([self.raw[i] for i in at], int(self.dim[at[0]]))

    def new(self, i: np.ndarray, j: np.ndarray) -> None:
        for k in range(0, self.seen.shape[1], 2):
            bi, bj = self.seen[i, k], self.seen[j, k]
            on = np.where(bi <= bj, bj > self.seen[i, k + 1], bi > self.seen[j, k + 1])
            i, j = i[on], j[on]
        if len(i):
            self.n += np.bincount(i, self.members[j], len(self.n)).astype(np.int64) + np.bincount(j, self.members[i], len(self.n)).astype(np.int64)
            _unite(self.lab, i, j)

    def found(self, reach: np.ndarray, open_: np.ndarray, to: int):
        """A row per vector (reach below 0: none) and the edges, in batches."""
        e = np.flatnonzero(self.cls != self.cls[self.lab])
        n, m = len(self.h), len(e)
        yield pa.RecordBatch.from_arrays([pa.array(self.h, pa.binary()), pa.array(self.n), pa.array(reach.astype(np.int32), mask=reach < 0),
                                          pa.array(np.full(n, to), mask=~open_), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=["h", "n", "reach", "open", "a", "b"])
        if m:
            yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()),
                                              pa.array(self.cls[e]), pa.array(self.cls[self.lab[e]])], names=["h", "n", "reach", "open", "a", "b"])


def _groups(batches, keys: int):
    """(key, rows) of consecutive rows whose first columns are the key."""
    at, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != at:
                if held:
                    yield at, held
                at, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield at, held


def _linked(p: Passes, g: _Rows, left: np.ndarray, x: np.ndarray, right: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of ``left`` link with any of ``right``; their pairs go to ``g``."""
    out = np.zeros(len(left), bool)
    for c in range(0, len(left), 4 * p.window):
        i, j = np.nonzero(x[c:c + 4 * p.window] @ y.T >= p.cosine)
        out[c + i] = True
        g.new(left[c + i], right[j])
    return out


def _within(p: Passes, last: int):
    """FOUND of segments, from rows (seg, h, cls, members, dim, vec, seen, rank) sorted by segment and rank."""
    def run(batches):
        for (seg,), rows in _groups(batches, 1):
            g = _Rows(rows)
            block = g.rank // p.window
            own = block >= seg * p.segment
            reach, open_ = np.where(own, block, -1), np.zeros(len(rows), bool)
            for d in np.unique(g.dim):
                live, x = np.zeros(0, np.int64), np.zeros((0, d))
                for k in np.unique(block[g.dim == d]):
                    at = np.flatnonzero((g.dim == d) & (block == k))
                    y = g.units(at)
                    if own[at[0]]:
                        i, j = np.nonzero(np.triu(y @ y.T >= p.cosine, 1))
                        g.new(at[i], at[j])
                        reach[live] = k
                        # rows without a link here are past their window, the others go on
                        on = _linked(p, g, live, x, at, y)
                        live, x = live[on], x[on]
                    old = len(live)
                    live, x = np.concatenate([live, at]), np.concatenate([x, y])
                open_[live[:old]] = seg < last
            yield from g.found(reach, open_, seg)
    return run


def _cells(p: Passes, last: int, step: int):
    """FOUND of cells, from rows (o, t, side, h, cls, members, dim, vec, seen, rank) sorted by cell: open rows of o against segment t."""
    def run(batches):
        for (o, _), rows in _groups(batches, 2):
            g = _Rows([r[1:] for r in rows])
            open_side = np.array([r[0] for r in rows]) == 0
            to = min(o + step, last)
            reach, open_ = np.where(open_side, (to + 1) * p.segment - 1, -1), np.zeros(len(rows), bool)
            for d in np.unique(g.dim):
                left = np.flatnonzero(open_side & (g.dim == d))
                right = np.flatnonzero(~open_side & (g.dim == d))
                if len(left) and len(right):
                    x = g.units(left)
                    for c in range(0, len(right), p.window):
                        at = right[c:c + p.window]
                        open_[left] |= _linked(p, g, left, x, at, g.units(at))
            yield from g.found(reach, open_ & (to < last), to)
    return run


def _ranked(one: DataFrame, p: Passes, k: int) -> DataFrame:
    """(h, rank) of pass k, a written table."""
    coded = one.select("h", "dim", "vec").mapInArrow(_codes(p, k), "h binary, dim int, code long")
    coded = coded.withColumn("g", F.lit(0)).withColumn("one", F.lit(1).cast("long")).withColumn("salt", F.xxhash64(F.lit(k), "h"))
    return prefix_sums(coded, "g", [F.col("dim"), F.col("code"), F.col("salt"), F.col("h")], "one", "vd-rank")


def found_links(one: DataFrame, p: Passes) -> tuple[DataFrame, DataFrame]:
    """Of classes (h, cls, members, dim, vec): (h, n: members of the classes it links with), (a, b): edges that span the links."""
    parts = int(one.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = one.count()
    last = max(total - 1, 0) // (p.window * p.segment)
    state = cut(one.select("h", F.lit(0).cast("long").alias("n"), F.array().cast("array<int>").alias("seen")), "vd-state")
    edges = None
    cols = ["h", "cls", "members", "dim", "vec", "seen", "rank"]
    for k in range(passes_for(p, total)):
        ranks = _ranked(one, p, k)
        rank = ranks.select("h", F.col("before").alias("rank"))
        rows = one.join(rank.join(state.select("h", "seen"), "h"), "h")
        block = F.floor(F.col("rank") / F.lit(p.window)).cast("long")
        seg = F.floor(block / F.lit(p.segment)).cast("long")
        # a row also stands before the segment it borders
        of = F.explode(F.when(block % p.segment == p.segment - 1, F.array(seg, seg + 1)).otherwise(F.array(seg)))
        dealt = rows.select(of.alias("seg"), *cols)
        found = [cut(dealt.repartition(parts, "seg").sortWithinPartitions("seg", "rank").mapInArrow(_within(p, last), FOUND), "vd-pass")]
        step = 1
        while last and not (still := found[-1].where("open is not null").groupBy("h").agg(F.max("open").alias("o"))).isEmpty():
            to = still.select("h", "o", F.explode(F.sequence(F.col("o") + 1, F.least(F.col("o") + step, F.lit(last).cast("long")))).alias("t"))
            left = rows.join(to, "h").select("o", "t", F.lit(0).alias("side"), *cols)
            right = rows.withColumn("t", seg).join(to.select("o", "t").distinct(), "t").select("o", "t", F.lit(1).alias("side"), *cols)
            cells = left.unionByName(right).repartition(parts, "o", "t").sortWithinPartitions("o", "t", "side", "rank")
            found.append(cut(cells.mapInArrow(_cells(p, last, step), FOUND), "vd-round"))
            step *= 2
        all_ = found[0]
        for f in found[1:]:
            all_ = all_.unionByName(f)
        some = cut(all_.where("a is not null").select("a", "b"), "vd-edges")
        edges = some if edges is None else edges.unionByName(some)
        per = all_.where("h is not null").groupBy("h").agg(F.sum("n").alias("m"), F.max("reach").alias("reach"))
        after = state.join(per, "h").join(rank, "h").select("h", (F.col("n") + F.col("m")).alias("n"), F.concat("seen", F.array(block.cast("int"), "reach")).alias("seen"))
        after = cut(after, "vd-state")
        drop(state, ranks, *found)
        state = after
    return state.select("h", "n"), edges


def link(vectors: DataFrame, p: Passes = Passes(), id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept per row."""
    tune(vectors.sparkSession)
    v = only(vectors, **{"vec_id": id_col, "v": vector}).withColumn("vec_id", F.col("vec_id").cast("long"))
    full = v.select("vec_id", F.col("v").cast("array<double>").alias("v")).mapInArrow(_normal(), "vec_id long, dim int, vec binary")
    full = full.withColumn("h", F.unhex(F.sha2(F.concat("vec", F.encode(F.col("dim").cast("string"), "utf-8")), 256)))
    # written without the vectors, which stand once per class in ``one``
    all_ = cut(full.select("vec_id", "dim", "h"), "vd-rows")
    # a class is all rows of one vector, named by a hash of it: its rows may all lack an id
    some = all_.where("dim > 0")
    per = cut(some.groupBy("h").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("members")).withColumn("cls", F.xxhash64("h")), "vd-classes")
    one = cut(full.where("dim > 0").select("h", "dim", "vec").dropDuplicates(["h"]).join(per, "h").select("h", "cls", "members", "dim", "vec"), "vd-one")
    links, pairs = found_links(one, p)
    comp = components(pairs)
    # a component is named by the least id of its classes
    named = per.join(comp.select(F.col("node").alias("cls"), "component"), "cls", "left")
    first = named.where("component is not null").groupBy("component").agg(F.min("least").alias("first"))
    named = named.join(first, "component", "left").select("h", "members", F.coalesce("first", "least").alias("first"))
    j = all_.select("vec_id", "h").join(named, "h", "left").join(links, "h", "left")
    n = F.when(F.col("members").isNull(), F.lit(0)).otherwise(F.col("members") - 1 + F.coalesce("n", F.lit(0))).cast("long")
    out = j.select("vec_id", n.alias("n_links"), F.when(F.col("vec_id").isNotNull(), F.coalesce("first", "vec_id")).alias("component_id"))
    out = cut(out, "vd-result")
    drop(all_, per, one, comp)
    return out.withColumn("kept", F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id")))
