"""Repeated strings (4): sampled anchors, grouped by fingerprints in three fixed passes (no suffix order).

Finds every byte covered by a ``length``-byte string that also starts earlier
(smaller id, or same document and earlier start).

1. Initial buckets.  Of the ``length - q + 1`` q-grams of every string the one
   with the least hash (leftmost on a tie) is its anchor, so equal strings have
   their anchors at equal offsets.  Consecutive starts mostly share an anchor;
   only anchors are sampled as suffixes and bucketed by their q-gram.  Buckets
   of one suffix hold no repeat and are dropped.
2. Grouping by the bytes around: an anchor's reach is the
   bytes of all strings it anchors.  Suffixes of equal reach form a sub-bucket;
   all but its first suffix are repeats over their whole reach.  A bucket with
   a single sub-bucket is settled.
3. What is left is split once more, first suffixes of sub-buckets only:
   their starts are split by the side on which more of the string lies, and
   bucketed by the q-gram with the bytes on that side; buckets of one suffix
   are settled.  The remaining starts are bucketed by their whole string; all
   but the first are repeats.

A settled bucket is never sorted again.  First members come from map-side
aggregated minima that are joined back, so a hot bucket is never gathered.

Defined cases: null text is empty; texts shorter than ``length`` keep all
bytes; rows that repeat an id are documents of their own, ordered by text
(null ids last); extra columns never enter.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import cut, drop, give_back, only, tune
from .order import unique_ids

U = np.uint64
ANCHOR = "uid long, s long, n short, nl short, gram long, reach long, lh int, rh int"
_POS = U(0xFFFFFFFF)


@dataclass(frozen=True)
class Repeats:
    length: int = 100
    q: int = 32

    @property
    def window(self) -> int:
        return self.length - self.q + 1

    @property
    def side(self) -> int:
        """Bytes beside the q-gram that a string holds on its longer side at least."""
        return (self.length - self.q) // 2


def _slide_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w consecutive values, by doubling."""
    m, k = x, 1
    while 2 * k <= w:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    return np.minimum(m[:len(x) - w + 1], m[w - k:]) if w > k else m


def anchors(buf: np.ndarray, offs: np.ndarray, r: Repeats):
    """(row, first start, starts, starts that lie mainly left, hashes of q-gram, reach, left and right) of each anchor."""
    none = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, U)] * 4
    if len(buf) < r.length:
        return none
    prefix = tb.prefix_hash(buf)
    at = np.arange(len(buf) - r.q + 1)
    gram = tb.span_hash(prefix, at, at + r.q)
    low = _slide_min((gram & ~_POS) | at.astype(U), r.window)  # index: start of the string
    pos = (low & _POS).astype(np.int64)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:len(pos)]
    start = np.flatnonzero(offs[1:][row] - np.arange(len(pos)) >= r.length)
    if not len(start):
        return none
    p = pos[start]
    first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
    n = np.diff(np.concatenate([first, [len(start)]]))
    s, p = start[first], p[first]
    reach = tb.mix(tb.span_hash(prefix, s, s + n - 1 + r.length) + (p - s).astype(U) * U(0x9E3779B97F4A7C15))
    left = np.clip(p - r.side - s + 1, 0, n)
    has = np.where(left > 0, p - r.side, p)  # no start lies mainly left: the bytes there may be another row's
    return (row[s], s - offs[row[s]], n, left, gram[p], reach, tb.span_hash(prefix, has, p + r.q),
            tb.span_hash(prefix, p, np.minimum(p + r.q + r.side, len(buf))))


def _anchor_rows(r: Repeats):
    def run(batches):
        for batch in batches:
            data, offs = tb.binary(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in tb.chunks(offs):
                row, s, n, left, gram, reach, lh, rh = anchors(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a], r)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a + row]), pa.array(s.astype(np.int64)), pa.array(n.astype(np.int16)),
                     pa.array(left.astype(np.int16)), pa.array(gram.view(np.int64)), pa.array(reach.view(np.int64)),
                     *(pa.array((x & U(0x7FFFFFFF)).astype(np.int32)) for x in (lh, rh))],
                    names=["uid", "s", "n", "nl", "gram", "reach", "lh", "rh"])
    return run


def _start_rows(r: Repeats):
    """(uid, text, list of (s, n)) -> a row per start: hash of the string there."""
    def run(batches):
        for batch in batches:
            data, offs = tb.binary(batch.column(1))
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for i in range(batch.num_rows):
                own = lists[i].values
                s, n = (own.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
                at = np.repeat(s, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                prefix = tb.prefix_hash(data[offs[i]:offs[i + 1]])
                h = tb.span_hash(prefix, at, at + r.length)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), ids[i], np.int64)), pa.array(at), pa.array(h.view(np.int64))],
                                                 names=["uid", "s", "h"])
    return run


def repeated_runs(d: DataFrame, r: Repeats) -> tuple[DataFrame, list[DataFrame]]:
    """(uid, s, n): runs of n consecutive starts whose strings also start earlier; the written tables behind it."""
    all_ = cut(d.select("uid", "text").mapInArrow(give_back(_anchor_rows(r)), ANCHOR), "sd-anchors")
    # 1: q-gram buckets of two or more suffixes
    buckets = cut(all_.groupBy("gram").agg(F.count(F.lit(1)).alias("k"), F.min("reach").alias("lo"), F.max("reach").alias("hi"))
                  .where("k > 1").select("gram", (F.col("lo") != F.col("hi")).alias("open")), "sd-buckets")
    rows = cut(all_.join(buckets, "gram").drop("gram"), "sd-rows")
    drop(all_, buckets)
    # 2: sub-buckets of equal reach
    first = cut(rows.groupBy("reach").agg(F.min(F.struct("uid", "s", "n", "nl", "lh", "rh", "open")).alias("f")), "sd-first")
    whole = (rows.join(first.select("reach", F.col("f.uid").alias("fu"), F.col("f.s").alias("fs")), "reach")
             .where("uid != fu or s != fs").select("uid", "s", F.col("n").cast("long").alias("n")))
    # 3: first suffixes in buckets with several sub-buckets, by q-gram and longer side
    f = first.where("f.open").select("f.*")
    halves = f.select("uid", F.explode(F.array(
        F.struct("s", F.col("nl").cast("int").alias("n"), F.xxhash64(F.lit(1), "lh").alias("side")),
        F.struct((F.col("s") + F.col("nl")).alias("s"), (F.col("n") - F.col("nl")).cast("int").alias("n"), F.xxhash64(F.lit(2), "rh").alias("side")))
    ).alias("x")).select("uid", "x.*").where("n > 0")
    halves = cut(halves, "sd-halves")
    shared = cut(halves.groupBy("side").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("side"), "sd-shared")
    lists = halves.join(shared, "side").groupBy("uid").agg(F.collect_list(F.struct("s", "n")).alias("own"))
    starts = cut(d.join(lists, "uid").select("uid", "text", "own").mapInArrow(give_back(_start_rows(r)), "uid long, s long, h long"), "sd-starts")
    drop(halves, shared)
    early = cut(starts.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct("uid", "s")).alias("f")).where("k > 1")
                .select("h", F.col("f.uid").alias("fu"), F.col("f.s").alias("fs")), "sd-early")
    single = starts.join(early, "h").where("uid != fu or s != fs").select("uid", "s", F.lit(1).cast("long").alias("n"))
    return whole.unionByName(single), [rows, first, starts, early]


def _covered(own: pa.Array | None, length: int) -> list[tuple[int, int]]:
    """Merged byte spans of runs of starts."""
    if own is None or not len(own):
        return []
    s, n = (own.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
    order = np.argsort(s, kind="stable")
    s, e = s[order], (s + n - 1 + length)[order]
    top = np.maximum.accumulate(e)
    new = np.concatenate([[True], s[1:] > top[:-1]])
    i = np.flatnonzero(new)
    last = np.concatenate([i[1:], [len(s)]]) - 1
    return list(zip(s[i].tolist(), top[last].tolist(), strict=True))


def _digests(length: int):
    def run(batches):
        for batch in batches:
            data, offs = tb.binary(batch.column(1))
            out = []
            for i in range(batch.num_rows):
                t = data[offs[i]:offs[i + 1]]
                own = batch.column(2)[i]
                spans = _covered(own.values if own.is_valid else None, length)
                sha, at = hashlib.sha256(), 0
                for s, e in spans:
                    sha.update(t[at:s])
                    at = e
                sha.update(t[at:])
                out.append((len(t), sum(e - s for s, e in spans), len(spans), sha.hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([o[k] for o in out], t) for k, t in enumerate(kinds))],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def _strip(length: int):
    def run(batches):
        for batch in batches:
            data, offs = tb.binary(batch.column(1))
            valid = batch.column(1).is_valid().to_pylist()
            out = []
            for i in range(batch.num_rows):
                t = data[offs[i]:offs[i + 1]]
                own = batch.column(2)[i]
                keep = np.ones(len(t), bool)
                for s, e in _covered(own.values if own.is_valid else None, length):
                    keep[s:e] = False
                if not keep.all():
                    # a code point that is cut by a span's edge stays whole
                    lead = np.flatnonzero((t & 0xC0) != 0x80)
                    keep = np.repeat(np.maximum.reduceat(keep, lead), np.diff(np.concatenate([lead, [len(t)]])))
                out.append(t[keep].tobytes().decode("utf-8", "replace") if valid[i] else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["uid", "text"])
    return run


def _with_runs(d: DataFrame, runs: DataFrame) -> DataFrame:
    lists = runs.groupBy("uid").agg(F.collect_list(F.struct("s", "n")).alias("own"))
    return d.join(lists, "uid", "left")


def repeat_digests(docs: DataFrame, r: Repeats = Repeats(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per document. A written table."""
    tune(docs.sparkSession)
    d, own = unique_ids(only(docs, **{"doc_id": id_col, "text": text}), "doc_id", "text")
    runs, tables = repeated_runs(d.select("uid", "text"), r)
    out = cut(_with_runs(d, runs).select("doc_id", "text", "own").mapInArrow(
        give_back(_digests(r.length)), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), "sd-result")
    drop(own, *tables)
    return out


def remove_repeats(docs: DataFrame, r: Repeats = Repeats()) -> DataFrame:
    """The documents without their repeated bytes; columns and types of the input.

    Spans are narrowed to whole code points, so the text stays valid; a text
    that repeats as a whole becomes empty.  ``n_chars`` follows the text where
    the input has it as an integer.
    """
    tune(docs.sparkSession)
    cols = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(cols))])
    i_id, i_text = f"c{cols.index('doc_id')}", f"c{cols.index('text')}"
    d, own = unique_ids(inner, i_id, i_text)
    runs, tables = repeated_runs(d.select("uid", F.col(i_text).alias("text")), r)
    lists = cut(runs.groupBy("uid").agg(F.collect_list(F.struct("s", "n")).alias("own")), "sd-lists")
    new = cut(d.join(lists, "uid").select("uid", F.col(i_text).alias("text"), "own").mapInArrow(
        give_back(_strip(r.length)), "uid long, text string"), "sd-new")
    drop(*tables, lists)
    j = d.join(new.select("uid", F.col("text").alias("_text"), F.lit(True).alias("_new")), "uid", "left")
    out = []
    for k, (c, f) in enumerate(zip(cols, docs.schema.fields, strict=True)):
        v = F.col(f"c{k}")
        if c == "text":
            v = F.when(F.col("_new"), F.col("_text")).otherwise(v)
        elif c == "n_chars" and f.dataType.simpleString() in ("int", "bigint"):
            v = F.when(F.col("_new"), F.char_length("_text")).otherwise(v).cast(f.dataType)
        out.append(v.alias(c))
    return j.select(*out)
