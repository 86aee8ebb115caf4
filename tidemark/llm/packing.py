"""Best-fit packing (8): vector best-fit of token pieces into training sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum
of squared lengths).  Pieces are dealt to shards by hash, and each shard packs
its own, longest first: among the open sequences that can take a piece under
every constraint, the one with the least weighted residual norm after placing
it (or the greatest weighted dot product of demand and residual) gets it.
What the shards leave half filled is dealt anew and packed again, until one
shard holds it or nothing is gained.

Defined cases: a null or empty text is one piece, the end id alone; a repeated
row is a document of its own; equal lengths are placed in hash order, so
reruns agree; an empty table gives no rows; extra columns never enter.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop, give_back, only, tune
from .tokens import MOST, encoder


@dataclass(frozen=True)
class Packing:
    tokens: int = 4096
    documents: int = 4096            # pieces in a sequence
    cost: float = 4096.0 ** 2        # sum of squared piece lengths
    weights: tuple = (1.0, 1e-6, 1e-6)
    score: str = "residual"          # or "dot"
    shard: int = 8192                # pieces in a shard, about
    well_filled: float = 0.995       # sequences below this share of the tokens are packed again
    rounds: int = 4
    held: int = MOST                 # parts of texts whose ids a worker keeps; memory and time only


def _pieces(name: str, end_id: int, size: int, with_ids: bool, held: int = MOST):
    def run(batches):
        enc = encoder(name, held)
        for batch in batches:
            doc, piece, start, length, crc, raw = [], [], [], [], [], []
            ids = batch.column(0).to_pylist()
            for i, got in enumerate(enc.encode(batch.column(1).to_pylist())):
                x = np.append(got.astype("<u4"), np.uint32(end_id)).astype("<u4")
                for k, a in enumerate(range(0, len(x), size)):
                    b = x[a:a + size].tobytes()
                    doc.append(ids[i])
                    piece.append(k)
                    start.append(a)
                    length.append(len(b) // 4)
                    crc.append(zlib.crc32(b))
                    raw.append(b if with_ids else None)
            cols = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(raw, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def pieces(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, p: Packing = Packing(),
           id_col: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32 (and the ids, little-endian unsigned 32-bit)."""
    tune(docs.sparkSession)
    d = only(docs, **{"doc_id": id_col, "text": text}).withColumn("doc_id", F.col("doc_id").cast("long"))
    return d.mapInArrow(give_back(_pieces(tokenizer, end_id, p.tokens, with_ids, p.held)),
                        "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else ""))


def best_fit(length: np.ndarray, p: Packing) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset, tokens in each sequence) of pieces already in placing order."""
    n = len(length)
    cap = np.array([p.tokens, p.documents, p.cost], float)
    weight = np.array(p.weights, float)
    need = np.stack([length, np.ones(n), length.astype(float) ** 2], axis=1) / cap
    if n and need.max() > 1:
        raise ValueError("a piece exceeds a capacity on its own")
    rest = np.ones((n, 3))             # residuals of the open sequences, packed to the front
    name = np.zeros(n, np.int64)       # their numbers
    fill = np.zeros(n, np.int64)
    seq, off = np.zeros(n, np.int64), np.zeros(n, np.int64)
    shortest = length.min() / p.tokens if n else 0
    used = made = 0
    eps = 1e-12
    for i in range(n):
        d = need[i]
        best = -1
        if used:
            r = rest[:used]
            ok = np.flatnonzero((r[:, 0] >= d[0] - eps) & (r[:, 1] >= d[1] - eps) & (r[:, 2] >= d[2] - eps))
            if len(ok):
                x = r[ok]
                best = ok[np.argmin(((x - d) ** 2) @ weight) if p.score == "residual" else np.argmax(x @ (weight * d))]
        if best < 0:
            best, used = used, used + 1
            rest[best], name[best] = 1.0, made
            made += 1
        j = name[best]
        seq[i], off[i] = j, fill[j]
        fill[j] += length[i]
        rest[best] -= d
        if rest[best, 0] < shortest - eps:  # nothing fits any more: close it
            used -= 1
            rest[best], name[best] = rest[used], name[used]
    return seq, off, fill[:made]


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, tie long, shard long, seq long, offset long, filled long"


def _pack(p: Packing):
    def run(table: pa.Table) -> pa.Table:
        length, tie = (table.column(c).to_numpy() for c in ("length", "tie"))
        order = np.lexsort((tie, -length))
        t = table.take(pa.array(order))
        seq, off, fill = best_fit(length[order], p)
        return (t.append_column("seq", pa.array(seq)).append_column("offset", pa.array(off))
                .append_column("filled", pa.array(fill[seq])))
    return run


def pack(rows: DataFrame, p: Packing = Packing()) -> DataFrame:
    """Pieces plus sequence_id and offset. A written table."""
    todo = rows.withColumn("tie", F.xxhash64("doc_id", "piece", "start", "ids_crc32"))
    todo = cut(todo, "pk-pieces")
    done, made, before = [], [todo], None
    for k in range(p.rounds):
        n = todo.count()
        shards = max(1, -(-n // p.shard))
        dealt = todo.withColumn("shard", F.pmod(F.xxhash64(F.lit(k), "tie"), F.lit(shards)))
        placed = cut(dealt.groupBy("shard").applyInArrow(_pack(p), PLACED), "pk-placed")
        made.append(placed)
        placed = placed.withColumn("round", F.lit(k))
        poor = F.col("filled") < p.well_filled * p.tokens
        if shards == 1 or k == p.rounds - 1 or n == before:
            done.append(placed)
            break
        done.append(placed.where(~poor))
        todo = placed.where(poor).select("doc_id", "piece", "start", "length", "ids_crc32", "tie")
        before = n
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    # numbers that name round, shard and place in it
    number = F.col("round") * F.lit(1 << 56) + F.col("shard") * F.lit(1 << 24) + F.col("seq")
    out = cut(out.select("doc_id", "piece", "start", "length", "ids_crc32", number.cast("long").alias("sequence_id"), "offset"), "pk-result")
    drop(*made)
    return out


def pack_documents(docs: DataFrame, p: Packing = Packing(), tokenizer: str = "word_bpe_49k.json", end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document."""
    return pack(pieces(docs, tokenizer, end_id, p), p)
