"""Phrase collocation mining (13): dynamic itemset counting over cyclic shard scans.

The corpus is dealt to ``shards`` once; step t scans shard t modulo ``shards``.
Words are counted from the first step on.  A longer phrase becomes active at
the first step at which both of its subphrases (without its last, without its
first word) have reached ``least`` in what was scanned so far, is then counted
in every shard for one full cycle, and is complete.  Lengths interleave: pairs
are counted while words still are.  Steps go on until a full cycle has passed
since the last phrase reached the threshold, so every count is exact.

Which phrases have reached the threshold, and when, is sent to tasks as a
filter of ``cells`` bytes (a fixed bound, whatever the corpus): a cell holds
the first step of the phrases that hash to it, a phrase's step is the greatest
of its ``probes`` cells.  A cell is written once and never changes, so a false
hit only counts a phrase needlessly or from an earlier step on, over a full
cycle all the same.  Tasks compare words as strings and phrases as pairs of
subphrases (no hash decides), add up within a batch, and Spark adds up the
rest by the phrase itself, with partial aggregates before the shuffle.

Defined cases: null or empty text: no words.  A null lang counts as ``und``.
Texts are worked off whole, in stretches cut at piece separators.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path
from . import textbytes as tb
from .common import CLEAN, _set, cut, delete_path, drop, only, tune

U = np.uint64
#: bytes by kind: 0 word, 1 blank, 2 piece separator
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("act", pa.int32()), ("cnt", pa.int64())])
COUNTS_SQL = "lang string, phrase string, size int, act int, cnt long"


@dataclass(frozen=True)
class Mining:
    """Parameters of the mining."""
    least: int = 100
    longest: int = 5
    top: int = 2000          # phrases reported per lang
    shards: int = 3
    cells: int = 1 << 24     # bytes of the filter that tasks get
    probes: int = 3
    stretch: int = 6 << 20   # bytes of text worked off at a time: a task holds about 30 times as much


# --- words and hashes ------------------------------------------------------------------------

def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _word_hashes(words: pa.Array, seeds: np.ndarray) -> np.ndarray:
    """Hashes of words in their languages."""
    data, offs = tb.binary(words)
    lo = offs[0] if len(offs) else 0
    return tb.mix(tb.span_hash(tb.prefix_hash(data[lo:offs[-1]]), offs[:-1] - lo, offs[1:] - lo) + seeds)


def _longer(prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of the phrase without its last word, and that word's."""
    return tb.mix(prefix * U(0x9FB21C651E98DF25) + last)


def _places(h: np.ndarray, p: Mining) -> list[np.ndarray]:
    return [(tb.mix(h + U(i)) % U(p.cells)).astype(np.int64) for i in range(1, p.probes + 1)]


def _reached(filter_: np.ndarray, h: np.ndarray, p: Mining) -> np.ndarray:
    """Step from which the phrases count as known, 0 if they don't."""
    v = [filter_[x] for x in _places(h, p)]
    return np.where(np.minimum.reduce(v) > 0, np.maximum.reduce(v), 0).astype(np.int64)


def _stretches(data: np.ndarray, offs: np.ndarray, most: int):
    """(bytes, offsets, rows) of about ``most`` bytes; a longer text is cut after piece separators."""
    for a, b in tb.chunks(offs, most):
        lo, hi = int(offs[a]), int(offs[b])
        if b - a > 1 or hi - lo <= most:
            yield data[lo:hi], offs[a:b + 1] - lo, np.arange(a, b)
            continue
        while lo < hi:
            end = min(lo + most, hi)
            while end < hi:
                found = np.flatnonzero(KIND[data[lo:end]] == 2)
                if len(found):
                    end = lo + int(found[-1]) + 1
                    break
                end = min(end + most, hi)
            yield data[lo:end], np.array([0, end - lo]), np.array([a])
            lo = end


def _split(buf: np.ndarray, offs: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, whether a word begins a piece, row of each word)."""
    kind = KIND[buf]
    inside = kind == 0
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    filled = offs[1:] > offs[:-1]
    start[offs[:-1][filled]] = inside[offs[:-1][filled]]
    end[offs[1:][filled] - 1] = inside[offs[1:][filled] - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    del start, end
    row = np.searchsorted(offs, s, "right") - 1
    seps = np.cumsum(kind == 2, dtype=np.int32)[s] if len(s) else np.zeros(0, np.int32)
    fresh = np.ones(len(s), bool)
    fresh[1:] = (seps[1:] != seps[:-1]) | (row[1:] != row[:-1])
    ends = np.concatenate([[0], np.cumsum(e - s)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(s), pa.py_buffer(ends), pa.py_buffer(tb.LOWER[buf[inside]]))
    return words, fresh, row


# --- one scan ------------------------------------------------------------------------------------

def _count(data: np.ndarray, offs: np.ndarray, lang: np.ndarray, langs: list[str], filter_: np.ndarray, step: int, p: Mining):
    """Counts of the active phrases of a stretch, a record batch per length."""
    words, fresh, row = _split(data, offs)
    if not len(words):
        return
    coded = words.dictionary_encode()
    which, word = lang[row], coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    cur, uniq = pd.factorize(word * len(langs) + which)
    seeds = np.array([_seed(x) for x in langs], U)
    names, texts = pa.array(langs, pa.string()), coded.dictionary

    def batch(size: int, at: np.ndarray, act: np.ndarray, cnt: np.ndarray) -> pa.RecordBatch:
        parts = [texts.take(pa.array(word[at + j])) for j in range(size)]
        phrase = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, " ")
        return pa.RecordBatch.from_arrays([names.take(pa.array(which[at])), phrase, pa.array(np.full(len(at), size, np.int32)),
                                           pa.array(act.astype(np.int32)), pa.array(cnt)], schema=COUNTS)
    if step < p.shards:
        at = np.zeros(len(uniq), np.int64)
        at[cur[::-1]] = np.arange(len(cur))[::-1]
        yield batch(1, at, np.zeros(len(uniq)), np.bincount(cur, minlength=len(uniq)))
    word_hash = _word_hashes(texts.take(pa.array(uniq // len(langs))), seeds[uniq % len(langs)])
    wid, h = cur, word_hash
    r = _reached(filter_, h, p)
    known = np.where(r > 0, np.maximum(r, 1), 0)          # step from which a phrase is a subphrase that counts, by local id
    at, ids = np.flatnonzero(known[cur] > 0), cur           # places of known phrases
    ids = ids[at]
    for size in range(2, p.longest + 1):
        # a phrase where two known ones of one word less overlap, within a piece
        last = at[:-1] + size - 1
        m = np.flatnonzero((at[1:] == at[:-1] + 1) & ~fresh[np.minimum(last, len(fresh) - 1)] & (last < len(fresh)))
        if not len(m):
            return
        a, b = ids[m], ids[m + 1]
        code, pair = pd.factorize(a * len(h) + b)
        pre, suf = pair // len(h), pair % len(h)
        act = np.maximum(known[pre], known[suf])
        first = np.zeros(len(pair), np.int64)
        first[code[::-1]] = at[m][::-1]
        live = act > step - p.shards
        if live.any():
            yield batch(size, first[live], act[live], np.bincount(code, minlength=len(pair))[live])
        h = _longer(h[pre], word_hash[wid[first + size - 1]])
        r = _reached(filter_, h, p)
        known = np.where((r > 0) & (act + 1 <= step), np.maximum(r, act + 1), 0)
        keep = known[code] > 0
        at, ids = at[m][keep], code[keep]


def _scan(packed: bytes, step: int, p: Mining):
    def run(batches):
        filter_ = np.frombuffer(zlib.decompress(packed), np.uint8)
        held, size = [], 0

        def flush():
            t = pa.Table.from_batches(held).combine_chunks()
            coded = pc.fill_null(t.column(0), "und").dictionary_encode().combine_chunks()
            lang, langs = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
            for buf, offs, rows in _stretches(*tb.binary(t.column(1)), p.stretch):
                yield from _count(buf, offs, lang[rows], langs, filter_, step, p)
        for b in batches:
            held.append(b)
            size += b.nbytes
            if size >= p.stretch:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()
    return run


def _cells(p: Mining):
    """Cells of the filter that phrases take."""
    def run(batches):
        for b in batches:
            phrases, langs = b.column(1), b.column(0).to_pylist()
            out = []
            if len(phrases):
                parts = pc.split_pattern(phrases, " ")
                offs, words = np.asarray(parts.offsets), parts.flatten()
                n = np.diff(offs)
                seeds = np.array([_seed(x) for x in langs], U)
                hw = _word_hashes(words, np.repeat(seeds, n))
                h = hw[offs[:-1] - offs[0]]
                for j in range(1, int(n.max())):
                    more = np.flatnonzero(n > j)
                    h[more] = _longer(h[more], hw[offs[:-1][more] - offs[0] + j])
                out = np.concatenate(_places(h, p)) + 1  # Spark's bitmaps count from 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["cell"])
    return run


def _mark(filter_: np.ndarray, rows: DataFrame, step: int, p: Mining) -> None:
    """Write ``step`` to the empty cells of the phrases of ``rows``; at most ``cells`` / 8 bytes come to the driver."""
    cells = rows.select("lang", "phrase").mapInArrow(_cells(p), "cell long")
    bits = cells.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    for r in bits.collect():
        on = np.flatnonzero(np.unpackbits(np.frombuffer(r.bits, np.uint8), bitorder="little")) + (r.bucket - 1) * 32768
        filter_[on[filter_[on] == 0]] = step


# --- operator ------------------------------------------------------------------------------------

def frequent(docs: DataFrame, p: Mining = Mining(), text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, cnt) of all phrases of 1 to ``longest`` words with ``least`` occurrences or more,
    and (lang, n), the words of each lang. Written tables."""
    spark = docs.sparkSession
    tune(spark)
    folder = shared_path(spark, f"ph-shards-{uuid.uuid4().hex}")
    d = only(docs, lang=lang, text=text).where("text is not null and text != ''")
    with _set(spark, CLEAN | {"spark.sql.maxConcurrentOutputFileWriters": str(p.shards)}):
        d.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(p.shards)).cast("int")).write.partitionBy("shard").parquet(folder)
    shards = spark.read.schema("lang string, text string, shard int").parquet(folder)
    filter_ = np.zeros(p.cells, np.uint8)
    state, totals, step, last = None, None, 0, {0: -1}  # last: the last step at which phrases of a size reached the threshold

    def counting() -> bool:
        """Whether phrases of some size may still be within their cycle: one after the last phrase of one word less."""
        return any(step <= last.get(k - 1, -1 - p.shards) + p.shards for k in range(1, p.longest + 1))
    while counting():
        now = (shards.where(F.col("shard") == step % p.shards).select("lang", "text")
               .mapInArrow(_scan(zlib.compress(filter_.tobytes(), 1), step, p), COUNTS_SQL).withColumn("old", F.lit(0).cast("long")))
        if state is not None:  # what is complete and below the threshold goes
            now = now.unionByName(state.where((F.col("act") > step - p.shards) | (F.col("cnt") >= p.least)).withColumn("old", F.col("cnt")))
        new = cut(now.groupBy("lang", "phrase", "size", "act").agg(F.sum("cnt").alias("cnt"), F.sum("old").alias("old")), "ph-state")
        drop(state)
        state = new
        if step == p.shards - 1:
            totals = cut(state.where("size = 1").groupBy("lang").agg(F.sum("cnt").alias("n")), "ph-totals")
        reached = state.where((F.col("cnt") >= p.least) & (F.col("old") < p.least) & (F.col("size") < p.longest))
        _mark(filter_, reached, step + 1, p)
        for r in reached.groupBy("size").count().collect():
            last[r["size"]] = step
        step += 1
    out = cut(state.where(F.col("cnt") >= p.least).select("lang", "phrase", "size", "cnt"), "ph-frequent")
    drop(state)
    delete_path(spark, folder)
    return out, totals


def collocations(docs: DataFrame, p: Mining = Mining(), text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each lang. A written table.

    score: floor(1000 a n / (l r)) at the cut with the least score, ties to the
    shortest first part.  A phrase that lies in a longer one as frequent as
    itself is left out; if any longer one is, so is one of one word more.
    """
    f, totals = frequent(docs, p, text, lang)
    whole = f.where("size > 1")
    w = F.split("phrase", " ")
    part = lambda start, n: F.array_join(F.slice(w, start, n), " ")
    k = F.col("k")
    cuts = (whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .select("lang", "phrase", F.col("cnt").alias("a"), "k", part(F.lit(1), k).alias("first"), part(k + 1, F.col("size") - k).alias("rest")))
    one = lambda name, v: f.select(F.col("lang"), F.col("phrase").alias(name), F.col("cnt").alias(v))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    scored = cuts.join(one("first", "l"), ["lang", "first"]).join(one("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    scored = scored.withColumn("num", (wide("a") * wide("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")).withColumn("den", wide("l") * wide("r"))
    scored = scored.withColumn("score", F.expr("num div den"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("b"))
    inner = (f.where("size > 2").select("lang", F.explode(F.array(part(F.lit(1), F.col("size") - 1), part(F.lit(2), F.col("size") - 1))).alias("phrase"), "cnt")
             .groupBy("lang", "phrase").agg(F.max("cnt").alias("over")))
    left = best.join(inner, ["lang", "phrase"], "left").where(F.col("over").isNull() | (F.col("over") < F.col("b.a")))
    flat = left.select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    out = cut(flat.withColumn("rank", rank).where(F.col("rank") <= p.top)
              .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "ph-result")
    drop(f, totals)
    return out


SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents),
p AS (SELECT lang, unnest(pieces) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
h AS (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS size FROM g),
f AS (SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, size, count(*) AS cnt FROM h GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, phrase, size, cnt AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM f WHERE size > 1),
s AS (
  SELECT c.lang, c.phrase, c.a, l.cnt AS l, r.cnt AS r, n.n, c.k,
         ((1000::HUGEINT * c.a * n.n) // (l.cnt::HUGEINT * r.cnt))::BIGINT AS score
  FROM c JOIN n USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, string_split(phrase, ' ') AS w, size, cnt FROM f WHERE size > 2),
j AS (SELECT lang, w, size, cnt, unnest(range(2, size)) AS m FROM i),
o AS (SELECT lang, w, m, cnt, unnest(range(1, size - m + 2)) AS pos FROM j),
over_ AS (SELECT lang, array_to_string(w[pos:pos + m - 1], ' ') AS phrase, max(cnt) AS most FROM o GROUP BY ALL),
kept AS (SELECT b.* FROM b LEFT JOIN over_ USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
