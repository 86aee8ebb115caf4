"""Mixing sources to target weights (6).

Sources get weights by their place in code-point order (null last), share a
budget by weight, and stop at a multiple of their own size, the excess being
shared again.  Documents get hash-random keys and are range-sorted within
their source; distributed prefix sums of the sizes give every document its
interval on the source's line, and the line is cut at the source's exact
target: whole epochs first, then the part of one more.

Defined cases: null or wordless text has size 0 and is taken 0 words; a source
of size 0 has target 0; rows that repeat are documents of their own (rows
equal in id, source and text may swap places, their multiset of results
stays); a null id is a value like any other; an empty table gives no rows.
The table of sources has one row per source and is the only thing summed in
one place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, only
from .order import prefix_sums, unique_ids

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    weights: tuple = (5.0, 2.0, 1.0)   # by place of the source, repeating
    budget: float = 1.5                # times all sizes
    most: float = 2.0                  # times its source's size that a target may be
    seed: int = 17


def targets(sizes: DataFrame, m: Mix = Mix()) -> DataFrame:
    """(source, source_size, target) from (source, source_size): shares by weight, stopped at the cap.

    In order of cap per unit of weight, a source is capped while the level
    that the rest would reach lies above it; the others share what is left.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in m.weights]),
                                           ((F.row_number().over(place) - 1) % len(m.weights) + 1).cast("int")))
    s = s.withColumn("cap", F.lit(float(m.most)) * F.col("source_size"))
    every = Window.partitionBy(F.lit(1))
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("total", F.least(F.lit(float(m.budget)), F.lit(float(m.most))) * F.sum("source_size").over(every))
         .withColumn("all_w", F.sum("w").over(every))
         .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    s = s.withColumn("capped", (F.col("total") - F.col("cap_before")) * F.col("w") >= F.col("cap") * (F.col("all_w") - F.col("w_before")))
    rest_w = F.sum(F.when(F.col("capped"), F.lit(0.0)).otherwise(F.col("w"))).over(every)
    rest = F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(F.lit(0.0))).over(every)
    level = F.try_divide(rest, rest_w)
    return s.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(level * F.col("w")).alias("target"))


def take(docs: DataFrame, m: Mix = Mix(), id_col: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """doc_id, source, size, source_size, target, epochs, part, taken per document. Lazy over a written table."""
    d = only(docs, **{"doc_id": id_col, "source": source, "text": text})
    items = d.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                     F.xxhash64(F.lit(m.seed), "doc_id").alias("key"), F.xxhash64("text").alias("tie"))
    line = prefix_sums(items, "source", ["key", F.col("doc_id").asc_nulls_last(), "tie"], "size", "mix")
    goal = targets(line.groupBy("source").agg(F.sum("size").alias("source_size")), m)
    goal = cut(goal.withColumnRenamed("source", "_source"), "mix-targets")
    j = line.join(goal, F.col("source").eqNullSafe(F.col("_source")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    j = j.withColumn("epochs", whole).withColumn("left", F.round("target").cast("long") - F.col("epochs") * F.col("source_size"))
    j = j.withColumn("part", F.greatest(F.lit(0).cast("long"), F.least("size", F.col("left") - F.col("before"))))
    return j.select("doc_id", "source", "size", "source_size", "target", "epochs", "part",
                    (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))


def mixed_documents(docs: DataFrame, m: Mix = Mix()) -> DataFrame:
    """The mix as rows of the input's columns: each document once per whole epoch, and once more if the cut
    leaves it at least half of its words (texts are never cut)."""
    cols = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(cols))])
    d, _ = unique_ids(inner, f"c{cols.index('doc_id')}", f"c{cols.index('text')}")
    t = take(d, m, "uid", f"c{cols.index('source')}", f"c{cols.index('text')}")
    # in a source's order the documents that come once more than all stand first (but for those without words):
    # the last of them tells, so texts are not shuffled to meet their counts
    again = (F.col("part") > 0) & (2 * F.col("part") >= F.col("size"))
    place = lambda uid: F.struct(F.xxhash64(F.lit(m.seed), uid).alias("key"), F.col(uid).alias("uid"))
    per = cut(t.groupBy(F.col("source").alias("_source")).agg(F.max("epochs").alias("_epochs"), F.max(F.when(again, place("doc_id"))).alias("_last")), "mix-last")
    j = d.join(per, F.col(f"c{cols.index('source')}").eqNullSafe(F.col("_source")))
    more = F.coalesce((place("uid") <= F.col("_last")) & F.col(f"c{cols.index('text')}").rlike(WORD), F.lit(False))
    j = j.withColumn("copies", F.col("_epochs") + more.cast("long")).where("copies > 0")
    j = j.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return j.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)])
