"""Connected components of an edge table by alternating large and small stars.

Everything stays in distributed tables.  A node's least neighbour is
aggregated map-side and written before it is joined back, so the join reads
two plain shuffles and AQE can split the rows of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop


def _least(pairs: DataFrame, name: str, **more) -> DataFrame:
    """The least of every u and its neighbours, aggregated map-side and written."""
    return cut(pairs.groupBy("u").agg(F.min("v").alias("m"), *[c.alias(k) for k, c in more.items()]).withColumn("m", F.least("u", "m")), name)


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 40) -> DataFrame:
    """(node, component): the least node reachable, for every node that has an edge to another node.

    Settled once every edge leads from a node that has no other edge to one
    that is no edge's greater end; the table of least neighbours, which the
    next round needs anyway, tells it.
    """
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v"), "cc-edges")
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # another edge than that to the least neighbour, and whether a smaller neighbour has greater ones beside it
        l1 = _least(both, "cc-least", low=F.min(F.when(F.col("v") < F.col("u"), F.col("v"))),
                    top=F.max(F.when(F.col("v") < F.col("u"), F.col("v"))), up=F.max(F.when(F.col("v") > F.col("u"), F.col("v"))))
        if l1.where("low is not null and (low != top or up is not null)").isEmpty():
            drop(e)
            out = l1.select(F.col("u").alias("node"), F.col("m").alias("component"))
            out._cut_path = l1._cut_path
            return out
        large = both.join(l1.select("u", "m"), "u")
        f = cut(large.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        l2 = _least(f, "cc-least")
        small = f.join(l2, "u")
        g = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        g = cut(g.select("e.u", "e.v").where("u > v").distinct(), "cc-small")
        drop(e, f, l1, l2)
        e = g
    raise RuntimeError(f"components did not settle in {rounds} rounds")
