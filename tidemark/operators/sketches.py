"""Drift of whole distributions by mergeable quantile sketches.

A run keeps one KLL sketch per series and day in the baseline table.  Any
look-back is the merge of its days' sketches, without the raw rows, and two
runs are compared by the greatest difference of their distribution functions
(the Kolmogorov-Smirnov distance), so a shift that keeps mean and deviation
is seen as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRID = 128


def daily_sketches(df: DataFrame, value: str, keys: Sequence[str] = ("series_id",), date: str = "observation_date", k: int = 400) -> DataFrame:
    """(keys, day, n, sketch): a sketch per series and day, built map-side; null values don't count."""
    v = F.col(value).cast("double")
    return (df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, F.col(date).cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(v, k).alias("sketch")))


def lookback(sketches: DataFrame, first: str, last: str, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """(keys, n, sketch) of the days from ``first`` to ``last``, ends included."""
    days = sketches.where((F.col("day") >= F.lit(first).cast("date")) & (F.col("day") <= F.lit(last).cast("date")))
    return days.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def distribution_drift(current: DataFrame, previous: DataFrame, keys: Sequence[str] = ("series_id",), most: float = 0.1) -> DataFrame:
    """(keys, n, n_previous, distance, median, median_previous, status) between two look-backs.

    distance: the greatest difference of the two distribution functions, both
    read off ``GRID`` quantiles (a step of 1 / ``GRID`` is its resolution).  status: ``drift`` above ``most``, ``stable``
    up to it, ``missing`` where one side has no values.
    """
    b = previous.select(*[F.col(c).alias(f"_p_{c}") for c in keys], F.col("n").alias("n_previous"), F.col("sketch").alias("_b"))
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    j = current.withColumnRenamed("sketch", "_a").join(b, same, "full")
    shares = F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)])
    j = j.withColumns({f"_q{c}": F.kll_sketch_get_quantile_double(c, shares) for c in ("_a", "_b")})
    share = lambda q, x: F.size(F.filter(q, lambda y: y <= x)) / GRID
    gap = F.array_max(F.transform(F.array_distinct(F.concat("_q_a", "_q_b")), lambda x: F.abs(share("_q_a", x) - share("_q_b", x))))
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    named = [F.coalesce(F.col(c), F.col(f"_p_{c}")).alias(c) for c in keys]
    half = F.lit(0.5)
    out = j.select(*named, "n", "n_previous", F.when(both, gap).alias("distance"),
                   F.when(F.col("_a").isNotNull(), F.kll_sketch_get_quantile_double("_a", half)).alias("median"),
                   F.when(F.col("_b").isNotNull(), F.kll_sketch_get_quantile_double("_b", half)).alias("median_previous"))
    return out.withColumn("status", F.when(F.col("distance").isNull(), "missing").when(F.col("distance") > most, "drift").otherwise("stable"))
