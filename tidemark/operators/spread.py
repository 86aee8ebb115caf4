"""Windows and quantiles over series too long for one task.

A series of any length, or all rows as one series, is range-sorted over many
tasks and every row gets its global place (rows of a task, plus the counts of
the tasks before it).  Places are cut into blocks of ``block`` rows; a frame
of n rows needs the n-1 rows before a block, so those are sent to it as well
(its halo) and the frame is run per block.  Quantiles find the task that
holds a rank from the counts alone and look at that task's values only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import ensure_checkpoint_dir

PLACE, BLOCK, TASK = "_place", "_block", "_task"


def ranged(df: DataFrame, order: Sequence[Column | str], tasks: int | None = None) -> DataFrame:
    """``df`` range-sorted by ``order``, with the number of its task; cut by a reliable checkpoint, so the numbers stay."""
    ensure_checkpoint_dir(df.sparkSession)
    dealt = df.repartitionByRange(tasks, *order) if tasks else df.repartitionByRange(*order)
    return dealt.withColumn(TASK, F.spark_partition_id()).checkpoint(eager=True)


def placed(df: DataFrame, order: Sequence[Column | str], tasks: int | None = None) -> DataFrame:
    """``df`` plus its place (from 0) in the order of all rows; ``order`` should tell rows apart."""
    spark = df.sparkSession
    r = ranged(df, order, tasks)
    before, offsets = 0, []
    for t, n in sorted(r.groupBy(TASK).count().collect()):  # a row per task
        offsets.append((t, before))
        before += n
    at = spark.createDataFrame(offsets, StructType([StructField("_t", LongType()), StructField("_before", LongType())]))
    own = F.row_number().over(Window.partitionBy(TASK).orderBy(*order)) - 1
    return (r.withColumn("_own", own).join(at, F.col(TASK) == F.col("_t")).withColumn(PLACE, F.col("_own") + F.col("_before"))
            .drop("_own", "_t", "_before", TASK))


def with_halo(df: DataFrame, order: Sequence[Column | str], rows: int, build: Mapping[str, Callable[[WindowSpec], Column]],
              keys: Sequence[str] = (), block: int = 100_000, tasks: int | None = None) -> DataFrame:
    """Window columns over the ``rows`` rows before each row and itself, for series of any length.

    ``build`` names columns and makes each from a window spec ordered within a
    series; frames must not reach further back than ``rows`` rows, nor forward.
    ``order`` is the order within a series.  Equal to the plain window over
    ``keys`` (none: all rows are one series), without a task that sees more
    than ``block`` + ``rows`` rows of it.
    """
    p = placed(df, [*[F.col(k) for k in keys], *order], tasks)
    own = F.floor(F.col(PLACE) / block)
    near = p.withColumn(BLOCK, F.explode(F.sequence(own, F.floor((F.col(PLACE) + rows) / block))))
    w = Window.partitionBy(BLOCK, *keys).orderBy(PLACE)
    out = near.withColumns({name: make(w) for name, make in build.items()})
    return out.where(F.col(BLOCK) == own).drop(BLOCK, PLACE)


def rolling_avg(df: DataFrame, value: str, n: int, order: Sequence[Column | str], keys: Sequence[str] = (), name: str = "rolling_avg", **kw) -> DataFrame:
    """Mean of the last n rows (W5) of series of any length."""
    return with_halo(df, order, n, {name: lambda w: F.avg(F.col(value)).over(w.rowsBetween(1 - n, 0))}, keys, **kw)


def rolling_corr(df: DataFrame, x: str, y: str, n: int, order: Sequence[Column | str], keys: Sequence[str] = (), name: str = "rolling_corr", **kw) -> DataFrame:
    """Correlation over the last n rows (W7) of series of any length; constant frames give null."""
    from ..functions.series import rolling_corr as corr
    return with_halo(df, order, n, {name: lambda w: corr(F.col(x), F.col(y), w, n)}, keys, **kw)


def spike(df: DataFrame, value: str, pct: float, order: Sequence[Column | str], keys: Sequence[str] = (), **kw) -> DataFrame:
    """Rows whose change against the previous non-null row exceeds ``pct`` per cent (Q8, W10), for series of any length."""
    x = F.col(value).cast("double")
    s = with_halo(df.where(F.col(value).isNotNull()), order, 1, {"prev_value": lambda w: F.lag(x).over(w)}, keys, **kw)
    change = F.abs(F.try_divide(x - F.col("prev_value"), F.col("prev_value")) * 100.0)
    return s.withColumn("change_pct", change).where(F.col("prev_value").isNotNull() & (F.col("change_pct") > pct))


def quantiles(df: DataFrame, value: str, shares: Mapping[str, float], keys: Sequence[str] = (), tasks: int | None = None) -> DataFrame:
    """Exact quantiles per key (the lower order statistic), a key with most of the rows spread over tasks.

    Equal values are counted before the shuffle; the counts per task and key
    tell which task holds a rank, and only its values are summed up.  Null
    values don't count; a key without values has no row.
    """
    k = list(keys)
    per = df.where(F.col(value).isNotNull()).groupBy(*k, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    r = ranged(per, [*[F.col(c) for c in k], F.col("_v")], tasks)
    sums = r.groupBy(*k, TASK).agg(F.sum("_c").alias("_s"))
    ahead = Window.partitionBy(*k, F.lit(0)).orderBy(TASK).rowsBetween(Window.unboundedPreceding, -1)  # a row per task and key
    everything = Window.partitionBy(*k, F.lit(0))
    sums = sums.withColumns({"_before": F.coalesce(F.sum("_s").over(ahead), F.lit(0)), "_n": F.sum("_s").over(everything)})
    rank = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.greatest(F.ceil(F.col("_n") * q), F.lit(1)).alias("rank")) for n, q in shares.items()]))
    want = sums.withColumn("_w", rank).where((F.col("_w.rank") > F.col("_before")) & (F.col("_w.rank") <= F.col("_before") + F.col("_s")))
    names = {c: f"_k{i}" for i, c in enumerate(k)}
    want = want.select(*[F.col(c).alias(n) for c, n in names.items()], F.col(TASK).alias("_t"), "_before", "_w")
    same = F.col(TASK) == F.col("_t")
    for c, n in names.items():
        same = same & F.col(c).eqNullSafe(F.col(n))
    # the tasks that hold a rank, each summed up once
    hot = r.join(want.select(*names.values(), "_t").distinct(), same, "left_semi")
    cum = hot.withColumn("_to", F.sum("_c").over(Window.partitionBy(*k, TASK).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)))
    found = cum.join(want, same).where(F.col("_before") + F.col("_to") >= F.col("_w.rank"))
    return found.groupBy(*k).agg(*[F.min(F.when(F.col("_w.name") == n, F.col("_v"))).alias(n) for n in shares])
