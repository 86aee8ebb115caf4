"""Distributed order: range-sorted tables with running sums, and unique ids that follow an order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop


def _running(n_group: int, n_size: int, schema: pa.Schema):
    """Running sum of the size column within a task, restarted where the group changes."""
    def run(batches):
        last, total = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column(n_size).to_numpy(zero_copy_only=False).astype(np.int64)
            group = batch.column(n_group).to_pylist()
            before = np.zeros(len(size), np.int64)
            cum = np.concatenate([[0], np.cumsum(size)])
            new = [i for i in range(len(group)) if group[i] != (group[i - 1] if i else last)]
            bounds = ([] if new and new[0] == 0 else [0]) + new + [len(group)]
            for a, b in zip(bounds, bounds[1:], strict=False):
                base = total if a == 0 and not (new and new[0] == 0) else 0
                before[a:b] = cum[a:b] - cum[a] + base
                total = base + int(cum[b] - cum[a])
            last = group[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], schema=schema)
    return run


def prefix_sums(df: DataFrame, group: str, order: list, size: str, name: str, parts: int | None = None) -> DataFrame:
    """``df`` plus ``before`` (long): the sum of ``size`` over all rows that come earlier in the group.

    The rows are range-sorted by (group, order); each task adds up its own
    rows, and only one total per task and group is summed across tasks.  A
    written table.  ``order`` must tell rows apart for reruns to agree.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StructField, StructType
    keys = [F.col(group).asc_nulls_last(), *order]
    sorted_ = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    schema = StructType([*df.schema.fields, StructField("local_before", LongType())])
    cols = df.columns
    run = _running(cols.index(group), cols.index(size), to_arrow_schema(schema))
    local = cut(sorted_.sortWithinPartitions(*keys).mapInArrow(run, schema).withColumn("pid", F.spark_partition_id()), f"{name}-local")
    from pyspark.sql.window import Window
    per = local.groupBy(group, "pid").agg(F.sum(size).alias("s"))
    per = per.withColumn("offset", F.coalesce(F.sum("s").over(Window.partitionBy(group).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    per = per.select(F.col(group).alias("_g"), F.col("pid").alias("_pid"), "offset")
    out = (local.join(per, (F.col(group).eqNullSafe(F.col("_g"))) & (F.col("pid") == F.col("_pid")))
           .withColumn("before", F.col("local_before") + F.col("offset")).select(*cols, "before"))
    out = cut(out, name)
    drop(local)
    return out


def unique_ids(d: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame | None]:
    """(``d`` with a column uid; a written table behind it or None).

    uid follows the order of the ids.  It is the id itself where ids are
    unique and not null; else rows are numbered by (id, null last, text), so
    rows that repeat an id are documents of their own.
    """
    ids = d.select(F.col(id_col).cast("long").alias("i"))
    odd = ids.groupBy("i").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or i is null").limit(1).count()
    if not odd:
        return d.withColumn("uid", F.col(id_col).cast("long")), None
    one = d.withColumn("g", F.lit(0)).withColumn("one", F.lit(1).cast("long"))
    t = prefix_sums(one, "g", [F.col(id_col).cast("long").asc_nulls_last(), F.col(text).asc_nulls_last()], "one", "uid")
    return t.withColumnRenamed("before", "uid").drop("g", "one"), t
