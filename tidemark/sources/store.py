"""The stored observation table: laid out by (bucket of series, year), upserts rewrite only what a batch touches.

A series' id stands in the files, never in a folder name, so ids such as
``007`` or ``1e3`` keep their text.  A folder holds one year of the series
that hash to one bucket: the number of folders does not grow with the number
of series, and a batch of one month rewrites one year.  A range that holds
many rows is written by several tasks, split by date (and, within a day, by
the key), so a series with a third of all rows spreads.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .observations import high_water_mark, table_exists, upsert

BUCKET, YEAR = "series_bucket", "obs_year"


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@dataclass(frozen=True)
class SeriesStore:
    """A table of observations under ``path``.

    series: columns that name a series; date: its observation date; seq: the
    column whose highest value wins among rows of equal (series, date).
    """
    path: str
    series: tuple[str, ...] = ("series_id",)
    date: str = "observation_date"
    seq: str = "seq"
    buckets: int = 64
    rows_per_file: int = 2_000_000

    @property
    def keys(self) -> tuple[str, ...]:
        return (*self.series, self.date)

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` with the columns of the layout."""
        return df.withColumns({BUCKET: F.pmod(F.xxhash64(*self.series), F.lit(self.buckets)).cast("int"), YEAR: F.year(self.date)})

    def exists(self, spark: SparkSession) -> bool:
        return table_exists(spark, self.path)

    def read(self, spark: SparkSession, layout: bool = False) -> DataFrame:
        df = spark.read.parquet(self.path)
        return df if layout else df.drop(BUCKET, YEAR)

    def series_rows(self, spark: SparkSession, *value) -> DataFrame:
        """The rows of one series: its bucket's folders only."""
        want = spark.range(1).select(*[F.lit(v).cast(t.dataType).alias(t.name) for v, t in zip(
            value, [f for f in self.read(spark).schema.fields if f.name in self.series], strict=True)])
        bucket = want.select(F.pmod(F.xxhash64(*self.series), F.lit(self.buckets)).cast("int")).first()[0]
        rows = self.read(spark, layout=True).where(F.col(BUCKET) == bucket)
        for c, v in zip(self.series, value, strict=True):
            rows = rows.where(F.col(c).eqNullSafe(F.lit(v)))
        return rows.drop(BUCKET, YEAR)

    def upsert(self, updates: DataFrame) -> DataFrame:
        """Insert or update by (series, date); the row of the highest ``seq`` wins. Returns the ranges written with their rows.

        Only the ranges (bucket, year) of the batch are read and rewritten.
        They are few, whatever the batch: buckets times its years.  The merged
        rows are written to the shared folder first and deleted afterwards.
        """
        spark = updates.sparkSession
        u = self.placed(updates)
        touched = u.select(BUCKET, YEAR).distinct()
        current = None
        if self.exists(spark):
            table = self.read(spark, layout=True)
            years: dict = {}
            for r in touched.groupBy(YEAR).agg(F.collect_set(BUCKET).alias("b")).collect():
                years.setdefault(tuple(sorted(r.b)), []).append(r[YEAR])
            near = F.lit(False)
            for buckets, ys in years.items():  # literals: they prune folders
                known = [y for y in ys if y is not None]
                in_year = F.col(YEAR).isin(known) if known else F.lit(False)
                near = near | (F.col(BUCKET).isin(list(buckets)) & ((in_year | F.col(YEAR).isNull()) if None in ys else in_year))
            current = table.where(near)
        staged = shared_path(spark, f"upsert-{uuid.uuid4().hex}")
        merged = upsert(current, u, (*self.keys, BUCKET, YEAR), self.seq)
        merged.write.parquet(staged)
        rows = spark.read.schema(merged.schema).parquet(staged)
        sizes = rows.groupBy(BUCKET, YEAR).agg(F.count(F.lit(1)).alias("n_rows"))
        files = F.ceil(F.col("n_rows") / F.lit(self.rows_per_file))
        day = F.coalesce(F.dayofyear(self.date) - 1, F.lit(0)) + F.pmod(F.xxhash64(*self.keys), F.lit(1000)) / 1000
        dealt = (rows.join(sizes.select(F.col(BUCKET).alias("_b"), F.col(YEAR).alias("_y"), files.alias("_files")),
                           (F.col(BUCKET) == F.col("_b")) & F.col(YEAR).eqNullSafe(F.col("_y")))
                 .withColumn("_part", F.floor(day * F.col("_files") / 366)))
        (dealt.repartition(BUCKET, YEAR, "_part").sortWithinPartitions(BUCKET, YEAR, *self.keys).select(*merged.columns)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", self.rows_per_file).partitionBy(BUCKET, YEAR).parquet(self.path))
        out = spark.createDataFrame(sizes.collect(), sizes.schema)  # at most buckets times years
        remove(spark, staged)
        return out

    def load(self, source: DataFrame, as_of: str, lookback_days: int = 90) -> DataFrame:
        """Incremental load (S5 + S3): source rows after each series' newest stored date, upserted; returns the ranges written."""
        spark = source.sparkSession
        start = F.date_sub(F.lit(as_of).cast("date"), lookback_days)
        if self.exists(spark):
            mark = high_water_mark(self.read(spark), self.series, self.date)
            same = F.lit(True)
            for c in self.series:
                same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"m.{c}"))
            j = source.alias("s").join(mark.alias("m"), same, "left")
            rows = j.where((F.col(f"s.{self.date}") >= F.coalesce(F.date_add("m.latest_date", 1), start))).select("s.*")
        else:
            rows = source.where(F.col(self.date) >= start)
        return self.upsert(rows.where(F.col(self.date) <= F.lit(as_of).cast("date")))


def observation_store(path: str, series: Sequence[str] = ("series_id",), seq: str = "seq") -> SeriesStore:
    return SeriesStore(path, tuple(series), seq=seq)
