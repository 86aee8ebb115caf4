"""Containment join of dates and intervals of any number (J8 in general): bins of fixed width, exact test behind an equi join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_join(rows: DataFrame, intervals: DataFrame, date: str, start: str, end: str, on: Sequence[str] = (), bin_days: int = 32, how: str = "inner") -> DataFrame:
    """Every row with every interval that holds its date (ends included), also equal in the columns ``on``.

    An interval goes to each bin that it touches, a row to its own bin; the
    join is on (``on``, bin), so it is hashed or sorted, whatever the sizes,
    and Spark splits skewed bins.  A row and an interval share at most one
    bin, so no pair comes twice.  ``bin_days`` about as long as a typical
    interval keeps copies few.  Rows without a date, and intervals without
    both ends or with the end before the start, match nothing; with ``how`` =
    ``left`` unmatched rows stay.  Interval columns that clash with row columns must be renamed first.
    """
    epoch = F.lit("1970-01-01").cast("date")
    bin_of = lambda c: F.floor(F.datediff(F.col(c).cast("date"), epoch) / bin_days)
    names = {c: f"_on_{i}" for i, c in enumerate(on)}
    filled = intervals.where(F.col(start).cast("date") <= F.col(end).cast("date"))
    wide = filled.withColumn("_bin2", F.explode(F.sequence(bin_of(start), bin_of(end)))).withColumnsRenamed(names)
    left = rows.withColumn("_bin", bin_of(date))
    same = (F.col("_bin") == F.col("_bin2")) & (F.col(date).cast("date") >= F.col(start).cast("date")) & (F.col(date).cast("date") <= F.col(end).cast("date"))
    for c, n in names.items():
        same = same & (F.col(c) == F.col(n))
    return left.join(wide, same, how).drop("_bin", "_bin2", *names.values())
