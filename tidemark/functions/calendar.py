"""Calendar scalars: period keys and labels (date_trunc, extract, to_char, concat)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_start(x) -> Column:
    return F.trunc(_c(x).cast("date"), "month")


def quarter_start(x) -> Column:
    return F.trunc(_c(x).cast("date"), "quarter")


def year_month(x) -> Column:
    """``YYYY-MM`` (concat of year and zero-padded month)."""
    return F.concat_ws("", F.year(_c(x)).cast("string"), F.lit("-"),
                       F.lpad(F.month(_c(x)).cast("string"), 2, "0"))


def year_month_of(year, month) -> Column:
    return F.concat_ws("", _c(year).cast("string"), F.lit("-"), F.lpad(_c(month).cast("string"), 2, "0"))


def year_quarter_of(year, quarter) -> Column:
    return F.concat_ws("", _c(year).cast("string"), F.lit("-Q"), _c(quarter).cast("string"))


def month_spine(start, end) -> Column:
    """Month starts from ``start`` to ``end`` inclusive (generate_series)."""
    return F.explode(F.sequence(month_start(start), month_start(end), F.expr("INTERVAL 1 MONTH")))
