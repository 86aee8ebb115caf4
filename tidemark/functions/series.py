"""Series functions over a partitioned window.

Every function returns a ``Column``; none is a UDF.  ``w`` is always a window
``partitionBy(keys).orderBy(date)`` (see ``operators.panel.series_window``) so a
panel of many series is processed in parallel and one series never has to be
the whole table.  Divisions use ``try_divide``: a zero or null denominator
gives null where the reference would raise (ledger #7).
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double(x) -> Column:
    return _c(x).cast("double")


def lag_of(x, w: WindowSpec, n: int = 1) -> Column:
    """Value ``n`` rows back in the same series."""
    return F.lag(_c(x), n).over(w)


def pct_change(x, w: WindowSpec, n: int = 1) -> Column:
    """(x - lag(x, n)) / lag(x, n) * 100 (W1 YoY with n=12 or 4, W2 QoQ/MoM with n=1)."""
    prev = lag_of(x, w, n)
    return F.try_divide(_c(x) - prev, prev) * F.lit(100.0)


def diff(x, w: WindowSpec, n: int = 1) -> Column:
    """First difference x - lag(x, n)."""
    return _c(x) - lag_of(x, w, n)


def direction(x, w: WindowSpec, up: str = "Rising", down: str = "Falling", flat: str = "Flat") -> Column:
    """Compare with the previous row; a null previous value falls to ``flat``."""
    prev = lag_of(x, w, 1)
    return F.when(_c(x) > prev, F.lit(up)).when(_c(x) < prev, F.lit(down)).otherwise(F.lit(flat))


def rolling_avg(x, w: WindowSpec, n: int) -> Column:
    """Mean over the last ``n`` rows including this one; short leading frames average what exists."""
    return F.avg(_c(x)).over(w.rowsBetween(-(n - 1), Window.currentRow))


def rolling_count_if(flag, w: WindowSpec, n: int) -> Column:
    """Number of true flags in the last ``n`` rows."""
    return F.count(F.when(_c(flag), F.lit(1))).over(w.rowsBetween(-(n - 1), Window.currentRow))


def rolling_corr(x, y, w: WindowSpec, n: int) -> Column:
    """Pearson correlation over the last ``n`` rows, pairs with both values only.

    ``covar_pop / (stddev_pop * stddev_pop)`` with ``try_divide``: a constant
    frame or a single pair gives null (Spark's ``corr`` raises on zero
    variance under ANSI mode; ledger #8).
    """
    both = _c(x).isNotNull() & _c(y).isNotNull()
    xx = F.when(both, as_double(x))
    yy = F.when(both, as_double(y))
    frame = w.rowsBetween(-(n - 1), Window.currentRow)
    return F.try_divide(F.covar_pop(xx, yy).over(frame),
                        F.stddev_pop(xx).over(frame) * F.stddev_pop(yy).over(frame))


def negative_flag(x) -> Column:
    """``x < 0`` with null -> false."""
    return F.coalesce(_c(x) < 0, F.lit(False))


def round_half_up(x, digits: int, precision: int = 18) -> Column:
    """Round like a SQL numeric: go through decimal, then HALF_UP at ``digits``."""
    return F.round(_c(x).cast("decimal(38,10)"), digits).cast(f"decimal({precision},{digits})")
