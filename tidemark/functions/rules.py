"""Rule tables as Columns (P3-P9): ordered buckets, first-match decision
tables, additive point scores and factor lists.

All are chained ``CASE WHEN`` expressions built from plain Python lists, so
they stay inside whole-stage codegen.  A null input never matches a rule and
falls to the ELSE value, as in SQL (ledger #4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bucket(x, thresholds: Sequence[float], labels: Sequence[str], otherwise: str | None,
           inclusive: bool = True) -> Column:
    """Ordered threshold CASE: first ``x <= t_i`` (or ``<`` if not inclusive) wins."""
    col = _c(x)
    expr = None
    for t, lab in zip(thresholds, labels):
        cond = col <= F.lit(t) if inclusive else col < F.lit(t)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(otherwise))


def decision_table(rules: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """First-match CASE over arbitrary conditions."""
    expr = None
    for cond, val in rules:
        v = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    o = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return expr.otherwise(o)


def points(rules: Sequence[tuple[Column, int]]) -> Column:
    """First-match points for one term; no match scores 0."""
    return decision_table(rules, 0)


def additive_score(terms: Sequence[Column]) -> Column:
    """Sum of CASE point terms."""
    total = None
    for t in terms:
        total = t if total is None else total + t
    return total


def outlook(x, pivot: float = 100.0, above: str = "Optimistic", below: str = "Pessimistic",
            equal: str = "Neutral") -> Column:
    """Above/below a pivot, else the neutral label (P5)."""
    col = _c(x)
    return F.when(col > pivot, F.lit(above)).when(col < pivot, F.lit(below)).otherwise(F.lit(equal))


def flag(cond: Column) -> Column:
    """Conjunctive flag; unknown -> false."""
    return F.coalesce(cond, F.lit(False))


def factor_list(conds: Sequence[tuple[Column, str]], sep: str = ", ") -> tuple[Column, Column]:
    """Null-or-label per condition; joined text and count of labels."""
    labels = [F.when(c, F.lit(lab)) for c, lab in conds]
    text = F.concat_ws(sep, *labels)
    count = additive_score([F.when(lab.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for lab in labels])
    return text, count
