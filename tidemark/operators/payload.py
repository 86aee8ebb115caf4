"""Verdict over whole payloads before they are loaded (X2): observations judged first, then the payload, in one pass.

A payload is judged where it lies, with array functions over its own
observations: no shuffle, no second read, whatever the number of payloads.
Repeated dates are neighbours in a sort and the order of dates is followed
by one fold, so the work grows with a payload's length.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.observations import ELEMENT_SCHEMA, MISSING, PAYLOAD_SCHEMA

#: reasons by severity; an observation with a reason of severity ERROR is invalid
ERRORS = ("bad_element", "missing_field", "bad_date", "not_numeric", "future_date", "before_1900", "duplicate_date")
WARNINGS = ("out_of_order",)


@dataclass(frozen=True)
class PayloadRules:
    """When a whole payload is rejected."""
    earliest: str = "1900-01-01"
    most_invalid: float = 0.5      # rejected if a larger share of its observations is invalid


def _faults(as_of: str, r: PayloadRules) -> Callable[[Column], Column]:
    """Errors that an observation shows by itself: all but ``duplicate_date``."""
    day = F.lit(as_of).cast("date")
    early = F.lit(r.earliest).cast("date")

    def judge(o: Column) -> Column:
        d, number = o["day"], o["value"].try_cast("double")
        given = o["value"].isNotNull() & (o["value"] != MISSING)
        return F.array_compact(F.array(
            F.when(o["odd"], F.lit("bad_element")),
            F.when(~o["odd"] & (o["date"].isNull() | o["value"].isNull()), F.lit("missing_field")),
            F.when(o["date"].isNotNull() & d.isNull(), F.lit("bad_date")),
            F.when(given & number.isNull(), F.lit("not_numeric")),
            F.when(d > day, F.lit("future_date")),
            F.when(d < early, F.lit("before_1900"))))
    return judge


def payload_verdict(payloads: DataFrame, as_of: str, keys: Sequence[str] = ("series_id",), payload_col: str = "payload",
                    rules: PayloadRules = PayloadRules()) -> DataFrame:
    """One row per payload: passed, rejected, total, valid, invalid, issues (severity, reason, n).

    rejected: no JSON object (``bad_payload``), no list of observations
    (``bad_observations``), or too large a share of invalid observations
    (``too_many_invalid``); nothing of such a payload is to be loaded.
    passed: not rejected and no observation invalid.  A null payload is a bad
    one.  ``"."`` is a missing value, which is valid.
    """
    names = F.json_object_keys(payload_col)
    p = payloads.select(*keys, F.col(payload_col), names.alias("_names"), F.from_json(payload_col, PAYLOAD_SCHEMA)["observations"].alias("_list"))
    # every step reads its array once or at an index, so a payload costs its length (and a sort); no step's column
    # is used just once by the next, or the optimizer would work it out again for every element
    one = F.transform("_list", lambda e: F.struct(F.from_json(e, ELEMENT_SCHEMA).alias("j"), (e.isNull() | F.json_object_keys(e).isNull()).alias("odd")))
    one = F.transform(one, lambda o: F.struct(o["j"]["date"].alias("date"), o["j"]["value"].alias("value"), o["odd"],
                                              F.try_to_date(o["j"]["date"], "yyyy-MM-dd").alias("day")))
    faults = _faults(as_of, rules)
    p = p.withColumn("_o", F.transform(one, lambda o: F.struct(o["day"].alias("day"), faults(o).alias("faults"))))
    p = p.withColumn("_days", F.sort_array(F.transform(F.filter("_o", lambda o: o["day"].isNotNull()),
                                                       lambda o: F.struct(o["day"].alias("day"), (F.size(o["faults"]) > 0).alias("bad")))))
    # equal dates are neighbours among the sorted ones
    p = p.withColumn("_twice", F.filter("_days", lambda x, i: (x["day"] == F.get("_days", i - 1)["day"]) | (x["day"] == F.get("_days", i + 1)["day"])))
    back = F.aggregate("_o", F.struct(F.lit(None).cast("date").alias("top"), F.lit(0).alias("n")),
                       lambda a, o: F.struct(F.greatest(a["top"], o["day"]).alias("top"), (a["n"] + F.when(o["day"] < a["top"], 1).otherwise(0)).alias("n")),
                       lambda a: a["n"])
    invalid = F.size(F.filter("_o", lambda o: F.size(o["faults"]) > 0)) + F.size(F.filter("_twice", lambda x: ~x["bad"]))
    total = F.coalesce(F.size("_list"), F.lit(0))
    p = p.withColumns({"total": F.when(F.col("_list").isNull(), F.lit(0)).otherwise(total),
                       "invalid": F.when(F.col("_list").isNull(), F.lit(0)).otherwise(invalid)})
    whole = (F.when(F.col("_names").isNull(), "bad_payload").when(F.col("_list").isNull(), "bad_observations")
             .when(F.col("invalid") > F.col("total") * rules.most_invalid, "too_many_invalid"))

    def times_of(reason: str) -> Column:
        n = {"duplicate_date": F.size("_twice"), "out_of_order": back}.get(reason)
        return F.coalesce(F.size(F.filter("_o", lambda o: F.array_contains(o["faults"], reason))) if n is None else n, F.lit(0))
    per = F.array(*[F.struct(F.lit("ERROR" if x in ERRORS else "WARNING").alias("severity"), F.lit(x).alias("reason"),
                             times_of(x).alias("n")) for x in (*ERRORS, *WARNINGS)])
    found = F.filter(per, lambda s: s["n"] > 0)
    own = F.array(F.struct(F.lit("CRITICAL").alias("severity"), F.col("rejected_for").alias("reason"), F.lit(1).alias("n")))
    p = p.withColumn("rejected_for", whole)
    issues = F.concat(F.when(F.col("rejected_for").isNotNull(), own).otherwise(F.filter(own, lambda s: F.lit(False))),
                      F.when(F.col("_list").isNotNull(), found).otherwise(F.filter(per, lambda s: F.lit(False))))
    return p.select(*keys, (F.col("rejected_for").isNull() & (F.col("invalid") == 0)).alias("passed"), F.col("rejected_for").isNotNull().alias("rejected"),
                    "rejected_for", "total", (F.col("total") - F.col("invalid")).alias("valid"), "invalid", issues.alias("issues"))
