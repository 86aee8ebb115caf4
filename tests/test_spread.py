"""Windows and quantiles over series too long for one task, against the plain ones; load rules by hand."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import load_rules as L
from tidemark.operators import spread


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(1)
    rows = []
    for i in range(1200):  # one key holds most of the rows; null keys are a series too
        k = rng.choice(["hot"] * 12 + ["a", "b", None])
        rows.append((k, dt.date(2000, 1, 1) + dt.timedelta(days=i), float(rng.randrange(50)) if rng.random() > 0.1 else None, float(rng.randrange(9)), i))
    return spark.createDataFrame(rows, "k string, d date, x double, y double, id int").repartition(5).cache()


def same(a, b, cols):
    r = lambda v: round(v, 9) if isinstance(v, float) else v
    one, two = (sorted((tuple(r(v) for v in row) for row in df.select(*cols).collect()), key=repr) for df in (a, b))
    assert one == two


@pytest.mark.parametrize("keys, block, n", [((), 100, 12), (("k",), 7, 12), (("k",), 1, 5), ((), 10_000, 3)])
def test_rolling_equals_the_plain_window(panel, keys, block, n):
    w = Window.partitionBy(*keys).orderBy("d") if keys else Window.orderBy("d")
    frame = w.rowsBetween(1 - n, 0)
    got = spread.with_halo(panel, ["d"], n, {"avg": lambda s: F.avg("x").over(s.rowsBetween(1 - n, 0)), "prev": lambda s: F.lag("x").over(s),
                                             "n": lambda s: F.count_if(F.col("y") > 4).over(s.rowsBetween(1 - n, 0))}, keys, block, tasks=4)
    want = panel.withColumns({"avg": F.avg("x").over(frame), "prev": F.lag("x").over(w), "n": F.count_if(F.col("y") > 4).over(frame)})
    same(got, want, ["k", "id", "avg", "prev", "n"])


def test_corr_and_spike_equal_the_plain_ones(panel):
    from tidemark.functions.series import rolling_corr
    from tidemark.operators import quality as Q
    w = Window.partitionBy("k").orderBy("d")
    same(spread.rolling_corr(panel, "x", "y", 10, ["d"], ["k"], block=33), panel.withColumn("rolling_corr", rolling_corr("x", "y", w, 10)), ["id", "rolling_corr"])
    same(spread.spike(panel, "x", 50.0, ["d"], block=40), Q.spike(panel, "x", 50.0, (), "d"), ["id", "prev_value", "change_pct"])


def test_no_window_over_all_rows_in_one_task(panel):
    plan = spread.rolling_avg(panel, "x", 12, ["d"], block=50)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    sizes = spread.placed(panel, ["d"], 4).agg(F.min("_place"), F.max("_place"), F.countDistinct("_place")).first()
    assert tuple(sizes) == (0, 1199, 1200)


@pytest.mark.parametrize("keys, tasks", [(("k",), 6), ((), 3), (("k",), 1)])
def test_quantiles_equal_the_order_statistic(panel, keys, tasks):
    shares = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "max": 1.0, "min": 0.0}
    got = {tuple(r[k] for k in keys): tuple(r[n] for n in shares) for r in spread.quantiles(panel, "x", shares, keys, tasks).collect()}
    values = {}
    for r in panel.collect():
        if r.x is not None:
            values.setdefault(tuple(r[k] for k in keys), []).append(r.x)
    want = {k: tuple(sorted(v)[max(1, -(-len(v) * int(q * 100) // 100)) - 1] for q in shares.values()) for k, v in values.items()}
    assert got == want


def test_empty_inputs(spark, panel):
    none = panel.limit(0)
    assert spread.rolling_avg(none, "x", 3, ["d"]).count() == 0 and spread.quantiles(none, "x", {"p": 0.5}, ["k"]).count() == 0


def test_load_rules_by_hand(spark):
    ok = spark.createDataFrame([("A",), ("A",), ("C",)], "series_id string")
    bad = spark.createDataFrame([("A",), ("B",)], "series_id string")
    report = L.load_report(ok, bad, spark.createDataFrame([("A",), ("B",), ("D",)], "series_id string"))
    got = {r.series_id: (r.fetched, r.upserted, r.failed, r.status) for r in report.collect()}
    assert got == {"A": (3, 2, 1, "success"), "B": (1, 0, 1, "partial"), "C": (1, 1, 0, "success"), "D": (0, 0, 0, "no_data")}
    assert tuple(L.load_report_totals(report).first()) == (4, 2, 1, 1, 5, 3, 2)
    rows = spark.createDataFrame([("A", dt.datetime(2020, 1, 1)), ("B", dt.datetime(2020, 1, 20))], "series_id string, ingested_at timestamp_ntz")
    want = spark.createDataFrame([("A", 10, 20), ("B", 10, 20), ("none", 10, 20)], "series_id string, warn_days int, error_days int")
    fresh = {r.series_id: r.freshness_status for r in L.freshness(rows, want, "2020-01-31").collect()}
    assert fresh == {"A": "error", "B": "warn", "none": "error"}
    g = spark.createDataFrame([("a", 5), ("b", -7), ("c", 0)], "t string, new_rows long")
    one = L.growth_verdict(g, "t").first()
    assert (one.check_status, one.total_new_rows, one.tables_with_no_growth) == ("passed", 5, "b,c")
    assert L.growth_verdict(g.where("new_rows <= 0"), "t").first().check_status == "warning"
    assert {r.table_name: r.row_count for r in L.row_count_snapshot(rows).collect()} == {"A": 1, "B": 1, "total": 2}


def test_no_shared_folder_outside_local_mode(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(RuntimeError, match="shared folder"):
        session.ensure_checkpoint_dir(Session())
