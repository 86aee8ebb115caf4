"""The stored observation table and odd payloads."""

import datetime as dt
import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import observations as O
from tidemark.sources.store import SeriesStore
from tidemark.streaming.incremental import load_stream

SCHEMA = "series_id string, observation_date date, value double, seq long"
ODD_IDS = ["007", "7", "1e3", "1000", "2020-01-01", "true", "", None, "a/b=c", "Ä"]


def rows_of(df):
    return sorted(((r.series_id, str(r.observation_date), r.value) for r in df.collect()), key=repr)


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_ids_keep_their_text_and_updates_replace(spark, scratch):
    d = dt.date(2020, 1, 1)
    st = SeriesStore(f"{scratch}/t", buckets=4)
    st.upsert(spark.createDataFrame([(s, d, 1.0, 1) for s in ODD_IDS], SCHEMA))
    st.upsert(spark.createDataFrame([(s, d, 9.0, 2) for s in ("007", None)] + [("7", d, 5.0, 2), ("new", None, 1.0, 1)], SCHEMA))
    want = {s: 1.0 for s in ODD_IDS} | {"007": 9.0, None: 9.0, "7": 5.0}
    assert rows_of(st.read(spark)) == sorted([(s, str(d), v) for s, v in want.items()] + [("new", "None", 1.0)], key=repr)
    assert rows_of(st.series_rows(spark, "007")) == [("007", str(d), 9.0)] and st.series_rows(spark, None).count() == 1


@pytest.mark.parametrize("s", ["007", "1e3", "2020-01-01"])
def test_partitioned_table_keeps_ids(spark, scratch, s):
    path, d = f"{scratch}/p", dt.date(2020, 1, 1)
    args = (path, ["series_id", "observation_date"], "seq", "series_id")
    O.write_upsert(spark, spark.createDataFrame([(s, d, 1.0, 1), (None, d, 2.0, 1)], SCHEMA), *args)
    out = O.write_upsert(spark, spark.createDataFrame([(s, d, 9.0, 2), (None, d, 3.0, 2), ("7", d, 5.0, 3)], SCHEMA), *args)
    assert rows_of(out) == sorted([(s, str(d), 9.0), (None, str(d), 3.0), ("7", str(d), 5.0)], key=repr)
    assert out.schema["series_id"].dataType.simpleString() == "string"


def test_a_month_rewrites_one_year(spark, scratch):
    st = SeriesStore(f"{scratch}/t", buckets=4)
    hist = [(f"S{s}", dt.date(y, m, 1), float(s), 1) for s in range(20) for y in (2018, 2019, 2020) for m in range(1, 13)]
    st.upsert(spark.createDataFrame(hist, SCHEMA))
    before = files(st.path)
    ranges = st.upsert(spark.createDataFrame([(f"S{s}", dt.date(2019, 5, 1), -1.0, 2) for s in range(20)], SCHEMA))
    after = files(st.path)
    gone = {f for f in before if after.get(f) != before[f]}
    assert gone and all("obs_year=2019" in f for f in gone | (set(after) - set(before)))
    assert {r.obs_year for r in ranges.collect()} == {2019}
    assert st.read(spark).where("value = -1.0").count() == 20 and st.read(spark).count() == len(hist)


def test_random_batches_equal_last_wins(spark, scratch):
    rng = random.Random(3)
    st, want = SeriesStore(f"{scratch}/t", buckets=3, rows_per_file=40), {}
    for batch in range(4):
        rows = [(rng.choice(["hot", "hot", "007", "7", "b"]), dt.date(2000 + rng.randrange(4), rng.randrange(1, 13), rng.randrange(1, 28)), float(i), batch * 1000 + i)
                for i in range(150)]
        for s, d, v, q in rows:
            want[s, str(d)] = v
        st.upsert(spark.createDataFrame(rows, SCHEMA).repartition(3))
        st.upsert(spark.createDataFrame(rows, SCHEMA))  # again: no change
    assert rows_of(st.read(spark)) == sorted(((s, d, v) for (s, d), v in want.items()), key=repr)
    per = {}
    for f in files(st.path):
        per.setdefault(os.path.dirname(f), []).append(f)
    assert max(map(len, per.values())) > 1  # a range of many rows is several files


def test_read_prunes_and_stages_nothing(spark, scratch):
    st = SeriesStore(f"{scratch}/t", buckets=8)
    left = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/upsert-*"))
    st.upsert(spark.createDataFrame([(f"S{s}", dt.date(2020, 1, 1), 1.0, 1) for s in range(30)], SCHEMA))
    plan = st.series_rows(spark, "S3")._jdf.queryExecution().executedPlan().toString()
    assert "series_bucket" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/upsert-*")) == left


def test_incremental_load(spark, scratch):
    src = spark.createDataFrame([(s, dt.date(2020, 1, d), float(d), d) for s in ("A", "B") for d in range(1, 31)], SCHEMA)
    st = SeriesStore(f"{scratch}/t")
    st.upsert(src.where("series_id = 'A' and observation_date <= date'2020-01-20'"))
    st.load(src, "2020-01-25", lookback_days=3)
    got = rows_of(st.read(spark))
    assert got == sorted([("A", f"2020-01-{d:02d}", float(d)) for d in range(1, 26)] + [("B", f"2020-01-{d}", float(d)) for d in range(22, 26)])


GOOD = {"date": "2020-01-01", "value": "2"}
PAYLOADS = [("list", "[1]"), ("text", json.dumps({"observations": "x"})), ("string", '"abc"'), ("odd", json.dumps({"observations": [1, GOOD]})),
            ("null list", json.dumps({"observations": None})), ("null element", json.dumps({"observations": [None, GOOD, "s", [GOOD], {"date": "2020-01-02"}]})),
            ("number", json.dumps({"observations": [{"date": "2020-01-01", "value": 1.5, "more": {"x": 1}}]})), ("no key", json.dumps({"other": []})),
            ("null", None), ("broken", '{"observations": [{"date"'), ("object", json.dumps({"observations": {"a": GOOD}})), ("empty", ""), ("none", '{"observations": []}')]


def test_odd_payloads_are_kept(spark):
    p = spark.createDataFrame(PAYLOADS, "series_id string, payload string")
    parsed, bad = O.parse_observations(p)
    got = sorted((r.series_id, str(r.observation_date), r.value) for r in parsed.collect())
    assert got == [("null element", "2020-01-01", 2.0), ("null element", "2020-01-02", None), ("number", "2020-01-01", 1.5), ("odd", "2020-01-01", 2.0)]
    q = sorted((r.series_id, r.reason, r.pos) for r in bad.collect())
    assert q == sorted([("list", "bad_payload", None), ("text", "bad_observations", None), ("string", "bad_payload", None), ("odd", "bad_element", 0),
                        ("null list", "bad_observations", None), ("null element", "bad_element", 0), ("null element", "bad_element", 2),
                        ("null element", "bad_element", 3), ("broken", "bad_payload", None), ("object", "bad_observations", None), ("empty", "bad_payload", None)])
    raw = {r.series_id: r.raw_json for r in parsed.collect()}
    assert json.loads(raw["number"])["more"] == {"x": 1}
    assert {r.series_id: r.raw_json for r in bad.collect()}["list"] == "[1]"


def test_stream_keeps_ids_and_odd_payloads(spark, scratch):
    os.makedirs(f"{scratch}/in")
    for i, (sid, value) in enumerate([("007", "1"), ("7", "2"), ("007", "3")]):
        with open(f"{scratch}/in/{i}.json", "w") as f:
            f.write(json.dumps({"series_id": sid, "seq": i, "payload": json.dumps({"observations": [{"date": "2020-01-01", "value": value}, 5]})}) + "\n")
        load_stream(spark, f"{scratch}/in", f"{scratch}/t", f"{scratch}/c")
    assert rows_of(SeriesStore(f"{scratch}/t").read(spark)) == [("007", "2020-01-01", 3.0), ("7", "2020-01-01", 2.0)]
    assert spark.read.parquet(f"{scratch}/t_quarantine").where(F.col("reason") == "bad_element").count() == 3
