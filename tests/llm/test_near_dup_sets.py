"""The sets that a star's pairs are confirmed on."""

import re

import pytest

from tidemark.llm import near_dup


@pytest.fixture()
def confirmed(monkeypatch):
    """(pairs, sets of the first ends, sets of the second ends) of every confirmation."""
    calls, old = [], near_dup._confirmed

    def spy(pairs, of_a, of_b, *rest):
        calls.append([{tuple(r) for r in pairs.select("a", "b").collect()}, *({r.rep for r in t.select("rep").collect()} for t in (of_a, of_b))])
        return old(pairs, of_a, of_b, *rest)
    monkeypatch.setattr(near_dup, "_confirmed", spy)
    return calls


def test_a_stars_pairs_are_confirmed_on_the_sets_of_their_ends_alone(spark, confirmed):
    """Half of the documents share words with others but resemble none: their sets are not moved for the pairs."""
    base = [[f"g{g}w{i}" for i in range(60)] for g in range(20)]
    rows = [(10 * g + k, " ".join(w[:-1] + [f"end{k}"])) for g, w in enumerate(base) for k in range(3)]
    rows += [(1000 + g, " ".join(w[:25] + [f"o{g}v{i}" for i in range(60)])) for g, w in enumerate(base)]
    got = {r.doc_id: r.component_id for r in near_dup.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (i if i >= 1000 else i // 10 * 10) for i, _ in rows}
    pairs, of_a, of_b = confirmed[0]
    assert of_a == {a for a, _ in pairs} and of_b == {b for _, b in pairs}


def test_the_sets_are_dealt_out_once_and_stay_where_they_are(spark, monkeypatch):
    """No confirmation shuffles the table of all sets: second ends are read by bucket, and the tables are gone at the end."""
    moved, old = [], near_dup._confirmed

    def spy(pairs, of_a, of_b, *rest):
        at_b = pairs.join(of_b.withColumnRenamed("rep", "b"), "b").select("a", "b", "shingles")
        plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(at_b._jdf.queryExecution(), "formatted")
        moved.append(re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", plan))
        return old(pairs, of_a, of_b, *rest)
    monkeypatch.setattr(near_dup, "_confirmed", spy)
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(10 * g + k, " ".join([f"g{g}w{i}" for i in range(59)] + [f"end{k}"])) for g in range(20) for k in range(3)]
        got = {r.doc_id: r.component_id for r in near_dup.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    assert got == {i: i // 10 * 10 for i, _ in rows}
    assert moved and all(moved) and not any("shingles" in cols for one in moved for cols in one)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("nd_")]
