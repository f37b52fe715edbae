from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabspark.plans import service as V
from tabspark.plans import service_queries as Q
from tabspark.plans.queries import Tables

from .oracle import connect

T = [dt.datetime(2026, 1, d) for d in range(1, 10)]


@pytest.fixture(scope="module")
def tables(spark):
    rows = {
        "evaluations": [("e1", T[0], T[1], "RUNNING", "RUNNING", "j1", None), ("e1", T[2], T[1], "FINAL", "DONE", "j1", 0.9), ("e2", T[3], T[3], "FINAL", "DONE", "j1", 0.8), ("e3", T[4], T[4], "FAILED", "FAILED", "j2", None)],
        "metrics": [("e1", T[1], "t", "column", "fidelity", "column.ks", "a", None, None, 0.1, 0.9, "PASS"), ("e2", T[3], "t", "column", "fidelity", "column.ks", "a", None, None, 0.3, 0.2, "FAIL"), ("e2", T[0], "t", "column", "fidelity", "column.tvd", "a", None, None, 0.3, 0.2, "FAIL")],
        "dlq": [("r1", "t", "fk.orphan", "blocker", "c", T[0], "b"), ("r1", "t", "fk.orphan", "blocker", "c", T[1], "a"), ("r2", "t", "pk.null", "blocker", "c", T[1], "z")],
        "runs": [("run", T[0], "t", "j9", "PASSED", 0.0), ("run-1", T[1], "u", "j9", "FAILED", 0.5), ("runner", T[2], "u", "j8", "FAILED", 0.5)],
        "source_stats": [("t", "d", "r1", "c", "exact", T[0], "old"), ("t", "d", "r2", "c", "exact", T[1], "new")],
        "pools": [("d", "m", "c", 10, T[0]), ("x", "m", "c", 10, T[0])],
    }
    V.register(spark, {k: spark.createDataFrame(v, V.SCHEMAS[k]) for k, v in rows.items()})


def test_every_query_runs(spark, tables):
    for name in V.QUERIES:
        V.run(spark, name).collect()
    assert len(V.QUERIES) == 22


def test_results(spark, tables):
    assert [(r.evaluation_id, r.total) for r in V.run(spark, "evaluations.list", limit=2).collect()] == [("e3", 3), ("e2", 3)]
    assert V.run(spark, "evaluations.count", status="DONE").first().n == 2
    assert V.run(spark, "evaluations.byJobId", job="j1").first().evaluation_id == "e2"
    assert [r.evaluation_id for r in V.run(spark, "trend", metric="column.ks").collect()] == ["e2", "e1"]
    assert V.run(spark, "trend", metric="column.tvd").count() == 0  # of another time than its evaluation
    assert {(r.rule, r.n, r.example) for r in V.run(spark, "dlq.summary").collect()} == {("fk.orphan", 2, "a"), ("pk.null", 1, "z")}
    assert [r.run_id for r in V.run(spark, "runs.forEvaluation", run="run").collect()] == ["run", "run-1"]
    assert [r.stats for r in V.run(spark, "sourceStats.byTable", table="t").collect()] == ["new"]
    assert {(r.reference_digest, r.table_fqn) for r in V.run(spark, "rag.poolSets").collect()} == {("d", "t"), ("x", None)}


def test_guards(spark):
    for bad in ("DROP TABLE x", "SELECT 1; SELECT 2", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a"):
        with pytest.raises(ValueError):
            V.read_only(bad)
    assert V.read_only("SELECT 'drop; this'")
    with pytest.raises(ValueError):
        V.run(spark, "runs.count", nothing=1)


def test_trend_cuts_tied_rows_alike(spark):
    evaluations = spark.createDataFrame([("e1", T[0], T[1], "FINAL", "DONE", "j1", 0.9)], V.SCHEMAS["evaluations"])
    rows = [("e1", T[1], "t", "column", "fidelity", "column.ks", "a", None, None, i / 10, None, "PASS") for i in range(40)]
    for some in (rows, rows[::-1], rows[7::2] + rows[:7] + rows[8::2]):
        V.register(spark, {"evaluations": evaluations, "metrics": spark.createDataFrame(some, V.SCHEMAS["metrics"])})
        assert [r.value for r in V.run(spark, "trend", metric="column.ks", limit=5).collect()] == [0.0, 0.1, 0.2, 0.3, 0.4]


def test_trend_is_one_of_the_results_that_its_sql_allows(spark):
    sf = "/root/testdata/sf0.01"
    V.register(spark, Q.result_tables(Tables(spark, sf)))
    rows = connect(sf).execute(Q.other_engine("trend")).fetchall()  # below the registered limit, so none is cut
    key = lambda r: (r[1], r[0], r[2], *r[6:9])
    for limit in (7, 409):
        last = key(rows[limit - 1])
        assert key(rows[limit]) == last  # the limit cuts among tied rows
        found = V.run(spark, "trend", metric="m1", table="t1", limit=limit).withColumn("evaluated_at", F.unix_micros("evaluated_at")).collect()
        found = [tuple(r) for r in found]
        assert len(found) == limit
        assert Counter(r for r in found if key(r) != last) == Counter(r for r in rows[:limit] if key(r) != last)
        assert Counter(r for r in found if key(r) == last) <= Counter(r for r in rows if key(r) == last)
