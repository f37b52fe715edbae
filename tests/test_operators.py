from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabspark import sources as S
from tabspark.functions import sql_round
from tabspark.operators import membership as M
from tabspark.operators import profile as P
from tabspark.operators import relational as R
from tabspark.operators import validate as V
from tabspark.streaming import events as E


def test_model_waves_and_roles():
    own = R.Edge("items", "orders", (("order_id", "id"),))
    other = R.Edge("items", "parts", (("part_id", "id"),))
    shared = R.Edge("items", "batches", (("order_id", "order_id"), ("batch", "id")))
    m = R.Model(["users", "orders", "parts", "batches", "items"], [R.Edge("orders", "users", (("user_id", "id"),)), own, other, shared])
    assert m.waves() == [["users", "parts", "batches"], ["orders"], ["items"]]
    assert m.driving("items") is own
    assert [m.roles("items")[e] for e in (own, other, shared)] == ["driving", "independent", "conditional"]
    assert m.component("parts") == m.tables
    with pytest.raises(ValueError):
        R.Model(["a", "b"], [R.Edge("a", "b", (("x", "y"),)), R.Edge("b", "a", (("x", "y"),))]).waves()
    with pytest.raises(ValueError):
        R.Model(["a"], [R.Edge("a", "b", (("x", "y"),))])


def test_null_keys(spark):
    parent = spark.createDataFrame([(1, 1)], "a int, b int")
    child = spark.createDataFrame([(1, 1), (1, None), (None, None), (2, 2)], "x int, y int")
    assert [tuple(r) for r in R.orphans(child, parent, ["x", "y"], ["a", "b"]).collect()] == [(2, 2)]
    gate = {(r.x, r.y): r.orphan for r in V.orphan_gate(child, parent, ["x", "y"], ["a", "b"]).collect()}
    assert gate == {(1, 1): False, (1, None): True, (None, None): False, (2, 2): True}


def test_all_null_rows_never_match(spark):
    df = spark.createDataFrame([(None, None), (1, "a")], "x int, y string")
    r = M.exact_matches(df, df, ["x", "y"]).first()
    assert (r.n, r.matches) == (2, 1)


def test_running_totals(spark):
    df = spark.range(1000).select(F.col("id").alias("v"), (F.col("id") % 5 + 1).alias("c"))
    got = {r.v: r.before for r in P.running(df, "v", "c").collect()}
    total = 0
    for v in range(1000):
        assert got[v] == total
        total += v % 5 + 1


def test_ndjson_and_events(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5)], "k int, a double")
    S.write_ndjson(df, str(tmp_path / "j"))
    assert sorted((r.k, r.a) for r in spark.read.schema("a double, k int").json(str(tmp_path / "j")).collect()) == [(1, None), (2, 1.5)]
    S.append_event(df.select("k"), "RUNNING", str(tmp_path / "e"))
    S.append_event(df.select("k"), "FINAL", str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e")).count() == 4
    with pytest.raises(ValueError):
        S.append_event(df, "DONE", str(tmp_path / "e"))


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    q = E.stream(spark, str(tmp_path / "in"), events.schema, "1 hour").writeStream.outputMode("complete").format("memory").queryName("windows").start()
    q.processAllAvailable()
    q.stop()
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, spark.table("windows").collect()), key=key) == sorted(map(tuple, E.batch(events, "1 hour").collect()), key=key)


def test_graph_rules():
    from tabspark.operators import relational as R

    m = R.load_model("""
tables: [a, b, c]
edges:
  - {child: b, parent: a, columns: {b_a: a_id}}
  - {child: c, parent: b, columns: {c_b: b_id, c_a: b_a}}
  - {child: c, parent: a, columns: {c_a: a_id}}
""")
    assert m.waves() == [["a"], ["b"], ["c"]] and m.launch(["c"], ["a"]) == ["b", "c"]
    edge = m.edges[2]
    assert m.roles("c")[edge] == "implied" and m.overlap(edge) == (["c_a"], [])
    assert ("b_a", "a_id") in m.widened("b")[m.edges[0]]
    assert m.digest() == R.Model(["c", "b", "a"], m.edges[::-1]).digest() and "driving b by c_b, c_a" in m.card()
    m.check_ownership()
    two = R.Model(["a", "b", "c"], [R.Edge("c", "a", (("k", "id"),), drives=True), R.Edge("c", "b", (("x", "id"),)), R.Edge("c", "a", (("x", "other"),))])
    with pytest.raises(ValueError):
        two.check_ownership()
    with pytest.raises(ValueError):
        R.load_model("tables: [a]\nother: 1")


def test_stores_and_dispositions(spark, tmp_path):
    from tabspark import sources as S
    from tabspark.operators import relational as R

    rows = spark.range(3)
    path = str(tmp_path / "store")
    assert S.store_get(spark, path, "d1") is None
    S.store_put(rows, path, "d1")
    S.store_put(spark.range(9), path, "d1")
    assert S.store_get(spark, path, "d1").count() == 3
    with pytest.raises(ValueError):
        S.write_disposed(rows, str(tmp_path / "none"), create=False)
    S.write_disposed(rows, str(tmp_path / "t"))
    S.write_disposed(rows, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6
    assert S.load_safe(rows.schema) == rows.schema and S.table_facts(rows, ["id"])["key"] == ["id"]
    assert R.incompatible(R.Edge("x", "y", (("id", "id"),)), rows, rows.selectExpr("cast(id AS string) AS id"))


def test_running_totals_in_ranges(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tabspark.operators import profile as P

    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x"), (F.col("id") % 3).alias("g"), F.lit(2).alias("c"))
    monkeypatch.setattr(P, "PART", 2000)
    assert len(P.cuts(rows, "x")) > 3
    got = {(r.g, r.x): r.before for r in P.running(rows, "x", "c", by=("g",)).collect()}
    want, sums = {}, {}
    for x, g in sorted((i * 7919 % 5003, i % 3) for i in range(5000)):
        want[g, x] = sums.get(g, 0)
        sums[g] = want[g, x] + 2
    assert got == want


def test_command_line(spark, tmp_path, capsys):
    from tabspark.__main__ import main

    assert main(["catalogue"]) == 0 and "column.ks" in capsys.readouterr().out
    source = "/root/testdata/sf0.001/customer.parquet"
    assert main(["generate", "--source", source, "--key", "c_custkey", "--categorical", "c_mktsegment", "--rows", "20", "--out", str(tmp_path / "g")]) == 0
    assert spark.read.parquet(str(tmp_path / "g")).count() == 20


def test_joint_keys_meet_their_tuples_by_ranges(spark):
    from tabspark.operators import generate as G

    weights = [3, 0, 5000, 1, *[1] * 300, 40, 2_000_000]
    tuples = spark.createDataFrame(list(enumerate(weights)), "k long, weight long")
    ids = spark.range(2000)
    drawn = G.joint_keys(ids, tuples, ["k"], "id", "s")
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    loops = [x for x in plan.splitlines() if "NestedLoopJoin" in x or "CartesianProduct" in x]
    assert "_part" in plan and all("Cross" in x for x in loops)  # no tuple is compared with every draw
    ends, total = [], 0
    for w in weights:
        total += w
        ends.append(total)
    want = {}
    for r in ids.select("id", F.floor(G.unit(F.col("id"), "s") * total).alias("x")).collect():
        want[r.id] = next(k for k, end in enumerate(ends) if r.x < end)
    got = drawn.collect()
    assert len(got) == 2000 and {r.id: r.k for r in got} == want


def test_quantiles_of_times_are_rounded_as_in_sql(spark):
    import duckdb

    from tabspark.operators import generate as G

    q, times = [0.0, 0.25, 0.5, 0.75, 1.0], [1704718027228185 + i for i in (-5, 0, 1, 4, 9, 11, 40, 41)]
    want = duckdb.execute("SELECT list_transform(quantile_cont(x::double, ?), lambda z: round(z, 6)) FROM (SELECT unnest(?) AS x)", [q, times]).fetchone()[0]
    grid = G.quantile_grid(spark.createDataFrame([(x,) for x in times], "x long"), "x", 5)
    assert grid.first().q == want
    some = [0.5, -2.5, 1e-7, -1.2345675, 123456.7890125, 1704718027228185.75, 1e300, 1e305, -1e305]
    rounded = spark.createDataFrame([(x,) for x in some], "x double").select(F.col("x"), sql_round(F.col("x"), 6).alias("r"))
    assert {r.x: r.r for r in rounded.collect()} == {x: duckdb.execute("SELECT round(?::double, 6)", [x]).fetchone()[0] for x in some}
