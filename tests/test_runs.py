"""Whole runs: an evaluation of planted defects, generated tables, the report."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabspark.operators import relational as R
from tabspark.plans import evaluate as E
from tabspark.plans.queries import Tables, _spec

SF = "/root/testdata/sf0.001"


def test_planted_defects_are_found(spark):
    t = Tables(spark, SF)
    source = t.side("orders", "o_orderkey", 0)
    scored = E.evaluate(source, t.planted(), _spec()).cache()
    by = {(r.metric_id, r.unit): r for r in scored.collect()}
    assert by["row.exact_match_rate_nonkey", "*"].status == "FAIL"
    assert by["field.category_adherence", "o_orderstatus"].value < 1
    same = {(r.metric_id, r.unit): r for r in E.evaluate(source, source, _spec()).collect()}
    assert same["column.tvd", "o_orderstatus"].value == 0 and same["column.ks", "o_totalprice"].status == "PASS"
    assert "row.exact_match_rate_nonkey" in E.report(scored) and '"FAIL"' in E.report_json(scored) and "column.ks" in E.render_catalogue()
    assert len({m for m, _ in by}) >= 40 and by["column.tvd", "o_orderstatus"].noise > 0
    edges = {r.metric_id: r.value for r in E.edge_metrics((source, t.customer), (t.planted(), t.customer), "o_custkey", "c_custkey", "orders", "orders->customer").collect()}
    assert edges["relationship.orphan_rate"] > 0


def test_generated_tables(spark):
    t = Tables(spark, SF)
    spec = E.TableSpec("orders", ["o_orderkey"], categorical=["o_orderstatus"], numeric=["o_totalprice"])
    made = E.generate_table(spark, t.orders, spec, 2000, "salt")
    again = E.generate_table(spark, t.orders, spec, 2000, "salt")
    assert made.count() == 2000 and made.exceptAll(again).isEmpty()
    low, high = t.orders.agg(F.min("o_totalprice"), F.max("o_totalprice")).first()
    assert made.where(~F.col("o_totalprice").between(low, high)).isEmpty()
    model = R.Model(["customer", "orders"], [R.Edge("orders", "customer", (("o_custkey", "c_custkey"),))])
    specs = {"customer": E.TableSpec("customer", ["c_custkey"], categorical=["c_mktsegment"], numeric=["c_acctbal"]), "orders": E.TableSpec("orders", ["o_orderkey"], categorical=["o_orderstatus"], numeric=["o_totalprice"], temporal=["o_orderdate"])}
    made = E.generate_model({"customer": t.customer, "orders": t.orders}, model, specs, "x", {"customer": 300})
    orphans = made["orders"].join(made["customer"], F.col("o_custkey") == F.col("c_custkey"), "left_anti")
    assert made["customer"].count() == 300 and orphans.isEmpty() and made["orders"].count() > 300
    assert set(made["orders"].columns) == {"o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"}
    first, last = t.orders.agg(F.min("o_orderdate").cast("timestamp"), F.max("o_orderdate").cast("timestamp")).first()
    assert made["orders"].where(~F.col("o_orderdate").between(first, last)).isEmpty()


def test_profile_frames(spark):
    frames = E.profile(Tables(spark, SF).orders, _spec())
    assert {r.column: r.kind for r in frames["kinds"].collect()}["o_orderstatus"] == "categorical"
    assert all(f.count() for f in frames.values())
