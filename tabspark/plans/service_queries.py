"""The named service queries over result tables derived from the test tables, each with the same statement in the other engine."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import service
from .queries import Tables, add

#: Result table: the test table and column that give its rows, and its columns as SQL for both
#: engines (``{t}`` stands for a time of so many seconds).
DERIVED = {
    "evaluations": ("orders", "'e' || (o_orderkey % 997) AS evaluation_id, {t}(o_orderkey) AS recorded_at, {t}(1000 * (o_orderkey % 997)) AS evaluated_at, CASE o_orderkey % 4 WHEN 0 THEN 'FINAL' WHEN 1 THEN 'RUNNING' WHEN 2 THEN 'FAILED' ELSE 'SKIPPED' END AS event, CASE o_orderkey % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'WARN' ELSE 'FAIL' END AS status, 'j' || (o_orderkey % 97) AS job_id, round(o_orderkey % 100 / 100, 2) AS overall_score"),
    "metrics": ("lineitem", "'e' || (l_orderkey % 997) AS evaluation_id, {t}(1000 * (l_orderkey % 997)) AS evaluated_at, 't' || (l_suppkey % 3) AS table_name, 'column' AS level, CASE l_linenumber % 2 WHEN 0 THEN 'fidelity' ELSE 'privacy' END AS family, 'm' || l_linenumber AS metric_id, 'c' || (l_partkey % 50) AS column_name, CASE WHEN l_linenumber > 5 THEN 'c' || (l_suppkey % 50) END AS column_name_2, cast(NULL AS {s}) AS edge, round(l_quantity, 2) AS value, round(l_discount, 2) AS score, l_returnflag AS status"),
    "profiles": ("part", "'e' || (p_partkey % 97) AS evaluation_id, {t}(1000 * (p_partkey % 97)) AS evaluated_at, 't' || (p_partkey % 3) AS table_name, 'c' || (p_partkey % 5) AS column_name, cast(NULL AS {s}) AS edge, CASE p_partkey % 2 WHEN 0 THEN 'topk' ELSE 'histogram' END AS profile_kind, CASE p_partkey % 7 WHEN 0 THEN 'source' ELSE 'synthetic' END AS side, p_name AS payload"),
    "flags": ("customer", "'e' || (c_custkey % 97) AS evaluation_id, {t}(1000 * (c_custkey % 97)) AS evaluated_at, 't' || (c_nationkey % 3) AS table_name, c_mktsegment AS check, cast(c_nationkey AS int) AS rank, c_name AS synthetic_key, round(c_acctbal, 2) AS distance"),
    "runs": ("orders", "'r' || (o_orderkey % 5000) || CASE WHEN o_orderkey % 3 = 0 THEN '-' || (o_orderkey % 9) ELSE '' END AS run_id, {t}(o_orderkey) AS created_at, 't' || (o_orderkey % 3) AS table_name, 'j' || (o_orderkey % 97) AS job_id, o_orderstatus AS status, round(o_orderkey % 10 / 10, 1) AS blocker_ratio"),
    "dlq": ("lineitem", "'r' || (l_orderkey % 50) AS run_id, 't' || (l_suppkey % 3) AS table_name, 'rule' || l_linenumber AS rule, l_linestatus AS severity, CASE WHEN l_linenumber < 3 THEN 'c1' END AS column_name, {t}(l_orderkey) AS created_at, l_returnflag AS message"),
    "source_stats": ("orders", "'f' || (o_orderkey % 7) AS table_fqn, 'd' || (o_orderkey % 5) AS reference_digest, 'r' || o_orderkey AS run_id, 'c' || (o_orderkey % 11) AS column, CASE o_orderkey % 2 WHEN 0 THEN 'exact' ELSE 'sample' END AS tier, {t}(o_orderkey) AS created_at, o_orderstatus AS stats"),
    "chunks": ("part", "'k' || (p_partkey % 500) AS chunk_id, 'd' || (p_partkey % 5) AS reference_digest, CASE p_partkey % 3 WHEN 0 THEN 'row_doc' ELSE 'free_text:p' END AS kind, p_name AS text, {t}(p_partkey) AS created_at, '{{\"table\":\"t' || (p_partkey % 4) || '\"}}' AS metadata"),
    "pools": ("supplier", "'d' || (s_suppkey % 6) AS reference_digest, 'm' || (s_suppkey % 2) AS model, 'c' || (s_suppkey % 9) AS column, cast(s_suppkey AS int) AS target, {t}(s_suppkey) AS created_at"),
}
#: Parameters of each query as it is registered; columns that hold times; columns that hold arrays.
REGISTERED = {
    "evaluations.list": ({"status": "PASS", "limit": 20, "offset": 10}, ["recorded_at", "evaluated_at"], []),
    "evaluations.count": ({"status": "WARN"}, [], []),
    "evaluations.events": ({"id": "e5"}, ["recorded_at", "evaluated_at"], []),
    "evaluations.latestByIds": ({"ids": "e1,e2,e900"}, ["recorded_at", "evaluated_at"], []),
    "evaluations.byJobId": ({"job": "j4"}, ["recorded_at", "evaluated_at"], []),
    "evaluations.slim": ({}, ["recorded_at", "evaluated_at"], []),
    "metrics.byEvaluation": ({"id": "e5"}, ["evaluated_at"], []),
    "metrics.byEvaluations": ({"ids": "e5,e6"}, ["evaluated_at"], []),
    "metrics.ids": ({}, [], []),
    "profiles.byEvaluation": ({"id": "e5", "kind": "topk"}, ["evaluated_at"], []),
    "flags.byEvaluation": ({"id": "e5"}, ["evaluated_at"], []),
    "trend": ({"metric": "m1", "table": "t1", "limit": 200_000}, ["evaluated_at"], []),
    "runs.list": ({"status": "F", "search": "R1", "limit": 30, "offset": 3}, ["created_at"], []),
    "runs.forEvaluation": ({"job": "j4", "run": "r7"}, ["created_at"], []),
    "runs.count": ({}, [], []),
    "dlq.summary": ({}, ["first_at", "last_at"], []),
    "sourceStats.tables": ({}, ["last_at"], ["tiers"]),
    "sourceStats.byTable": ({"table": "f3"}, ["created_at"], []),
    "rag.sets": ({}, [], ["tables"]),
    "rag.chunks": ({"digest": "d1", "limit": 40, "offset": 5}, ["created_at"], []),
    "rag.pools": ({"digest": "d1"}, ["created_at"], []),
    "rag.poolSets": ({}, [], []),
}


def result_tables(t: Tables) -> dict[str, DataFrame]:
    """The result tables, derived from the test tables."""
    quoted = lambda sql: sql.replace(" AS column,", " AS `column`,").replace(" AS check,", " AS `check`,")
    out = {}
    for name, (table, columns) in DERIVED.items():
        frame = getattr(t, table)
        out[name] = frame.selectExpr(*_split(quoted(columns.format(t="timestamp_seconds", s="string"))))
    return out


def _split(columns: str) -> list[str]:
    """The comma-separated expressions at the top level."""
    out, depth, text, at = [], 0, False, 0
    for i, c in enumerate(columns):
        text ^= c == "'"
        if not text:
            depth += (c == "(") - (c == ")")
            if c == "," and not depth:
                out.append(columns[at:i])
                at = i + 1
    return [*out, columns[at:]]


def other_engine(name: str) -> str:
    """The statement with its parameters as literals and its functions under the other engine's names."""
    sql, known = service.QUERIES[name]
    given, times, arrays = REGISTERED[name]
    for key, value in (known | given).items():
        sql = re.sub(rf":{key}\b", "NULL" if value is None else repr(value), sql)
    for a, b in (("* EXCEPT (", "* EXCLUDE ("), ("array_contains(split(", "list_contains(string_split("), ("array_sort(collect_set(", "list_sort(list(DISTINCT "), ("get_json_object(", "json_extract_string("), ("RLIKE concat('^', 'r7', '(-[0-9]+)?$')", "SIMILAR TO 'r7(-[0-9]+)?'")):
        sql = sql.replace(a, b)
    sql = re.sub(r"cast\(NULL AS timestamp\)", "NULL::timestamp", sql)
    named = lambda x: re.sub(r'(?<![\w"\'.])(column|check)(?![\w"\'])', r'"\1"', x)
    tables = ", ".join(f"{n} AS (SELECT {named(c.format(t='_ts', s='varchar'))} FROM {table})" for n, (table, c) in DERIVED.items() if re.search(rf"\b{n}\b", sql))
    tables = re.sub(r"_ts\(", "make_timestamp(1000000 * ", tables)
    replaced = [f"epoch_us({c}) AS {c}" for c in times] + [f"array_to_string({c}, ',') AS {c}" for c in arrays]
    return f"WITH {tables} SELECT * {f'REPLACE ({", ".join(replaced)})' if replaced else ''} FROM ({named(sql)})"


def _registered(name: str):
    given, times, arrays = REGISTERED[name]

    def query(t: Tables) -> DataFrame:
        service.register(t.spark, result_tables(t))
        out = service.run(t.spark, name, **given)
        return out.withColumns({c: F.unix_micros(c) for c in times} | {c: F.array_join(c, ",") for c in arrays})

    return query


for _name in service.QUERIES:
    add("service_" + _name.replace(".", "_"), other_engine(_name))(_registered(_name))
