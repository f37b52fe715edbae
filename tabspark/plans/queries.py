"""Registered queries and, for each, SQL that states the same result independently.

Sides are views of the test tables: rows with an even key are the source, rows with an odd
key the synthetic side. The planted side adds copies, orphans and blanks to the latter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources as S
from ..operators import compare as C
from ..operators import generate as G
from ..operators import membership as M
from ..operators import privacy as Y
from ..operators import profile as P
from ..operators import relational as R
from ..operators import scoring as K
from ..operators import validate as V
from ..operators import vectors as X
from ..streaming import events as E

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return S.read(self.spark, self.sf_dir, name)

    def side(self, name: str, key: str, odd: int) -> DataFrame:
        return getattr(self, name).where(F.col(key) % 2 == odd)

    def both(self, name: str, key: str) -> DataFrame:
        return C.sided(self.side(name, key, 0), self.side(name, key, 1))

    def planted(self) -> DataFrame:
        o = self.orders
        k = F.col("o_orderkey")
        parts = [
            o.where(k % 2 == 1),
            o.where(k % 40 == 0).withColumn("o_orderkey", k + 1_000_000_000),
            o.where(k % 200 == 0).withColumn("o_orderkey", k + 2_000_000_000).withColumn("o_custkey", F.col("o_custkey") + 10_000_000),
            o.where(k % 200 == 100).withColumn("o_orderkey", k + 3_000_000_000).withColumn("o_orderstatus", F.lit("")),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


PLANTED = """(SELECT * FROM orders WHERE o_orderkey % 2 = 1
 UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 40 = 0
 UNION ALL SELECT o_orderkey + 2000000000, o_custkey + 10000000, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 200 = 0
 UNION ALL SELECT o_orderkey + 3000000000, o_custkey, '', o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 200 = 100)"""
U = "(('0x' || substr(md5('{salt}|' || {key}::varchar), 1, 13))::bigint::double / 4503599627370496.0)"
H = "('0x' || substr(md5('{salt}|' || {key}::varchar), 1, 15))::bigint"


def add(name: str, sql: str | None):
    """Registers a function of :class:`Tables`, with its SQL where there is one."""

    def keep(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


# ---- scans, samples, scopes, windows ---------------------------------------------------

add("fanout_histogram", "SELECT k, count(*) AS parents FROM (SELECT c_custkey, count(o_orderkey) AS k FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey) GROUP BY k")(lambda t: R.fanout_histogram(t.orders, t.customer, "o_custkey", "c_custkey"))
add("reference_sample", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey::varchar) LIMIT 100")(lambda t: S.reference_sample(t.orders, F.col("o_orderkey"), 100).select("o_orderkey", "o_totalprice"))
add("panel_sample", "SELECT o_orderkey, rank, CASE WHEN rank <= (least(400, (SELECT count(*) FROM orders)) + 1) // 2 THEN 'R' ELSE 'H' END AS side, rank <= 50 AS exposed FROM (SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey::varchar)) AS rank FROM orders) WHERE rank <= 400")(lambda t: S.panel(t.orders.select("o_orderkey"), F.col("o_orderkey"), 200, 50).select("o_orderkey", F.col("rank").cast("long").alias("rank"), "side", "exposed"))
add("hash_band_sample", f"SELECT o_orderkey FROM orders WHERE {H.format(salt='band', key='o_orderkey')} % 100 < 7")(lambda t: S.hash_band(t.orders, F.col("o_orderkey"), "band", 7, 100).select("o_orderkey"))
add("scope_multiset_difference", "SELECT o_custkey, o_orderstatus FROM orders EXCEPT ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0")(lambda t: S.scope_diff(t.orders.select("o_custkey", "o_orderstatus"), t.orders.where("o_orderkey % 3 = 0").select("o_custkey", "o_orderstatus")))
add("latest_per_key", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")(lambda t: S.latest(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type"))
add("page_with_total", "SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders) AS total FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20 OFFSET 40")(lambda t: S.page(t.orders.select("o_orderkey", "o_totalprice"), [F.desc_nulls_last("o_totalprice"), F.asc("o_orderkey")], 20, 40))
add("frequent_values", "SELECT o_custkey::varchar AS value, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) >= 10")(lambda t: S.frequent_values(t.orders, "o_custkey", 10).select(F.col("value").cast("string").alias("value"), "n"))
add("key_pool", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL")(lambda t: S.key_pool(t.lineitem, ["l_partkey", "l_suppkey"]))
add("longest_runs", "WITH g AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS g FROM events) SELECT user_id, max(c) AS longest FROM (SELECT user_id, event_type, g, count(*) AS c FROM g GROUP BY ALL) GROUP BY user_id")(lambda t: P.runs(t.events, ["user_id"], [F.asc("ts"), F.asc("event_id")], "event_type"))
add("sequential_ids", "SELECT l_orderkey, count(*) AS n_steps, min(s) = max(s) AS constant FROM (SELECT l_orderkey, l_linenumber - lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS s FROM lineitem) WHERE s IS NOT NULL GROUP BY 1")(lambda t: P.steps(t.lineitem, "l_orderkey", "l_linenumber", "l_linenumber"))
add("flatten_union", "SELECT side, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM (SELECT 0 AS side, o_totalprice FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 1, o_totalprice FROM orders WHERE o_orderkey % 2 = 1) GROUP BY side")(lambda t: t.both("orders", "o_orderkey").groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")))

# ---- profiles ---------------------------------------------------------------------------

CUST = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
_long = lambda cols, table: " UNION ALL ".join(f"SELECT '{c}' AS col, {c}::varchar AS value FROM {table}" for c in cols)
add("column_counts", f'SELECT col AS "column", count(*) AS n_rows, count(*) FILTER (WHERE value IS NULL) AS n_null, count(*) FILTER (WHERE trim(value) = \'\') AS n_empty, count(DISTINCT value) AS n_distinct FROM ({_long(CUST, "customer")}) GROUP BY col')(lambda t: P.counts(t.customer, CUST))
MIX = ["o_orderstatus", "o_orderpriority"]
_share = f"SELECT col, value, c / sum(c) OVER (PARTITION BY col) AS p, c FROM (SELECT col, value, count(*) AS c FROM ({_long(MIX, 'orders')}) WHERE value IS NOT NULL GROUP BY ALL)"
add("value_mix", f'SELECT col AS "column", round(-sum(p * log2(p)), 6) AS entropy, CASE WHEN count(*) > 1 THEN round(-sum(p * log2(p)) / log2(count(*)), 6) ELSE 0.0 END AS entropy_norm, round(max(p), 6) AS top1_share FROM ({_share}) GROUP BY col')(lambda t: P.value_mix(t.orders, MIX))
add("top_values", f'SELECT col AS "column", value, c AS n, rank FROM (SELECT col, value, c, row_number() OVER (PARTITION BY col ORDER BY c DESC, value) AS rank FROM ({_share})) WHERE rank <= 3')(lambda t: P.top_values(t.orders, MIX, 3))
NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
add("numeric_profile", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n, count(*) FILTER (WHERE {c} = 0) AS zeros, min({c}) AS minimum, max({c}) AS maximum, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std, round(kurtosis_pop({c}), 4) AS kurtosis FROM lineitem" for c in NUM))(lambda t: P.numeric(t.lineitem, NUM))
add("nearest_deciles", "WITH o AS (SELECT l_quantity AS value, row_number() OVER (ORDER BY l_quantity) - 1 AS pos, count(*) OVER () AS n FROM lineitem WHERE l_quantity IS NOT NULL) SELECT i::int AS i, value FROM o JOIN (SELECT unnest(range(0, 11)) AS i) ON pos = round_even(i * (n - 1) / 10.0, 0)::bigint")(lambda t: P.deciles(t.lineitem, "l_quantity"))
add("percentiles", " UNION ALL ".join(f"SELECT {p} AS p, round(quantile_cont(l_extendedprice, {p}), 6) AS value FROM lineitem" for p in (0.05, 0.25, 0.5, 0.75, 0.95)))(lambda t: P.quantiles(t.lineitem, "l_extendedprice", [0.05, 0.25, 0.5, 0.75, 0.95]))
_len = "SELECT length(p_name) AS len, row_number() OVER (ORDER BY length(p_name)) - 1 AS pos, count(*) OVER () AS n FROM part WHERE p_name IS NOT NULL"
add("string_lengths", f"SELECT n, round(avg(len), 6) AS mean_length, max(len) FILTER (WHERE pos = floor(0.05 * (n - 1))) AS p05, max(len) FILTER (WHERE pos = floor(0.5 * (n - 1))) AS p50, max(len) FILTER (WHERE pos = floor(0.95 * (n - 1))) AS p95 FROM ({_len}) GROUP BY n")(lambda t: P.lengths(t.part, "p_name"))
MASK = "regexp_replace(regexp_replace(regexp_replace({c}, '[A-Z]', 'A', 'g'), '[a-z]', 'a', 'g'), '[0-9]', '9', 'g')"
add("shape_mix", f"SELECT CASE WHEN n / t >= 0.02 THEN mask ELSE '<tail>' END AS mask, sum(n)::bigint AS n, round(sum(n) / max(t), 6) AS share FROM (SELECT mask, n, sum(n) OVER () AS t FROM (SELECT {MASK.format(c='p_brand')} AS mask, count(*) AS n FROM part GROUP BY 1)) GROUP BY 1")(lambda t: P.shapes(t.part, "p_brand", 0.02).select("mask", "n", "share"))
add("null_patterns", "SELECT pattern, count(*) AS n FROM (SELECT CASE WHEN nullif(o_orderstatus, 'F') IS NULL THEN '1' ELSE '0' END || CASE WHEN nullif(o_orderpriority, '5-LOW') IS NULL THEN '1' ELSE '0' END AS pattern FROM orders) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 64")(lambda t: P.null_patterns(t.orders.select(F.expr("nullif(o_orderstatus, 'F')").alias("a"), F.expr("nullif(o_orderpriority, '5-LOW')").alias("b")), ["a", "b"], 64))
add("calendar_mix", "SELECT part, slot, count(*) AS n FROM (SELECT 'dow' AS part, isodow(ts) - 1 AS slot FROM events UNION ALL SELECT 'month', month(ts) - 1 FROM events UNION ALL SELECT 'hour', hour(ts) FROM events) GROUP BY ALL")(lambda t: P.calendar(t.events, "ts"))
add("column_kinds", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CASE WHEN count(DISTINCT {c}) = 1 AND count({c}) = count(*) THEN 'constant' WHEN '{g}' <> 'text' THEN CASE WHEN count(DISTINCT {c}) <= 20 THEN 'categorical' ELSE '{g}' END WHEN count(DISTINCT {c}) <= 50 THEN 'categorical' ELSE 'free_text' END AS kind, count(DISTINCT {c}) AS n_distinct FROM orders" for c, g in (("o_orderkey", "numeric"), ("o_orderstatus", "text"), ("o_totalprice", "numeric"), ("o_orderdate", "temporal"), ("o_orderpriority", "text"))))(lambda t: P.kinds(t.orders, ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]))
add("key_report", "SELECT sum(c)::bigint AS n_rows, count(*) AS n_keys, max(c) AS max_repeat FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)")(lambda t: P.key_report(t.lineitem, ["l_orderkey", "l_linenumber"]))
add("frequency_of_frequencies", "SELECT multiplicity, count(*) AS records FROM (SELECT count(*) AS multiplicity FROM lineitem GROUP BY l_partkey, l_suppkey) GROUP BY 1")(lambda t: M.frequency_of_frequencies(t.lineitem, ["l_partkey", "l_suppkey"]))
add("sketches", None)(lambda t: P.sketches(t.lineitem, "l_extendedprice"))
_row = "sha256(concat_ws('|', " + ", ".join(f"coalesce({c}::varchar, '\\N')" for c in sorted(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"])) + "))"
add("table_digest", "SELECT count(*) AS n, sha256(concat_ws(':', count(*)::varchar, " + ", ".join(f"sum(('0x' || substr(h, {1 + 15 * i}, 15))::bigint)::varchar" for i in range(4)) + f")) AS digest FROM (SELECT {_row} AS h FROM lineitem)")(lambda t: P.digest(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")))

# ---- two-sided distances -----------------------------------------------------------------

_census = "SELECT '{c}' AS col, {c}::varchar AS value, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS c_src, count(*) FILTER (WHERE o_orderkey % 2 = 1) AS c_syn FROM orders WHERE {c} IS NOT NULL GROUP BY {c}"
CEN = " UNION ALL ".join(_census.format(c=c) for c in ["o_orderstatus", "o_orderpriority", "o_custkey"])
SHARES = f"SELECT *, c_src / sum(c_src) OVER (PARTITION BY col) AS p, c_syn / sum(c_syn) OVER (PARTITION BY col) AS q, sum(c_src) OVER (PARTITION BY col) AS n_src, sum(c_syn) OVER (PARTITION BY col) AS n_syn, count(*) OVER (PARTITION BY col) AS k FROM ({CEN})"
CENSUS = ["o_orderstatus", "o_orderpriority", "o_custkey"]
add("value_census", f'SELECT col AS "column", value, c_src, c_syn FROM ({CEN})')(lambda t: C.census(t.both("orders", "o_orderkey"), CENSUS))
add("frequency_distances", f"""SELECT col AS "column", round(sum(abs(p - q)) / 2, 6) AS tvd, round(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 6) AS jsd,
 round(sqrt(greatest(0.0, 1 - sum(sqrt(p * q)))), 6) AS hellinger, round(sqrt(sum(CASE WHEN p > 0 THEN (q - p) * (q - p) / p ELSE 0 END)), 6) AS cohens_w,
 round(sum(((c_syn + 0.5::double) / (n_syn + 0.5::double * k) - (c_src + 0.5::double) / (n_src + 0.5::double * k)) * ln(((c_syn + 0.5::double) / (n_syn + 0.5::double * k)) / ((c_src + 0.5::double) / (n_src + 0.5::double * k)))), 6) AS psi FROM ({SHARES}) GROUP BY col""")(lambda t: C.frequency_distances(C.census(t.both("orders", "o_orderkey"), CENSUS), "column"))
add("value_diversity", f"""SELECT col AS "column", round(-sum(CASE WHEN p > 0 THEN p * log2(p) ELSE 0 END), 6) AS entropy_src, round(-sum(CASE WHEN q > 0 THEN q * log2(q) ELSE 0 END), 6) AS entropy_syn,
 round(-sum(CASE WHEN p > 0 THEN p * log2(p) ELSE 0 END) + (count(*) FILTER (WHERE p > 0) - 1) / (2 * max(n_src) * ln(2)), 6) AS miller_madow_src, count(*) FILTER (WHERE p > 0) AS distinct_src, count(*) FILTER (WHERE q > 0) AS distinct_syn,
 round(sum(CASE WHEN q > 0 THEN p ELSE 0 END), 6) AS coverage, round(sum(CASE WHEN p = 0 THEN q ELSE 0 END), 6) AS novelty, round(sum(CASE WHEN p > 0 THEN q ELSE 0 END), 6) AS adherence, round(abs(max(p) - max(q)), 6) AS top1_delta, count(*) FILTER (WHERE c_src = 1) AS singletons_src FROM ({SHARES}) GROUP BY col""")(lambda t: C.diversity(C.census(t.both("orders", "o_orderkey"), CENSUS), "column"))
EDGES = [50_000.0, 100_000.0, 150_000.0, 200_000.0, 300_000.0, 400_000.0]
_bin = f"(SELECT b.bin, count(o_orderkey) FILTER (WHERE o_orderkey % 2 = 0) AS c_src, count(o_orderkey) FILTER (WHERE o_orderkey % 2 = 1) AS c_syn FROM (SELECT unnest(range(0, {len(EDGES) + 1})) AS bin) b LEFT JOIN orders ON len(list_filter({EDGES}, lambda e: e < o_totalprice)) = b.bin GROUP BY b.bin)"
add("edge_histogram", f"SELECT bin, c_src, c_syn FROM {_bin}")(lambda t: C.binned(t.both("orders", "o_orderkey"), F.col("o_totalprice"), EDGES))
_cdf = f"SELECT *, sum(p) OVER (ORDER BY bin) AS fp, sum(q) OVER (ORDER BY bin) AS fq, CASE {' '.join(f'WHEN bin = {i} THEN {b - a}' for i, (a, b) in enumerate(zip(EDGES, EDGES[1:], strict=False)))} ELSE 0 END AS w FROM (SELECT *, c_src / sum(c_src) OVER () AS p, c_syn / sum(c_syn) OVER () AS q, sum(c_src) OVER () AS ns, sum(c_syn) OVER () AS nt FROM {_bin})"
_a, _b = f"((c_src + 0.5::double) / (ns + 0.5::double * {len(EDGES) + 1}))", f"((c_syn + 0.5::double) / (nt + 0.5::double * {len(EDGES) + 1}))"
add("binned_distances", f"SELECT round(max(abs(fp - fq)), 6) AS ks, round(max(greatest(abs(fp - fq), abs(fp - p - fq + q), abs(fp - fq + q), abs(fp - p - fq))), 6) AS ks_high, round(sum(w * abs(fp - fq)), 6) AS w1, round(sum(p * abs((fp - p / 2) - (fq - q / 2))), 6) AS pit_w1, round(sum(({_b} - {_a}) * ln({_b} / {_a})), 6) AS psi FROM ({_cdf})")(lambda t: C.binned_distances(C.binned(t.both("orders", "o_orderkey"), F.col("o_totalprice"), EDGES), EDGES))
_mom = "SELECT '{c}' AS \"column\", round(abs(a1 - a0) / s0, 6) AS smd, round(s1 / s0, 6) AS std_ratio, round(greatest(0.0, least(x0, x1) - greatest(m0, m1)) / (x0 - m0), 6) AS range_coverage, (SELECT round(avg(({c} BETWEEN m0 AND x0)::int), 6) FROM lineitem WHERE l_orderkey % 2 = 1) AS range_adherence FROM (SELECT avg({c}) FILTER (WHERE l_orderkey % 2 = 0) AS a0, avg({c}) FILTER (WHERE l_orderkey % 2 = 1) AS a1, stddev_pop({c}) FILTER (WHERE l_orderkey % 2 = 0) AS s0, stddev_pop({c}) FILTER (WHERE l_orderkey % 2 = 1) AS s1, min({c}) FILTER (WHERE l_orderkey % 2 = 0) AS m0, min({c}) FILTER (WHERE l_orderkey % 2 = 1) AS m1, max({c}) FILTER (WHERE l_orderkey % 2 = 0) AS x0, max({c}) FILTER (WHERE l_orderkey % 2 = 1) AS x1 FROM lineitem)"
add("moment_deltas", " UNION ALL ".join(_mom.format(c=c) for c in NUM))(lambda t: C.moment_deltas(t.both("lineitem", "l_orderkey"), NUM))
add("rate_deltas", f"SELECT round(abs(max(n) FILTER (WHERE s = 1) - max(n) FILTER (WHERE s = 0)), 6) AS null_rate_delta, round(abs(max(e) FILTER (WHERE s = 1) - max(e) FILTER (WHERE s = 0)), 6) AS empty_rate_delta, round(abs(max(z) FILTER (WHERE s = 1) - max(z) FILTER (WHERE s = 0)), 6) AS zero_rate_delta FROM (SELECT s, count(*) FILTER (WHERE x IS NULL) / count(*) AS n, count(*) FILTER (WHERE trim(x) = '') / count(*) AS e, count(*) FILTER (WHERE try_cast(x AS double) = 0) / count(*) AS z FROM (SELECT 0 AS s, o_orderstatus AS x FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 1, o_orderstatus FROM {PLANTED}) GROUP BY s)")(lambda t: C.rates(C.sided(t.side("orders", "o_orderkey", 0), t.planted()), "o_orderstatus"))
add("char_class_l1", "SELECT round(" + " + ".join(f"abs(avg(regexp_matches(c_name, '{r}')::int) FILTER (WHERE c_custkey % 2 = 0) - avg(regexp_matches(c_name, '{r}')::int) FILTER (WHERE c_custkey % 2 = 1))" for r in ("[A-Z]", "[a-z]", "[0-9]", "[ \\t\\n\\r]", "[^A-Za-z0-9 \\t\\n\\r]")) + ", 6) AS char_class_l1 FROM customer")(lambda t: C.char_classes(t.both("customer", "c_custkey"), "c_name"))
add("shape_head_tv", f"WITH m AS (SELECT {MASK.format(c='p_name')} AS mask, count(*) FILTER (WHERE p_partkey % 2 = 0) AS a, count(*) FILTER (WHERE p_partkey % 2 = 1) AS b FROM part GROUP BY 1), s AS (SELECT mask, a / sum(a) OVER () AS p, b / sum(b) OVER () AS q FROM m), h AS (SELECT CASE WHEN p >= 0.02 THEN mask ELSE '<tail>' END AS g, sum(p) AS p, sum(q) AS q, sum(abs(p - q)) AS raw FROM s GROUP BY 1) SELECT round(sum(raw) / 2, 6) AS shape_tv, round(sum(abs(p - q)) / 2, 6) AS shape_head_tv FROM h")(lambda t: C.shape_head_tv(t.both("part", "p_partkey"), "p_name", 0.02))
add("calendar_tvd", "SELECT part, round(sum(abs(p - q)) / 2, 6) AS tvd FROM (SELECT part, slot, sum(a) / sum(sum(a)) OVER (PARTITION BY part) AS p, sum(b) / sum(sum(b)) OVER (PARTITION BY part) AS q FROM (SELECT 'dow' AS part, isodow(o_orderdate) AS slot, (o_orderkey % 2 = 0)::int AS a, (o_orderkey % 2 = 1)::int AS b FROM orders UNION ALL SELECT 'month', month(o_orderdate), (o_orderkey % 2 = 0)::int, (o_orderkey % 2 = 1)::int FROM orders) GROUP BY part, slot) GROUP BY part")(
    lambda t: C.frequency_distances(
        P.calendar(t.side("orders", "o_orderkey", 0), "o_orderdate").select("part", "slot", F.col("n").alias("c_src"), F.lit(0).cast("long").alias("c_syn")).union(P.calendar(t.side("orders", "o_orderkey", 1), "o_orderdate").select("part", "slot", F.lit(0).cast("long").alias("c_src"), F.col("n").alias("c_syn"))).groupBy("part", "slot").agg(F.sum("c_src").alias("c_src"), F.sum("c_syn").alias("c_syn")).where("part <> 'hour'"),
        "part",
    ).select("part", "tvd")
)
PAIRS = [("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_extendedprice", "l_tax")]
_prs = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) FILTER (WHERE l_orderkey % 2 = 0) AS x, corr({a}, {b}) FILTER (WHERE l_orderkey % 2 = 1) AS y FROM lineitem" for a, b in PAIRS)
add("pearson_deltas", f"SELECT a, b, round(x, 6) AS pearson_src, round(y, 6) AS pearson_syn, round(abs(y - x), 6) AS pearson_delta FROM ({_prs})")(lambda t: C.pearson(t.both("lineitem", "l_orderkey"), PAIRS))
add("correlation_summary", f"SELECT round(sqrt(avg(d * d)), 5) AS corr_rms_delta, round(max(d), 6) AS corr_max_delta FROM (SELECT round(abs(y - x), 6) AS d FROM ({_prs}))")(lambda t: C.correlation_summary(C.pearson(t.both("lineitem", "l_orderkey"), PAIRS)))
_rk = "SELECT l_orderkey % 2 AS side, rank() OVER (PARTITION BY l_orderkey % 2 ORDER BY {a}) + (count(*) OVER (PARTITION BY l_orderkey % 2, {a}) - 1) / 2 AS ra, rank() OVER (PARTITION BY l_orderkey % 2 ORDER BY {b}) + (count(*) OVER (PARTITION BY l_orderkey % 2, {b}) - 1) / 2 AS rb FROM lineitem"
add("spearman", f"SELECT side::int AS side, round(corr(ra, rb), 6) AS spearman FROM ({_rk.format(a='l_quantity', b='l_extendedprice')}) GROUP BY side")(lambda t: C.spearman(t.both("lineitem", "l_orderkey"), "l_quantity", "l_extendedprice"))
add("contingency", "WITH c AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*)::double AS c FROM lineitem GROUP BY ALL), t AS (SELECT *, sum(c) OVER (PARTITION BY a) AS ra, sum(c) OVER (PARTITION BY b) AS rb, sum(c) OVER () AS n, (SELECT count(DISTINCT a) FROM c)::double AS ka, (SELECT count(DISTINCT b) FROM c)::double AS kb FROM c), o AS (SELECT max(n) AS n, max(ka) AS ka, max(kb) AS kb, sum(c * c / (ra * rb / n)) - max(n) AS chi2, sum(c / n * ln((c / n) / (ra / n * rb / n))) AS mi, -sum(c / n * ln(ra / n)) AS ha, -sum(c / n * ln(rb / n)) AS hb FROM t) SELECT round(chi2, 4) AS chi2, round(sqrt(greatest(0.0, chi2 / n - (ka - 1) * (kb - 1) / (n - 1)) / least(ka - (ka - 1) * (ka - 1) / (n - 1) - 1, kb - (kb - 1) * (kb - 1) / (n - 1) - 1)), 6) AS cramers_v, round(mi / least(ha, hb), 6) AS nmi FROM o")(lambda t: C.contingency(t.lineitem, "l_returnflag", "l_linestatus"))
add("contingency_tvd", "SELECT round(sum(abs(a / (sum_a) - b / (sum_b))) / 2, 6) AS contingency_tvd FROM (SELECT a, b, sum(a) OVER () AS sum_a, sum(b) OVER () AS sum_b FROM (SELECT count(*) FILTER (WHERE l_orderkey % 2 = 0) AS a, count(*) FILTER (WHERE l_orderkey % 2 = 1) AS b FROM lineitem GROUP BY l_returnflag, l_linestatus))")(lambda t: C.joint_tvd(t.both("lineitem", "l_orderkey"), "l_returnflag", "l_linestatus"))
add("value_overlap", "WITH a AS (SELECT DISTINCT c_nationkey AS v FROM customer), b AS (SELECT DISTINCT s_nationkey AS v FROM supplier) SELECT (SELECT count(*) FROM (SELECT v FROM a INTERSECT SELECT v FROM b)) AS common, (SELECT count(*) FROM (SELECT v FROM a UNION SELECT v FROM b)) AS either, round((SELECT count(*) FROM (SELECT v FROM a INTERSECT SELECT v FROM b)) / (SELECT count(*) FROM (SELECT v FROM a UNION SELECT v FROM b)), 6) AS jaccard")(lambda t: C.value_overlap(t.customer, t.supplier, "c_nationkey", "s_nationkey"))

# ---- relations ---------------------------------------------------------------------------

add("orphan_rate", f"SELECT count(*) AS n, count(*) FILTER (WHERE c_custkey IS NULL) AS orphans, round(count(*) FILTER (WHERE c_custkey IS NULL) / count(*), 6) AS orphan_rate FROM {PLANTED} LEFT JOIN customer ON o_custkey = c_custkey WHERE o_custkey IS NOT NULL")(lambda t: R.orphan_rate(t.planted(), t.customer, "o_custkey", "c_custkey"))
add("orphan_rows", f"SELECT o_orderkey FROM {PLANTED} p WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = p.o_custkey)")(lambda t: R.orphans(t.planted(), t.customer, ["o_custkey"], ["c_custkey"]).select("o_orderkey"))
_fan = "SELECT c_custkey, count(o_orderkey) FILTER (WHERE o_orderkey % 2 = {s}) AS k FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey"
add("fanout_metrics", f"WITH a AS ({_fan.format(s=0)}), b AS ({_fan.format(s=1)}), h AS (SELECT b, sum(x) AS x, sum(y) AS y FROM (SELECT least(k, 50) AS b, count(*) AS x, 0 AS y FROM a GROUP BY 1 UNION ALL SELECT least(k, 50), 0, count(*) FROM b GROUP BY 1) GROUP BY b) SELECT (SELECT round(sum(abs(x / (SELECT count(*) FROM a) - y / (SELECT count(*) FROM b))) / 2, 6) FROM h) AS fanout_tvd, round((SELECT avg(k) FROM b) / (SELECT avg(k) FROM a), 6) AS fanout_mean_ratio, round(abs((SELECT avg((k = 0)::int) FROM b) - (SELECT avg((k = 0)::int) FROM a)), 6) AS zero_child_share_delta, round((SELECT avg((k > 0)::int) FROM b) / (SELECT avg((k > 0)::int) FROM a), 6) AS parent_coverage, (SELECT round(avg((k BETWEEN (SELECT min(k) FROM a) AND (SELECT max(k) FROM a))::int), 6) FROM b) AS cardinality_adherence")(lambda t: R.fanout_metrics(R.fanout(t.side("orders", "o_orderkey", 0), t.customer, "o_custkey", "c_custkey").select("k"), R.fanout(t.side("orders", "o_orderkey", 1), t.customer, "o_custkey", "c_custkey").select("k")))
add("key_cells", "SELECT l_linenumber, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL")(lambda t: R.cells(t.lineitem, ["l_linenumber", "l_returnflag"]))
add("distinct_tuples", "SELECT count(*) AS n_tuples FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL)")(lambda t: R.distinct_tuples(t.lineitem, ["l_partkey", "l_suppkey"]))

# ---- membership --------------------------------------------------------------------------

MEM = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
_cols = ", ".join(MEM)
add("exact_matches", f"SELECT count(*) AS n, count(*) FILTER (WHERE m) AS matches, round(count(*) FILTER (WHERE m) / count(*), 6) AS rate FROM (SELECT ({_cols}) IN (SELECT ({_cols}) FROM orders WHERE o_orderkey % 2 = 0) AS m FROM {PLANTED})")(lambda t: M.exact_matches(t.planted(), t.side("orders", "o_orderkey", 0), MEM))
_near = " OR ".join("EXISTS (SELECT 1 FROM src s WHERE " + " AND ".join(f"s.{c} {'<>' if c == x else '='} p.{c}" for c in MEM) + ")" for x in MEM)
add("near_matches", f"WITH src AS (SELECT * FROM orders WHERE o_orderkey % 2 = 0), p AS (SELECT * FROM {PLANTED}) SELECT count(*) AS n, count(*) FILTER (WHERE ({_near}) AND ({_cols}) NOT IN (SELECT ({_cols}) FROM src)) AS near FROM p")(lambda t: M.near_matches(t.planted(), t.side("orders", "o_orderkey", 0), MEM))
add("memorization_lifts", f"WITH pan AS (SELECT o_custkey, o_orderstatus, CASE WHEN rank <= (least(6000, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0)) + 1) // 2 THEN 'R' ELSE 'H' END AS side FROM (SELECT *, row_number() OVER (ORDER BY md5(o_orderkey::varchar)) AS rank FROM orders WHERE o_orderkey % 2 = 0) WHERE rank <= 6000), k AS (SELECT o_custkey, o_orderstatus, max((side = 'R')::int) AS r, max((side = 'H')::int) AS h FROM pan GROUP BY ALL), j AS (SELECT k.*, EXISTS (SELECT 1 FROM {PLANTED} p WHERE p.o_custkey = k.o_custkey AND p.o_orderstatus = k.o_orderstatus) AS s FROM k), c AS (SELECT count(*) FILTER (WHERE r = 1 AND h = 0) AS r_only, count(*) FILTER (WHERE h = 1 AND r = 0) AS h_only, count(*) FILTER (WHERE r = 1 AND h = 0 AND s) AS r_hit, count(*) FILTER (WHERE h = 1 AND r = 0 AND s) AS h_hit FROM j) SELECT *, CASE WHEN h_hit > 0 THEN round((r_hit / r_only) / (h_hit / h_only), 6) END AS lift FROM c")(lambda t: M.lifts(t.planted(), S.panel(t.side("orders", "o_orderkey", 0), F.col("o_orderkey"), 3000, 100), ["o_custkey", "o_orderstatus"]))
add("duplicate_rate", f"SELECT count(*) AS n, coalesce(sum(c) FILTER (WHERE c > 1), 0)::bigint AS duplicates, round(coalesce(sum(c) FILTER (WHERE c > 1), 0) / sum(c), 6) AS rate FROM (SELECT o_custkey, o_totalprice, count(*) AS c FROM {PLANTED} GROUP BY ALL)".replace("SELECT count(*) AS n,", "SELECT sum(c)::bigint AS n,"))(lambda t: M.duplicate_rate(t.planted(), ["o_custkey", "o_totalprice"]))
add("substantive_copies", f"""SELECT 'o_totalprice' AS "column", coalesce(sum(t) FILTER (WHERE s BETWEEN 1 AND 9), 0)::bigint AS copies, sum(t)::bigint AS n FROM (SELECT v, count(*) FILTER (WHERE side = 0) AS s, count(*) FILTER (WHERE side = 1) AS t FROM (SELECT o_totalprice AS v, 0 AS side FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_totalprice, 1 FROM {PLANTED}) WHERE v IS NOT NULL GROUP BY v)""")(lambda t: C.substantive_copies(C.sided(t.side("orders", "o_orderkey", 0), t.planted()), ["o_totalprice"], 10))

# ---- validation --------------------------------------------------------------------------


def _ruled(t: Tables) -> DataFrame:
    p = t.planted()
    gate = V.orphan_gate(p, t.customer, ["o_custkey"], ["c_custkey"])
    return V.rule_violations(gate, {"pk.null": F.col("o_orderkey").isNull(), "schema.blank": F.col("o_orderstatus") == "", "fk.orphan": F.col("orphan"), "range.price": F.col("o_totalprice") > 400_000})


RULED = f"(SELECT p.*, CASE WHEN o_orderkey IS NULL THEN 'pk.null' WHEN o_orderstatus = '' THEN 'schema.blank' WHEN o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = p.o_custkey) THEN 'fk.orphan' WHEN o_totalprice > 400000 THEN 'range.price' END AS rule FROM {PLANTED} p)"
add("record_rules", f"SELECT rule, count(*) AS n FROM {RULED} WHERE rule IS NOT NULL GROUP BY rule")(lambda t: _ruled(t).where("rule IS NOT NULL").groupBy("rule").agg(F.count(F.lit(1)).alias("n")))
add("run_summary", f"WITH w AS (SELECT sum(CASE WHEN rule = 'fk.orphan' THEN 3 ELSE 1 END) FILTER (WHERE rule IS NOT NULL AND rule <> 'range.price') AS b, count(*) FILTER (WHERE rule IS NULL) AS v FROM {RULED}) SELECT b::bigint AS blockers, (b + v)::bigint AS total, round(b / (b + v), 6) AS ratio, CASE WHEN b / (b + v) > 0.05 THEN 'FAILED' ELSE 'PASSED' END AS status FROM w")(
    lambda t: V.run_summary(_ruled(t), {"fk.orphan": F.lit(3)}, ["range.price"], 0.05)
)
add("dead_letters", f"SELECT rule, count(*) AS n, count(DISTINCT o_orderkey) AS n_payloads FROM {RULED} WHERE rule IS NOT NULL GROUP BY rule")(lambda t: V.dead_letters(_ruled(t)).groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.get_json_object("payload", "$.o_orderkey")).alias("n_payloads")))
UNI = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderkey"]
_dig = "md5(concat_ws('|', coalesce(o_custkey::varchar, 'None'), coalesce(o_orderstatus, 'None'), coalesce(o_orderpriority, 'None')))"
add("uniqueness", f"""WITH a AS (SELECT o_custkey, o_orderstatus, o_orderpriority, o_orderkey, {_dig} AS d, o_orderkey::varchar AS i, concat_ws('|', o_custkey::varchar, o_orderstatus) AS k FROM orders), b AS (SELECT *, (row_number() OVER (PARTITION BY d ORDER BY i) > 1)::int AS s1 FROM a), c AS (SELECT *, greatest(s1, (row_number() OVER (PARTITION BY k ORDER BY s1, d, i) > 1)::int) AS s2 FROM b), e AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY s2, d, k) AS o FROM c)
 SELECT CASE WHEN s1 = 1 THEN 'duplicate.row' WHEN s2 = 1 THEN 'duplicate.pk' WHEN o > 1 THEN 'duplicate.identity' ELSE 'ok' END AS verdict, count(*) AS n, min(o_orderkey) AS first_key FROM e GROUP BY 1""")(lambda t: V.unique(t.orders.select(*UNI), ["o_custkey", "o_orderstatus"], ["o_orderkey"]).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key")))
add("uniqueness_counts", "SELECT (SELECT count(*) FROM lineitem) AS n, (SELECT sum(c - 1) FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber))::bigint AS row_excess, (SELECT sum(c - 1) FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey))::bigint AS pk_excess, (SELECT sum(c - 1) FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_linenumber))::bigint AS identity_excess")(lambda t: V.unique_counts(t.lineitem.select("l_orderkey", "l_linenumber"), ["l_orderkey"], ["l_linenumber"]))

# ---- scoring -----------------------------------------------------------------------------

_W = "SELECT o_orderpriority, count(*)::double AS n, (count(*) FILTER (WHERE o_orderstatus = 'F'))::double AS k FROM orders GROUP BY 1"
_z = repr(K.Z)
_wl = "(({k} / {n} + {z} * {z} / (2 * {n})) {s} {z} * sqrt({k} / {n} * (1 - {k} / {n}) / {n} + {z} * {z} / (4 * {n} * {n}))) / (1 + {z} * {z} / {n})"


def _counted(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).cast("double").alias("n"), F.count_if(F.col("o_orderstatus") == "F").cast("double").alias("k"))


add("wilson_intervals", f"SELECT o_orderpriority, round({_wl.format(k='k', n='n', z=_z, s='-')}, 6) AS low, round({_wl.format(k='k', n='n', z=_z, s='+')}, 6) AS high FROM ({_W})")(lambda t: _counted(t).select("o_orderpriority", F.round(K.wilson(F.col("k"), F.col("n"))[0], 6).alias("low"), F.round(K.wilson(F.col("k"), F.col("n"))[1], 6).alias("high")))
add("noise_floors", f"SELECT o_orderpriority, round(sqrt(ln(40.0) / (2 * n)), 6) AS dkw, round(sqrt(-ln(0.025) / 2) * sqrt((n + 500) / (n * 500)), 6) AS ks, round({_z} * sqrt(1 / (n - 3) + 1 / 497.0::double), 6) AS fisher FROM ({_W})")(lambda t: _counted(t).select("o_orderpriority", F.round(K.dkw(F.col("n")), 6).alias("dkw"), F.round(K.ks_critical(F.col("n"), F.lit(500.0)), 6).alias("ks"), F.round(K.fisher_floor(F.col("n"), F.lit(500.0)), 6).alias("fisher")))
METRICS = [("column.ks", "orders", "o_totalprice", 0.15, 0.2), ("column.tvd", "orders", "o_orderstatus", 0.15, 0.01), ("column.std_ratio", "orders", "o_totalprice", 1.3, 0.0), ("relationship.orphan_rate", "orders", "customer", 0.01, 0.5), ("row.exact_match_rate", "orders", "*", 0.0, 0.0), ("column.wasserstein", "orders", "o_totalprice", 9.0, 0.0), ("row.coverage", "customer", "*", 0.75, 0.0), ("column.psi", "customer", "c_acctbal", None, 0.0)]
_mv = "(VALUES " + ", ".join(f"('{m}', '{tb}', '{u}', {'NULL' if v is None else f'{v}::double'}, {n}::double)" for m, tb, u, v, n in METRICS) + ") AS m(metric_id, table_name, unit, value, noise)"
_cv = "(VALUES " + ", ".join(f"('{m}', '{f}', '{d}', {t}::double, {'NULL' if w is None else f'{w}::double'}, {'NULL' if x is None else f'{x}::double'})" for m, f, d, t, w, x in K.CATALOGUE) + ") AS c(metric_id, family, direction, target, warn, fail)"
_dist = "(CASE WHEN direction = 'T' THEN abs(value - target) ELSE value END)"
_within = f"(CASE WHEN direction = 'H' THEN target - {_dist} <= noise WHEN direction = 'T' THEN {_dist} <= noise ELSE {_dist} - target <= noise END)"
_cross = lambda x: f"(CASE WHEN direction = 'H' THEN {_dist} <= {x} + 1e-9 * greatest(abs({x}), 1) ELSE {_dist} >= {x} - 1e-9 * greatest(abs({x}), 1) END)"
_off = "(CASE WHEN direction = 'H' THEN greatest(0, target - value) WHEN direction = 'T' THEN abs(value - target) ELSE greatest(0, value - target) END)"
_span = "(CASE WHEN direction = 'T' THEN fail ELSE abs(fail - target) END)"
SCORED = f"(SELECT *, CASE WHEN status IN ('NOT_EVALUATED', 'INFO') THEN NULL WHEN {_span} > 0 THEN round(greatest(0.0, 1 - {_off} / (2 * {_span})), 6) ELSE ({_off} <= 0)::int::double END AS score FROM (SELECT m.*, family, direction, target, warn, fail, CASE WHEN value IS NULL THEN 'NOT_EVALUATED' WHEN warn IS NULL OR fail IS NULL THEN 'INFO' WHEN warn = 0 AND fail = 0 THEN CASE WHEN value > 0 THEN 'FAIL' ELSE 'PASS' END WHEN {_cross('fail')} AND NOT {_within} THEN 'FAIL' WHEN {_cross('warn')} AND NOT {_within} THEN 'WARN' ELSE 'PASS' END AS status FROM {_mv} LEFT JOIN {_cv} USING (metric_id)))"


def _scored(t: Tables) -> DataFrame:
    return K.scored(t.spark.createDataFrame(METRICS, "metric_id string, table_name string, unit string, value double, noise double"))


add("metric_scores", f"SELECT metric_id, table_name, unit, status, score FROM {SCORED}")(lambda t: _scored(t).select("metric_id", "table_name", "unit", "status", "score"))
add("score_rollup", f"WITH u AS (SELECT table_name, family, unit, avg(score) AS s FROM {SCORED} WHERE score IS NOT NULL GROUP BY ALL), f AS (SELECT table_name, family, avg(s) AS s FROM u GROUP BY ALL), t AS (SELECT table_name, avg(s) AS s FROM f GROUP BY ALL) SELECT 'family' AS level, table_name, family, round(s, 6) AS score FROM f UNION ALL SELECT 'table', table_name, NULL, round(s, 6) FROM t UNION ALL SELECT 'model', NULL, NULL, round(avg(s), 6) FROM t")(lambda t: K.rollup(_scored(t)))
add("headline_counts", f"SELECT status, count(*) AS n FROM {SCORED} GROUP BY status")(lambda t: K.headline(_scored(t)))
add("metric_catalogue", f"SELECT * FROM {_cv}")(lambda t: K.catalogue(t.spark))
add("compare_runs", "WITH a AS (SELECT o_custkey AS k, NULLIF(o_orderstatus, 'F') AS s, round(sum(o_totalprice), 2) AS value FROM orders WHERE o_orderkey % 2 = 0 GROUP BY ALL), b AS (SELECT o_custkey AS k, NULLIF(o_orderstatus, 'F') AS s, round(sum(o_totalprice), 2) AS value FROM orders WHERE o_orderkey % 2 = 1 OR o_orderkey % 3 = 0 GROUP BY ALL) SELECT coalesce(a.k, b.k) AS k, coalesce(a.s, b.s) AS s, a.value AS value_a, b.value AS value_b, round(b.value - a.value, 2) AS delta, CASE WHEN a.value IS NULL THEN 'added' WHEN b.value IS NULL THEN 'removed' WHEN a.value = b.value THEN 'same' ELSE 'changed' END AS change FROM a FULL OUTER JOIN b ON a.k IS NOT DISTINCT FROM b.k AND a.s IS NOT DISTINCT FROM b.s")(
    lambda t: K.compare_runs(*[t.orders.where(m).groupBy(F.col("o_custkey").alias("k"), F.expr("nullif(o_orderstatus, 'F')").alias("s")).agg(F.round(F.sum("o_totalprice"), 2).alias("value")) for m in ("o_orderkey % 2 = 0", "o_orderkey % 2 = 1 OR o_orderkey % 3 = 0")], ["k", "s"]).withColumn("delta", F.round("delta", 2))
)

# ---- generation --------------------------------------------------------------------------

_cum = "SELECT v, sum(c) OVER (ORDER BY v) - c AS lo, sum(c) OVER (ORDER BY v) AS hi, sum(c) OVER () AS n FROM (SELECT c_mktsegment AS v, count(*) AS c FROM customer GROUP BY 1)"
add("categorical_draw", f"WITH w AS ({_cum}), d AS (SELECT o_orderkey, {U.format(salt='seg', key='o_orderkey')} AS u FROM orders) SELECT o_orderkey, v AS c_mktsegment FROM d JOIN w ON u >= lo / n AND u < hi / n")(lambda t: G.categorical(t.orders.select("o_orderkey"), t.customer, "c_mktsegment", "o_orderkey", "seg"))
add("inverse_cdf_draw", f"WITH q AS (SELECT quantile_cont(c_acctbal, {[i / 20 for i in range(21)]}) AS q FROM customer), d AS (SELECT o_orderkey, {U.format(salt='bal', key='o_orderkey')} * 20 AS x FROM orders) SELECT o_orderkey, round(q[floor(x)::int + 1] + (q[least(floor(x)::int + 2, 21)] - q[floor(x)::int + 1]) * (x - floor(x)), 4) AS balance FROM d, q")(lambda t: G.numeric(t.orders.select("o_orderkey"), G.quantile_grid(t.customer, "c_acctbal", 21), "balance", "o_orderkey", "bal").withColumn("balance", F.round("balance", 4)))
add("pool_draw", f"SELECT o_orderkey, CASE WHEN {U.format(salt='pool|null', key='o_orderkey')} >= 0.1 THEN ['red', 'green', 'blue'][{H.format(salt='pool', key='o_orderkey')} % 3 + 1] END AS colour FROM orders")(lambda t: G.pooled(t.orders.select("o_orderkey"), F.array(F.lit("red"), F.lit("green"), F.lit("blue")), "colour", "o_orderkey", "pool", 0.1))
add("identity_values", f"SELECT o_orderkey, {H.format(salt='id', key='o_orderkey')} AS new_id FROM orders")(lambda t: G.identity(t.orders.select("o_orderkey"), "new_id", "o_orderkey", "id"))
add("fanout_expansion", f"WITH h AS (SELECT k, count(*) AS c FROM (SELECT c_custkey, count(o_orderkey) AS k FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) GROUP BY k), w AS (SELECT k, sum(c) OVER (ORDER BY k) - c AS lo, sum(c) OVER (ORDER BY k) AS hi, sum(c) OVER () AS n FROM h), d AS (SELECT s_suppkey, {U.format(salt='fan', key='s_suppkey')} AS u FROM supplier) SELECT s_suppkey, unnest(range(1, k + 1)) AS ordinal FROM d JOIN w ON u >= lo / n AND u < hi / n WHERE k > 0")(lambda t: G.children(t.supplier, "s_suppkey", R.fanout_histogram(t.orders, t.customer, "o_custkey", "c_custkey"), "fan"))
_cand = "SELECT l_partkey, list(l_suppkey ORDER BY n) AS vals FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY md5('cand|' || l_suppkey::varchar), l_suppkey) AS n FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_partkey IS NOT NULL)) WHERE n <= 4 GROUP BY 1"
add("candidate_lists", f"SELECT l_partkey, array_to_string(vals, ',') AS candidates FROM ({_cand})")(lambda t: G.candidates(t.lineitem, "l_partkey", "l_suppkey", 4, "cand").select("l_partkey", F.array_join(F.col("values").cast("array<string>"), ",").alias("candidates")))
add("conditional_join", f"SELECT p_partkey AS l_partkey, coalesce(len(vals), 0) AS n_candidates FROM part LEFT JOIN ({_cand}) ON l_partkey = p_partkey")(lambda t: G.conditional(t.part.select(F.col("p_partkey").alias("l_partkey")), G.candidates(t.lineitem, "l_partkey", "l_suppkey", 4, "cand"), "l_partkey").select("l_partkey", F.size("values").cast("long").alias("n_candidates")))
add("mixed_radix", "SELECT o_orderkey, o_orderkey % 7 AS d0, (o_orderkey // 7) % 5 AS d1, (o_orderkey // 35) % 3 AS d2 FROM orders")(lambda t: t.orders.select("o_orderkey", *[x.alias(f"d{i}") for i, x in enumerate(G.mixed_radix(F.col("o_orderkey"), [7, 5, 3]))]))
add("weighted_permutation", f"SELECT o_orderkey, place FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY pow({U.format(salt='perm', key='o_orderkey')}, 1 / (1 + o_totalprice)) DESC, o_orderkey) AS place FROM orders) WHERE place <= 5")(lambda t: G.permuted(t.orders, "o_orderpriority", 1 + F.col("o_totalprice"), "o_orderkey", "perm").where("place <= 5").select("o_orderkey", F.col("place").cast("long").alias("place")))

# ---- vectors, ranking, retrieval -----------------------------------------------------------

add("vector_search", "WITH q AS (SELECT vec_id AS query_id, embedding AS e FROM embeddings WHERE vec_id % 100 = 0), s AS (SELECT query_id, vec_id, round(list_sum(list_transform(list_zip(embedding, e), lambda z: z[1]::double * z[2]::double)), 5) AS score FROM embeddings, q) SELECT query_id, vec_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10")(lambda t: X.search(t.embeddings.where("vec_id % 100 = 0"), t.embeddings, 10).select("query_id", "vec_id", "score", F.col("rank").cast("long").alias("rank")))
add("centroids", "SELECT label, pos - 1 AS pos, round(avg(x::double), 5) AS mean FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY label, pos")(lambda t: X.centroids(t.embeddings, "label").select("label", F.col("pos").cast("long").alias("pos"), "mean"))
_tok = "SELECT p_partkey AS id, unnest(string_split_regex(lower(p_name), '[^a-z0-9]+')) AS t FROM part"
add("hashing_embedding", f"SELECT id, b AS bucket, sum(w)::bigint AS weight FROM (SELECT id, ('0x' || substr(sha256('emb|' || t), 1, 8))::bigint % 32 AS b, CASE WHEN ('0x' || substr(sha256('emb|' || t), 9, 2))::bigint % 2 = 0 THEN 1 ELSE -1 END AS w FROM ({_tok}) WHERE t <> '') GROUP BY ALL HAVING sum(w) <> 0")(lambda t: X.hashing_counts(t.part, "p_partkey", "p_name", 32, "emb"))
_sc = "SELECT n_chars % 977 AS score, quality FROM documents JOIN labels USING (doc_id)"
add("midrank_auc", f"WITH s AS ({_sc}), r AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r FROM s), c AS (SELECT sum(r) FILTER (WHERE quality = 1) AS w, count(*) FILTER (WHERE quality = 1) AS p, count(*) FILTER (WHERE quality = 0) AS n FROM r) SELECT round((w - p * (p + 1) / 2) / (p * n), 6) AS auc FROM c")(lambda t: X.auc(t.documents.join(t.labels, "doc_id").select((F.col("n_chars") % 977).alias("score"), "quality"), "score", "quality"))
add("roc_points", f"WITH s AS ({_sc}), g AS (SELECT score, count(*) FILTER (WHERE quality = 1) AS p, count(*) FILTER (WHERE quality = 0) AS n FROM s GROUP BY score) SELECT score, round(sum(n) OVER (ORDER BY score DESC) / sum(n) OVER (), 6) AS fpr, round(sum(p) OVER (ORDER BY score DESC) / sum(p) OVER (), 6) AS tpr FROM g")(lambda t: X.roc(t.documents.join(t.labels, "doc_id").select((F.col("n_chars") % 977).alias("score"), "quality"), "score", "quality"))
_gow = "SELECT q.s_suppkey AS id, round((least(1.0, abs(q.s_acctbal - r.c_acctbal) / 11000) + (q.s_nationkey <> r.c_nationkey)::int) / 2, 8) AS d FROM supplier q, (SELECT c_acctbal, c_nationkey FROM (SELECT *, row_number() OVER (ORDER BY md5(c_custkey::varchar)) AS rank FROM customer) WHERE rank <= 4000 AND (rank <= (least(4000, (SELECT count(*) FROM customer)) + 1) // 2) = {r}) r"
_g2 = "SELECT id, max(d) FILTER (WHERE n = 1) AS d1, max(d) FILTER (WHERE n = 2) AS d2 FROM (SELECT id, d, row_number() OVER (PARTITION BY id ORDER BY d) AS n FROM ({g})) WHERE n <= 2 GROUP BY id"


#: Rows of R and of H, and of each side of density and coverage; all rows where there are fewer.
PANEL = 2000


def _gower(t: Tables, side: str) -> DataFrame:
    ref = S.panel(t.customer.select("c_custkey", F.col("c_acctbal").alias("s_acctbal"), F.col("c_nationkey").alias("s_nationkey")), F.col("c_custkey"), PANEL, 1).where(F.col("side") == side)
    return X.gower_nearest(t.supplier, ref, {"s_acctbal": 11_000.0}, ["s_nationkey"], "s_suppkey")


add("gower_nearest", _g2.format(g=_gow.format(r='true')))(lambda t: _gower(t, "R"))
add("dcr_share", f"WITH r AS ({_g2.format(g=_gow.format(r='true'))}), h AS ({_g2.format(g=_gow.format(r='false'))}) SELECT round(avg(CASE WHEN r.d1 < h.d1 THEN 1.0 WHEN r.d1 = h.d1 THEN 0.5 ELSE 0.0 END), 6) AS dcr_share, round(avg(CASE WHEN r.d2 > 0 THEN r.d1 / r.d2 ELSE 1.0 END), 5) AS nndr_mean FROM r JOIN h USING (id)")(lambda t: X.nearest_summary(_gower(t, "R"), _gower(t, "H")))
add("rag_chunks", "SELECT md5(i || '|' || kind) AS chunk_id, kind, text FROM (SELECT p_partkey::varchar AS i, 'row_doc' AS kind, 'p_brand is ' || p_brand || ', p_size is ' || p_size::varchar AS text FROM part UNION ALL SELECT p_partkey::varchar, 'free_text:p_name', p_name FROM part WHERE p_name IS NOT NULL)")(lambda t: X.chunks(t.part, "p_partkey", ["p_name"], ["p_brand", "p_size"]))

# ---- streams ---------------------------------------------------------------------------------

add("streaming_windows", "SELECT epoch_us(time_bucket(INTERVAL '1 hour', ts)) AS start_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")(lambda t: E.batch(t.events, "1 hour"))

# ---- privacy, detection, whole runs ------------------------------------------------------------

_pan = "(SELECT c_custkey AS id, c_acctbal / 11000 AS x, c_nationkey / 25.0::double AS y FROM customer WHERE c_custkey % 2 = {s} ORDER BY md5(c_custkey::varchar) LIMIT 2000)"


def _points(t: Tables, s: int) -> DataFrame:
    rows = S.reference_sample(t.side("customer", "c_custkey", s), F.col("c_custkey"), PANEL)
    return rows.select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 11000).alias("x"), (F.col("c_nationkey") / 25.0).alias("y"))


add("density_coverage", f"WITH r AS {_pan.format(s=0)}, s AS {_pan.format(s=1)}, d AS (SELECT a.id, a.x, a.y, b.id AS j, round((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), 8) AS d FROM r a JOIN r b ON a.id <> b.id), k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, j) AS n FROM d) WHERE n = 5), m AS (SELECT k.id, count(*) AS c FROM k JOIN s ON round((s.x - k.x) * (s.x - k.x) + (s.y - k.y) * (s.y - k.y), 8) <= k.d GROUP BY k.id) SELECT round(coalesce(sum(c), 0) / (5 * (SELECT count(*) FROM s)), 6) AS density, round(count(*) / (SELECT count(*) FROM r), 6) AS coverage FROM m")(lambda t: Y.density_coverage(_points(t, 0), _points(t, 1), ["x", "y"], 5, id_col="id"))
add("rarefied_duplicates", "WITH f AS (SELECT k, count(*) AS r FROM (SELECT count(*) AS k FROM lineitem GROUP BY l_partkey) GROUP BY k), n AS (SELECT sum(k * r)::double AS n FROM f) SELECT round(1 - sum(r * (1 - CASE WHEN n - k < 3000 THEN 0 ELSE exp(lgamma(n - k + 1) + lgamma(n - 3000 + 1) - lgamma(n - k - 3000 + 1) - lgamma(n + 1)) END)) / 3000, 6) AS duplicate_share FROM f, n")(lambda t: Y.rarefied_duplicates(M.frequency_of_frequencies(t.lineitem, ["l_partkey"]), 3000))
add("matched_size", f"WITH b AS (SELECT 0 AS side, o_orderkey FROM orders WHERE o_orderkey % 4 = 0 UNION ALL SELECT 1, o_orderkey FROM orders WHERE o_orderkey % 4 <> 0), r AS (SELECT side, (SELECT min(c) FROM (SELECT count(*) AS c FROM b GROUP BY side)) / count(*) AS p FROM b GROUP BY side) SELECT side, count(*) AS n, sum(o_orderkey)::bigint AS keys FROM b JOIN r USING (side) WHERE {U.format(salt='m', key='o_orderkey')} < p GROUP BY side")(lambda t: Y.matched(C.sided(t.orders.where("o_orderkey % 4 = 0"), t.orders.where("o_orderkey % 4 <> 0")), F.col("o_orderkey"), "m").groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")))
add("row_flags", f"SELECT status, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY o_totalprice, o_orderkey) AS rank FROM (SELECT DISTINCT o_orderstatus AS status, o_orderkey, o_totalprice FROM {PLANTED})) WHERE rank <= 5")(lambda t: Y.row_flags(t.planted().select(F.col("o_orderstatus").alias("status"), "o_orderkey", "o_totalprice"), "status", "o_orderkey", "o_totalprice", 5).select("status", "o_orderkey", F.col("rank").cast("long").alias("rank")))
add("length_ks", "WITH l AS (SELECT length(p_name) AS len, count(*) FILTER (WHERE p_partkey % 2 = 0) AS a, count(*) FILTER (WHERE p_partkey % 2 = 1) AS b FROM part GROUP BY 1) SELECT round(max(d), 6) AS length_ks FROM (SELECT abs(sum(a) OVER (ORDER BY len) / sum(a) OVER () - sum(b) OVER (ORDER BY len) / sum(b) OVER ()) AS d FROM l WHERE len <= 64)")(lambda t: C.binned_distances(C.binned(t.both("part", "p_partkey"), F.length("p_name").cast("double"), [float(i) for i in range(1, 65)]), [float(i) for i in range(1, 65)]).select(F.col("ks").alias("length_ks")))
_npt = "SELECT CASE WHEN nullif(o_orderstatus, 'F') IS NULL THEN '1' ELSE '0' END || CASE WHEN nullif(o_orderpriority, '5-LOW') IS NULL THEN '1' ELSE '0' END AS value, o_orderkey % 2 AS s FROM orders"


def _patterns(t: Tables) -> DataFrame:
    from ..functions import null_pattern

    both = t.both("orders", "o_orderkey").select("side", null_pattern(F.expr("nullif(o_orderstatus, 'F')"), F.expr("nullif(o_orderpriority, '5-LOW')")).alias("value"))
    return both.groupBy("value").agg(F.count_if(F.col("side") == 0).alias("c_src"), F.count_if(F.col("side") == 1).alias("c_syn")).withColumn("g", F.lit(1))


add("null_pattern_tvd", f"SELECT round(sum(abs(p - q)) / 2, 6) AS tvd FROM (SELECT count(*) FILTER (WHERE s = 0) / sum(count(*) FILTER (WHERE s = 0)) OVER () AS p, count(*) FILTER (WHERE s = 1) / sum(count(*) FILTER (WHERE s = 1)) OVER () AS q FROM ({_npt}) GROUP BY value)")(lambda t: C.frequency_distances(_patterns(t), "g").select("tvd"))
add("stats_drift", "SELECT round(greatest(abs(n1 - n0), abs(d1 - d0) / d0, abs(m1 - m0) / s0), 6) AS drift FROM (SELECT count(*) FILTER (WHERE o_totalprice IS NULL AND o_orderkey % 2 = 0) / count(*) AS n0, count(*) FILTER (WHERE o_totalprice IS NULL AND o_orderkey % 2 = 1) / count(*) AS n1, count(DISTINCT o_totalprice) FILTER (WHERE o_orderkey % 2 = 0) AS d0, count(DISTINCT o_totalprice) FILTER (WHERE o_orderkey % 2 = 1) AS d1, avg(o_totalprice) FILTER (WHERE o_orderkey % 2 = 0) AS m0, avg(o_totalprice) FILTER (WHERE o_orderkey % 2 = 1) AS m1, stddev_pop(o_totalprice) FILTER (WHERE o_orderkey % 2 = 0) AS s0 FROM orders)")(lambda t: C.stats_drift(t.both("orders", "o_orderkey"), "o_totalprice"))
add("publishable_values", "SELECT o_custkey::varchar AS value, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 10 UNION ALL SELECT '<rare>', coalesce(sum(n), 0)::bigint FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) < 10)")(lambda t: C.publishable(t.orders, "o_custkey", 10))


def _spec():
    from .evaluate import TableSpec

    return TableSpec("orders", ["o_orderkey"], categorical=["o_orderstatus", "o_orderpriority"], numeric=["o_totalprice"], temporal=["o_orderdate"])


def _evaluated(t: Tables) -> DataFrame:
    from .evaluate import evaluate

    return evaluate(t.side("orders", "o_orderkey", 0), t.planted(), _spec())


add("evaluation", None)(lambda t: _evaluated(t).select("metric_id", "table_name", "unit", "value", "status", "score"))
add("detection_scores", None)(lambda t: X.auc(Y.out_of_fold_scores(t.both("customer", "c_custkey"), ["c_acctbal", "c_nationkey"], "c_custkey"), "score", "side"))
add("propensity_ratio", None)(lambda t: Y.pmse_ratio(Y.out_of_fold_scores(t.both("customer", "c_custkey"), ["c_acctbal", "c_nationkey"], "c_custkey", folds=2, boosted=False), 2))


def _generated(t: Tables) -> DataFrame:
    from .evaluate import generate_model

    from .evaluate import TableSpec

    model = R.Model(["customer", "supplier", "orders"], [R.Edge("orders", "customer", (("o_custkey", "c_custkey"),)), R.Edge("orders", "supplier", (("o_suppkey", "s_suppkey"),))])
    specs = {"customer": TableSpec("customer", ["c_custkey"]), "supplier": TableSpec("supplier", ["s_suppkey"]), "orders": TableSpec("orders", ["o_orderkey"], categorical=["o_orderpriority"])}
    made = generate_model({"customer": t.customer, "supplier": t.supplier, "orders": t.orders}, model, specs, "run")
    return made["orders"]


_hist = "SELECT k, sum(c) OVER (ORDER BY k) - c AS lo, sum(c) OVER (ORDER BY k) AS hi, sum(c) OVER () AS n FROM (SELECT k, count(*) AS c FROM (SELECT c_custkey, count(o_orderkey) AS k FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) GROUP BY k)"
_row_ = "(o_custkey::varchar || '|' || j::varchar)"
_prio = "SELECT v, sum(c) OVER (ORDER BY v) - c AS lo, sum(c) OVER (ORDER BY v) AS hi, sum(c) OVER () AS n FROM (SELECT o_orderpriority AS v, count(*) AS c FROM orders GROUP BY 1)"
add("generated_model", f"""WITH w AS ({_hist}), p AS (SELECT {H.format(salt='run|customer|c_custkey', key='i')} AS o_custkey FROM range(0, (SELECT count(*) FROM customer)) r(i)), d AS (SELECT o_custkey, {U.format(salt='run|orders', key='o_custkey')} AS u FROM p), e AS (SELECT o_custkey, unnest(range(1, k + 1)) AS j FROM d JOIN w ON u >= lo / n AND u < hi / n WHERE k > 0),
 s AS (SELECT {H.format(salt='run|supplier|s_suppkey', key='i')} AS key FROM range(0, (SELECT count(*) FROM supplier)) r(i)), t AS (SELECT key, row_number() OVER (ORDER BY lpad(key::varchar, 20, '0')) - 1 AS place FROM s), c AS ({_prio}),
 f AS (SELECT o_custkey, j, floor({U.format(salt='run|orders|supplier', key=_row_)} * (SELECT count(*) FROM s))::bigint AS x, {U.format(salt='run|orders|o_orderpriority', key=_row_)} AS v FROM e)
 SELECT o_custkey, t.key AS o_suppkey, {H.format(salt='run|orders|o_orderkey', key=_row_)} AS o_orderkey, c.v AS o_orderpriority FROM f JOIN t ON t.place = x JOIN c ON f.v >= lo / n AND f.v < hi / n""")(_generated)
