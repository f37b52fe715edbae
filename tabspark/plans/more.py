"""Further registered queries: scopes, text shapes, samples, corrected entropies, lifts, noise, scores of runs, generation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import sources as S
from ..operators import compare as C
from ..operators import generate as G
from ..operators import membership as M
from ..operators import privacy as Y
from ..operators import profile as P
from ..operators import relational as R
from ..operators import sampling as A
from ..operators import scoring as K
from ..operators import text as X
from ..operators import validate as V
from ..operators import vectors as W
from ..streaming import events as E
from .queries import CENSUS, EDGES, H, MEM, NUM, PLANTED, SCORED, SHARES, Tables, U, _bin, _fan, _rk, _scored, add

# ---- scopes and filters -------------------------------------------------------------------

_since, _until = "2024-01-03 00:00:00", "2024-01-09 00:00:00"
_us = lambda t: f"epoch_us(TIMESTAMP '{t}')"
add("scope_as_of", f"SELECT event_id, user_id FROM events WHERE ts <= TIMESTAMP '{_until}'")(lambda t: S.as_of(t.events, "ts", _until).select("event_id", "user_id"))
add("scope_appends", f"SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '{_since}' AND ts <= TIMESTAMP '{_until}'")(lambda t: S.appends(t.events, "ts", _since, _until).select("event_id", "user_id"))
add("as_of_difference", f"SELECT user_id, event_type FROM events WHERE ts <= TIMESTAMP '{_until}' EXCEPT ALL SELECT user_id, event_type FROM events WHERE ts <= TIMESTAMP '{_since}'")(lambda t: S.scope_diff(S.as_of(t.events, "ts", _until).select("user_id", "event_type"), S.as_of(t.events, "ts", _since).select("user_id", "event_type")))
add("distinct_values_capped", "SELECT CASE WHEN count(DISTINCT o_orderpriority) <= 10 THEN array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') END AS few, CASE WHEN count(DISTINCT o_custkey) <= 10 THEN 'x' END AS many FROM orders")(
    lambda t: S.distinct_capped(t.orders, "o_orderpriority", 10).select(F.array_join("values", ",").alias("few")).crossJoin(F.broadcast(S.distinct_capped(t.orders, "o_custkey", 10).select(F.array_join("values", ",").alias("many"))))
)
add("dropped_null_keys", "SELECT count(*) AS n, count(*) FILTER (WHERE nullif(o_orderstatus, 'F') IS NULL) AS dropped FROM orders")(lambda t: S.null_keys(t.orders.select(F.expr("nullif(o_orderstatus, 'F')").alias("k")), ["k"]))
add("deferred_failures", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority NOT IN (SELECT o_orderpriority FROM orders GROUP BY 1 HAVING max(o_totalprice) > 400000 AND min(o_orderkey) = 0) GROUP BY 1")(
    lambda t: V.without_failed(t.orders, t.orders.groupBy("o_orderpriority").agg(F.max("o_totalprice").alias("x"), F.min("o_orderkey").alias("y")).where("x > 400000 AND y = 0").select("o_orderpriority"), "o_orderpriority").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
)
add("in_subquery", "SELECT count(*) AS n FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) >= 35)")(lambda t: t.lineitem.join(S.frequent_values(t.lineitem, "l_partkey", 35).select(F.col("value").alias("l_partkey")), "l_partkey", "left_semi").agg(F.count(F.lit(1)).alias("n")))
add("panel_exclusives", "WITH p AS (SELECT o_custkey, rank <= (least(400, (SELECT count(*) FROM orders)) + 1) // 2 AS r, rank <= 50 AS e FROM (SELECT o_custkey, row_number() OVER (ORDER BY md5(o_orderkey::varchar)) AS rank FROM orders) WHERE rank <= 400), k AS (SELECT o_custkey, bool_or(r) AS r, bool_or(NOT r) AS h, bool_or(e) AS e FROM p GROUP BY 1) SELECT count(*) FILTER (WHERE r AND NOT h) AS r_not_h, count(*) FILTER (WHERE h AND NOT r) AS h_not_r, count(*) FILTER (WHERE e AND NOT h) AS e_not_h, count(*) FILTER (WHERE r AND NOT h AND NOT e) AS r_not_h_e FROM k")(
    lambda t: S.panel(t.orders.select("o_orderkey", "o_custkey"), F.col("o_orderkey"), 200, 50).groupBy("o_custkey").agg(F.bool_or(F.col("side") == "R").alias("r"), F.bool_or(F.col("side") == "H").alias("h"), F.bool_or("exposed").alias("e")).agg(F.count_if(F.expr("r AND NOT h")).alias("r_not_h"), F.count_if(F.expr("h AND NOT r")).alias("h_not_r"), F.count_if(F.expr("e AND NOT h")).alias("e_not_h"), F.count_if(F.expr("r AND NOT h AND NOT e")).alias("r_not_h_e"))
)

# ---- text shapes ----------------------------------------------------------------------------

_mask = "regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '[A-Z]', 'A', 'g'), '[a-z]', 'a', 'g'), '[0-9]', '9', 'g'), '[ \\t\\n\\r]', '␣', 'g')"
_fold = lambda m: f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({m}, '9{{2,}}', '9+', 'g'), 'A{{2,}}', 'A+', 'g'), 'a{{2,}}', 'a+', 'g'), '␣{{2,}}', '␣+', 'g')"
add("collapsed_masks", f"SELECT {_fold(_mask.format(c='c_name'))} AS mask, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT {_fold(_mask.format(c='p_name'))}, count(*) FROM part GROUP BY 1")(
    lambda t: t.customer.select(X.collapse(X.spaced_mask(F.col("c_name"))).alias("mask")).groupBy("mask").agg(F.count(F.lit(1)).alias("n")).union(t.part.select(X.collapse(X.spaced_mask(F.col("p_name"))).alias("mask")).groupBy("mask").agg(F.count(F.lit(1)).alias("n")))
)
add("identifier_template", "WITH s AS (SELECT unnest(string_split(c_name, '')) AS c, generate_subscripts(string_split(c_name, ''), 1) AS pos FROM customer), p AS (SELECT pos, CASE WHEN count(DISTINCT c) = 1 THEN min(c) WHEN bool_and(c BETWEEN '0' AND '9') THEN '9' WHEN bool_and(regexp_matches(c, '[A-Z]')) THEN 'A' WHEN bool_and(regexp_matches(c, '[a-z]')) THEN 'a' WHEN bool_and(regexp_matches(c, '[A-Za-z0-9]')) THEN 'X' ELSE '?' END AS t, count(*) AS n FROM s GROUP BY pos) SELECT CASE WHEN min(n) = max(n) THEN string_agg(t, '' ORDER BY pos) END AS template FROM p")(lambda t: X.template(t.customer, "c_name"))
add("temporal_formats", "SELECT (SELECT CASE WHEN bool_and(try_strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') IS NOT NULL) THEN 'yyyy-MM-dd' END FROM orders) AS a, (SELECT CASE WHEN bool_and(try_strptime(strftime(ts, '%d.%m.%Y'), '%d.%m.%Y') IS NOT NULL) THEN 'dd.MM.yyyy' END FROM events) AS b, (SELECT CASE WHEN count(try_strptime(o_orderpriority, '%Y-%m-%d')) > 0 THEN 'yyyy-MM-dd' END FROM orders) AS c")(
    lambda t: X.temporal_format(t.orders.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("x")), "x").select(F.col("format").alias("a")).crossJoin(F.broadcast(X.temporal_format(t.events.select(F.date_format("ts", "dd.MM.yyyy").alias("x")), "x").select(F.col("format").alias("b")))).crossJoin(F.broadcast(X.temporal_format(t.orders, "o_orderpriority").select(F.col("format").alias("c"))))
)
add("relaxed_shapes", f"WITH m AS (SELECT length(p_name) // 4 AS bucket, {_fold(_mask.format(c='p_name'))} AS mask, count(*) AS n FROM part GROUP BY 1, 2) SELECT bucket, mask, n, share FROM (SELECT *, round(n / sum(n) OVER (PARTITION BY bucket), 6) AS share, row_number() OVER (PARTITION BY bucket ORDER BY n DESC, mask) AS r FROM m) WHERE r <= 3")(lambda t: X.relaxed_shapes(t.part, "p_name", 4, 3))
add("text_hints", "SELECT round(avg(regexp_matches({c}, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]')::int), 6) AS control_share, min(length({c})) AS min_length, max(length({c})) AS max_length, bool_or(regexp_matches({c}, '[A-Z]')) AS upper, bool_or(regexp_matches({c}, '[a-z]')) AS lower, bool_or(regexp_matches({c}, '[0-9]')) AS digit, round(avg(regexp_matches({c}, '^[A-Za-z]+[-_#]?[0-9]+$')::int), 6) AS identifier_share, min(length({c})) = max(length({c})) AS fixed_width FROM customer".replace("{c}", "c_name"))(lambda t: X.hints(t.customer, "c_name"))
add("shape_adherence", f"SELECT sum(t)::bigint AS n, round(sum(CASE WHEN s > 0 THEN t ELSE 0 END) / sum(t), 6) AS adherence FROM (SELECT {_mask.format(c='p_name').replace('␣', ' ')} AS m, count(*) FILTER (WHERE p_partkey % 2 = 0) AS s, count(*) FILTER (WHERE p_partkey % 2 = 1) AS t FROM part GROUP BY 1)")(lambda t: X.shape_adherence(t.both("part", "p_partkey"), "p_name"))
_dr = lambda key, salt, n, i="i": f"(('0x' || substr(md5('{salt}|' || {key}::varchar || '|' || {i}), 1, 8))::bigint % {n})"
_let = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
add("mask_fill", f"SELECT p_partkey, string_agg(CASE c WHEN '9' THEN {_dr('p_partkey', 'fill', 10)}::varchar WHEN 'A' THEN substr({_let}, {_dr('p_partkey', 'fill', 26)}::int + 1, 1) WHEN 'a' THEN lower(substr({_let}, {_dr('p_partkey', 'fill', 26)}::int + 1, 1)) WHEN '␣' THEN ' ' ELSE c END, '' ORDER BY i) AS value FROM (SELECT p_partkey, unnest(string_split({_mask.format(c='p_brand')}, '')) AS c, generate_subscripts(string_split(p_brand, ''), 1) - 1 AS i FROM part) GROUP BY 1")(lambda t: t.part.select("p_partkey", X.fill(X.spaced_mask(F.col("p_brand")), F.col("p_partkey"), "fill").alias("value")))
_isd = lambda i: f"coalesce(regexp_matches(s[{i}], '[0-9]'), false)"
add("digit_mutation", f"SELECT c_custkey, string_agg(CASE WHEN {_isd('j')} AND ({_isd('j - 1')} OR {_isd('j + 1')}) THEN CASE WHEN NOT {_isd('j - 1')} THEN CASE WHEN s[j] = '0' THEN '0' ELSE ({_dr('c_name', 'mut', 9, '(j - 1)')} + 1)::varchar END ELSE {_dr('c_name', 'mut', 10, '(j - 1)')}::varchar END ELSE s[j] END, '' ORDER BY j) AS value FROM (SELECT c_custkey, c_name, s, unnest(range(1, len(s) + 1)) AS j FROM (SELECT c_custkey, c_name, string_split(c_name, '') AS s FROM customer)) GROUP BY 1")(lambda t: t.customer.select("c_custkey", X.mutate_digits(F.col("c_name"), "mut").alias("value")))
add("keyed_labels", "SELECT c_custkey, 'h:' || substr(sha256('key|' || c_name), 1, 8) AS label FROM customer")(lambda t: t.customer.select("c_custkey", X.keyed_label(F.col("c_name"), "key").alias("label")))
add("row_texts", "SELECT o_orderkey, 'o_orderstatus is ' || coalesce(nullif(o_orderstatus, 'F'), 'null') || ', o_custkey is ' || o_custkey::varchar AS text FROM orders")(lambda t: t.orders.withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'F')")).select("o_orderkey", X.row_text(["o_orderstatus", "o_custkey"]).alias("text")))

# ---- samples --------------------------------------------------------------------------------

_prio = f"SELECT o_custkey AS key, count(*) AS multiplicity, {U.format(salt='bk', key='o_custkey')} AS priority FROM orders GROUP BY 1"
add("bottom_k", f"SELECT * FROM ({_prio}) ORDER BY priority, key LIMIT 64")(lambda t: A.bottom_k(t.orders, "o_custkey", 64, "bk"))
add("merged_reservoirs", f"SELECT * FROM ({_prio}) ORDER BY priority, key LIMIT 64")(lambda t: A.merge_reservoirs(A.bottom_k(t.side("orders", "o_orderkey", 0), "o_custkey", 64, "bk"), A.bottom_k(t.side("orders", "o_orderkey", 1), "o_custkey", 64, "bk"), 64))
add("prefiltered_sample", f"SELECT o_orderkey FROM orders ORDER BY {U.format(salt='pre', key='o_orderkey')} LIMIT 50")(lambda t: A.prefiltered(t.orders.select("o_orderkey"), F.col("o_orderkey"), "pre", 50, 1000))
add("systematic_points", "WITH s AS (SELECT o_custkey, count(*) AS size FROM orders GROUP BY 1), c AS (SELECT *, sum(size) OVER (ORDER BY o_custkey) - size AS before, sum(size) OVER () AS total FROM s), h AS (SELECT o_custkey, size, (greatest(ceil((before + size) * 40 / total - 0.5::double), 0) - greatest(ceil(before * 40 / total - 0.5::double), 0))::bigint AS hits FROM c) SELECT * FROM h WHERE hits > 0")(lambda t: A.systematic(t.orders.withColumn("one", F.lit(1)), "one", "o_custkey", 40).select("o_custkey", "size", "hits"))
_ht = f"SELECT *, CASE WHEN c >= 12 THEN 1.0 ELSE 2.5 END AS weight FROM (SELECT o_custkey AS value, count(*) AS c FROM orders GROUP BY 1) WHERE c >= 12 OR {U.format(salt='ht', key='value')} < 0.4"
add("head_and_tail", f"SELECT value, c, weight FROM ({_ht})")(lambda t: A.head_and_tail(t.orders.groupBy(F.col("o_custkey").alias("value")).agg(F.count(F.lit(1)).alias("c")), "value", 12, "ht", 0.4).select("value", "c", F.col("weight").cast("double").alias("weight")))
add("stratified_totals", f"SELECT coalesce(sum(c) FILTER (WHERE c >= 12), 0)::bigint AS head_rows, coalesce(sum(c) FILTER (WHERE c < 12), 0)::bigint AS tail_rows, count(*) FILTER (WHERE c < 12) AS tail_clusters, coalesce(sum(c * c) FILTER (WHERE c < 12), 0)::bigint AS tail_squares, round(sum(c * weight)::double, 4) AS estimated_rows FROM ({_ht})")(lambda t: A.stratified_totals(A.head_and_tail(t.orders.groupBy(F.col("o_custkey").alias("value")).agg(F.count(F.lit(1)).alias("c")), "value", 12, "ht", 0.4), 12))

# ---- distances, floors ------------------------------------------------------------------------

_both = lambda t: t.both("orders", "o_orderkey")
_lbin = _bin.replace("e < o_totalprice", "e <= o_totalprice")
add("edge_histogram_left", f"SELECT bin, c_src, c_syn FROM {_lbin}")(lambda t: C.binned(_both(t), F.col("o_totalprice"), EDGES, left=True))
_sh = lambda c, w: f"round(coalesce(sum({c}) FILTER (WHERE {w}), 0) / sum({c}), 6)"
add("tail_masses", f"SELECT {_sh('c_src', 'bin = 0')} AS below_source, {_sh('c_src', f'bin = {len(EDGES)}')} AS above_source, {_sh('c_syn', 'bin = 0')} AS below_synthetic, {_sh('c_syn', f'bin = {len(EDGES)}')} AS above_synthetic FROM {_bin}")(lambda t: C.tail_masses(C.binned(_both(t), F.col("o_totalprice"), EDGES), EDGES))
_qs = [0.001, 0.2, 0.5, 0.9, 0.9999]
add("quantiles_from_bins", f"WITH f AS (SELECT bin, ({EDGES}::double[])[bin::int + 1] AS x, sum(c_src) OVER (ORDER BY bin) / sum(c_src) OVER () AS f FROM {_bin}), e AS (SELECT * FROM f WHERE bin < {len(EDGES)}), p AS (SELECT unnest({_qs}::double[]) AS p) SELECT p, round(CASE WHEN lo.x IS NULL THEN (SELECT min(x) FROM e) WHEN hi.x IS NULL THEN (SELECT max(x) FROM e) ELSE lo.x + (hi.x - lo.x) * (p - lo.f) / (hi.f - lo.f) END, 6) AS value FROM p LEFT JOIN LATERAL (SELECT max(x) AS x, max(f) AS f FROM e WHERE f <= p.p) lo ON true LEFT JOIN LATERAL (SELECT min(x) AS x, min(f) AS f FROM e WHERE f > p.p) hi ON true")(lambda t: C.quantiles_from_bins(C.binned(_both(t), F.col("o_totalprice"), EDGES), "c_src", EDGES, _qs))
_cs = "SELECT col, c, n, (1 - CASE WHEN f < n THEN f ELSE n - 1 END / n) * c / n AS p FROM (SELECT col, c_src AS c, sum(c_src) OVER (PARTITION BY col)::double AS n, count(*) FILTER (WHERE c_src = 1) OVER (PARTITION BY col) AS f FROM ({s}) WHERE c_src > 0)".format(s=SHARES)
add("chao_shen", f'SELECT col AS "column", round(sum(-p * log2(p) / (1 - exp(n * ln(1 - p)))), 6) AS chao_shen FROM ({_cs}) GROUP BY col')(lambda t: C.chao_shen(C.census(_both(t), CENSUS), "c_src", "column"))
add("chance_floors", f'SELECT col AS "column", round(sum(sqrt(2 * p * (1 - p) * (1 / n_src + 1 / n_syn) / pi())) / 2, 6) AS tvd_floor, round(max((k - 1) * (1 / n_src + 1 / n_syn)) / (8 * ln(2)), 6) AS jsd_floor FROM ({SHARES}) GROUP BY col')(lambda t: C.chance_floors(C.census(_both(t), CENSUS), "column"))
_pw = "WITH m AS (SELECT avg(l_quantity) AS m, count(*)::double AS n FROM lineitem), s AS (SELECT max(n) AS n, max(m) AS m, sum(pow(l_quantity - m, 2)) AS s2, sum(pow(l_quantity - m, 3)) AS s3, sum(pow(l_quantity - m, 4)) AS s4 FROM lineitem, m) SELECT n::bigint AS n, round(m, 6) AS mean, round(s2 / n, 4) AS variance, round(sqrt(n) * s3 / pow(s2, 1.5), 6) AS skewness, round(n * s4 / (s2 * s2) - 3, 6) AS kurtosis FROM s"
add("merged_moments", _pw)(lambda t: C.merge_moments(C.power_sums(t.lineitem, "l_quantity", "l_linenumber")))
add("spearman_delta", f"SELECT round(abs(max(r) FILTER (WHERE side = 1) - max(r) FILTER (WHERE side = 0)), 5) AS spearman_delta FROM (SELECT side, corr(ra, rb) AS r FROM ({_rk.format(a='l_quantity', b='l_extendedprice')}) GROUP BY side)")(lambda t: C.spearman(t.both("lineitem", "l_orderkey"), "l_quantity", "l_extendedprice").agg(F.round(F.abs(F.max(F.when(F.col("side") == 1, F.col("spearman"))) - F.max(F.when(F.col("side") == 0, F.col("spearman")))), 5).alias("spearman_delta")))
_ct = "(WITH c AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*)::double AS c FROM lineitem WHERE l_orderkey % 2 = {s} GROUP BY ALL), t AS (SELECT *, sum(c) OVER (PARTITION BY a) AS ra, sum(c) OVER (PARTITION BY b) AS rb, sum(c) OVER () AS n, (SELECT count(DISTINCT a) FROM c)::double AS ka, (SELECT count(DISTINCT b) FROM c)::double AS kb FROM c), o AS (SELECT max(n) AS n, max(ka) AS ka, max(kb) AS kb, sum(c * c / (ra * rb / n)) - max(n) AS chi2, sum(c / n * ln((c / n) / (ra / n * rb / n))) AS mi, -sum(c / n * ln(ra / n)) AS ha, -sum(c / n * ln(rb / n)) AS hb FROM t) SELECT {x} FROM o)"
_vv = "round(sqrt(greatest(0.0, chi2 / n - (ka - 1) * (kb - 1) / (n - 1)) / least(ka - (ka - 1) * (ka - 1) / (n - 1) - 1, kb - (kb - 1) * (kb - 1) / (n - 1) - 1)), 6)"
_nn = "round(mi / least(ha, hb), 6)"
add("contingency_deltas", f"SELECT round(abs({_ct.format(s=1, x=_vv)} - {_ct.format(s=0, x=_vv)}), 6) AS cramers_v_delta, round(abs({_ct.format(s=1, x=_nn)} - {_ct.format(s=0, x=_nn)}), 6) AS nmi_delta")(lambda t: C.side_deltas(t.both("lineitem", "l_orderkey"), lambda d: C.contingency(d, "l_returnflag", "l_linestatus"), {"cramers_v": "cramers_v_delta", "nmi": "nmi_delta"}))
_mt = f"(SELECT o_orderkey, 0 AS s, o_custkey FROM orders WHERE o_orderkey % 4 = 0 UNION ALL SELECT o_orderkey, 1, o_custkey FROM (SELECT * FROM orders WHERE o_orderkey % 4 <> 0) WHERE {U.format(salt='mr', key='o_orderkey')} < (SELECT count(*) FROM orders WHERE o_orderkey % 4 = 0) / (SELECT count(*) FROM orders WHERE o_orderkey % 4 <> 0))"
add("matched_ratios", f"WITH c AS (SELECT o_custkey, count(*) FILTER (WHERE s = 0) AS a, count(*) FILTER (WHERE s = 1) AS b FROM {_mt} GROUP BY 1), p AS (SELECT a / sum(a) OVER () AS p, b / sum(b) OVER () AS q FROM c) SELECT 'o_custkey' AS \"column\", round(round(-sum(CASE WHEN q > 0 THEN q * log2(q) ELSE 0 END), 6) / round(-sum(CASE WHEN p > 0 THEN p * log2(p) ELSE 0 END), 6), 5) AS entropy_ratio, round(count(*) FILTER (WHERE q > 0) / count(*) FILTER (WHERE p > 0), 6) AS distinct_ratio FROM p")(
    lambda t: C.ratios(C.census(Y.matched(C.sided(t.orders.where("o_orderkey % 4 = 0"), t.orders.where("o_orderkey % 4 <> 0")), F.col("o_orderkey"), "mr"), ["o_custkey"]), "column")
)
add("distinct_ceiling", "SELECT 'o_orderpriority' AS \"column\", count(DISTINCT o_orderpriority) AS distinct_syn, (count(DISTINCT o_orderpriority) IN (5, 512))::int::double AS hit FROM orders WHERE o_orderkey % 2 = 1")(lambda t: C.ceiling_hit(C.census(_both(t), ["o_orderpriority"]), [5, 512], "column"))
add("type_validity", "SELECT 'o_totalprice' AS \"column\", 1.0::double AS validity UNION ALL SELECT 'o_orderpriority', round(count(try_cast(o_orderpriority AS double)) / count(o_orderpriority), 6) FROM orders")(lambda t: C.type_validity(t.orders, ["o_totalprice", "o_orderpriority"]))
add("merged_edges", "SELECT array_to_string(list_transform(list_sort(list_distinct(list_filter([3.0, 1.5, NULL, 7.0, 1.5, 'inf'::double], lambda e: e IS NOT NULL AND e < 'inf'::double))), lambda e: e::int::varchar), ',') AS edges, count(*) AS n FROM nation")(lambda t: t.nation.agg(F.count(F.lit(1)).alias("n"), F.first(F.array_join(F.transform(C.merged_edges(F.array(F.lit(3.0), F.lit(1.5), F.lit(None).cast("double")), F.array(F.lit(7.0), F.lit(1.5), F.lit(float("inf")))), lambda e: F.bround(e, 0).cast("int").cast("string")), ",")).alias("edges")))

# ---- relations, lifts ---------------------------------------------------------------------------

_atoms = lambda s, f: f"SELECT b, CASE WHEN b = 50 THEN avg(k) ELSE b END AS x, count(*) / sum(count(*)) OVER () AS p, {s} AS s FROM (SELECT k, least(k, 50) AS b FROM ({f})) GROUP BY b"
add("fanout_w1", f"WITH a AS ({_atoms(0, _fan.format(s=0))} UNION ALL {_atoms(1, _fan.format(s=1))}), m AS (SELECT x, sum(p) FILTER (WHERE s = 0) AS p, sum(p) FILTER (WHERE s = 1) AS q FROM a GROUP BY x), g AS (SELECT lead(x) OVER (ORDER BY x) - x AS w, abs(sum(coalesce(p, 0)) OVER (ORDER BY x) - sum(coalesce(q, 0)) OVER (ORDER BY x)) AS gap FROM m) SELECT round(sum(w * gap), 6) AS fanout_w1 FROM g")(lambda t: R.fanout_w1(*[R.fanout(t.side("orders", "o_orderkey", s), t.customer, "o_custkey", "c_custkey").select("k") for s in (0, 1)]))
add("broadcast_orphans", f"SELECT count(*) AS n, count(*) FILTER (WHERE c_custkey IS NULL) AS orphans, round(count(*) FILTER (WHERE c_custkey IS NULL) / count(*), 6) AS orphan_rate FROM {PLANTED} LEFT JOIN customer ON o_custkey = c_custkey WHERE o_custkey IS NOT NULL")(lambda t: R.broadcast_orphans(t.planted(), t.customer, "o_custkey", "c_custkey"))
add("orphan_rate_source", "SELECT count(*) AS n, count(*) FILTER (WHERE c_custkey IS NULL) AS orphans, round(count(*) FILTER (WHERE c_custkey IS NULL) / count(*), 6) AS orphan_rate FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 2 = 0")(lambda t: R.orphan_rate(t.side("orders", "o_orderkey", 0), t.customer, "o_custkey", "c_custkey"))
_pan = "(SELECT *, CASE WHEN rank <= (least(6000, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0)) + 1) // 2 THEN 'R' ELSE 'H' END AS side, rank <= 500 AS exposed FROM (SELECT *, row_number() OVER (ORDER BY md5(o_orderkey::varchar)) AS rank FROM orders WHERE o_orderkey % 2 = 0) WHERE rank <= 6000)"
_panel = lambda t: S.panel(t.side("orders", "o_orderkey", 0), F.col("o_orderkey"), 3000, 500)
add("exposure_lift", f"WITH k AS (SELECT o_custkey, o_orderstatus, bool_or(side = 'R') AS r, bool_or(side = 'H') AS h, bool_or(exposed) AS e FROM {_pan} GROUP BY ALL), j AS (SELECT k.*, EXISTS (SELECT 1 FROM {PLANTED} p WHERE p.o_custkey = k.o_custkey AND p.o_orderstatus = k.o_orderstatus) AS s FROM k WHERE r AND NOT h), c AS (SELECT count(*) FILTER (WHERE e) AS e_only, count(*) FILTER (WHERE NOT e) AS r_only, count(*) FILTER (WHERE e AND s) AS e_hit, count(*) FILTER (WHERE NOT e AND s) AS r_hit FROM j) SELECT *, CASE WHEN r_hit > 0 THEN round((e_hit / e_only) / (r_hit / r_only), 6) END AS lift FROM c")(lambda t: M.exposure_lift(t.planted(), _panel(t), ["o_custkey", "o_orderstatus"]))
_nr = lambda s: "(" + " OR ".join("EXISTS (SELECT 1 FROM pan s WHERE side = '" + s + "' AND " + " AND ".join(f"s.{c} {'<>' if c == x else '='} p.{c}" for c in MEM) + ")" for x in MEM) + f") AND NOT EXISTS (SELECT 1 FROM pan s WHERE side = '{s}' AND " + " AND ".join(f"s.{c} = p.{c}" for c in MEM) + ")"
add("near_match_lift", f"WITH pan AS {_pan}, c AS (SELECT count(*) FILTER (WHERE {_nr('R')}) AS near_R, count(*) FILTER (WHERE {_nr('H')}) AS near_H, count(*) AS n FROM {PLANTED} p) SELECT near_R, near_H, CASE WHEN near_H > 0 THEN round((near_R / n) / (near_H / n), 6) END AS lift FROM c")(lambda t: M.near_match_lift(t.planted().select(*MEM), _panel(t).select("side", *MEM), MEM))
_vl = "WITH k AS (SELECT o_custkey AS v, count(*) FILTER (WHERE side = 'R') AS r, count(*) FILTER (WHERE side = 'H') AS h FROM {pan} GROUP BY 1 HAVING count(*) < 10), j AS (SELECT *, v IN (SELECT {col} FROM {by} WHERE {col} IS NOT NULL) AS s FROM k WHERE r = 0 OR h = 0), c AS (SELECT count(*) FILTER (WHERE r > 0) AS r_only, count(*) FILTER (WHERE r = 0) AS h_only, count(*) FILTER (WHERE r > 0 AND s) AS r_hit, count(*) FILTER (WHERE r = 0 AND s) AS h_hit FROM j) SELECT *, CASE WHEN h_hit > 0 THEN round((r_hit / r_only) / (h_hit / h_only), 6) END AS lift FROM c"
add("value_memorization_lift", _vl.format(pan=_pan, col="o_custkey", by=PLANTED))(lambda t: M.value_lift(t.planted(), _panel(t), "o_custkey", 10))
add("pool_memorization_lift", _vl.format(pan=_pan, col="s_suppkey", by="supplier"))(lambda t: M.value_lift(t.supplier.select(F.col("s_suppkey").alias("o_custkey")), _panel(t), "o_custkey", 10))
add("identity_duplicate_rate", f"SELECT sum(c)::bigint AS n, coalesce(sum(c) FILTER (WHERE c > 1 AND o_totalprice IS NOT NULL), 0)::bigint AS duplicates, round(coalesce(sum(c) FILTER (WHERE c > 1 AND o_totalprice IS NOT NULL), 0) / sum(c), 6) AS rate FROM (SELECT o_totalprice, count(*) AS c FROM {PLANTED} GROUP BY 1)")(lambda t: M.duplicate_rate(t.planted(), ["o_totalprice"]))
add("row_count_ratio", f"SELECT round((SELECT count(*) FROM {PLANTED}) / (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0), 6) AS row_count_ratio")(lambda t: t.planted().agg(F.count(F.lit(1)).alias("b")).crossJoin(F.broadcast(t.side("orders", "o_orderkey", 0).agg(F.count(F.lit(1)).alias("a")))).select(F.round(F.col("b") / F.col("a"), 6).alias("row_count_ratio")))

# ---- intervals, noise ------------------------------------------------------------------------------

_W2 = "SELECT o_orderpriority, count(*) FILTER (WHERE o_orderkey % 2 = 0)::double AS n1, count(*) FILTER (WHERE o_orderkey % 2 = 1)::double AS n2, count(*) FILTER (WHERE o_orderkey % 2 = 0 AND o_orderstatus = 'F')::double AS k1, count(*) FILTER (WHERE o_orderkey % 2 = 1 AND o_orderstatus = 'F')::double AS k2 FROM orders GROUP BY 1"
_z = repr(K.Z)
_wl = lambda k, n, s: f"(({k} / {n} + {_z} * {_z} / (2 * {n})) {s} {_z} * sqrt({k} / {n} * (1 - {k} / {n}) / {n} + {_z} * {_z} / (4 * {n} * {n}))) / (1 + {_z} * {_z} / {n})"
_nc = f"SELECT o_orderpriority, d - sqrt(pow(k1 / n1 - {_wl('k1', 'n1', '-')}, 2) + pow({_wl('k2', 'n2', '+')} - k2 / n2, 2)) AS lo, d + sqrt(pow({_wl('k1', 'n1', '+')} - k1 / n1, 2) + pow(k2 / n2 - {_wl('k2', 'n2', '-')}, 2)) AS hi FROM (SELECT *, k1 / n1 - k2 / n2 AS d FROM ({_W2}))"


def _rates(t: Tables) -> DataFrame:
    side = lambda s: F.col("o_orderkey") % 2 == s
    hit = F.col("o_orderstatus") == "F"
    return t.orders.groupBy("o_orderpriority").agg(*[F.count_if(c).cast("double").alias(n) for n, c in (("n1", side(0)), ("n2", side(1)), ("k1", side(0) & hit), ("k2", side(1) & hit))])


_new = lambda: K.newcombe(*[F.col(c) for c in ("k1", "n1", "k2", "n2")])
add("newcombe_intervals", f"SELECT o_orderpriority, round(lo, 6) AS low, round(hi, 6) AS high FROM ({_nc})")(lambda t: _rates(t).select("o_orderpriority", F.round(_new()[0], 6).alias("low"), F.round(_new()[1], 6).alias("high")))
add("folded_intervals", f"SELECT o_orderpriority, round(CASE WHEN lo <= 0 AND hi >= 0 THEN 0 ELSE least(abs(lo), abs(hi)) END, 6) AS low, round(greatest(abs(lo), abs(hi)), 6) AS high FROM ({_nc})")(lambda t: _rates(t).select("o_orderpriority", *[F.round(x, 6).alias(n) for n, x in zip(("low", "high"), K.folded(*_new()), strict=True)]))
_ns = "(VALUES ('column.ks', 500.0::double, 400.0::double, 5.0::double, 3.0::double, 2.0::double), ('column.jsd', 500.0, 400.0, 5.0, 3.0, 2.0), ('pair.pearson_delta', 500.0, 400.0, 5.0, 3.0, 2.0), ('pair.nmi_delta', 500.0, 400.0, 5.0, 3.0, 2.0), ('pair.pearson_delta', 3.0, 400.0, 5.0, 3.0, 2.0), ('column.smd', 500.0, 400.0, 5.0, 3.0, 2.0)) AS m(metric_id, n, m, k, r, c)"
add("noise_dispatch", f"SELECT metric_id, n, round(CASE metric_id WHEN 'column.ks' THEN sqrt(-ln(0.025) / 2) * sqrt((n + m) / (n * m)) WHEN 'column.jsd' THEN (k - 1) * (1 / n + 1 / m) / (8 * ln(2)) WHEN 'pair.pearson_delta' THEN CASE WHEN n > 3 AND m > 3 THEN {_z} * sqrt(1 / (n - 3) + 1 / (m - 3)) END WHEN 'pair.nmi_delta' THEN (r - 1) * (c - 1) / (2 * n) END, 6) AS noise FROM {_ns}")(
    lambda t: K.noise_floors(t.spark.createDataFrame([("column.ks", 500.0, 400.0, 5.0, 3.0, 2.0), ("column.jsd", 500.0, 400.0, 5.0, 3.0, 2.0), ("pair.pearson_delta", 500.0, 400.0, 5.0, 3.0, 2.0), ("pair.nmi_delta", 500.0, 400.0, 5.0, 3.0, 2.0), ("pair.pearson_delta", 3.0, 400.0, 5.0, 3.0, 2.0), ("column.smd", 500.0, 400.0, 5.0, 3.0, 2.0)], "metric_id string, n double, m double, k double, r double, c double")).select("metric_id", "n", F.round("noise", 6).alias("noise"))
)
_sc = "SELECT n_chars % 977 AS score, quality FROM documents JOIN labels USING (doc_id)"
add("delong_interval", f"WITH g AS (SELECT score, count(*) FILTER (WHERE quality = 1) AS p, count(*) FILTER (WHERE quality = 0) AS n FROM ({_sc}) GROUP BY 1), v AS (SELECT *, (sum(n) OVER (ORDER BY score) - n + n / 2) / sum(n) OVER () AS v10, (sum(p) OVER () - sum(p) OVER (ORDER BY score) + p / 2) / sum(p) OVER () AS v01 FROM g), s AS (SELECT sum(p)::double AS tp, sum(n)::double AS tn, sum(p * v10) AS a, sum(p * v10 * v10) AS aa, sum(n * v01) AS b, sum(n * v01 * v01) AS bb FROM v), d AS (SELECT a / tp AS auc, 1.959964::double * sqrt(greatest(0.0, (aa - a * a / tp) / (tp - 1) / tp + (bb - b * b / tn) / (tn - 1) / tn)) AS half FROM s) SELECT round(auc, 6) AS auc, round(greatest(0.0, auc - half), 6) AS ci_low, round(least(1.0, auc + half), 6) AS ci_high FROM d")(lambda t: W.delong(t.documents.join(t.labels, "doc_id").select((F.col("n_chars") % 977).alias("score"), "quality"), "score", "quality"))

# ---- profiles ---------------------------------------------------------------------------------------

_pl = lambda c: f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std, min({c})::double AS minimum, max({c})::double AS maximum FROM lineitem"
add("planning_aggregate", " UNION ALL ".join(map(_pl, NUM)))(lambda t: P.planning(t.lineitem, NUM))
add("string_profile", "SELECT count(*) AS n, count(*) FILTER (WHERE p_name IS NULL) AS n_null, count(*) FILTER (WHERE trim(p_name) = '') AS n_empty, count(DISTINCT p_name) AS n_distinct, min(length(p_name)) AS min_length, max(length(p_name)) AS max_length, round(avg(length(p_name)), 6) AS mean_length FROM part")(lambda t: P.strings(t.part, "p_name"))
add("temporal_profile", "SELECT epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, round(avg((ts = date_trunc('day', ts))::int), 6) AS day_share, round(avg((ts > TIMESTAMP '2024-01-10 00:00:00')::int), 6) AS future_share FROM events")(lambda t: P.temporal(t.events, "ts", "2024-01-10 00:00:00"))
add("null_patterns_with_tail", "WITH p AS (SELECT CASE WHEN nullif(l_linenumber % 3, 0) IS NULL THEN '1' ELSE '0' END || CASE WHEN nullif(l_returnflag, 'A') IS NULL THEN '1' ELSE '0' END || CASE WHEN l_linenumber = 1 THEN '1' ELSE '0' END AS pattern, count(*) AS n FROM lineitem GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, pattern) AS r FROM p) SELECT CASE WHEN r <= 3 THEN pattern ELSE '<tail>' END AS pattern, sum(n)::bigint AS n FROM r GROUP BY 1")(lambda t: P.null_patterns_tail(t.lineitem.select(F.expr("nullif(l_linenumber % 3, 0)").alias("a"), F.expr("nullif(l_returnflag, 'A')").alias("b"), F.expr("CASE WHEN l_linenumber = 1 THEN NULL ELSE 1 END").alias("c")), ["a", "b", "c"], 3))
add("value_literals", f"SELECT {H.format(salt='code', key='o_orderpriority')} AS code, min(o_orderpriority) AS literal FROM orders GROUP BY 1")(lambda t: P.literals(t.orders, "o_orderpriority", "code"))
add("profile_payloads", "SELECT o_orderpriority AS value, count(*) AS n, '{\"value\":\"' || o_orderpriority || '\",\"n\":' || count(*)::varchar || '}' AS payload FROM orders GROUP BY 1")(lambda t: P.payloads(t.orders.groupBy(F.col("o_orderpriority").alias("value")).agg(F.count(F.lit(1)).alias("n"))))


# ---- vectors ---------------------------------------------------------------------------------------

_c1 = "SELECT c_custkey AS id, c_acctbal, c_nationkey, rank FROM (SELECT *, row_number() OVER (ORDER BY md5(c_custkey::varchar)) AS rank FROM customer) WHERE rank <= 4000"
_half = "(least(4000, (SELECT count(*) FROM customer)) + 1) // 2"
_pair = lambda q: f"SELECT id, min(d) FILTER (WHERE n = 1) AS d1, min(d) FILTER (WHERE n = 2) AS d2 FROM (SELECT q.id, d, row_number() OVER (PARTITION BY q.id ORDER BY d) AS n FROM (SELECT q.id, round((least(1.0, abs(q.x - r.c_acctbal) / 11000) + (q.y <> r.c_nationkey)::int) / 2, 8) AS d FROM ({q}) q, (SELECT * FROM p WHERE rank <= {_half}) r) q) WHERE n <= 2 GROUP BY id"
_p5 = lambda x: f"SELECT round(quantile_cont(d1, 0.05), 6) AS a, round(quantile_cont(round(CASE WHEN d2 > 0 THEN d1 / d2 ELSE 1.0 END, 8), 0.05), 6) AS b FROM ({x})"


def _near(t: Tables, synthetic: bool) -> DataFrame:
    both = S.panel(t.customer.select("c_custkey", F.col("c_acctbal").alias("s_acctbal"), F.col("c_nationkey").alias("s_nationkey")), F.col("c_custkey"), 2000, 1)
    asked = t.supplier if synthetic else both.where("side = 'H'").withColumnRenamed("c_custkey", "s_suppkey")
    return W.gower_nearest(asked, both.where("side = 'R'"), {"s_acctbal": 11_000.0}, ["s_nationkey"], "s_suppkey")


add("nearest_percentiles", f"WITH p AS ({_c1}), s AS ({_p5(_pair('SELECT s_suppkey AS id, s_acctbal AS x, s_nationkey AS y FROM supplier'))}), h AS ({_p5(_pair(f'SELECT id, c_acctbal AS x, c_nationkey AS y FROM p WHERE rank > {_half}'))}) SELECT round(CASE WHEN h.a > 0 THEN s.a / h.a END, 4) AS dcr_p5_ratio, round(CASE WHEN h.b > 0 THEN s.b / h.b END, 4) AS nndr_p5_ratio FROM s, h")(lambda t: W.nearest_percentiles(_near(t, True), _near(t, False)))
_cen = "SELECT label, list(mean ORDER BY pos) AS m FROM (SELECT label, pos, round(avg(x::double), 5) AS mean FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY label, pos) GROUP BY label"
add("centroid_exemplars", f"WITH c AS ({_cen}), s AS (SELECT label, vec_id, round(list_sum(list_transform(list_zip(embedding, m), lambda z: z[1]::double * z[2])), 5) AS score FROM embeddings JOIN c USING (label)) SELECT label, vec_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 3")(lambda t: W.nearest_to_centroid(t.embeddings, "label", 3))
add("farthest_first", None)(lambda t: W.k_center(t.embeddings, 5))
add("marginal_relevance", None)(lambda t: W.marginal_relevance(W.search(t.embeddings.where("vec_id % 100 = 0"), t.embeddings, 10), t.embeddings, 4, 0.5))

# ---- generation ---------------------------------------------------------------------------------------

add("temporal_draw", "WITH q AS (SELECT list_transform(quantile_cont(epoch_us(ts)::double, [0.0, 0.25, 0.5, 0.75, 1.0]), lambda z: round(z, 6)) AS q FROM events), e AS (SELECT o_orderkey, {u} AS u, {v} AS v, floor({u} * 4)::int AS a, q FROM orders, q) SELECT o_orderkey, (floor(CASE WHEN v < 0.1 THEN q[1] + (q[5] - q[1]) * u ELSE q[a + 1] + (q[least(a + 2, 5)] - q[a + 1]) * (u * 4 - a) END))::bigint // 1000 AS ms FROM e".format(u=U.format(salt="tmp", key="o_orderkey"), v=U.format(salt="tmp|spread", key="o_orderkey")))(
    lambda t: G.temporal(t.orders.select("o_orderkey"), G.quantile_grid(t.events.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("us")), "us", 5), "us", "o_orderkey", "tmp").select("o_orderkey", F.floor(F.col("us") / 1000).cast("long").alias("ms"))
)
add("clamped_draw", f"SELECT o_orderkey, round(greatest(-500.0, least(7000.0, {U.format(salt='clamp', key='o_orderkey')} * 12000 - 2000)), 1) AS balance FROM orders")(lambda t: t.orders.select("o_orderkey", G.clamped(G.unit(F.col("o_orderkey"), "clamp") * 12000 - 2000, F.lit(-500.0), F.lit(7000.0), 1).alias("balance")))
_scr = " UNION ALL ".join(f"SELECT o_orderkey, {i} AS a, {H.format(salt=f'scrub|{i}', key='o_orderkey')} % 4000 AS v FROM orders" for i in range(8))
add("collision_scrub", f"WITH d AS ({_scr}), f AS (SELECT o_orderkey, min_by(v, a) AS v FROM d WHERE v NOT IN (SELECT c_custkey FROM customer) GROUP BY 1) SELECT o_orderkey, coalesce(v, 4000 + {H.format(salt='scrub|rest', key='o_orderkey')}) AS new_id FROM orders LEFT JOIN f USING (o_orderkey)")(lambda t: G.scrubbed(t.orders.select("o_orderkey"), t.customer.select(F.col("c_custkey").alias("value")), "new_id", "o_orderkey", "scrub", 4000))


def _ipf(sweeps: int) -> str:
    parts = ["w0 AS (SELECT DISTINCT c_nationkey AS a, c_mktsegment AS b, 1.0::double AS w FROM customer)", "ma AS (SELECT s_nationkey AS a, count(*)::double AS want FROM supplier GROUP BY 1)", "mb AS (SELECT c_mktsegment AS b, count(*)::double AS want FROM customer WHERE c_acctbal > 0 GROUP BY 1)"]
    for i in range(2 * sweeps):
        x = "ab"[i % 2]
        parts.append(f"w{i + 1} AS (SELECT a, b, w * coalesce((SELECT want FROM m{x} WHERE m{x}.{x} = w{i}.{x}), 0.5) / sum(w) OVER (PARTITION BY {x}) AS w FROM w{i})")
    return ", ".join(parts) + f", wt AS (SELECT a, b, greatest(1, round(w / sum(w) OVER () * 1e6))::bigint AS weight FROM w{2 * sweeps})"


def _fitted(t: Tables) -> DataFrame:
    child = t.supplier.select(F.col("s_nationkey").alias("x"), F.lit(None).cast("string").alias("y")).union(t.customer.where("c_acctbal > 0").select(F.lit(None).cast("int"), "c_mktsegment"))
    return G.fitted_tuples(t.customer.select(F.col("c_nationkey").alias("a"), F.col("c_mktsegment").alias("b")), child, [("x", "a"), ("y", "b")], 2)


add("fitted_tuples", f"WITH {_ipf(2)} SELECT a, b, round(weight / 10.0)::bigint AS tens FROM wt")(lambda t: _fitted(t).select("a", "b", F.round(F.col("weight") / 10).cast("long").alias("tens")))
_tu = "SELECT l_partkey, l_suppkey, count(*) AS weight, lpad(l_partkey::varchar, 20, '0') || '|' || lpad(l_suppkey::varchar, 20, '0') AS o FROM lineitem WHERE l_partkey % 10 = 3 GROUP BY 1, 2"
add("joint_keys", f"WITH t AS ({_tu}), c AS (SELECT *, sum(weight) OVER (ORDER BY o) - weight AS lo, sum(weight) OVER () AS n FROM t), d AS (SELECT c_custkey, floor({U.format(salt='joint', key='c_custkey')} * (SELECT sum(weight) FROM t))::bigint AS x FROM customer) SELECT c_custkey, l_partkey, l_suppkey FROM d JOIN c ON x >= lo AND x < lo + weight")(lambda t: G.joint_keys(t.customer.select("c_custkey"), t.lineitem.where("l_partkey % 10 = 3").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("weight")), ["l_partkey", "l_suppkey"], "c_custkey", "joint"))
add("multi_parent_keys", "WITH a AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS i FROM supplier), b AS (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS i FROM nation) SELECT o_orderkey, s_suppkey, n_nationkey FROM orders JOIN a ON a.i = o_orderkey % 10 JOIN b ON b.i = (o_orderkey // 10) % 25")(lambda t: G.multi_parent(t.orders.select("o_orderkey"), "o_orderkey", [("s_suppkey", G.numbered(t.supplier, "s_suppkey")), ("n_nationkey", G.numbered(t.nation, "n_nationkey"))], [10, 25]))

# ---- validation and scores -----------------------------------------------------------------------------

_bt = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string", "o_comment": "string"}


def _batch(t: Tables) -> DataFrame:
    return V.batch(t.planted(), _bt, ["o_custkey"], {"o_orderpriority": 8}, {"o_totalprice": (0.0, 400_000.0)}, {"o_orderstatus": ["F", "O", "P"]}, {"o_orderpriority": "^[0-9]-"}, ["o_custkey", "o_totalprice"])


_r = lambda rule, col, checked, failed: f"SELECT '{rule}' AS rule, '{col}' AS \"column\", ({checked})::bigint AS checked, ({failed})::bigint AS failed FROM p"
_bsql = f"WITH p AS (SELECT * FROM {PLANTED}), b AS (" + " UNION ALL ".join([*[_r("schema.types", c, "count(*)", "count(*)" if c == "o_comment" else "0") for c in _bt], _r("schema.batch", "o_comment", "count(*)", "count(*)"), _r("null.required", "o_custkey", "count(*)", "count(*) FILTER (WHERE o_custkey IS NULL)"), _r("schema.batch", "o_orderpriority", "count(o_orderpriority)", "count(*) FILTER (WHERE length(o_orderpriority) > 8)"), _r("range.numeric", "o_totalprice", "count(o_totalprice)", "count(*) FILTER (WHERE o_totalprice < 0 OR o_totalprice > 400000)"), _r("enum.member", "o_orderstatus", "count(o_orderstatus)", "count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P'))"), _r("regex.format", "o_orderpriority", "count(o_orderpriority)", "count(*) FILTER (WHERE NOT regexp_matches(o_orderpriority, '^[0-9]-'))"), "SELECT 'pk.duplicate', 'o_custkey,o_totalprice', sum(c)::bigint, sum(c - 1)::bigint FROM (SELECT count(*) AS c FROM p GROUP BY o_custkey, o_totalprice)"]) + ")"
add("batch_validation", f"{_bsql} SELECT * FROM b")(_batch)
_rc = "(VALUES " + ", ".join(f"('{a}', '{b}', '{c}', {d}::double)" for a, b, c, d in V.RULES) + ") AS r(rule, dimension, severity, threshold)"
add("validation_gate", f"{_bsql}, f AS (SELECT severity FROM b JOIN {_rc} USING (rule) WHERE failed > 0) SELECT count(*) FILTER (WHERE severity = 'BLOCKER') AS blocker, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical, count(*) FILTER (WHERE severity = 'MAJOR') AS major, CASE WHEN count(*) FILTER (WHERE severity <> 'MAJOR') > 0 THEN 'FAILED' ELSE 'PASSED' END AS verdict FROM f")(lambda t: V.gate(_batch(t)))
add("rule_catalogue", f"SELECT * FROM {_rc}")(lambda t: V.rule_catalogue(t.spark))
add("shape_and_trend", f"SELECT table_name, round(avg(score) FILTER (WHERE starts_with(metric_id, 'column.')), 6) AS column_shape_score, round(avg(score) FILTER (WHERE starts_with(metric_id, 'pair.')), 6) AS pair_trend_score FROM {SCORED} GROUP BY 1")(lambda t: K.shape_and_trend(_scored(t)))
add("model_families", f"WITH u AS (SELECT table_name, family, unit, avg(score) AS s FROM {SCORED} WHERE score IS NOT NULL GROUP BY ALL) SELECT family, round(avg(s), 6) AS score FROM (SELECT table_name, family, avg(s) AS s FROM u GROUP BY ALL) GROUP BY family")(lambda t: K.model_families(_scored(t)))
add("fail_on", f"SELECT count(*) FILTER (WHERE status IN ('FAIL', 'WARN')) AS hits, (count(*) FILTER (WHERE status IN ('FAIL', 'WARN')) > 0)::int AS exit_code FROM {SCORED}")(lambda t: K.fail_on(_scored(t), ["FAIL", "WARN"]))


# ---- streams, functions, profiles as rows ---------------------------------------------------------------

_ts = lambda t: t.events.withColumn("ts", F.col("ts").cast("timestamp"))
add("sliding_windows", "SELECT epoch_us(w) AS start_us, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT value, unnest([time_bucket(INTERVAL '30 minutes', ts), time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes']) AS w FROM events) GROUP BY 1")(lambda t: E.sliding(_ts(t), "1 hour", "30 minutes"))
add("session_windows", "WITH g AS (SELECT user_id, ts, coalesce(ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '20 minutes', true)::int AS new FROM events), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts, new DESC ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS n FROM s GROUP BY user_id, s")(lambda t: E.sessions(_ts(t), "20 minutes"))
add("first_events", "SELECT DISTINCT user_id, event_type FROM events")(lambda t: E.first_of(_ts(t), ["user_id", "event_type"]).select("user_id", "event_type"))


def _by_sql(t: Tables) -> DataFrame:
    from ..functions import sql

    sql.register(t.spark)
    t.part.createOrReplaceTempView("_parts")
    return t.spark.sql("SELECT p_partkey, shape_mask(p_name) AS mask, round(unit_of(cast(p_partkey AS string), 'sql'), 9) AS u, is_substantive(p_name) AS ok, stable_round(p_retailprice, 2) AS price FROM _parts")


add("sql_functions", f"SELECT p_partkey, {_mask.format(c='p_name').replace('␣', ' ')} AS mask, round({U.format(salt='sql', key='p_partkey')}, 9) AS u, p_name IS NOT NULL AND trim(p_name) <> '' AS ok, round(p_retailprice * pow(10, 1 - floor(log10(abs(p_retailprice))))) / pow(10, 1 - floor(log10(abs(p_retailprice)))) AS price FROM part")(_by_sql)


def _pieces(t: Tables) -> DataFrame:
    from ..functions import sql

    sql.register(t.spark)
    t.part.createOrReplaceTempView("_parts")
    return t.spark.sql("SELECT p_partkey, x.part, x.text FROM _parts, LATERAL pieces(p_name, 4) AS x")


add("table_function", "SELECT p_partkey, i::int AS part, substr(p_name, (4 * i + 1)::int, 4) AS text FROM (SELECT p_partkey, p_name, unnest(range(0, (length(p_name) + 3) // 4)) AS i FROM part)")(_pieces)


def _gini(t: Tables) -> DataFrame:
    from ..functions import sql

    sql.register(t.spark)
    t.supplier.createOrReplaceTempView("_suppliers")
    return t.spark.sql("SELECT s_nationkey, round(gini(abs(s_acctbal)), 6) AS gini FROM _suppliers GROUP BY s_nationkey")


add("aggregate_function", "WITH r AS (SELECT s_nationkey, abs(s_acctbal) AS v, row_number() OVER (PARTITION BY s_nationkey ORDER BY abs(s_acctbal)) AS i, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier) SELECT s_nationkey, round(2 * sum(v * i) / (max(n) * sum(v)) - (max(n) + 1) / max(n), 6) AS gini FROM r GROUP BY 1")(_gini)
_tp = lambda c: f"SELECT '{c}' AS col, {c}::varchar AS v, count(*) AS c FROM orders WHERE {{w}} GROUP BY {c}"


def _tps(w: str) -> str:
    by = " UNION ALL ".join(_tp(c).format(w=w) for c in ("o_orderstatus", "o_orderpriority"))
    one = f"SELECT col, sum(c)::double AS r, coalesce(sum(c) FILTER (WHERE v IS NULL), 0)::double AS nulls, count(v)::double AS d, round(abs(log2(sum(c) FILTER (WHERE v IS NOT NULL)) - sum(c * log2(c)) FILTER (WHERE v IS NOT NULL) / sum(c) FILTER (WHERE v IS NOT NULL)), 6) AS h, round(max(c) FILTER (WHERE v IS NOT NULL) / sum(c) FILTER (WHERE v IS NOT NULL), 6) AS t, (count(*) FILTER (WHERE v IS NOT NULL AND c = 1))::double AS s FROM ({by}) GROUP BY col"
    return " UNION ALL ".join(f'SELECT col AS "column", \'{n}\' AS statistic, {c} AS value FROM ({one})' for n, c in (("rows", "r"), ("nulls", "nulls"), ("distinct", "d"), ("entropy", "h"), ("top1_share", "t"), ("singletons", "s")))


_PR = ["o_orderstatus", "o_orderpriority"]
add("table_profile", _tps("true"))(lambda t: P.table_profile(t.orders, _PR))
add("profile_difference", f'SELECT a."column", a.statistic, a.value AS value_a, b.value AS value_b, round(b.value - a.value, 6) AS delta FROM ({_tps("o_orderkey % 2 = 0")}) a JOIN ({_tps("o_orderkey % 2 = 1")}) b ON a."column" = b."column" AND a.statistic = b.statistic')(lambda t: P.profile_diff(*[P.table_profile(t.side("orders", "o_orderkey", s), _PR) for s in (0, 1)]))
add("copy_flags", f'SELECT col AS "column", count(*) FILTER (WHERE c_src > 0) AS source_distinct, round(count(*) FILTER (WHERE c_src > 0 AND c_syn > 0) / count(*) FILTER (WHERE c_src > 0), 6) AS copied FROM ({SHARES}) GROUP BY col HAVING count(*) FILTER (WHERE c_src > 0) > 2 AND count(*) FILTER (WHERE c_src > 0 AND c_syn > 0) >= 0.3 * count(*) FILTER (WHERE c_src > 0)')(lambda t: P.copy_flags(C.census(_both(t), CENSUS), 2, 0.3))
add("rate_ratio_intervals", None)(lambda t: K.rate_ratios(_rates(t).select(*[F.col(c).cast("long").alias(c) for c in ("k1", "n1", "k2", "n2")], "o_orderpriority")))
