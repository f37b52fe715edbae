"""Noise floors, scores, statuses and roll-ups of metric rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Z = 1.959964

#: Metric id, family, direction (L lower, H higher, T target), target, warn, fail.
CATALOGUE = [
    ("field.category_adherence", "fidelity", "H", 1.0, 0.99, 0.95),
    ("field.range_adherence", "fidelity", "H", 1.0, 0.99, 0.95),
    ("field.shape_adherence", "fidelity", "H", 1.0, 0.95, 0.8),
    ("field.substantive_copy_rate", "privacy", "L", 0.0, 0.0001, 0.001),
    ("field.value_memorization_lift", "privacy", "L", 1.0, 2.0, 5.0),
    ("field.pool_memorization_lift", "privacy", "L", 1.0, 2.0, 5.0),
    ("field.type_validity", "integrity", "H", 1.0, 0.9999, 0.999),
    ("column.null_rate_delta", "fidelity", "L", 0.0, 0.02, 0.05),
    ("column.empty_rate_delta", "fidelity", "L", 0.0, 0.02, 0.05),
    ("column.ks", "fidelity", "L", 0.0, 0.1, 0.2),
    ("column.pit_w1", "fidelity", "L", 0.0, 0.05, 0.1),
    ("column.wasserstein", "fidelity", "L", 0.0, None, None),
    ("column.decile_ks_legacy", "fidelity", "L", 0.0, 0.2, 0.4),
    ("column.jsd", "fidelity", "L", 0.0, 0.05, 0.1),
    ("column.tvd", "fidelity", "L", 0.0, 0.1, 0.2),
    ("column.psi", "fidelity", "L", 0.0, 0.1, 0.25),
    ("column.smd", "fidelity", "L", 0.0, 0.1, 0.2),
    ("column.std_ratio", "fidelity", "T", 1.0, 0.1, 0.25),
    ("column.zero_rate_delta", "fidelity", "L", 0.0, 0.02, 0.05),
    ("column.range_coverage", "diversity", "H", 1.0, 0.9, 0.75),
    ("column.dow_tvd", "fidelity", "L", 0.0, 0.1, 0.2),
    ("column.month_tvd", "fidelity", "L", 0.0, 0.1, 0.2),
    ("column.hour_tvd", "fidelity", "L", 0.0, 0.1, 0.2),
    ("column.cohens_w", "fidelity", "L", 0.0, 0.1, 0.3),
    ("column.top1_share_delta", "diversity", "L", 0.0, 0.05, 0.15),
    ("column.coverage_mass", "diversity", "H", 1.0, 0.95, 0.8),
    ("column.novelty_mass", "diversity", "T", 0.0, 0.1, 0.25),
    ("column.entropy_ratio", "diversity", "T", 1.0, 0.1, 0.25),
    ("column.distinct_ratio", "diversity", "T", 1.0, 0.1, 0.3),
    ("column.distinct_ceiling_hit", "diversity", "L", 0.0, 0.5, 1.0),
    ("column.length_ks", "fidelity", "L", 0.0, 0.1, 0.2),
    ("column.shape_head_tv", "fidelity", "L", 0.0, 0.1, 0.2),
    ("column.char_class_l1", "fidelity", "L", 0.0, 0.1, 0.2),
    ("column.source_stats_drift", "integrity", "L", 0.0, 0.05, 0.15),
    ("pair.pearson_delta", "fidelity", "L", 0.0, 0.1, 0.2),
    ("pair.spearman_delta", "fidelity", "L", 0.0, 0.1, 0.2),
    ("pair.cramers_v_delta", "fidelity", "L", 0.0, 0.1, 0.2),
    ("pair.nmi_delta", "fidelity", "L", 0.0, 0.05, 0.15),
    ("pair.contingency_tvd", "fidelity", "L", 0.0, 0.1, 0.2),
    ("row.exact_match_rate", "privacy", "L", 0.0, 1e-05, 0.0001),
    ("row.exact_match_rate_nonkey", "privacy", "L", 0.0, 0.001, 0.01),
    ("row.memorization_lift", "privacy", "L", 1.0, 2.0, 5.0),
    ("row.exposure_lift", "privacy", "L", 1.0, 2.0, 5.0),
    ("row.near_match_rate", "privacy", "L", 0.0, 0.001, 0.01),
    ("row.near_match_lift", "privacy", "L", 1.0, 2.0, 5.0),
    ("row.internal_duplicate_excess", "diversity", "L", 0.0, 0.01, 0.05),
    ("row.dcr_train_holdout_share", "privacy", "L", 0.5, 0.55, 0.6),
    ("row.dcr_p5_ratio", "privacy", "H", 1.0, 0.8, 0.5),
    ("row.nndr_p5_ratio", "privacy", "H", 1.0, 0.8, 0.5),
    ("row.density", "fidelity", "T", 1.0, 0.2, 0.4),
    ("row.coverage", "diversity", "H", 1.0, 0.85, 0.7),
    ("row.null_pattern_tvd", "fidelity", "L", 0.0, 0.1, 0.2),
    ("table.row_count_ratio", "integrity", "T", 1.0, 0.01, 0.05),
    ("table.pk_duplicate_rate", "integrity", "L", 0.0, 0.0, 0.0),
    ("table.identity_duplicate_rate", "integrity", "L", 0.0, 0.0, 0.0),
    ("table.detection_auc", "fidelity", "L", 0.5, 0.7, 0.85),
    ("table.pmse_ratio", "fidelity", "L", 0.0, 3.0, 10.0),
    ("table.corr_rms_delta", "fidelity", "L", 0.0, 0.05, 0.1),
    ("table.corr_max_delta", "fidelity", "L", 0.0, 0.15, 0.3),
    ("relationship.orphan_rate", "integrity", "L", 0.0, 0.0, 0.0),
    ("relationship.orphan_rate_source", "integrity", "L", 0.0, None, None),
    ("relationship.fanout_tvd", "fidelity", "L", 0.0, 0.1, 0.2),
    ("relationship.fanout_w1", "fidelity", "L", 0.0, None, None),
    ("relationship.fanout_mean_ratio", "fidelity", "T", 1.0, 0.05, 0.15),
    ("relationship.zero_child_share_delta", "fidelity", "L", 0.0, 0.02, 0.05),
    ("relationship.cardinality_adherence", "fidelity", "H", 1.0, 0.99, 0.95),
    ("relationship.parent_coverage", "diversity", "H", 1.0, 0.95, 0.8),
]
CATALOGUE_SCHEMA = "metric_id string, family string, direction string, target double, warn double, fail double"


def catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATALOGUE, CATALOGUE_SCHEMA)


def wilson(k: Column, n: Column, z: float = Z) -> tuple[Column, Column]:
    """Bounds of a share k / n."""
    p, d = k / n, 1 + z * z / n
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return (p + z * z / (2 * n) - half) / d, (p + z * z / (2 * n) + half) / d


def newcombe(k1: Column, n1: Column, k2: Column, n2: Column, z: float = Z) -> tuple[Column, Column]:
    """Bounds of k1 / n1 - k2 / n2 from two Wilson intervals."""
    (l1, u1), (l2, u2), p1, p2 = wilson(k1, n1, z), wilson(k2, n2, z), k1 / n1, k2 / n2
    return p1 - p2 - F.sqrt((p1 - l1) ** 2 + (u2 - p2) ** 2), p1 - p2 + F.sqrt((u1 - p1) ** 2 + (p2 - l2) ** 2)


def dkw(n: Column, alpha: float = 0.05) -> Column:
    return F.sqrt(F.lit(math.log(2 / alpha)) / (2 * n))


def ks_critical(n: Column, m: Column, alpha: float = 0.05) -> Column:
    return F.lit(math.sqrt(-math.log(alpha / 2) / 2)) * F.sqrt((n + m) / (n * m))


def fisher_floor(n: Column, m: Column, z: float = Z) -> Column:
    """Noise of a difference of correlations, by Fisher's transform near 0."""
    return F.lit(z) * F.sqrt(1 / (n - 3) + 1 / (m - 3))


def folded(low: Column, high: Column) -> tuple[Column, Column]:
    """Bounds of an absolute value from those of the signed one."""
    a, b = F.abs(low), F.abs(high)
    return F.when((low <= 0) & (high >= 0), 0.0).otherwise(F.least(a, b)), F.greatest(a, b)


#: How far chance alone moves a metric, by metric; those without an entry have an interval or none.
NOISE = {
    "ks_two_sample": ["column.ks", "column.length_ks"],
    "jsd_null": ["column.jsd"],
    "fisher_z": ["pair.pearson_delta", "pair.spearman_delta"],
    "mi_bias": ["pair.nmi_delta"],
    "tvd_null": ["column.tvd", "column.dow_tvd", "column.month_tvd", "column.hour_tvd", "column.shape_head_tv", "pair.contingency_tvd", "row.null_pattern_tvd", "relationship.fanout_tvd"],
}


def noise_floors(rows: DataFrame) -> DataFrame:
    """``rows`` (metric_id and sizes n, m; k categories, r rows and c columns, or ``floor`` where it was measured) with ``noise``.

    Null where the metric has no scalar floor or a size is missing or too small.
    """
    has = lambda x: F.col(x) if x in rows.columns else F.lit(None).cast("double")
    n, m, k, r, c = (has(x) for x in "nmkrc")
    good = (n > 0) & (m > 0)
    of = lambda method: F.col("metric_id").isin(NOISE[method])
    noise = (
        F.when(of("ks_two_sample"), F.when(good, ks_critical(n, m)))
        .when(of("jsd_null"), F.when(good & (k > 0), (k - 1) * (1 / n + 1 / m) / (8 * math.log(2.0))))
        .when(of("fisher_z"), F.when((n > 3) & (m > 3), fisher_floor(n, m)))
        .when(of("mi_bias"), F.when((n > 0) & (r > 0) & (c > 0), (r - 1) * (c - 1) / (2 * n)))
        .when(of("tvd_null"), has("floor"))
    )
    return rows.withColumn("noise", noise)


def status(value: Column, direction: Column, target: Column, warn: Column, fail: Column, noise: Column) -> Column:
    """NOT_EVALUATED, INFO, PASS, WARN or FAIL. Crossings are inclusive; one within noise passes, but
    for metrics with both thresholds 0 any excess fails."""
    distance = F.when(direction == "T", F.abs(value - target)).otherwise(value)
    tol = lambda t: 1e-9 * F.greatest(F.abs(t), F.lit(1.0))
    crossed = lambda t: F.when(direction == "H", distance <= t + tol(t)).otherwise(distance >= t - tol(t))
    within = F.when(direction == "H", target - distance <= F.coalesce(noise, F.lit(0.0))).when(direction == "T", distance <= F.coalesce(noise, F.lit(0.0))).otherwise(distance - target <= F.coalesce(noise, F.lit(0.0)))
    hard = (warn == 0) & (fail == 0)
    return (
        F.when(value.isNull() | F.isnan(value), "NOT_EVALUATED")
        .when(warn.isNull() | fail.isNull(), "INFO")
        .when(hard, F.when(value > 0, "FAIL").otherwise("PASS"))
        .when(crossed(fail) & ~within, "FAIL")
        .when(crossed(warn) & ~within, "WARN")
        .otherwise("PASS")
    )


def score(value: Column, direction: Column, target: Column, fail: Column) -> Column:
    """1 at the target, 0.5 at the fail threshold, linear, not below 0."""
    span = F.when(direction == "T", fail).otherwise(F.abs(fail - target))
    off = F.when(direction == "H", F.greatest(F.lit(0.0), target - value)).when(direction == "T", F.abs(value - target)).otherwise(F.greatest(F.lit(0.0), value - target))
    return F.when(span > 0, F.greatest(F.lit(0.0), 1 - off / (2 * span))).otherwise((off <= 0).cast("double"))


def scored(metrics: DataFrame) -> DataFrame:
    """Metric rows (metric_id, value, noise, ...) with family, status and score from the catalogue (66 rows, broadcast)."""
    known = catalogue(metrics.sparkSession)
    out = metrics.join(F.broadcast(known), "metric_id", "left")
    c = F.col
    return out.withColumn("status", status(c("value"), c("direction"), c("target"), c("warn"), c("fail"), c("noise"))).withColumn("score", F.when(~c("status").isin("NOT_EVALUATED", "INFO"), F.round(score(c("value"), c("direction"), c("target"), c("fail")), 6)))


def rollup(rows: DataFrame) -> DataFrame:
    """level, table_name, family, score: mean over units, then families of a table, then tables, then all."""
    unit = rows.where("score IS NOT NULL").groupBy("table_name", "family", "unit").agg(F.avg("score").alias("s"))
    fam = unit.groupBy("table_name", "family").agg(F.avg("s").alias("s"))
    table = fam.groupBy("table_name").agg(F.avg("s").alias("s"))
    model = table.agg(F.avg("s").alias("s"))
    none = F.lit(None).cast("string")
    parts = [
        fam.select(F.lit("family").alias("level"), "table_name", "family", F.round("s", 6).alias("score")),
        table.select(F.lit("table").alias("level"), "table_name", none.alias("family"), F.round("s", 6).alias("score")),
        model.select(F.lit("model").alias("level"), none.alias("table_name"), none.alias("family"), F.round("s", 6).alias("score")),
    ]
    return parts[0].union(parts[1]).union(parts[2])


def headline(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def compare_runs(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """keys..., value_a, value_b, delta, change: two runs' metric rows matched with NULL equal to NULL."""
    on = None
    for k in keys:
        test = F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        on = test if on is None else on & test
    met = a.alias("a").join(b.alias("b"), on, "full_outer")
    change = F.when(F.col("a.value").isNull(), "added").when(F.col("b.value").isNull(), "removed").when(F.col("a.value") == F.col("b.value"), "same").otherwise("changed")
    return met.select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys], F.col("a.value").alias("value_a"), F.col("b.value").alias("value_b"), F.round(F.col("b.value") - F.col("a.value"), 6).alias("delta"), change.alias("change"))


def overridden(metrics: DataFrame, thresholds: dict[str, tuple[float, float]]) -> DataFrame:
    """Scored rows under other warn and fail limits for some metrics (a few literals)."""
    rows = scored(metrics)
    for name, (warn, fail) in thresholds.items():
        mine = F.col("metric_id") == name
        rows = rows.withColumn("warn", F.when(mine, F.lit(float(warn))).otherwise(F.col("warn"))).withColumn("fail", F.when(mine, F.lit(float(fail))).otherwise(F.col("fail")))
    c = F.col
    rows = rows.withColumn("status", status(c("value"), c("direction"), c("target"), c("warn"), c("fail"), c("noise")))
    return rows.withColumn("score", F.when(~c("status").isin("NOT_EVALUATED", "INFO"), F.round(score(c("value"), c("direction"), c("target"), c("fail")), 6)))


def fail_on(rows: DataFrame, statuses: list[str]) -> DataFrame:
    """One row: how many rows have one of the statuses, and the exit code of a run that fails on them."""
    return rows.agg(F.count_if(F.col("status").isin(statuses)).alias("hits")).withColumn("exit_code", F.when(F.col("hits") > 0, 1).otherwise(0))


def shape_and_trend(rows: DataFrame) -> DataFrame:
    """table_name, column_shape_score, pair_trend_score: means of the column and of the pair metrics' scores."""
    mean = lambda p: F.round(F.avg(F.when(F.col("metric_id").startswith(p), F.col("score"))), 6)
    return rows.groupBy("table_name").agg(mean("column.").alias("column_shape_score"), mean("pair.").alias("pair_trend_score"))


def model_families(rows: DataFrame) -> DataFrame:
    """family, score: each family's mean over tables, of means over units."""
    unit = rows.where("score IS NOT NULL").groupBy("table_name", "family", "unit").agg(F.avg("score").alias("s"))
    return unit.groupBy("table_name", "family").agg(F.avg("s").alias("s")).groupBy("family").agg(F.round(F.avg("s"), 6).alias("score"))


def rate_ratios(rows: DataFrame) -> DataFrame:
    """``rows`` (k1, n1, k2, n2: hits and trials of two groups) with ci_low and ci_high of the ratio of the rates, conditional on k1 + k2."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    from .planning import rate_ratio

    def run(frames):
        for f in frames:
            bounds = [rate_ratio(*map(int, r)) if r[0] + r[2] else (0.0, math.inf) for r in f[["k1", "n1", "k2", "n2"]].itertuples(index=False)]
            yield f.assign(ci_low=[b[0] for b in bounds], ci_high=[b[1] for b in bounds])

    return rows.mapInPandas(run, StructType([*rows.schema.fields, StructField("ci_low", DoubleType()), StructField("ci_high", DoubleType())]))
