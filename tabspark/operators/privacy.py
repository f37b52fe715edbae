"""Density and coverage, detection by a classifier, propensity, rarefied duplicates, matched-size diversity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def squared_distance(a: list[Column], b: list[Column]) -> Column:
    return sum(((x - y) * (x - y) for x, y in zip(a, b, strict=True)), F.lit(0.0))


def density_coverage(real: DataFrame, synthetic: DataFrame, features: list[str], k: int, *, id_col: str) -> DataFrame:
    """One row: density (mean number of real k-NN balls over a synthetic row, over k) and coverage.

    Both sides are bounded panels (samples of stated size), met by a broadcast join.
    """
    r = real.select(F.col(id_col).alias("_i"), *[F.col(c).cast("double").alias(f"r_{c}") for c in features])
    other = real.select(F.col(id_col).alias("_j"), *[F.col(c).cast("double").alias(f"o_{c}") for c in features])
    s = synthetic.select(F.col(id_col).alias("_s"), *[F.col(c).cast("double").alias(f"s_{c}") for c in features])
    at = lambda p: [F.col(f"{p}_{c}") for c in features]
    near = r.join(F.broadcast(other), F.col("_i") != F.col("_j")).withColumn("_d", F.round(squared_distance(at("r"), at("o")), 8))
    radius = near.withColumn("_n", F.row_number().over(Window.partitionBy("_i").orderBy("_d", "_j"))).where(F.col("_n") == k).select("_i", F.col("_d").alias("_r2"), *[f"r_{c}" for c in features])
    balls = s.join(F.broadcast(radius), F.round(squared_distance(at("s"), at("r")), 8) <= F.col("_r2")).groupBy("_i").agg(F.count(F.lit(1)).alias("_c"))
    n = synthetic.agg(F.count(F.lit(1)).alias("n"))
    m = real.agg(F.count(F.lit(1)).alias("m"))
    return balls.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("c"), F.count(F.lit(1)).alias("b")).crossJoin(F.broadcast(n)).crossJoin(F.broadcast(m)).select(F.round(F.col("c") / (k * F.col("n")), 6).alias("density"), F.round(F.col("b") / F.col("m"), 6).alias("coverage"))


def out_of_fold_scores(both: DataFrame, features: list[str], key: str, *, folds: int = 5, boosted: bool = True) -> DataFrame:
    """key, side, score: each row scored by a classifier that other folds trained (folds by md5 of the key)."""
    from pyspark.ml.classification import GBTClassifier, LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from ..functions import hashed

    rows = both.select(key, F.col("side").cast("double").alias("label"), *[F.col(c).cast("double").alias(c) for c in features], (hashed(F.col(key), "fold") % folds).alias("fold")).na.fill(0.0)
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(rows)
    out = None
    for f in range(folds):
        model = (GBTClassifier(maxIter=10, maxDepth=3, seed=7) if boosted else LogisticRegression(maxIter=50)).fit(rows.where(F.col("fold") != f))
        part = model.transform(rows.where(F.col("fold") == f)).select(key, F.col("label").cast("int").alias("side"), vector_to_array("probability")[1].alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


def pmse_ratio(scores: DataFrame, n_features: int) -> DataFrame:
    """One row: mean squared distance of the propensity from the synthetic share, over its null expectation."""
    one = scores.agg(F.count(F.lit(1)).alias("n"), F.avg("side").alias("c"))
    full = scores.crossJoin(F.broadcast(one))
    expected = F.lit(float(n_features)) * (1 - F.col("c")) * (1 - F.col("c")) * F.col("c") / F.col("n")
    return full.groupBy("n", "c").agg(F.avg((F.col("score") - F.col("c")) * (F.col("score") - F.col("c"))).alias("p")).select(F.round(F.col("p") / expected, 6).alias("pmse_ratio"))


def rarefied_duplicates(frequencies: DataFrame, m: int) -> DataFrame:
    """One row: expected share of duplicate rows in a sample of m of n rows, from (multiplicity, records).

    The expected number of distinct records is the sum over records of 1 - C(n - k, m) / C(n, m).
    """
    n = frequencies.agg(F.sum(F.col("multiplicity") * F.col("records")).alias("n"))
    lg = lambda x: F.when(x < 1.5, F.lit(0.0)).otherwise((x - 0.5) * F.ln(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x * x * x))  # noqa: E731  ln gamma(x) for x of 1 or more
    full = frequencies.crossJoin(F.broadcast(n))
    k, t = F.col("multiplicity"), F.col("n")
    missed = F.when(t - k < m, F.lit(0.0)).otherwise(F.exp(lg(t - k + 1.0) + lg(t - m + 1.0) - lg(t - k - m + 1.0) - lg(t + 1.0)))
    return full.agg(F.round(1 - F.sum(F.col("records") * (1 - missed)) / m, 6).alias("duplicate_share"))


def matched(both: DataFrame, key: Column, salt: str) -> DataFrame:
    """Both sides thinned by a salted hash to the expected size of the smaller one."""
    from ..functions import unit

    sizes = both.groupBy("side").agg(F.count(F.lit(1)).alias("_n"))
    least = sizes.agg(F.min("_n").alias("_m"))
    rate = sizes.crossJoin(F.broadcast(least)).select("side", (F.col("_m") / F.col("_n")).alias("_p"))
    return both.join(F.broadcast(rate), "side").where(unit(key, salt) < F.col("_p")).drop("_p")


def row_flags(candidates: DataFrame, check: str, by: str, distance: str, k: int) -> DataFrame:
    """The k best distinct candidates of each check, ties by key."""
    w = Window.partitionBy(check).orderBy(distance, by)
    return candidates.dropDuplicates([check, by]).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
