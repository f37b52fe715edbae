"""Vectors and ranked scores: exact search, centroids, hashing embeddings, AUC, ROC, Gower distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .profile import running


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def search(queries: DataFrame, base: DataFrame, k: int, *, block: int = 64 << 20) -> DataFrame:
    """query_id, vec_id, rank, score: exact top-k by inner product, ties by id.

    The query set is a stated, bounded one: its size is checked before it is broadcast; every
    base row meets every query once, and each task keeps k rows of a query.
    """
    size = queries.agg(F.coalesce(F.sum(F.size("embedding")) * 4, F.lit(0))).first()[0]
    if size > block:
        raise ValueError(f"{size} bytes of queries; pass them in blocks of at most {block}")
    q = queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("_q"))
    scored = base.join(F.broadcast(q), F.lit(True)).select("query_id", "vec_id", F.round(inner_product(F.col("embedding"), F.col("_q")), 5).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def centroids(df: DataFrame, by: str) -> DataFrame:
    """by, pos, mean: coordinate means of each group."""
    long = df.select(by, F.posexplode("embedding").alias("pos", "x"))
    return long.groupBy(by, "pos").agg(F.round(F.avg(F.col("x").cast("double")), 5).alias("mean"))


def hashing_counts(df: DataFrame, id_col: str, text_col: str, dims: int, salt: str) -> DataFrame:
    """id, bucket, weight: each token adds a sign to a bucket, both from its salted SHA-256."""
    tokens = df.select(F.col(id_col).alias("id"), F.explode(F.split(F.lower(text_col), "[^a-z0-9]+")).alias("t")).where("t <> ''")
    counted = tokens.groupBy("id", "t").agg(F.count(F.lit(1)).alias("c"))
    h = F.sha2(F.concat(F.lit(salt + "|"), F.col("t")), 256)
    bucket = F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(dims))
    sign = F.when(F.conv(F.substring(h, 9, 2), 16, 10).cast("long") % 2 == 0, 1).otherwise(-1)
    return counted.select("id", bucket.alias("bucket"), (sign * F.col("c")).alias("w")).groupBy("id", "bucket").agg(F.sum("w").alias("weight")).where("weight <> 0")


def _by_score(df: DataFrame, score: str, label: str) -> DataFrame:
    """score, p, n and how many positives and negatives have smaller scores: a row for each distinct score."""
    by = df.groupBy(F.col(score).alias("score")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    return running(by, "score", "p", "n")


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row: area under the ROC curve by midranks, from counts by distinct score."""
    by = _by_score(df, score, label)
    return by.agg(F.round(F.sum(F.col("p") * (F.col("before_n") + F.col("n") / 2)) / (F.sum("p") * F.sum("n")), 6).alias("auc"))


def delong(df: DataFrame, score: str, label: str, z: float = 1.959964) -> DataFrame:
    """One row: auc and its DeLong interval, clipped to [0, 1], from counts by distinct score.

    The placement of a positive is the share of negatives below it (ties half), that of a
    negative the share of positives above it; the variance is that of both means.
    """
    by = _by_score(df, score, label)
    t = by.agg(F.sum("p").alias("tp"), F.sum("n").alias("tn"))
    v = by.crossJoin(F.broadcast(t)).select("p", "n", "tp", "tn", ((F.col("before_n") + F.col("n") / 2) / F.col("tn")).alias("v10"), ((F.col("tp") - F.col("before_p") - F.col("p") / 2) / F.col("tp")).alias("v01"))
    s = lambda c, x: F.sum(F.col(c) * x)
    one = v.agg(F.max("tp").alias("tp"), F.max("tn").alias("tn"), s("p", F.col("v10")).alias("a"), s("p", F.col("v10") * F.col("v10")).alias("aa"), s("n", F.col("v01")).alias("b"), s("n", F.col("v01") * F.col("v01")).alias("bb"))
    mean = F.col("a") / F.col("tp")
    spread = lambda x, xx, n: (F.col(xx) - F.col(x) * F.col(x) / F.col(n)) / (F.col(n) - 1) / F.col(n)
    half = z * F.sqrt(F.greatest(F.lit(0.0), spread("a", "aa", "tp") + spread("b", "bb", "tn")))
    return one.select(F.round(mean, 6).alias("auc"), F.round(F.greatest(F.lit(0.0), mean - half), 6).alias("ci_low"), F.round(F.least(F.lit(1.0), mean + half), 6).alias("ci_high"))


def roc(df: DataFrame, score: str, label: str) -> DataFrame:
    """score, fpr, tpr: one vertex for each distinct score, from the highest down."""
    by = _by_score(df, score, label)
    t = by.agg(F.sum("p").alias("tp"), F.sum("n").alias("tn"))
    above = lambda total, before: F.round((F.col(total) - F.col(before)) / F.col(total), 6)
    return by.crossJoin(F.broadcast(t)).select("score", above("tn", "before_n").alias("fpr"), above("tp", "before_p").alias("tpr"))


#: Rows of a reference panel at most: it goes to every task as one array.
PANEL = 100_000


def gower_nearest(queries: DataFrame, reference: DataFrame, numeric: dict[str, float], categorical: list[str], id_col: str) -> DataFrame:
    """id, d1, d2: distances to the nearest and second nearest reference row (null where there is none).

    Mean over columns of |a - b| / range, or of inequality; NULL equals NULL and differs from
    a value by 1. The reference is a bounded panel (its size is checked), broadcast as one
    row; a query row runs over it and keeps two distances, so that no pair is ever a row.
    """
    ref = reference.select(F.struct(*numeric, *categorical).alias("r")).limit(PANEL + 1).agg(F.collect_list("r").alias("_ref"))
    checked = ref.select(F.when(F.size("_ref") > PANEL, F.raise_error(F.lit(f"a reference of more than {PANEL} rows"))).otherwise(F.col("_ref")).alias("_ref"))

    def distance(r: Column) -> Column:
        parts = [F.when(F.col(c).isNull() & r[c].isNull(), 0.0).when(F.col(c).isNull() | r[c].isNull(), 1.0).otherwise(F.least(F.lit(1.0), F.abs(F.col(c) - r[c]) / n)) for c, n in numeric.items()]
        parts += [F.when(F.col(c).eqNullSafe(r[c]), 0.0).otherwise(1.0) for c in categorical]
        return F.round(sum(parts, F.lit(0.0)) / len(parts), 8)

    far = F.lit(float("inf"))
    two = F.aggregate(
        F.transform("_ref", distance),
        F.struct(far.alias("a"), far.alias("b")),
        lambda t, d: F.when(d < t["a"], F.struct(d.alias("a"), t["a"].alias("b"))).when(d < t["b"], F.struct(t["a"].alias("a"), d.alias("b"))).otherwise(t),
    )
    met = queries.crossJoin(F.broadcast(checked)).select(F.col(id_col).alias("id"), two.alias("t"))
    return met.select("id", *[F.when(F.col(f"t.{x}") < far, F.col(f"t.{x}")).alias(n) for x, n in (("a", "d1"), ("b", "d2"))])


def chunks(df: DataFrame, id_col: str, text_cols: list[str], row_cols: list[str]) -> DataFrame:
    """chunk_id, kind, text: one row_doc ("column is value, ...") of each row and one chunk of each non-null text."""
    doc = F.concat_ws(", ", *[F.concat(F.lit(f"{c} is "), F.col(c).cast("string")) for c in row_cols])
    items = F.array(F.struct(F.lit("row_doc").alias("kind"), doc.alias("text")), *[F.struct(F.lit(f"free_text:{c}").alias("kind"), F.col(c).alias("text")) for c in text_cols])
    out = df.select(F.col(id_col).cast("string").alias("_i"), F.explode(items).alias("x")).where("x.text IS NOT NULL")
    return out.select(F.md5(F.concat_ws("|", "_i", "x.kind")).alias("chunk_id"), F.col("x.kind").alias("kind"), F.col("x.text").alias("text"))


def nearest_summary(to_r: DataFrame, to_h: DataFrame) -> DataFrame:
    """One row from two :func:`gower_nearest` frames: DCR share (ties half) and mean nearest-distance ratio."""
    met = to_r.alias("r").join(to_h.alias("h"), "id")
    nndr = F.when(F.col("r.d2") > 0, F.col("r.d1") / F.col("r.d2")).otherwise(1.0)
    return met.agg(F.round(F.avg(F.when(F.col("r.d1") < F.col("h.d1"), 1.0).when(F.col("r.d1") == F.col("h.d1"), 0.5).otherwise(0.0)), 6).alias("dcr_share"), F.round(F.avg(nndr), 5).alias("nndr_mean"))


def nearest_percentiles(synthetic: DataFrame, holdout: DataFrame, p: float = 0.05) -> DataFrame:
    """One row from two :func:`gower_nearest` frames against one reference: percentiles of the nearest distance and of
    its ratio to the second nearest (1 where that is 0), synthetic over holdout."""
    from .profile import quantiles

    ratio = F.when(F.col("d2") > 0, F.col("d1") / F.col("d2")).otherwise(1.0)
    parts = {}
    for side, frame in (("s", synthetic), ("h", holdout)):
        both = frame.select("d1", F.round(ratio, 8).alias("r"))
        parts |= {f"{side}_{c}": quantiles(both, c, [p]).select(F.col("value").alias(f"{side}_{c}")) for c in ("d1", "r")}
    one = parts["s_d1"]
    for name in ("s_r", "h_d1", "h_r"):
        one = one.crossJoin(F.broadcast(parts[name]))
    over = lambda c: F.round(F.when(F.col(f"h_{c}") > 0, F.col(f"s_{c}") / F.col(f"h_{c}")), 4)
    return one.select(over("d1").alias("dcr_p5_ratio"), over("r").alias("nndr_p5_ratio"))


def nearest_to_centroid(df: DataFrame, by: str, k: int) -> DataFrame:
    """by, vec_id, rank: the k vectors of each group with the greatest inner product with its centroid, ties by id."""
    means = centroids(df, by).groupBy(by).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "mean"))), lambda x: x["mean"]).alias("_m"))
    scored = df.join(F.broadcast(means), by).select(by, "vec_id", F.round(inner_product(F.col("embedding"), F.col("_m")), 5).alias("score"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select(by, "vec_id", F.col("rank").cast("long").alias("rank"))


def k_center(df: DataFrame, k: int) -> DataFrame:
    """vec_id, step: farthest-first choice of k vectors, from the least id on; ties by id.

    Each step is one aggregation over the table; only the chosen vectors (k rows) come to the driver.
    """
    spark, chosen = df.sparkSession, [df.orderBy("vec_id").select("vec_id", "embedding").first()]
    while len(chosen) < k:
        points = F.array(*[F.array(*[F.lit(float(x)) for x in r.embedding]) for r in chosen])
        near = F.array_min(F.transform(points, lambda p: F.aggregate(F.zip_with("embedding", p, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda a, x: a + x)))
        best = df.select("vec_id", "embedding", F.round(near, 6).alias("d")).where(~F.col("vec_id").isin([r.vec_id for r in chosen])).orderBy(F.desc("d"), "vec_id").select("vec_id", "embedding").first()
        if best is None:
            break
        chosen.append(best)
    return spark.createDataFrame([(r.vec_id, i) for i, r in enumerate(chosen)], "vec_id long, step int")


def marginal_relevance(found: DataFrame, base: DataFrame, k: int, balance: float) -> DataFrame:
    """query_id, vec_id, place: k of each query's search results (query_id, vec_id, score) by relevance less likeness to those
    already taken. A query's results are a stated few rows, taken up one by one in an aggregate."""
    rows = found.join(base.select("vec_id", "embedding"), "vec_id").groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct(F.col("vec_id").alias("id"), "score", "embedding"))).alias("all"))
    kind = rows.schema["all"].dataType.simpleString()

    def take(state, _):
        taken = F.transform(state, lambda s: s["id"])
        left = F.filter("all", lambda c: ~F.array_contains(taken, c["id"]))
        value = lambda c: balance * c["score"] - (1 - balance) * F.coalesce(F.array_max(F.transform(state, lambda s: inner_product(s["embedding"], c["embedding"]))), F.lit(0.0))
        ranked = F.array_sort(F.transform(left, lambda c: F.struct((-F.round(value(c), 5)).alias("v"), c["id"].alias("id"))))
        best = F.filter(left, lambda c: c["id"] == F.get(ranked, F.lit(0))["id"])
        return F.concat(state, F.slice(best, 1, 1))

    chosen = F.aggregate(F.sequence(F.lit(1), F.lit(k)), F.array().cast(kind), take)
    return rows.select("query_id", F.posexplode(chosen).alias("place", "c")).select("query_id", F.col("c.id").alias("vec_id"), "place")


def prefix(chunks_: DataFrame, order: str, most: int) -> DataFrame:
    """The first ``most`` chunks in order: the stated prefix that a store is filled with (a feature limit)."""
    return chunks_.orderBy(order).limit(most)
