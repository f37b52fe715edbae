"""Two sides compared: value censuses, binned distances, moments, dependence.

Everything two-sided starts from one aggregation in which a row carries its side; the
closed forms then run on the few aggregated rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import shape_mask, substantive
from .profile import running, unpivot


def sided(source: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Both sides in one frame, ``side`` 0 for source and 1 for synthetic."""
    return source.withColumn("side", F.lit(0)).unionByName(synthetic.withColumn("side", F.lit(1)), allowMissingColumns=True)


def census(both: DataFrame, columns: list[str]) -> DataFrame:
    """column, value, c_src, c_syn over the non-null values of a sided frame."""
    cells = unpivot(both, columns, "side").where("value IS NOT NULL")
    return cells.groupBy("column", "value").agg(F.count_if(F.col("side") == 0).alias("c_src"), F.count_if(F.col("side") == 1).alias("c_syn"))


def shares(counted: DataFrame, *by: str) -> DataFrame:
    """Adds n_src, n_syn, k, p, q: the sides' totals, the number of rows, and shares. Totals are a row for each ``by``."""
    totals = counted.groupBy(*by).agg(F.sum("c_src").alias("n_src"), F.sum("c_syn").alias("n_syn"), F.count(F.lit(1)).alias("k"))
    out = counted.join(F.broadcast(totals), list(by))
    return out.withColumn("p", F.col("c_src") / F.col("n_src")).withColumn("q", F.col("c_syn") / F.col("n_syn"))


def _xlog(x: Column, y: Column) -> Column:
    return F.when(x > 0, x * F.log2(x / y)).otherwise(0.0)


def frequency_distances(counted: DataFrame, *by: str) -> DataFrame:
    """by..., tvd, jsd (bits), hellinger, cohens_w (over the source support), psi_smoothed of c_src and c_syn."""
    s = shares(counted, *by)
    p, q, m = F.col("p"), F.col("q"), (F.col("p") + F.col("q")) / 2
    a = (F.col("c_src") + 0.5) / (F.col("n_src") + 0.5 * F.col("k"))
    b = (F.col("c_syn") + 0.5) / (F.col("n_syn") + 0.5 * F.col("k"))
    r6 = lambda x, name: F.round(x, 6).alias(name)
    return s.groupBy(*by).agg(
        r6(F.sum(F.abs(p - q)) / 2, "tvd"),
        r6(F.sum(_xlog(p, m) + _xlog(q, m)) / 2, "jsd"),
        r6(F.sqrt(F.greatest(F.lit(0.0), 1 - F.sum(F.sqrt(p * q)))), "hellinger"),
        r6(F.sqrt(F.sum(F.when(p > 0, (q - p) * (q - p) / p).otherwise(0.0))), "cohens_w"),
        r6(F.sum((b - a) * F.ln(b / a)), "psi"),
    )


def diversity(counted: DataFrame, *by: str) -> DataFrame:
    """by..., entropy, Miller-Madow entropy, distinct counts, coverage, novelty, adherence, top-1 difference, singletons."""
    s = shares(counted, *by)
    p, q = F.col("p"), F.col("q")
    h = lambda x: -F.sum(F.when(x > 0, x * F.log2(x)).otherwise(0.0))
    out = s.groupBy(*by).agg(
        F.round(h(p), 6).alias("entropy_src"),
        F.round(h(q), 6).alias("entropy_syn"),
        F.round(h(p) + (F.count_if(p > 0) - 1) / (2 * F.max("n_src") * F.ln(F.lit(2.0))), 6).alias("miller_madow_src"),
        F.count_if(p > 0).alias("distinct_src"),
        F.count_if(q > 0).alias("distinct_syn"),
        F.round(F.sum(F.when(q > 0, p).otherwise(0.0)), 6).alias("coverage"),
        F.round(F.sum(F.when(p == 0, q).otherwise(0.0)), 6).alias("novelty"),
        F.round(F.sum(F.when(p > 0, q).otherwise(0.0)), 6).alias("adherence"),
        F.round(F.abs(F.max("p") - F.max("q")), 6).alias("top1_delta"),
        F.count_if(F.col("c_src") == 1).alias("singletons_src"),
    )
    return out


def substantive_copies(both: DataFrame, columns: list[str], rare: int) -> DataFrame:
    """column, copies, n: substantive synthetic values equal to a source value of fewer than ``rare`` rows."""
    cells = unpivot(both, columns, "side").where(substantive(F.col("value")))
    by = cells.groupBy("column", "value").agg(F.count_if(F.col("side") == 0).alias("s"), F.count_if(F.col("side") == 1).alias("t"))
    return by.groupBy("column").agg(F.coalesce(F.sum(F.when((F.col("s") > 0) & (F.col("s") < rare), F.col("t"))), F.lit(0)).alias("copies"), F.sum("t").alias("n"))


def rates(both: DataFrame, column: str) -> DataFrame:
    """One row: differences of the sides' null, blank and zero shares."""
    c, n = F.col(column), F.count(F.lit(1))
    by = both.groupBy("side").agg((F.count_if(c.isNull()) / n).alias("null"), (F.count_if(F.trim(c.cast("string")) == "") / n).alias("empty"), (F.count_if(c.try_cast("double") == 0) / n).alias("zero"))
    side = lambda x, s: F.max(F.when(F.col("side") == s, F.col(x)))
    return by.agg(*[F.round(F.abs(side(x, 1) - side(x, 0)), 6).alias(f"{x}_rate_delta") for x in ("null", "empty", "zero")])


def binned(both: DataFrame, value: Column, edges: list[float], left: bool = False) -> DataFrame:
    """bin, c_src, c_syn for (-inf, e0], (e0, e1], ..., (ek, inf), or closed on the ``left``; every bin has a row."""
    array = F.array(*[F.lit(float(e)) for e in edges])
    at = F.size(F.filter(array, lambda e: (e <= value) if left else (e < value))).cast("long")
    got = both.where(value.isNotNull()).groupBy(at.alias("bin")).agg(F.count_if(F.col("side") == 0).alias("c_src"), F.count_if(F.col("side") == 1).alias("c_syn"))
    bins = both.sparkSession.range(len(edges) + 1).withColumnRenamed("id", "bin")
    return bins.join(F.broadcast(got), "bin", "left").select("bin", F.coalesce("c_src", F.lit(0)).alias("c_src"), F.coalesce("c_syn", F.lit(0)).alias("c_syn"))


def binned_distances(counted: DataFrame, edges: list[float]) -> DataFrame:
    """ks (largest gap at an edge), ks_high (plus what a bin can hide), w1, pit_w1, psi over given bins."""
    n = counted.agg(F.sum("c_src").alias("ns"), F.sum("c_syn").alias("nt"))
    s = counted.crossJoin(F.broadcast(n)).withColumn("p", F.col("c_src") / F.col("ns")).withColumn("q", F.col("c_syn") / F.col("nt"))
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # as many rows as bins
    s = s.withColumn("fp", F.sum("p").over(w)).withColumn("fq", F.sum("q").over(w))
    gap = F.abs(F.col("fp") - F.col("fq"))
    before = F.abs((F.col("fp") - F.col("p")) - (F.col("fq") - F.col("q")))
    widths = F.array(*[F.lit(float(b - a)) for a, b in zip(edges, edges[1:], strict=False)])
    width = F.coalesce(F.get(widths, F.col("bin").cast("int")), F.lit(0.0))
    mid = F.abs((F.col("fp") - F.col("p") / 2) - (F.col("fq") - F.col("q") / 2))
    k = len(edges) + 1
    a, b = (F.col("c_src") + 0.5) / (F.col("ns") + 0.5 * k), (F.col("c_syn") + 0.5) / (F.col("nt") + 0.5 * k)
    hidden = F.greatest(F.abs(F.col("fp") - (F.col("fq") - F.col("q"))), F.abs((F.col("fp") - F.col("p")) - F.col("fq")))
    return s.agg(
        F.round(F.max(gap), 6).alias("ks"),
        F.round(F.max(F.greatest(gap, before, hidden)), 6).alias("ks_high"),
        F.round(F.sum(width * gap), 6).alias("w1"),
        F.round(F.sum(F.col("p") * mid), 6).alias("pit_w1"),
        F.round(F.sum((b - a) * F.ln(b / a)), 6).alias("psi"),
    )


def moment_deltas(both: DataFrame, columns: list[str]) -> DataFrame:
    """column, smd, std_ratio, range_coverage, range_adherence from one pass a side and one to count inside the range."""
    aggs = [f(F.when(F.col("side") == s, F.col(c).cast("double"))).alias(f"{c}_{n}{s}") for c in columns for s in (0, 1) for n, f in (("avg", F.avg), ("sd", F.stddev_pop), ("min", F.min), ("max", F.max))]
    one = both.agg(*aggs)
    inside = both.where("side = 1").crossJoin(F.broadcast(one)).agg(*[F.avg(F.col(c).between(F.col(f"{c}_min0"), F.col(f"{c}_max0")).cast("double")).alias(f"{c}_in") for c in columns])
    parts = []
    for c in columns:
        v = lambda n, c=c: F.col(f"{c}_{n}")
        cover = F.greatest(F.lit(0.0), F.least(v("max0"), v("max1")) - F.greatest(v("min0"), v("min1"))) / (v("max0") - v("min0"))
        parts.append(F.struct(F.lit(c).alias("column"), F.round(F.abs(v("avg1") - v("avg0")) / v("sd0"), 6).alias("smd"), F.round(v("sd1") / v("sd0"), 6).alias("std_ratio"), F.round(cover, 6).alias("range_coverage"), F.round(v("in"), 6).alias("range_adherence")))
    return one.crossJoin(F.broadcast(inside)).select(F.explode(F.array(*parts)).alias("s")).select("s.*")


def char_classes(both: DataFrame, column: str) -> DataFrame:
    """char_class_l1: L1 distance of the shares of strings with upper, lower, digit, space, other characters."""
    tests = ["[A-Z]", "[a-z]", "[0-9]", "[ \\t\\n\\r]", "[^A-Za-z0-9 \\t\\n\\r]"]
    by = both.where(F.col(column).isNotNull()).agg(*[(F.avg(F.when(F.col("side") == 0, F.col(column).rlike(t).cast("double"))) - F.avg(F.when(F.col("side") == 1, F.col(column).rlike(t).cast("double")))).alias(f"d{i}") for i, t in enumerate(tests)])
    return by.select(F.round(sum((F.abs(f"d{i}") for i in range(len(tests))), F.lit(0.0)), 6).alias("char_class_l1"))


def mask_census(both: DataFrame, column: str) -> DataFrame:
    """value (shape mask), c_src, c_syn."""
    masks = both.where(F.col(column).isNotNull()).groupBy(shape_mask(F.col(column)).alias("value"))
    return masks.agg(F.count_if(F.col("side") == 0).alias("c_src"), F.count_if(F.col("side") == 1).alias("c_syn"))


def shape_head_tv(both: DataFrame, column: str, floor: float) -> DataFrame:
    """One row: raw mask TV and the TV of head masks (source share of ``floor`` or more) plus one pooled tail."""
    s = shares(mask_census(both, column).withColumn("g", F.lit(1)), "g")
    head = s.groupBy(F.when(F.col("p") >= floor, F.col("value")).otherwise("<tail>").alias("m")).agg(F.sum("p").alias("p"), F.sum("q").alias("q"), F.sum(F.abs(F.col("p") - F.col("q"))).alias("raw"))
    return head.agg(F.round(F.sum("raw") / 2, 6).alias("shape_tv"), F.round(F.sum(F.abs(F.col("p") - F.col("q"))) / 2, 6).alias("shape_head_tv"))


def pearson(both: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """a, b, pearson_src, pearson_syn, pearson_delta: all pairs in one pass."""
    aggs = [F.corr(F.when(F.col("side") == s, F.col(a)), F.when(F.col("side") == s, F.col(b))).alias(f"r{i}_{s}") for i, (a, b) in enumerate(pairs) for s in (0, 1)]
    one = both.agg(*aggs)
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(f"r{i}_0", 6).alias("pearson_src"), F.round(f"r{i}_1", 6).alias("pearson_syn"), F.round(F.abs(F.col(f"r{i}_1") - F.col(f"r{i}_0")), 6).alias("pearson_delta")) for i, (a, b) in enumerate(pairs)]
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def correlation_summary(deltas: DataFrame) -> DataFrame:
    return deltas.agg(F.round(F.sqrt(F.avg(F.col("pearson_delta") * F.col("pearson_delta"))), 5).alias("corr_rms_delta"), F.round(F.max("pearson_delta"), 6).alias("corr_max_delta"))


def ranked(counted: DataFrame, value: str, count: str, by: tuple[str, ...]) -> DataFrame:
    """by..., value, rank: the average rank of a value's rows, from its count and those of the smaller ones."""
    own = counted.groupBy(*by, value).agg(F.sum(count).alias("_c"))
    return running(own, value, "_c", by=by).select(*by, value, (F.col("before") + (F.col("_c") + 1) / 2).alias("rank"))


def spearman(both: DataFrame, a: str, b: str) -> DataFrame:
    """side, spearman: Pearson correlation of midranks, weighted by the counts of the distinct pairs of values."""
    pairs = both.select("side", F.col(a).alias("_a"), F.col(b).alias("_b")).where("_a IS NOT NULL AND _b IS NOT NULL").groupBy("side", "_a", "_b").agg(F.count(F.lit(1)).alias("c"))
    x = ranked(pairs, "_a", "c", ("side",)).withColumnRenamed("rank", "x")
    y = ranked(pairs, "_b", "c", ("side",)).withColumnRenamed("rank", "y")
    met = pairs.join(x, ["side", "_a"]).join(y, ["side", "_b"])
    # ranks have the mean (n + 1) / 2: sums of centred products don't lose digits
    centred = met.join(F.broadcast(pairs.groupBy("side").agg(((F.sum("c") + 1) / 2).alias("m"))), "side").withColumn("x", F.col("x") - F.col("m")).withColumn("y", F.col("y") - F.col("m"))
    s = lambda v: F.sum(F.col("c") * v)
    one = centred.groupBy("side").agg(s(F.col("x") * F.col("y")).alias("xy"), s(F.col("x") * F.col("x")).alias("xx"), s(F.col("y") * F.col("y")).alias("yy"))
    return one.select("side", F.round(F.col("xy") / F.sqrt(F.col("xx") * F.col("yy")), 6).alias("spearman"))


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: chi-square, bias-corrected Cramer's V, mutual information over the smaller entropy."""
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("c"))
    margin = lambda x: cells.groupBy(x).agg(F.sum("c").alias(f"r{x}"))
    t = cells.join(margin("a"), "a").join(margin("b"), "b").crossJoin(F.broadcast(cells.agg(F.sum("c").alias("n"), F.countDistinct("a").alias("ka"), F.countDistinct("b").alias("kb"))))
    p, e = F.col("c") / F.col("n"), F.col("ra") * F.col("rb") / F.col("n")
    pa, pb = F.col("ra") / F.col("n"), F.col("rb") / F.col("n")
    one = t.agg(
        F.max("n").alias("n"),
        F.max("ka").alias("ka"),
        F.max("kb").alias("kb"),
        (F.sum(F.col("c") * F.col("c") / e) - F.max("n")).alias("chi2"),
        F.sum(p * F.ln(p / (pa * pb))).alias("mi"),
        (-F.sum(p * F.ln(pa))).alias("ha"),
        (-F.sum(p * F.ln(pb))).alias("hb"),
    )
    phi = F.greatest(F.lit(0.0), F.col("chi2") / F.col("n") - (F.col("ka") - 1) * (F.col("kb") - 1) / (F.col("n") - 1))
    fix = lambda k: F.col(k) - (F.col(k) - 1) * (F.col(k) - 1) / (F.col("n") - 1)
    return one.select(F.round("chi2", 4).alias("chi2"), F.round(F.sqrt(phi / F.least(fix("ka") - 1, fix("kb") - 1)), 6).alias("cramers_v"), F.round(F.col("mi") / F.least("ha", "hb"), 6).alias("nmi"))


def joint_tvd(both: DataFrame, a: str, b: str) -> DataFrame:
    """One row: total variation distance of the joint tables of two columns."""
    cells = both.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count_if(F.col("side") == 0).alias("c_src"), F.count_if(F.col("side") == 1).alias("c_syn"))
    s = cells.crossJoin(F.broadcast(cells.agg(F.sum("c_src").alias("ns"), F.sum("c_syn").alias("nt"))))
    return s.agg(F.round(F.sum(F.abs(F.col("c_src") / F.col("ns") - F.col("c_syn") / F.col("nt"))) / 2, 6).alias("contingency_tvd"))


def value_overlap(a: DataFrame, b: DataFrame, column_a: str, column_b: str) -> DataFrame:
    """One row: distinct values common to two columns, of either, and their Jaccard overlap."""
    x = a.select(F.col(column_a).cast("string").alias("v"), F.lit(1).alias("x"), F.lit(0).alias("y"))
    y = b.select(F.col(column_b).cast("string").alias("v"), F.lit(0).alias("x"), F.lit(1).alias("y"))
    by = x.union(y).where("v IS NOT NULL").groupBy("v").agg(F.max("x").alias("x"), F.max("y").alias("y"))
    return by.agg(F.count_if((F.col("x") == 1) & (F.col("y") == 1)).alias("common"), F.count(F.lit(1)).alias("either")).withColumn("jaccard", F.round(F.col("common") / F.col("either"), 6))


def stats_drift(both: DataFrame, column: str) -> DataFrame:
    """One row: the largest of the differences of null share, of distinct count (relative) and of mean (in source deviations)."""
    c, n = F.col(column), F.count(F.lit(1))
    side = lambda x, s: F.when(F.col("side") == s, x)
    one = both.agg(
        *[(F.count_if(c.isNull() & (F.col("side") == s)) / n).alias(f"n{s}") for s in (0, 1)],
        *[F.countDistinct(side(c, s)).alias(f"d{s}") for s in (0, 1)],
        *[F.avg(side(c, s)).alias(f"m{s}") for s in (0, 1)],
        F.stddev_pop(side(c, 0)).alias("s0"),
    )
    gap = lambda x: F.abs(F.col(f"{x}1") - F.col(f"{x}0"))
    return one.select(F.round(F.greatest(gap("n"), gap("d") / F.col("d0"), gap("m") / F.col("s0")), 6).alias("drift"))


def publishable(df: DataFrame, column: str, least: int) -> DataFrame:
    """value, n: values of at least ``least`` rows as they are, all others as one count."""
    by = df.groupBy(F.col(column).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    rare = by.where(F.col("c") < least).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n")).select(F.lit("<rare>").alias("value"), "n")
    return by.where(F.col("c") >= least).select(F.col("v").alias("value"), F.col("c").alias("n")).union(rare)


def tail_masses(counted: DataFrame, edges: list[float]) -> DataFrame:
    """One row: the shares of each side below the first edge and above the last."""
    share = lambda c, cond: F.round(F.sum(F.when(cond, F.col(c)).otherwise(0)) / F.sum(c), 6)
    low, high = F.col("bin") == 0, F.col("bin") == len(edges)
    return counted.agg(share("c_src", low).alias("below_source"), share("c_src", high).alias("above_source"), share("c_syn", low).alias("below_synthetic"), share("c_syn", high).alias("above_synthetic"))


def quantiles_from_bins(counted: DataFrame, count: str, edges: list[float], probabilities: list[float]) -> DataFrame:
    """p, value: quantiles by linear interpolation of the distribution function at the edges, flat outside them."""
    up = F.sum(count).over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))  # as many rows as bins
    at = counted.withColumn("f", up / F.lit(counted.agg(F.sum(count)).first()[0])).where(F.col("bin") < len(edges))
    x = F.get(F.array(*[F.lit(float(e)) for e in edges]), F.col("bin").cast("int"))
    points = at.select("f", x.alias("x")).agg(F.sort_array(F.collect_list(F.struct("x", "f"))).alias("g"))  # a few edges
    wanted = points.select(F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p"), "g")
    below = F.filter("g", lambda e: e["f"] <= F.col("p"))
    lo, hi = F.get(below, F.size(below) - 1), F.get("g", F.size(below))
    inside = lo["x"] + (hi["x"] - lo["x"]) * (F.col("p") - lo["f"]) / (hi["f"] - lo["f"])
    return wanted.select("p", F.round(F.when(F.size(below) == 0, F.get("g", F.lit(0))["x"]).when(F.size(below) == F.size("g"), F.element_at("g", -1)["x"]).otherwise(inside), 6).alias("value"))


def chao_shen(counted: DataFrame, count: str, *by: str) -> DataFrame:
    """by..., entropy in bits with coverage-adjusted shares and inclusion weights, from counts by value.

    The chance that a value is seen, 1 - (1 - p) ** n, is taken by expm1 and log1p: it doesn't
    vanish however small p is.
    """
    c = F.col(count)
    totals = counted.where(c > 0).groupBy(*by).agg(F.sum(c).cast("double").alias("_n"), F.count_if(c == 1).cast("double").alias("_f"))
    cover = 1 - F.when(F.col("_f") < F.col("_n"), F.col("_f")).otherwise(F.col("_n") - 1) / F.col("_n")
    p = cover * c / F.col("_n")
    term = F.when(p < 1, -p * F.log2(p) / -F.expm1(F.col("_n") * F.log1p(-p))).otherwise(0.0)
    return counted.where(c > 0).join(F.broadcast(totals), list(by)).groupBy(*by).agg(F.round(F.sum(term), 6).alias("chao_shen"))


def chance_floors(counted: DataFrame, *by: str) -> DataFrame:
    """by..., tvd_floor, jsd_floor: what two samples of the sides' sizes from the source distribution differ by on average."""
    s = shares(counted, *by)
    r = 1 / F.col("n_src") + 1 / F.col("n_syn")
    return s.groupBy(*by).agg(F.round(F.sum(F.sqrt(2 * F.col("p") * (1 - F.col("p")) * r / math.pi)) / 2, 6).alias("tvd_floor"), F.round(F.max((F.col("k") - 1) * r) / (8 * math.log(2.0)), 6).alias("jsd_floor"))


def power_sums(df: DataFrame, column: str, *by: str) -> DataFrame:
    """by..., n, mean, m2, m3, m4: central sums, which :func:`merge_moments` adds up."""
    x = F.col(column).cast("double")
    means = df.where(x.isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean"))
    d = df.where(x.isNotNull()).join(F.broadcast(means), list(by)) if by else df.where(x.isNotNull()).crossJoin(F.broadcast(means))
    e = x - F.col("mean")
    return d.groupBy(*by, "n", "mean").agg(*[F.sum(F.pow(e, F.lit(float(k)))).alias(f"m{k}") for k in (2, 3, 4)])


def merge_moments(parts: DataFrame, *by: str) -> DataFrame:
    """by..., n, mean, variance, skewness, kurtosis (population) of the union of parts, from their central sums alone."""
    whole = parts.groupBy(*by).agg(F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    met = parts.join(F.broadcast(whole), list(by)) if by else parts.crossJoin(F.broadcast(whole))
    n, d = F.col("n"), F.col("mean") - F.col("_mean")
    one = met.groupBy(*by, "_n", "_mean").agg(
        F.sum(F.col("m2") + n * d * d).alias("s2"),
        F.sum(F.col("m3") + 3 * d * F.col("m2") + n * d * d * d).alias("s3"),
        F.sum(F.col("m4") + 4 * d * F.col("m3") + 6 * d * d * F.col("m2") + n * d * d * d * d).alias("s4"),
    )
    t = F.col("_n")
    return one.select(*by, t.alias("n"), F.round("_mean", 6).alias("mean"), F.round(F.col("s2") / t, 4).alias("variance"), F.round(F.sqrt(t) * F.col("s3") / F.pow("s2", F.lit(1.5)), 6).alias("skewness"), F.round(t * F.col("s4") / (F.col("s2") * F.col("s2")) - 3, 6).alias("kurtosis"))


def side_deltas(both: DataFrame, measure, columns: dict[str, str]) -> DataFrame:
    """One row: for each of ``columns`` (measure's column to new name) the absolute difference of a one-row measure of each side."""
    a, b = (measure(both.where(F.col("side") == s)).select(*[F.col(c).alias(f"_{s}_{n}") for c, n in columns.items()]) for s in (0, 1))
    return a.crossJoin(F.broadcast(b)).select(*[F.round(F.abs(F.col(f"_1_{n}") - F.col(f"_0_{n}")), 6).alias(n) for n in columns.values()])


def ratios(counted: DataFrame, *by: str) -> DataFrame:
    """by..., entropy_ratio, distinct_ratio of a census at matched sizes. Both sides constant: 1; the synthetic alone: 0; the source alone: not known."""
    d = diversity(counted, *by)
    ratio = F.when((F.col("entropy_src") == 0) & (F.col("entropy_syn") == 0), 1.0).when(F.col("entropy_src") == 0, None).otherwise(F.round(F.col("entropy_syn") / F.col("entropy_src"), 5))
    return d.select(*by, ratio.alias("entropy_ratio"), F.round(F.col("distinct_syn") / F.col("distinct_src"), 6).alias("distinct_ratio"))


def ceiling_hit(counted: DataFrame, ceilings: list[int], *by: str) -> DataFrame:
    """by..., distinct_syn, hit: 1.0 where the number of distinct synthetic values is one of the ceilings."""
    return counted.groupBy(*by).agg(F.count_if(F.col("c_syn") > 0).alias("distinct_syn")).withColumn("hit", F.col("distinct_syn").isin(ceilings).cast("double"))


def type_validity(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, validity: the share of non-null values that are a finite number, or text that reads as one."""
    x = lambda c: F.col(c).try_cast("double")
    good = lambda c: x(c).isNotNull() & ~F.isnan(x(c)) & (F.abs(x(c)) != float("inf"))
    one = df.agg(*[F.round(F.count_if(good(c)) / F.count(c), 6).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("validity")) for c in columns])).alias("s")).select("s.*")


def merged_edges(a: Column, b: Column) -> Column:
    """The ascending distinct finite edges of two grids."""
    return F.array_sort(F.array_distinct(F.filter(F.concat(a, b), lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))))


def binned_columns(both: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """column, bin, c_src, c_syn as :func:`binned`, of many columns in one scan."""

    def place(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(x.isNotNull(), F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges[c]]), lambda e: e < x)))

    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), place(c).alias("bin")) for c in edges]))
    got = both.select("side", cells.alias("x")).select("side", "x.*").where("bin IS NOT NULL").groupBy("column", "bin").agg(F.count_if(F.col("side") == 0).alias("c_src"), F.count_if(F.col("side") == 1).alias("c_syn"))
    every = both.sparkSession.createDataFrame([(c, i) for c, e in edges.items() for i in range(len(e) + 1)], "column string, bin int")
    return every.join(F.broadcast(got), ["column", "bin"], "left").select("column", "bin", F.coalesce("c_src", F.lit(0)).alias("c_src"), F.coalesce("c_syn", F.lit(0)).alias("c_syn"))


def binned_distances_by(counted: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """column, ks, w1, pit_w1, psi as :func:`binned_distances`, by column (as many rows as bins)."""
    s = shares(counted, "column")
    up = Window.partitionBy("column").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.withColumn("fp", F.sum("p").over(up)).withColumn("fq", F.sum("q").over(up))
    widths = F.create_map(*[x for c, e in edges.items() for x in (F.lit(c), F.array(*[F.lit(float(b - a)) for a, b in zip(e, e[1:], strict=False)], F.lit(0.0)))])
    width = F.when(F.col("bin") > 0, 1.0) * F.coalesce(F.get(widths[F.col("column")], F.col("bin") - 1), F.lit(0.0))
    gap = F.abs(F.col("fp") - F.col("fq"))
    # the gap at an edge is that of the bin that ends there
    before = F.abs((F.col("fp") - F.col("p")) - (F.col("fq") - F.col("q")))
    mid = F.abs((F.col("fp") - F.col("p") / 2) - (F.col("fq") - F.col("q") / 2))
    a, b = (F.col("c_src") + 0.5) / (F.col("n_src") + 0.5 * F.col("k")), (F.col("c_syn") + 0.5) / (F.col("n_syn") + 0.5 * F.col("k"))
    return s.groupBy("column").agg(F.round(F.max(gap), 6).alias("ks"), F.round(F.sum(F.coalesce(width * before, F.lit(0.0))), 6).alias("w1"), F.round(F.sum(F.col("p") * mid), 6).alias("pit_w1"), F.round(F.sum((b - a) * F.ln(b / a)), 6).alias("psi"))


def rates_of(both: DataFrame, columns: list[str]) -> DataFrame:
    """column, null_rate_delta, empty_rate_delta, zero_rate_delta of many columns in one scan."""
    n = lambda s: F.count_if(F.col("side") == s)
    tests = {"null": lambda c: F.col(c).isNull(), "empty": lambda c: F.trim(F.col(c).cast("string")) == "", "zero": lambda c: F.col(c).try_cast("double") == 0}
    gap = lambda t, c: F.round(F.abs(F.count_if(tests[t](c) & (F.col("side") == 1)) / n(1) - F.count_if(tests[t](c) & (F.col("side") == 0)) / n(0)), 6)
    one = both.agg(*[F.struct(F.lit(c).alias("column"), *[gap(t, c).alias(f"{t}_rate_delta") for t in tests]).alias(f"c{i}") for i, c in enumerate(columns)])
    return one.select(F.explode(F.array(*[f"c{i}" for i in range(len(columns))])).alias("x")).select("x.*")
