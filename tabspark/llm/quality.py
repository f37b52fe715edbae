"""Quality rules: base statistics and robust multivariate outliers, in DataFrame functions only.

For every (language, source) group a minimum-covariance-determinant estimate of the
transformed statistics is found by concentration steps from several deterministic starts. A
step takes the ``CORE`` share of the group that lies nearest by Mahalanobis distance; its mean
and covariance are the next estimate. Each start is followed until the determinant no longer
falls, and of all estimates of a group the one of least determinant is kept. A document is
rejected when its squared distance exceeds the chi-square quantile ``CUTOFF``.

One rule holds for groups of every size: the covariance of a core of n rows weighs n / (n +
``SHRINK``), and the squares of the least standard deviations are added to its diagonal
(minimum regularized covariance determinant). So a group of a few rows is judged by little
more than these, and no covariance is singular.

Everything summed is an integer (statistics are fixed-point), and quantiles come from
binned counts, so results do not depend on how rows are dealt. Only sums and counts by
group are shuffled, after map-side aggregation: a group that holds a third of all rows
costs no task more than the number of its bins. The estimates form a few rows for each group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_RE, WORD_RE, materialize

#: Transformed statistics and the least standard deviation that each is given (what is the
#: same in all of a group, such as no repeated line, would otherwise have none).
FEATURES = {"x0": 0.10, "x1": 0.50, "x2": 0.10, "x3": 0.10, "x4": 2.0}
#: Fixed-point units of a transformed statistic; bins of its histogram; bins of a log distance.
UNIT, BIN, FINE = 10_000, 50, 20
#: Share of a group that the estimate rests on, tail of the cut-off, rows that weigh as much as the prior.
CORE, TAIL, SHRINK = 0.75, 1e-6, 5
#: A start is followed while the logarithm of the determinant falls by more.
TOLERANCE = 1e-3
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def chi2_tail(x: float, dof: int) -> float:
    """P(chi-square > x), by the closed forms for even and odd degrees of freedom."""
    if dof % 2 == 0:
        return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))
    term, total = math.sqrt(2 * x / math.pi) * math.exp(-x / 2), 0.0
    for k in range(1, dof // 2 + 1):
        total += term
        term *= x / (2 * k + 1)
    return math.erfc(math.sqrt(x / 2)) + total


def chi2_quantile(tail: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_tail(mid, dof) > tail else (low, mid)
    return low


P = len(FEATURES)
CUTOFF = chi2_quantile(TAIL, P)
#: Makes the covariance of the core consistent at the normal distribution.
CONSISTENCY = CORE / (1 - chi2_tail(chi2_quantile(1 - CORE, P), P + 2))


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with struct ``_s`` of the base statistics (see STATS) of each whole text, null as none.

    A word position counts as repeated when any 3-word window over it occurs twice or more
    in the text. Windows are compared by 64-bit hashes of their words, sorted with their
    positions, so a text of n words takes O(n log n).
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = docs.withColumn("_w", F.filter(F.split(text, SPACE_RE), lambda w: w != ""))
    n = F.size("_w")
    hashes = F.when(
        n >= 4,
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = words.withColumn("_h", hashes)
    placed = hashed.withColumn(
        "_p",
        F.when(
            F.size(F.array_distinct("_h")) < F.size("_h"),
            F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
        ),
    )
    same = lambda x, i: F.coalesce(F.get("_p", i)["h"] == x["h"], F.lit(False))
    found = placed.withColumn("_r", F.sort_array(F.transform(F.filter("_p", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["p"])))
    covered = F.aggregate(
        "_r",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + F.least(F.lit(3), p + 3 - a["end"])).alias("n")),
        lambda a: a["n"],
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_RE))
    found = found.withColumn("_l", lines)
    stats = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    return found.withColumn("_s", stats).drop("_w", "_h", "_p", "_r", "_l")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def transformed() -> list[Column]:
    """The fixed-point statistic vector (bigint): mean word length, symbols, repeated words, repeated lines, length."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    raw = [
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        F.log1p(100 * F.col("n_symbols") / words),
        F.col("n_repeat_words") / words,
        10 * F.col("n_dup_lines") / words,
        F.log(words),
    ]
    return [F.round(x * UNIT).cast("long").alias(name) for x, name in zip(raw, FEATURES, strict=True)]


def _key(lang: str, source: str) -> Column:
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    return F.concat(name(lang), F.lit("\t"), name(source)).alias("g")


def _estimates(core: DataFrame) -> DataFrame:
    """``g, start``, mean ``m_i``, inverse Cholesky factor ``l_i_j`` and ``logdet`` of the regularized covariance of the rows."""
    names = list(FEATURES)
    big = lambda c: c.cast("decimal(20,0)")
    pairs = [(i, j) for i in range(P) for j in range(i + 1)]
    sums = [F.sum(big(F.col(a))).alias(f"s_{i}") for i, a in enumerate(names)]
    sums += [F.sum(big(F.col(names[i]) * F.col(names[j]))).alias(f"q_{i}_{j}") for i, j in pairs]
    est = core.groupBy("g", "start").agg(F.count(F.lit(1)).cast("double").alias("n"), *sums)
    mean = lambda c: F.col(c).cast("double") / F.col("n")
    est = est.select("g", "start", "n", *[mean(f"s_{i}").alias(f"m_{i}") for i in range(P)], *[mean(f"q_{i}_{j}").alias(f"q_{i}_{j}") for i, j in pairs])
    weight = F.col("n") / (F.col("n") + SHRINK) * CONSISTENCY
    prior = [(v * UNIT) ** 2 for v in FEATURES.values()]
    cov = lambda i, j: (F.col(f"q_{i}_{j}") - F.col(f"m_{i}") * F.col(f"m_{j}")) * weight + (prior[i] if i == j else 0.0)
    return _inverse(est.select("g", "start", *[f"m_{i}" for i in range(P)], *[cov(i, j).alias(f"c_{i}_{j}") for i, j in pairs]))


def _inverse(est: DataFrame) -> DataFrame:
    """Columns ``c_i_j`` to ``l_i_j``, the inverse of their Cholesky factor, one column at a time; and ``logdet``."""
    for j in range(P):
        est = est.withColumn(f"k_{j}_{j}", F.sqrt(F.col(f"c_{j}_{j}") - sum((F.col(f"k_{j}_{k}") ** 2 for k in range(j)), F.lit(0.0))))
        if j + 1 < P:
            est = est.withColumns({f"k_{i}_{j}": (F.col(f"c_{i}_{j}") - sum((F.col(f"k_{i}_{k}") * F.col(f"k_{j}_{k}") for k in range(j)), F.lit(0.0))) / F.col(f"k_{j}_{j}") for i in range(j + 1, P)})
    for i in range(P):
        est = est.withColumn(f"l_{i}_{i}", 1 / F.col(f"k_{i}_{i}"))
        if i:
            est = est.withColumns({f"l_{i}_{j}": -sum((F.col(f"k_{i}_{k}") * F.col(f"l_{k}_{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"k_{i}_{i}") for j in range(i)})
    logdet = sum((2 * F.log(f"k_{i}_{i}") for i in range(P)), F.lit(0.0))
    return est.select("g", "start", *_columns(), logdet.alias("logdet"))


def _columns() -> list[str]:
    return [*[f"m_{i}" for i in range(P)], *[f"l_{i}_{j}" for i in range(P) for j in range(i + 1)]]


def _distance() -> Column:
    centred = [F.col(a) - F.col(f"m_{i}") for i, a in enumerate(FEATURES)]
    return sum((sum((F.col(f"l_{i}_{j}") * centred[j] for j in range(i + 1)), F.lit(0.0)) ** 2 for i in range(P)), F.lit(0.0))


def _quantiles(rows: DataFrame, *by: str, at: dict[str, float]) -> DataFrame:
    """For each ``by``: the least ``bin`` up to which the share ``at`` of the rows lies."""
    counts = rows.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("c"))
    each = Window.partitionBy(*by)  # of aggregated rows: as many as there are bins
    summed = counts.select(*by, "bin", F.sum("c").over(each.orderBy("bin")).alias("up"), F.sum("c").over(each).alias("of"))
    return summed.groupBy(*by).agg(*[F.min(F.when(F.col("up") >= F.ceil(F.col("of") * share), F.col("bin"))).alias(name) for name, share in at.items()])


def _starts(rows: DataFrame) -> DataFrame:
    """Three deterministic starts of each group: 0 medians and quartile ranges, 1 mean and covariance
    of all rows, 2 medians and the least standard deviations. Their ``logdet`` is null: they aren't of a core."""
    long = rows.select("g", F.posexplode(F.array(*FEATURES)).alias("j", "x")).select("g", "j", F.floor(F.col("x") / BIN).alias("bin"))
    q = _quantiles(long, "g", "j", at={"low": 0.25, "mid": 0.5, "high": 0.75})
    least = F.element_at(F.array(*[F.lit(v * UNIT) for v in FEATURES.values()]), F.col("j") + 1)
    scale = F.greatest((F.col("high") - F.col("low")) * BIN / 1.349, least)
    at = lambda i, x: F.max(F.when(F.col("j") == i, x))
    wide = q.groupBy("g").agg(*[at(i, (F.col("mid") + 0.5) * BIN).alias(f"m_{i}") for i in range(P)], *[at(i, 1 / scale).alias(f"a_{i}") for i in range(P)], *[at(i, 1 / least).alias(f"b_{i}") for i in range(P)])
    none = F.lit(None).cast("double").alias("logdet")
    diagonal = lambda n, x: wide.select("g", F.lit(n).alias("start"), *[f"m_{i}" for i in range(P)], *[(F.col(f"{x}_{i}") if i == j else F.lit(0.0)).alias(f"l_{i}_{j}") for i in range(P) for j in range(i + 1)], none)
    classical = _estimates(rows.withColumn("start", F.lit(1))).drop("logdet").select("g", "start", *_columns(), none)
    return diagonal(0, "a").union(classical).union(diagonal(2, "b"))


def _step(rows: DataFrame, est: DataFrame) -> DataFrame:
    """The next estimates: of the core of each group under each present estimate."""
    near = rows.join(est.drop("logdet"), "g").select("g", "start", *FEATURES, F.floor(F.log(_distance() + 1e-6) * FINE).alias("bin"))
    cut = _quantiles(near, "g", "start", at={"cut": CORE})
    return _estimates(near.join(cut, ["g", "start"]).where(F.col("bin") <= F.col("cut")))


def fit(stats: DataFrame, *, lang: str = "lang", source: str = "source") -> DataFrame:
    """Estimates from a frame of base statistics: a row for each group, with ``logdet`` and the ``start`` that led to it.

    Only rows that pass the base rules count. Each step's estimates are written, so a step
    reads the statistics once and no plan grows with the steps; a start that has settled
    takes no part in further steps.
    """
    rows = stats.where(~base_failed()).select(_key(lang, source), *transformed())
    now = materialize(_starts(rows), "mcd-start")
    found = None
    while not now.isEmpty():
        before = now.select("g", "start", F.col("logdet").alias("_before"))
        after = materialize(_step(rows, now).join(before, ["g", "start"]), "mcd-step")
        here = after.drop("_before")
        found = here if found is None else found.union(here)
        now = after.where(F.col("_before").isNull() | (F.col("logdet") < F.col("_before") - TOLERANCE)).drop("_before")
    if found is None:
        found = now
    best = F.min_by(F.struct(*[c for c in found.columns if c != "g"]), F.struct("logdet", "start")).alias("_e")
    return materialize(found.groupBy("g").agg(best).select("g", "_e.*"), "mcd-best")


def verdicts(stats: DataFrame, est: DataFrame, *, lang: str = "lang", source: str = "source") -> DataFrame:
    """``stats`` with ``base_failed``, ``distance`` (squared; null without an estimate) and ``kept``."""
    rows = stats.select("*", base_failed().alias("base_failed"), _key(lang, source), *transformed()).join(est.drop("start", "logdet"), "g", "left")
    keep = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    own = [f"`{c}`" for c in stats.columns]
    return rows.select(*own, "base_failed", _distance().alias("distance")).withColumn("kept", keep)


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``id_col``, base statistics, ``base_failed``, ``distance``, ``kept`` for every row of ``docs``.

    Null text: no words, so base_failed. Null language or source: a group of its own.
    Repeated rows count as rows; ties in distance are in or out of a core together. Other
    columns are ignored, whatever their names; an empty table gives an empty result.
    """
    given = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t"), F.col(f"`{lang}`").alias("_lang"), F.col(f"`{source}`").alias("_source"))
    stats = materialize(with_stats(given, "_t").select("_id", "_lang", "_source", "_s.*"), "quality-stats")
    out = verdicts(stats, fit(stats, lang="_lang", source="_source"), lang="_lang", source="_source")
    return out.select(F.col("_id").alias(id_col), *STATS, "base_failed", "kept", "distance")


def keep_good(docs: DataFrame, *, text_col: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that :func:`score` keeps, with their own columns.

    The rows are written once with their statistics, so that these are computed once and no
    text is shuffled.
    """
    given = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), F.col(f"`{text_col}`").alias("_t"), F.col(f"`{lang}`").alias("_lang"), F.col(f"`{source}`").alias("_source"))
    stats = materialize(with_stats(given, "_t").select("_row", "_lang", "_source", "_s.*"), "quality-stats")
    est = fit(stats, lang="_lang", source="_source")
    return verdicts(stats, est, lang="_lang", source="_source").where("kept").select("_row.*")
