"""Profiles of one table: every statistic of a column set in one scan, then group-wise mixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import canonical, hashed, null_pattern, shape_mask, sql_round


def unpivot(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """Rows (keep..., column, value) with canonical text values, null included."""
    kinds = dict(df.dtypes)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), canonical(F.col(c), kinds[c]).alias("value")) for c in columns]))
    return df.select(*keep, cells.alias("_c")).select(*keep, "_c.*")


def counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, n_rows, n_null, n_empty, n_distinct of each column, by one scan and one aggregation by value."""
    by_value = unpivot(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("c"))
    return by_value.groupBy("column").agg(
        F.sum("c").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("c"))), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum(F.when(F.trim("value") == "", F.col("c"))), F.lit(0)).alias("n_empty"),
        F.count("value").alias("n_distinct"),
    )


def value_mix(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, entropy (bits), entropy_norm, top1_share of the non-null values.

    With counts c of n rows the entropy is log n - sum(c log c) / n: one aggregation more, no
    row meets the others of its column.
    """
    by_value = unpivot(df, columns).where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("c"))
    n = F.sum("c").cast("double")
    out = by_value.groupBy("column").agg((F.log2(n) - F.sum(F.col("c") * F.log2("c")) / n).alias("h"), F.count(F.lit(1)).alias("k"), (F.max("c") / n).alias("top1"))
    return out.select("column", F.round(F.abs("h"), 6).alias("entropy"), F.when(F.col("k") > 1, F.round(F.col("h") / F.log2(F.col("k").cast("double")), 6)).otherwise(0.0).alias("entropy_norm"), F.round("top1", 6).alias("top1_share"))


def top_values(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    """The k most frequent values of each column, ties by value."""
    by_value = unpivot(df, columns).where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))
    return by_value.withColumn("rank", rank).where(F.col("rank") <= k)


def numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, n, zeros, minimum, maximum, mean, std (population) and power means, in one scan."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        good = F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
        aggs.append(F.struct(F.lit(c).alias("column"), F.count(good).alias("n"), F.count_if(good == 0).alias("zeros"), F.min(good).alias("minimum"), F.max(good).alias("maximum"), F.round(F.avg(good), 6).alias("mean"), F.round(F.stddev_pop(good), 6).alias("std"), F.round(F.kurtosis(good), 4).alias("kurtosis")).alias(c))
    return df.agg(*aggs).select(F.explode(F.array(*columns)).alias("s")).select("s.*")


def deciles(df: DataFrame, column: str) -> DataFrame:
    """i, value: the 11 nearest-index deciles, index ``round(i * (n - 1) / 10)`` with ties to even.

    Positions come from counts by distinct value and a running total, so no sort of all rows
    meets in one task: the running total is over distinct values, by range partitions.
    """
    by_value = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("c"))
    placed = running(by_value, "value", "c")
    n = by_value.agg(F.sum("c").alias("n"))
    wanted = n.select(F.explode(F.sequence(F.lit(0), F.lit(10))).alias("i"), "n").select("i", F.bround(F.col("i") * (F.col("n") - 1) / 10, 0).cast("long").alias("at"))
    return placed.join(F.broadcast(wanted), (F.col("at") >= F.col("before")) & (F.col("at") < F.col("before") + F.col("c"))).select("i", "value")


#: Bytes (as the optimizer estimates them) that one task orders in a running total.
PART = 64 << 20


def cuts(df: DataFrame, order: str) -> list:
    """Values that cut ``df`` into ranges of about PART bytes: none for a small table.

    They come from the values of a hash band, so they are the same whenever they are asked for.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = min(1000, size // PART + 1)
    if parts < 2:
        return []
    band = F.pmod(F.xxhash64(order), F.lit(max(1, size // 16 // (parts * 50)))) == 0
    found = sorted(r[0] for r in df.where(F.col(order).isNotNull() & band).select(order).distinct().collect())
    return found[:: max(1, len(found) // parts)][1:]


def running(df: DataFrame, order: str, *sums: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``before`` (``before_x`` of several): the sum over the rows of smaller ``order`` of the same ``by``.

    Two levels: rows fall into ranges by fixed cuts and are summed within each; totals of the
    ranges (a row for each) are summed up and joined back.
    """
    names = ["before"] if len(sums) == 1 else [f"before_{x}" for x in sums]
    bounds = cuts(df, order)
    upto = Window.partitionBy(*by, "_p").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = df.withColumn("_p", F.size(F.filter(F.array(*[F.lit(x) for x in bounds]), lambda c: c <= F.col(order))) if bounds else F.lit(0))
    inner = ranged.withColumns({n: F.sum(x).over(upto) - F.col(x) for n, x in zip(names, sums, strict=True)})
    if not bounds:
        return inner.drop("_p")
    totals = ranged.groupBy(*by, "_p").agg(*[F.sum(x).alias(f"_t{i}") for i, x in enumerate(sums)])
    ranges = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # as many rows as cuts
    offsets = totals.select(*by, "_p", *[(F.sum(f"_t{i}").over(ranges) - F.col(f"_t{i}")).alias(f"_o{i}") for i in range(len(sums))])
    met = inner.join(F.broadcast(offsets), [*by, "_p"])
    return met.select(*df.columns, *[(F.col(n) + F.col(f"_o{i}")).alias(n) for i, n in enumerate(names)])


def quantiles(df: DataFrame, column: str, probabilities: list[float]) -> DataFrame:
    """p, value: interpolated exact percentiles, from counts by distinct value and their running total."""
    by_value = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("x")).agg(F.count(F.lit(1)).alias("c"))
    placed, n = running(by_value, "x", "c"), by_value.agg(F.sum("c").alias("n"))
    at = F.col("p") * (F.col("n") - 1)
    wanted = n.select(F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p"), "n").select("p", F.floor(at).alias("lo"), F.ceil(at).alias("hi"), (at - F.floor(at)).alias("part"))
    holds = lambda i: (F.col(i) >= F.col("before")) & (F.col(i) < F.col("before") + F.col("c"))
    met = placed.join(F.broadcast(wanted), holds("lo") | holds("hi")).groupBy("p", "part").agg(F.min("x").cast("double").alias("a"), F.max("x").cast("double").alias("b"))
    return met.select("p", sql_round(F.col("a") + (F.col("b") - F.col("a")) * F.col("part"), 6).alias("value"))


def lengths(df: DataFrame, column: str) -> DataFrame:
    """n, mean_length and the truncated-index p05, p50, p95 of string lengths."""
    by = df.where(F.col(column).isNotNull()).groupBy(F.length(column).alias("len")).agg(F.count(F.lit(1)).alias("c"))
    up = by.withColumn("before", F.sum("c").over(Window.orderBy("len").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("c"))  # as many rows as there are lengths
    n = by.agg(F.sum("c").alias("n"), F.round(F.sum(F.col("len") * F.col("c")) / F.sum("c"), 6).alias("mean_length"))
    full = up.crossJoin(F.broadcast(n))
    at = lambda p: F.max(F.when((F.floor(F.lit(p) * (F.col("n") - 1)) >= F.col("before")) & (F.floor(F.lit(p) * (F.col("n") - 1)) < F.col("before") + F.col("c")), F.col("len")))
    return full.groupBy("n", "mean_length").agg(at(0.05).alias("p05"), at(0.5).alias("p50"), at(0.95).alias("p95"))


def shapes(df: DataFrame, column: str, floor: float) -> DataFrame:
    """mask, n, share of the masks with at least ``floor`` of the values; the others as one tail."""
    masks = df.where(F.col(column).isNotNull()).groupBy(shape_mask(F.col(column)).alias("mask")).agg(F.count(F.lit(1)).alias("n"))
    total = masks.crossJoin(F.broadcast(masks.agg(F.sum("n").alias("t"))))
    return total.groupBy(F.when(F.col("n") / F.col("t") >= floor, F.col("mask")).otherwise("<tail>").alias("mask")).agg(F.sum("n").alias("n"), F.round(F.sum("n") / F.max("t"), 6).alias("share"))


def null_patterns(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    """pattern, n: the k most frequent null patterns, ties by pattern."""
    by = df.groupBy(null_pattern(*[F.col(c) for c in columns]).alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
    return by.orderBy(F.desc("n"), "pattern").limit(k)


def calendar(df: DataFrame, column: str) -> DataFrame:
    """part, slot, n for weekday (Monday 0), month (0..11) and hour."""
    t = F.col(column).cast("timestamp")
    parts = F.array(*[F.struct(F.lit(p).alias("part"), e.cast("long").alias("slot")) for p, e in (("dow", F.weekday(t)), ("month", F.month(t) - 1), ("hour", F.hour(t)))])
    return df.where(F.col(column).isNotNull()).select(F.explode(parts).alias("s")).groupBy("s.part", "s.slot").agg(F.count(F.lit(1)).alias("n"))


def kinds(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, kind by the ladder constant, numeric, temporal, categorical, free_text."""
    types = dict(df.dtypes)
    by_value = unpivot(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("c"))
    stats = by_value.groupBy("column").agg(
        F.sum("c").alias("n"), F.count("value").alias("d"), F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("c"))), F.lit(0)).alias("m"), F.coalesce(F.sum(F.length("value") * F.col("c")), F.lit(0)).alias("chars")
    )
    group = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit("numeric" if types[c] in ("bigint", "int", "double", "float") or types[c].startswith("decimal") else "temporal" if types[c].startswith(("timestamp", "date")) else "text"))])[F.col("column")]
    kind = (
        F.when((F.col("d") == 1) & (F.col("m") == F.col("n")), "constant")
        .when(group == "numeric", F.when(F.col("d") <= 20, "categorical").otherwise("numeric"))
        .when(group == "temporal", F.when(F.col("d") <= 20, "categorical").otherwise("temporal"))
        .when(F.col("d") <= 50, "categorical")
        .otherwise("free_text")
    )
    return stats.select("column", kind.alias("kind"), F.col("d").alias("n_distinct"))


def runs(df: DataFrame, by: list[str], order: list[Column], value: str) -> DataFrame:
    """by..., longest: the longest run of one value in order (gaps and islands)."""
    w, v = Window.partitionBy(*by).orderBy(*order), Window.partitionBy(*by, value).orderBy(*order)
    islands = df.select(*by, value, (F.row_number().over(w) - F.row_number().over(v)).alias("_g"))
    return islands.groupBy(*by, value, "_g").agg(F.count(F.lit(1)).alias("c")).groupBy(*by).agg(F.max("c").alias("longest"))


def steps(df: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """by, n_steps, constant: do consecutive values of a group differ by one constant step?"""
    w = Window.partitionBy(by).orderBy(order)
    step = df.select(by, (F.col(value) - F.lag(value).over(w)).alias("s")).where("s IS NOT NULL")
    return step.groupBy(by).agg(F.count(F.lit(1)).alias("n_steps"), (F.min("s") == F.max("s")).alias("constant"))


def key_report(df: DataFrame, key: list[str]) -> DataFrame:
    """n_rows, n_keys, max_repeat; NULL counts as a value."""
    by = df.groupBy(*key).agg(F.count(F.lit(1)).alias("c"))
    return by.agg(F.sum("c").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), F.max("c").alias("max_repeat"))


def sketches(df: DataFrame, column: str) -> DataFrame:
    """Approximate distinct count and quartiles: bounded sketches for tables that exact ones are too dear for."""
    return df.agg(F.approx_count_distinct(column, 0.02).alias("distinct_about"), F.percentile_approx(column, [0.25, 0.5, 0.75], 10000).alias("quartiles_about"))


def digest(df: DataFrame) -> DataFrame:
    """One row: an order-free digest of a table, SHA-256 over the number of rows and the sums of four parts of their SHA-256.

    Sums combine map-side, so nothing but one row moves; repeated rows count each.
    """
    h = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in sorted(df.columns)]), 256)
    parts = [F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(p), F.lit(0).cast("decimal(20,0)")).alias(f"s{i}") for i, p in enumerate(parts)])
    return one.select("n", F.sha2(F.concat_ws(":", F.col("n").cast("string"), *[F.col(f"s{i}").cast("string") for i in range(4)]), 256).alias("digest"))


def planning(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, n_rows, n_null, n_distinct, mean, std, minimum, maximum: everything that plans need, in one select over the table."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs.append(F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(c).isNull()).alias("n_null"), F.countDistinct(c).alias("n_distinct"), F.round(F.avg(x), 4).alias("mean"), F.round(F.stddev_pop(x), 4).alias("std"), F.min(x).alias("minimum"), F.max(x).alias("maximum")).alias(c))
    return df.agg(*aggs).select(F.explode(F.array(*columns)).alias("s")).select("s.*")


def strings(df: DataFrame, column: str) -> DataFrame:
    """One row: n, null, blank, distinct, least, greatest and mean length."""
    c = F.col(column)
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(c.isNull()).alias("n_null"), F.count_if(F.trim(c) == "").alias("n_empty"), F.countDistinct(c).alias("n_distinct"), F.min(F.length(c)).cast("long").alias("min_length"), F.max(F.length(c)).cast("long").alias("max_length"), F.round(F.avg(F.length(c)), 6).alias("mean_length"))


def temporal(df: DataFrame, column: str, now: str) -> DataFrame:
    """One row: first and last time in microseconds, the shares of whole days and of times after ``now``."""
    c = F.col(column)
    later = F.unix_micros(c.cast("timestamp")) > F.unix_micros(F.lit(now).cast("timestamp"))
    return df.agg(F.unix_micros(F.min(c).cast("timestamp")).alias("first_us"), F.unix_micros(F.max(c).cast("timestamp")).alias("last_us"), F.round(F.avg((c == F.date_trunc("day", c)).cast("double")), 6).alias("day_share"), F.round(F.avg(later.cast("double")), 6).alias("future_share"))


def null_patterns_tail(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    """pattern, n: the k most frequent null patterns, ties by pattern, and one row for all others."""
    by = df.groupBy(null_pattern(*[F.col(c) for c in columns]).alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
    top = by.orderBy(F.desc("n"), "pattern").limit(k).select("pattern", F.lit(True).alias("_top"))
    met = by.join(F.broadcast(top), "pattern", "left")
    return met.groupBy(F.when(F.col("_top"), F.col("pattern")).otherwise("<tail>").alias("pattern")).agg(F.sum("n").alias("n"))


def literals(df: DataFrame, column: str, salt: str) -> DataFrame:
    """code, literal: the least text of each value code."""
    return df.where(F.col(column).isNotNull()).groupBy(hashed(F.col(column), salt).alias("code")).agg(F.min(F.col(column).cast("string")).alias("literal"))


def payloads(rows: DataFrame) -> DataFrame:
    """``rows`` with ``payload``: each as JSON, as profiles are stored."""
    return rows.withColumn("payload", F.to_json(F.struct(*rows.columns)))


def table_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, statistic, value: the counts and mixes of the columns as rows, from one aggregation by value."""
    by_value = unpivot(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("c"))
    some = F.col("value").isNotNull()
    n = F.sum(F.when(some, F.col("c"))).cast("double")
    one = by_value.groupBy("column").agg(
        F.sum("c").cast("double").alias("rows"),
        F.coalesce(F.sum(F.when(~some, F.col("c"))), F.lit(0)).cast("double").alias("nulls"),
        F.count("value").cast("double").alias("distinct"),
        F.round(F.abs(F.log2(n) - F.sum(F.when(some, F.col("c") * F.log2("c"))) / n), 6).alias("entropy"),
        F.round(F.max(F.when(some, F.col("c"))) / n, 6).alias("top1_share"),
        F.count_if(some & (F.col("c") == 1)).cast("double").alias("singletons"),
    )
    names = [c for c in one.columns if c != "column"]
    return one.select("column", F.explode(F.array(*[F.struct(F.lit(x).alias("statistic"), F.col(x).alias("value")) for x in names])).alias("s")).select("column", "s.*")


def profile_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """column, statistic, value_a, value_b, delta of two :func:`table_profile` frames; a side that lacks one is null."""
    on = ["column", "statistic"]
    met = a.withColumnRenamed("value", "value_a").join(b.withColumnRenamed("value", "value_b"), on, "full_outer")
    return met.select(*on, "value_a", "value_b", F.round(F.col("value_b") - F.col("value_a"), 6).alias("delta"))


def copy_flags(counted: DataFrame, least: int, share: float) -> DataFrame:
    """column, source_distinct, copied: of a census, the columns of more than ``least`` source values of which at least ``share`` occur on the other side."""
    by = counted.groupBy("column").agg(F.count_if(F.col("c_src") > 0).alias("source_distinct"), F.round(F.count_if((F.col("c_src") > 0) & (F.col("c_syn") > 0)) / F.count_if(F.col("c_src") > 0), 6).alias("copied"))
    return by.where((F.col("source_distinct") > least) & (F.col("copied") >= share))
