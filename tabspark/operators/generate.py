"""Rows drawn from measured distributions, every draw a function of the row's id and a salt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashed, unit
from .profile import quantiles, running


def categorical(ids: DataFrame, source: DataFrame, column: str, id_col: str, salt: str) -> DataFrame:
    """``ids`` with ``column`` drawn with the source's exact shares (NULL too).

    The cumulative weights are one row for each distinct value, met by an interval join.
    """
    weights = source.groupBy(F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    key = weights.withColumn("_o", F.coalesce(F.col("_v").cast("string"), F.lit("")))
    placed = running(key, "_o", "_c").crossJoin(F.broadcast(weights.agg(F.sum("_c").alias("_n"))))
    cum = placed.select("_v", (F.col("before") / F.col("_n")).alias("_lo"), ((F.col("before") + F.col("_c")) / F.col("_n")).alias("_hi"))
    drawn = ids.withColumn("_u", unit(F.col(id_col), salt))
    return drawn.join(cum, (F.col("_u") >= F.col("_lo")) & (F.col("_u") < F.col("_hi"))).select(*ids.columns, F.col("_v").alias(column))


def numeric(ids: DataFrame, grid: DataFrame, column: str, id_col: str, salt: str) -> DataFrame:
    """``ids`` with ``column`` by inverse CDF: linear between the points of ``grid`` (one row: array ``q``)."""
    n = F.size("q") - 1
    x = unit(F.col(id_col), salt) * n
    at = F.floor(x).cast("int")
    lo, hi = F.get("q", at), F.get("q", F.least(at + 1, n))
    return ids.crossJoin(F.broadcast(grid)).select(*ids.columns, (lo + (hi - lo) * (x - at)).alias(column))


def quantile_grid(source: DataFrame, column: str, points: int) -> DataFrame:
    """One row, array ``q``: ``points`` interpolated percentiles."""
    q = quantiles(source, column, [i / (points - 1) for i in range(points)])
    return q.agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "value"))), lambda x: x["value"]).alias("q"))


def pooled(ids: DataFrame, pool: Column, column: str, id_col: str, salt: str, null_share: float = 0.0) -> DataFrame:
    """``ids`` with ``column`` from an array ``pool`` with replacement; NULL with the given share."""
    value = F.get(pool, F.pmod(hashed(F.col(id_col), salt), F.size(pool)).cast("int"))
    return ids.withColumn(column, F.when(unit(F.col(id_col), salt + "|null") >= null_share, value))


def identity(ids: DataFrame, column: str, id_col: str, salt: str) -> DataFrame:
    """``ids`` with a 60-bit identity value."""
    return ids.withColumn(column, hashed(F.col(id_col), salt))


def children(parents: DataFrame, key: str, histogram: DataFrame, salt: str) -> DataFrame:
    """(key, ordinal) rows: each parent gets k children, k drawn from ``histogram`` (k, parents)."""
    placed = running(histogram, "k", "parents").crossJoin(F.broadcast(histogram.agg(F.sum("parents").alias("_n"))))
    cum = placed.select("k", (F.col("before") / F.col("_n")).alias("_lo"), ((F.col("before") + F.col("parents")) / F.col("_n")).alias("_hi"))
    drawn = parents.select(key).withColumn("_u", unit(F.col(key), salt)).join(F.broadcast(cum), (F.col("_u") >= F.col("_lo")) & (F.col("_u") < F.col("_hi")))
    return drawn.where("k > 0").select(key, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("k").cast("bigint"))).alias("ordinal"))


def candidates(df: DataFrame, shared: str, value: str, m: int, salt: str) -> DataFrame:
    """shared, values: the m candidates of least salted hash for each shared key, in that order."""
    rank = F.md5(F.concat(F.lit(salt + "|"), F.col(value).cast("string")))
    nth = F.row_number().over(Window.partitionBy(shared).orderBy(rank, value))
    top = df.where(F.col(shared).isNotNull()).select(shared, value).distinct().withColumn("_n", nth).where(F.col("_n") <= m)
    return top.groupBy(shared).agg(F.transform(F.sort_array(F.collect_list(F.struct("_n", value))), lambda x: x[value]).alias("values"))


def conditional(keys: DataFrame, cands: DataFrame, shared: str) -> DataFrame:
    """``keys`` with their candidates, empty where there is none."""
    kind = dict(cands.dtypes)["values"]
    return keys.join(cands, shared, "left").withColumn("values", F.coalesce("values", F.array().cast(kind)))


def mixed_radix(index: Column, radices: list[int]) -> list[Column]:
    """The digits of an index over bounded dimensions, first dimension fastest."""
    out, below = [], 1
    for r in radices:
        out.append(F.pmod(F.floor(index / below).cast("long"), F.lit(r)))
        below *= r
    return out


def permuted(df: DataFrame, by: str, weight: Column, id_col: str, salt: str) -> DataFrame:
    """``df`` with ``place``: a weighted random order within ``by`` (u to the power 1 / weight, descending)."""
    u = F.pow(unit(F.col(id_col), salt), 1 / weight)
    return df.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(F.desc(u), id_col)))


def expected_duplicates(n: float, k: float) -> float:
    """Share of n draws from k keys that repeat an earlier one."""
    import math

    return 1 - k / n * (1 - math.exp(-n / k))


def temporal(ids: DataFrame, grid: DataFrame, column: str, id_col: str, salt: str, spread: float = 0.1) -> DataFrame:
    """``ids`` with ``column`` in microseconds: by inverse CDF between the points of ``grid`` (one row: array ``q``
    of microseconds), or, with probability ``spread``, anywhere between its ends. Nothing lies outside them."""
    n = F.size("q") - 1
    u = unit(F.col(id_col), salt)
    at = F.floor(u * n).cast("int")
    lo, hi = F.get("q", at), F.get("q", F.least(at + 1, n))
    first, last = F.get("q", F.lit(0)), F.get("q", n)
    anchored, anywhere = lo + (hi - lo) * (u * n - at), first + (last - first) * u
    drawn = F.when(unit(F.col(id_col), salt + "|spread") < spread, anywhere).otherwise(anchored)
    return ids.crossJoin(F.broadcast(grid)).select(*ids.columns, F.floor(drawn).cast("long").alias(column))


def clamped(value: Column, low: Column, high: Column, places: int) -> Column:
    """A drawn number within the source's range, at the source's scale; NULL stays."""
    return F.when(value.isNotNull(), F.round(F.greatest(low, F.least(high, value)), places))


def scrubbed(ids: DataFrame, taken: DataFrame, column: str, id_col: str, salt: str, modulus: int, attempts: int = 8) -> DataFrame:
    """``ids`` with an identity number below ``modulus`` that is not in ``taken`` (column ``value``): the first of
    some draws that isn't; one that always collides gets a number above the modulus, from its own id."""
    draws = ids.select(id_col, F.posexplode(F.array(*[F.pmod(hashed(F.col(id_col), f"{salt}|{i}"), F.lit(modulus)) for i in range(attempts)])).alias("_at", "_v"))
    free = draws.join(taken.select(F.col("value").alias("_t")).distinct(), F.col("_v") == F.col("_t"), "left_anti")
    first = free.groupBy(id_col).agg(F.min_by("_v", "_at").alias("_v"))
    return ids.join(first, id_col, "left").select(*ids.columns, F.coalesce("_v", F.lit(modulus) + hashed(F.col(id_col), salt + "|rest")).alias(column))


def fitted_tuples(parents: DataFrame, child: DataFrame, columns: list[tuple[str, str]], sweeps: int, floor: float = 0.5) -> DataFrame:
    """parent columns..., ``weight`` (whole numbers, in millionths): parent key tuples weighted so that their column
    sums follow the child's shares (iterative proportional fitting; a value that no child row has counts ``floor`` rows)."""
    keys = [p for _, p in columns]
    now = parents.select(*keys).na.drop().distinct().withColumn("w", F.lit(1.0))
    n = child.agg(F.count(F.lit(1)).alias("_n"))
    wants = {p: child.where(F.col(c).isNotNull()).groupBy(F.col(c).alias(p)).agg(F.count(F.lit(1)).cast("double").alias("want")).crossJoin(F.broadcast(n)) for c, p in columns}
    for _ in range(sweeps):
        for p in keys:
            sums = now.groupBy(p).agg(F.sum("w").alias("s"))
            scale = sums.join(wants[p], p, "left").select(p, (F.coalesce(F.col("want"), F.lit(floor)) / F.col("s")).alias("scale"))
            now = now.join(scale, p).select(*keys, (F.col("w") * F.col("scale")).alias("w"))
    total = now.agg(F.sum("w").alias("t"))
    return now.crossJoin(F.broadcast(total)).select(*keys, F.greatest(F.lit(1), F.round(F.col("w") / F.col("t") * 1e6)).cast("long").alias("weight"))


def joint_keys(ids: DataFrame, tuples: DataFrame, keys: list[str], id_col: str, salt: str) -> DataFrame:
    """``ids`` with whole parent tuples drawn by their ``weight``: the running total of the tuples in order of their text.

    A draw meets its tuple by an equality join on ranges of the running total, about as many as
    there are tuples: a tuple stands in each range that it reaches into, so at most as many
    copies are made as there are tuples and ranges, and a draw meets about two of them.
    """
    ordered = tuples.withColumn("_o", F.concat_ws("|", *[F.lpad(F.col(k).cast("string"), 20, "0") for k in keys]))
    sums = tuples.agg(F.sum("weight").alias("_m"), F.greatest(F.count(F.lit(1)), F.lit(1000)).alias("_k"))
    total = F.broadcast(sums.select("_m", F.expr("greatest(1, cast(_m AS bigint) div _k)").alias("_width")))
    placed = running(ordered, "_o", "weight").where("weight > 0").crossJoin(total)
    reach = placed.withColumn("_part", F.explode(F.expr("sequence(cast(before AS bigint) div _width, cast(before + weight - 1 AS bigint) div _width)"))).drop("_m", "_width")
    x = F.floor(unit(F.col(id_col), salt) * F.col("_m")).cast("long")
    drawn = ids.crossJoin(total).withColumn("_x", x).withColumn("_part", F.expr("_x div _width")).drop("_m", "_width")
    met = drawn.join(reach, "_part").where((F.col("_x") >= F.col("before")) & (F.col("_x") < F.col("before") + F.col("weight")))
    return met.select(*ids.columns, *keys)


def numbered(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys with ``place`` from 0 in their order."""
    keys = df.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_one", F.lit(1))
    return running(keys, key, "_one").select(key, F.col("before").cast("long").alias("place"))


def multi_parent(ids: DataFrame, index: str, dimensions: list[tuple[str, DataFrame]], sizes: list[int]) -> DataFrame:
    """``ids`` with a key of each parent: the digits of the index over the numbered parents (column, :func:`numbered`).

    Below the product of the sizes no combination comes twice.
    """
    digits = mixed_radix(F.col(index), sizes)
    out = ids
    for (name, keys), d in zip(dimensions, digits, strict=True):
        own = [c for c in keys.columns if c != "place"][0]
        out = out.withColumn("_d", d).join(keys.select(F.col(own).alias(name), F.col("place").alias("_d")), "_d").drop("_d")
    return out


def plan_log(columns: dict[str, str]) -> list[tuple[str, str]]:
    """column, strategy in order: what a generation run will do to each column."""
    return sorted(columns.items())
