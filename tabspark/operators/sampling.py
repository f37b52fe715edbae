"""Deterministic samples: bottom-k reservoirs, systematic proportional-to-size points, prefiltered and fixed-size ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import unit
from .profile import running


def bottom_k(df: DataFrame, key: str, k: int, salt: str) -> DataFrame:
    """key, multiplicity, priority: the k keys of least priority (a function of key and salt), with all their rows counted.

    Reservoirs merge: the k least of the union of two are the k least of both, with counts added.
    """
    by = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("multiplicity"))
    return by.withColumn("priority", unit(F.col("key"), salt)).orderBy("priority", "key").limit(k)


def merge_reservoirs(a: DataFrame, b: DataFrame, k: int) -> DataFrame:
    """The reservoir of two tables from theirs (of the same k and salt)."""
    both = a.unionByName(b).groupBy("key").agg(F.sum("multiplicity").alias("multiplicity"), F.min("priority").alias("priority"))
    return both.orderBy("priority", "key").limit(k)


def prefiltered(df: DataFrame, key: Column, salt: str, k: int, n: int, slack: float = 4.0) -> DataFrame:
    """The k rows of least priority, dropping those before the sort that can't be among them but by a rare chance.

    A row passes with probability ``slack * k / n``; where fewer than k pass, none is dropped.
    """
    rows = df.withColumn("_u", unit(key, salt))
    some = rows.where(F.col("_u") < min(1.0, slack * k / max(n, 1)))
    enough = some.agg(F.count(F.lit(1)).alias("c")).first()[0] >= min(k, n)
    return (some if enough else rows).orderBy("_u").limit(k).drop("_u")


def systematic(df: DataFrame, size: str, order: str, points: int, start: float = 0.5) -> DataFrame:
    """order, size, hits: how many of ``points`` equally spaced points fall on each row's share of the sizes, rows in order.

    The running total is two-level; a row of a share above 1 / points is hit more than once.
    """
    rows = df.groupBy(order).agg(F.sum(size).alias("size"))
    placed = running(rows, order, "size").crossJoin(F.broadcast(rows.agg(F.sum("size").alias("total"))))
    upto = lambda x: F.ceil(x * points / F.col("total") - start)
    hits = (F.greatest(upto(F.col("before") + F.col("size")), F.lit(0)) - F.greatest(upto(F.col("before")), F.lit(0))).cast("long")
    return placed.select(order, "size", hits.alias("hits")).where("hits > 0")


def head_and_tail(counted: DataFrame, value: str, least: int, salt: str, rate: float) -> DataFrame:
    """``counted`` (value, c) with ``weight``: values of ``least`` rows or more are in for certain, of the others the share ``rate``."""
    head = F.col("c") >= least
    inside = counted.where(head | (unit(F.col(value), salt) < rate))
    return inside.withColumn("weight", F.when(head, 1.0).otherwise(1.0 / rate))


def stratified_totals(sampled: DataFrame, least: int) -> DataFrame:
    """One row from :func:`head_and_tail`: sums of the head and of the sampled tail, and the estimated total."""
    head = F.col("c") >= least
    part = lambda cond, x: F.coalesce(F.sum(F.when(cond, x)), F.lit(0))
    return sampled.agg(part(head, F.col("c")).alias("head_rows"), part(~head, F.col("c")).alias("tail_rows"), F.count_if(~head).alias("tail_clusters"), part(~head, F.col("c") * F.col("c")).alias("tail_squares"), F.round(F.sum(F.col("c") * F.col("weight")), 4).alias("estimated_rows"))
