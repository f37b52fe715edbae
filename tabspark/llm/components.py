"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, materialize, scratch


def _large(edges: DataFrame) -> DataFrame:
    """Each node gives its larger neighbours the least node that it knows."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("b"), F.col("m").alias("a")).where("a <> b").select("a", "b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours, and itself, to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of ``a, b`` links: root is the least node of the component.

    The edges are pre-aggregated to one star for each component in a logarithmic number of
    rounds; each round's edges are written, so a lost executor costs one round at most.
    A root appears with itself. Self-links and repeated links do no harm.
    """
    spark = edges.sparkSession
    path = scratch(spark, "components")
    now = materialize(edges.select("a", "b").where("a <> b").distinct(), "components", path)
    seen = None
    while True:
        after = scratch(spark, "components")
        now = materialize(_small(_large(now)), "components", after)
        drop_scratch(spark, path)
        path = after
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            break
        seen = state
    stars = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.union(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
