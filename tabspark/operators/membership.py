"""Is a synthetic row a source row? Exact, non-key and near matches; lifts; duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import canonical


def cells(df: DataFrame, columns: list[str]) -> Column:
    """Canonical texts of the columns as one array; null stays null."""
    kinds = dict(df.dtypes)
    return F.array(*[canonical(F.col(c), kinds[c]) for c in columns])


def _key(array: Column) -> Column:
    return F.sha2(F.to_json(array, {"ignoreNullFields": "false"}), 256)


def exact_matches(synthetic: DataFrame, source: DataFrame, columns: list[str]) -> DataFrame:
    """One row: n, matches, rate. Rows whose columns are all NULL never match."""
    known = source.select(_key(cells(source, columns)).alias("_k")).distinct().withColumn("_m", F.lit(1))
    some = F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()
    rows = synthetic.select(F.when(some, _key(cells(synthetic, columns))).alias("_k")).groupBy("_k").agg(F.count(F.lit(1)).alias("c"))
    met = rows.join(known, "_k", "left")
    return met.agg(F.sum("c").alias("n"), F.coalesce(F.sum(F.when(F.col("_m") == 1, F.col("c"))), F.lit(0)).alias("matches")).withColumn("rate", F.round(F.col("matches") / F.col("n"), 6))


def near_matches(synthetic: DataFrame, source: DataFrame, columns: list[str]) -> DataFrame:
    """One row: n, near. A near match equals a source row in all columns but one, and no row in all.

    Each row gives a key for every column left out; keys meet by an equi-join, so work grows
    with rows times columns.
    """
    if len(columns) < 2:
        raise ValueError("a near match needs two columns or more")

    def loo(df: DataFrame) -> DataFrame:
        whole = df.withColumn("_c", cells(df, columns)).withColumn("_all", _key(F.col("_c"))).select("_c", "_all").groupBy("_all").agg(F.first("_c").alias("_c"), F.count(F.lit(1)).alias("n"))
        left = [F.struct(F.lit(i).alias("j"), _key(F.array(*[F.get("_c", F.lit(k)) for k in range(len(columns)) if k != i])).alias("k")) for i in range(len(columns))]
        return whole.select("_all", "n", F.explode(F.array(*left)).alias("x")).select("_all", "n", "x.*")

    a, b = loo(synthetic), loo(source).select("j", "k", F.col("_all").alias("_other")).groupBy("j", "k").agg(F.min("_other").alias("lo"), F.max("_other").alias("hi"))
    met = a.join(b, ["j", "k"], "left").withColumn("near", F.coalesce((F.col("lo") != F.col("_all")) | (F.col("hi") != F.col("_all")), F.lit(False)))
    known = source.select(_key(cells(source, columns)).alias("_all")).distinct().withColumn("_m", F.lit(1))
    rows = met.groupBy("_all").agg(F.max("n").alias("n"), F.max("near").alias("near")).join(known, "_all", "left")
    return rows.agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("near") & F.col("_m").isNull(), F.col("n"))), F.lit(0)).alias("near"))


def lifts(synthetic: DataFrame, panel: DataFrame, columns: list[str]) -> DataFrame:
    """One row: distinct records of R only and of H only, how many of each are reproduced, and the lift."""
    sides = panel.select(_key(cells(panel, columns)).alias("k"), F.col("side")).groupBy("k").agg(F.max((F.col("side") == "R").cast("int")).alias("r"), F.max((F.col("side") == "H").cast("int")).alias("h"))
    hit = synthetic.select(_key(cells(synthetic, columns)).alias("k")).distinct().withColumn("s", F.lit(1))
    met = sides.join(hit, "k", "left")
    only = lambda a, b: (F.col(a) == 1) & (F.col(b) == 0)
    out = met.agg(F.count_if(only("r", "h")).alias("r_only"), F.count_if(only("h", "r")).alias("h_only"), F.count_if(only("r", "h") & (F.col("s") == 1)).alias("r_hit"), F.count_if(only("h", "r") & (F.col("s") == 1)).alias("h_hit"))
    return out.withColumn("lift", F.round(F.when(F.col("h_hit") > 0, (F.col("r_hit") / F.col("r_only")) / (F.col("h_hit") / F.col("h_only"))), 6))


def frequency_of_frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """multiplicity, records: how many distinct records occur how often."""
    by = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("multiplicity"))
    return by.groupBy("multiplicity").agg(F.count(F.lit(1)).alias("records"))


def duplicate_rate(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: n, rows whose key (without NULL) occurs twice or more, their share of all rows."""
    by = df.groupBy(*key).agg(F.count(F.lit(1)).alias("c"))
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(k).isNotNull()
    return by.agg(F.sum("c").alias("n"), F.coalesce(F.sum(F.when(whole & (F.col("c") > 1), F.col("c"))), F.lit(0)).alias("duplicates")).withColumn("rate", F.round(F.col("duplicates") / F.col("n"), 6))


def exposure_lift(synthetic: DataFrame, panel: DataFrame, columns: list[str]) -> DataFrame:
    """One row: distinct records of the exposed rows that H lacks, against those of R's others that H lacks: how many of each are reproduced, and the lift."""
    has = lambda cond: F.max(cond.cast("int"))
    sides = panel.select(_key(cells(panel, columns)).alias("k"), "side", "exposed").groupBy("k").agg(has(F.col("side") == "R").alias("r"), has(F.col("side") == "H").alias("h"), has(F.col("exposed")).alias("e"))
    hit = synthetic.select(_key(cells(synthetic, columns)).alias("k")).distinct().withColumn("s", F.lit(1))
    met = sides.where("r = 1 AND h = 0").join(hit, "k", "left")
    seen = F.col("s") == 1
    out = met.agg(F.count_if(F.col("e") == 1).alias("e_only"), F.count_if(F.col("e") == 0).alias("r_only"), F.count_if((F.col("e") == 1) & seen).alias("e_hit"), F.count_if((F.col("e") == 0) & seen).alias("r_hit"))
    return out.withColumn("lift", F.round(F.when(F.col("r_hit") > 0, (F.col("e_hit") / F.col("e_only")) / (F.col("r_hit") / F.col("r_only"))), 6))


def near_match_lift(synthetic: DataFrame, panel: DataFrame, columns: list[str]) -> DataFrame:
    """One row: synthetic rows near a row of R, near a row of H, and the ratio of these rates."""
    r, h = (near_matches(synthetic, panel.where(F.col("side") == s), columns).select(F.col("near").alias(f"near_{s}"), F.col("n").alias(f"n_{s}")) for s in "RH")
    out = r.crossJoin(F.broadcast(h))
    return out.select("near_R", "near_H", F.round(F.when(F.col("near_H") > 0, (F.col("near_R") / F.col("n_R")) / (F.col("near_H") / F.col("n_H"))), 6).alias("lift"))


def value_lift(reproduced: DataFrame, panel: DataFrame, column: str, rare: int) -> DataFrame:
    """One row: values of fewer than ``rare`` rows that only R or only H has, how many of each are among the
    values ``reproduced`` (a synthetic column, or a pool of values), and the lift."""
    by = panel.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count_if(F.col("side") == "R").alias("r"), F.count_if(F.col("side") == "H").alias("h"))
    only = by.where((F.col("r") + F.col("h") < rare) & ((F.col("r") == 0) | (F.col("h") == 0)))
    hit = reproduced.select(F.col(column).alias("v")).distinct().withColumn("s", F.lit(1))
    met = only.join(hit, "v", "left")
    r, seen = F.col("r") > 0, F.col("s") == 1
    out = met.agg(F.count_if(r).alias("r_only"), F.count_if(~r).alias("h_only"), F.count_if(r & seen).alias("r_hit"), F.count_if(~r & seen).alias("h_hit"))
    return out.withColumn("lift", F.round(F.when(F.col("h_hit") > 0, (F.col("r_hit") / F.col("r_only")) / (F.col("h_hit") / F.col("h_only"))), 6))
