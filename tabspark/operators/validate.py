"""Validation of generated rows: record rules, orphan gate, uniqueness, dead letters, run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rule_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df`` with ``rule``: the first rule, in the order given, that a row breaks; null if none."""
    out = F.lit(None).cast("string")
    for name, broken in reversed(rules.items()):
        out = F.when(F.coalesce(broken, F.lit(False)), name).otherwise(out)
    return df.withColumn("rule", out)


def record_rules(df: DataFrame, required: list[str] = (), key: list[str] = (), max_length: dict[str, int] | None = None) -> dict[str, Column]:
    """Rule name to condition that breaks it, from a table's declared columns."""
    rules = {f"pk.null:{c}": F.col(c).isNull() for c in key}
    rules |= {f"schema.required:{c}": F.col(c).isNull() for c in required}
    rules |= {f"schema.max_length:{c}": F.length(c) > n for c, n in (max_length or {}).items()}
    rules |= {f"schema.non_finite:{c}": F.isnan(c) | (F.abs(F.col(c)) == float("inf")) for c, t in df.dtypes if t in ("double", "float")}
    return rules


def orphan_gate(child: DataFrame, parent: DataFrame, fk: list[str], pk: list[str]) -> DataFrame:
    """``child`` with ``orphan``: no parent has the key; a key that is NULL throughout passes."""
    keys = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(pk)]).distinct().withColumn("_m", F.lit(1))
    on = F.lit(True)
    for i, f in enumerate(fk):
        on = on & (F.col(f) == F.col(f"_p{i}"))
    some = F.coalesce(*[F.col(f).cast("string") for f in fk]).isNotNull()
    met = child.join(keys, on, "left")
    return met.select(*child.columns, (some & F.col("_m").isNull()).alias("orphan"))


def row_digest(df: DataFrame, columns: list[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns]))


def unique(df: DataFrame, key: list[str], identity: list[str]) -> DataFrame:
    """``df`` with ``verdict``: ok, duplicate.row, duplicate.pk or duplicate.identity.

    One row survives for each digest of the non-identity columns; of those, the least digest
    of each key; of those, the least digest of each identity. NULL counts as the text None.
    Equal rows are counted first and each least row is found by aggregation, so that a
    frequent row or key takes no task more than its partial results.
    """
    text = lambda cs: F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in cs])
    rows = df.select(F.struct(*df.columns).alias("_row"), row_digest(df, [c for c in df.columns if c not in identity]).alias("_d"), text(identity).alias("_i"), text(key).alias("_k"))
    rows = rows.groupBy("_d", "_i", "_k").agg(F.first("_row").alias("_row"), F.count(F.lit(1)).alias("_c"))
    lost, mine = F.lit(0), {"_d": F.struct("_i"), "_k": F.struct("_s", "_d", "_i"), "_i": F.struct("_s", "_d", "_k")}
    rows = rows.withColumn("_s", lost)
    for step, (by, order) in enumerate(mine.items(), 1):
        first = rows.groupBy(by).agg(F.min(order).alias("_first"))
        rows = rows.join(first, by).withColumn("_s", F.when((F.col("_s") == 0) & (order != F.col("_first")), step).otherwise(F.col("_s"))).drop("_first")
    verdict = F.element_at(F.array(*[F.lit(x) for x in ("ok", "duplicate.row", "duplicate.pk", "duplicate.identity")]), F.col("_s") + 1)
    each = rows.select("_row", verdict.alias("_v"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("_c"))).alias("_n"))
    return each.select("_row.*", F.when(F.col("_n") > 1, "duplicate.row").otherwise(F.col("_v")).alias("verdict"))


def unique_counts(df: DataFrame, key: list[str], identity: list[str]) -> DataFrame:
    """One row: rows, excess rows, keys and identities; counts alone, for streams and very large tables."""
    parts = []
    for name, columns in (("row", df.columns), ("pk", key), ("identity", identity)):
        by = df.groupBy(*columns).agg((F.count(F.lit(1)) - 1).alias("x")).agg(F.sum("x").alias(f"{name}_excess"))
        parts.append(by)
    out = df.agg(F.count(F.lit(1)).alias("n"))
    for p in parts:
        out = out.crossJoin(F.broadcast(p))  # one row each
    return out


def dead_letters(rows: DataFrame, rule: str = "rule") -> DataFrame:
    """rule, payload: rejected rows in the uniform dead-letter form."""
    others = [c for c in rows.columns if c != rule]
    return rows.where(F.col(rule).isNotNull()).select(F.col(rule).alias("rule"), F.to_json(F.struct(*others)).alias("payload"))


def weighted_rules(letters: DataFrame, weights: dict[str, Column] | None = None) -> DataFrame:
    """rule, weight: rows lost by rule; a rule weighs 1 a row unless ``weights`` says otherwise."""
    w = F.lit(1)
    for rule, value in (weights or {}).items():
        w = F.when(F.col("rule") == rule, value).otherwise(w)
    return letters.groupBy("rule").agg(F.sum(w).cast("long").alias("weight"))


def run_summary(ruled: DataFrame, weights: dict[str, Column], excluded: list[str], budget: float) -> DataFrame:
    """One row: blockers, total, ratio, status, of rows with their first broken ``rule`` (null: valid).

    Excluded rules leave both sides of the ratio. One aggregation over the rows.
    """
    w = F.lit(1)
    for rule, value in weights.items():
        w = F.when(F.col("rule") == rule, value).otherwise(w)
    blocks = F.col("rule").isNotNull() & ~F.col("rule").isin(excluded)
    one = ruled.agg(F.coalesce(F.sum(F.when(blocks, w)), F.lit(0)).cast("long").alias("blockers"), F.count_if(F.col("rule").isNull()).alias("valid"))
    total = F.col("blockers") + F.col("valid")
    return one.select("blockers", total.alias("total"), F.round(F.col("blockers") / total, 6).alias("ratio"), F.when(F.col("blockers") / total > budget, "FAILED").otherwise("PASSED").alias("status"))


def without_failed(rows: DataFrame, failed: DataFrame, unit: str) -> DataFrame:
    """``rows`` but those of units (tables) that are listed as failed: their results are withheld."""
    return rows.join(failed.select(unit).distinct(), unit, "left_anti")


#: Rule, dimension, severity, threshold (null: judged after the run by limits of its own).
RULES = [
    ("schema.types", "validity", "BLOCKER", 1.0),
    ("null.required", "completeness", "BLOCKER", 0.0),
    ("pk.duplicate", "uniqueness", "BLOCKER", 0.0),
    ("fk.orphan", "consistency", "BLOCKER", 0.0),
    ("row.duplicate", "uniqueness", "BLOCKER", 0.0),
    ("identity.unique", "uniqueness", "BLOCKER", 0.0),
    ("engine_failure", "reliability", "BLOCKER", 0.0),
    ("schema.batch", "validity", "CRITICAL", 1.0),
    ("null.optional", "completeness", "MAJOR", 0.05),
    ("range.numeric", "validity", "CRITICAL", 1.0),
    ("enum.member", "validity", "CRITICAL", 1.0),
    ("regex.format", "validity", "MAJOR", 0.999),
    ("freetext.empty_parity", "fidelity", "MAJOR", 0.10),
    ("freetext.distinct_floor", "fidelity", "MAJOR", 0.5),
    ("freetext.copy_fraction", "privacy", "BLOCKER", 0.0001),
    ("numeric.decile_ks", "fidelity", "MAJOR", 0.4),
]
#: Share of blocked rows that a run may have, by environment.
BUDGETS = {"dev": 0.20, "uat": 0.05, "prd": 0.01}


def rule_catalogue(spark) -> DataFrame:
    return spark.createDataFrame(RULES, "rule string, dimension string, severity string, threshold double")


def batch(df: DataFrame, types: dict[str, str], required: list[str] = (), max_length: dict[str, int] | None = None, ranges: dict[str, tuple[float, float]] | None = None, members: dict[str, list] | None = None, formats: dict[str, str] | None = None, key: list[str] = ()) -> DataFrame:
    """rule, column, checked, failed: every rule of a declared table over all its rows, in one aggregation, and one for the key.

    A column that is missing, too many, or of another type fails for all rows (schema.batch, schema.types).
    """
    own, n, rows = dict(df.dtypes), F.count(F.lit(1)), []
    fail = lambda cond: F.count_if(F.coalesce(cond, F.lit(False)))

    def rule(name: str, column: str, checked: Column, failed: Column) -> None:
        rows.append(F.struct(F.lit(name).alias("rule"), F.lit(column).alias("column"), checked.cast("long").alias("checked"), failed.cast("long").alias("failed")))

    for c, t in types.items():
        rule("schema.types", c, n, F.lit(0) if own.get(c) == t else n)
    for c in sorted(set(own) ^ set(types)):
        rule("schema.batch", c, n, n)
    for c in required:
        rule("null.required", c, n, fail(F.col(c).isNull()))
    for c, most in (max_length or {}).items():
        rule("schema.batch", c, F.count(c), fail(F.length(c) > most))
    for c, (low, high) in (ranges or {}).items():
        rule("range.numeric", c, F.count(c), fail((F.col(c) < low) | (F.col(c) > high)))
    for c, values in (members or {}).items():
        rule("enum.member", c, F.count(c), fail(~F.col(c).isin(values)))
    for c, pattern in (formats or {}).items():
        rule("regex.format", c, F.count(c), fail(~F.col(c).rlike(pattern)))
    out = df.agg(*[x.alias(f"r{i}") for i, x in enumerate(rows)]).select(F.explode(F.array(*[f"r{i}" for i in range(len(rows))])).alias("x")).select("x.*")
    if key:
        by = df.groupBy(*key).agg(n.alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("checked"), F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("failed"))
        out = out.union(by.select(F.lit("pk.duplicate"), F.lit(",".join(key)), "checked", "failed"))
    return out


def gate(failures: DataFrame, severities: tuple[str, ...] = ("BLOCKER", "CRITICAL")) -> DataFrame:
    """One row: rules broken of each severity, and the verdict, from :func:`batch`."""
    known = rule_catalogue(failures.sparkSession).select("rule", "severity")
    broken = failures.where("failed > 0").join(F.broadcast(known), "rule")
    one = broken.agg(*[F.count_if(F.col("severity") == s).alias(s.lower()) for s in ("BLOCKER", "CRITICAL", "MAJOR")])
    return one.withColumn("verdict", F.when(sum(F.col(s.lower()) for s in severities) > 0, "FAILED").otherwise("PASSED"))
