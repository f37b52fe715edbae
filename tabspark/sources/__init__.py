"""Reading: tables, sides, deterministic samples and scopes. Writing: canonical JSON lines, append-only events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType


def read(spark: SparkSession, sf_dir: str, table: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(f"{sf_dir}/{table}.{fmt}")


def reference_sample(df: DataFrame, key: Column, n: int, where: Column | None = None) -> DataFrame:
    """The ``n`` rows of least md5 of ``key``: a sample that only the content decides (a feature limit)."""
    rows = df if where is None else df.where(where)
    return rows.withColumn("_r", F.md5(key.cast("string"))).orderBy("_r").limit(n).drop("_r")


def panel(df: DataFrame, key: Column, n: int, exposed: int) -> DataFrame:
    """First 2n rows in md5 order with ``rank``, ``side`` (R: 1..n, H: the rest) and ``exposed``; of a smaller
    table all rows, half of them on each side.

    The limit comes first (top-k by task), so the one-partition ranking sees 2n rows.
    """
    top = df.withColumn("_r", F.md5(key.cast("string"))).orderBy("_r").limit(2 * n)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy("_r"))).withColumn("_half", F.floor((F.count(F.lit(1)).over(Window.partitionBy()) + 1) / 2)).drop("_r")
    return ranked.withColumn("side", F.when(F.col("rank") <= F.col("_half"), "R").otherwise("H")).withColumn("exposed", F.col("rank") <= exposed).drop("_half")


def hash_band(df: DataFrame, key: Column, salt: str, keep: int, of: int) -> DataFrame:
    """Rows whose salted hash falls into the first ``keep`` of ``of`` bands: pushes down into one scan."""
    from ..functions import hashed

    return df.where(F.pmod(hashed(key, salt), F.lit(of)) < keep)


def scope_diff(end: DataFrame, start: DataFrame) -> DataFrame:
    """What ``end`` has more than ``start``, with multiplicity."""
    return end.exceptAll(start)


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def as_of(df: DataFrame, time: str, at: str) -> DataFrame:
    """The rows that a table had at a time, by its append time."""
    return df.where(F.col(time) <= F.lit(at).cast(df.schema[time].dataType))


def appends(df: DataFrame, time: str, after: str, upto: str) -> DataFrame:
    """The rows that came in a window of append times."""
    kind = df.schema[time].dataType
    return df.where((F.col(time) > F.lit(after).cast(kind)) & (F.col(time) <= F.lit(upto).cast(kind)))


def distinct_capped(df: DataFrame, column: str, cap: int) -> DataFrame:
    """One row, array ``values``: the distinct values in order, null if there are more than ``cap`` (a feature limit)."""
    some = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("v")).distinct().limit(cap + 1)
    return some.agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("v")).alias("v")).select(F.when(F.col("n") <= cap, F.col("v")).alias("values"))


def null_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: n rows, of which ``dropped`` have a NULL in the key and take part in no join."""
    from ..functions import none_null

    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(~none_null(*[F.col(c) for c in key])).alias("dropped"))


def frequent_values(df: DataFrame, column: str, least: int) -> DataFrame:
    """Values that at least ``least`` rows have."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def key_pool(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct key tuples without NULL."""
    return df.select(*columns).na.drop().distinct()


def page(df: DataFrame, order: list[Column], size: int, offset: int) -> DataFrame:
    """A page of rows, with the count of all rows as ``total`` (one aggregate joined back, not a window)."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return df.orderBy(*order).offset(offset).limit(size).crossJoin(F.broadcast(total))


def write_ndjson(df: DataFrame, path: str, mode: str = "append") -> None:
    """Canonical JSON lines: columns by name, non-finite numbers as null."""
    fixed = [F.when(F.isnan(c) | (F.abs(F.col(c)) == float("inf")), None).otherwise(F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in sorted(df.dtypes)]
    df.select(*fixed).write.mode(mode).json(path)


def append_event(df: DataFrame, event: str, path: str) -> None:
    """One append-only registry event a row; a FINAL event goes in after all other writes."""
    if event not in ("RUNNING", "FINAL", "FAILED", "SKIPPED"):
        raise ValueError(f"unknown event {event}")
    df.withColumn("event", F.lit(event)).write.mode("append").parquet(path)


def store_put(rows: DataFrame, path: str, digest: str) -> None:
    """Keep rows under a content digest; an entry that is there already stays as it is."""
    if not store_has(rows.sparkSession, path, digest):
        rows.write.mode("errorifexists").parquet(f"{path}/digest={digest}")


def store_has(spark: SparkSession, path: str, digest: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/digest={digest}")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def store_get(spark: SparkSession, path: str, digest: str) -> DataFrame | None:
    """The rows kept under a digest; None if there are none."""
    return spark.read.parquet(f"{path}/digest={digest}") if store_has(spark, path, digest) else None


def write_disposed(df: DataFrame, path: str, append: bool = True, create: bool = True) -> None:
    """Write under a disposition: append or truncate; without ``create`` only where there is a table already."""
    spark = df.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not create and not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        raise ValueError(f"{path} doesn't exist and is not to be made")
    df.write.mode("append" if append else "overwrite").parquet(path)


def load_safe(schema: StructType) -> StructType:
    """A schema without what loaders reject: metadata goes, at every depth."""

    def plain(kind):
        if isinstance(kind, StructType):
            return StructType([StructField(f.name, plain(f.dataType), f.nullable) for f in kind.fields])
        return ArrayType(plain(kind.elementType), kind.containsNull) if isinstance(kind, ArrayType) else kind

    return plain(schema)


def table_facts(df: DataFrame, key: list[str]) -> dict:
    """The schema and declared key of a table, as plain values."""
    return {"columns": [{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for f in df.schema.fields], "key": list(key)}
