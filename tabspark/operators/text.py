"""Text shapes: masks, templates, formats; and values made from them, every sign a function of a key and a salt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import shape_mask

#: Date and time formats that are tried, in this order.
FORMATS = ["yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy", "yyyyMMdd", "yyyy/MM/dd", "HH:mm:ss"]


def spaced_mask(c: Column) -> Column:
    """:func:`shape_mask` with white space as one sign."""
    return F.regexp_replace(shape_mask(c), "[ \\t\\n\\r]", "␣")


def collapse(mask: Column) -> Column:
    """Runs of two or more of a class as the class and a plus."""
    for c in "9Aa␣":
        mask = F.regexp_replace(mask, c + "{2,}", c + "+")
    return mask


def _signs(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _draw(key: Column, salt: str, i: Column, n: int) -> Column:
    """A number below n for sign i of the value of a key."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(salt), key.cast("string"), i.cast("string"))), 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")


def _sign(base: str, at: Column) -> Column:
    alphabet = {"9": "0123456789", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "a": "abcdefghijklmnopqrstuvwxyz"}[base]
    return F.substring(F.lit(alphabet), at + 1, F.lit(1))


def fill(mask: Column, key: Column, salt: str) -> Column:
    """A value of a mask: each 9, A and a drawn, all else as it stands."""
    one = lambda c, i: F.when(c == "9", _sign("9", _draw(key, salt, i, 10))).when(c == "A", _sign("A", _draw(key, salt, i, 26))).when(c == "a", _sign("a", _draw(key, salt, i, 26))).when(c == "␣", " ").otherwise(c)
    return F.array_join(F.transform(_signs(mask), one), "")


def mutate_digits(text: Column, salt: str) -> Column:
    """Every run of two digits or more drawn anew; it begins with 0 if and only if it did."""
    signs = _signs(text)
    digit = lambda i: F.coalesce(F.get(signs, i).rlike("[0-9]"), F.lit(False))

    def one(c: Column, i: Column) -> Column:
        first, run = ~digit(i - 1), digit(i) & (digit(i - 1) | digit(i + 1))
        drawn = F.when(first, F.when(c == "0", "0").otherwise(_sign("9", _draw(text, salt, i, 9) + 1))).otherwise(_sign("9", _draw(text, salt, i, 10)))
        return F.when(run, drawn).otherwise(c)

    return F.array_join(F.transform(signs, one), "")


def template(df: DataFrame, column: str) -> DataFrame:
    """One row, ``template``: per place the sign that all values have, or the narrowest class of
    9 (digits), A, a, X (letters and digits), ? of those that occur; null if lengths differ.

    Signs are counted by place before anything meets, so the result has as many rows as places until the end.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("v"))
    places = values.select(F.posexplode(_signs(F.col("v"))).alias("at", "c")).groupBy("at", "c").agg(F.count(F.lit(1)).alias("n"))
    all_ = lambda p: F.bool_and(F.col("c").rlike(p))
    by = places.groupBy("at").agg(F.count(F.lit(1)).alias("k"), F.min("c").alias("c"), F.sum("n").alias("n"), all_("^[0-9]$").alias("d"), all_("^[A-Z]$").alias("u"), all_("^[a-z]$").alias("l"), all_("^[A-Za-z0-9]$").alias("x"))
    sign = F.when(F.col("k") == 1, F.col("c")).when(F.col("d"), "9").when(F.col("u"), "A").when(F.col("l"), "a").when(F.col("x"), "X").otherwise("?")
    one = by.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", sign.alias("s")))), lambda x: x["s"]), "").alias("t"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    return one.select(F.when(F.col("lo") == F.col("hi"), F.col("t")).alias("template"))


def temporal_format(df: DataFrame, column: str) -> DataFrame:
    """One row, ``format``: the first of FORMATS that every value of the column has; null if none."""
    c = F.col(column)
    one = df.where(c.isNotNull()).agg(*[F.bool_and(F.try_to_timestamp(c, F.lit(f)).isNotNull() & (F.length(c) == len(f.replace("'", "")))).alias(f"f{i}") for i, f in enumerate(FORMATS)])
    return one.select(F.coalesce(*[F.when(F.col(f"f{i}"), f) for i, f in enumerate(FORMATS)]).alias("format"))


def relaxed_shapes(df: DataFrame, column: str, width: int, k: int) -> DataFrame:
    """bucket, mask, n, share: collapsed masks by length bucket, the k most frequent of each bucket (ties by mask)."""
    from pyspark.sql import Window

    c = F.col(column)
    by = df.where(c.isNotNull()).groupBy(F.floor(F.length(c) / width).alias("bucket"), collapse(spaced_mask(c)).alias("mask")).agg(F.count(F.lit(1)).alias("n"))
    total = by.join(F.broadcast(by.groupBy("bucket").agg(F.sum("n").alias("t"))), "bucket")
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("n"), "mask"))  # of distinct masks
    return total.withColumn("r", rank).where(F.col("r") <= k).select("bucket", "mask", "n", F.round(F.col("n") / F.col("t"), 6).alias("share"))


def hints(df: DataFrame, column: str) -> DataFrame:
    """One row: share of values with control characters, least and greatest length, whether one width holds all, letters and digits seen."""
    c = F.col(column)
    one = df.where(c.isNotNull()).agg(
        F.round(F.avg(c.rlike("[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]").cast("double")), 6).alias("control_share"),
        F.min(F.length(c)).alias("min_length"),
        F.max(F.length(c)).alias("max_length"),
        F.bool_or(c.rlike("[A-Z]")).alias("upper"),
        F.bool_or(c.rlike("[a-z]")).alias("lower"),
        F.bool_or(c.rlike("[0-9]")).alias("digit"),
        F.round(F.avg(c.rlike("^[A-Za-z]+[-_#]?[0-9]+$").cast("double")), 6).alias("identifier_share"),
    )
    return one.withColumn("fixed_width", F.col("min_length") == F.col("max_length"))


def shape_adherence(both: DataFrame, column: str) -> DataFrame:
    """One row: n, adherence: the share of synthetic values whose mask a source value has."""
    masks = both.where(F.col(column).isNotNull()).groupBy(shape_mask(F.col(column)).alias("m")).agg(F.count_if(F.col("side") == 0).alias("s"), F.count_if(F.col("side") == 1).alias("t"))
    return masks.agg(F.sum("t").alias("n"), F.round(F.sum(F.when(F.col("s") > 0, F.col("t")).otherwise(0)) / F.sum("t"), 6).alias("adherence"))


def keyed_label(value: Column, key: str) -> Column:
    """A label that shows nothing of a value without the key: ``h:`` and eight signs."""
    return F.concat(F.lit("h:"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), value.cast("string")), 256), 1, 8))


def row_text(columns: list[str]) -> Column:
    """``column is value, ...`` of a row, NULL as ``column is null``."""
    return F.concat_ws(", ", *[F.concat(F.lit(f"{c} is "), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in columns])
