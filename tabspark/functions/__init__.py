"""Column builders: canonical text, shape masks, hash units, predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(c: Column, kind: str) -> Column:
    """Equality text of a value: plain decimals, UTC micros, base64 bytes; non-finite numbers are NULL."""
    if kind in ("double", "float"):
        return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(F.when(c == 0, F.lit("0.0")).otherwise(c.cast("string")))
    if kind.startswith("timestamp") or kind == "date":
        return F.unix_micros(c.cast("timestamp")).cast("string")
    if kind == "binary":
        return F.base64(c)
    if kind.startswith("decimal"):
        return F.regexp_replace(F.regexp_replace(c.cast("string"), "(\\.[0-9]*?)0+$", "$1"), "\\.$", "")
    if kind.startswith(("struct", "array", "map")):
        return F.to_json(c)
    return c.cast("string")


def sql_round(c: Column, places: int) -> Column:
    """A double at so many places as the SQL engine rounds it: scaled, rounded to a whole number, scaled back.

    The function ``round`` goes by decimal digits; the two differ in the last bit of large
    numbers, and a microsecond time times a million has no bits left for its fraction.
    """
    scaled = c * F.lit(float(10**places))
    return F.when(F.isnan(scaled) | (F.abs(scaled) == float("inf")), c).otherwise(F.round(scaled) / F.lit(float(10**places)))


def shape_mask(c: Column) -> Column:
    """Upper-case ASCII letters to A, lower-case to a, digits to 9; all else stays."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "9")


def unit(key: Column, salt: str) -> Column:
    """A uniform number in [0, 1) drawn from the key and a salt, alike in every engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt + "|"), key.cast("string"))), 1, 13), 16, 10).cast("double") / float(16**13)


def hashed(key: Column, salt: str) -> Column:
    """A non-negative 60-bit integer drawn from the key and a salt."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt + "|"), key.cast("string"))), 1, 15), 16, 10).cast("long")


def substantive(c: Column) -> Column:
    """Neither null, nor blank, nor a sentinel date of year 1 or 9999."""
    s = c.cast("string")
    return c.isNotNull() & (F.trim(s) != "") & ~s.rlike("^(0001|9999)-")


def null_pattern(*columns: Column) -> Column:
    return F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])


def none_null(*columns: Column) -> Column:
    """MATCH SIMPLE: a key tuple with a NULL part neither matches nor is an orphan."""
    out = F.lit(True)
    for c in columns:
        out = out & c.isNotNull()
    return out
