"""The same functions for SQL text: scalar SQL functions, which the optimizer inlines, a table function and an aggregate."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Name, parameters, result and body of each scalar function.
SCALARS = {
    "shape_mask": ("s STRING", "STRING", "regexp_replace(regexp_replace(regexp_replace(s, '[A-Z]', 'A'), '[a-z]', 'a'), '[0-9]', '9')"),
    "unit_of": ("key STRING, salt STRING", "DOUBLE", "cast(conv(substring(md5(concat(salt, '|', key)), 1, 13), 16, 10) AS double) / 4503599627370496.0D"),
    "is_substantive": ("s STRING", "BOOLEAN", "s IS NOT NULL AND trim(s) <> '' AND NOT s RLIKE '^(0001|9999)-'"),
    "stable_round": ("x DOUBLE, digits INT", "DOUBLE", "CASE WHEN x = 0 OR x IS NULL THEN x ELSE round(x * pow(10D, digits - 1 - floor(log10(abs(x))))) / pow(10D, digits - 1 - floor(log10(abs(x)))) END"),
    "as_number": ("s STRING", "DOUBLE", "coalesce(try_cast(s AS double), CASE lower(s) WHEN 'true' THEN 1D WHEN 'false' THEN 0D END, cast(unix_micros(try_cast(s AS timestamp)) AS double))"),
}


def register(spark: SparkSession) -> None:
    """Makes all of them known to the session's SQL."""
    for name, (parameters, result, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")

    @F.udtf(returnType="part int, text string")
    class Pieces:
        """The pieces of a text, of a number of characters each."""

        def eval(self, text: str, size: int) -> Iterator[tuple]:
            for i in range(0, len(text or ""), size):
                yield i // size, text[i : i + size]

    @F.pandas_udf("double")
    def gini(x: pd.Series) -> float:
        """The Gini coefficient of a group's values, taken in one batch: for groups of bounded size."""
        v = x.dropna().sort_values().to_numpy()
        n, total = len(v), v.sum()
        return float((2 * (v * range(1, n + 1)).sum() / (n * total) - (n + 1) / n)) if n and total else 0.0

    spark.udtf.register("pieces", Pieces)
    spark.udf.register("gini", gini)
