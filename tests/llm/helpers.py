from __future__ import annotations

from pyspark.sql import SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Null and empty texts, ties, repeated rows, odd characters.
ODD = [
    (1, None, "en", "a", None),
    (2, "", None, "a", 0),
    (3, "one two three four five six", "en", None, 27),
    (3, "one two three four five six", "en", None, 27),
    (4, "  \t\n\v\f\r ", "en", "a", 8),
    (5, "naïve café 日本語 \u0085   don't WE'LL 1234", "fr", "b", 40),
    (6, "A" * 3000 + " tail\n\n  x", "en", "b", 3010),
    (None, "no id here", "en", "b", 10),
    (7, "<|endoftext|> middle <|startoftext|>end</s>", "en", "b", 40),
]


def docs(spark: SparkSession, rows=ODD):
    """Documents with extra columns whose names clash with what operators make."""
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.selectExpr("*", "'x' AS id", "'y' AS n_tokens", "'z' AS ids", "1 AS n_words", "2 AS start", "3 AS kept", "4 AS h", "5 AS component_id", "6 AS blob")


def texts(rows=ODD):
    return [(r[0], r[1] or "") for r in rows]


def key(row):
    return tuple((x is not None, str(x)) for x in row)
