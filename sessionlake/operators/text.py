"""Word count over lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: what separates words.
SEPARATORS = r"[ \t\n\r\f]+"


def word_count(df: DataFrame, column: str = "value", lower: bool = False) -> DataFrame:
    """Words, split on white space, with the number of times they occur."""
    text = F.lower(column) if lower else F.col(column)
    words = df.select(F.explode(F.split(text, SEPARATORS)).alias("word"))
    return words.filter(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
