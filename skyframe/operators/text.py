"""Line and word operators over text columns (whole texts, every line)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lines(df: DataFrame, col: str = "text", name: str = "line") -> DataFrame:
    """One row per line of a text column."""
    return df.select(F.explode(F.split(F.col(col), "\n", -1)).alias(name))


def words(df: DataFrame, col: str = "line", sep: str = " ", name: str = "word") -> DataFrame:
    """Split on a literal separator; empty tokens are kept (see ``nonempty``)."""
    import re
    return df.select(F.explode(F.split(F.col(col), re.escape(sep), -1)).alias(name))


def nonempty(df: DataFrame, col: str = "word") -> DataFrame:
    return df.filter(F.length(col) > 0)


def word_count(df: DataFrame, col: str = "line", sep: str = " ") -> DataFrame:
    """Count per word after splitting on ``sep`` (partial counts map-side)."""
    w = nonempty(words(df, col, sep))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def grep_count(df: DataFrame, col: str, needle: str) -> DataFrame:
    """Number of rows whose ``col`` contains ``needle``."""
    return df.filter(F.col(col).contains(needle)).agg(F.count(F.lit(1)).alias("matches"))


def sort_numbers(df: DataFrame, col: str = "line") -> DataFrame:
    """Space-separated integers, one row each, ascending, duplicates kept;
    tokens that are not integers are dropped."""
    nums = df.select(F.explode(F.split(F.col(col), " ")).alias("tok"))
    nums = nums.select(F.expr("try_cast(tok AS BIGINT)").alias("number")).filter("number IS NOT NULL")
    return nums.orderBy("number")
