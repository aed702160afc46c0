"""Session catalog: temp and global views, SQL on them, catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query(spark: SparkSession, df: DataFrame, view: str, sql: str) -> DataFrame:
    """Register ``df`` as ``view`` and run ``sql`` against it."""
    df.createOrReplaceTempView(view)
    return spark.sql(sql)


def global_view(df: DataFrame, name: str) -> str:
    """Visible from every session of the application as ``global_temp.name``."""
    df.createOrReplaceGlobalTempView(name)
    return f"global_temp.{name}"


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def create_kv_table(spark: SparkSession, name: str, path: str | None = None,
                    sep: str = "\u0001") -> DataFrame:
    """``CREATE TABLE name(key INT, value STRING)`` and optionally load a
    text file of ``key<sep>value`` lines into it."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (key INT, value STRING) USING parquet")
    if path:
        from pyspark.sql import functions as F
        raw = spark.read.text(path)
        parts = F.split(F.col("value"), sep)
        kv = raw.select(parts.getItem(0).cast("int").alias("key"), parts.getItem(1).alias("value"))
        kv.write.insertInto(name)
    return spark.table(name)
