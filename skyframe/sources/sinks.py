"""Batch sinks: file formats with save modes, partitioned and bucketed
tables, text lines, JDBC, and a write/read-back check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", **opts) -> None:
    df.write.mode(mode).format(fmt).options(**opts).save(path)


def write_partitioned(df: DataFrame, path: str, cols: list[str], fmt: str = "parquet",
                      mode: str = "overwrite") -> None:
    """One folder per key value.  Rows are clustered by the partition
    columns first so each task writes few files."""
    df.repartition(*cols).write.mode(mode).format(fmt).partitionBy(*cols).save(path)


def write_bucketed(df: DataFrame, table: str, n: int, cols: list[str], sort: list[str] | None = None,
                   partition_by: list[str] | None = None, fmt: str = "parquet",
                   mode: str = "overwrite", path: str | None = None) -> None:
    """A bucketed (and optionally sorted / partitioned) catalog table: later
    joins and aggregations on the bucket columns skip the shuffle."""
    w = df.write.mode(mode).format(fmt).bucketBy(n, *cols)
    if sort:
        w = w.sortBy(*sort)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def write_text(df: DataFrame, path: str, cols: list[str] | None = None, sep: str = "\t",
               mode: str = "overwrite") -> None:
    """One line per row, fields joined by ``sep``; a null is an empty field
    (so every line keeps all its positions)."""
    cols = cols or df.columns
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]).alias("value")
    df.select(line).write.mode(mode).text(path)


def write_jdbc(df: DataFrame, url: str, table: str, props: dict | None = None,
               ddl: str | None = None, mode: str = "errorifexists") -> None:
    w = df.write.mode(mode)
    if ddl:
        w = w.option("createTableColumnTypes", ddl)
    w.jdbc(url, table, properties=props or {})


def roundtrip_count(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write, read back, and compare counts in one row (before, after, equal)."""
    spark = df.sparkSession
    df.write.mode("overwrite").format(fmt).save(path)
    back = spark.read.format(fmt).load(path)
    after = back.agg(F.count(F.lit(1))).scalar()
    return (df.agg(F.count(F.lit(1)).alias("before")).withColumn("after", after)
              .withColumn("equal", F.col("before") == F.col("after")))
