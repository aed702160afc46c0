"""Physical layout of the shared tables for repeated large joins.

The fact table (lineitem) and orders are joined on the order key by every
destination-based airline query.  Writing both once as catalog tables
bucketed (and sorted) by the order key lets later sort-merge joins read
matching buckets side by side with no shuffle of either table; the
dimensions keep their own keys.  Both tables need the same bucket count,
chosen so one bucket of the larger table is a task-sized few hundred MB;
the rows are repartitioned by the bucket key before the write so each
bucket is one file per table, not one per writing task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyframe.session import table


def bucket_by_order(spark: SparkSession, sf_dir: str, prefix: str, path: str, buckets: int = 64) -> dict:
    """Write lineitem and orders bucketed and sorted by order key as
    ``<prefix>_lineitem`` / ``<prefix>_orders`` (data under ``path``)."""
    names = {}
    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        t = f"{prefix}_{name}"
        (table(spark, sf_dir, name).repartition(buckets, key)
             .write.mode("overwrite").format("parquet")
             .bucketBy(buckets, key).sortBy(key).option("path", f"{path}/{name}").saveAsTable(t))
        names[name] = t
    return names


def co_located_join(spark: SparkSession, names: dict) -> DataFrame:
    """lineitem joined with orders on the order key, read from the bucketed
    tables: the plan has no Exchange below the join."""
    li = spark.table(names["lineitem"])
    o = spark.table(names["orders"])
    return li.join(o, li.l_orderkey == o.o_orderkey)
