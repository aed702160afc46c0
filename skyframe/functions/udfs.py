"""User-defined functions and aggregates.

Python runs only where it must, and then on Arrow batches:

* ``udaf_mean`` -- a zero / reduce / merge / finish aggregate.  The reduce
  step is pandas code over bounded chunks (``applyInPandas`` on
  (key, salt) groups), merge and finish are native aggregates, so a key
  holding a third of the rows is still spread over ``buckets`` tasks.
* ``register_my_average`` -- the same average as a SQL-callable grouped
  aggregate (pandas UDF); use it over salted sub-groups (see the
  registered query) when one key can be large.
* ``count_tokens`` -- scalar, native ``size``; ``count_tokens_pandas`` is
  the Arrow-batched Python form of the same function.
* ``map_frames`` -- partition-wise pandas function with an output schema.
* ``apply_params`` -- one small job per parameter row, run in parallel.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def my_average(value: str | Column) -> Column:
    """Native mean that skips nulls: sum / count (partial aggregation)."""
    v = F.col(value) if isinstance(value, str) else value
    return (F.sum(v) / F.count(v)).cast("double")


def udaf_mean(df: DataFrame, key: str, value: str, buckets: int = 64) -> DataFrame:
    """Mean per key with a Python reduce step over bounded chunks."""
    salted = df.select(key, value, F.pmod(F.xxhash64(*df.columns), F.lit(buckets)).alias("_salt"))

    def reduce_chunk(pdf: pd.DataFrame) -> pd.DataFrame:     # zero + reduce
        v = pdf[value].dropna()
        return pd.DataFrame({key: pdf[key].iloc[:1], "_sum": [float(v.sum())], "_n": [int(v.count())]})

    kt = dict(df.dtypes)[key]
    partial = salted.groupBy(key, "_salt").applyInPandas(reduce_chunk, f"{key} {kt}, _sum double, _n long")
    merged = partial.groupBy(key).agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))   # merge
    return merged.select(key, (F.col("_sum") / F.col("_n")).alias("average"))             # finish


def register_my_average(spark: SparkSession, name: str = "myAverage"):
    """Register a grouped-aggregate pandas UDF usable in SQL; nulls skipped."""
    @F.pandas_udf("double")
    def my_avg(v: pd.Series) -> float:
        v = v.dropna()
        return float(v.mean()) if len(v) else None

    spark.udf.register(name, my_avg)
    return my_avg


def count_tokens(df: DataFrame, col: str, out: str = "n_tokens") -> DataFrame:
    return df.withColumn(out, F.size(F.col(col)))


@F.pandas_udf(T.IntegerType())
def _count_tokens_pd(tokens: pd.Series) -> pd.Series:
    return tokens.map(lambda t: 0 if t is None else len(t)).astype("int32")


def count_tokens_pandas(df: DataFrame, col: str, out: str = "n_tokens") -> DataFrame:
    return df.withColumn(out, _count_tokens_pd(F.col(col)))


def map_frames(df: DataFrame, fn, schema) -> DataFrame:
    """Apply ``fn(pandas.DataFrame) -> pandas.DataFrame`` to each Arrow batch
    of each partition (R ``dapply``)."""
    def run(batches):
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def apply_params(spark: SparkSession, params: list[dict], fn, schema: str) -> DataFrame:
    """Run ``fn(param_dict) -> pandas.DataFrame`` once per parameter set, in
    parallel tasks (R ``spark.lapply``).  ``fn`` must work on bounded data
    (sufficient statistics, a model, a small table) captured in its closure."""
    import json
    rows = [(i, json.dumps(p)) for i, p in enumerate(params)]
    pdf = spark.createDataFrame(rows, "_i int, _p string").repartition(max(1, len(rows)), "_i")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return fn(json.loads(group["_p"].iloc[0]))
    return pdf.groupBy("_i").applyInPandas(run, schema)
