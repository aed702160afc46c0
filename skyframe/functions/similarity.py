"""Locality-sensitive hashing: bucketed random projection (Euclidean) and
MinHash (Jaccard) models, nearest neighbours and approximate joins."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel, MinHashLSH
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# rows of a bucket that meet at once, and rows of small buckets that share a task's group
TILE_ROWS, GROUP_ROWS = 8_192, 20_000


def brp(df: DataFrame, bucket_length: float, tables: int = 3, features: str = "features", seed: int = 42):
    return BucketedRandomProjectionLSH(inputCol=features, outputCol="hashes", bucketLength=bucket_length,
                                       numHashTables=tables, seed=seed).fit(df)


def minhash(df: DataFrame, tables: int = 5, features: str = "features", seed: int = 42):
    return MinHashLSH(inputCol=features, outputCol="hashes", numHashTables=tables, seed=seed).fit(df)


def ann(model, df: DataFrame, key, k: int) -> DataFrame:
    """Up to k approximate nearest neighbours of ``key`` (may return fewer)."""
    return model.approxNearestNeighbors(df, key, k)


def approx_join(model, a: DataFrame, b: DataFrame, threshold: float, id_col: str = "id",
                dist: str = "distance") -> DataFrame:
    """Pairs (a, b) closer than ``threshold`` that share a hash bucket in at
    least one table.  Candidate pairs come only from shared buckets; each
    returned pair's distance is exact.

    With Euclidean hashes candidates are never written: a bucket's rows are dealt to
    tiles, each pair of tiles meets in one group, and only pairs below the threshold
    leave it, from the first table in which they share a bucket."""
    if isinstance(model, BucketedRandomProjectionLSHModel):
        return _tiled_join(model, a, b, threshold, id_col, dist)
    j = model.approxSimilarityJoin(a, b, threshold, distCol=dist)
    return j.select(F.col(f"datasetA.{id_col}").alias("id_a"), F.col(f"datasetB.{id_col}").alias("id_b"), dist)


def _tiled_join(model, a: DataFrame, b: DataFrame, threshold: float, id_col: str, dist: str,
                tile: int | None = None) -> DataFrame:
    tile = tile or TILE_ROWS
    tables = model.getNumHashTables()

    def hashed(df: DataFrame) -> DataFrame:
        h = model.transform(df.distinct())                # a row that comes twice counts once
        values = F.transform(F.array(*[vector_to_array(F.col(model.getOutputCol())[t]) for t in range(tables)]), lambda v: v[0])
        h = h.select(F.col(id_col).alias("id"), vector_to_array(model.getInputCol()).alias("x"), values.alias("h"))
        return h.select("id", "x", "h", F.posexplode("h").alias("t", "bucket"))

    left, right = hashed(a), hashed(b)
    count = lambda df, n: df.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias(n))
    shared = count(left, "na").join(count(right, "nb"), ["t", "bucket"])
    tiles = lambda n: F.ceil(F.col(n) / tile).cast("int")
    # small buckets share groups, a large one has groups of its own (its hash is not below ``few``)
    few = 1 + tables * (a.count() + b.count()) // GROUP_ROWS
    name = F.xxhash64("t", "bucket")
    group = F.when(F.col("na") + F.col("nb") < GROUP_ROWS // 10, F.pmod(name, F.lit(few))).otherwise(name)
    shared = shared.select("t", "bucket", group.alias("g"), tiles("na").alias("ta"), tiles("nb").alias("tb"))
    here, there = (lambda n: F.pmod(F.xxhash64("id", "x"), F.col(n)).cast("int")), (lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)))
    left = left.join(shared, ["t", "bucket"]).select("g", here("ta").alias("i"), there("tb").alias("j"), "t", "bucket", "id", "x", "h")
    right = right.join(shared, ["t", "bucket"]).select(F.col("g").alias("g_b"), there("ta").alias("i_b"), here("tb").alias("j_b"), "t", "bucket", "id", "x", "h")
    kinds = dict(left.dtypes)["id"], dict(right.dtypes)["id"]
    return (left.groupBy("g", "i", "j").cogroup(right.groupBy("g_b", "i_b", "j_b"))
                .applyInPandas(_meet(threshold, dist), f"id_a {kinds[0]}, id_b {kinds[1]}, `{dist}` double"))


def _meet(threshold: float, dist: str):
    """Two tiles -> their pairs below ``threshold`` that share this bucket and none of an earlier table."""
    def pairs(p: pd.DataFrame, q: pd.DataFrame, t: int):
        x, y = np.stack(p["x"].to_numpy()), np.stack(q["x"].to_numpy())
        hx, hy = np.stack(p["h"].to_numpy()), np.stack(q["h"].to_numpy())
        xx, yy = (x * x).sum(1), (y * y).sum(1)
        step = max(1, 2_000_000 // len(y))
        for s in range(0, len(x), step):
            norms = xx[s:s + step, None] + yy
            near = norms - 2 * (x[s:s + step] @ y.T) <= threshold ** 2 + 1e-9 * norms      # a margin for rounding
            m, n = np.nonzero(near)
            m += s
            for e in range(t):
                fresh = hx[m, e] != hy[n, e]
                m, n = m[fresh], n[fresh]
            d = np.zeros(len(m))
            for c in range(x.shape[1]):                    # in order of components, as the model adds them
                d += (x[m, c] - y[n, c]) ** 2
            d = np.sqrt(d)
            kept = d < threshold
            yield p["id"].to_numpy()[m[kept]], q["id"].to_numpy()[n[kept]], d[kept]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            others = dict(list(right.groupby(["t", "bucket"])))
            for key, p in left.groupby(["t", "bucket"]):
                if key in others:
                    found += pairs(p, others[key], key[0])
        cols = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
        return pd.DataFrame(dict(zip(["id_a", "id_b", dist], cols)))
    return run
