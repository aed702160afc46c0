"""Gaussian mixtures by expectation maximisation over packed blocks of points.

The start is that of ``pyspark.ml``'s estimator, and so are the steps and the end; but its
rounds visit one cached vector object a row.  Here points are packed once into blocks of
numbers, and a round is one pass of array operations over them whose sums (k weights,
means and moment matrices) are all that reaches the driver.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import clustering as K
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from skyframe.session import checkpoint_dir

ROWS_PER_BLOCK = 32_768
EPSILON = float(np.finfo(float).eps)      # added to every density, so that none is zero


@dataclass
class Mixture:
    weights: list[float]
    means: np.ndarray             # k x d
    covs: np.ndarray              # k x d x d
    features: str
    iterations: int = 0
    log_likelihood: float = float("-inf")

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (vector, one per component) and ``prediction``."""
        share = _shares(self.weights, self.means, self.covs)

        @pandas_udf("array<double>")
        def probability(x: pd.Series) -> pd.Series:
            return pd.Series(list(share(np.stack(x.to_numpy()).T.copy())[0].T)) if len(x) else pd.Series([], dtype=object)

        p = F.col("_shares")
        return (df.withColumn("_shares", probability(vector_to_array(self.features)))
                  .withColumn("prediction", (F.array_position(p, F.array_max(p)) - 1).cast("int"))
                  .withColumn("probability", array_to_vector(p)).drop("_shares"))


def _shares(weights, means: np.ndarray, covs: np.ndarray):
    """Points, one a column -> (probability of each component, density of each point)."""
    forms = []
    for w, m, c in zip(weights, means, covs):
        values, vectors = np.linalg.eigh(c)
        kept = values > EPSILON * values.max() * len(values)
        if not kept.any():
            raise ValueError("a covariance matrix has no non-zero singular value")
        root = vectors[:, kept] / np.sqrt(values[kept])
        forms.append((w, m, root, -0.5 * (len(values) * math.log(2 * math.pi) + np.log(values[kept]).sum())))

    def run(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = np.empty((len(forms), x.shape[1]))
        for i, (w, m, root, u) in enumerate(forms):
            z = root.T @ (x - m[:, None])
            z *= z
            p[i] = EPSILON + w * np.exp(u - 0.5 * z.sum(0))
        total = p.sum(0)
        p /= total
        return p, total
    return run


def _pack(d: int):
    def run(batches):
        held, n = [], 0
        for pdf in batches:
            if len(pdf):
                held.append(np.stack(pdf["x"].to_numpy()))
                n += len(pdf)
            if n >= ROWS_PER_BLOCK:
                yield pd.DataFrame({"points": [np.concatenate(held).T.astype("<f8").tobytes()]})
                held, n = [], 0
        if n:
            yield pd.DataFrame({"points": [np.concatenate(held).T.astype("<f8").tobytes()]})
    return run


def _sums(model: Mixture, d: int):
    """Blocks -> one row: log-likelihood, then per component weight, weighted sum and moments."""
    k, (weights, means, covs) = len(model.weights), (model.weights, model.means, model.covs)

    def run(batches):
        share = _shares(weights, means, covs)
        log, w, s, m = 0.0, np.zeros(k), np.zeros((k, d)), np.zeros((k, d, d))
        for pdf in batches:
            for b in pdf["points"]:
                x = np.frombuffer(b, "<f8").reshape(d, -1)
                p, total = share(x)
                log += float(np.log(total).sum())
                w += p.sum(1)
                s += p @ x.T
                for i in range(k):
                    m[i] += (x * p[i]) @ x.T
        yield pd.DataFrame({"s": [np.concatenate([[log], w, s.ravel(), m.ravel()])]})
    return run


def fit(df: DataFrame, k: int, seed: int, features: str = "features", max_iter: int = 100, tol: float = 0.01) -> Mixture:
    """Rounds until the log-likelihood changes by at most ``tol``, ``max_iter`` at most."""
    spark = df.sparkSession
    start = K.GaussianMixture(k=k, seed=seed, featuresCol=features, maxIter=0).fit(df)     # its start, no round
    gaussians = start.gaussiansDF.collect()                                               # k rows
    model = Mixture(list(start.weights), np.stack([g["mean"].toArray() for g in gaussians]),
                    np.stack([g["cov"].toArray() for g in gaussians]), features)
    d = model.means.shape[1]
    path = f"{checkpoint_dir(spark)}/points-{uuid.uuid4().hex}"
    df.select(vector_to_array(features).alias("x")).mapInPandas(_pack(d), "points binary").write.parquet(path)
    points = spark.read.parquet(path)
    before = 0.0
    log = -float(np.finfo(float).max)
    while model.iterations < max_iter and abs(log - before) > tol:
        each = points.mapInPandas(_sums(model, d), "s array<double>")
        found = dict(each.select(F.posexplode("s").alias("pos", "v")).groupBy("pos").agg(F.sum("v")).collect())  # k d^2 numbers
        s = np.array([found[i] for i in range(len(found))])
        w, mean, moment = s[1:1 + k], s[1 + k:1 + k + k * d].reshape(k, d), s[1 + k + k * d:].reshape(k, d, d)
        mean = mean / w[:, None]
        cov = moment / w[:, None, None] - mean[:, :, None] * mean[:, None, :]
        before, log = log, float(s[0])
        model = Mixture([float(v) for v in w / w.sum()], mean, cov, features, model.iterations + 1, log)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return model
