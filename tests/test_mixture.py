from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.linalg import Vectors

from skyframe.ml import mixture
from skyframe.ml import models as md


def test_mixture_is_that_of_the_estimator_without_caching_rows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 1, (150, 2)), rng.normal(4, [1, 2], (100, 2))])
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x.tolist())], ["id", "features"]).repartition(3)
    want = GaussianMixture(k=2, seed=538009335).fit(df)
    rounds = []
    monkeypatch.setattr(mixture, "K", SimpleNamespace(
        GaussianMixture=lambda **p: rounds.append(p["maxIter"]) or GaussianMixture(**p)))
    monkeypatch.setattr(mixture, "ROWS_PER_BLOCK", 40)
    got = md.gmm(df, 2)
    assert rounds == [0] and got.iterations == want.summary.numIter
    assert got.weights == pytest.approx(want.weights) and got.log_likelihood == pytest.approx(want.summary.logLikelihood)
    a, b = ({r.id: r for r in md.gmm_membership(m, df).collect()} for m in (got, want))
    assert all(a[i].prediction == b[i].prediction and np.allclose(a[i].probability, b[i].probability) for i in b)
