"""Elastic net, contingency test and row projection against other ways to
the same numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyframe.ml import linear
from skyframe.operators import stats as sa


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for _ in range(300):
        a, b, c = rng.gauss(0, 1), rng.gauss(5, 3), rng.uniform(-1, 1)
        data.append((a, b, 0.5 * a + c, 7.0, 2 * a - 0.7 * b + 0.01 * c + rng.gauss(0, 0.5)))
    return spark.createDataFrame(data, "a double, b double, c double, k double, y double")


@pytest.mark.parametrize("reg,mix", [(0.0, 0.0), (0.3, 0.8), (0.5, 0.0), (0.2, 1.0), (50.0, 1.0)])
def test_matches_the_iterative_solver(rows, reg, mix):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    m = linear.fit(rows, ["a", "b", "c"], "y", reg, mix)
    v = VectorAssembler(inputCols=["a", "b", "c"], outputCol="f").transform(rows)
    want = LinearRegression(featuresCol="f", labelCol="y", regParam=reg, elasticNetParam=mix, tol=1e-12, maxIter=500).fit(v)
    assert np.allclose(m.coefficients, want.coefficients.toArray(), atol=1e-4)
    assert m.intercept == pytest.approx(want.intercept, abs=1e-3)
    assert m.rmse == pytest.approx(want.summary.rootMeanSquaredError, rel=1e-4)
    assert m.r2 == pytest.approx(want.summary.r2, abs=1e-4)
    assert m.violation < 1e-9 and all(x >= y - 1e-12 for x, y in zip(m.objective, m.objective[1:]))
    got = m.residuals(rows).agg(F.sqrt(F.avg(F.col("residual") ** 2))).first()[0]
    assert got == pytest.approx(m.rmse, rel=1e-9)


def test_odd_rows(spark, rows):
    m = linear.fit(rows, ["a", "k"], "y", 0.1, 0.5)                      # a constant feature
    assert m.coefficients[1] == 0 and m.coefficients[0] != 0
    extra = spark.createDataFrame([(None, 1.0, 1.0, 1.0, 9.0), (1.0, 1.0, 1.0, 1.0, None)], rows.schema)
    with_nulls = linear.fit(rows.union(extra), ["a", "b"], "y", 0.1, 0.5)
    assert np.allclose(with_nulls.coefficients, linear.fit(rows, ["a", "b"], "y", 0.1, 0.5).coefficients, atol=1e-9)
    assert with_nulls.rows == 300 and with_nulls.residuals(rows.union(extra)).count() == 300
    none = linear.fit(rows.limit(0), ["a", "b"], "y", 0.1, 0.5)
    assert none.rows == 0 and list(none.coefficients) == [0, 0] and none.intercept == 0
    one = linear.fit(rows.limit(1), ["a", "b"], "y")
    assert one.rows == 1 and list(one.coefficients) == [0, 0]
    flat = linear.fit(rows.withColumn("z", F.lit(3.0)), ["a", "b"], "z", 0.1, 0.5)   # a constant label
    assert np.allclose(flat.coefficients, 0) and flat.intercept == pytest.approx(3.0) and flat.r2 == 0
    with pytest.raises(RuntimeError):
        linear.fit(rows, ["a", "b", "c"], "y", 0.3, 0.8, max_iter=1)


def test_contingency(spark):
    cells = [("r1", "c1", 13), ("r1", "c2", 47), ("r2", "c1", 40), ("r2", "c2", 11), ("r3", "c1", 20), ("r3", "c2", 30)]
    o = np.array([[13, 47], [40, 11], [20, 30]], float)
    e = o.sum(1, keepdims=True) * o.sum(0) / o.sum()
    df = spark.createDataFrame([*cells[1:], ("r1", "c1", 6), ("r1", "c1", 7), (None, "c1", 5), ("r1", "c2", 0)],
                               "r string, c string, n long")
    got = sa.chisq_contingency(df, "r", "c", "n").first()
    x = ((o - e) ** 2 / e).sum()
    assert got["statistic"] == pytest.approx(x) and got["dof"] == 2 and got["p_value"] == pytest.approx(math.exp(-x / 2))
    with_zero = spark.createDataFrame([("a", "x", 5), ("b", "y", 7)], "r string, c string, n long")
    assert sa.chisq_contingency(with_zero, "r", "c", "n").first()["statistic"] == pytest.approx(12.0)
    none = sa.chisq_contingency(df.limit(0), "r", "c", "n").first()
    assert (none["statistic"], none["dof"], none["p_value"]) == (0.0, 0, 1.0)


def test_chi_square_tail():
    assert sa.chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert sa.chi_square_tail(7.814727903251179, 3) == pytest.approx(0.05)
    assert sa.chi_square_tail(9.487729036781154, 4) == pytest.approx(0.05)
    assert sa.chi_square_tail(124.3421134, 100) == pytest.approx(0.05, abs=1e-6)
    assert sa.chi_square_tail(1e6, 7) == 0.0 and sa.chi_square_tail(0.0, 3) == 1.0


def test_projection(spark):
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 4)) @ np.diag([5, 3, 1, 0.1])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>")
    df = df.select("id", array_to_vector("v").alias("v"))
    got = np.array([r["projected"] for r in sa.project_rows(df, "v", 2).orderBy("id").collect()])
    want = x @ sa.row_pca(df, "v", 2)
    assert np.allclose(got, want)
    assert got[:, 0].var() > got[:, 1].var()
