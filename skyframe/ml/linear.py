"""Linear regression with an elastic-net penalty from one pass over the rows.

Means, variances and covariances of the features and the label are one Spark
aggregate with partial sums; coordinate descent then works on that small
matrix alone, so rounds cost nothing in rows.  The penalty is on standardised
coefficients: ``reg * mix * sum|b|`` and ``reg / sd(label) * (1 - mix) / 2 * sum b^2``
with ``b`` = coefficient times the feature's standard deviation (deviations divide by the
rows), which is the parametrisation of ``pyspark.ml``'s default solver.

Rows with a null in a feature or the label take no part.  A constant feature
gets the coefficient 0.  Without rows all coefficients are 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.operators.graph import rounds


@dataclass
class Linear:
    names: list[str]
    label: str
    intercept: float
    coefficients: np.ndarray
    rows: int
    rmse: float
    r2: float
    objective: list[float]        # before the first round and after each
    violation: float              # of the optimality conditions, by standardised coefficient

    def linear(self) -> Column:
        out = F.lit(float(self.intercept))
        for n, c in zip(self.names, self.coefficients):
            out = out + F.lit(float(c)) * F.col(n)
        return out

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.linear())

    def residuals(self, df: DataFrame, out: str = "residual") -> DataFrame:
        """``df`` without rows that took no part, with label minus prediction."""
        return df.dropna(subset=[*self.names, self.label]).withColumn(out, F.col(self.label) - self.linear())

    def table(self, spark) -> DataFrame:
        """(term, coefficient)."""
        rows = [("(intercept)", float(self.intercept)), *zip(self.names, map(float, self.coefficients))]
        return spark.createDataFrame(rows, "term string, coefficient double")


def moments(df: DataFrame, names: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows without nulls, means, and the covariance matrix (divided by the rows)."""
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    cols = [F.col(n).cast("double") for n in names]
    r = df.dropna(subset=names).agg(F.count(F.lit(1)), *[F.avg(c) for c in cols],
                                    *[F.covar_pop(cols[i], cols[j]) for i, j in pairs]).first()
    n, d = r[0], len(names)
    if not n:
        return 0, np.zeros(d), np.zeros((d, d))
    cov = np.zeros((d, d))
    for (i, j), v in zip(pairs, r[1 + d:]):
        cov[i, j] = cov[j, i] = v
    return n, np.array(r[1:1 + d], float), cov


def fit(df: DataFrame, features: list[str], label: str, reg: float = 0.0, mix: float = 0.0, tol: float = 1e-13,
        max_iter: int | None = None) -> Linear:
    """Coordinate descent until no standardised coefficient moves by more
    than ``tol`` of the label's deviation; an error if a given ``max_iter`` is reached first."""
    n, mean, cov = moments(df, [*features, label])
    d = len(features)
    sd = np.sqrt(np.diag(cov))
    used = np.flatnonzero(sd[:d] > 0)
    scale = sd[used]
    c = cov[np.ix_(used, used)] / np.outer(scale, scale)
    cy = cov[used, d] / scale
    lasso, ridge = reg * mix, (reg * (1 - mix) / sd[d] if sd[d] else 0.0)
    b = np.zeros(len(used))

    def loss() -> float:
        return float((cov[d, d] - 2 * b @ cy + b @ c @ b) / 2 + lasso * np.abs(b).sum() + ridge / 2 * b @ b)

    history = [loss()]
    if reg == 0:
        b = np.linalg.lstsq(c, cy, rcond=None)[0]
        history.append(loss())
    else:
        for _ in rounds(max_iter):
            moved = 0.0
            for j in range(len(b)):
                pull = cy[j] - c[j] @ b + c[j, j] * b[j]
                new = np.sign(pull) * max(abs(pull) - lasso, 0.0) / (c[j, j] + ridge)
                moved, b[j] = max(moved, abs(new - b[j])), new
            history.append(loss())
            if moved <= tol * sd[d]:
                break
    slope = cy - c @ b - ridge * b
    off = np.where(b != 0, np.abs(slope - lasso * np.sign(b)), np.maximum(np.abs(slope) - lasso, 0.0))
    coefficients = np.zeros(d)
    coefficients[used] = b / scale
    sse = max(0.0, cov[d, d] - 2 * b @ cy + b @ c @ b)
    return Linear(list(features), label, float(mean[d] - coefficients @ mean[:d]), coefficients, n, float(np.sqrt(sse)),
                  float(1 - sse / cov[d, d]) if cov[d, d] else 0.0, history, float(off.max(initial=0.0)))
