"""Generalized linear models by iteratively reweighted least squares.

Each round is one pass over the rows: every task adds up X'WX, X'Wz and the
deviance of its Arrow batches, Spark adds up the tasks' sums, and the driver solves one
system of (features + 1) equations.  The result carries what a summary
prints: standard errors from the Fisher information, t or z statistics,
p-values, deviance, null deviance, dispersion and AIC.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.operators.graph import rounds

TINY = 1e-10


@dataclass(frozen=True)
class Link:
    """eta = g(mu), its inverse, and g'(mu)."""
    to_eta: Callable
    to_mu: Callable
    slope: Callable
    column: Callable          # inverse as a Spark expression


LINKS = {
    "identity": Link(lambda m: m, lambda e: e, np.ones_like, lambda e: e),
    "log": Link(np.log, np.exp, lambda m: 1 / m, F.exp),
    "logit": Link(lambda m: np.log(m / (1 - m)), lambda e: 1 / (1 + np.exp(-e)), lambda m: 1 / (m * (1 - m)),
                  lambda e: 1.0 / (1.0 + F.exp(-e))),
    "inverse": Link(lambda m: 1 / m, lambda e: 1 / e, lambda m: -1 / (m * m), lambda e: 1.0 / e),
    "sqrt": Link(np.sqrt, lambda e: e * e, lambda m: 0.5 / np.sqrt(m), lambda e: e * e),
}


def _y_log(y, m):
    """y ln(y / m), 0 where y is 0."""
    return np.where(y > 0, y * np.log(np.where(y > 0, y, 1) / m), 0.0)


@dataclass(frozen=True)
class Family:
    link: str                 # the canonical one
    variance: Callable
    start: Callable           # first mean from the response
    deviance: Callable        # of one row
    clip: Callable
    fixed: bool               # dispersion is 1


FAMILIES = {
    "gaussian": Family("identity", np.ones_like, lambda y: y, lambda y, m: (y - m) ** 2, lambda m: m, False),
    "binomial": Family("logit", lambda m: m * (1 - m), lambda y: (y + 0.5) / 2,
                       lambda y, m: 2 * (_y_log(y, m) + _y_log(1 - y, 1 - m)), lambda m: np.clip(m, TINY, 1 - TINY), True),
    "poisson": Family("log", lambda m: m, lambda y: np.maximum(y, 0.1), lambda y, m: 2 * (_y_log(y, m) - (y - m)),
                      lambda m: np.maximum(m, TINY), True),
    "gamma": Family("inverse", lambda m: m * m, lambda y: np.maximum(y, TINY),
                    lambda y, m: -2 * (np.log(y / m) - (y - m) / m), lambda m: np.maximum(m, TINY), False),
}


@dataclass
class GLM:
    family: str
    link: str
    names: list[str]
    coefficients: np.ndarray      # intercept first
    std_errors: np.ndarray
    statistics: np.ndarray        # z where the dispersion is fixed, else t
    p_values: np.ndarray
    deviance: float
    null_deviance: float
    dispersion: float
    aic: float
    dof: int
    rows: int
    rounds: int
    score: np.ndarray             # gradient of the log-likelihood (times the dispersion) at the solution

    def linear(self, features: str | list[str], df: DataFrame) -> Column:
        x = _features(df, features)
        w = F.array(*[F.lit(float(v)) for v in self.coefficients[1:]])
        return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(float(self.coefficients[0])), lambda s, v: s + v)

    def predict(self, df: DataFrame, features: str | list[str], out: str = "prediction") -> DataFrame:
        """``df`` with the expected response."""
        return df.withColumn(out, LINKS[self.link].column(self.linear(features, df)))

    def table(self, spark) -> DataFrame:
        """(term, coefficient, std_error, statistic, p_value)."""
        rows = [(n, float(c), float(s), float(t), float(p)) for n, c, s, t, p in zip(
            ["(intercept)", *self.names], self.coefficients, self.std_errors, self.statistics, self.p_values)]
        return spark.createDataFrame(rows, "term string, coefficient double, std_error double, statistic double, p_value double")


def _features(df: DataFrame, features: str | list[str]) -> Column:
    if isinstance(features, list):
        return F.array(*[F.col(c).cast("double") for c in features])
    kind = dict(df.dtypes)[features]
    return F.col(features).cast("array<double>") if kind.startswith("array") else vector_to_array(F.col(features))


def _summed(rows: DataFrame, part: Callable, size: int) -> np.ndarray:
    """``part`` maps (x with intercept, y, weight) of a batch to ``size``
    numbers; their sums over all rows.  Tasks add up their batches, one
    aggregate adds up the tasks."""
    def run(batches):
        total = np.zeros(size)
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["x"].to_numpy())
                with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
                    total += part(np.hstack([np.ones((len(x), 1)), x]), pdf["y"].to_numpy(), pdf["w"].to_numpy())
        yield pd.DataFrame({"i": np.arange(size), "v": total})

    out = np.zeros(size)
    for r in rows.mapInPandas(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():   # ``size`` rows
        out[r["i"]] = r["v"]
    return out


def _log_gamma(y: np.ndarray) -> np.ndarray:
    some, at = np.unique(y, return_inverse=True)
    return np.array([math.lgamma(v) for v in some])[at]


def _p_value(t: float, dof: int, fixed: bool) -> float:
    from skyframe.streaming.learners import t_two_sided_p
    return math.erfc(abs(t) / math.sqrt(2)) if fixed else t_two_sided_p(float(t), dof)


def fit(df: DataFrame, features: str | list[str], label: str, family: str = "gaussian", link: str | None = None,
        weight: str | None = None, tol: float = 1e-10, max_iter: int | None = 100,
        names: list[str] | None = None) -> GLM:
    """Fit until the deviance changes by less than ``tol`` of itself; an
    error if ``max_iter`` rounds are not enough.  Rows with a null in the
    label, the weight or a feature take no part."""
    fam, g = FAMILIES[family], LINKS[link or FAMILIES[family].link]
    x = _features(df, features)
    rows = df.select(x.alias("x"), F.col(label).cast("double").alias("y"),
                     (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))
    rows = rows.filter("x is not null and y is not null and w > 0").filter(F.forall("x", lambda v: v.isNotNull()))
    rows = rows.persist()
    try:
        head = rows.agg(F.count(F.lit(1)), F.sum("w"), F.sum(F.col("w") * F.col("y")), F.max(F.size("x")),
                        F.sum(F.log("w"))).first()
        n, total, weighted, p, log_w = head
        if not n:
            raise ValueError("no rows to fit")
        p += 1
        beta: np.ndarray | None = None
        last = math.inf

        def step(x, y, w):
            if beta is None:
                mu = fam.clip(fam.start(y))
                eta = g.to_eta(mu)
            else:
                eta = x @ beta
                mu = fam.clip(g.to_mu(eta))
                eta = g.to_eta(mu)
            slope = g.slope(mu)
            weight = w / (slope * slope * fam.variance(mu))
            z = eta + (y - mu) * slope
            xw = x * weight[:, None]
            return np.concatenate([(xw.T @ x).ravel(), xw.T @ z, [(w * fam.deviance(y, mu)).sum()]])

        for done in rounds(max_iter):
            sums = _summed(rows, step, p * p + p + 1)
            deviance = float(sums[-1])
            if beta is not None and abs(deviance - last) <= tol * (abs(deviance) + 0.1):
                break
            last = deviance if beta is not None else math.inf
            beta = np.linalg.lstsq(sums[:p * p].reshape(p, p), sums[p * p:-1], rcond=None)[0]

        mean = weighted / total

        def final(x, y, w):
            mu = fam.clip(g.to_mu(x @ beta))
            slope = g.slope(mu)
            residual = w * (y - mu)
            own = {"binomial": lambda: -2 * w * (
                       np.where(y > 0, y * np.log(mu), 0) + np.where(y < 1, (1 - y) * np.log(1 - mu), 0)),
                   "poisson": lambda: -2 * w * (y * np.log(mu) - mu - _log_gamma(y + 1))}.get(family, lambda: 0 * w)()
            xw = x * (w / (slope * slope * fam.variance(mu)))[:, None]
            some = [(w * fam.deviance(y, fam.clip(np.full_like(y, mean)))).sum(), (residual * (y - mu) / fam.variance(mu)).sum(),
                    own.sum(), (w * np.log(np.maximum(y, TINY))).sum() if family == "gamma" else 0.0,
                    (w * y / mu).sum() if family == "gamma" else 0.0, (w * np.log(mu)).sum() if family == "gamma" else 0.0]
            return np.concatenate([some, x.T @ (residual / (slope * fam.variance(mu))), (xw.T @ x).ravel()])

        sums = _summed(rows, final, 6 + p + p * p)
    finally:
        rows.unpersist()
    null, pearson, two_log, log_y, ratio, log_mu = sums[:6]
    information = sums[6 + p:].reshape(p, p)
    rank = int(np.linalg.matrix_rank(information))
    dof = n - rank
    dispersion = 1.0 if fam.fixed else float(pearson / dof) if dof else math.nan
    if family == "gaussian":
        aic = n * (math.log(max(deviance, 1e-300) / n * 2 * math.pi) + 1) + 2 - log_w
    elif family == "gamma":
        a = total / max(deviance, 1e-300)               # shape: 1 / mean deviance
        aic = -2 * ((a - 1) * log_y - a * ratio - a * (log_mu - math.log(a) * total) - math.lgamma(a) * total) + 2
    else:
        aic = two_log
    errors = np.sqrt(np.diag(np.linalg.pinv(information)) * dispersion)
    with np.errstate(divide="ignore", invalid="ignore"):
        statistics = beta / errors
    return GLM(family, link or fam.link, names or (features if isinstance(features, list) else [f"x{i}" for i in range(p - 1)]),
               beta, errors, statistics, np.array([_p_value(t, dof, fam.fixed) for t in statistics]), deviance, float(null),
               dispersion, float(aic + 2 * rank), dof, n, done, sums[6:6 + p])
