"""Online learners on micro-batches (``foreachBatch``): k-means with
forgetfulness, least-squares and logistic regression by SGD, and a running
two-sample significance test.

Each batch costs one or a few distributed aggregates; the model (centres,
weights, or six summary numbers) is the only state on the driver, and it is
also written per batch so a restarted query resumes from it.
"""

from __future__ import annotations

import json
import math
import os

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from skyframe.ml.models import closest


def _arr(df: DataFrame, col: str):
    return vector_to_array(F.col(col)) if dict(df.dtypes)[col] not in ("array<double>",) else F.col(col)


def _save_state(path: str | None, batch_id: int, state: dict, spark) -> None:
    if path:
        spark.createDataFrame([(batch_id, json.dumps(state))], "batch long, state string") \
             .write.mode("overwrite").json(os.path.join(path, f"batch={batch_id}"))


def load_state(spark, path: str) -> dict | None:
    """The state written by the newest batch under ``path`` (one small row),
    so a restarted driver resumes the model where the stream left off."""
    try:
        df = spark.read.json(path)
    except Exception:  # noqa: BLE001 -- nothing written yet
        return None
    row = df.orderBy(F.desc("batch")).select("batch", "state").first()
    return {**json.loads(row["state"]), "batch": row["batch"]} if row else None


class _Once:
    """Applies each batch of a stream exactly once.  Batch ids rise.  A batch's
    new state is computed apart from the model, saved, and only then taken
    over together with the batch's id: a batch that fails anywhere before is applied in full when it
    is retried, and one that is replayed after it was applied is skipped."""

    last = -1
    state_path: str | None = None

    def update(self, batch_df: DataFrame, batch_id: int) -> None:
        if batch_id <= self.last:
            return
        new = self._next(batch_df, batch_id)
        _save_state(self.state_path, batch_id, self._state(new), batch_df.sparkSession)
        self.__dict__.update(new)
        self.last = batch_id

    def _next(self, batch_df: DataFrame, batch_id: int) -> dict:
        """The attributes after the batch; must leave the model as it is."""
        raise NotImplementedError

    def _state(self, new: dict) -> dict:
        """What of ``new`` is saved."""
        raise NotImplementedError


class StreamingKMeans(_Once):
    """Mini-batch k-means with decay ``a`` (1 = remember everything):
    c' = (c n a + sum(x)) / (n a + m),  n' = n a + m."""

    def __init__(self, centres, decay: float = 1.0, features: str = "features", state_path: str | None = None,
                 weights=None):
        self.centres = np.asarray(centres, dtype=float)
        self.weights = np.zeros(len(self.centres)) if weights is None else np.asarray(weights, dtype=float)
        self.decay = decay
        self.features = features
        self.state_path = state_path

    def _next(self, batch_df: DataFrame, batch_id: int) -> dict:
        x = batch_df.select(_arr(batch_df, self.features).alias("x"))
        stats = (x.select(closest("x", self.centres).alias("c"), array_to_vector("x").alias("v"))
                  .groupBy("c").agg(Summarizer.sum(F.col("v")).alias("s"), F.count(F.lit(1)).alias("m"))
                  .collect())                                   # at most k rows
        centres, weights = self.centres.copy(), self.weights * self.decay
        for r in stats:
            i, m, s = r["c"], r["m"], r["s"].toArray()
            n = weights[i]
            centres[i] = (centres[i] * n + s) / (n + m)
            weights[i] = n + m
        return {"centres": centres, "weights": weights}

    def _state(self, new: dict) -> dict:
        return {k: v.tolist() for k, v in new.items()}

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", closest_col(df, self.features, self.centres))

    @classmethod
    def resume(cls, spark, state_path: str, default_centres, **kw) -> "StreamingKMeans":
        st = load_state(spark, state_path)
        if st is None:
            return cls(default_centres, state_path=state_path, **kw)
        model = cls(st["centres"], state_path=state_path, weights=st["weights"], **kw)
        model.last = st["batch"]
        return model


def closest_col(df: DataFrame, col: str, centres):
    """Index of the nearest centre for a vector or array column."""
    a = _arr(df, col)
    dists = [F.aggregate(F.zip_with(a, F.array(*[F.lit(float(v)) for v in c]), lambda p, q: (p - q) * (p - q)),
                         F.lit(0.0), lambda acc, v: acc + v) for c in centres]
    return F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(dists)]))["i"]


SGD_BLOCK = 4096


def _blocks(df: DataFrame) -> DataFrame:
    """(x, y) -> (rows, xy): blocks of rows as one binary value, row-major
    doubles, the label last.  A null among a row's numbers is an error."""
    def pack(batches):
        import pandas as pd
        for pdf in batches:
            for i in range(0, len(pdf), SGD_BLOCK):
                part = pdf.iloc[i:i + SGD_BLOCK]
                xy = np.column_stack([np.stack(part["x"].to_numpy()), part["y"].to_numpy(dtype=float)])
                yield pd.DataFrame({"rows": [len(xy)], "xy": [np.ascontiguousarray(xy, dtype=float).tobytes()]})

    whole = F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull())
    x = F.when(whole, F.col("x")).otherwise(F.raise_error(F.lit("null among the numbers of a row")))
    return df.select(x.alias("x"), "y").mapInPandas(pack, "rows long, xy binary")


def _total(blocks: DataFrame, each) -> np.ndarray | None:
    """Sum of ``each(xy)``, a fixed number of values, over all blocks: added
    up in every task, then by position.  None without blocks."""
    def partial(batches):
        import pandas as pd
        s = None
        for pdf in batches:
            for rows, xy in zip(pdf["rows"], pdf["xy"]):
                v = np.asarray(each(np.frombuffer(xy).reshape(rows, -1)), dtype=float).ravel()
                s = v if s is None else s + v
        if s is not None:
            yield pd.DataFrame({"v": [s.tolist()]})

    parts = blocks.mapInPandas(partial, "v array<double>").select(array_to_vector("v").alias("v"))
    s = parts.agg(Summarizer.sum(F.col("v")).alias("s")).first()["s"]
    return None if s is None else s.toArray()


class _StreamingSGD(_Once):
    """Shared SGD loop: ``iters`` full-batch gradient steps per micro-batch,
    step size ``step / sqrt(t)`` as in the classic streaming regressors.  A batch is read
    once and packed into blocks of numbers; what a step costs is in ``_gradients``."""

    def __init__(self, dims: int, step: float = 0.1, iters: int = 50, features: str = "features",
                 label: str = "label", state_path: str | None = None):
        self.w = np.zeros(dims)
        self.step = step
        self.iters = iters
        self.features = features
        self.label = label
        self.state_path = state_path
        self.t = 0

    def _dot(self, x, w=None):
        wl = F.array(*[F.lit(float(v)) for v in (self.w if w is None else w)])
        return F.aggregate(F.zip_with(x, wl, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)

    @staticmethod
    def _residual(dot: np.ndarray, y: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def _gradients(self, blocks: DataFrame):
        """Function of the weights: the gradient summed over ``blocks``; here one pass each."""
        residual = self._residual

        def gradient(w: np.ndarray) -> np.ndarray:
            def each(xy):
                x, y = xy[:, :-1], xy[:, -1]
                return residual(x @ w, y) @ x
            s = _total(blocks, each)
            return np.zeros(len(w)) if s is None else s
        return gradient

    def _next(self, batch_df: DataFrame, batch_id: int) -> dict:
        base = batch_df.select(_arr(batch_df, self.features).alias("x"), F.col(self.label).cast("double").alias("y"))
        n = base.count()
        w, t = self.w, self.t
        blocks = _blocks(base).persist(StorageLevel.DISK_ONLY)
        try:
            gradient = self._gradients(blocks) if n and self.iters else None
            for _ in range(self.iters if n else 0):
                t += 1
                w = w - self.step / math.sqrt(t) * gradient(w) / n
        finally:
            blocks.unpersist()
        return {"w": w, "t": t}

    def _state(self, new: dict) -> dict:
        return {"weights": new["w"].tolist(), "t": new["t"]}

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self._link(self._dot(_arr(df, self.features))))

    @classmethod
    def resume(cls, spark, state_path: str, dims: int, **kw):
        m = cls(dims, state_path=state_path, **kw)
        st = load_state(spark, state_path)
        if st is not None:
            m.w = np.asarray(st["weights"], dtype=float)
            m.t, m.last = st["t"], st["batch"]
        return m

    def _link(self, dot):
        return dot


class StreamingLinearRegression(_StreamingSGD):
    """Least squares: the gradient X'(Xw - y) = (X'X)w - X'y needs the moments
    of the batch only, one pass however many steps follow."""

    def _gradients(self, blocks: DataFrame):
        s = _total(blocks, lambda xy: xy[:, :-1].T @ xy)
        dims = len(self.w)
        m = np.zeros((dims, dims + 1)) if s is None else s.reshape(dims, dims + 1)
        return lambda w: m[:, :-1] @ w - m[:, -1]


class StreamingLogisticRegression(_StreamingSGD):
    """Labels 0/1; predicts 1 when the probability exceeds 0.5."""

    @staticmethod
    def _residual(dot, y):
        with np.errstate(over="ignore"):
            return 1.0 / (1.0 + np.exp(-dot)) - y

    def _link(self, dot):
        return F.when(1.0 / (1.0 + F.exp(-dot)) > 0.5, 1.0).otherwise(0.0)


# ---------------------------------------------------------------- significance test
def _betacf(a, b, x):
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny, qab, qap, qam = 1e-300, a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 300):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-14:
            break
    return h


def _betainc(a, b, x):
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def t_two_sided_p(t: float, dof: float) -> float:
    """Two-sided p-value of Student's t with (fractional) ``dof``."""
    if not math.isfinite(t) or dof <= 0:
        return float("nan")
    return _betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def welch(n1, m1, v1, n2, m2, v2):
    """Welch's t statistic, degrees of freedom and two-sided p-value from
    counts, means and sample variances."""
    se1, se2 = v1 / n1, v2 / n2
    t = (m1 - m2) / math.sqrt(se1 + se2)
    dof = (se1 + se2) ** 2 / (se1 ** 2 / (n1 - 1) + se2 ** 2 / (n2 - 1))
    return t, dof, t_two_sided_p(t, dof)


class StreamingABTest(_Once):
    """Two groups (label true/false) of values; per batch one aggregate of
    (n, mean, M2) per group, merged into the running state (Chan et al.).
    ``window`` > 0 keeps only the last ``window`` batches; the first
    ``peace`` batches are ignored.  Each batch appends one result row."""

    def __init__(self, group: str = "label", value: str = "value", window: int = 0, peace: int = 0,
                 alpha: float = 0.05, out_path: str | None = None, state_path: str | None = None):
        self.group, self.value, self.window, self.peace = group, value, window, peace
        self.alpha = alpha
        self.out_path = out_path
        self.state_path = state_path
        # the last ``window`` batches; without a window one merged entry
        self.batches: list[dict] = []
        self.seen = 0
        self.results: list[tuple] = []
        self.stopped = False

    def should_stop(self, max_batches: int | None = None) -> bool:
        """True once the difference is significant or ``max_batches`` have
        been seen (the caller stops the query)."""
        return self.stopped or (max_batches is not None and self.seen >= max_batches)

    @staticmethod
    def _merge(a, b):
        n = a[0] + b[0]
        if n == 0:
            return (0, 0.0, 0.0)
        d = b[1] - a[1]
        mean = a[1] + d * b[0] / n
        m2 = a[2] + b[2] + d * d * a[0] * b[0] / n
        return (n, mean, m2)

    def _add(self, stats: dict) -> tuple[list[dict], dict]:
        """The batches kept with the new one's statistics, and their totals."""
        if self.window:
            batches = [*self.batches, stats][-self.window:]
        else:                                # bounded state: one merged entry
            old = self.batches[0] if self.batches else {}
            batches = [{g: self._merge(old.get(g, (0, 0.0, 0.0)), stats.get(g, (0, 0.0, 0.0)))
                        for g in (True, False)}]
        total = {True: (0, 0.0, 0.0), False: (0, 0.0, 0.0)}
        for b in batches:
            for g in b:
                total[g] = self._merge(total[g], b[g])
        return batches, total

    @classmethod
    def resume(cls, spark, state_path: str, **kw) -> "StreamingABTest":
        t, st = cls(state_path=state_path, **kw), load_state(spark, state_path)
        if st is not None:
            t.last, t.seen = st["batch"], st["seen"]
            t.batches = [{k == "true": tuple(v) for k, v in b.items()} for b in st["batches"]]
        return t

    def _next(self, batch_df: DataFrame, batch_id: int) -> dict:
        seen = self.seen + 1
        if seen <= self.peace:
            return {"seen": seen, "batches": self.batches}
        rows = batch_df.groupBy(F.col(self.group).cast("boolean").alias("g")).agg(
            F.count(self.value).alias("n"), F.avg(self.value).alias("m"),
            (F.coalesce(F.var_pop(self.value), F.lit(0.0)) * F.count(self.value)).alias("m2")).collect()
        stats = {bool(r["g"]): (r["n"], r["m"] or 0.0, r["m2"] or 0.0) for r in rows}
        batches, tot = self._add(stats)
        (n1, m1, s1), (n2, m2, s2) = tot[True], tot[False]
        if n1 > 1 and n2 > 1:
            t, dof, p = welch(n1, m1, s1 / (n1 - 1), n2, m2, s2 / (n2 - 1))
            row = (batch_id, t, dof, p, p < self.alpha)
        else:
            row = (batch_id, float("nan"), float("nan"), float("nan"), False)
        if self.out_path:                    # a folder per batch: a retry writes the same one again
            batch_df.sparkSession.createDataFrame(
                [row], "batch long, statistic double, dof double, p_value double, significant boolean") \
                .write.mode("overwrite").parquet(os.path.join(self.out_path, f"batch={batch_id}"))
        return {"seen": seen, "batches": batches, "results": [*self.results, row], "stopped": bool(row[4])}

    def _state(self, new: dict) -> dict:
        return {"seen": new["seen"], "batches": [{str(g).lower(): v for g, v in b.items()} for b in new["batches"]]}
