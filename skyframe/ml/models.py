"""Models: pyspark.ml estimators with the reference's settings, plus the
hand-written iterative forms (batch-gradient logistic regression, Lloyd's
k-means) as one aggregate per step, and custom Transformer / Estimator
classes.

Drivers hold only models: weights, centres, trees.  Every pass over the
data is a distributed aggregate.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml import classification as C
from pyspark.ml import clustering as K
from pyspark.ml import regression as R
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasInputCol, HasLabelCol, HasOutputCol, HasPredictionCol, Param, Params, TypeConverters
from pyspark.ml.recommendation import ALS
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# ---------------------------------------------------------------- classification
def logreg(df: DataFrame, features="features", label="label", **p):
    """Binary or multinomial logistic regression (elastic net via
    ``regParam`` / ``elasticNetParam``)."""
    return C.LogisticRegression(featuresCol=features, labelCol=label, **p).fit(df)


def logreg_summary(model) -> dict:
    """Objective history, area under ROC and the threshold that maximises F1."""
    s = model.summary
    best = (s.fMeasureByThreshold.orderBy(F.desc("F-Measure"), "threshold").first())
    return {"objective_history": list(s.objectiveHistory), "auc": s.areaUnderROC,
            "best_threshold": best["threshold"], "best_f": best["F-Measure"]}


def logreg_lbfgs(df: DataFrame, features="features", label="label", reg: float = 0.1):
    """L-BFGS logistic regression with intercept and L2 penalty, tol 1e-4."""
    return C.LogisticRegression(featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=0.0,
                                tol=1e-4, fitIntercept=True).fit(df)


def logreg_gd(df: DataFrame, features: str, label: str, dims: int, iters: int = 5,
              step: float = 1.0, seed: int = 42) -> np.ndarray:
    """Batch gradient descent for labels in {-1, +1}:
    w -= sum_i x_i (1 / (1 + exp(-y_i w.x_i)) - 1) y_i.
    Each step is one vector-sum aggregate; the weights (``dims`` numbers)
    are the only state on the driver."""
    rng = np.random.default_rng(seed)
    w = 2 * rng.random(dims) - 1
    x = vector_to_array(F.col(features)) if dict(df.dtypes)[features] != "array<double>" else F.col(features)
    base = df.select(x.alias("x"), F.col(label).cast("double").alias("y"))
    for _ in range(iters):
        wl = F.array(*[F.lit(float(v)) for v in w])
        dot = F.aggregate(F.zip_with("x", wl, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
        coef = (1.0 / (1.0 + F.exp(-F.col("y") * dot)) - 1.0) * F.col("y")
        g = base.select(array_to_vector(F.transform("x", lambda a: a * coef)).alias("g"))
        grad = g.agg(Summarizer.sum(F.col("g")).alias("s")).first()["s"].toArray()
        w = w - step * grad
    return w


def linear_svc(df: DataFrame, features="features", label="label", **p):
    return C.LinearSVC(featuresCol=features, labelCol=label, **p).fit(df)


def naive_bayes(df: DataFrame, features="features", label="label", smoothing: float = 1.0,
                model_type: str = "multinomial"):
    return C.NaiveBayes(featuresCol=features, labelCol=label, smoothing=smoothing, modelType=model_type).fit(df)


def tree(df: DataFrame, task: str = "classification", features="features", label="label", **p):
    est = C.DecisionTreeClassifier if task == "classification" else R.DecisionTreeRegressor
    return est(featuresCol=features, labelCol=label, **p).fit(df)


def forest(df: DataFrame, task: str = "classification", features="features", label="label", **p):
    est = C.RandomForestClassifier if task == "classification" else R.RandomForestRegressor
    return est(featuresCol=features, labelCol=label, **p).fit(df)


def gbt(df: DataFrame, task: str = "classification", features="features", label="label", **p):
    est = C.GBTClassifier if task == "classification" else R.GBTRegressor
    return est(featuresCol=features, labelCol=label, **p).fit(df)


def mlp(df: DataFrame, layers: list[int], features="features", label="label", block: int = 128,
        seed: int = 1234, iters: int = 100):
    return C.MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=layers,
                                            blockSize=block, seed=seed, maxIter=iters).fit(df)


def one_vs_rest(df: DataFrame, base=None, features="features", label="label"):
    # fixed values: the settings whose results are to match
    base = base or C.LogisticRegression(maxIter=10, tol=1e-6, fitIntercept=True)
    return C.OneVsRest(classifier=base, featuresCol=features, labelCol=label).fit(df)


# ---------------------------------------------------------------- regression
def linreg(df: DataFrame, features="features", label="label", **p):
    """Linear regression (elastic net); ``model.summary`` has residuals,
    RMSE and r2."""
    return R.LinearRegression(featuresCol=features, labelCol=label, **p).fit(df)


def glr(df: DataFrame, family: str = "gaussian", link: str | None = None, features="features", label="label",
        **p):
    est = R.GeneralizedLinearRegression(featuresCol=features, labelCol=label, family=family, **p)
    if link:
        est.setLink(link)
    return est.fit(df)


def isotonic(df: DataFrame, increasing: bool = True, features="features", label="label"):
    return R.IsotonicRegression(featuresCol=features, labelCol=label, isotonic=increasing).fit(df)


def aft(df: DataFrame, quantiles=(0.3, 0.6), features="features", label="label", censor="censor"):
    return R.AFTSurvivalRegression(featuresCol=features, labelCol=label, censorCol=censor,
                                   quantileProbabilities=list(quantiles), quantilesCol="quantiles").fit(df)


# ---------------------------------------------------------------- clustering
def kmeans(df: DataFrame, k: int, init: str = "k-means||", seed: int = 1, features="features", iters: int = 20):
    """K-means; the training cost (WSSSE) is ``model.summary.trainingCost``."""
    return K.KMeans(k=k, initMode=init, seed=seed, featuresCol=features, maxIter=iters).fit(df)


def lloyd(df: DataFrame, features: str, k: int, eps: float = 1e-4, seed: int = 42,
          max_iter: int | None = None) -> np.ndarray:
    """Lloyd's k-means by hand: k seeded sample rows as starting centres,
    then per round one aggregate (mean of the points closest to each
    centre) until the total movement is at most ``eps``; an error if
    ``max_iter`` rounds are not enough.  A centre that
    loses all its points keeps its old position."""
    from skyframe.operators.graph import rounds
    from skyframe.operators.sampling import take_sample
    x = vector_to_array(F.col(features)) if dict(df.dtypes)[features] != "array<double>" else F.col(features)
    pts = df.select(x.alias("x"))
    init = take_sample(pts.withColumn("_rid", F.monotonically_increasing_id()), k, seed, key=["x"]).collect()
    centres = np.array([r["x"] for r in init], dtype=float)
    for _ in rounds(max_iter):
        new = lloyd_step(pts, "x", centres)
        moved = float(np.sum((new - centres) ** 2))
        centres = new
        if moved <= eps:
            return centres


def closest(x_col: str, centres: np.ndarray) -> F.Column:
    """Index of the nearest centre (squared Euclidean), as an expression."""
    dists = [F.aggregate(F.zip_with(F.col(x_col), F.array(*[F.lit(float(v)) for v in c]),
                                    lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v)
             for c in centres]
    best = F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(dists)]))
    return best["i"]


def lloyd_step(pts: DataFrame, x_col: str, centres: np.ndarray) -> np.ndarray:
    """One assignment + mean step; returns the new centres."""
    assigned = pts.select(closest(x_col, centres).alias("c"), array_to_vector(F.col(x_col)).alias("v"))
    means = assigned.groupBy("c").agg(Summarizer.mean(F.col("v")).alias("m")).collect()   # k rows
    new = centres.copy()
    for r in means:
        new[r["c"]] = r["m"].toArray()
    return new


def bisecting(df: DataFrame, k: int, seed: int = 1, features="features"):
    return K.BisectingKMeans(k=k, seed=seed, featuresCol=features).fit(df)


def gmm(df: DataFrame, k: int, seed: int = 538009335, features="features"):
    """Gaussian mixture; has ``weights``, ``means``, ``covs`` and ``transform``."""
    from skyframe.ml import mixture
    return mixture.fit(df, k, seed, features)


def gmm_membership(model, df: DataFrame) -> DataFrame:
    """Soft membership: probability per component (rows sum to 1)."""
    return model.transform(df)


def lda(df: DataFrame, k: int = 10, optimizer: str = "online", iters: int = 10, features="features", seed=1):
    return K.LDA(k=k, maxIter=iters, optimizer=optimizer, featuresCol=features, seed=seed).fit(df)


def lda_pipeline(docs: DataFrame, text: str, k: int = 5, vocab: int = 10_000, extra_stopwords=None,
                 iters: int = 10):
    """Regex tokenise, drop stop words, count vectors, then LDA."""
    from pyspark.ml.feature import CountVectorizer, RegexTokenizer, StopWordsRemover
    stop = StopWordsRemover.loadDefaultStopWords("english") + list(extra_stopwords or [])
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"\W", minTokenLength=4),
        StopWordsRemover(inputCol="_tok", outputCol="_words", stopWords=stop),
        CountVectorizer(inputCol="_words", outputCol="features", vocabSize=vocab),
        K.LDA(k=k, maxIter=iters, optimizer="online", seed=1)])
    return pipe.fit(docs)


# ---------------------------------------------------------------- recommendation
def als(df: DataFrame, user="user", item="item", rating="rating", rank: int = 10, reg: float = 0.01,
        iters: int = 10, implicit: bool = False, seed: int = 42):
    """ALS with cold-start rows dropped from predictions."""
    return ALS(userCol=user, itemCol=item, ratingCol=rating, rank=rank, regParam=reg, maxIter=iters,
               implicitPrefs=implicit, coldStartStrategy="drop", seed=seed).fit(df)


def als_scores(model, pairs: DataFrame, user="user", item="item") -> DataFrame:
    """``pairs`` with the model's predictions, cold-start rows dropped, as its ``transform`` gives them;
    but users are joined last, so that the rows lie by user and a ranking per user moves nothing."""
    items = model.itemFactors.select(F.col("id").cast("long").alias("_i"), F.col("features").alias("_v"))
    users = model.userFactors.select(F.col("id").cast("long").alias("_u"), F.col("features").alias("_w"))
    zero = F.lit(0.0).cast("float")
    dot = F.aggregate(F.zip_with("_w", "_v", lambda a, b: a * b), zero, lambda s, x: s + x)
    j = pairs.join(items, F.col(item).cast("long") == F.col("_i")).join(users, F.col(user).cast("long") == F.col("_u"))
    return j.select(*pairs.columns, dot.alias("prediction")).filter(~F.isnan("prediction"))


def als_factors(model) -> tuple[DataFrame, DataFrame]:
    """User and item factor tables as text lines ``id,[v1,v2,...]``."""
    fmt = lambda t: t.select(F.concat(F.col("id").cast("string"), F.lit(",["),
                                      F.array_join(F.transform("features", lambda v: v.cast("string")), ","),
                                      F.lit("]")).alias("value"))
    return fmt(model.userFactors), fmt(model.itemFactors)


# ---------------------------------------------------------------- pipelines and tuning
def pipeline(stages) -> Pipeline:
    return Pipeline(stages=stages)


def fit_with(est, df: DataFrame, params: dict):
    """Fit with a parameter map overriding the estimator's own values."""
    return est.fit(df, params)


def cross_validate(est, grid, evaluator, df: DataFrame, folds: int = 2, seed: int = 42, parallelism: int = 2):
    return CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
                          seed=seed, parallelism=parallelism).fit(df)


def train_validate(est, grid, evaluator, df: DataFrame, ratio: float = 0.8, seed: int = 42):
    return TrainValidationSplit(estimator=est, estimatorParamMaps=grid, evaluator=evaluator,
                                trainRatio=ratio, seed=seed).fit(df)


def roundtrip(model, path: str):
    """Save and load a fitted model (or pipeline)."""
    model.write().overwrite().save(path)
    return type(model).load(path)


# ---------------------------------------------------------------- custom stages
class ShiftTransformer(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """output = input + shift, for a numeric input column (native
    expression); persists with its parameters."""

    shift = Param(Params._dummy(), "shift", "value added to the input", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, shift=0.0):
        super().__init__()
        self._setDefault(shift=0.0)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        t = dict(df.dtypes)[self.getInputCol()]
        if t not in ("double", "float", "int", "bigint", "smallint", "tinyint"):
            raise TypeError(f"input column must be numeric, got {t}")
        return df.withColumn(self.getOutputCol(), F.col(self.getInputCol()) + F.lit(self.getOrDefault("shift")))


class MyClassifierModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Linear model holding coefficients; raw prediction (-m, m) with
    margin m = coefficients . x; predicts the index of the larger score."""

    coefficients = Param(Params._dummy(), "coefficients", "weights", typeConverter=TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        w = F.array(*[F.lit(float(v)) for v in self.getOrDefault("coefficients")])
        x = vector_to_array(F.col(self.getFeaturesCol()))
        m = F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
        raw = F.array(-m, m)
        return (df.withColumn("rawPrediction", array_to_vector(raw))
                  .withColumn(self.getPredictionCol(), F.when(m > 0, 1.0).otherwise(0.0)))


class MyClassifier(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable,
                   DefaultParamsWritable):
    """Toy estimator: learns all-zero coefficients (so every prediction is
    class 0); the number of features comes from one aggregate."""

    def __init__(self):
        super().__init__()

    def _fit(self, df: DataFrame) -> MyClassifierModel:
        n = df.select(F.size(vector_to_array(F.col(self.getFeaturesCol()))).alias("n")).agg(F.max("n")).first()[0]
        m = MyClassifierModel()
        m._set(coefficients=[0.0] * int(n or 0))
        m.set(m.featuresCol, self.getFeaturesCol())
        m.set(m.predictionCol, self.getPredictionCol())
        return m


def evaluators():
    return {"auc": BinaryClassificationEvaluator(), "rmse": RegressionEvaluator()}


def grid(est, **values):
    b = ParamGridBuilder()
    for name, vs in values.items():
        b = b.addGrid(est.getParam(name), vs)
    return b.build()


# ---------------------------------------------------------------- ALS by hand
def _init_factor(key, rank: int, seed: int):
    return F.transform(F.sequence(F.lit(1), F.lit(rank)),
                       lambda i: F.pmod(F.xxhash64(F.lit(seed), key, i), F.lit(10_000)).cast("double") / 10_000.0)


def _init_factors(ids: DataFrame, id_col: str, rank: int, seed: int) -> DataFrame:
    """Deterministic pseudo-random start vectors in [0, 1) from the id."""
    return ids.select(F.col(id_col).alias("id"), _init_factor(F.col(id_col), rank, seed).alias("f"))


def _systems(ratings: DataFrame, key: str, other: str, fixed: DataFrame, rank: int, total: int,
             alpha: float | None) -> DataFrame:
    """(id, ata, atb, n): each key's own part of its normal equations."""
    from skyframe.plans.joins import keyed_join
    j = keyed_join(ratings, fixed.withColumnRenamed("id", other), other, total)
    r, f = F.col("rating"), F.col("f")
    weight = F.lit(1.0) if alpha is None else alpha * F.abs(r)
    goal = r if alpha is None else F.when(r > 0, 1.0 + alpha * F.abs(r)).otherwise(0.0)
    # plain sums: they are added up in every task first, which vectors are not
    square = {(a, b): F.sum(f[a] * f[b] * weight) for a in range(rank) for b in range(a, rank)}
    g = j.groupBy(key).agg(*[c.alias(f"s{a}_{b}") for (a, b), c in square.items()],
                           *[F.sum(f[a] * goal).alias(f"b{a}") for a in range(rank)], F.count(F.lit(1)).alias("n"))
    return g.select(F.col(key).alias("id"),
                    F.array(*[f"s{min(a, b)}_{max(a, b)}" for a in range(rank) for b in range(rank)]).alias("ata"),
                    F.array(*[f"b{a}" for a in range(rank)]).alias("atb"), "n")


def _gram(factors: DataFrame, rank: int) -> np.ndarray:
    """V^T V of a factor table: rank^2 numbers from one aggregate."""
    outer = F.flatten(F.transform("f", lambda a: F.transform("f", lambda b: a * b)))
    s = factors.select(array_to_vector(outer).alias("o")).agg(Summarizer.sum(F.col("o")).alias("s")).first()["s"]
    return np.zeros((rank, rank)) if s is None else s.toArray().reshape(rank, rank)


def _solve_block(rank: int, lam: float, alpha: float | None, shared: np.ndarray, hot: int):
    """For every key of a block solve (sum v v^T + lam * n * I) x = sum r v over its ratings.

    With ``alpha`` (implicit preferences) every pair counts: an unrated one
    with preference 0 and confidence 1, a rated one with preference 1 where the
    rating is positive and confidence 1 + alpha |r|.  All pairs' share is one matrix
    V^T V for everyone (``shared``), to which each key adds alpha |r| v v^T of its own ratings;
    so the work follows the ratings, not the pairs.  Hot keys, the last ``hot``, only get their sums."""
    def run(block, n, k, o, r, f):
        w = np.ones(len(r)) if alpha is None else alpha * np.abs(r)
        goal = r if alpha is None else np.where(r > 0, 1.0 + w, 0.0)
        cols = [f[:, c][o] for c in range(rank)]
        ata, atb = np.empty((n, rank, rank)), np.empty((n, rank))
        for a in range(rank):
            atb[:, a] = np.bincount(k, cols[a] * goal, n)
            for b in range(a, rank):
                ata[:, a, b] = ata[:, b, a] = np.bincount(k, cols[a] * cols[b] * w, n)
        count = np.bincount(k, minlength=n).astype(float)
        own = np.bincount(k, r * r if alpha is None else goal, n)      # the error of predicting 0
        sums = np.concatenate([ata.reshape(n, -1), atb, count[:, None], own[:, None]], 1)
        x, *rest = _solved(sums[:n - hot], rank, lam, shared)
        return pd.DataFrame({"block": [block], "f": [x.ravel()], "hot": [sums[n - hot:].ravel()], "parts": [np.concatenate(rest)]})
    return run


def _solved(sums: np.ndarray, rank: int, lam: float, shared: np.ndarray) -> tuple:
    """(factors, [squared error, penalty], V^T V) of keys with their sums."""
    n, q = len(sums), rank * rank
    ata, atb, count, own = sums[:, :q].reshape(n, rank, rank), sums[:, q:q + rank], sums[:, q + rank], sums[:, q + rank + 1]
    x = np.linalg.solve(ata + shared + lam * count[:, None, None] * np.eye(rank), atb[:, :, None])[:, :, 0] if n else np.zeros((0, rank))
    error = own.sum() - 2 * (x * atb).sum() + np.einsum("ni,nij,nj->", x, ata, x)
    return x, np.array([error, (count[:, None] * x * x).sum()]), (x.T @ x).ravel()


def _half_step(to, source, state: DataFrame, hot: np.ndarray, rank: int, lam: float, alpha: float | None,
               shared: np.ndarray, path: str) -> tuple:
    """One side solved for the other: (state, hot factors, squared error, penalty, V^T V)."""
    from skyframe.plans import blocks
    spark, width = state.sparkSession, rank * rank + rank + 2
    solve = _solve_block(rank, lam, alpha, shared, len(to.hot))
    blocks.step(to, source, state, hot, rank, solve,
                "block int, f array<double>, hot array<double>, parts array<double>").write.parquet(path)
    out = spark.read.parquet(path)
    parts = np.array(out.agg(*[F.sum(F.col("parts")[i]) for i in range(rank * rank + 2)]).first(), float)
    sums = np.zeros(len(to.hot) * width)
    if to.hot:
        for pos, total in out.select(F.posexplode("hot").alias("pos", "v")).groupBy("pos").agg(F.sum("v")).collect():
            sums[pos] = total                                          # the few hot keys' sums
    x, *rest = _solved(sums.reshape(-1, width), rank, lam, shared)
    parts = parts + np.concatenate(rest)
    return out.select("block", "f"), x, parts[0], parts[1], parts[2:].reshape(rank, rank)


def _factor_table(side, state: DataFrame, hot: np.ndarray, rank: int) -> DataFrame:
    """(id, f) of a side's keys."""
    each = side.blocks.select("block", "ids").join(state, "block").select(F.posexplode("ids").alias("pos", "id"), "f")
    table = each.select("id", F.slice("f", F.col("pos") * rank + 1, F.lit(rank)).alias("f"))
    if not side.hot:
        return table
    rows = [(k, [float(v) for v in f]) for k, f in zip(side.hot, hot)]
    return table.unionByName(state.sparkSession.createDataFrame(rows, f"id {side.kind}, f array<double>"))


def als_by_hand(ratings: DataFrame, user: str = "user", item: str = "item", rating: str = "rating",
                rank: int = 5, iters: int = 5, lam: float = 0.01, seed: int = 42, alpha: float | None = None,
                rows_per_block: int | None = None):
    """Alternating least squares written as DataFrame steps (lam * n on the
    diagonal).  Returns (user factors, item factors, history): explicit
    ratings by default, with the RMSE after each iteration; with ``alpha``
    implicit preferences, with the objective over all user-item pairs after each iteration.
    Ratings are packed once by user and once by item; a half-step sends factors to the blocks
    that name them, and its systems also give the error.  Ratings of no user or item are left out.
    Only the history and one matrix a half-step reach the driver."""
    import uuid

    from skyframe.plans import blocks
    from skyframe.session import checkpoint_dir
    spark = ratings.sparkSession
    base = f"{checkpoint_dir(spark)}/als-{uuid.uuid4().hex}"
    r = ratings.select(F.col(user).alias("u"), F.col(item).alias("i"), F.col(rating).cast("double").alias("rating"))
    r = r.filter(F.col("u").isNotNull() | F.col("i").isNotNull()).checkpoint(eager=True)
    if not r.filter(F.col("rating").isNull()).isEmpty():
        raise ValueError("a rating is null")
    r = r.dropna(subset=["u", "i"])
    total = r.count()
    if not total:
        raise ValueError("no ratings")
    users, items = blocks.pack(r, "u", "i", "rating", total, rows_per_block)
    listed = spark.createDataFrame([(k,) for k in items.hot], f"id {items.kind}")
    named = {x["id"]: x["f"] for x in _init_factors(listed, "id", rank, seed).collect()} if items.hot else {}
    hot_v = np.array([named[k] for k in items.hot], float).reshape(-1, rank)
    v = items.blocks.select("block", F.flatten(F.transform("ids", lambda x: _init_factor(x, rank, seed))).alias("f"))
    gram_v = _gram(_factor_table(items, v, hot_v, rank), rank) if alpha is not None else np.zeros((rank, rank))
    none, history = np.zeros((rank, rank)), []
    for i in range(iters):
        u, hot_u, _, pen_u, gram_u = _half_step(users, items, v, hot_v, rank, lam, alpha,
                                                none if alpha is None else gram_v, f"{base}/u{i}")
        v, hot_v, error, pen_v, gram_v = _half_step(items, users, u, hot_u, rank, lam, alpha,
                                                    none if alpha is None else gram_u, f"{base}/v{i}")
        # all pairs' squared predictions add up to the product of the two Gram matrices
        history.append(float(np.sqrt(max(error, 0.0) / total)) if alpha is None else
                       float(np.sum(gram_u * gram_v) + error + lam * (pen_u + pen_v)))
    return _factor_table(users, u, hot_u, rank), _factor_table(items, v, hot_v, rank), history


def als_residual(ratings: DataFrame, key: str, other: str, solved: DataFrame, fixed: DataFrame, lam: float,
                 alpha: float | None = None) -> DataFrame:
    """(id, residual): how far each solved factor is from its normal
    equations, as the largest component of |A x - b|.  ``ratings``: (u, i, rating)."""
    rank = solved.select(F.size("f")).first()[0]
    system = _systems(ratings, key, other, fixed, rank, ratings.count(), alpha)
    shared = _gram(fixed, rank) if alpha is not None else np.zeros((rank, rank))

    def residual(batches):
        for pdf in batches:
            a = np.stack(pdf["ata"].to_numpy()).reshape(-1, rank, rank) if len(pdf) else np.zeros((0, rank, rank))
            a = a + shared + lam * pdf["n"].to_numpy()[:, None, None] * np.eye(rank)
            f, b = (np.stack(pdf[c].to_numpy()) if len(pdf) else np.zeros((0, rank)) for c in ("f", "atb"))
            out = np.abs(np.einsum("nij,nj->ni", a, f) - b).max(1) if len(pdf) else np.zeros(0)
            yield pd.DataFrame({"id": pdf["id"], "residual": out})

    return (system.join(solved, "id").select("id", "ata", "atb", "n", "f")
                  .mapInPandas(residual, f"id {dict(system.dtypes)['id']}, residual double"))
