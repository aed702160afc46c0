"""Models and tests written as DataFrame steps against pyspark.ml, closed
forms and brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from skyframe.ml import bayes, glm, lda_em
from skyframe.session import checkpoint_dir
from skyframe.ml import models as md
from skyframe.operators import evaluation as ev
from skyframe.operators import graph as gr
from skyframe.operators import stats as sa
from skyframe.plans import joins
from skyframe.session import ship_package


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


# ---------------------------------------------------------------- components
def brute_components(edges, vertices):
    boss = {v: v for v in vertices}

    def find(x):
        while boss[x] != x:
            x = boss[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        boss[max(a, b)] = min(a, b)
    return {v: find(v) for v in vertices}


def graphs():
    rng = random.Random(1)
    return {"path": [(i, i + 1) for i in range(60)],
            "hub below": [(0, i) for i in range(1, 1500)] + [(5000, i) for i in range(1, 1500, 7)],
            "hub above": [(9999, i) for i in range(1, 1000)] + [(i, i + 2000) for i in range(1, 1000, 3)],
            "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(7, 7)],
            "none": []}


@pytest.mark.parametrize("name", list(graphs()))
@pytest.mark.parametrize("least,most", [(200_000, 10_000), (100, 20)])
def test_star_contraction(spark, monkeypatch, name, least, most):
    monkeypatch.setattr(joins.keyed_join, "__defaults__", ("inner", least, most))
    edges = graphs()[name]
    vertices = {x for e in edges for x in e} | {100_000}
    got = gr.connected_components(spark.createDataFrame(edges, "src long, dst long"),
                                  spark.createDataFrame([(v,) for v in vertices], "id long"))
    assert {r.id: r.label for r in got.collect()} == brute_components(edges, vertices)


def test_keyed_join_spreads_hot_keys(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, 1).when(F.col("id") < 1900, None).otherwise(F.col("id"))
                                    .cast("long").alias("k"), "id")
    keyed = spark.createDataFrame([(1, "a"), (2000, "b")], "k long, v string")
    for how in ("inner", "left"):
        want = Counter(tuple(r) for r in rows.join(keyed, "k", how).select("k", "id", "v").collect())
        got = joins.keyed_join(rows, keyed, "k", 3000, how, least=10, most=5)
        if how == "inner":
            assert Counter(tuple(r) for r in got.select("k", "id", "v").collect()) == want
        else:
            known = got.filter("k is not null")
            assert Counter(tuple(r) for r in known.select("k", "id", "v").collect()) == Counter(
                {k: n for k, n in want.items() if k[0] is not None})
        assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- threshold curve
def test_threshold_curve_over_many_scores(spark):
    rng = random.Random(3)
    rows = [(round(rng.random(), 3), float(rng.random() < 0.4)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "score double, label double").repartition(5)
    t = ev.threshold_table(df)
    assert "SinglePartition" not in t._jdf.queryExecution().executedPlan().toString()
    got = {r.threshold: (r.tp, r.fp) for r in t.collect()}
    want = {s: (sum(y > 0.5 for x, y in rows if x >= s), sum(y <= 0.5 for x, y in rows if x >= s)) for s, _ in rows}
    assert got == want
    pos, neg = [x for x, y in rows if y > 0.5], [x for x, y in rows if y <= 0.5]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert ev.auc_roc(t).first()[0] == pytest.approx(auc)
    assert ev.threshold_table(df.limit(0)).count() == 0
    assert ev.threshold_table(df, num_bins=10).count() <= 11


# ---------------------------------------------------------------- generalized linear models
@pytest.fixture(scope="module")
def responses(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 2))
    eta = 0.3 + x @ [0.5, -0.2]
    rows = [(float(a), float(b), float(e + rng.normal()), float(rng.random() < 1 / (1 + np.exp(-e))), float(rng.poisson(np.exp(e))),
             float(rng.gamma(3, np.exp(e) / 3) + 1e-3), float(rng.integers(1, 4))) for (a, b), e in zip(x, eta)]
    return spark.createDataFrame(rows, "a double, b double, gaussian double, binomial double, poisson double, gamma double, w double").cache()


@pytest.mark.parametrize("family,link,weight", [("gaussian", "identity", None), ("binomial", "logit", None), ("poisson", "log", None),
                                                ("gamma", "log", None), ("gaussian", "identity", "w"), ("poisson", "log", "w")])
def test_glm_matches_ml(responses, family, link, weight):
    m = glm.fit(responses, ["a", "b"], family, family, link, weight=weight)
    est = GeneralizedLinearRegression(featuresCol="f", labelCol=family, family=family, link=link, maxIter=50, tol=1e-10)
    if weight:
        est.setWeightCol(weight)
    other = est.fit(VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(responses))
    s = other.summary
    assert m.coefficients == pytest.approx(np.r_[other.intercept, other.coefficients.toArray()], abs=1e-6)
    assert m.std_errors == pytest.approx(np.roll(s.coefficientStandardErrors, 1), abs=1e-8)
    assert m.p_values == pytest.approx(np.roll(s.pValues, 1), abs=1e-10)
    assert (m.deviance, m.null_deviance, m.dispersion, m.aic) == pytest.approx((s.deviance, s.nullDeviance, s.dispersion, s.aic))
    got = {r.a: r.prediction for r in m.predict(responses, ["a", "b"]).collect()}
    want = {r.a: r.prediction for r in other.transform(VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(responses)).collect()}
    assert got == pytest.approx(want, rel=1e-5)
    assert m.table(responses.sparkSession).count() == 3


def test_glm_leaves_out_nulls_and_reports_a_bound(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 6.2), (None, 1.0), (4.0, None)], "x double, y double")
    m = glm.fit(df, ["x"], "y")
    assert m.rows == 3 and m.coefficients[1] == pytest.approx(2.1)
    with pytest.raises(ValueError):
        glm.fit(df.limit(0), ["x"], "y")
    with pytest.raises(RuntimeError):
        glm.fit(df, ["x"], "y", "poisson", max_iter=1)


# ---------------------------------------------------------------- naive Bayes
@pytest.mark.parametrize("kind", ["multinomial", "bernoulli"])
def test_bayes_matches_ml(spark, kind):
    rng = random.Random(2)
    docs = [(i, rng.choice("abc"), [rng.randrange(4) for _ in range(6)] + [1]) for i in range(50)]
    terms = spark.createDataFrame([(i, c, f"t{j}", n) for i, c, v in docs for j, n in enumerate(v) if n],
                                  "doc_id long, label string, term string, n long")
    model = bayes.fit(terms, kind=kind)
    got = {r.doc_id: (r.prediction, r.score) for r in model.scores(terms).collect()}
    dense = [(i, float("abc".index(c)), Vectors.dense([float(x if kind == "multinomial" else x > 0) for x in v])) for i, c, v in docs]
    frame = spark.createDataFrame(dense, ["doc_id", "label", "features"])
    for r in NaiveBayes(modelType=kind).fit(frame).transform(frame).collect():
        assert got[r.doc_id][1] == pytest.approx(max(r.rawPrediction))
        assert got[r.doc_id][0] == "abc"[int(r.prediction)]
    unseen = spark.createDataFrame([(900, "?", "never", 3)], "doc_id long, label string, term string, n long")
    assert model.scores(unseen).first()["score"] == pytest.approx(max(model.prior))
    with pytest.raises(ValueError):
        bayes.fit(terms.limit(0))


# ---------------------------------------------------------------- implicit preferences
def test_implicit_als(spark):
    rng = np.random.default_rng(1)
    ratings = {(u, i): float(rng.integers(-1, 5)) for u in range(15) for i in range(20) if rng.random() < 0.3}
    df = spark.createDataFrame([(u, i, r) for (u, i), r in ratings.items()], "user long, item long, rating double")
    alpha, lam = 2.0, 0.05
    u, v, history = md.als_by_hand(df, rank=3, iters=3, lam=lam, alpha=alpha)
    fu, fv = ({r.id: np.array(r.f) for r in t.collect()} for t in (u, v))
    n = Counter(k for pair in ratings for k in (("u", pair[0]), ("i", pair[1])))
    total = sum((1 + alpha * abs(ratings.get((a, b), 0))) * (float(ratings.get((a, b), 0) > 0) - fu[a] @ fv[b]) ** 2
                for a in fu for b in fv)
    total += lam * (sum(n["u", a] * f @ f for a, f in fu.items()) + sum(n["i", b] * f @ f for b, f in fv.items()))
    assert history[-1] == pytest.approx(total) and history == sorted(history, reverse=True)
    named = df.select(F.col("user").alias("u"), F.col("item").alias("i"), "rating")
    worst = md.als_residual(named, "i", "u", v, u, lam, alpha).agg(F.max("residual")).first()[0]
    assert worst < 1e-9


# ---------------------------------------------------------------- topics
def test_lda_em_rises_and_separates_topics(spark):
    rng = random.Random(4)
    edges = [(d, f"t{(d % 2) * 10 + rng.randrange(10)}", rng.randint(1, 3)) for d in range(40) for _ in range(8)]
    df = spark.createDataFrame(edges, "doc_id long, term string, n long")
    m = lda_em.fit(df, 2, max_rounds=6)
    assert len(m.log_posterior) == 6 and m.log_posterior == sorted(m.log_posterior)
    assert m.perplexity == sorted(m.perplexity, reverse=True)
    assert sum(m.mass) == pytest.approx(sum(n for _, _, n in edges))
    weights = m.term_weights().groupBy("topic").agg(F.sum("weight")).collect()
    assert [r[1] for r in weights] == pytest.approx([1.0, 1.0])
    shares = np.array([r["topics"] for r in m.doc_topics().orderBy("doc").collect()])
    assert shares.sum(1) == pytest.approx(np.ones(40))


def test_lda_em_by_chunks_equals_the_plain_rounds(spark, monkeypatch):
    """Counts do not depend on the chunks, edges that repeat add up, and of the
    rounds' files the last two stay."""
    import glob
    rng = random.Random(8)
    edges = [(f"d{rng.randrange(30)}", f"t{rng.randrange(15)}", rng.randint(1, 3)) for _ in range(300)]
    df = spark.createDataFrame([*edges, (None, "t1", 2), ("d1", None, 2), ("d1", "t1", 0), ("d1", "t1", None)],
                               "doc_id string, term string, n long")
    models = []
    for size in (lda_em.EDGES_PER_CHUNK, 40):
        monkeypatch.setattr(lda_em, "EDGES_PER_CHUNK", size)
        before = set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/lda-*"))
        models.append(lda_em.fit(df, 3, max_rounds=5))
        made, = set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/lda-*")) - before
        assert len(glob.glob(f"{made}/round=*")) == 2
    one, many = models
    assert one.log_posterior == pytest.approx(many.log_posterior, rel=1e-12) and one.tokens == many.tokens == sum(e[2] for e in edges)
    for side, key, counts in (("docs", "doc", "nd"), ("terms", "term", "nw")):
        a, b = ({r[key]: r[counts] for r in getattr(m, side).collect()} for m in models)
        assert a.keys() == b.keys() == {e[0 if key == "doc" else 1] for e in edges}
        assert all(a[v] == pytest.approx(b[v], rel=1e-9) for v in a)
    total = sum(sum(r["nd"]) for r in one.docs.collect())
    assert total == pytest.approx(one.tokens)


def test_lda_em_leaves_no_shuffle_files_and_its_rounds_no_words(spark):
    import glob
    import time

    def shuffles():
        dirs = [d.getPath() for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
        return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    df = spark.range(4000).selectExpr("id % 100 doc_id", "'t' || (id * 7 % 333) term", "1 n").repartition(4)
    before, setting = shuffles(), spark.conf.get(name, "false")
    made = set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/lda-*"))
    m = lda_em.fit(df, 2, max_rounds=3)
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before and spark.conf.get(name, "false") == setting
    base, = set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/lda-*")) - made
    last = spark.read.parquet(f"{base}/round=2")
    assert not [t for _, t in last.dtypes if "string" in t] and m.terms.count() == m.vocabulary == 333
    assert sum(sum(r["nw"]) for r in m.terms.collect()) == pytest.approx(4000)


# ---------------------------------------------------------------- distributions and similarities
def test_ks_against_any_distribution(spark):
    rng = random.Random(6)
    values = [round(rng.expovariate(0.5), 2) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double").repartition(4)

    def brute(cdf):
        s, n = sorted(values), len(values)
        return max(max((i + 1) / n - cdf(v) for i, v in enumerate(s) if i + 1 == n or s[i + 1] != v),
                   max(cdf(v) - i / n for i, v in enumerate(s) if i == 0 or s[i - 1] != v))

    e = sa.ks_test(df, "x", lambda c: sa.exponential_cdf(c, 0.5)).first()
    assert e["n"] == 300 and e["statistic"] == pytest.approx(brute(lambda v: 1 - math.exp(-0.5 * v) if v > 0 else 0.0))
    n = sa.ks_test(df, "x", lambda c: sa.normal_cdf(c, 2, 1.5)).first()
    assert n["statistic"] == pytest.approx(brute(lambda v: 0.5 * math.erfc((2 - v) / 1.5 / math.sqrt(2))))
    same = sa.ks_normal(df.filter("x is not null and not isnan(x)"), "x", 2.0, 1.5).first()
    assert n["statistic"] == pytest.approx(same["statistic"]) and n["p_value"] == pytest.approx(same["pValue"], abs=0.01)
    assert e["p_value"] > n["p_value"]


def test_normal_cdf_is_accurate(spark):
    xs = [-20.0, -9.0, -7.2, -3.0, -1e-3, 0.0, 0.5, 2.0, 7.5, 50.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").coalesce(1).select(sa.normal_cdf(F.col("x"))).collect()]
    assert got == pytest.approx([0.5 * math.erfc(-x / math.sqrt(2)) for x in xs], rel=1e-7, abs=1e-15)


def test_sampled_cosines_do_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, [float(v) for v in rng.random(4)]) for i in range(3000)], "id long, x array<double>")
    assert min(sa.dimsum_rates(sa.column_norms(df, "x"), 0.05)) < 1
    e = sa.dimsum_error(df, "x", 0.05, key=["id"]).first()
    assert e["pairs"] == 6 and 0 < e["mean_absolute_error"] < 0.1
    one, other = ({(r.i, r.j): r.similarity for r in sa.column_cosine_approx(d, "x", 0.05, key=["id"]).collect()}
                  for d in (df.repartition(7, "x"), df.coalesce(1)))
    assert one == pytest.approx(other)
