"""Features, statistics, patterns, evaluation, UDFs and models on the small
inputs of the original examples (values derived by hand where noted).  Those
input tables are fixed values: the asserted results belong to them."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from skyframe.functions import features as fe
from skyframe.functions import udfs as uf
from skyframe.ml import models as md
from skyframe.operators import evaluation as ev
from skyframe.operators import patterns as pt
from skyframe.operators import stats as sa


def test_binarizer_bucketizer(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.8), (2, 0.2)], "id int, feature double")
    assert [r.b for r in fe.binarize(df, "feature", 0.5, "b").orderBy("id").collect()] == [0.0, 1.0, 0.0]
    d = spark.createDataFrame([(-999.9,), (-0.5,), (-0.3,), (0.0,), (0.2,), (999.9,)], "features double")
    b = fe.bucketize(d, "features", [float("-inf"), -0.5, 0.0, 0.5, float("inf")], "bucket")
    assert [r.bucket for r in b.collect()] == [0.0, 1.0, 1.0, 2.0, 2.0, 3.0]


def test_imputer_fills_means(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, nan), (2.0, nan), (nan, 3.0), (4.0, 4.0), (5.0, 5.0)], "a double, b double")
    out = fe.impute(df, ["a", "b"], suffix="_out").collect()
    assert out[2]["a_out"] == 3.0 and out[0]["b_out"] == 4.0


def test_string_indexer_frequency_then_name(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "a"), (4, "a"), (5, "c")], "id int, category string")
    got = {r.category: r.idx for r in fe.index_strings(df, "category", "idx").collect()}
    assert got == {"a": 0.0, "c": 1.0, "b": 2.0}
    model = fe.string_indexer(df, "category", "ci")
    back = fe.unindex(model.transform(df), "ci", "orig")
    assert all(r.category == r.orig for r in back.collect())
    oh = fe.one_hot(fe.index_strings(df, "category", "idx"), "idx", 3, "v")
    assert {tuple(r.v.toArray()) for r in oh.collect()} == {(1.0, 0.0), (0.0, 1.0), (0.0, 0.0)}


def test_text_features(spark):
    df = spark.createDataFrame([(0, "Hi I heard about Spark"), (1, "I wish Java could use case classes"),
                                (2, "Logistic,regression,models,are,neat")], "id int, sentence string")
    t = fe.tokenize(df, "sentence")
    assert t.first().tokens == ["hi", "i", "heard", "about", "spark"]
    rt = fe.regex_tokenize(df, "sentence").orderBy("id").collect()
    assert rt[2].tokens == ["logistic", "regression", "models", "are", "neat"]
    sw = fe.remove_stopwords(t, "tokens").first().filtered
    assert "i" not in sw and "spark" in sw
    ng = fe.ngrams(t, "tokens", 2).first().ngrams
    assert ng[0] == "hi i"
    tf = fe.hashing_tf(t, "tokens", 20)
    assert fe.idf(tf, "tf").first().tfidf.size == 20
    terms = {r.term: r.idf for r in fe.idf_terms(rt and fe.regex_tokenize(df, "sentence"), "id", "tokens").collect()}
    assert terms["i"] == pytest.approx(math.log(4 / 3))
    cv, vocab = fe.count_vectors(spark.createDataFrame([(["a", "b", "c"],), (["a", "b", "b", "c", "a"],)], "w array<string>"), "w")
    assert set(vocab) == {"a", "b", "c"}


def test_scalers_and_vectors(spark):
    df = spark.createDataFrame([(0, Vectors.dense([1.0, 0.1, -1.0])), (1, Vectors.dense([2.0, 1.1, 1.0])),
                                (2, Vectors.dense([3.0, 10.1, 3.0]))], ["id", "features"])
    mm = [list(r.scaled) for r in fe.minmax(df, "features").orderBy("id").collect()]
    assert mm[0] == [0.0, 0.0, 0.0] and mm[2] == [1.0, 1.0, 1.0]
    ma = [list(r.scaled) for r in fe.maxabs(df, "features").orderBy("id").collect()]
    assert ma[2] == [1.0, 1.0, 1.0]
    n1 = fe.normalize(df, "features", 1.0).first().normalized
    assert sum(abs(x) for x in n1) == pytest.approx(1.0)
    ninf = fe.normalize(df, "features", float("inf")).first().normalized
    assert max(abs(x) for x in ninf) == pytest.approx(1.0)
    assert list(fe.scale_by(df, "features", [0.0, 1.0, 2.0]).first().scaled) == [0.0, 0.1, -2.0]
    assert fe.poly(df, "features", 2).first().poly.size == 9
    assert fe.dct(df, "features").first().dct.size == 3
    _, p = fe.pca(df, "features", 2)
    assert p.first().pca.size == 2
    assert fe.slice_vector(df, "features", [1]).first().sliced.toArray().tolist() == [0.1]


def test_statistics(spark):
    s = spark.createDataFrame([(1.0, 11.0), (2.0, 22.0), (3.0, 33.0), (3.0, 33.0), (5.0, 555.0)], "x double, y double")
    c = sa.corr_pairs(s, "x", ["y"]).first()[0]
    assert c == pytest.approx(np.corrcoef([1, 2, 3, 3, 5], [11, 22, 33, 33, 555])[0, 1])
    sp = {(r.a, r.b): r.corr for r in sa.corr_matrix(s, ["x", "y"], "spearman").collect()}
    assert sp[("x", "y")] == pytest.approx(1.0, abs=1e-9)
    k = {r.point: r.density for r in sa.kde(s, "x", [-1.0, 2.0, 5.0], 3.0).collect()}
    want = np.mean([math.exp(-((x - 2.0) ** 2) / 18) for x in [1, 2, 3, 3, 5]]) / (3 * math.sqrt(2 * math.pi))
    assert k[2.0] == pytest.approx(want)
    df = spark.createDataFrame([(0.0, 0.5, 10.0), (0.0, 1.5, 20.0), (1.0, 1.5, 30.0), (0.0, 3.5, 30.0),
                                (0.0, 3.5, 40.0), (1.0, 3.5, 40.0)], "label double, f1 double, f2 double")
    mine = {r.feature: (round(r.statistic, 6), r.dof) for r in sa.chisq_independence(df, ["f1", "f2"], "label").collect()}
    ref = sa.chisq_test(fe.assemble(df, ["f1", "f2"]), "features", "label").orderBy("featureIndex").collect()
    assert mine["f1"] == (round(ref[0].statistic, 6), ref[0].degreesOfFreedom)
    assert mine["f2"] == (round(ref[1].statistic, 6), ref[1].degreesOfFreedom)
    ks = sa.ks_normal(spark.createDataFrame([(0.1,), (0.15,), (0.2,), (0.3,), (0.25,)], "x double"), "x").first()
    assert 0 <= ks.pValue <= 1
    cos = {(r.a, r.b): r.similarity for r in sa.column_cosine(s, ["x", "y"]).collect()}
    x, y = np.array([1, 2, 3, 3, 5.0]), np.array([11, 22, 33, 33, 555.0])
    assert cos[("x", "y")] == pytest.approx(x @ y / np.linalg.norm(x) / np.linalg.norm(y))


def test_svd_and_pca_rows(spark):
    rows = [Vectors.dense([0.0, 1.0, 0.0, 7.0, 0.0]), Vectors.dense([2.0, 0.0, 3.0, 4.0, 5.0]),
            Vectors.dense([4.0, 0.0, 0.0, 6.0, 7.0])]
    df = spark.createDataFrame([(v,) for v in rows], ["features"])
    s, v, _ = sa.svd(df, "features", 3)
    want = np.linalg.svd(np.array([r.toArray() for r in rows]), compute_uv=False)
    assert np.allclose(s, want[:3])
    assert sa.row_pca(df, "features", 2).shape == (5, 2)


def test_patterns(spark):
    df = spark.createDataFrame([(0, ["1", "2", "5"]), (1, ["1", "2", "3", "5"]), (2, ["1", "2"])], "id int, items array<string>")
    sets = {tuple(r.items): r.freq for r in pt.itemsets(df, "items", 0.5).collect()}
    assert sets[("1", "2")] == 3 and sets[("1", "2", "5")] == 2
    m = pt.fpgrowth(df, "items", 0.5, 0.6)
    rules = {(tuple(r.antecedent), tuple(r.consequent)): r.confidence for r in pt.rules(m).collect()}
    assert rules[(("5",), ("1",))] == 1.0
    fi = spark.createDataFrame([(["a"], 15), (["b"], 35), (["a", "b"], 12)], "items array<string>, freq long")
    r = pt.rules_from(fi, 0.8).collect()
    assert [(x.antecedent, x.consequent, x.confidence) for x in r] == [(["a"], ["b"], 0.8)]
    seqs = spark.createDataFrame([([[1, 2], [3]],), ([[1], [3, 2], [1, 2]],), ([[1, 2], [5]],), ([[6]],)],
                                 "sequence array<array<int>>")
    ps = {str(r.sequence): r.freq for r in pt.sequences(seqs, "sequence", 0.5, 5).collect()}
    assert ps["[[1, 2]]"] == 3


def test_sequences_of_the_query_have_up_to_five_items(spark, tmp):
    import itertools
    import random
    from collections import Counter
    from skyframe.plans.registry import QUERIES
    rng = random.Random(2)
    baskets = [[sorted(rng.sample("abcde", rng.randint(1, 2))) for _ in range(4)] for _ in range(12)]
    line, orders = [], []
    for c, seq in enumerate(baskets):
        for day, items in enumerate(seq):
            orders.append((c * 10 + day, c, f"1995-01-0{day + 1}"))
            line += [(c * 10 + day, ord(x)) for x in items]
    for name, rows, kind in (("lineitem", line, "l_orderkey long, l_partkey long"),
                             ("part", [(ord(x), x) for x in "abcde"], "p_partkey long, p_brand string"),
                             ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate string")):
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp}/{name}.parquet")
    want = Counter()
    for seq in baskets:
        parts = [[c for n in range(len(b) + 1) for c in itertools.combinations(b, n)] for b in seq]
        found = {tuple(x for x in pick if x) for pick in itertools.product(*parts)}
        want.update(f for f in found if 1 <= sum(map(len, f)) <= 5)
    want = {k: n for k, n in want.items() if n >= 1.2}
    got = {tuple(tuple(sorted(x)) for x in r.sequence): r.freq for r in QUERIES["fpm05_prefixspan"](spark, tmp).collect()}
    assert got == want and max(sum(map(len, k)) for k in got) == 5


def test_sequences_are_counted_on_bitmaps_as_by_the_estimator(spark, monkeypatch):
    """Long, empty and null sequences; bitmaps of few rows and of several words."""
    import random
    from pyspark.ml.fpm import PrefixSpan
    rng = random.Random(1)

    def key(df):
        rows = df.collect()
        out = {tuple(tuple(sorted(x)) for x in r.sequence): r.freq for r in rows}
        assert len(out) == len(rows)
        return out

    for n, items, sets, support, most in ((60, 6, 5, 0.2, 5), (20, 4, 150, 0.95, 3)):
        data = [([rng.sample(range(items), rng.randint(0, 3)) for _ in range(rng.randint(0, sets))],) for _ in range(n)]
        df = spark.createDataFrame(data + [(None,)], "sequence array<array<int>>").repartition(3)
        want = PrefixSpan(minSupport=support, maxPatternLength=most).findFrequentSequentialPatterns(df)
        with monkeypatch.context() as m:
            m.setattr(pt, "PrefixSpan", lambda **_: pytest.fail("the estimator counts item by item"))
            got = pt.sequences(df, "sequence", support, most, 20_000)
            assert got.schema == want.schema and key(got) == key(want) and len(key(got)) > 10
            assert pt.sequences(df.limit(0)).count() == 0
    twice = spark.createDataFrame([([[1, 1, 2], [2]],), ([[1, 1]],)], "sequence array<array<int>>")
    assert key(pt.sequences(twice, "sequence", 1.0)) == {((1,),): 2, ((1, 1),): 2}


def test_lloyd_ends_by_movement_or_raises(spark, monkeypatch):
    df = spark.createDataFrame([(Vectors.dense([float(i)]),) for i in range(12)], ["features"])
    with pytest.raises(RuntimeError):
        md.lloyd(df, "features", 2, max_iter=1, eps=-1.0)
    seen = []

    def slow(pts, x, centres):
        seen.append(centres.copy())
        return centres + (1.0 if len(seen) <= 70 else 0.0)
    monkeypatch.setattr(md, "lloyd_step", slow)
    assert np.array_equal(md.lloyd(df, "features", 2), seen[0] + 70) and len(seen) == 71


def test_evaluation(spark):
    df = spark.createDataFrame([(0.9, 1.0), (0.8, 1.0), (0.7, 0.0), (0.6, 1.0), (0.2, 0.0)], "score double, label double")
    t = ev.threshold_table(df, num_bins=None)
    auc = ev.auc_roc(t).first()[0]
    assert auc == pytest.approx(5 / 6)
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ref = BinaryClassificationEvaluator(rawPredictionCol="score").evaluate(df)
    assert auc == pytest.approx(ref)
    mc = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 2.0), (2.0, 0.0)],
                               "prediction double, label double")
    s = ev.multiclass_summary(ev.multiclass(mc)).first()
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    assert s.accuracy == pytest.approx(MulticlassClassificationEvaluator(metricName="accuracy").evaluate(mc))
    assert s.weighted_f1 == pytest.approx(MulticlassClassificationEvaluator(metricName="f1").evaluate(mc))
    ml = spark.createDataFrame([([0.0, 1.0], [0.0, 2.0]), ([0.0, 2.0], [0.0, 1.0]), ([], [0.0]), ([2.0], [2.0]),
                                ([2.0, 0.0], [2.0, 0.0]), ([0.0, 1.0, 2.0], [0.0, 1.0]), ([1.0], [1.0, 2.0])],
                               "prediction array<double>, label array<double>")
    m = ev.multilabel(ml).first()
    from pyspark.ml.evaluation import MultilabelClassificationEvaluator as MLE
    assert m.micro_f1 == pytest.approx(MLE(metricName="microF1Measure").evaluate(ml))
    assert m.hamming_loss == pytest.approx(MLE(metricName="hammingLoss").evaluate(ml))
    assert m.subset_accuracy == pytest.approx(MLE(metricName="subsetAccuracy").evaluate(ml))
    reg = spark.createDataFrame([(2.5, 3.0), (0.0, -0.5), (2.0, 2.0), (8.0, 7.0)], "prediction double, label double")
    r = ev.regression(reg).first()
    from pyspark.ml.evaluation import RegressionEvaluator as RE
    for k, name in [("rmse", "rmse"), ("mae", "mae"), ("r2", "r2"), ("explained_variance", "var")]:
        assert r[k] == pytest.approx(RE(metricName=name).evaluate(reg))


def test_ranking_metrics(spark):
    pred = spark.createDataFrame([("u", i, float(10 - i)) for i in range(1, 6)], "user string, item int, score double")
    rel = spark.createDataFrame([("u", 1), ("u", 3), ("u", 9)], "user string, item int")
    m = ev.ranking(pred, rel, "user", "item", "score", (1, 3)).first()
    assert m.precision_at_1 == 1.0 and m.precision_at_3 == pytest.approx(2 / 3)
    assert m.map == pytest.approx((1 / 1 + 2 / 3) / 3)
    idcg3 = 1 + 1 / math.log2(3) + 1 / math.log2(4)
    assert m.ndcg_at_3 == pytest.approx((1 + 1 / math.log2(4)) / idcg3)


def test_udfs(spark):
    emp = spark.createDataFrame([("Michael", 3000), ("Andy", 4500), ("Justin", 3500), ("Berta", 4000)],
                                "name string, salary long").withColumn("g", F.lit(1))
    assert uf.udaf_mean(emp, "g", "salary", 4).first().average == 3750.0
    assert emp.agg(uf.my_average("salary")).first()[0] == 3750.0
    uf.register_my_average(spark)
    emp.createOrReplaceTempView("employees")
    assert spark.sql("SELECT myAverage(salary) AS a FROM employees").first().a == 3750.0
    toks = spark.createDataFrame([(["a", "b"],), ([],)], "t array<string>")
    assert [r.n for r in uf.count_tokens_pandas(toks, "t", "n").collect()] == [2, 0]
    out = uf.map_frames(emp, lambda p: p.assign(salary=p.salary * 2), emp.schema)
    assert out.agg(F.sum("salary")).first()[0] == 30000
    import pandas as pd
    res = uf.apply_params(spark, [{"x": 1}, {"x": 2}], lambda p: pd.DataFrame({"y": [p["x"] ** 2]}), "y long")
    assert sorted(r.y for r in res.collect()) == [1, 4]


def test_custom_stages_persist(spark, tmp):
    df = spark.range(0, 4).select(F.col("id").cast("double").alias("x"))
    t = md.ShiftTransformer(inputCol="x", outputCol="y", shift=0.5)
    t.write().overwrite().save(f"{tmp}/shift")
    back = md.ShiftTransformer.load(f"{tmp}/shift")
    assert [r.y for r in back.transform(df).collect()] == [0.5, 1.5, 2.5, 3.5]
    with pytest.raises(TypeError):
        t.transform(spark.createDataFrame([("a",)], "x string"))
    v = spark.createDataFrame([(Vectors.dense([1.0, 2.0]), 1.0)], ["features", "label"])
    m = md.MyClassifier().fit(v)
    assert sum(m.getOrDefault("coefficients")) == 0 and m.transform(v).first().prediction == 0.0


def test_models_fit(spark, tmp):
    rows = [(Vectors.dense([float(i % 7), float(i % 3)]), float(i % 7 > 3)) for i in range(60)]
    df = spark.createDataFrame(rows, ["features", "label"])
    lr = md.logreg(df, maxIter=20)
    assert 0 <= md.logreg_summary(lr)["best_threshold"] <= 1
    w = md.logreg_gd(df.select("features", (F.col("label") * 2 - 1).alias("y")), "features", "y", 2, iters=5)
    assert w[0] > 0
    for model in (md.linear_svc(df, maxIter=10), md.naive_bayes(df), md.tree(df, maxDepth=3),
                  md.forest(df, numTrees=3, seed=1), md.gbt(df, maxIter=3), md.mlp(df, [2, 4, 2], iters=20),
                  md.one_vs_rest(df)):
        assert model.transform(df).filter("prediction = label").count() > 30
    km = md.kmeans(df, 2, seed=1)
    assert km.summary.trainingCost > 0
    c = md.lloyd(df, "features", 2)
    assert c.shape == (2, 2)
    back = md.roundtrip(km, f"{tmp}/km")
    assert back.transform(df).count() == 60
    lin = md.linreg(df.withColumn("y", F.col("label") * 3 + 1), label="y")
    assert lin.summary.r2 <= 1.0
    surv = spark.createDataFrame([(1.218, 1.0, Vectors.dense(1.560, -0.605)), (2.949, 0.0, Vectors.dense(0.346, 2.158)),
                                  (3.627, 0.0, Vectors.dense(1.380, 0.231)), (0.273, 1.0, Vectors.dense(0.520, 1.151)),
                                  (4.199, 0.0, Vectors.dense(0.795, -0.226))], ["label", "censor", "features"])
    assert len(md.aft(surv).transform(surv).first().quantiles) == 2
    g = md.gmm(df, 2)
    probs = md.gmm_membership(g, df).first().probability
    assert sum(probs) == pytest.approx(1.0)
    ratings = spark.createDataFrame([(u, i, float((u * i) % 5)) for u in range(10) for i in range(10)],
                                    "user int, item int, rating float")
    als = md.als(ratings, rank=3, iters=3)
    users, items = md.als_factors(als)
    assert users.count() == 10 and users.first().value.count(",") == 3


def test_als_by_hand_fits_low_rank(spark):
    rng = np.random.default_rng(0)
    a, b = rng.random((12, 2)), rng.random((9, 2))
    r = a @ b.T
    rows = [(u, i, float(r[u, i])) for u in range(12) for i in range(9)]
    df = spark.createDataFrame(rows, "user int, item int, rating double")
    u, v, hist = md.als_by_hand(df, rank=2, iters=10, lam=1e-4)
    assert hist[-1] < 0.05 and hist[-1] <= hist[0]
    assert u.count() == 12 and v.count() == 9


def test_dimsum_close_to_exact(spark):
    rng = np.random.default_rng(1)
    m = rng.random((400, 5))
    m[:, 1] = m[:, 0] * 2 + 0.01 * rng.random(400)
    df = spark.createDataFrame([([float(v) for v in r],) for r in m], "x array<double>")
    n = np.linalg.norm(m, axis=0)
    exact = (m.T @ m) / np.outer(n, n)
    # a low threshold keeps (almost) every entry: close to exact
    got = {(r.i, r.j): r.similarity for r in sa.column_cosine_approx(df, "x", 0.1).collect()}
    assert all(abs(v - exact[i, j]) < 0.1 for (i, j), v in got.items()) and len(got) == 10
    # a high threshold samples: unbiased on average over seeds
    runs = [{(r.i, r.j): r.similarity for r in sa.column_cosine_approx(df, "x", 2.0, seed=s).collect()}
            for s in range(8)]
    mean01 = np.mean([r.get((0, 1), 0.0) for r in runs])
    assert abs(mean01 - exact[0, 1]) < 0.15


def test_more_estimators_shapes(spark):
    df = spark.createDataFrame([(float(i), Vectors.dense([float(i % 4), float(i % 3), float(i)]), float(i % 2))
                                for i in range(40)], ["x", "features", "label"])
    q = fe.quantile_buckets(df, "x", 4, "qb")
    assert q.select("qb").distinct().count() == 4
    _, iv = fe.index_vector(df, "features", 4)
    assert iv.first().indexed.size == 3
    _, sel = fe.chisq_select(df, 2)
    assert sel.first().selected.size == 2
    words = spark.createDataFrame([(["a", "b", "c", "a"],), (["b", "c", "d"],)] * 5, "w array<string>")
    m, t = fe.word2vec(words, "w", 3, 0, partitions=2)
    assert m.findSynonyms("a", 2).count() == 2 and t.first().vector.size == 3
    assert md.bisecting(df, 2).transform(df).select("prediction").distinct().count() == 2
    cv, _ = fe.count_vectors(words, "w", out="features")
    lda = md.lda(cv, k=2, iters=3)
    assert lda.describeTopics(2).count() == 2
    iso = md.isotonic(df.withColumn("features", F.col("features")), True, label="x")
    assert iso.boundaries.size > 0


def test_spearman_ranks_values_not_rows(spark, monkeypatch):
    """Ties at their mean rank, by both ways of looking ranks up; no null, no NaN."""
    import numpy as np
    rows = [(float(i % 7), float(i * i % 23), -0.0 if i % 2 else 0.0) for i in range(90)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    x = np.array(rows)

    def ranks(v):
        return np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])

    want = np.corrcoef(ranks(x[:, 0]), ranks(x[:, 1]))[0, 1]
    ml = "pyspark.ml.stat.Correlation.corr"
    monkeypatch.setattr(ml, lambda *a, **k: pytest.fail("ranks of all rows of all columns in one sort"))
    for limit in (sa.RANKS_BROADCAST, 0):
        monkeypatch.setattr(sa, "RANKS_BROADCAST", limit)
        got = {(r.a, r.b): r.corr for r in sa.corr_matrix(df, ["x", "y", "z"], "spearman").collect()}
        assert abs(got["x", "y"] - want) < 1e-12 and got["x", "y"] == got["y", "x"] and got["x", "x"] == 1.0
        assert got["x", "z"] != got["x", "z"]           # z has one value
    for odd in (None, float("nan")):
        with pytest.raises(Exception):
            sa.corr_matrix(df.union(spark.createDataFrame([(1.0, odd, 1.0)], df.schema)), ["x", "y"], "spearman").collect()


def test_top_items_make_the_ratings_once(spark, tmp):
    from skyframe.plans.registry import QUERIES
    orders = [(o, o % 6) for o in range(60)]
    line = [(o, (o * 7 + n * n) % 25, float(1 + (o * n) % 9)) for o in range(60) for n in range(6)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp}/orders.parquet")
    spark.createDataFrame(line, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp}/lineitem.parquet")
    top = QUERIES["mod22_als_top_items"](spark, tmp)
    plan = top._jdf.queryExecution().toString()
    assert "l_quantity" not in plan
    assert dict(top.dtypes) == {"user": "bigint", "item": "bigint", "prediction": "float", "rank": "int"}
    rated = {(o % 6, item) for o, item, _ in line}
    got = top.collect()
    assert len(got) == sum(min(10, sum(u == v for v, _ in rated)) for u in range(6)) and {(r.user, r.item) for r in got} <= rated
    for u in range(6):
        mine = sorted((r.rank, r.prediction) for r in got if r.user == u)
        assert [k for k, _ in mine] == list(range(1, len(mine) + 1)) and [p for _, p in mine] == sorted((p for _, p in mine), reverse=True)
    r = spark.createDataFrame([(u, i, float((u * i) % 5 + 1)) for u in range(6) for i in range(9)], "user long, item long, rating float")
    m, pairs = md.als(r, rank=3, iters=2), r.select("user", "item").union(spark.createDataFrame([(99, 1), (1, 99)], "user long, item long"))
    assert sorted(md.als_scores(m, pairs).collect()) == sorted(m.transform(pairs).collect())


def test_ngrams_are_counted_in_tasks_of_bounded_text(spark, tmp, monkeypatch):
    from collections import Counter
    from skyframe.plans.registry import QUERIES
    texts = [f"w{i % 7} x{i % 5} y{i % 3} w{i % 7} x{i % 5}" for i in range(200)] + ["", "one"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp}/documents.parquet")
    monkeypatch.setattr(fe, "CHARS_PER_TASK", 500)
    docs = fe.spread(spark.read.parquet(f"{tmp}/documents.parquet"), "text")
    assert docs.rdd.getNumPartitions() == -(-sum(map(len, texts)) // 500)
    q = QUERIES["fea04_ngrams"](spark, tmp)
    assert "RoundRobinPartitioning" in q._jdf.queryExecution().toString()
    want = Counter(f"{a} {b}" for t in texts for a, b in zip(t.split(), t.split()[1:]))
    assert {r.ngram: r["count"] for r in q.collect()} == want
