"""Evaluation metrics as aggregates: binary (threshold curves, AUC),
multiclass, multilabel, ranking, regression, error rate, clustering cost.

Curves are computed on the table of distinct scores, not on the rows, by
prefix sums over ranges of scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def threshold_table(df: DataFrame, score: str = "score", label: str = "label",
                    num_bins: int | None = None) -> DataFrame:
    """Per threshold (distinct score, descending): cumulative true and false
    positives, precision, recall, false-positive rate, and the threshold's
    own positives and negatives with the totals of both.

    The curve is exact however many distinct scores there are: one aggregate per
    score, then prefix sums over ranges of scores -- sums inside each range, shifted by the totals
    of the ranges above it -- so no task orders more than its range.  ``num_bins``
    instead rounds the scores down to that many steps of equal width."""
    from skyframe.operators.relational import ordered_running
    s = F.col(score)
    if num_bins:
        lo_hi = df.agg(F.min(score).alias("lo"), F.max(score).alias("hi")).first()
        lo, hi = (lo_hi["lo"], lo_hi["hi"]) if lo_hi["lo"] is not None else (0.0, 0.0)
        width = (hi - lo) / num_bins or 1.0
        s = F.lit(lo) + F.floor((s - F.lit(lo)) / width) * width
    counts = df.groupBy(s.alias("threshold")).agg(
        F.sum(F.when(F.col(label) > 0.5, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) > 0.5, 0).otherwise(1)).alias("neg"))
    t = ordered_running(counts.withColumn("_all", F.lit(0)), "_all", [F.desc("threshold")], ["pos", "neg"], totals=True)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    return t.select("threshold", tp.alias("tp"), fp.alias("fp"),
                    (tp / (tp + fp)).alias("precision"),
                    F.when(F.col("tot_pos") > 0, tp / F.col("tot_pos")).alias("recall"),
                    F.when(F.col("tot_neg") > 0, fp / F.col("tot_neg")).alias("fpr"),
                    "pos", "neg", "tot_pos", "tot_neg")


def f_measure(table: DataFrame, beta: float = 1.0) -> DataFrame:
    b2 = beta * beta
    p, r = F.col("precision"), F.col("recall")
    return table.withColumn("f_measure", F.when(p + r == 0, 0.0).otherwise((1 + b2) * p * r / (b2 * p + r)))


def auc_roc(table: DataFrame) -> DataFrame:
    """Area under ROC by the trapezoid rule from (0, 0) to (1, 1).  A
    threshold's own counts give the point before it, so this is one aggregate."""
    before = F.col("tp") - F.col("pos")
    area = F.col("neg") / F.col("tot_neg") * (before + F.col("tp")) / (2 * F.col("tot_pos"))
    return table.agg(F.sum(area).alias("auc_roc"))


def auc_pr(table: DataFrame) -> DataFrame:
    """Area under precision-recall (trapezoid, first point at recall 0 with
    the first precision); one aggregate."""
    seen = F.col("tp") + F.col("fp") - F.col("pos") - F.col("neg")
    last = F.when(seen == 0, F.col("precision")).otherwise((F.col("tp") - F.col("pos")) / seen)
    return table.agg(F.sum(F.col("pos") / F.col("tot_pos") * (F.col("precision") + last) / 2).alias("auc_pr"))


def multiclass(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Per label: tp, fp, fn, precision, recall, F1, false-positive rate,
    plus the label's share (weights for the weighted averages)."""
    cm = df.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    tp = cm.filter(F.col("l") == F.col("p")).select(F.col("l").alias("label"), F.col("n").alias("tp"))
    actual = cm.groupBy(F.col("l").alias("label")).agg(F.sum("n").alias("actual"))
    predicted = cm.groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("predicted"))
    total = cm.agg(F.sum("n")).scalar()                 # scalar subquery, no join
    m = (actual.join(predicted, "label", "full").join(tp, "label", "left")
               .fillna(0, ["actual", "predicted", "tp"])
               .withColumn("total", total))
    prec = F.when(F.col("predicted") == 0, 0.0).otherwise(F.col("tp") / F.col("predicted"))
    rec = F.when(F.col("actual") == 0, 0.0).otherwise(F.col("tp") / F.col("actual"))
    fp = F.col("predicted") - F.col("tp")
    return m.select("label", "tp", (fp).alias("fp"), (F.col("actual") - F.col("tp")).alias("fn"),
                    prec.alias("precision"), rec.alias("recall"),
                    F.when(prec + rec == 0, 0.0).otherwise(2 * prec * rec / (prec + rec)).alias("f1"),
                    (fp / (F.col("total") - F.col("actual"))).alias("fpr"),
                    (F.col("actual") / F.col("total")).alias("weight"))


def multiclass_summary(per_label: DataFrame) -> DataFrame:
    """accuracy, weighted precision / recall / F1."""
    return per_label.agg((F.sum("tp") / F.sum(F.col("tp") + F.col("fn"))).alias("accuracy"),
                         F.sum(F.col("weight") * F.col("precision")).alias("weighted_precision"),
                         F.sum(F.col("weight") * F.col("recall")).alias("weighted_recall"),
                         F.sum(F.col("weight") * F.col("f1")).alias("weighted_f1"))


def multilabel(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Document-averaged precision, recall, F1, accuracy; micro precision /
    recall / F1; Hamming loss; subset accuracy."""
    p, l = F.col(prediction), F.col(label)
    inter = F.size(F.array_intersect(p, l))
    union = F.size(F.array_union(p, l))
    per = df.select(inter.alias("i"), F.size(p).alias("np"), F.size(l).alias("nl"), union.alias("u"),
                    (F.array_sort(F.array_distinct(p)) == F.array_sort(F.array_distinct(l))).cast("int").alias("eq"),
                    F.array_union(p, l).alias("labels"))
    n_labels = per.select(F.explode("labels").alias("x")).agg(F.count_distinct("x")).scalar()
    agg = per.agg(
        F.avg(F.when(F.col("np") > 0, F.col("i") / F.col("np")).otherwise(0.0)).alias("precision"),
        F.avg(F.when(F.col("nl") > 0, F.col("i") / F.col("nl")).otherwise(0.0)).alias("recall"),
        F.avg(F.when(F.col("np") + F.col("nl") > 0, 2 * F.col("i") / (F.col("np") + F.col("nl"))).otherwise(0.0))
         .alias("f1"),
        F.avg(F.when(F.col("u") > 0, F.col("i") / F.col("u")).otherwise(1.0)).alias("accuracy"),
        (F.sum("i") / F.sum("np")).alias("micro_precision"),
        (F.sum("i") / F.sum("nl")).alias("micro_recall"),
        (2 * F.sum("i") / (F.sum("np") + F.sum("nl"))).alias("micro_f1"),
        F.sum(F.col("np") + F.col("nl") - 2 * F.col("i")).alias("_ham"),
        F.count(F.lit(1)).alias("_docs"),
        F.avg("eq").alias("subset_accuracy"))
    return (agg.withColumn("hamming_loss", F.col("_ham") / (F.col("_docs") * n_labels))
               .drop("_ham", "_docs"))


def ranking(pred: DataFrame, relevant: DataFrame, user: str, item: str, score: str, ks=(1, 3, 5)) -> DataFrame:
    """precision@k, NDCG@k and MAP: ``pred`` ranks items per user by score
    (ties by item), ``relevant`` lists (user, item) pairs that count.
    Users without relevant items are skipped."""
    from skyframe.operators.relational import ordered_running
    rel = relevant.select(user, item).distinct().withColumn("hit", F.lit(1))
    nrel = rel.groupBy(user).agg(F.count(F.lit(1)).alias("nrel"))
    tagged = pred.select(user, item, score).join(rel, [user, item], "left").fillna(0, ["hit"])
    # exact ranks and running hit counts per user without a per-user window
    ranked = ordered_running(tagged, user, [F.desc(score), F.asc(item)], ["hit"])
    r = ranked.withColumnRenamed("cum_hit", "hits_so_far").join(nrel, user)
    per_user = r.groupBy(user).agg(
        (F.sum(F.when(F.col("hit") == 1, F.col("hits_so_far") / F.col("rank")).otherwise(0.0))
         / F.first("nrel")).alias("ap"),
        *[(F.sum(F.when(F.col("rank") <= k, F.col("hit")).otherwise(0)) / k).alias(f"p_at_{k}") for k in ks],
        *[F.sum(F.when((F.col("rank") <= k) & (F.col("hit") == 1), 1.0 / F.log2(F.col("rank") + 1))
                .otherwise(0.0)).alias(f"dcg_{k}") for k in ks],
        F.first("nrel").alias("nrel"))
    # ideal DCG at k: relevant items in the first min(k, nrel) places
    idcg = {k: F.aggregate(F.sequence(F.lit(1), F.least(F.lit(k), F.col("nrel"))), F.lit(0.0),
                           lambda acc, i: acc + 1.0 / F.log2(i + 1)) for k in ks}
    out = per_user.select(user, "ap", *[f"p_at_{k}" for k in ks],
                          *[(F.col(f"dcg_{k}") / idcg[k]).alias(f"ndcg_{k}") for k in ks])
    return out.agg(F.avg("ap").alias("map"), *[F.avg(f"p_at_{k}").alias(f"precision_at_{k}") for k in ks],
                   *[F.avg(f"ndcg_{k}").alias(f"ndcg_at_{k}") for k in ks])


def regression(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """MSE, RMSE, MAE, R^2 and explained variance, in one aggregate."""
    p, y = F.col(prediction), F.col(label)
    agg = df.agg(F.avg((p - y) ** 2).alias("mse"), F.avg(F.abs(p - y)).alias("mae"),
                 F.var_pop(y).alias("_vy"), F.avg(p * p).alias("_pp"), F.avg(p).alias("_mp"),
                 F.avg(y).alias("_my"))
    # explained variance = mean((p - mean(y))^2), expanded so one pass suffices
    explained = F.col("_pp") - 2 * F.col("_my") * F.col("_mp") + F.col("_my") * F.col("_my")
    return agg.select("mse", F.sqrt("mse").alias("rmse"), "mae",
                      (1 - F.col("mse") / F.col("_vy")).alias("r2"),
                      explained.alias("explained_variance"))


def error_rate(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    return df.agg(F.avg((F.col(prediction) != F.col(label)).cast("double")).alias("error_rate"))


def mse(df: DataFrame, prediction: str, label: str) -> DataFrame:
    d = F.col(prediction) - F.col(label)
    return df.agg(F.avg(d * d).alias("mse"), F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(F.abs(d)).alias("mae"))


def wssse(df: DataFrame, features: str, centers: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Sum of squared distances of points (array column) to their own
    centre; ``centers``: (cluster, center array)."""
    from skyframe.plans.joins import broadcast_if_small
    j = df.join(broadcast_if_small(centers), cluster)
    d = F.aggregate(F.zip_with(features, "center", lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                    lambda acc, x: acc + x)
    return j.agg(F.sum(d).alias("wssse"))
