"""Statistics and linear algebra: summaries, correlation, chi-square tests,
Kolmogorov-Smirnov, kernel density, column similarities, SVD and PCA.

Sufficient statistics are computed in one aggregate over the data; only a
fixed number of values (per column or per column pair) reaches the driver.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframe.plans.joins import keyed_join
from skyframe.session import checkpoint_dir


def summarize(df: DataFrame, vec: str, dims: int) -> DataFrame:
    """Per component: count, mean, variance (sample), min, max, non-zeros,
    L1 and L2 norm -- long form (component, metric columns)."""
    a = vector_to_array(F.col(vec)) if dict(df.dtypes)[vec] != "array<double>" else F.col(vec)
    exploded = df.select(F.posexplode(a).alias("component", "x"))
    return exploded.groupBy("component").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.var_samp("x").alias("variance"),
        F.min("x").alias("min"), F.max("x").alias("max"),
        F.sum(F.when(F.col("x") != 0, 1).otherwise(0)).alias("num_nonzeros"),
        F.sum(F.abs("x")).alias("norm_l1"), F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm_l2"))


def summarizer(df: DataFrame, vec: str) -> DataFrame:
    """pyspark.ml Summarizer in one aggregate (vectors out)."""
    from pyspark.ml.stat import Summarizer
    s = Summarizer.metrics("count", "mean", "variance", "min", "max", "numNonZeros", "normL1", "normL2")
    return df.select(s.summary(F.col(vec)).alias("s")).select("s.*")


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.describe(*cols)


def corr_matrix(df: DataFrame, cols: list[str], method: str = "pearson") -> DataFrame:
    """Pairwise correlation of columns, long form (a, b, corr).  Pearson is
    one aggregate of all pairs; Spearman is the same of the columns' mean ranks
    (``mean_ranks``) and wants at least two rows without null or NaN."""
    spark = df.sparkSession
    pairs = [(a, b) for a in cols for b in cols]
    if method == "pearson":
        row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs]).first()
        return spark.createDataFrame([(a, b, float(row[f"{a}|{b}"]) if row[f"{a}|{b}"] is not None else None)
                                      for a, b in pairs], "a string, b string, corr double")
    rows = df.select(*[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(cols)])
    bad = reduce(lambda p, q: p | q, [F.col(c).isNull() | F.isnan(c) for c in rows.columns])
    n, odd = rows.agg(F.count(F.lit(1)), F.count_if(bad)).first()
    if n < 2 or odd:
        raise ValueError(f"ranks need two rows or more without null or NaN; {n} rows, {odd} with")
    for v in list(rows.columns):
        ranks, values = mean_ranks(rows, v, f"_r{v}")
        rows = rows.join(F.broadcast(ranks), v) if values <= RANKS_BROADCAST else keyed_join(rows, ranks, v, n)
        rows = rows.drop(v)
    upper = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    cov = dict(zip(upper, rows.agg(*[F.covar_pop(f"_r_v{i}", f"_r_v{j}") for i, j in upper]).first()))
    known = {(i, i): 1.0 for i in range(len(cols))}
    for i, j in upper:
        if i != j:
            spread = math.sqrt(cov[i, i] * cov[j, j])
            known[i, j] = known[j, i] = cov[i, j] / spread if spread else float("nan")     # one value only: undefined
    return spark.createDataFrame([(a, b, known[i, j]) for i, a in enumerate(cols) for j, b in enumerate(cols)],
                                 "a string, b string, corr double")


RANKS_BROADCAST = 200_000      # distinct values of a column, two numbers each


def mean_ranks(df: DataFrame, col: str, name: str) -> tuple[DataFrame, int]:
    """(col, name): the rank from 1 of each distinct value, ties at their mean;
    and how many values there are.  Rows are counted per value first, so what is sorted and
    added up are distinct values, in ranges; a sum per range reaches the driver."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    parts = max(1, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "1")))
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    ordered = counts.repartitionByRange(parts, col).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    sums = ordered.groupBy("_pid").agg(F.sum("_n"), F.count(F.lit(1))).collect()        # one row per range
    offsets, before, values = [], 0, 0
    for pid, n, k in sorted(tuple(r) for r in sums):
        offsets.append((pid, before))
        before, values = before + n, values + k
    table = F.broadcast(spark.createDataFrame(offsets, "_pid int, _off long"))
    upto = F.sum("_n").over(Window.partitionBy("_pid").orderBy(col).rowsBetween(Window.unboundedPreceding, 0))
    rank = F.col("_off") + upto - (F.col("_n") - 1) / 2.0
    return ordered.join(table, "_pid").select(col, rank.alias(name)), values


def corr_pairs(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """Pearson correlation of the label with each feature, one aggregate."""
    return df.agg(*[F.corr(label, f).alias(f) for f in features])


def chisq_independence(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Pearson chi-square statistic and degrees of freedom of each
    (categorical) feature against the label.

    Uses sum((o - e)^2 / e) = sum(o^2 / e) - n over the observed cells only,
    so the empty cells of the contingency table are never materialised.
    """
    out = None
    for f in features:
        cells = df.groupBy(F.col(f).alias("v"), F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("o"))
        rows = cells.groupBy("v").agg(F.sum("o").alias("rv"))
        cols_ = cells.groupBy("y").agg(F.sum("o").alias("cy"))
        j = cells.join(rows, "v").join(cols_, "y")
        stat = j.agg((F.sum(F.col("o") * F.col("o") / (F.col("rv") * F.col("cy"))) * F.sum("o")
                      - F.sum("o")).alias("statistic"),
                     ((F.count_distinct("v") - 1) * (F.count_distinct("y") - 1)).alias("dof"))
        stat = stat.select(F.lit(f).alias("feature"), "statistic", "dof")
        out = stat if out is None else out.unionByName(stat)
    return out


def chisq_test(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """pyspark.ml ChiSquareTest (p-values, dof, statistics per feature)."""
    from pyspark.ml.stat import ChiSquareTest
    return ChiSquareTest.test(df, features, label, flatten=True)


def chisq_gof(df: DataFrame, col: str, expected: DataFrame | None = None) -> DataFrame:
    """Goodness of fit of the value counts of ``col`` against ``expected``
    (value, share) or, by default, the uniform distribution."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("o"))
    j = (counts.withColumn("n", counts.agg(F.sum("o")).scalar())          # scalar subqueries
               .withColumn("k", counts.agg(F.count(F.lit(1))).scalar()))
    if expected is None:
        j = j.withColumn("e", F.col("n") / F.col("k"))
    else:
        j = j.join(expected.withColumnRenamed("share", "_p"), col).withColumn("e", F.col("n") * F.col("_p"))
    return j.agg(F.sum((F.col("o") - F.col("e")) ** 2 / F.col("e")).alias("statistic"),
                 (F.count(F.lit(1)) - 1).alias("dof"))


def chi_square_tail(x: float, dof: int) -> float:
    """P(chi-square with ``dof`` degrees of freedom > x): a finite sum, which
    starts from exp for even and from erfc for odd degrees."""
    if x <= 0 or dof <= 0:
        return 1.0
    h, odd = x / 2, dof % 2
    log_term = (0.5 * math.log(h) - math.lgamma(1.5) if odd else 0.0) - h
    total = math.erfc(math.sqrt(h)) if odd else 0.0
    for i in range(dof // 2):
        total += math.exp(log_term)
        log_term += math.log(h) - math.log(i + (1.5 if odd else 1.0))
    return min(1.0, total)


def chisq_contingency(cells: DataFrame, row: str, col: str, n: str) -> DataFrame:
    """Pearson independence test of a contingency matrix in long form (one or
    more rows a cell, absent cells are 0): statistic, dof, p_value.

    Margins are joined to the observed cells only; empty cells add to the
    statistic through n alone.  Cells with a null count or name take no part;
    without cells the statistic is 0 and the p-value 1."""
    c = (cells.filter(F.col(row).isNotNull() & F.col(col).isNotNull() & (F.col(n) > 0))
              .groupBy(F.col(row).alias("r"), F.col(col).alias("c")).agg(F.sum(n).cast("double").alias("o")))
    rows, cols_ = c.groupBy("r").agg(F.sum("o").alias("nr")), c.groupBy("c").agg(F.sum("o").alias("nc"))
    total = F.sum("o")
    got = (c.join(rows, "r").join(cols_, "c")
            .agg((F.sum(F.col("o") * F.col("o") / (F.col("nr") * F.col("nc"))) * total - total).alias("x"),
                 F.count_distinct("r").alias("r"), F.count_distinct("c").alias("c")).first())
    x, dof = max(0.0, got["x"] or 0.0), max(0, got["r"] - 1) * max(0, got["c"] - 1)
    return cells.sparkSession.createDataFrame([(x, dof, chi_square_tail(x, dof))],
                                              "statistic double, dof long, p_value double")


def ks_normal(df: DataFrame, col: str, mean: float = 0.0, sd: float = 1.0) -> DataFrame:
    """Two-sided one-sample Kolmogorov-Smirnov statistic against N(mean, sd)
    using pyspark.ml's distributed test."""
    from pyspark.ml.stat import KolmogorovSmirnovTest
    return KolmogorovSmirnovTest.test(df, col, "norm", mean, sd)


# Hart's rational approximation of the upper normal tail, as
# polynomials in |z| from the highest power down.
TAIL_TOP = (3.52624965998911e-2, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871,
            221.213596169931, 220.206867912376)
TAIL_DOWN = (8.83883476483184e-2, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674,
             637.333633378831, 793.826512519948, 440.413735824752)
TAIL_FAR = 7.07106781186547


def normal_cdf(x: Column, mean: float = 0.0, sd: float = 1.0) -> Column:
    """P(X <= x) of the normal distribution, as an expression (about 15
    digits): the rational form near the middle, a continued fraction in the tails."""
    z = (x - F.lit(float(mean))) / F.lit(float(sd))
    a = F.abs(z)

    def horner(cs):
        out = F.lit(cs[0])
        for c in cs[1:]:
            out = out * a + F.lit(c)
        return out

    far = a + 0.65
    for k in (4.0, 3.0, 2.0, 1.0):
        far = a + F.lit(k) / far
    density = F.exp(-a * a / 2)
    tail = F.when(a < TAIL_FAR, density * horner(TAIL_TOP) / horner(TAIL_DOWN)).otherwise(density / far / 2.506628274631)
    return F.when(z > 0, 1 - tail).otherwise(tail)


def exponential_cdf(x: Column, rate: float) -> Column:
    return F.when(x <= 0, 0.0).otherwise(1 - F.exp(-F.lit(float(rate)) * x))


def ks_test(df: DataFrame, col: str, cdf) -> DataFrame:
    """Two-sided one-sample Kolmogorov-Smirnov test against any continuous
    distribution; ``cdf`` maps a column of values to P(X <= value).

    The statistic is the largest gap between ``cdf`` and the empirical
    distribution on either side of each distinct value.  Ranks are exact and global: counts per value, summed inside
    ranges of values and shifted by the ranges before.  The p-value is the asymptotic one
    with the usual correction for the sample's size.  Nulls and NaNs take no part."""
    from skyframe.operators.relational import ordered_running
    x = F.col(col).cast("double")
    counts = df.select(x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x")).groupBy("x").agg(
        F.count(F.lit(1)).alias("c"))
    ranked = ordered_running(counts.withColumn("_all", F.lit(0)), "_all", [F.asc("x")], ["c"], totals=True)
    up = F.col("cum_c") / F.col("tot_c") - cdf(F.col("x"))
    down = cdf(F.col("x")) - (F.col("cum_c") - F.col("c")) / F.col("tot_c")
    stat = ranked.agg(F.max(F.greatest(up, down)).alias("statistic"), F.max("tot_c").alias("n"))
    root = F.sqrt("n")
    lam = (root + 0.12 + 0.11 / root) * F.col("statistic")
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda s, k: s + F.when(k % 2 == 1, 2.0).otherwise(-2.0)
                         * F.exp(-2.0 * k * k * lam * lam))
    return stat.select("statistic", "n", F.when(lam < 0.2, 1.0).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), series))).alias("p_value"))


def kde(df: DataFrame, col: str, points: list[float], bandwidth: float) -> DataFrame:
    """Gaussian kernel density at fixed points: one aggregate, one column
    per point (no join of data with points)."""
    x = F.col(col)
    c = 1.0 / (bandwidth * math.sqrt(2 * math.pi))
    aggs = [(F.avg(F.exp(-((x - p) ** 2) / (2 * bandwidth ** 2))) * c).alias(f"p{i}") for i, p in enumerate(points)]
    row = df.agg(*aggs)
    stack = ", ".join(f"{float(p)}D, p{i}" for i, p in enumerate(points))
    return row.selectExpr(f"stack({len(points)}, {stack}) AS (point, density)")


def column_cosine(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact cosine similarity of every column pair i < j, from one
    aggregate of dot products and norms (no row pairs)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    aggs = [F.sum(F.col(a) * F.col(b)).alias(f"d|{a}|{b}") for a, b in pairs]
    aggs += [F.sqrt(F.sum(F.col(c) * F.col(c))).alias(f"n|{c}") for c in cols]
    row = df.agg(*aggs)
    parts = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                      (F.col(f"`d|{a}|{b}`") / (F.col(f"`n|{a}`") * F.col(f"`n|{b}`"))).alias("similarity"))
             for a, b in pairs]
    return row.select(F.explode(F.array(*parts)).alias("p")).select("p.*")


def _rows_of(df: DataFrame, vec: str) -> Column:
    kind = dict(df.dtypes)[vec]
    return F.col(vec).cast("array<double>") if kind.startswith("array") else vector_to_array(F.col(vec))


def column_norms(df: DataFrame, vec: str) -> list[float]:
    """Norm of every column of the row matrix: as many numbers as there are columns."""
    found = df.select(F.posexplode(_rows_of(df, vec)).alias("i", "v")).groupBy("i").agg(
        F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("n")).collect()
    norms = [0.0] * (max((r["i"] for r in found), default=-1) + 1)
    for r in found:
        norms[r["i"]] = r["n"] or 0.0
    return norms


def dimsum_rates(norms: list[float], threshold: float) -> list[float]:
    """Probability that an entry of each column is kept:
    min(1, sqrt(gamma) / norm) with gamma = 10 log(columns) / threshold."""
    root = math.sqrt(10 * math.log(max(len(norms), 2)) / threshold)
    return [min(1.0, root / n) if n else 1.0 for n in norms]


def column_cosine_approx(df: DataFrame, vec: str, threshold: float = 0.1, seed: int = 42,
                         key: list[str] | None = None) -> DataFrame:
    """Column cosine similarities by DIMSUM sampling (i < j, long form).

    Each row keeps its entry i with the probability p_i of ``dimsum_rates`` and
    emits, for every kept pair, x_i x_j / (n_i n_j p_i p_j), with n the
    column norms (one aggregate): an unbiased estimate of the
    cosine whose error is bounded for pairs above ``threshold``.  Coins are hashes of
    the row's ``key`` columns (default: its values) and the column number: they do not depend on how
    rows lie in files or tasks, so a retry or another layout draws the same sample.  Rows
    alike in their key share their coins, so name a unique key where there is one."""
    x = _rows_of(df, vec)
    rows = df.select(x.alias("x"), F.xxhash64(*(key or [x])).alias("_row"))
    norms = column_norms(rows, "x")
    if not norms:
        return df.sparkSession.createDataFrame([], "i int, j int, similarity double")
    rates = dimsum_rates(norms, threshold)
    p = F.array(*[F.lit(v) for v in rates])
    scale = F.array(*[F.lit(1.0 / (n * q) if n else 0.0) for n, q in zip(norms, rates)])
    coin = lambda i: F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("_row"), i), 11) / F.lit(float(1 << 53))
    entries = F.filter(F.transform("x", lambda a, i: F.struct(i.alias("i"), (a * scale[i]).alias("a"))),
                       lambda e: (e["a"] != 0) & (coin(e["i"]) < p[e["i"]]))
    kept = rows.select(entries.alias("k"))
    pairs = kept.select(F.explode(F.flatten(F.transform(
        "k", lambda e1: F.transform(F.filter("k", lambda e2: e2["i"] > e1["i"]),
                                    lambda e2: F.struct(e1["i"].alias("i"), e2["i"].alias("j"),
                                                        (e1["a"] * e2["a"]).alias("w")))))).alias("e")).select("e.*")
    return pairs.groupBy("i", "j").agg(F.sum("w").alias("similarity"))


def column_cosine_vec(df: DataFrame, vec: str) -> DataFrame:
    """Exact column cosines of a vector column (i < j, long form), from one Gram aggregate."""
    g = gram(df, vec)
    n = [math.sqrt(g[i][i]) for i in range(len(g))]
    return df.sparkSession.createDataFrame(
        [(i, j, float(g[i][j] / (n[i] * n[j]))) for i in range(len(g)) for j in range(i + 1, len(g)) if n[i] and n[j]],
        "i int, j int, similarity double")


def dimsum_error(df: DataFrame, vec: str, threshold: float, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """(pairs, mean_absolute_error) of the sampled cosines against the exact
    ones; a pair the sample misses counts as 0."""
    exact = column_cosine_vec(df, vec)
    found = column_cosine_approx(df, vec, threshold, seed, key).withColumnRenamed("similarity", "estimate")
    gap = F.abs(F.col("similarity") - F.coalesce("estimate", F.lit(0.0)))
    return exact.join(found, ["i", "j"], "left").agg(F.count(F.lit(1)).alias("pairs"), F.avg(gap).alias("mean_absolute_error"))


def gram(df: DataFrame, vec: str) -> "np.ndarray":
    """A^T A of the row matrix in one aggregate: each row contributes its
    outer product x x^T (a d*d vector built by expressions), summed by the
    vector Summarizer.  Only the d x d result reaches the driver."""
    import numpy as np
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer
    x = vector_to_array(F.col(vec)) if dict(df.dtypes)[vec] != "array<double>" else F.col(vec)
    outer = F.flatten(F.transform(x, lambda a: F.transform(x, lambda b: a * b)))
    g = df.select(array_to_vector(outer).alias("_g")).agg(Summarizer.sum(F.col("_g")).alias("s")).first()["s"]
    arr = g.toArray()
    d = int(round(len(arr) ** 0.5))
    return np.asarray(arr).reshape(d, d)


def svd(df: DataFrame, vec: str, k: int, compute_u: bool = False):
    """Top-k singular values and right singular vectors of the row matrix
    from the eigen-decomposition of A^T A (d x d, on the driver); U, when
    asked for, is the distributed projection A V diag(1/s).
    Returns (s as list, V as d x k array, U DataFrame or None)."""
    import numpy as np
    w, vecs = np.linalg.eigh(gram(df, vec))
    order = np.argsort(w)[::-1][:k]
    s_vals = np.sqrt(np.clip(w[order], 0, None))
    v = vecs[:, order]
    u = None
    if compute_u:
        x = vector_to_array(F.col(vec)) if dict(df.dtypes)[vec] != "array<double>" else F.col(vec)
        cols = []
        for j in range(v.shape[1]):
            wj = F.array(*[F.lit(float(c)) for c in v[:, j] / (s_vals[j] or 1.0)])
            cols.append(F.aggregate(F.zip_with(x, wj, lambda a, b: a * b), F.lit(0.0), lambda acc, t: acc + t))
        u = df.select(F.array(*cols).alias("u"))
    return list(s_vals), v, u


def row_pca(df: DataFrame, vec: str, k: int):
    """Principal components of the rows (d x k), via pyspark.ml PCA."""
    from pyspark.ml.feature import PCA
    return PCA(k=k, inputCol=vec).fit(df.select(vec)).pc.toArray()


def project_rows(df: DataFrame, vec: str, k: int, out: str = "projected") -> DataFrame:
    """``df`` with each row's coordinates along the first ``k`` principal
    components; only the components (d x k) reach the tasks."""
    pc = row_pca(df, vec, k)
    x = vector_to_array(F.col(vec)) if dict(df.dtypes)[vec] != "array<double>" else F.col(vec)
    axes = F.array(*[F.array(*[F.lit(float(v)) for v in pc[:, j]]) for j in range(pc.shape[1])])
    along = F.transform(axes, lambda w: F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda s, t: s + t))
    return df.withColumn(out, along)
