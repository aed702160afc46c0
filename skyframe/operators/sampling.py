"""Sampling: random split, Bernoulli / Poisson samples, fixed-size samples,
stratified samples (approximate and exact).

Randomness comes from a seeded hash of the row's key columns wherever the
result must be reproducible, so a task recomputed after an executor loss
draws the same rows again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCALE = float(2 ** 53)


def unit_hash(cols: list[str], seed: int) -> Column:
    """Deterministic pseudo-uniform value in [0, 1) from key columns."""
    h = F.xxhash64(F.lit(seed), *[F.col(c) for c in cols])
    return F.shiftright(h, 11).bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / F.lit(_SCALE)


def split(df: DataFrame, weights: list[float], seed: int = 42, key: list[str] | None = None):
    """Random split.  With ``key`` the split is a stable function of the key
    (``hash < cumulative weight``), reproducible by SQL; otherwise
    ``randomSplit``."""
    if key is None:
        return df.randomSplit(weights, seed)
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        bounds.append((acc / total, (acc + w) / total))
        acc += w
    u = unit_hash(key, seed)
    return [df.filter((u >= lo) & (u < hi)) for lo, hi in bounds]


def sample(df: DataFrame, fraction: float, replace: bool = False, seed: int = 42) -> DataFrame:
    return df.sample(withReplacement=replace, fraction=fraction, seed=seed)


def take_sample(df: DataFrame, n: int, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """Exactly ``min(n, count)`` rows: the n smallest seeded hashes (a
    top-n heap per task, never a global sort)."""
    u = unit_hash(key or df.columns, seed)
    return df.withColumn("_u", u).orderBy("_u").limit(n).drop("_u")


def by_key(df: DataFrame, key: str, fractions: dict, seed: int = 42) -> DataFrame:
    """Independent coin per row with a per-key probability."""
    return df.stat.sampleBy(key, fractions, seed)


def _hash53(cols: list[str], seed: int) -> Column:
    return F.shiftright(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), 11) \
        .bitwiseAND(F.lit((1 << 53) - 1))


def by_key_exact(df: DataFrame, key: str, fractions: dict, seed: int = 42,
                 order: list[str] | None = None, bits: int = 10,
                 max_exact_group: int = 200_000) -> DataFrame:
    """Exactly ``ceil(fraction * n_key)`` rows per key: the rows with the
    smallest seeded 53-bit hash in each key (ties by the row itself).

    No window over a whole key: a histogram over the next ``bits`` bits of
    the hash per (key, bin) -- one aggregate with bounded output -- finds
    the bin where each key's quota is crossed.  Rows in lower bins are taken
    whole; the crossing bin is refined by the next bits until it holds at
    most ``max_exact_group`` rows, and only then ranked by a window.  A key
    holding a third of the table is split ``2**bits`` ways per round.
    """
    from pyspark.sql import Window

    from skyframe.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    frac = F.create_map(*[x for k, v in fractions.items() for x in (F.lit(k), F.lit(float(v)))])
    d = (df.withColumn("_h", _hash53(order or df.columns, seed))
           .withColumn("_f", frac[F.col(key)]).filter(F.col("_f").isNotNull()))
    quota = (d.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first("_f").alias("_f"))
              .select(key, F.ceil(F.col("_f") * F.col("_n")).cast("long").alias("_need")))
    # per key: the hash prefix still undecided (``_p`` over the top
    # ``used`` bits) and the rows still needed from it
    state = quota.select(key, F.lit(0).cast("long").alias("_p"), "_need")
    parts, used = [], 0
    while used < 53:
        step = min(bits, 53 - used)
        shift_p, shift_b = 53 - used, 53 - used - step
        cand = (d.join(state, key)
                 .filter(F.shiftright("_h", shift_p) == F.col("_p"))
                 .withColumn("_b", F.shiftright("_h", shift_b).bitwiseAND(F.lit((1 << step) - 1))))
        hist = cand.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_c"), F.first("_need").alias("_need"),
                                            F.first("_p").alias("_p"))
        w = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0)))
        cross = hist.filter((F.col("_before") < F.col("_need"))
                            & (F.col("_before") + F.col("_c") >= F.col("_need"))).checkpoint(eager=True)
        bound = cross.select(key, F.col("_b").alias("_bx"))
        parts.append(cand.join(bound, key).filter(F.col("_b") < F.col("_bx"))
                         .drop("_b", "_bx", "_p", "_need"))
        used += step
        state = cross.select(key, (F.shiftleft("_p", step) + F.col("_b")).alias("_p"),
                             (F.col("_need") - F.col("_before")).alias("_need"), "_c")
        if state.filter(F.col("_c") > max_exact_group).limit(1).count() == 0:
            break
    state = state.drop("_c")
    last = d.join(state, key).filter(F.shiftright("_h", 53 - used) == F.col("_p"))
    wr = Window.partitionBy(key).orderBy("_h", *df.columns)
    last = last.withColumn("_r", F.row_number().over(wr)).filter(F.col("_r") <= F.col("_need"))
    parts.append(last.drop("_r", "_p", "_need"))
    out = parts[0]
    for t in parts[1:]:
        out = out.unionByName(t)
    return out.drop("_h", "_f")
