"""Join and aggregation helpers that keep shuffles bounded.

* ``broadcast_if_small`` hints a broadcast only when the optimizer's size
  estimate of the side is under a limit; otherwise the join is left to
  Spark (sort-merge, with AQE free to switch to broadcast at runtime when
  the real size turns out small).
* ``salted_agg`` spreads one hot key over ``buckets`` tasks before the final
  merge, for aggregates whose partial form is not already combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 32 MB: comfortably inside executor memory on every node, small enough
# that shipping it to 1000 executors costs less than one shuffle of the
# large side.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate of a plan, or None when unavailable."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(stats.sizeInBytes().toString())
    except Exception:  # Spark Connect or a plan without statistics
        return None


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its estimated size is known and below ``limit``."""
    size = estimated_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose row count is fixed by construction (a code list,
    the 25 nations, a model's k centres).  Still checked, so a caller who
    passes a large table by mistake gets a normal join."""
    return broadcast_if_small(df)


def salted_agg(df: DataFrame, keys: list[str], aggs: dict[str, tuple[str, Column]],
               buckets: int = 32, salt_source: Column | None = None) -> DataFrame:
    """Two-stage aggregation: (keys, salt) then keys.

    ``aggs`` maps an output name to (merge function, partial expression),
    where the merge function is ``sum``, ``min`` or ``max`` -- the set of
    aggregates whose partial results merge exactly.  A key holding a third
    of all rows is handled by ``buckets`` tasks in the first stage.
    """
    # a hash of the row, not rand(): a recomputed task after an executor
    # loss must put every row in the same bucket again
    source = salt_source if salt_source is not None else F.xxhash64(*df.columns)
    salted = df.withColumn("_salt", F.pmod(source, F.lit(buckets)))
    first = salted.groupBy(*keys, "_salt").agg(
        *[expr.alias(name) for name, (_, expr) in aggs.items()])
    merge = {"sum": F.sum, "min": F.min, "max": F.max}
    return first.groupBy(*keys).agg(
        *[merge[m](F.col(name)).alias(name) for name, (m, _) in aggs.items()])


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Keys holding more than ``share`` of the rows (at most 1 / share of
    them exist).  One partial-aggregated count per key, filtered on the
    executors; only the hot keys reach the driver."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    rows = counts.filter(F.col("_n") > share * total).collect()      # at most 1 / share keys
    return [r[key] for r in rows]


def skew_join(big: DataFrame, other: DataFrame, key: str, how: str = "inner", share: float = 0.01,
              buckets: int = 32) -> DataFrame:
    """Equi-join on ``key`` that spreads hot keys.

    Rows of ``big`` with a hot key get a salt (hash of the row mod
    ``buckets``); the matching rows of ``other`` are copied once per salt,
    so each hot key is joined by ``buckets`` tasks.  Cold keys join
    normally.  ``how`` is inner or left (rows of ``big`` are kept)."""
    hot = hot_keys(big, key, share)
    if not hot:
        return big.join(other, key, how)
    is_hot = F.col(key).isin(hot)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(buckets))
    big_hot = big.filter(is_hot).withColumn("_salt", salt)
    other_hot = other.filter(is_hot).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    hot_part = big_hot.join(other_hot, [key, "_salt"], how).drop("_salt")
    cold_part = big.filter(~is_hot | F.col(key).isNull()).join(other.filter(~is_hot), key, how)
    return hot_part.unionByName(cold_part)


# ``keyed_join``: below the first number of rows no key is worth a plan of its
# own; a key counts as hot from the share 1 / HOT_KEYS of all rows, so
# there are at most HOT_KEYS of them.
HOT_ROWS, HOT_KEYS = 200_000, 10_000


def keyed_join(rows: DataFrame, keyed: DataFrame, key: str, total: int, how: str = "inner",
               least: int = HOT_ROWS, most: int = HOT_KEYS) -> DataFrame:
    """``rows`` joined with ``keyed``, which has one row per key; ``how`` is
    inner or left.

    Keys that hold more than ``total / most`` of the rows never meet in one
    task: there are at most ``most`` of them, so their rows of ``keyed`` are
    broadcast and the rows stay where they are.  All others are joined by a
    shuffle in which no key is larger than that share.  ``total`` is the number
    of rows; ``rows`` should be materialised, as it is read up to three times."""
    if total <= least:
        return rows.join(keyed, key, how)
    limit = max(least, total // most)
    hot = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select(key)
    keys = [r[0] for r in hot.collect()]                              # at most ``most`` keys
    if not keys:
        return rows.join(keyed, key, how)
    listed = F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in keys], rows.select(key).schema))
    few = F.broadcast(listed.join(keyed, key, how))
    cold = rows.join(listed, key, "left_anti").join(keyed, key, how)
    return rows.join(few, key).unionByName(cold)
