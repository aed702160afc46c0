"""Relational operators: projection, filters, joins, aggregates, ordering,
set operations and row numbering -- all as DataFrame expressions so that
Catalyst pushes filters and column pruning into the scans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.plans.joins import broadcast_if_small, salted_agg


def _c(c):
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- projection
def project(df: DataFrame, cols: list) -> DataFrame:
    return df.select(*cols)


def add_const(df: DataFrame, col: str, k, name: str | None = None) -> DataFrame:
    """``col + k``; null stays null."""
    return df.withColumn(name or f"{col}_plus_{k}", F.col(col) + F.lit(k))


def format_rows(df: DataFrame, fmt: str, cols: list[str], name: str = "line") -> DataFrame:
    """printf-style text per row, e.g. ``'Key: %d, Value: %s'``."""
    return df.select(F.format_string(fmt, *[F.col(c) for c in cols]).alias(name))


def row_map(df: DataFrame, cols: list[str], name: str = "values_map") -> DataFrame:
    """Row -> JSON object of the named columns (a string map of name -> value)."""
    return df.select(F.to_json(F.struct(*cols)).alias(name))


def unpivot_pair(df: DataFrame, a: str, b: str, name: str = "value") -> DataFrame:
    """One row per input row and column: (a), (b)."""
    return df.select(F.explode(F.array(F.col(a), F.col(b))).alias(name))


def cast(df: DataFrame, col: str, dtype: str, lenient: bool = True) -> DataFrame:
    """Type conversion; ``lenient`` turns unparsable text into null."""
    c = F.col(col).try_cast(dtype) if lenient else F.col(col).cast(dtype)
    return df.withColumn(col, c)


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def with_index(df: DataFrame, order_cols: list[str], name: str = "row_idx") -> DataFrame:
    """Consecutive ids 0..n-1 in ``order_cols`` order without a
    single-partition window.

    Rows are range-partitioned and sorted, written as a reliable checkpoint
    (so both passes see identical partitions even after an executor loss),
    then each row gets ``offset(partition) + position within partition``.
    Only one count per partition reaches the driver.
    """
    spark = df.sparkSession
    from skyframe.session import checkpoint_dir

    checkpoint_dir(spark)
    # as many ranges as the cluster's shuffle width (one count each)
    parts = max(1, spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions", "1")))
    ordered = (df.repartitionByRange(parts, *order_cols)
                 .sortWithinPartitions(*order_cols)
                 .withColumn("_pid", F.spark_partition_id()))
    ordered = ordered.checkpoint(eager=True)
    counts = ordered.groupBy("_pid").count().collect()   # one row per partition
    offsets, running = {}, 0
    for r in sorted(counts, key=lambda r: r["_pid"]):
        offsets[r["_pid"]] = running
        running += r["count"]
    # one row per partition
    table = spark.createDataFrame(list(offsets.items()) or [(0, 0)], "_pid int, _off long")
    # position inside a partition: monotonically_increasing_id encodes the
    # partition in its upper bits and the row position in the lower 33 bits
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return (ordered.withColumn("_local", local).join(F.broadcast(table), "_pid")
                   .withColumn(name, F.col("_off") + F.col("_local")).drop("_pid", "_off", "_local"))


# ---------------------------------------------------------------- filters
def filter_gt(df: DataFrame, col: str, v) -> DataFrame:
    return df.filter(F.col(col) > v)


def filter_lt(df: DataFrame, col: str, v) -> DataFrame:
    return df.filter(F.col(col) < v)


def filter_eq(df: DataFrame, col: str, v) -> DataFrame:
    return df.where(F.col(col) == v)


def filter_between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Inclusive on both ends."""
    return df.filter(F.col(col).between(lo, hi))


def drop_listed(df: DataFrame, col: str, block: DataFrame, block_col: str | None = None):
    """Rows whose ``col`` is not in ``block``, and the count of dropped rows.

    Returns ``(kept, dropped_count_df)``.  The block list is broadcast only
    when its size estimate is small.
    """
    bc = block_col or col
    small = broadcast_if_small(block.select(F.col(bc).alias("_blk")).distinct())
    kept = df.join(small, F.col(col) == F.col("_blk"), "left_anti")
    dropped = (df.join(small, F.col(col) == F.col("_blk"), "left_semi")
                 .agg(F.count(F.lit(1)).alias("dropped")))
    return kept, dropped


# ---------------------------------------------------------------- joins
def join_inner(a: DataFrame, b: DataFrame, on) -> DataFrame:
    return a.join(b, on, "inner")


def join_left_default(a: DataFrame, b: DataFrame, on, defaults: dict) -> DataFrame:
    """Left outer join; missing right-side values replaced by ``defaults``."""
    j = a.join(b, on, "left")
    for c, v in defaults.items():
        j = j.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return j


def lookup(df: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join against a lookup table, broadcast when its size estimate allows."""
    return df.join(broadcast_if_small(small), on, how)


# ---------------------------------------------------------------- aggregates
def group_count(df: DataFrame, key) -> DataFrame:
    """Rows per key; a null key is its own group.  Every task first counts its
    own rows, so a hot key is one row per task at the exchange and needs no salt."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count"))


def group_avg(df: DataFrame, key, cols: list[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"avg_{c}") for c in cols])


def sum_by_key(df: DataFrame, key, value: str, name: str = "total") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def distinct_count(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    if approx:
        c = F.approx_count_distinct(F.struct(*cols)) if len(cols) > 1 else F.approx_count_distinct(cols[0])
    else:
        c = F.count_distinct(*[F.col(x) for x in cols])
    return df.agg(c.alias("distinct_count"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count and share of the total per value (the total is a scalar
    subquery: one more aggregate, no join and no driver round trip)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1))).scalar()           # scalar subquery, no join
    return counts.withColumn("fraction", F.col("count") / total)


def reduce_sum(df: DataFrame, expr, name: str = "total") -> DataFrame:
    return df.agg(F.sum(_c(expr)).alias(name))


def collect_per_key(df: DataFrame, key: str, value: str, name: str = "values") -> DataFrame:
    """Sorted list of values per key.  Only for keys whose lists are bounded
    (adjacency of one page, items of one user)."""
    return df.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias(name))


# ---------------------------------------------------------------- ordering
def order(df: DataFrame, cols: list, ascending=True) -> DataFrame:
    return df.orderBy(*cols, ascending=ascending)


def top_k(df: DataFrame, col: str, k: int, asc: bool = False, tie: list[str] | None = None) -> DataFrame:
    """k rows by ``col`` (TakeOrderedAndProject: a k-row heap per task)."""
    o = F.asc(col) if asc else F.desc(col)
    return df.orderBy(o, *[F.asc(t) for t in (tie or [])]).limit(k)


def top_k_per(df: DataFrame, key: str, col: str, k: int, asc: bool = False,
              tie: list[str] | None = None, rank_name: str = "rank") -> DataFrame:
    """k rows per key, ranked 1..k.

    A plain ranked window: Spark keeps only the first k rows of a key in
    every task before the exchange, so a hot key shrinks to k rows per task
    and nothing has to be salted."""
    from pyspark.sql import Window
    o = [F.asc(col) if asc else F.desc(col)] + [F.asc(t) for t in (tie or [])]
    w = Window.partitionBy(key).orderBy(*o)
    return df.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= k)


def head(df: DataFrame, n: int, order_cols: list[str]) -> DataFrame:
    return df.orderBy(*order_cols).limit(n)


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct(df: DataFrame) -> DataFrame:
    return df.distinct()


# ---------------------------------------------------------------- typed access
def as_typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reorder and cast columns by name to ``schema`` (Dataset ``as[T]``)."""
    return df.to(schema)


def cached(df: DataFrame) -> DataFrame:
    from pyspark import StorageLevel
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def describe_shape(df: DataFrame) -> DataFrame:
    """(column count, row count, column names) as one row."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(len(df.columns)).alias("column_count"), "row_count",
        F.lit(",".join(df.columns)).alias("columns"))


def ordered_running(df: DataFrame, key: str, order: list, sums: list[str] = (),
                    rank_name: str = "rank", totals: bool = False) -> DataFrame:
    """Exact 1-based rank (and running sums of ``sums``) of each row within
    its ``key`` in ``order`` -- without a window over a whole key.
    ``totals`` adds the sums over the whole key as ``tot_<column>``, and the
    number of its rows as ``tot_rows``.

    Rows are range-partitioned on (key, order), so a key holding a third
    of the table is spread over many partitions.  Positions are counted
    inside each (key, partition) piece -- a piece never exceeds one range
    partition -- and each piece is shifted by the totals of the key's
    earlier pieces, computed on the small (key, partition) table.
    """
    from pyspark.sql import Window
    spark = df.sparkSession
    parts = max(1, spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions", "1")))
    ranged = df.repartitionByRange(parts, F.col(key), *order).withColumn("_pid", F.spark_partition_id())
    # Written once: both sides of the join below must see the same ranges,
    # also after a lost executor, and the input is read only here.
    from skyframe.session import checkpoint_dir
    checkpoint_dir(spark)
    ranged = ranged.checkpoint(eager=True)
    w = Window.partitionBy(key, "_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_lr", F.count(F.lit(1)).over(w))
    for c in sums:
        local = local.withColumn(f"_l_{c}", F.sum(c).over(w))
    pieces = local.groupBy(key, "_pid").agg(F.count(F.lit(1)).alias("_n"),
                                            *[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(key)                      # of pieces: as many rows as there are ranges
    offsets = pieces.select(key, "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                            *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
                            *([F.sum("_n").over(whole).alias("tot_rows")] if totals else []),
                            *[F.sum(f"_t_{c}").over(whole).alias(f"tot_{c}") for c in sums if totals])
    out = local.join(offsets, [key, "_pid"]).withColumn(rank_name, (F.col("_off") + F.col("_lr")).cast("long"))
    for c in sums:
        out = out.withColumn(f"cum_{c}", F.col(f"_o_{c}") + F.col(f"_l_{c}"))
    return out.drop("_pid", "_lr", "_off", *[f"_l_{c}" for c in sums], *[f"_o_{c}" for c in sums])
