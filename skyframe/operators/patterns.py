"""Frequent patterns: FP-growth itemsets, association rules (from a model or
from a given itemset table), rule-based prediction, PrefixSpan."""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, LongType, StringType, StructField, StructType

from skyframe.session import checkpoint_dir, ship_package

MOST_COUNTS, CHUNK_COUNTS = 16_000_000, 50_000       # counts that a task holds, and that it sends as one value


def fpgrowth(df: DataFrame, items: str = "items", min_support: float = 0.3,
             min_confidence: float = 0.8, partitions: int | None = None):
    """Fit FP-growth (parallel FP-growth: conditional trees per item are
    built in separate tasks)."""
    fp = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=min_confidence)
    if partitions:
        fp.setNumPartitions(partitions)
    return fp.fit(df)


def itemsets(df: DataFrame, items: str = "items", min_support: float = 0.3) -> DataFrame:
    """(items sorted, freq)."""
    m = fpgrowth(df, items, min_support)
    return m.freqItemsets.select(F.array_sort("items").alias("items"), "freq")


def rules(model, min_confidence: float | None = None) -> DataFrame:
    """(antecedent, consequent, confidence, lift, support) of a fitted model."""
    r = model.associationRules
    if min_confidence is not None:
        r = r.filter(F.col("confidence") >= min_confidence)
    return r.select(F.array_sort("antecedent").alias("antecedent"), "consequent", "confidence", "lift", "support")


def rules_from(itemsets_df: DataFrame, min_confidence: float) -> DataFrame:
    """Rules with a single-item consequent from an (items, freq) table:
    for each itemset and each of its items c, antecedent = items - c,
    confidence = freq(items) / freq(antecedent)."""
    sets = itemsets_df.select(F.array_sort("items").alias("items"), "freq")
    cand = (sets.filter(F.size("items") >= 2)
                .select("items", "freq", F.explode("items").alias("consequent"))
                .withColumn("antecedent", F.array_sort(F.array_except("items", F.array("consequent")))))
    ante = sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("ante_freq"))
    r = cand.join(ante, "antecedent").withColumn("confidence", F.col("freq") / F.col("ante_freq"))
    return r.filter(F.col("confidence") >= min_confidence).select(
        "antecedent", F.array("consequent").alias("consequent"), "confidence")


def predict(model, df: DataFrame) -> DataFrame:
    """Consequents of rules whose antecedent is in the basket, minus the
    items already there."""
    return model.transform(df)


def sequences(df: DataFrame, col: str = "sequence", min_support: float = 0.5,
              max_len: int = 5, max_local_db: int = 32_000_000) -> DataFrame:
    """Frequent sequential patterns (PrefixSpan) of up to ``max_len`` items.

    Prefixes grow by one item a round, in all tasks at once.  A task holds its sequences
    as bitmaps: per item and sequence a bit for every itemset with the item.  A prefix is
    where its last itemset can end; an item that starts a new itemset must lie after the
    first of these places, an item of the same itemset in one of them.  Tasks count every
    frequent prefix with every frequent item; only frequent ones come back.  There are at
    most (mean items of a sequence) / ``min_support`` frequent items, so bitmaps stay
    small; at most ``max_local_db`` bytes of them are made at once.

    Itemsets that repeat an item, and items other than strings, whole numbers and dates, go
    through the ML estimator, which takes ``max_local_db`` as items of a projected database."""
    spark = df.sparkSession
    ship_package(spark)
    kind = df.schema[col].dataType
    base = f"{checkpoint_dir(spark)}/sequences-{uuid.uuid4().hex}"
    df.select(F.col(col).alias("s")).filter("s is not null").write.parquet(f"{base}/rows")
    rows = spark.read.parquet(f"{base}/rows")
    odd = F.exists("s", lambda x: x.isNull() | (F.size(F.array_distinct(x)) < F.size(x)))
    total, repeats = rows.agg(F.count(F.lit(1)), F.max(odd)).first()
    if repeats or not isinstance(kind.elementType.elementType, (StringType, IntegralType, DateType)):
        ps = PrefixSpan(minSupport=min_support, maxPatternLength=max_len, maxLocalProjDBSize=max_local_db, sequenceCol="s")
        return ps.findFrequentSequentialPatterns(rows)
    least = max(1, math.ceil(min_support * total))
    items = (rows.select(F.explode(F.array_distinct(F.flatten("s"))).alias("item")).groupBy("item")
                 .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).orderBy(F.desc("n"), "item").toArrow())
    names = items["item"].combine_chunks()
    parts = max(1, min(-(-total // 2000), 2 * spark.sparkContext.defaultParallelism))
    (rows.repartition(parts).mapInArrow(_coded(names), "sets binary, sizes binary, items binary")
         .write.parquet(f"{base}/coded"))
    coded = spark.read.parquet(f"{base}/coded").repartition(parts)
    # a pattern is a row of steps: item + 1 in a new itemset, -(item + 1) in the same one
    steps = np.arange(1, len(names) + 1, dtype=np.int32)[:, None]
    found = [(steps, items["n"].to_numpy())]
    while len(steps) and steps.shape[1] < max_len:
        longer = [_extended(coded, steps[a:a + MOST_COUNTS // (2 * len(names)) + 1], len(names), least, max_local_db)
                  for a in range(0, len(steps), MOST_COUNTS // (2 * len(names)) + 1)]
        steps, n = (np.concatenate(x) for x in zip(*longer))
        found.append((steps, n))
    values, out = names.to_pylist(), []
    for steps, n in found:
        for row, freq in zip(steps.tolist(), n.tolist()):
            sets: list[list] = []
            for step in row:
                if step > 0:
                    sets.append([])
                sets[-1].append(values[abs(step) - 1])
            out.append((sets, freq))
    return spark.createDataFrame(out, StructType([StructField("sequence", kind, False),
                                                   StructField("freq", LongType(), False)]))


def _coded(names):
    """Batches of sequences -> itemsets of each, items of each itemset, and frequent
    items by number (others: -1), as arrays."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch in batches:
            sequences_ = batch.column(0)
            sets = sequences_.flatten()
            values = sets.flatten()
            code = pc.index_in(values, value_set=names.cast(values.type)).fill_null(-1)
            yield pa.RecordBatch.from_arrays([pa.array([x.to_numpy(zero_copy_only=False).astype(np.int32).tobytes()], pa.binary())
                                              for x in (pc.list_value_length(sequences_), pc.list_value_length(sets), code)],
                                             names=["sets", "sizes", "items"])
    return run


def _bitmaps(sets: np.ndarray, sizes: np.ndarray, items: np.ndarray, n_items: int, limit: int):
    """Bitmaps (item, sequence, word) of sequences of like length, at most ``limit``
    bytes at once unless a single sequence has more."""
    row = np.repeat(np.repeat(np.arange(len(sets)), sets), sizes)
    place = np.repeat(np.arange(len(sizes)) - np.repeat(np.cumsum(sets) - sets, sets), sizes)
    row, place, items = row[items >= 0], place[items >= 0], items[items >= 0].astype(np.int64)
    words = np.maximum(1, (sets + 63) // 64).astype(np.int64)
    order = np.argsort(words, kind="stable")
    at, start = np.empty(len(sets), np.int64), 0
    at[order] = np.arange(len(sets))
    while start < len(sets):
        fits = np.arange(1, len(sets) - start + 1) * words[order[start:]] * n_items * 8 <= limit
        n = max(1, int(np.argmin(fits)) if not fits.all() else len(fits))
        width = int(words[order[start + n - 1]])
        some = (at[row] >= start) & (at[row] < start + n)
        key = (items[some] * n + at[row[some]] - start) * width + (place[some] >> 6)
        by_key = np.argsort(key, kind="stable")
        key, bit = key[by_key], np.uint64(1) << (place[some][by_key] & 63).astype(np.uint64)
        maps = np.zeros(n_items * n * width, np.uint64)
        edge = np.flatnonzero(np.diff(key, prepend=-1))
        if len(edge):
            maps[key[edge]] = np.bitwise_or.reduceat(bit, edge)
        yield maps.reshape(n_items, n, width)
        start += n


def _after(bits: np.ndarray) -> np.ndarray:
    """All places after the first one set, by row."""
    out = ~(bits ^ (bits - np.uint64(1)))
    if bits.shape[1] > 1:
        earlier = np.logical_or.accumulate(bits != 0, axis=1)[:, :-1]
        out[:, 1:][earlier] = ~np.uint64(0)
    return out


def _support(maps: np.ndarray) -> np.ndarray:
    """In how many rows each item has a place."""
    some = maps[..., 0] != 0 if maps.shape[2] == 1 else (maps != 0).any(axis=2)
    return np.count_nonzero(some, axis=1)


def _count(maps: np.ndarray, patterns: list[list[int]], total: np.ndarray) -> None:
    """Add to ``total`` (pattern, new or same itemset, item) the rows with each longer pattern."""
    path: list = []                          # steps of the last pattern: step, rows that have it, places of its end
    for p, steps in enumerate(patterns):
        same = 0
        while same < len(path) and path[same][0] == steps[same]:
            same += 1
        del path[same:]
        for step in steps[same:]:
            item = abs(step) - 1
            if path:
                rows, bits = path[-1][1:]
                bits = (_after(bits) if step > 0 else bits) & maps[item, rows]
            else:
                rows, bits = np.arange(maps.shape[1]), maps[item]
            live = bits.any(axis=1)
            path.append((step, rows[live], bits[live]))
        _, rows, bits = path[-1]
        if len(rows):
            some, last = maps[:, rows], abs(steps[-1])
            total[p, 0] += _support(some & _after(bits))
            total[p, 1, last:] += _support(some[last:] & bits)


def _extended(coded: DataFrame, steps: np.ndarray, n_items: int, least: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent patterns one item longer than ``steps``, and their counts."""
    steps = steps[np.lexsort(steps.T[::-1])]           # patterns with a common prefix side by side
    shared = coded.sparkSession.sparkContext.broadcast(steps)
    chunk = max(1, CHUNK_COUNTS // (2 * n_items))

    def count(batches):
        import pyarrow as pa
        total = np.zeros((len(shared.value), 2, n_items), np.int64)
        patterns = shared.value.tolist()
        for batch in batches:
            for block in batch.to_pylist():
                arrays = (np.frombuffer(block[c], np.int32) for c in ("sets", "sizes", "items"))
                for maps in _bitmaps(*arrays, n_items, limit):
                    _count(maps, patterns, total)
        firsts = range(0, len(total), chunk)
        yield pa.RecordBatch.from_arrays([pa.array(firsts, pa.int64()),
                                          pa.array([total[a:a + chunk].tobytes() for a in firsts], pa.binary())],
                                         names=["first", "counts"])

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in pdf["counts"])
        at = np.flatnonzero(total >= least)
        pattern, step = np.divmod(at, 2 * n_items)
        return pd.DataFrame({"pattern": pdf["first"].iloc[0] + pattern, "step": np.where(step < n_items, step + 1, n_items - 1 - step),
                             "n": total[at]})

    grown = (coded.mapInArrow(count, "first long, counts binary").groupBy("first")
                  .applyInPandas(summed, "pattern long, step int, n long").toArrow())
    shared.unpersist()
    return (np.column_stack([steps[grown["pattern"].to_numpy()], grown["step"].to_numpy()]).astype(np.int32),
            grown["n"].to_numpy())
