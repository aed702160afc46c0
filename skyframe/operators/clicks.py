"""Click-stream analytics: page views, error rates, active users, users seen.

Input: (url, status, zip, user_id, ts).  Windowed forms use ``window()``:
the same expression is incremental under Structured Streaming and a plain
Expand + aggregate in batch.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.plans.joins import broadcast_if_small

ERROR_FLAG_THRESHOLD = 0.05


def page_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("url").agg(F.count(F.lit(1)).alias("views"))


def page_counts_windowed(df: DataFrame, win: str, slide: str) -> DataFrame:
    return (df.groupBy(F.window("ts", win, slide).alias("w"), "url")
              .agg(F.count(F.lit(1)).alias("views"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "url", "views"))


def _error_cols(n, errors):
    rate = errors / n
    return [rate.alias("error_rate"),
            F.when(rate > ERROR_FLAG_THRESHOLD, F.format_string("**%.4f**", rate))
             .otherwise(F.format_string("%.4f", rate)).alias("flag")]


def error_rate(df: DataFrame, key: str = "zip") -> DataFrame:
    """(n - n(status = 200)) / n per key; flagged when above 5%."""
    agg = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                              F.sum(F.when(F.col("status") != 200, 1).otherwise(0)).alias("errors"))
    return agg.select(key, "n", "errors", *_error_cols(F.col("n"), F.col("errors")))


def error_rate_windowed(df: DataFrame, win: str, slide: str, key: str = "zip") -> DataFrame:
    agg = (df.groupBy(F.window("ts", win, slide).alias("w"), key)
             .agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.when(F.col("status") != 200, 1).otherwise(0)).alias("errors")))
    return agg.select(F.col("w.start").alias("window_start"), key, "n", "errors",
                      (F.col("errors") / F.col("n")).alias("error_rate"))


def active_users(df: DataFrame, win: str, slide: str, approx: bool = False) -> DataFrame:
    """Distinct users per window (approximate on streams, where exact
    distinct counts are not supported)."""
    d = F.approx_count_distinct("user_id") if approx else F.count_distinct("user_id")
    return (df.groupBy(F.window("ts", win, slide).alias("w"))
              .agg(d.alias("active_users"))
              .select(F.col("w.start").alias("window_start"), "active_users"))


def users_seen(df: DataFrame, users: DataFrame, k: int | None = 10) -> DataFrame:
    """Distinct users of the stream that appear in ``users`` (user_id, name),
    first k by user id."""
    seen = df.select("user_id").distinct().join(broadcast_if_small(users), "user_id")
    seen = seen.orderBy("user_id")
    return seen.limit(k) if k else seen


WINDOWS_PER_BLOCK = 96
USER_BUCKETS = 64
ENTRIES_AT_ONCE = 200_000          # entries a task holds as it packs or counts them


def window_users(df: DataFrame, win: str, slide: str) -> DataFrame:
    """(window, user) pairs with their event counts: the streaming state
    from which exact distinct users per window follow.

    On a stream a row of state a pair would cost far more than what it says.  There the state has a row per block of
    consecutive windows and bucket of users, with packed lists of (pane, user, events), a pane being
    the time that the same windows cover; an event is kept once, or twice where its windows lie in two blocks."""
    if not df.isStreaming:
        return (df.groupBy(F.window("ts", win, slide).alias("w"), "user_id")
                  .agg(F.count(F.lit(1)).alias("events"))
                  .select(F.col("w.start").alias("window_start"), "user_id", "events"))
    length, step = df.sparkSession.sql(f"SELECT unix_micros(timestamp_micros(0) + CAST('{win}' AS INTERVAL)), "
                                       f"unix_micros(timestamp_micros(0) + CAST('{slide}' AS INTERVAL))").first()
    pane = math.gcd(length, step)
    panes = df.select(F.window("ts", f"{pane} microseconds").alias("w"), "user_id").select(
        F.col("w.start").alias("pane"), F.pmod(F.xxhash64("user_id"), F.lit(USER_BUCKETS)).cast("int").alias("bucket"), "user_id")
    time, user = (dict(panes.dtypes)[c] for c in ("pane", "user_id"))
    packed = panes.mapInArrow(_pack_panes(length, step), f"block long, bucket int, panes array<{time}>, users array<{user}>, events array<long>")
    kept = packed.groupBy("block", "bucket").agg(F.collect_list(F.struct("panes", "users", "events")).alias("parts"))
    return (kept.select("block", "bucket", F.explode("parts").alias("p")).select("block", "bucket", "p.*")
                .mapInArrow(_count_windows(length, step), f"window_start {time}, user_id {user}, events long"))


def _micros(times: pa.Array) -> np.ndarray:
    return times.cast(pa.int64()).to_numpy(zero_copy_only=False)


def _pack_panes(length: int, step: int):
    """Rows of (pane, bucket, user) -> their counts, in lists by the blocks of the windows that cover the pane."""
    def lists(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).group_by(["pane", "bucket", "user_id"]).aggregate([([], "count_all")]).combine_chunks()
        at = _micros(t["pane"].combine_chunks())
        last = at // step // WINDOWS_PER_BLOCK
        first = ((at - length) // step + 1) // WINDOWS_PER_BLOCK
        spans = last - first + 1
        rows = np.repeat(np.arange(len(at)), spans)
        block = first[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(spans) - spans, spans)
        bucket = t["bucket"].to_numpy()[rows]
        order = np.lexsort((bucket, block))
        block, bucket, rows = block[order], bucket[order], pa.array(rows[order])
        starts = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (bucket[1:] != bucket[:-1])])
        offsets = pa.array(np.r_[starts, len(block)], pa.int32())
        out = {"block": pa.array(block[starts], pa.int64()), "bucket": pa.array(bucket[starts], pa.int32())}
        for name, c in (("panes", "pane"), ("users", "user_id"), ("events", "count_all")):
            values = t[c].combine_chunks().take(rows)
            out[name] = pa.ListArray.from_arrays(offsets, values)
        return pa.RecordBatch.from_pydict(out)

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= ENTRIES_AT_ONCE:
                yield lists(held)
                held = []
        if held:
            yield lists(held)
    return run


def _count_windows(length: int, step: int):
    """Lists of (pane, user, events), those of a block and bucket one after the other -> the pairs of their windows."""
    def pairs(held: list[pa.RecordBatch]):
        def flat(name):
            return pa.concat_arrays([b.column(name).flatten() for b in held])
        sizes = np.concatenate([b.column("panes").value_lengths().to_numpy() for b in held])
        block = np.repeat(np.concatenate([b.column("block").to_numpy() for b in held]), sizes)
        panes, users, events = flat("panes"), flat("users"), flat("events")
        at = _micros(panes)
        rows, starts = [], []
        for back in range(-(-length // step)):
            window = at // step - back
            inside = np.flatnonzero((window * step > at - length) & (window // WINDOWS_PER_BLOCK == block))
            rows.append(inside)
            starts.append(window[inside] * step)
        rows = pa.array(np.concatenate(rows))
        t = pa.table({"window_start": pa.array(np.concatenate(starts)).cast(panes.type), "user_id": users.take(rows), "events": events.take(rows)})
        t = t.group_by(["window_start", "user_id"]).aggregate([("events", "sum")])
        yield from t.select(["window_start", "user_id", "events_sum"]).rename_columns(["window_start", "user_id", "events"]).to_batches(50_000)

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            begun = 0
            sizes = batch.column("panes").value_lengths().to_pylist()
            for i, key in enumerate(zip(batch.column("block").to_pylist(), batch.column("bucket").to_pylist())):
                if key != last and size >= ENTRIES_AT_ONCE:      # a pair's parts are all of one block and bucket
                    yield from pairs([*held, batch.slice(begun, i - begun)])
                    held, size, begun = [], 0, i
                last, size = key, size + sizes[i]
            if begun < batch.num_rows:
                held.append(batch.slice(begun))
        if held:
            yield from pairs(held)
    return run


def active_users_from_pairs(pairs: DataFrame) -> DataFrame:
    """Exact distinct users per window from ``window_users`` (inside
    foreachBatch on a stream, where a distinct count is not allowed)."""
    return pairs.groupBy("window_start").agg(F.count(F.lit(1)).alias("active_users"))
