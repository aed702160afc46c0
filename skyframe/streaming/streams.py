"""Structured Streaming sources, stream operators and a runner.

Operators take a streaming DataFrame and return one; the aggregations are
the same expressions as the batch operators, so the state store does the
incremental work (running counts, sliding windows, sessions).  Steps that
Structured Streaming does not allow on a stream (several aggregations in a
row, sort without aggregation) run inside ``foreachBatch``.
"""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.session import checkpoint_dir


# ---------------------------------------------------------------- sources
def socket(spark: SparkSession, host: str, port: int, include_timestamp: bool = False) -> DataFrame:
    """Lines from a TCP socket (testing only; not fault tolerant)."""
    r = spark.readStream.format("socket").option("host", host).option("port", port)
    if include_timestamp:
        r = r.option("includeTimestamp", True)
    return r.load()


def files(spark: SparkSession, path: str, fmt: str = "text", schema=None,
          max_files_per_trigger: int | None = None, **opts) -> DataFrame:
    """New files appearing in a folder (text, csv, json, parquet)."""
    r = spark.readStream.format(fmt).options(**opts)
    if schema is not None:
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def kafka(spark: SparkSession, servers: str, topics: str, mode: str = "subscribe",
          starting: str = "latest") -> DataFrame:
    """Kafka records with the value as text.  ``mode`` is subscribe,
    subscribePattern or assign; ``topics`` a comma list (or pattern/JSON).
    Needs the spark-sql-kafka package on the classpath."""
    try:
        raw = (spark.readStream.format("kafka")
                    .option("kafka.bootstrap.servers", servers).option(mode, topics)
                    .option("startingOffsets", "earliest" if starting in ("earliest", "smallest") else
                            "latest" if starting in ("latest", "largest") else starting)
                    .load())
    except Exception as e:  # noqa: BLE001
        if "kafka" in str(e).lower():
            raise RuntimeError("Kafka source needs the spark-sql-kafka-0-10 package on the classpath") from e
        raise
    return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                      "topic", "partition", "offset", "timestamp")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


FILE_BYTES = 64 << 20


def _value_bytes(df: DataFrame, name: str, kind: str):
    """Bytes of a column's value, as far as its type tells."""
    c = F.col(f"`{name}`")
    if kind in ("string", "binary"):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if kind == "vector":
        from pyspark.ml.functions import vector_to_array
        c, kind = vector_to_array(c), "array"
    return 8 * F.greatest(F.size(c), F.lit(0)) if kind.startswith("array") else F.lit(8)


def files_per_batch(df: DataFrame, n_batches: int) -> int:
    """Files of a batch, so that none holds much more than ``FILE_BYTES``.

    Rows of one table are added up, in one pass: stored text may be a small part of what it
    is in a shuffle, and the smaller the more of it repeats.  Above joins, which a second
    pass would repeat, the bytes of the tables count."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    # estimates above joins multiply and mean nothing; what has no estimate says the largest number
    known = (int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    size = sum(n for n in known if n < 1 << 62)
    if leaves.size() == 1:
        row = sum((_value_bytes(df, n, t) for n, t in df.dtypes), F.lit(0)).cast("long")
        size = max(size, df.agg(F.sum(row)).first()[0] or 0)
    return max(1, -(-size // (n_batches * FILE_BYTES)))


def replay(spark: SparkSession, df: DataFrame, n_batches: int, fmt: str = "parquet",
           folder: str | None = None, order_col: str | None = None) -> DataFrame:
    """Queue of ``n_batches`` batches: ``df`` written as files, read back as a
    file stream that takes one batch's files per trigger.  A batch has as many files as
    its size asks for, each written by its own task.

    With ``order_col`` the batches are consecutive ranges of that column
    (event time arriving in order), written one after the other so the
    stream sees them in that order -- a later range never arrives first and
    pushes the watermark past an earlier one.  The ranges come from a
    quantile sketch; they need not be equal.
    """
    folder = folder or scratch(spark, "replay")
    per_batch = files_per_batch(df, n_batches)
    if order_col:
        num = F.unix_micros(F.col(order_col).cast("timestamp")) \
            if dict(df.dtypes)[order_col].startswith("timestamp") else F.col(order_col)
        probs = [i / n_batches for i in range(1, n_batches)]
        cuts = (df.agg(F.percentile_approx(num, probs, 1000)).first()[0] or []) if probs else []
        bucket = sum((F.when(num >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
        keyed = df.withColumn("_batch", bucket)
        for i in range(n_batches):
            (keyed.filter(F.col("_batch") == i).drop("_batch").repartition(per_batch)
                  .write.mode("append").format(fmt).save(folder))
    else:
        df.repartition(n_batches * per_batch).write.mode("overwrite").format(fmt).save(folder)
    return files(spark, folder, fmt, schema=df.schema, max_files_per_trigger=per_batch)


def register_custom(spark: SparkSession, source_cls) -> str:
    """Register a Python Data Source (``pyspark.sql.datasource.DataSource``)
    and return its short name for ``readStream.format(name)``."""
    spark.dataSource.register(source_cls)
    return source_cls.name()


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


# ---------------------------------------------------------------- running
def run(df: DataFrame, mode: str, writer=None, checkpoint: str | None = None,
        fmt: str | None = None, path: str | None = None, trigger: dict | None = None,
        query_name: str | None = None):
    """Start a query; with the default ``availableNow`` trigger, wait until
    all available input is processed.  Returns the StreamingQuery."""
    spark = df.sparkSession
    w = df.writeStream.outputMode(mode).option(
        "checkpointLocation", checkpoint or scratch(spark, "stream-ckpt"))
    if query_name:
        w = w.queryName(query_name)
    if writer is not None:
        w = w.foreachBatch(writer)
    elif fmt:
        w = w.format(fmt)
        if path:
            w = w.option("path", path)
    trig = trigger or {"availableNow": True}
    q = w.trigger(**trig).start()
    if trig.get("availableNow") or trig.get("once"):
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return q


def run_until(query, predicate, poll_seconds: float = 1.0, timeout_seconds: float | None = None) -> None:
    """Stop a running query once ``predicate()`` holds (e.g. a significance
    test has decided) or the timeout passes."""
    import time
    start = time.time()
    while query.isActive:
        if predicate() or (timeout_seconds is not None and time.time() - start > timeout_seconds):
            query.stop()
            break
        time.sleep(poll_seconds)


# ---------------------------------------------------------------- operators
def split_words(stream: DataFrame, col: str = "value", sep: str = " ") -> DataFrame:
    import re
    w = stream.select(F.explode(F.split(F.col(col), re.escape(sep))).alias("word"), *[
        c for c in stream.columns if c == "timestamp" or c == "ts"])
    return w.filter(F.length("word") > 0)


def running_word_count(stream: DataFrame, col: str = "value") -> DataFrame:
    """Full table of counts, every trigger (complete mode)."""
    return split_words(stream, col).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def batch_word_count(target: str):
    """foreachBatch writer: counts of this batch only, one folder per batch."""
    from skyframe.streaming.sinks import batch_dirs
    write = batch_dirs(target)

    def each(batch_df: DataFrame, batch_id: int) -> None:
        write(batch_df.groupBy("word").agg(F.count(F.lit(1)).alias("count")), batch_id)
    return each


def windowed_count(stream: DataFrame, ts: str, key: str, win: str, slide: str | None = None,
                   watermark: str | None = None) -> DataFrame:
    """Count per (event-time window, key).  ``slide`` defaults to the window
    (tumbling); with a watermark old windows are finalised and dropped."""
    ntz = dict(stream.dtypes)[ts] == "timestamp_ntz"
    s = stream
    if watermark:
        # watermarks need an instant type; convert and convert back on output
        s = s.withColumn(ts, F.col(ts).cast("timestamp")) if ntz else s
        s = s.withWatermark(ts, watermark)
    back = (lambda c: c.cast("timestamp_ntz")) if (watermark and ntz) else (lambda c: c)
    return (s.groupBy(F.window(ts, win, slide or win).alias("w"), key)
             .agg(F.count(F.lit(1)).alias("count"))
             .select(back(F.col("w.start")).alias("window_start"), back(F.col("w.end")).alias("window_end"),
                     key, "count"))


def sliding_count(stream: DataFrame, ts: str, key: str, win: str, slide: str,
                  watermark: str | None = None) -> DataFrame:
    """Sliding-window count; the state store adds rows entering a window and
    finalises windows leaving it (no inverse function needed)."""
    return windowed_count(stream, ts, key, win, slide, watermark)


def update_state(stream: DataFrame, key: str, value: str, name: str = "total") -> DataFrame:
    """Running sum per key, never expiring (update or complete mode)."""
    return stream.groupBy(key).agg(F.sum(value).alias(name))


def update_mean(stream: DataFrame, key: str, value: str, name: str = "mean") -> DataFrame:
    """Running (total, n) per key and their float mean."""
    return (stream.groupBy(key).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))
                  .withColumn(name, (F.col("total") / F.col("n")).cast("float")))


def seeded_sums(seed: DataFrame, key: str, target: str, name: str = "total", sink=None):
    """foreachBatch writer for a running-sum stream in update mode: adds a
    fixed initial state (``seed``: key, name) to each updated key and
    upserts the result at ``target``, by ``sink`` (path, keys) -> writer."""
    from skyframe.plans.joins import broadcast_if_small
    from skyframe.streaming.sinks import upsert_parquet
    write = (sink or upsert_parquet)(target, [key])
    s = seed.withColumnRenamed(name, "_seed")

    def each(batch_df: DataFrame, batch_id: int) -> None:
        out = (batch_df.join(broadcast_if_small(s), key, "left")
                       .withColumn(name, F.col(name) + F.coalesce(F.col("_seed"), F.lit(0))).drop("_seed"))
        write(out, batch_id)
    return each


def sessions(stream: DataFrame, key: str, ts: str, gap: str, watermark: str | None = None) -> DataFrame:
    """Event-time sessions per key: events closer than ``gap`` join one
    session; output n events, start, end and duration in ms."""
    s = stream.withWatermark(ts, watermark) if watermark else stream
    return (s.groupBy(F.session_window(ts, gap).alias("sw"), key)
             .agg(F.count(F.lit(1)).alias("num_events"))
             .select(key, F.col("sw.start").alias("start"), F.col("sw.end").alias("end"),
                     "num_events",
                     ((F.unix_micros(F.col("sw.end").cast("timestamp"))
                       - F.unix_micros(F.col("sw.start").cast("timestamp"))) / 1000)
                     .cast("long").alias("duration_ms")))


def sessions_with_timeout(stream: DataFrame, key: str, ts: str, timeout: str = "10 seconds") -> DataFrame:
    """Sessions closed by a processing-time timeout: each update emits the
    running session (expired = false); when no event arrives for
    ``timeout`` the final row is emitted with expired = true."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    out_schema = "id string, duration_ms long, num_events long, expired boolean"
    state_schema = "n long, start_us long, end_us long"
    timeout_ms = _interval_ms(timeout)

    def update(k, pdfs, state):
        if state.hasTimedOut:
            n, s, e = state.get
            state.remove()
            yield pd.DataFrame({"id": [str(k[0])], "duration_ms": [(e - s) // 1000], "num_events": [n],
                                "expired": [True]})
            return
        n, s, e = state.get if state.exists else (0, None, None)
        for pdf in pdfs:
            us = pd.to_datetime(pdf[ts]).astype("int64") // 1000
            n += len(pdf)
            s = int(us.min()) if s is None else min(s, int(us.min()))
            e = int(us.max()) if e is None else max(e, int(us.max()))
        state.update((n, s, e))
        state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame({"id": [str(k[0])], "duration_ms": [(e - s) // 1000], "num_events": [n],
                            "expired": [False]})

    return stream.groupBy(key).applyInPandasWithState(
        update, out_schema, state_schema, "update", GroupStateTimeout.ProcessingTimeTimeout)


def run_until_expired(stream: DataFrame, writer, poll_seconds: float = 0.2, timeout_seconds: float = 600.0) -> None:
    """Run a query with processing-time timers until it has read its input and
    no key has state left: every timer has fired.  An error if ``timeout_seconds`` pass first."""
    import time
    q = run(stream, "update", writer, trigger={"processingTime": "0 seconds"})
    begun = time.time()
    try:
        while True:                     # timers make a batch of every trigger, so the query is never idle
            if q.exception():
                raise q.exception()
            last = q.lastProgress
            if last and last["numInputRows"] == 0 and all(op["numRowsTotal"] == 0 for op in last["stateOperators"]):
                return
            if time.time() - begun > timeout_seconds:
                raise TimeoutError("some sessions are still open")
            time.sleep(poll_seconds)
    finally:
        q.stop()


def _interval_ms(text: str) -> int:
    n, unit = text.split()
    scale = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000}
    return int(float(n) * scale[unit.rstrip("s")])


def sql_per_batch(sql: str, view: str, writer):
    """foreachBatch: expose the batch as ``view`` in the batch's own session
    and hand the SQL result to ``writer``."""
    def each(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.createOrReplaceTempView(view)
        writer(batch_df.sparkSession.sql(sql), batch_id)
    return each


def join_static(stream: DataFrame, static: DataFrame, on, how: str = "inner") -> DataFrame:
    """Stream-static join; the static side is broadcast when small."""
    from skyframe.plans.joins import broadcast_if_small
    return stream.join(broadcast_if_small(static), on, how)


def happiest_words(counts: DataFrame, sentiments: DataFrame, k: int = 5) -> DataFrame:
    """(word, happiness = score * count), top k.  For a stream, call inside
    foreachBatch on the running counts."""
    from skyframe.plans.joins import broadcast_if_small
    j = counts.join(broadcast_if_small(sentiments), "word")
    return (j.select("word", (F.col("score") * F.col("count")).alias("happiness"))
             .orderBy(F.desc("happiness"), "word").limit(k))


def batch_count(writer):
    """foreachBatch: number of events in each batch, handed to ``writer`` as
    one row (batch_id, events)."""
    def each(batch_df: DataFrame, batch_id: int) -> None:
        n = batch_df.agg(F.count(F.lit(1)).alias("events")).withColumn("batch_id", F.lit(batch_id))
        writer(n, batch_id)
    return each
