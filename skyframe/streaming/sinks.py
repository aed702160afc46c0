"""Streaming sinks built on ``foreachBatch``: a keyed upsert table of change
files with a manifest, whole versions per micro-batch, per-batch folders that skip empty batches, a
per-batch log, and console output.

Each writer is idempotent per batch id (it overwrites the folder of that
id), so a batch replayed after a failure or a restart from the checkpoint
does not double count.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _versions(spark, path: str) -> list[int]:
    """Batch ids already written under ``path`` (folders ``v=<id>``)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name[2:]))
    return sorted(out)


def latest(spark, path: str) -> DataFrame | None:
    """The newest complete version of an upsert table, or None."""
    vs = _versions(spark, path)
    return spark.read.parquet(os.path.join(path, f"v={vs[-1]}")) if vs else None


def upsert_parquet(path: str, keys: list[str], order_col: str | None = None):
    """foreachBatch writer: rows of the batch replace rows with the same key
    (last value wins); the merged table is written as version ``v=<batch>``.

    Versions are written whole, never edited in place, so a reader always
    sees a complete table and a retried batch rewrites its own version.
    """
    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        prev_versions = [v for v in _versions(spark, path) if v < batch_id]
        new = batch_df.withColumn("_prio", F.lit(1))
        if prev_versions:
            old = spark.read.parquet(os.path.join(path, f"v={prev_versions[-1]}")).withColumn("_prio", F.lit(0))
            new = new.unionByName(old)
        o = [F.desc("_prio")] + ([F.desc(order_col)] if order_col else [])
        w = Window.partitionBy(*keys).orderBy(*o)
        merged = new.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "_prio")
        merged.write.mode("overwrite").parquet(os.path.join(path, f"v={batch_id}"))
    return write


def upsert_bucketed(path: str, keys: list[str], buckets: int = 64):
    """foreachBatch writer for large keyed tables: the table is partitioned
    by a hash bucket of the key, and each batch rewrites only the buckets
    its rows touch (dynamic partition overwrite), so the cost of a batch
    follows the batch, not the table.

    The merged buckets are first written as a reliable checkpoint (the
    table cannot be read and overwritten by one job).  Replaying a batch
    after a failure merges the same rows again and gives the same buckets,
    so a partly written batch is repaired by its retry.
    """
    from skyframe.session import checkpoint_dir

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        checkpoint_dir(spark)
        b = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")
        new = batch_df.withColumn("_bucket", b).withColumn("_prio", F.lit(1))
        exists = bool(_versions_or_files(spark, path))
        if exists:
            touched = new.select("_bucket").distinct()
            old = (spark.read.parquet(path).join(F.broadcast(touched), "_bucket", "left_semi")   # <= buckets rows
                        .withColumn("_prio", F.lit(0)))
            new = new.unionByName(old)
        w = Window.partitionBy(*keys).orderBy(F.desc("_prio"))
        merged = (new.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "_prio")
                     .checkpoint(eager=True))
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("_bucket").parquet(path))
    return write


def read_bucketed(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("_bucket")


def _versions_or_files(spark, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.listStatus(p)) > 0


# ---------------------------------------------------------------- change files with a manifest
def _fs(spark, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def manifest(spark, path: str) -> dict | None:
    """The newest committed state of a delta table: the last batch, the
    merged base and the change files on top of it; None before the first."""
    jvm, p, fs = _fs(spark, os.path.join(path, "_manifest"))
    if not fs.exists(p):
        return None
    names = sorted(n for n in (st.getPath().getName() for st in fs.listStatus(p)) if n.endswith(".json"))
    if not names:
        return None
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(p, names[-1]))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _commit(spark, path: str, entry: dict) -> None:
    """Write the manifest of a batch whole: under another name, then renamed.
    The rename is the moment from which readers see the batch."""
    name = os.path.join(path, "_manifest", f"{entry['batch']:012d}.json")
    jvm, final, fs = _fs(spark, name)
    temporary = jvm.org.apache.hadoop.fs.Path(f"{name}.tmp")
    stream = fs.create(temporary, True)
    try:
        stream.write(bytearray(json.dumps(entry).encode()))
    finally:
        stream.close()
    if not fs.rename(temporary, final):
        raise OSError(f"cannot commit {name}")


def _merged(spark, path: str, state: dict, keys: list[str]) -> DataFrame:
    """The newest row of every key.  A key has one row in each change file, so
    its rows are at most as many as there are files since the last merge."""
    parts = ([state["base"]] if state["base"] is not None else []) + state["changes"]
    rows = None
    for i, name in enumerate(parts):
        part = spark.read.parquet(os.path.join(path, name)).withColumn("_v", F.lit(i))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    cols = [c for c in rows.columns if c != "_v"]
    newest = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in cols]), "_v").alias("_row"))
    return newest.select(*[F.col("_row").getField(c).alias(c) for c in cols])


def upsert_delta(path: str, keys: list[str], order_col: str | None = None, compact_every: int = 16):
    """foreachBatch writer: rows of the batch replace rows with the same key.

    A batch writes only its own rows, as one change file set, so its cost follows the
    batch and not the table.  Of two rows of a key in one batch the one with the larger ``order_col``
    stays; without it, or where that is equal, the larger row in column order (so a retry
    keeps the same one).  Every ``compact_every`` batches base and changes are merged into a new
    base, and what the merge before that replaced is removed.

    Readers (``read_delta``) go by the manifest, which is renamed into place
    after the data: they never see part of a batch.  A batch that was committed is
    skipped when replayed; one that failed before its commit overwrites its own files."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        state = manifest(spark, path) or {"batch": -1, "base": None, "changes": [], "old": []}
        if batch_id <= state["batch"]:
            return
        whole = F.struct(*[F.col(f"`{c}`") for c in batch_df.columns])
        rank = F.struct(F.col(f"`{order_col}`"), whole) if order_col else whole
        last = batch_df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.max_by(whole, rank).alias("_row"))
        name = f"change-{batch_id:012d}"
        (last.select(*[F.col("_row").getField(c).alias(c) for c in batch_df.columns])
             .write.mode("overwrite").parquet(os.path.join(path, name)))
        new = {"batch": batch_id, "base": state["base"], "changes": [*state["changes"], name], "old": state["old"]}
        gone = []
        if len(new["changes"]) >= compact_every:
            base = f"base-{batch_id:012d}"
            _merged(spark, path, new, keys).write.mode("overwrite").parquet(os.path.join(path, base))
            gone = new["old"]
            new |= {"base": base, "changes": [], "old": [*([new["base"]] if new["base"] else []), *new["changes"]]}
        _commit(spark, path, new)
        for name in gone:                      # replaced one merge ago: readers of that time are done
            jvm, p, fs = _fs(spark, os.path.join(path, name))
            fs.delete(p, True)
    return write


def read_delta(spark, path: str, keys: list[str]) -> DataFrame | None:
    """The table as of its last committed batch, or None before the first."""
    state = manifest(spark, path)
    return _merged(spark, path, state, keys) if state else None


def replace_table(path: str):
    """foreachBatch writer for complete-mode results: each batch holds the
    whole result, stored as version ``v=<batch>``."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.mode("overwrite").parquet(os.path.join(path, f"v={batch_id}"))
    return write


def batch_dirs(base: str, fmt: str = "parquet"):
    """foreachBatch writer: each non-empty batch to ``base/batch=<id>``."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        if batch_df.limit(1).count() == 0:    # skip empty batches
            return
        batch_df.write.mode("overwrite").format(fmt).save(os.path.join(base, f"batch={batch_id}"))
    return write


def batch_log(path: str, label: str = "Counts"):
    """foreachBatch writer: one text line per result row, prefixed with the
    time the batch is written, as the batch's own file set."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        line = F.concat_ws(" ", F.lit(f"{label} at time"), F.current_timestamp().cast("string"),
                           *[F.col(c).cast("string") for c in batch_df.columns])
        batch_df.select(line.alias("value")).write.mode("overwrite").text(
            os.path.join(path, f"batch={batch_id}"))
    return write


def console(df: DataFrame, n: int = 20, truncate: bool = False):
    """Start a console sink (complete mode for aggregates)."""
    mode = "complete" if df.isStreaming and _has_agg(df) else "append"
    return (df.writeStream.format("console").outputMode(mode)
              .option("numRows", n).option("truncate", truncate).start())


def _has_agg(df: DataFrame) -> bool:
    plan = df._jdf.queryExecution().analyzed().toString()
    return "Aggregate" in plan
