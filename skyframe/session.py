"""Session helpers: building a session, reading the shared tables, and the
checkpoint folder that iterative jobs use to cut lineage.

On a cluster the session comes from the platform and already names a shared
``spark.checkpoint.dir``; nothing here overrides settings that are present.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Settings applied only when the builder creates a new session.  They are the
# values we want on a large cluster as well: AQE re-plans joins and partition
# counts from runtime sizes, splits skewed join partitions, and coalesces
# small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # streaming state (running counts never expire) lives in RocksDB on
    # local disk instead of the executor heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app: str = "skyframe",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Return the active session or build one (local[*] when no master is set)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or "local[*]")
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package's functions and classes usable in the Python
    workers (pandas UDFs, mapInPandas / applyInPandas functions, the Python
    stream source): they are pickled by value, code included, so the
    workers need no copy of the package and no files are staged anywhere.
    Registered once per process."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules["skyframe"])
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints.

    Read from the session (``spark.checkpoint.dir`` or the context's
    directory).  Only when neither is set and Spark runs locally -- tests --
    a private temp folder is created and registered; on a cluster a folder
    of one machine would not do, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="skyframe-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Inside, the shuffle files of each job are removed when it is done, not once the driver
    happens to collect garbage: rounds do not add up on disk.  A setting that is present holds."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if spark.sparkContext.getConf().contains(name):
        yield
        return
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the shared tables as temp views of the same names."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
