"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.session import checkpoint_dir, ship_package

# A word is a maximal run of characters other than space, tab, line feed,
# vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read
    back: it is computed once, and later readers see only the columns they
    ask for."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Shared:
    """A model broadcast by value, its class included, so that workers need
    no copy of the package; rebuilt once in a worker process."""

    def __init__(self, spark: SparkSession, value) -> None:
        ready(spark)
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if not hasattr(self._bytes, "_made"):
            self._bytes._made = pickle.loads(self._bytes.value)
            del self._bytes._value                   # the value is enough
        return self._bytes._made


def ready(spark: SparkSession) -> None:
    """Functions sent to Python workers are pickled by value."""
    ship_package(spark)


def text_of(col: str = "text") -> Column:
    """The text, null as the empty string."""
    return F.coalesce(F.col(col), F.lit(""))


def unsigned_unit(h: Column) -> Column:
    """A signed 64-bit hash as a double in [0, 1) with 53 random bits."""
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def crc_remainder(col: str, m: int) -> Column:
    """crc32 of the id written as decimal text, modulo ``m`` (null ids: 0)."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(m), F.lit(0).cast("long"))
