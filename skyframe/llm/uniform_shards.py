"""Uniform shuffle into shards of exact size by a communication matrix.

A uniform shuffle of all rows, cut into ``shards`` pieces whose counts differ
by at most one.  Where rows of partition ``p`` go is drawn first: the row of
counts partition -> shard is multivariate hypergeometric, drawn from
what the partitions before it have left of every shard.  Only that
matrix (one row per partition) is made by the driver.  Then the partitions
work alone: a random permutation inside the partition deals its rows to the
shards in the drawn counts, the rows are exchanged, and a second random
permutation inside the shard gives the slots.  The second one runs over
cells of a shard (ranges of a random key), so a shard is never sorted in one
task.

The partitions are hash classes of the row, not Spark's, so a task that is
repeated after a lost executor deals the same rows the same way, and
reruns agree.  A doc_id or text that repeats does not matter for balance:
the counts are exact by construction.

Law: ``rows``.  Size: UTF-8 bytes of the text (null: none) plus 1.  Rows
alike in doc_id and text are interchangeable; a null doc_id is an id like
any other; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyframe.llm.common import text_of, written

ROWS_PER_PART = 4096
MAX_PARTS = 1 << 16


def communication_matrix(counts: list[tuple[int, int]], shards: int, seed: int) -> list[tuple[int, int, int, int]]:
    """(part, shard, from, to): the ranks of a part's permutation that go to a shard."""
    total = sum(n for _, n in counts)
    left = np.array([total // shards + (s < total % shards) for s in range(shards)], dtype=np.int64)
    rng, out = np.random.default_rng(seed), []
    for part, n in sorted(counts):
        rest, drawn = n, np.zeros(shards, dtype=np.int64)
        pool = int(left.sum())
        for s in range(shards):              # one hypergeometric draw per cell
            others = pool - int(left[s])
            drawn[s] = _hypergeometric(rng, int(left[s]), others, rest)
            rest -= int(drawn[s])
            pool = others
        left -= drawn
        ends = np.cumsum(drawn)
        out += [(part, s, int(ends[s] - drawn[s]), int(ends[s])) for s in range(shards) if drawn[s]]
    return out


def _hypergeometric(rng, good: int, bad: int, take: int) -> int:
    """How many of ``take`` rows drawn without return are good ones."""
    if take == 0 or good == 0:
        return 0
    if bad == 0:
        return take
    limit = 999_999_999                      # numpy's bound on good and bad
    if max(good, bad) <= limit:
        return int(rng.hypergeometric(good, bad, take))
    # beyond it, by inversion: probabilities around the mode from the ratios
    # of neighbours, so their common factor needs no large factorials
    lo, hi = max(0, take - bad), min(good, take)
    mode = min(hi, max(lo, (take + 1) * (good + 1) // (good + bad + 2)))
    share = good / (good + bad)
    reach = 16 * int((take * share * (1 - share)) ** 0.5 + 4)
    k = np.arange(max(lo, mode - reach), min(hi, mode + reach) + 1, dtype=np.float64)
    step = np.log(good - k[:-1]) + np.log(take - k[:-1]) - np.log(k[1:]) - np.log(bad - take + k[1:])
    logs = np.concatenate(([0.0], np.cumsum(step)))
    weight = np.cumsum(np.exp(logs - logs.max()))
    return int(k[np.searchsorted(weight, rng.random() * weight[-1])])


def shuffle_into_shards(docs: DataFrame, shards: int = 16, seed: int = 23) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    text = text_of()
    base = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("crc"))
    base = base.withColumns({"h1": F.xxhash64(F.lit(seed), "doc_id", "crc"),
                             "h2": F.xxhash64(F.lit(seed + 1), "doc_id", "crc", "size"),
                             "h3": F.xxhash64(F.lit(seed + 2), "doc_id", "crc", "size")})
    base = written(base, "shards")
    n = base.count()
    parts = int(min(MAX_PARTS, max(1, -(-n // ROWS_PER_PART))))
    base = base.withColumn("part", F.pmod("h1", F.lit(parts)).cast("int"))
    counts = [(r["part"], r["n"]) for r in base.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()]
    matrix = communication_matrix(counts, shards, seed)
    # at most MAX_PARTS x shards rows of four numbers
    plan = spark.createDataFrame(matrix or [(0, 0, 0, 0)], "part int, shard int, lo int, hi int")
    starts = plan.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "shard"))).alias("cells"))

    # permute locally: ranks of a random key inside the part
    order = Window.partitionBy("part").orderBy("h2", "doc_id", "crc", "size")
    ranked = base.withColumn("r", F.row_number().over(order) - 1)
    dealt = (ranked.join(starts, "part")
                   .withColumn("shard", F.filter("cells", lambda c: (c["lo"] <= F.col("r")) & (F.col("r") < c["hi"]))[0]["shard"])
                   .drop("cells", "r"))
    # exchange and permute again: cells are ranges of a second random key
    cells = max(1, -(-n // (ROWS_PER_PART * shards)))
    unit = F.shiftrightunsigned("h3", 11).cast("double") / F.lit(float(1 << 53))
    dealt = dealt.withColumn("cell", F.floor(unit * cells).cast("int"))
    inner = Window.partitionBy("shard", "cell").orderBy("h3", "doc_id", "crc", "size")
    placed = dealt.withColumn("i", F.row_number().over(inner) - 1)
    sizes = dealt.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("m"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "cell", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("off"))
    return (placed.join(offsets, ["shard", "cell"])
                  .select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard",
                          (F.col("off") + F.col("i")).cast("long").alias("slot"),
                          F.lit(None).cast("int").alias("grown_shard")))
