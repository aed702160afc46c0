"""Document fingerprints: bottom-k sketches of shingle hashes.

A text's shingles are its runs of 5 words (a shorter text: all its words);
each is hashed to 64 bits, and the sketch is the ``k`` smallest distinct
hashes in order.  The k smallest of the union of two sketches are the sketch of
the union, so sketches of parts merge; the share of those found in both
estimates the resemblance, the k-th smallest hash the number of distinct
shingles, and both together the containment.  Sets smaller than ``k`` are
kept whole and all estimates are exact.

Long texts are not sorted whole: hashes above a limit that should leave about 3k
are filtered out first; if that leaves fewer than k distinct ones, all are sorted.

Everything is DataFrame functions.  Defined results: null text counts as
empty; a text without words has the empty sketch, like another empty one by 1
and any other by 0; equal texts have equal sketches; repeated rows stay; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframe.llm.common import SPACE, text_of

K, SHINGLE = 128, 5
LEAST = -float(1 << 63)
RANGE = float(1 << 64)
ROWS_PER_RANGE, MAX_RANGES = 1000, 10_000


def with_sketch(df: DataFrame, text: Column, name: str, k: int = K, size: int = SHINGLE) -> DataFrame:
    """``df`` with the sketch of ``text``, an ascending array of hashes."""
    keep = [F.col(f"`{c}`") for c in df.columns]
    words = F.array_remove(F.split(text, SPACE), "")
    df = df.select(*keep, F.transform(words, lambda w: F.xxhash64(w)).alias("__h"))
    h = F.col("__h")
    runs = F.transform(F.slice(h, 1, F.greatest(F.size(h) - (size - 1), F.lit(0))),
                       lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, size)]))
    short = F.array(F.aggregate(h, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x)))
    df = df.select(*keep, F.when(F.size(h) >= size, runs).when(F.size(h) > 0, short)
                   .otherwise(F.array().cast("array<bigint>")).alias("__s"))
    s = F.col("__s")
    limit = (F.lit(LEAST) + F.lit(RANGE) * F.lit(3.0 * k) / F.size(s)).cast("long")
    low = F.when(F.size(s) > 4 * k, F.array_distinct(F.filter(s, lambda x: x < limit))).otherwise(F.array_distinct(s))
    df = df.select(*keep, s, low.alias("__low"))
    enough = (F.size("__low") >= k) | (F.size("__s") <= 4 * k)
    return df.select(*keep, F.when(enough, F.slice(F.sort_array("__low"), 1, k))
                     .otherwise(F.slice(F.sort_array(F.array_distinct("__s")), 1, k)).alias(name))


def union_sketch(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated |A and B| / |A or B|; exact if both sketches hold whole sets."""
    whole = (F.size(a) < k) & (F.size(b) < k)
    u = F.when(whole, F.array_union(a, b)).otherwise(union_sketch(a, b, k))
    both = F.array_intersect(F.array_intersect(a, b), u)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(
        F.size(both).cast("double") / F.size(u))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    kth = (F.element_at(a, -1).cast("double") - F.lit(LEAST)) / F.lit(RANGE)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / kth)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of A's shingles that B has."""
    j, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(na == 0, 1.0).otherwise(F.least(F.lit(1.0), j * (na + nb) / ((1 + j) * na)))


def merge_parts(parts: DataFrame, key: str, sketch: str, k: int = K) -> DataFrame:
    """Sketch of each key's union over its parts' sketches.  Hashes are
    deduplicated before the k smallest are taken, and Spark keeps only k of
    a key per task before the exchange, so a hot key stays small."""
    # explode_outer: for explode Spark would push a filter on the sketch below
    # the steps that make it, and compute them again inside it
    each = parts.select(key, F.explode_outer(sketch).alias("h")).filter("h is not null").distinct()
    w = Window.partitionBy(key).orderBy("h")
    low = each.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k)
    merged = low.groupBy(key).agg(F.sort_array(F.collect_list("h")).alias(sketch))
    keys = parts.select(F.col(key).alias("__k")).distinct()
    return (keys.join(merged, F.col("__k").eqNullSafe(F.col(key)), "left")
                .select(F.col("__k").alias(key), F.coalesce(sketch, F.array().cast("array<bigint>")).alias(sketch)))


def as_string(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def with_next(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(doc_id, text) -> with each row's own sketch, and text and sketch of the
    next row by descending doc_id (ties by text, null ids last; after the last:
    the first).

    Rows are dealt by ranges of doc_id in one exchange.  The first rows of a
    range also visit the range before it, as guests behind its last row, so no second pass
    joins the seams."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    n, top = docs.agg(F.count(F.lit(1)), F.max("doc_id")).first()
    ranges = int(min(MAX_RANGES, -(-n // rows_per_range)))
    splits: list[int] = []
    if ranges > 1:
        found = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)],
                                             max(10_000, 20 * ranges))).first()[0]
        splits = sorted(set(found or []), reverse=True)
    at = F.array(*[F.lit(s).cast("long") for s in splits]) if splits else F.array().cast("array<bigint>")
    # binary search: how many splits are at or above the id (null ids: all)
    steps = [1 << b for b in reversed(range(len(splits).bit_length()))]
    last = F.lit(len(splits))
    if splits:
        hit = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda p, s: F.when(
            (p + s <= last) & (F.get(at, F.least(p + s, last) - 1) >= F.col("doc_id")), p + s).otherwise(p))
        place = F.when(F.col("doc_id").isNull(), last).otherwise(hit)
    else:
        place = last
    docs = docs.withColumn("__r", place)
    first = (F.col("__r") > 0) & (F.get(at, F.col("__r") - 1) == F.col("doc_id"))
    none = F.lit(None).cast("struct<r:int,guest:int>")
    visits = F.array_compact(F.array(
        F.struct(F.col("__r").alias("r"), F.lit(0).alias("guest")),
        F.when(first, F.struct((F.col("__r") - 1).alias("r"), F.lit(1).alias("guest"))).otherwise(none),
        F.when(F.col("doc_id").eqNullSafe(F.lit(top).cast("long")),
               F.struct(last.alias("r"), F.lit(1).alias("guest"))).otherwise(none)))
    dealt = docs.select("doc_id", "text", F.explode(visits).alias("v")).select("doc_id", "text", "v.r", "v.guest")
    dealt = with_sketch(dealt.repartition("r"), F.col("text"), "sketch")
    w = Window.partitionBy("r").orderBy("guest", F.desc_nulls_last("doc_id"), "text")
    return (dealt.withColumns({"next_text": F.lead("text").over(w), "next_sketch": F.lead("sketch").over(w)})
                 .filter("guest = 0").drop("r", "guest"))


def edited_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text -- the last half of
    the code points replaced by the first as many of the next document."""
    d = with_next(docs).withColumn("n", F.length("text"))
    half = F.floor(F.col("n") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n") - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    d = d.select("doc_id", "n", "sketch", "next_sketch", edited.alias("edited"))
    d = with_sketch(d, F.col("edited"), "edited_sketch")
    own, other = F.col("sketch"), F.col("edited_sketch")
    return d.select("doc_id", F.col("n").cast("long").alias("n_chars"),
                    F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    as_string(own).alias("fingerprint"), as_string(other).alias("edited_fingerprint"),
                    resemblance(own, other).alias("near_edited"),
                    resemblance(own, F.col("next_sketch")).alias("near_next"),
                    containment(own, other).alias("kept_in_edited"), distinct_shingles(own).alias("shingles"))
