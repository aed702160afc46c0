"""SimHash near-duplicates with pigeonring filtering.

A text's fingerprint has 64 bits, each the majority of that bit over the
XXH64 hashes of its 3-word shingles.  Fingerprints link at ``MAX_BITS`` = 2 or
fewer differing bits; documents of one linked component are near-duplicates.

Candidates.  The 64 bits form a ring of 6 segments.  If two fingerprints
differ in at most 2 bits, then from some segment on every chain of ``l``
consecutive segments differs in at most ``2 * l / 6`` bits: 0 for the
first two, 1 up to the fifth, 2 for all.  Of the third to
fifth segment at least two are therefore equal as well, so the pair agrees in four whole segments
and meets under a key of about 43 bits; 15 such keys cover every
start and every choice.  Pairs that meet must then pass the chain budgets
before the full Hamming check.

Skew.  Copies share a fingerprint and count once.  A key shared by more than
``CROWD`` fingerprints is not paired off: its members link through midpoints instead.
Two fingerprints are within 2 bits exactly if flipping at most one of the free bits of
each gives the same value, and all that meet at a value are within 2 bits of
one another, so a star per value holds every link; no value can have more than 23 members.
The work is linear in the members, and no link is lost.

Defined results: null text counts as empty; a text with one or two words has
one shingle, the whole sequence; without words the fingerprint is zero and links like
any other.  Repeated rows share a component; a null doc_id never names a
component (its component_id is null only if no row of it has an id).  An
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframe.llm.common import cut, written
from skyframe.operators.graph import connected_components

SHINGLE, MAX_BITS, SEED = 3, 2, 42
WIDTHS = (11, 11, 11, 11, 10, 10)
CROWD = 24


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def segments() -> list[int]:
    out, at = [], 0
    for w in WIDTHS:
        out.append(((1 << w) - 1) << at)
        at += w
    return out


def key_masks() -> list[int]:
    """Bits that must agree: the first two segments of a chain and two of the
    next three, for every start; each set of segments once."""
    seg, n = segments(), len(WIDTHS)
    sets = {frozenset((i % n, (i + 1) % n, *[(i + a) % n for a in (2, 3, 4) if a != skip]))
            for i in range(n) for skip in (2, 3, 4)}
    return [sum(seg[s] for s in chosen) for chosen in sorted(sets, key=sorted)]


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64-bit SimHash of one text as an unsigned number."""
    import xxhash
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z only, the six spaces only
    if not words:
        return 0
    line, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-1]]]
    last = max(1, len(words) - size + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[starts[i]:ends[min(i + size, len(words)) - 1]], SEED) for i in range(last)),
                         np.uint64, last)
    ones = np.zeros(64, np.int64)
    for part in range(0, last, 1 << 16):     # bounded memory for very long texts
        bits = np.unpackbits(hashes[part:part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > last, bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column) -> Column:
    @F.arrow_udf("long")
    def one(texts: pa.Array) -> pa.Array:
        return pa.array((signed(fingerprint(t.as_py())) for t in texts), pa.int64())    # one string at a time
    return one(text)


def within(a: Column, b: Column) -> Column:
    """The chain budgets from some start, then the full Hamming check."""
    diff, seg, n = a.bitwiseXOR(b), segments(), len(WIDTHS)
    viable = F.lit(False)
    for start in range(n):
        chain, ok = 0, F.lit(True)
        for length in range(1, n):
            chain |= seg[(start + length - 1) % n]
            budget = MAX_BITS * length // n
            if MAX_BITS * (length + 1) // n != budget or length == n - 1:  # the longest chain of each budget
                ok = ok & (F.bit_count(diff.bitwiseAND(F.lit(signed(chain)))) <= budget)
        viable = viable | ok
    return viable & (F.bit_count(diff) <= MAX_BITS)


def links(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints (``fp``) -> links (src, dst) that connect every
    two within ``MAX_BITS``, directly or through others that are."""
    masks = key_masks()
    keyed = prints.select("fp", F.explode(F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(signed(m)))
                                                             .alias("key")) for v, m in enumerate(masks)])).alias("k"))
    keyed = keyed.select("fp", "k.v", "k.key")
    met = keyed.groupBy("v", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = written(keyed.join(met, ["v", "key"]), "simhash-keys")
    few = shared.filter(F.col("n") <= CROWD)
    a, b = few.select("v", "key", F.col("fp").alias("src")), few.select("v", "key", F.col("fp").alias("dst"))
    paired = (a.join(b, ["v", "key"]).filter((F.col("src") < F.col("dst")) & within(F.col("src"), F.col("dst")))
               .select("src", "dst"))
    return paired.unionByName(crowded_links(shared.filter(F.col("n") > CROWD), masks)).distinct()


def crowded_links(crowded: DataFrame, masks: list[int]) -> DataFrame:
    """Links inside crowded keys by midpoints over the key's free bits."""
    free = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(signed(1 << b)) for b in range(64) if not m >> b & 1])
                     for m in masks])
    mid = (crowded.select("fp", F.explode(F.element_at(free, F.col("v") + 1)).alias("flip"))
                  .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid")).distinct())
    stars = mid.groupBy("mid").agg(F.min("fp").alias("src"), F.collect_list("fp").alias("all"))
    return (stars.filter(F.size("all") > 1).select("src", F.explode("all").alias("dst"))
                 .filter(F.col("src") != F.col("dst")))


def components(prints: DataFrame) -> DataFrame:
    """(fp, first id of it) -> (fp, component_id)."""
    edges = cut(links(prints.select("fp")))
    label = connected_components(edges).select(F.col("id").alias("fp"), F.col("label"))
    named = prints.join(label, "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    return named.join(least, "label").select("fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp (64 bits, signed) and component_id of every document."""
    marked = written(docs.select("doc_id", fingerprints(F.col("text")).alias("fp")), "simhash")
    prints = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    return marked.join(components(written(prints, "simhash-distinct")), "fp").select("doc_id", "fp", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest doc_id (a null
    id only where there is no other); of rows alike in id and fingerprint
    the first by content.  Same columns as ``docs``."""
    cols = docs.columns
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), "doc_id",
                         fingerprints(F.col("text")).alias("fp"), F.xxhash64("text").alias("th"))
    keys = written(marked.select("doc_id", "fp", "th"), "simhash")
    prints = written(keys.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("fp"), F.col("th")))
    chosen = (keys.join(components(prints), "fp").withColumn("c", F.coalesce("component_id", "fp"))
                  .groupBy(F.col("component_id").isNull().alias("lone"), "c").agg(best.alias("b"))
                  .select(F.col("b.id").alias("id"), F.col("b.th").alias("bth")))
    # One row per chosen key; rows alike in both are interchangeable copies.
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), "doc_id", F.xxhash64("text").alias("th"))
    kept = kept.join(chosen, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("th").eqNullSafe(F.col("bth")), "left_semi")
    return kept.groupBy("doc_id", "th").agg(F.first("row").alias("row")).select("row.*")
