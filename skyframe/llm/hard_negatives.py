"""Hard-negative mining with Kronecker-packed products.

Vectors become integers (``floor(256 * x)``).  The components of several
candidates are shifted to be non-negative and laid side by side, as separated
fields, into one wide integer per dimension.  Multiplying such an integer by
one component of an anchor multiplies all its fields at once; after a sum over
the dimensions every field holds one candidate's exact score, as the fields
are wide enough that none runs into the next.  The shifts are taken off again
when the fields are read.

Wide integers of up to 53 bits are carried in doubles, which hold them and
all their sums exactly, so that the products are matrix products.  Where one
field needs more, 16 fields at a time are packed into Python's integers of any
length.

The anchors, a fixed share of the rows, are a query set against all rows, in
tiles of at most ``TILE`` anchors and blocks of at most ``MAX_BLOCK`` rows.  Two
passes: the first finds each anchor's positives, the second, which knows their scores,
the first negatives in each positive's band.  A task keeps only its block's best
few per anchor, and Spark ranks these.

Skew.  Blocks are dealt by a hash of the whole row, so a label or a
vector that a third of the rows share changes nothing.

Defined results: rows with a null id, label or vector or with a null or
non-finite component take no part; vectors of different length are compared
as if the shorter one ended in zeros (an empty one is all zeros); components
beyond the 64-bit range are taken at its end, and so are scores; rows alike in id, vector
and label count once; rows of the anchor's own id are neither its positives
nor its negatives; ties go to the smaller id (then the vector's hash); an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyframe.llm.common import written

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95                       # percent of the positive's score
TILE, MIN_BLOCK, MAX_BLOCK, BLOCKS = 4096, 1024, 65_536, 32
CARRIER_BITS, WIDE_FIELDS = 53, 16
SUB = 64                                 # anchors multiplied at a time
LONG = 2 ** 63 - 1


def flat(vectors: list, dims: int) -> np.ndarray:
    """Rows of integers, short ones padded with zeros."""
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


class Packed:
    """Candidates as wide integers, one per dimension and group of fields."""

    def __init__(self, rows: np.ndarray, most: int, size: int):
        """``rows``: candidates by dimension; ``most``: upper bound of an
        anchor's shifted component, ``size`` of its magnitude."""
        self.n, self.dims = rows.shape
        self.shift = int(rows.min(initial=0))
        span = int(rows.max(initial=0)) - self.shift
        self.bits = max(1, (span * max(most, 1) * max(self.dims, 1)).bit_length())
        own = max(abs(self.shift), abs(self.shift + span))
        self.exact = self.bits <= CARRIER_BITS and 4 * own * size * max(self.dims, 1) < LONG
        self.fields = CARRIER_BITS // self.bits if self.exact else WIDE_FIELDS
        kind = np.int64 if self.exact else object
        shifted = np.subtract(rows.astype(kind), self.shift)
        self.totals = rows.astype(kind).sum(1)
        groups = -(-self.n // self.fields)
        wide = np.zeros((self.dims, groups), kind)
        for f in range(self.fields):
            part = shifted[f::self.fields]
            wide[:, :len(part)] += part.T * (1 << (f * self.bits))
        self.wide = wide.astype(np.float64) if self.exact else wide

    def scores(self, anchors: np.ndarray, low: int) -> np.ndarray:
        """Inner products of every anchor with every candidate; ``low`` is
        the anchors' shift."""
        kind = np.int64 if self.exact else object
        a = np.subtract(anchors.astype(kind), low)
        if self.exact:
            sums = (a.astype(np.float64) @ self.wide).astype(np.int64)
        else:
            sums = a.dot(self.wide) if self.dims else np.zeros((len(a), self.wide.shape[1]), object)
        out = np.zeros((len(a), self.wide.shape[1] * self.fields), kind)
        field = (1 << self.bits) - 1
        for f in range(self.fields):
            out[:, f::self.fields] = (sums >> (f * self.bits)) & field
        # sum (a+low)(c+shift) = field + shift * sum a + low * sum c
        out = out[:, :self.n] + self.shift * a.sum(1)[:, None] + low * self.totals[None, :]
        return out if self.exact else np.clip(out, -LONG, LONG).astype(np.int64)


def products(anchors: np.ndarray, rows: np.ndarray):
    """(first anchor, scores) for ``SUB`` anchors at a time."""
    low = int(anchors.min(initial=0))
    high = int(anchors.max(initial=0))
    packed = Packed(rows, high - low, max(abs(low), abs(high)))
    for i in range(0, len(anchors), SUB):
        yield i, packed.scores(anchors[i:i + SUB], low)


def rows_of(vectors: DataFrame, vec_id: str, vec: str, label: str, flip_every: int, labels: int) -> DataFrame:
    """(id, label, vec, h): the rows that take part, as integers."""
    x = F.col(vec).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    ids, lab = F.col(vec_id).cast("long"), F.col(label).cast("long")
    lab = F.when(ids % flip_every == 0, (lab + 1) % labels).otherwise(lab) if flip_every else lab
    return (vectors.filter(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vec).isNotNull())
                   .filter(finite)
                   .select(ids.alias("id"), lab.alias("label"),
                           F.transform(x, lambda v: F.floor(v * 256.0).cast("long")).alias("vec"))
                   .distinct().withColumn("h", F.xxhash64("id", "label", "vec")))


def _groups(base: DataFrame, anchors: DataFrame) -> DataFrame:
    """Rows and anchors meeting in groups of one block and one tile."""
    n, m = base.count(), anchors.count()
    block = min(MAX_BLOCK, max(MIN_BLOCK, -(-n // BLOCKS)))
    blocks, tiles = max(1, -(-n // block)), max(1, -(-m // TILE))
    part = lambda k: F.pmod(F.xxhash64("h", F.lit(7)), F.lit(k))
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    none = F.lit(None).cast("array<bigint>")
    rows = base.select(part(blocks).alias("block"), every(tiles).alias("tile"), F.lit(0).alias("anchor"),
                       "id", "label", "vec", "h", none.alias("pos"), none.alias("bound"))
    asks = anchors.select(every(blocks).alias("block"), part(tiles).alias("tile"), F.lit(1).alias("anchor"),
                          "id", "label", "vec", "h", "pos", "bound")
    return rows.unionByName(asks).groupBy("block", "tile")


def _sides(pdf: pd.DataFrame):
    a, c = pdf[pdf["anchor"] == 1], pdf[pdf["anchor"] == 0]
    if not len(a) or not len(c):
        return None
    c = c.sort_values(["id", "h"])                     # a stable order by score then breaks ties by id
    dims = max(map(len, pdf["vec"]))
    return a, c, flat(list(a["vec"]), dims), flat(list(c["vec"]), dims)


def first_k(score: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k largest, in order, the earlier one first among equals."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
        return at[np.argsort(-score[at], kind="stable")][:k]
    return np.argsort(-score, kind="stable")


def _positives(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = {"ah": [], "id": [], "h": [], "score": []}
        sides = _sides(pdf)
        if sides:
            a, c, av, cv = sides
            cid, ch, clab = (c[x].to_numpy() for x in ("id", "h", "label"))
            aid, ah, alab = (a[x].to_numpy() for x in ("id", "h", "label"))
            same = {x: np.flatnonzero(clab == x) for x in np.unique(alab)}
            for start, scores in products(av, cv):
                for r, s in enumerate(scores):
                    own = same[alab[start + r]]
                    own = own[cid[own] != aid[start + r]]
                    at = own[first_k(s[own], k)]
                    out["ah"] += [ah[start + r]] * len(at)
                    out["id"] += cid[at].tolist()
                    out["h"] += ch[at].tolist()
                    out["score"] += s[at].tolist()
        return pd.DataFrame(out)
    return run


def band(score: int, low: int, high: int) -> tuple[int, int]:
    """The integers s with low * score <= 100 * s <= high * score."""
    return -((-low * score) // 100), (high * score) // 100


def _negatives(k: int, low: int, high: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = {"ah": [], "pos": [], "bound": [], "id": [], "h": [], "score": []}
        sides = _sides(pdf)
        if sides:
            a, c, av, cv = sides
            cid, ch, clab = (c[x].to_numpy() for x in ("id", "h", "label"))
            aid, ah, alab = (a[x].to_numpy() for x in ("id", "h", "label"))
            apos, abound = a["pos"].to_numpy(), a["bound"].to_numpy()
            for start, scores in products(av, cv):
                for r, s in enumerate(scores):
                    i = start + r
                    bands = [band(int(b), low, high) for b in abound[i]]
                    least = min((x for x, y in bands if x <= y), default=None)
                    if least is None:
                        continue
                    most = max(y for x, y in bands if x <= y)
                    near = np.flatnonzero((s >= least) & (s <= most) & (clab != alab[i]) & (cid != aid[i]))
                    sn = s[near]
                    for p, b, (x, y) in zip(apos[i], abound[i], bands):
                        inside = near[(sn >= x) & (sn <= y)]
                        at = inside[first_k(s[inside], k)]
                        out["ah"] += [ah[i]] * len(at)
                        out["pos"] += [p] * len(at)
                        out["bound"] += [b] * len(at)
                        out["id"] += cid[at].tolist()
                        out["h"] += ch[at].tolist()
                        out["score"] += s[at].tolist()
        return pd.DataFrame(out)
    return run


def mine(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label",
         anchor_every: int = 50, flip_every: int = 7, labels: int = 10, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: for each anchor (ids divisible by ``anchor_every``) and
    each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of another label whose score is ``low`` to ``high``
    percent of the positive's.  Labels of ids divisible by ``flip_every`` first move
    one on, modulo ``labels`` (0: none move)."""
    base = written(rows_of(vectors, vec_id, vec, label, flip_every, labels), "negatives-rows")
    chosen = base.filter(F.col("id") % anchor_every == 0)
    none = F.array().cast("array<bigint>")
    found = (_groups(base, chosen.withColumns({"pos": none, "bound": none}))
             .applyInPandas(_positives(positives), "ah long, id long, h long, score long"))
    best = Window.partitionBy("ah").orderBy(F.desc("score"), "id", "h")
    few = (found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= positives)
                .groupBy("ah").agg(F.sort_array(F.collect_list(F.struct("r", "id", "score"))).alias("p")))
    few = few.select(F.col("ah").alias("h"), F.col("p.id").alias("pos"), F.col("p.score").alias("bound"))
    asked = written(chosen.join(few, "h").select("id", "label", "vec", "h", "pos", "bound"), "negatives-anchors")
    hard = (_groups(base, asked).applyInPandas(
        _negatives(negatives, low, high), "ah long, pos long, bound long, id long, h long, score long"))
    first = Window.partitionBy("ah", "pos", "bound").orderBy(F.desc("score"), "id", "h")
    top = hard.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= negatives)
    return (top.join(asked.select(F.col("h").alias("ah"), F.col("id").alias("anchor_id")), "ah")
               .select("anchor_id", F.col("pos").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                       F.col("id").alias("negative_id"), F.col("bound").alias("positive_score"),
                       F.col("score").alias("negative_score")))
