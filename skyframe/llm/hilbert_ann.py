"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions by several random rotations, each
with a random shift, and ordered along a Hilbert curve of each.  Spark
range-partitions and numbers every ordering.  A query takes the rows whose
ranks lie within a window around its own on every curve; the windows are scored
exactly, merged and reranked.

Largest inner products become nearest points by one more coordinate,
``sqrt(M^2 - |x|^2)`` for rows and 0 for queries (M the largest norm).

The window's width is found, not set: for at most ``PROBES`` queries the true
neighbours are searched among all rows, and the window is made so wide that ``TARGET`` of
these pairs lie in it.  On data with structure it stays narrow; on data without any
(independent directions in many dimensions) it grows with the table.

Memory.  A task scores one block of at most ``WIDTH`` ranks against the queries of at
most ``SPAN`` ranks, ``TILE`` queries at a time; a wider window means more blocks.

Skew.  Equal vectors form one class with one position on a curve; a class
keeps its 21 smallest ids, which is all that any answer of 20 can show.  Blocks of a
curve are cut by rank, so they are equal however the keys fall.

Defined results: vectors null, empty, zero, holding null or non-finite components, or
of another than the commonest length take no part, nor do null ids; of a
repeated (id, vector) one counts; the query's own id is never an answer;
ties go to the smaller vec_id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyframe.llm.common import Shared, written
from skyframe.operators.relational import with_index

CURVES, DIMS, BITS, SEED = 16, 8, 7, 29
PROBES, TARGET = 200, 0.96
EVERY, TOP = 20, 20
WIDTH, SPAN, TILE = 4096, 40_960, 256


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of grid cells.

    Axis by axis and from the highest bit down, the walk through a cube is
    undone: where a bit is set the first axis is mirrored below it, where not
    the first axis and this one are swapped; a Gray code of the rest orders the cubes."""
    axes = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    for b in range(bits - 1, 0, -1):
        below = (1 << b) - 1
        for i, a in enumerate(axes):
            mirrored = (a >> b) & 1 == 1
            swap = np.where(mirrored, 0, (axes[0] ^ a) & below)
            if i:
                axes[i] = a ^ swap
            axes[0] = np.where(mirrored, axes[0] ^ below, axes[0] ^ swap)
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    carry = np.zeros(len(cells), np.int64)
    for b in range(bits - 1, 0, -1):
        carry ^= np.where((axes[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    key = np.zeros(len(cells), np.int64)
    for b in range(bits - 1, -1, -1):
        for a in axes:
            key = (key << 1) | (((a ^ carry) >> b) & 1)
    return key


class Curves:
    """The projections, fitted to the mean and covariance of all vectors."""

    def __init__(self, mean: np.ndarray, cov: np.ndarray, norm: float):
        rng, dim = np.random.default_rng(SEED), len(mean)
        self.norm, self.maps = norm, []
        for _ in range(CURVES):
            turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, :min(DIMS, dim)]
            sd = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", turn, cov, turn), 1e-18))
            self.maps.append((turn, mean @ turn, sd, rng.random(turn.shape[1])))

    def keys(self, x: np.ndarray, query: np.ndarray) -> list[np.ndarray]:
        rest = np.sqrt(np.maximum(self.norm ** 2 - (x * x).sum(1), 0)) * (query == 0)
        x, out = np.hstack([x, rest[:, None]]), []
        for turn, mean, sd, shift in self.maps:
            unit = 1 / (1 + np.exp(-1.702 * np.clip((x @ turn - mean) / sd, -20, 20)))
            cells = np.minimum(((unit + shift) / 2 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            out.append(hilbert_keys(cells, BITS))
        return out


def classes(vectors: DataFrame, vec_id: str, vec: str) -> DataFrame:
    """(cid, vec, ids): distinct usable vectors, named by their smallest id, with
    their smallest ids in order."""
    v = F.col(vec).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.filter(F.col(vec_id).isNotNull() & F.col(vec).isNotNull())
                   .select(F.col(vec_id).cast("long").alias("id"), v.alias("vec"))
                   .filter((F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0)))
    usual = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if usual is None:
        return rows.limit(0).select(F.col("id").alias("cid"), "vec", F.array("id").alias("ids"))
    rows = rows.filter(F.size("vec") == usual["d"]).select("id", F.transform("vec", lambda x: x + F.lit(0.0)).alias("vec"))
    first = Window.partitionBy("vec").orderBy("id")
    few = rows.distinct().withColumn("r", F.row_number().over(first)).filter(F.col("r") <= TOP + 1)
    return (few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
               .select(F.col("ids")[0].alias("cid"), "vec", "ids"))


def _moments(batches):
    n, total, square, norm = 0, 0.0, 0.0, 0.0
    for pdf in batches:
        if len(pdf):
            x = np.stack(pdf["vec"].to_numpy())
            n, total, square = n + len(x), total + x.sum(0), square + x.T @ x
            norm = max(norm, float((x * x).sum(1).max()))
    if n:
        yield pd.DataFrame({"n": [n], "total": [total], "square": [square.ravel()], "norm": [norm]})


def _fit(base: DataFrame) -> Curves:
    parts = base.select("vec").mapInPandas(_moments, "n long, total array<double>, square array<double>, norm double")
    total = (parts.select("n", "norm", F.posexplode(F.concat("total", "square")).alias("i", "x"))
                  .groupBy("i").agg(F.sum("x").alias("x"), F.sum("n").alias("n"), F.max("norm").alias("norm"))
                  .orderBy("i").collect())                           # dim + dim^2 numbers
    dim = int((np.sqrt(4 * len(total) + 1) - 1) / 2)
    x, n, norm = np.array([r["x"] for r in total]), total[0]["n"], float(np.sqrt(total[0]["norm"]))
    mean, square = x[:dim] / n, x[dim:].reshape(dim, dim) / n
    cov = np.zeros((dim + 1, dim + 1))
    cov[:dim, :dim] = square - np.outer(mean, mean)
    rest = max(norm ** 2 - np.trace(square), 0.0)                    # mean square of the extra coordinate
    cov[dim, dim] = rest
    return Curves(np.append(mean, np.sqrt(rest)), cov, norm)


def best_rows(q: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest inner products of each query: (indices, scores).  Scores
    of those kept are summed pair by pair, so a pair's score does not depend on
    what else was in the block."""
    rough = q @ x.T
    k = min(k, len(x))
    at = np.argpartition(-rough, k - 1, axis=1)[:, :k].copy()           # not a view that keeps the block
    return at, np.einsum("qd,qkd->qk", q, x[at], optimize=False)


def block_width(reach: int) -> int:
    return min(WIDTH, max(64, -(-reach // 2)))


def best_in_tiles(q: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``best_rows``, of ``TILE`` queries at a time."""
    found = [best_rows(q[i:i + TILE], x, k) for i in range(0, len(q), TILE)]
    return np.concatenate([at for at, _ in found]), np.concatenate([s for _, s in found])


def _probe(batches, ids, vecs):
    top: pd.DataFrame | None = None
    for pdf in batches:
        if not len(pdf):
            continue
        at, score = best_rows(vecs, np.stack(pdf["vec"].to_numpy()), TOP + 1)
        cid = pdf["cid"].to_numpy()
        new = pd.DataFrame({"q": np.repeat(ids, at.shape[1]), "cid": cid[at.ravel()], "score": score.ravel()})
        new = new if top is None else pd.concat([top, new])
        top = new.sort_values(["q", "score"], ascending=[True, False]).groupby("q").head(TOP + 1)
    if top is not None:
        yield top


def _window(base: DataFrame, queries: DataFrame, ranked: DataFrame) -> int:
    """Half width, in ranks, that holds TARGET of the probes' true neighbours."""
    some = queries.orderBy(F.xxhash64("qid", F.lit(SEED)), "qid").limit(PROBES).collect()
    if not some:
        return 1
    ids, vecs = np.array([r["qid"] for r in some]), np.array([r["vec"] for r in some])
    own = {r["qid"]: r["cid"] for r in some}
    best = Window.partitionBy("q").orderBy(F.desc("score"), "cid")
    near = (base.select("cid", "vec").mapInPandas(lambda b: _probe(b, ids, vecs), "q long, cid long, score double")
                .withColumn("r", F.row_number().over(best)).filter(F.col("r") <= TOP + 1).select("q", "cid").collect())
    pairs = [(r["q"], r["cid"]) for r in near if own[r["q"]] != r["cid"]]      # at most PROBES * 21
    if not pairs:
        return 1
    spark = base.sparkSession
    want = spark.createDataFrame([(1, int(q)) for q in ids] + [(0, int(c)) for c in {c for _, c in pairs}],
                                 "query int, cid long")
    rank: dict = {}
    for r in ranked.join(F.broadcast(want), ["query", "cid"]).select("query", "cid", "curve", "rank").collect():
        rank.setdefault((r["query"], r["cid"]), np.zeros(CURVES))[r["curve"]] = r["rank"]
    gaps = sorted(float(np.abs(rank[1, q] - rank[0, c]).min()) for q, c in pairs)
    return max(1, int(gaps[min(len(gaps) - 1, int(TARGET * len(gaps)))]))


def search(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: nearest rows of every query row."""
    spark = vectors.sparkSession
    base = written(classes(vectors, vec_id, vec), "ann-classes")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if base.isEmpty():
        return empty
    curves = Shared(spark, _fit(base))
    # every query row with its class; a class keeps only its smallest ids, so they are read anew
    v = F.transform(F.col(vec).cast("array<double>"), lambda x: x + F.lit(0.0))
    asked = (vectors.filter(F.col(vec_id).isNotNull() & (F.col(vec_id) % EVERY == 0))
                    .select(F.col(vec_id).cast("long").alias("qid"), v.alias("vec")).distinct())
    queries = written(asked.join(base.select("cid", "vec", F.col("ids").alias("own")), "vec"), "ann-queries")

    def keys(batches):
        for pdf in batches:
            if len(pdf):
                found = curves.value.keys(np.stack(pdf["vec"].to_numpy()), pdf["query"].to_numpy())
                yield pd.concat([pd.DataFrame({"curve": c, "key": k, "query": pdf["query"], "cid": pdf["cid"]})
                                 for c, k in enumerate(found)])

    both = (base.select("cid", "vec", F.lit(0).alias("query"))
                .unionByName(queries.select(F.col("qid").alias("cid"), "vec", F.lit(1).alias("query"))))
    both = both.dropDuplicates(["query", "cid"])
    keyed = both.mapInPandas(keys, "curve int, key long, query int, cid long")
    ranked = with_index(keyed, [F.col("curve"), F.col("key"), F.col("cid"), F.col("query")], "rank")
    reach = _window(base, queries, ranked)
    block, span = block_width(reach), SPAN
    n = ranked.agg(F.max("rank")).first()[0]
    places = ranked.filter("query = 0").select("cid", F.floor(F.col("rank") / block).alias("block"))
    # a block meets the queries of all spans from which it can be reached
    rows = places.join(base.select("cid", "vec"), "cid").select("block", F.explode(F.sequence(
        F.floor(F.greatest(F.col("block") * block - reach - block, F.lit(0)) / span),
        F.floor((F.col("block") * block + reach + block) / span))).alias("span"), F.lit(0).alias("query"), "cid", "vec")
    visits = ranked.filter("query = 1").select(F.col("cid"), F.floor(F.col("rank") / span).alias("span"), F.explode(F.sequence(
        F.floor(F.greatest(F.col("rank") - reach, F.lit(0)) / block),
        F.floor(F.least(F.col("rank") + reach, F.lit(n)) / block))).alias("block"))
    asks = (visits.join(queries.dropDuplicates(["qid"]).select(F.col("qid").alias("cid"), "vec"), "cid")
                  .select("block", "span", F.lit(1).alias("query"), "cid", "vec"))

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        q, x = pdf[pdf["query"] == 1], pdf[pdf["query"] == 0]
        if not len(q) or not len(x):
            return pd.DataFrame({"qid": [], "cid": [], "score": []})
        at, s = best_in_tiles(np.stack(q["vec"].to_numpy()), np.stack(x["vec"].to_numpy()), TOP + 1)
        return pd.DataFrame({"qid": np.repeat(q["cid"].to_numpy(), at.shape[1]),
                             "cid": x["cid"].to_numpy()[at.ravel()], "score": s.ravel()})

    found = (rows.unionByName(asks).groupBy("block", "span")
                 .applyInPandas(score, "qid long, cid long, score double")
                 .groupBy("qid", "cid").agg(F.max("score").alias("score")))
    top = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
    found = found.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= TOP + 1).drop("r")
    members = found.join(base.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("id"))
    final = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    return (members.filter(F.col("id") != F.col("qid")).withColumn("rank", F.row_number().over(final))
                   .filter(F.col("rank") <= TOP)
                   .select(F.col("qid").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"))
