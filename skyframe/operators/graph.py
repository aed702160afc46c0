"""Graph analytics on edge tables ``(src, dst[, weight])`` and optional
vertex tables ``(id, ...)``.

Iterative algorithms are loops of DataFrame joins and aggregations.  Each
round's state is a small (one row per vertex) table; every few rounds it is
written as a reliable checkpoint so lineage stays short and a lost executor
recomputes at most a few rounds.  Convergence checks are one aggregate per
round (a single number to the driver).
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.plans import blocks
from skyframe.plans.joins import keyed_join
from skyframe.session import checkpoint_dir

CHECKPOINT_EVERY = 3


def _cut(df: DataFrame, i: int, every: int = CHECKPOINT_EVERY) -> DataFrame:
    """Reliable checkpoint every ``every`` rounds (lineage cut)."""
    if i % every == every - 1:
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    return df


def read_edges(spark, path: str, canonical: bool = False) -> DataFrame:
    """``src dst`` per line (whitespace separated, ``#`` comments skipped)."""
    lines = spark.read.text(path).filter(~F.col("value").startswith("#"))
    p = F.split(F.trim("value"), r"\s+")
    e = lines.select(p.getItem(0).cast("long").alias("src"), p.getItem(1).cast("long").alias("dst"))
    return canonical_edges(e) if canonical else e


def canonical_edges(edges: DataFrame) -> DataFrame:
    """Undirected simple graph: (min, max), no self loops, no duplicates."""
    return (edges.filter(F.col("src") != F.col("dst"))
                 .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
                 .distinct())


def vertices_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).distinct()


def rounds(bound: int | None):
    """0, 1, 2, ... for a loop that ends itself; an error at ``bound``."""
    i = 0
    while bound is None or i < bound:
        yield i
        i += 1
    raise RuntimeError(f"not converged after {bound} rounds")


# ---------------------------------------------------------------- PageRank
def pagerank_naive(edges: DataFrame, iters: int = 10) -> DataFrame:
    """Classic two-table PageRank: distinct links, ranks start at 1.0,
    rank = 0.15 + 0.85 * sum(contributions).  Pages without in-links drop
    out after the first round (as in the original program)."""
    links = edges.select("src", "dst").distinct()
    deg = links.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))
    links = links.join(deg, "src").cache()
    ranks = links.select(F.col("src").alias("id")).distinct().withColumn("rank", F.lit(1.0))
    for i in range(iters):
        contrib = links.join(ranks, links.src == ranks.id).select(
            "dst", (F.col("rank") / F.col("deg")).alias("c"))
        ranks = contrib.groupBy(F.col("dst").alias("id")).agg((0.15 + 0.85 * F.sum("c")).alias("rank"))
        ranks = _cut(ranks, i)
    return ranks


def _pr_round(links: DataFrame, verts: DataFrame, ranks: DataFrame, reset: float) -> DataFrame:
    contrib = (links.join(ranks, links.src == ranks.id)
                    .groupBy("dst").agg(F.sum(F.col("rank") / F.col("deg")).alias("s")))
    return (verts.join(contrib, verts.id == contrib.dst, "left")
                 .select("id", (F.lit(reset) + (1 - reset) * F.coalesce(F.col("s"), F.lit(0.0))).alias("rank")))


def _pr_inputs(edges: DataFrame, vertices: DataFrame | None):
    links = edges.select("src", "dst")
    deg = links.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))
    links = links.join(deg, "src").cache()
    verts = (vertices.select("id") if vertices is not None else vertices_of(edges)).cache()
    return links, verts


def pagerank(edges: DataFrame, iters: int = 10, vertices: DataFrame | None = None,
             reset: float = 0.15) -> DataFrame:
    """Static PageRank over all vertices (every vertex keeps a rank;
    vertices without in-links have ``reset``).  Parallel edges count
    separately, as in a multigraph."""
    links, verts = _pr_inputs(edges, vertices)
    ranks = verts.withColumn("rank", F.lit(1.0))
    for i in range(iters):
        ranks = _cut(_pr_round(links, verts, ranks, reset), i)
    return ranks


def pagerank_tol(edges: DataFrame, tol: float = 1e-3, vertices: DataFrame | None = None,
                 reset: float = 0.15, max_iter: int | None = None) -> DataFrame:
    """PageRank until the largest change of a rank is below ``tol``; an
    error if a given ``max_iter`` is reached first."""
    links, verts = _pr_inputs(edges, vertices)
    ranks = _cut(verts.withColumn("rank", F.lit(1.0)), CHECKPOINT_EVERY - 1)
    for _ in rounds(max_iter):
        new = _pr_round(links, verts, ranks, reset)
        checkpoint_dir(new.sparkSession)
        new = new.checkpoint(eager=True)
        delta = (new.join(ranks.withColumnRenamed("rank", "old"), "id")
                    .agg(F.max(F.abs(F.col("rank") - F.col("old")))).first()[0])
        ranks = new
        if delta is None or delta < tol:
            break
    return ranks


# ---------------------------------------------------------------- components
def connected_components(edges: DataFrame, vertices: DataFrame | None = None,
                         max_iter: int | None = None) -> DataFrame:
    """Label = smallest vertex id of the component.

    Alternating star contraction on edges (a, b), a > b.  Large star: every
    neighbour above a vertex is linked to the vertex's smallest neighbour
    (or to itself if none is smaller).  Small star: a vertex and its smaller neighbours are
    linked to the smallest of them.  Both keep components connected and end in one star per
    component, after a number of rounds that grows with the logarithm of the longest path.

    Minima are partial aggregates, and an edge looks its minimum up by
    ``keyed_join``, so the adjacency of a hub is never in one task."""
    links = canonical_edges(edges).select(F.col("dst").alias("a"), F.col("src").alias("b"))
    links = _cut(links, CHECKPOINT_EVERY - 1)
    verts = vertices.select("id") if vertices is not None else vertices_of(edges)
    for _ in rounds(max_iter):
        if _is_star_forest(links):
            break
        links = _small_star(_large_star(links)).distinct()
        links = _cut(links, CHECKPOINT_EVERY - 1)
    stars = links.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return verts.join(stars, "id", "left").select("id", F.coalesce("label", "id").alias("label"))


def _is_star_forest(links: DataFrame) -> bool:
    """Whether every upper end has one link and is no lower end."""
    ends = (links.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("low"))
                 .union(links.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("low"))))
    return (ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("low").alias("low"))
                .filter((F.col("up") > 1) | (F.col("up") > 0) & (F.col("low") > 0)).isEmpty())


def _large_star(links: DataFrame) -> DataFrame:
    """Every (a, b) becomes (a, smallest neighbour of b, or b)."""
    least = links.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("m"))
    joined = keyed_join(links, least, "b", links.count(), "left")
    star = joined.select("a", F.coalesce("m", "b").alias("b")).distinct()
    return _cut(star, CHECKPOINT_EVERY - 1)


def _small_star(links: DataFrame) -> DataFrame:
    """Every a and each of its b but the smallest becomes linked to the smallest."""
    least = links.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    several = least.filter("n > 1").select("a", "m")
    moved = keyed_join(links, several, "a", links.count()).filter(F.col("b") != F.col("m"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def _ensure(df: DataFrame) -> bool:
    checkpoint_dir(df.sparkSession)
    return True


def component_count(labels: DataFrame) -> DataFrame:
    return labels.agg(F.count_distinct("label").alias("components"))


# ---------------------------------------------------------------- triangles
def triangles(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """Triangles through each vertex (canonical simple graph).

    Edges are oriented from the lower to the higher (degree, id) end, so a
    vertex's out-list has at most sqrt(2m) entries even when it is a hub:
    the wedge join is bounded by O(m^1.5), never deg(hub)^2.
    """
    e = canonical_edges(edges).cache()
    deg = (e.select(F.col("src").alias("v")).union(e.select(F.col("dst").alias("v")))
            .groupBy("v").agg(F.count(F.lit(1)).alias("d")))
    rank = lambda c: F.struct(c + "_d", c)
    oe = (e.join(deg.select(F.col("v").alias("src"), F.col("d").alias("src_d")), "src")
           .join(deg.select(F.col("v").alias("dst"), F.col("d").alias("dst_d")), "dst"))
    oe = oe.select(F.when(rank("src") < rank("dst"), F.col("src")).otherwise(F.col("dst")).alias("a"),
                   F.when(rank("src") < rank("dst"), F.col("dst")).otherwise(F.col("src")).alias("b"))
    oe = oe.cache()
    w1 = oe.alias("x").join(oe.alias("y"), F.col("x.a") == F.col("y.a")) \
           .filter(F.col("x.b") != F.col("y.b")) \
           .select(F.col("x.a").alias("ta"), F.col("x.b").alias("tb"), F.col("y.b").alias("tc"))
    # close the wedge with an oriented edge b -> c (each triangle found once)
    tri = w1.join(oe.alias("z"), (F.col("tb") == F.col("z.a")) & (F.col("tc") == F.col("z.b"))) \
            .select("ta", "tb", "tc")
    per = tri.select(F.explode(F.array("ta", "tb", "tc")).alias("id")).groupBy("id").agg(
        F.count(F.lit(1)).alias("triangles"))
    verts = vertices.select("id") if vertices is not None else vertices_of(e)
    return verts.join(per, "id", "left").select("id", F.coalesce("triangles", F.lit(0)).cast("long")
                                                .alias("triangles"))


def triangle_total(per_vertex: DataFrame) -> DataFrame:
    return per_vertex.agg((F.sum("triangles") / 3).cast("long").alias("triangles"))


# ---------------------------------------------------------------- Pregel
def pregel(vertices: DataFrame, edges: DataFrame, init: Column, send, merge, vprog,
           max_iter: int | None = None, active_col: str = "_active", reads_dst: bool = True) -> DataFrame:
    """Bulk-synchronous message passing with DataFrame expressions.

    Edges are laid out by their source once, so a round moves the active
    vertices to the edges and not the edges.  With ``reads_dst`` off, ``send`` gets null for
    ``dst_value`` and messages merge where they are made, before they move.

    ``vertices``: (id, ...); ``init``: initial ``value`` expression;
    ``send(src_value, dst_value, edge)`` -> message Column or null (no
    message); ``merge`` an aggregate function over messages (e.g. F.min);
    ``vprog(value, msg)`` -> new value.  Only vertices whose value changed
    send in the next round; stops when no messages are sent.  Without
    ``max_iter`` the loop has no bound; with one, reaching it is an error.
    """
    v = vertices.withColumn("value", init).withColumn(active_col, F.lit(True))
    e = _by_source(edges)
    checkpoint_dir(v.sparkSession)
    cached = None
    for i in rounds(max_iter):
        src = v.select(F.col("id").alias("_s"), F.col("value").alias("src_value"), active_col)
        dst = v.select(F.col("id").alias("_d"), F.col("value").alias("dst_value"))
        trip = e.join(src.filter(F.col(active_col)), e.src == F.col("_s"))
        trip = trip.join(dst, e.dst == F.col("_d")) if reads_dst else trip.withColumn("dst_value", F.lit(None))
        msgs = (trip.select(F.col("dst").alias("_id"), send(F.col("src_value"), F.col("dst_value"), e)
                            .alias("_m"))
                    .filter(F.col("_m").isNotNull())
                    .groupBy("_id").agg(merge("_m").alias("_msg")))
        nv = v.join(msgs, v.id == msgs._id, "left")
        newval = F.when(F.col("_msg").isNull(), F.col("value")).otherwise(vprog(F.col("value"), F.col("_msg")))
        nv = nv.select(*[c for c in vertices.columns], newval.alias("value"),
                       (F.col("_msg").isNotNull() & (newval != F.col("value"))).alias(active_col))
        # one heavy job per round: materialise the new state (a reliable
        # checkpoint every few rounds, cached in between), then a cheap
        # scan of it decides whether anything changed
        if i % CHECKPOINT_EVERY == CHECKPOINT_EVERY - 1:
            nv = nv.checkpoint(eager=True)
        else:
            nv = nv.cache()
        still_active = nv.filter(F.col(active_col)).count()   # full scan fills the cache
        if cached is not None:
            cached.unpersist()
        cached = nv if nv.storageLevel.useMemory or nv.storageLevel.useDisk else None
        v = nv
        if still_active == 0:
            break
    return v.drop(active_col)


EDGES_PER_BUCKET = 2_000_000


def _by_source(edges: DataFrame) -> DataFrame:
    """The edges as a table bucketed by source, which joins on it without a shuffle."""
    spark = edges.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    n = min(50_000, max(1, width, -(-edges.count() // EDGES_PER_BUCKET)))
    name = f"edges_{uuid.uuid4().hex}"
    (edges.repartition(n, "src").write.option("path", f"{checkpoint_dir(spark)}/{name}")
         .bucketBy(n, "src").sortBy("src").saveAsTable(name))
    return spark.table(name)


def sssp(edges: DataFrame, source, vertices: DataFrame | None = None, weight: str = "weight") -> DataFrame:
    """Single-source shortest paths (min relaxation); unreachable = +inf."""
    verts = vertices.select("id") if vertices is not None else vertices_of(edges)
    e = edges.select("src", "dst", F.col(weight).cast("double").alias("w"))
    init = F.when(F.col("id") == F.lit(source), F.lit(0.0)).otherwise(F.lit(float("inf")))
    out = pregel(verts, e, init,
                 send=lambda s, d, ed: s + ed["w"], merge=F.min, vprog=lambda v, m: F.least(v, m), reads_dst=False)
    return out.select("id", F.col("value").alias("distance"))


# ---------------------------------------------------------------- neighbourhood
def neighbour_mean(vertices: DataFrame, edges: DataFrame, attr: str) -> DataFrame:
    """aggregateMessages: each edge sends (1, attr[src]) to dst when
    attr[src] > attr[dst]; result per receiving vertex: count and mean.
    Vertices that receive nothing are absent."""
    a = vertices.select(F.col("id").alias("_s"), F.col(attr).alias("sa"))
    b = vertices.select(F.col("id").alias("_d"), F.col(attr).alias("da"))
    t = edges.join(a, edges.src == a._s).join(b, edges.dst == b._d).filter(F.col("sa") > F.col("da"))
    return t.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("senders"),
                                                   F.avg("sa").alias("mean_attr"))


def degrees(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """In + out degree per vertex; vertices without edges have 0."""
    ends = edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id")))
    d = ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    if vertices is None:
        return d
    return vertices.select("id").join(d, "id", "left").select("id", F.coalesce("degree", F.lit(0)).alias("degree"))


def degree_hist(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """Number of vertices per degree value."""
    return degrees(edges, vertices).groupBy("degree").agg(F.count(F.lit(1)).alias("vertices"))


def subgraph(vertices: DataFrame, edges: DataFrame, vpred: Column) -> tuple[DataFrame, DataFrame]:
    """Vertices satisfying ``vpred`` and the edges whose two ends are kept."""
    v = vertices.filter(vpred)
    ids = v.select("id")
    e = (edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
              .join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi"))
    return v, e


# ---------------------------------------------------------------- closure
def transitive_closure(edges: DataFrame, max_iter: int | None = None) -> DataFrame:
    """All (x, z) with a path x -> z.  Semi-naive: each round extends only
    the pairs found in the previous round, and keeps the ones not yet known
    (left anti join); stops when a round finds nothing new."""
    e = edges.select("src", "dst").distinct().cache()
    closure = e
    delta = e
    for i in rounds(max_iter):
        step = (delta.alias("p").join(e.alias("q"), F.col("p.dst") == F.col("q.src"))
                     .select(F.col("p.src").alias("src"), F.col("q.dst").alias("dst")).distinct())
        new = step.join(closure, ["src", "dst"], "left_anti")
        checkpoint_dir(new.sparkSession)
        new = new.checkpoint(eager=True)
        if new.limit(1).count() == 0:
            break
        closure = closure.unionByName(new)
        closure = _cut(closure, i)
        delta = new
    return closure


# ---------------------------------------------------------------- partitioning
def partition_edges(edges: DataFrame, strategy: str, n: int) -> DataFrame:
    """Assign each edge to one of ``n`` partitions (column ``part``) and
    repartition by it.  Strategies: random (hash of both ends), 1d (hash of
    source), 2d (grid on sqrt(n) x sqrt(n)), canonical (hash of the
    unordered pair)."""
    import math
    s, d = F.col("src"), F.col("dst")
    if strategy == "random":
        p = F.pmod(F.hash(s, d), F.lit(n))
    elif strategy == "1d":
        p = F.pmod(F.hash(s), F.lit(n))
    elif strategy == "2d":
        side = int(math.ceil(math.sqrt(n)))
        p = F.pmod(F.pmod(F.hash(s), F.lit(side)) * side + F.pmod(F.hash(d), F.lit(side)), F.lit(n))
    elif strategy == "canonical":
        p = F.pmod(F.hash(F.least(s, d), F.greatest(s, d)), F.lit(n))
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return edges.withColumn("part", p.cast("int")).repartition(n, "part")


def pic(similarities: DataFrame, k: int, iters: int = 20, init: str = "degree", rows_per_block: int | None = None) -> DataFrame:
    """Power iteration clustering on (src, dst, weight) similarities: (id, cluster).
    Every unordered pair counts once, so parallel and opposite edges are
    added up and loops left out.  ``init`` "degree" draws nothing at random.

    The pairs are packed into blocks once, both ways; a round multiplies the vector by the
    weights over their row sums, sending only the vector's numbers.  The rounds, their end and
    the clustering of the vector's numbers are those of the ML estimator."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    if init not in ("degree", "random"):
        raise ValueError(f"no such start: {init}")
    spark = similarities.sparkSession
    base = f"{checkpoint_dir(spark)}/pic-{uuid.uuid4().hex}"
    a, b = F.least("src", "dst"), F.greatest("src", "dst")
    (similarities.filter(F.col("src") != F.col("dst")).groupBy(a.cast("long").alias("src"), b.cast("long").alias("dst"))
                 .agg(F.sum("weight").cast("double").alias("weight")).write.parquet(f"{base}/pairs"))
    pairs = spark.read.parquet(f"{base}/pairs")
    if not pairs.filter(F.col("weight").isNull() | F.isnan("weight") | (F.col("weight") < 0)).isEmpty():
        raise ValueError("a weight is null, NaN or negative")
    total = 2 * pairs.count()
    if not total:
        raise ValueError("no pairs")
    side = blocks.pack_symmetric(pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")),
                                 "src", "dst", "weight", total, rows_per_block)
    hot, tiny = len(side.hot), float(np.finfo(float).eps)

    def multiply(block, n, keys, others, w, f):
        row, degree = np.bincount(keys, w * f[others, 0], n), np.bincount(keys, w, n)
        own = n - hot
        return pd.DataFrame({"block": [block], "f": [row[:own] / np.maximum(degree[:own], tiny)], "degree": [degree[:own]],
                             "hot": [np.concatenate([row[own:], degree[own:]])]})

    def moved(state, hot_values, path):
        blocks.step(side, side, state, hot_values, 1, multiply,
                    "block int, f array<double>, degree array<double>, hot array<double>").write.parquet(path)
        out, sums = spark.read.parquet(path), np.zeros(2 * hot)
        if hot:
            for pos, v in out.select(F.posexplode("hot").alias("pos", "v")).groupBy("pos").agg(F.sum("v")).collect():
                sums[pos] = v                                          # the few hot vertices' sums
        return out, sums[:hot] / np.maximum(sums[hot:], tiny), sums[hot:]

    def added(df, c):
        return float(df.agg(F.sum(F.aggregate(c, F.lit(0.0), lambda s, x: s + F.abs(x)))).first()[0])

    ones = side.blocks.select("block", F.transform("ids", lambda _: F.lit(1.0)).alias("f"))
    ones.write.parquet(f"{base}/ones")
    out, _, degrees = moved(spark.read.parquet(f"{base}/ones"), np.ones(hot), f"{base}/degrees")
    if init == "degree":
        state, at_hot = out.select("block", F.col("degree").alias("f")), degrees
    else:
        def draw(batches):
            for pdf in batches:
                pdf["f"] = [np.random.default_rng(b + 1).normal(size=len(x)) for b, x in zip(pdf["block"], pdf["f"])]
                yield pdf
        out.select("block", "f").mapInPandas(draw, "block int, f array<double>").write.parquet(f"{base}/start")
        state, at_hot = spark.read.parquet(f"{base}/start"), np.random.default_rng(0).normal(size=hot)
    norm = added(state, "f") + float(np.abs(at_hot).sum())
    vertices = side.blocks.agg(F.sum(F.size("ids"))).first()[0] + hot
    limit, before, change = max(1e-5 / vertices, 1e-8), float("inf"), float("inf")
    state, at_hot = _scaled(state, norm), at_hot / norm
    for i in range(iters):
        if not change > limit:
            break
        out, next_hot, _ = moved(state, at_hot, f"{base}/round{i}")
        norm = added(out, "f") + float(np.abs(next_hot).sum())
        after, next_hot = _scaled(out, norm), next_hot / norm
        both = after.join(state.withColumnRenamed("f", "was"), "block")
        delta = added(both, F.zip_with("f", "was", lambda x, y: x - y)) + float(np.abs(next_hot - at_hot).sum())
        before, change = delta, abs(delta - before)
        state, at_hot = after, next_hot
    # a join that is sorted must not lie below the rows k-means keeps: a partition without rows on one side ends in an error
    (side.blocks.select("block", "ids").groupBy("block").cogroup(state.groupBy("block"))
         .applyInPandas(lambda own, at: pd.DataFrame({"id": own["ids"].iloc[0], "v": at["f"].iloc[0]}), "id long, v double")
         .write.parquet(f"{base}/points"))
    points = spark.read.parquet(f"{base}/points")
    if hot:
        points = points.unionByName(spark.createDataFrame([(h, float(x)) for h, x in zip(side.hot, at_hot)], "id long, v double"))
    points = points.select("id", array_to_vector(F.array("v")).alias("features"))
    model = KMeans(k=k, seed=0, predictionCol="cluster").fit(points)
    return model.transform(points).select("id", "cluster")


def _scaled(state: DataFrame, norm: float) -> DataFrame:
    return state.select("block", F.transform("f", lambda x: x / F.lit(norm)).alias("f"))
