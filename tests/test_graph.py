"""Graph operators on a small hand-made graph with a cycle, a sink and an
isolated vertex, checked against values computed by hand or brute force."""

import itertools

import pytest
from pyspark.sql import functions as F

from skyframe.operators import graph as gr

EDGES = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (6, 7)]   # cycle 1-2-3, tail 3-4-5, pair 6-7


@pytest.fixture()
def edges(spark):
    return spark.createDataFrame([(a, b, 1.0) for a, b in EDGES], "src long, dst long, weight double")


def test_connected_components(spark, edges):
    verts = spark.createDataFrame([(i,) for i in range(1, 9)], "id long")   # 8 is isolated
    got = {r.id: r.label for r in gr.connected_components(edges, verts).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 6, 7: 6, 8: 8}
    assert gr.component_count(gr.connected_components(edges, verts)).first()[0] == 3


def test_sssp(spark, edges):
    got = {r.id: r.distance for r in gr.sssp(edges, 1).collect()}
    assert got[1] == 0 and got[4] == 3 and got[5] == 4 and got[6] == float("inf")


def test_triangles(spark):
    # K4 plus a pendant: each K4 vertex is in 3 triangles
    e = [(a, b) for a, b in itertools.combinations([1, 2, 3, 4], 2)] + [(4, 5), (2, 1)]
    df = spark.createDataFrame(e, "src long, dst long")
    got = {r.id: r.triangles for r in gr.triangles(df).collect()}
    assert got == {1: 3, 2: 3, 3: 3, 4: 3, 5: 0}
    assert gr.triangle_total(gr.triangles(df)).first()[0] == 4


def test_pagerank_forms(spark, edges):
    naive = {r.id: r.rank for r in gr.pagerank_naive(edges, 1).collect()}
    # one round: 2 gets 1.0 from 1; 3 gets 1.0 from 2; 1 and 4 get 0.5 each from 3
    assert naive[2] == pytest.approx(0.15 + 0.85) and naive[1] == pytest.approx(0.15 + 0.85 * 0.5)
    assert 6 not in naive          # no in-links: dropped
    full = {r.id: r.rank for r in gr.pagerank(edges, 10).collect()}
    assert full[6] == pytest.approx(0.15) and len(full) == 7
    tol = {r.id: r.rank for r in gr.pagerank_tol(edges, 1e-4).collect()}
    many = {r.id: r.rank for r in gr.pagerank(edges, 60).collect()}
    assert all(abs(tol[k] - many[k]) < 1e-2 for k in many)


def test_closure_degrees_subgraph(spark, edges):
    tc = {(r.src, r.dst) for r in gr.transitive_closure(edges).collect()}
    want = set()
    adj = {}
    for a, b in EDGES:
        adj.setdefault(a, set()).add(b)
    for s in adj:
        stack, seen = list(adj[s]), set()
        while stack:
            x = stack.pop()
            if x not in seen:
                seen.add(x)
                stack.extend(adj.get(x, ()))
        want |= {(s, x) for x in seen}
    assert tc == want
    verts = spark.createDataFrame([(i, i * 10) for i in range(1, 9)], "id long, age long")
    hist = {r.degree: r.vertices for r in gr.degree_hist(edges, verts).collect()}
    assert hist == {0: 1, 1: 3, 2: 3, 3: 1}
    v, e = gr.subgraph(verts, edges, F.col("age") <= 40)
    assert {(r.src, r.dst) for r in e.collect()} == {(1, 2), (2, 3), (3, 1), (3, 4)}
    nm = {r.id: (r.senders, r.mean_attr) for r in gr.neighbour_mean(verts, edges, "age").collect()}
    assert nm == {1: (1, 30.0)}


def test_edge_partitioning(spark, edges):
    for s in ("random", "1d", "2d", "canonical"):
        p = gr.partition_edges(edges, s, 4)
        assert p.count() == len(EDGES) and p.agg(F.max("part")).first()[0] < 4


def test_long_chains_reach_the_end(spark):
    """No bound on the rounds: a path longer than any small cap."""
    n = 70
    e = spark.createDataFrame([(i, i + 1, 1.0) for i in range(n)], "src long, dst long, weight double").cache()
    got = {r.id: r.distance for r in gr.sssp(e, 0).collect()}
    assert got == {i: float(i) for i in range(n + 1)}


def test_a_given_bound_that_is_reached_is_an_error(spark):
    import pytest
    e = spark.createDataFrame([(i, i + 1) for i in range(6)], "src long, dst long")
    with pytest.raises(RuntimeError):
        gr.transitive_closure(e, max_iter=2)
    assert gr.transitive_closure(e).count() == 21


def test_sssp_round_moves_no_edges(spark, monkeypatch):
    """Edges are shuffled once, when laid out; a round's plan reads them by bucket."""
    import random
    rnd = random.Random(3)
    rows = [(rnd.randrange(200), rnd.randrange(200), float(rnd.randrange(1, 9))) for _ in range(900)]
    rows += [(5, 6, float("nan")), (6, 5, None)]
    df = spark.createDataFrame(rows, "src long, dst long, weight double")
    plans, laid = [], gr._by_source
    monkeypatch.setattr(gr, "_by_source", lambda e: plans.append(laid(e)) or plans[-1])
    got = {r.id: r.distance for r in gr.sssp(df, 0).collect()}
    want = {v: float("inf") for r in rows for v in r[:2]} | {0: 0.0}
    for _ in want:
        for a, b, w in rows:
            if w is not None and w == w and want[a] + w < want[b]:
                want[b] = want[a] + w
    assert got == want
    few = spark.range(50).withColumnRenamed("id", "_s")
    plan = plans[0].hint("merge").join(few, plans[0]["src"] == few["_s"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan


def test_power_iteration_in_blocks(spark):
    """The clusters are those of the estimator, up to their numbers, in many blocks with hot vertices."""
    import random

    from pyspark.ml.clustering import PowerIterationClustering
    rng = random.Random(1)
    rows = [(0, 100, 0.01), (100, 300, 0.01), (7, 7, 5.0)]
    for lo, hi in ((0, 30), (100, 140), (300, 310)):
        rows += [(i, j, rng.random() + 0.1) for i in range(lo, hi) for j in rng.sample(range(lo, hi), 8)]
    df = spark.createDataFrame(rows, "src long, dst long, weight double")
    once = (df.filter("src <> dst").groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
              .agg(F.sum("weight").alias("weight")))
    p = PowerIterationClustering(k=3, maxIter=4, initMode="degree", weightCol="weight")
    want = {r.id: r.cluster for r in p.assignClusters(once).collect()}
    got = {r.id: r.cluster for r in gr.pic(df, 3, 4, rows_per_block=40).collect()}
    assert set(got) == set(want) and len({(want[i], got[i]) for i in want}) == 3
    assert gr.pic(df, 3, 0, init="random").count() == len(want)
    for odd in (None, -1.0, float("nan")):
        with pytest.raises(ValueError):
            gr.pic(df.union(spark.createDataFrame([(1, 400, odd)], df.schema)), 3)


def test_power_iteration_with_sorted_joins(spark):
    """Blocks too large to broadcast, and partitions that hold none: sorted joins
    under rows that k-means keeps ended in an error."""
    import random
    rng = random.Random(3)
    rows = [(0, 100, 0.01)]
    for lo, hi in ((0, 30), (100, 140)):
        rows += [(i, j, rng.random() + 0.1) for i in range(lo, hi) for j in rng.sample(range(lo, hi), 8)]
    df = spark.createDataFrame(rows, "src long, dst long, weight double")
    found = []
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            found.append({r.id: r.cluster for r in gr.pic(df, 2, 4, rows_per_block=100).collect()})
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    a, b = found
    assert set(a) == set(b) == {*range(30), *range(100, 140)} and len({(a[i], b[i]) for i in a}) == 2
