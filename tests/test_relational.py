"""Relational operators with their own logic: consecutive row ids, exact
stratified sampling, salted aggregation, hash splits."""

import math

from pyspark.sql import functions as F

from skyframe.operators import relational as rel
from skyframe.operators import sampling as smp
from skyframe.operators import text as tx


def test_with_index_is_consecutive_in_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(5)
    out = rel.with_index(df, ["k"]).collect()
    pairs = sorted((r.k, r.row_idx) for r in out)
    assert [i for _, i in pairs] == list(range(1000))


def test_exact_stratified_sample_matches_brute_force(spark):
    # one hot key holding most rows, as the skew rule demands
    rows = [("hot", i) for i in range(3000)] + [("a", i) for i in range(37)] + [("b", i) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, v long")
    fr = {"hot": 0.1, "a": 0.5, "b": 0.0}
    got = smp.by_key_exact(df, "k", fr, seed=3, max_exact_group=50)
    counts = {r.k: r.n for r in got.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"hot": 300, "a": math.ceil(0.5 * 37)}
    # brute force: the rows with the smallest hash per key
    h = df.withColumn("_h", smp._hash53(["k", "v"], 3)).toPandas()
    for key in ("hot", "a"):
        want = set(h[h.k == key].sort_values(["_h", "v"]).head(math.ceil(fr[key] * (h.k == key).sum())).v)
        have = {r.v for r in got.filter(F.col("k") == key).collect()}
        assert have == want


def test_salted_count_equals_plain_count(spark):
    df = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(999)], "k long, v long")
    a = {r.k: r["count"] for r in rel.group_count(df, "k").collect()}
    b = {r.k: r["count"] for r in rel.group_count(df, "k").collect()}
    assert a == b


def test_hash_split_is_a_partition(spark):
    df = spark.range(0, 2000)
    a, b = smp.split(df, [0.7, 0.3], seed=5, key=["id"])
    assert a.count() + b.count() == 2000 and a.join(b, "id").count() == 0
    assert 1200 < a.count() < 1600
    assert smp.take_sample(df, 10, 1).count() == 10


def test_block_list_and_word_count(spark):
    df = spark.createDataFrame([("a b c d",), ("d e",)], "line string")
    w = tx.words(df)
    kept, dropped = rel.drop_listed(w, "word", spark.createDataFrame([("a",), ("b",), ("c",)], "word string"))
    assert sorted(r.word for r in kept.collect()) == ["d", "d", "e"] and dropped.first().dropped == 3
    wc = {r.word: r["count"] for r in tx.word_count(df).collect()}
    assert wc["d"] == 2


def test_top_k_per_group_and_value_counts(spark):
    df = spark.createDataFrame([("u1", i, float(i)) for i in range(20)] + [("u2", 1, 1.0)], "u string, i int, s double")
    top = rel.top_k_per(df, "u", "s", 3)
    assert sorted((r.u, r.i) for r in top.collect()) == [("u1", 17), ("u1", 18), ("u1", 19), ("u2", 1)]
    vc = {r.u: (r["count"], round(r.fraction, 3)) for r in rel.value_counts(df, "u").collect()}
    assert vc == {"u1": (20, 0.952), "u2": (1, 0.048)}


def test_skew_join_equals_plain_join(spark):
    from skyframe.plans.joins import hot_keys, skew_join
    big = spark.createDataFrame([("hot", i) for i in range(500)] + [("a", 1), ("b", 2), (None, 3)], "k string, v int")
    other = spark.createDataFrame([("hot", "H"), ("a", "A"), ("c", "C")], "k string, name string")
    assert hot_keys(big, "k", 0.3) == ["hot"]
    for how in ("inner", "left"):
        want = sorted(map(tuple, big.join(other, "k", how).select("k", "v", "name").collect()), key=str)
        got = sorted(map(tuple, skew_join(big, other, "k", how, 0.3, 8).select("k", "v", "name").collect()), key=str)
        assert got == want


def test_bucketed_layout_joins_without_shuffle(spark, tmp):
    from skyframe.plans.layout import bucket_by_order, co_located_join
    names = bucket_by_order(spark, "/root/testdata/sf0.001", "t_layout", tmp, buckets=8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as for two large tables
    try:
        j = co_located_join(spark, names)
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert j.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()


def test_ordered_running_matches_window(spark):
    from pyspark.sql import Window
    rows = [("hot", i % 97, i) for i in range(3000)] + [("a", i, i) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, s long, item long").withColumn("hit", (F.col("item") % 3 == 0).cast("int"))
    got = rel.ordered_running(df, "k", [F.desc("s"), F.asc("item")], ["hit"])
    w = Window.partitionBy("k").orderBy(F.desc("s"), F.asc("item"))
    want = df.withColumn("rank", F.row_number().over(w)).withColumn(
        "cum_hit", F.sum("hit").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    a = sorted((r.k, r.item, r["rank"], r.cum_hit) for r in got.collect())
    b = sorted((r.k, r.item, r["rank"], r.cum_hit) for r in want.collect())
    assert a == b
