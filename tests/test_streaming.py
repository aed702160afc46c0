"""Streaming operators: stream result equals the batch result, restart
from a checkpoint, sessions with a processing-time timeout, seeded sums,
online learners."""

import glob
import math
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyframe.streaming import learners as lr
from skyframe.streaming import sinks as ssk
from skyframe.streaming import streams as st


def test_windowed_count_equals_batch(spark):
    rows = [(f"2024-01-01 00:{m:02d}:00", w) for m in range(0, 50, 3) for w in ("a", "b")]
    df = spark.createDataFrame(rows, "t string, word string").select(F.to_timestamp("t").alias("ts"), "word")
    batch = st.windowed_count(df, "ts", "word", "10 minutes", "5 minutes")
    stream = st.replay(spark, df, 3, order_col="ts")
    out = st.scratch(spark, "t-win")
    st.run(st.windowed_count(stream, "ts", "word", "10 minutes", "5 minutes"), "complete", ssk.replace_table(out))
    assert sorted(map(tuple, ssk.latest(spark, out).collect())) == sorted(map(tuple, batch.collect()))


def test_seeded_running_sum(spark):
    df = spark.createDataFrame([("hello world hello",), ("spark",)], "line string")
    stream = st.replay(spark, df, 2)
    out = st.scratch(spark, "t-seed")
    counts = st.split_words(stream, "line").groupBy("word").agg(F.count(F.lit(1)).alias("total"))
    seed = spark.createDataFrame([("hello", 1), ("world", 1)], "word string, total long")
    st.run(counts, "update", st.seeded_sums(seed, "word", out))
    got = {r.word: r.total for r in ssk.latest(spark, out).collect()}
    assert got == {"hello": 3, "world": 2, "spark": 1}


def test_sessions_event_time(spark):
    rows = [("u1", "2024-01-01 00:00:00"), ("u1", "2024-01-01 00:00:05"), ("u1", "2024-01-01 00:01:00"),
            ("u2", "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "k string, t string").select("k", F.to_timestamp("t").alias("ts"))
    got = sorted((r.k, r.num_events, r.duration_ms) for r in st.sessions(df, "k", "ts", "10 seconds").collect())
    assert got == [("u1", 1, 10000), ("u1", 2, 15000), ("u2", 1, 10000)]


def test_sessions_processing_time_timeout(spark, tmp):
    folder = f"{tmp}/in"
    spark.createDataFrame([("s1", "2024-01-01 00:00:00"), ("s1", "2024-01-01 00:00:03")], "id string, t string") \
        .select("id", F.to_timestamp("t").alias("ts")).write.parquet(folder)
    stream = st.files(spark, folder, "parquet", "id string, ts timestamp")
    sess = st.sessions_with_timeout(stream, "id", "ts", "1 second")
    q = sess.writeStream.outputMode("update").format("memory").queryName("sess_t") \
        .option("checkpointLocation", f"{tmp}/ck").trigger(processingTime="500 milliseconds").start()
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            rows = spark.sql("SELECT * FROM sess_t").collect()
            if any(r.expired for r in rows):
                break
            time.sleep(0.5)
    finally:
        q.stop()
    first = [r for r in rows if not r.expired][0]
    assert first.num_events == 2 and first.duration_ms == 3000
    assert any(r.expired for r in rows)


def test_restart_resumes_without_double_count(spark, tmp):
    folder, out, ck = f"{tmp}/in", f"{tmp}/out", f"{tmp}/ck"
    spark.createDataFrame([("a b",)], "line string").write.mode("append").parquet(folder)
    q = lambda: st.running_word_count(st.files(spark, folder, "parquet", "line string", 1), "line")
    st.run(q(), "complete", ssk.replace_table(out), checkpoint=ck)
    spark.createDataFrame([("a c",)], "line string").write.mode("append").parquet(folder)
    st.run(q(), "complete", ssk.replace_table(out), checkpoint=ck)
    assert {r.word: r["count"] for r in ssk.latest(spark, out).collect()} == {"a": 2, "b": 1, "c": 1}


def test_upsert_sink_last_value_wins(spark, tmp):
    w = ssk.upsert_parquet(f"{tmp}/t", ["k"])
    w(spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), 0)
    w(spark.createDataFrame([(2, "z")], "k int, v string"), 1)
    assert sorted(map(tuple, ssk.latest(spark, f"{tmp}/t").collect())) == [(1, "x"), (2, "z")]
    ssk.batch_dirs(f"{tmp}/b")(spark.createDataFrame([], "k int"), 0)
    import os
    assert not os.path.exists(f"{tmp}/b/batch=0")          # empty batch skipped


def test_streaming_kmeans_update_rule(spark):
    km = lr.StreamingKMeans([[0.0, 0.0], [10.0, 10.0]], decay=1.0)
    b1 = spark.createDataFrame([([1.0, 1.0],), ([9.0, 9.0],)], "features array<double>")
    km.update(b1, 0)
    assert km.centres.tolist() == [[1.0, 1.0], [9.0, 9.0]]
    km.update(spark.createDataFrame([([3.0, 3.0],)], "features array<double>"), 1)
    assert km.centres[0].tolist() == [2.0, 2.0]          # (1*1 + 3) / 2


def test_streaming_regressions_learn(spark):
    rows = [([float(x), 1.0], 2.0 * x + 1.0) for x in [0.0, 0.5, 1.0, 1.5, 2.0]]
    df = spark.createDataFrame(rows, "features array<double>, label double")
    m = lr.StreamingLinearRegression(2, step=1.0, iters=200)
    m.update(df, 0)
    assert m.w[0] == pytest.approx(2.0, abs=0.2) and m.w[1] == pytest.approx(1.0, abs=0.3)
    lg = lr.StreamingLogisticRegression(2, step=1.0, iters=100)
    lg.update(spark.createDataFrame([([-2.0, 1.0], 0.0), ([2.0, 1.0], 1.0)] * 5,
                                    "features array<double>, label double"), 0)
    assert lg.w[0] > 0


def test_welch_p_value():
    t, dof, p = lr.welch(10, 1.0, 1.0, 10, 0.0, 1.0)
    assert t == pytest.approx(2.2360679, rel=1e-6) and dof == pytest.approx(18.0)
    assert p == pytest.approx(0.03818, abs=1e-4)       # two-sided t(18) at 2.236


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, tmp):
    import os
    path = f"{tmp}/bt"
    w = ssk.upsert_bucketed(path, ["k"], 8)
    w(spark.createDataFrame([(i, "a") for i in range(40)], "k int, v string"), 0)
    before = {d: os.path.getmtime(f"{path}/{d}") for d in os.listdir(path) if d.startswith("_bucket=")}
    w(spark.createDataFrame([(3, "b")], "k int, v string"), 1)
    w(spark.createDataFrame([(3, "b")], "k int, v string"), 1)          # replayed batch: same result
    got = {r.k: r.v for r in ssk.read_bucketed(spark, path).collect()}
    assert len(got) == 40 and got[3] == "b" and got[4] == "a"
    after = {d: os.path.getmtime(f"{path}/{d}") for d in os.listdir(path) if d.startswith("_bucket=")}
    assert sum(1 for d in before if after[d] != before[d]) == 1


def test_learner_state_resumes(spark, tmp):
    path = f"{tmp}/km"
    km = lr.StreamingKMeans([[0.0], [10.0]], state_path=path)
    km.update(spark.createDataFrame([([1.0],), ([9.0],)], "features array<double>"), 0)
    back = lr.StreamingKMeans.resume(spark, path, [[0.0], [10.0]])
    assert back.centres.tolist() == [[1.0], [9.0]] and back.weights.tolist() == [1.0, 1.0]


def test_ab_test_stops_when_significant(spark):
    t = lr.StreamingABTest("g", "v")
    rows = [(True, 10.0 + i % 3) for i in range(30)] + [(False, 0.0 + i % 3) for i in range(30)]
    t.update(spark.createDataFrame(rows, "g boolean, v double"), 0)
    assert t.should_stop() and t.results[-1][3] < 0.05


def test_replayed_batches_count_once(spark, tmp):
    b = spark.createDataFrame([([1.0],), ([9.0],)], "features array<double>")
    km = lr.StreamingKMeans([[0.0], [10.0]], state_path=f"{tmp}/km")
    km.update(b, 0)
    km.update(b, 0)
    assert km.weights.tolist() == [1.0, 1.0]
    back = lr.StreamingKMeans.resume(spark, f"{tmp}/km", [[0.0], [10.0]])
    back.update(b, 0)
    assert back.weights.tolist() == [1.0, 1.0]
    rows = spark.createDataFrame([([1.0], 2.0), ([2.0], 4.0)], "features array<double>, label double")
    m = lr.StreamingLinearRegression(1, step=0.1, iters=3, state_path=f"{tmp}/lin")
    m.update(rows, 0)
    again = lr.StreamingLinearRegression.resume(spark, f"{tmp}/lin", 1, step=0.1, iters=3)
    assert again.t == 3
    again.update(rows, 0)
    again.update(rows, 1)
    m.update(rows, 1)
    assert again.w.tolist() == m.w.tolist()


def test_ab_test_state_resumes(spark, tmp):
    rows = spark.createDataFrame([(True, 1.0), (True, 2.0), (False, 1.5), (False, 3.5)] * 4, "g boolean, v double")
    t = lr.StreamingABTest("g", "v", state_path=f"{tmp}/ab")
    t.update(rows, 0)
    back = lr.StreamingABTest.resume(spark, f"{tmp}/ab", group="g", value="v")
    back.update(rows, 0)
    back.update(rows, 1)
    t.update(rows, 1)
    assert len(t.batches) == 1 and back.results[-1] == t.results[-1]


def test_late_files_with_earlier_names_are_read_once(tmp):
    import os
    from skyframe.streaming.custom_source import LineFilesStreamReader
    reader = LineFilesStreamReader(tmp)
    start = reader.initialOffset()
    with open(f"{tmp}/b.txt", "w") as f:
        f.write("one\ntwo")
    end = reader.latestOffset()
    first = reader.partitions(start, end)
    assert [os.path.basename(p.path) for p in first] == ["b.txt"]
    assert list(reader.read(first[0])) == [("one",), ("two",)]
    with open(f"{tmp}/a.txt", "w") as f:
        f.write("late\n")
    os.utime(f"{tmp}/a.txt", (os.path.getmtime(f"{tmp}/b.txt") + 1,) * 2)
    later = reader.latestOffset()
    assert [os.path.basename(p.path) for p in reader.partitions(end, later)] == ["a.txt"]
    assert reader.partitions(later, reader.latestOffset()) == []


def test_files_of_a_batch_follow_the_bytes_of_its_rows(spark, tmp, monkeypatch):
    """Text that repeats takes little room as stored, but not in a shuffle."""
    spark.range(4_000).selectExpr("repeat('word ', 200) AS line").coalesce(1).write.parquet(f"{tmp}/in")
    df = spark.read.parquet(f"{tmp}/in")
    assert sum(os.path.getsize(f) for f in glob.glob(f"{tmp}/in/*.parquet")) < 100_000
    monkeypatch.setattr(st, "FILE_BYTES", 300_000)           # 4 MB: a batch of four holds 3.3 such files
    assert st.files_per_batch(df, 4) == 4
    st.replay(spark, df, 4, folder=f"{tmp}/out")
    assert len(glob.glob(f"{tmp}/out/*.parquet")) == 16


def test_restartable_count_has_a_fixed_number_of_triggers(spark, tmp, monkeypatch):
    """However many files the documents are, each half is two batches."""
    from skyframe.plans import registry
    rows = [(i, f"a b{i % 3}\nc") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(20).write.parquet(f"{tmp}/documents.parquet")
    made = []
    monkeypatch.setattr(registry.ssk, "replace_table", lambda out, real=registry.ssk.replace_table: lambda b, i: (
        made.append(i), real(out)(b, i)))
    got = {r.word: r["count"] for r in registry.QUERIES["str10_restartable"](spark, tmp).collect()}
    assert got == {"a": 60, "b0": 20, "b1": 20, "b2": 20, "c": 60}
    assert len(made) == registry.N_BATCHES


@pytest.mark.parametrize("kind,passes", [(lr.StreamingLinearRegression, 1), (lr.StreamingLogisticRegression, 6)])
def test_learner_steps_equal_the_gradient_steps(spark, monkeypatch, kind, passes):
    """Weights of the plain formula; a null is an error and leaves the model as
    it was.  Least squares makes one pass however many steps it takes."""
    rows = [([math.sin(i), i % 5 / 5, 1.0], float(i % 3 == 0)) for i in range(300)]
    odd = [([1.0, None, 1.0], 1.0), ([1.0, 2.0, 3.0], None), (None, 0.0)]
    kinds = "features array<double>, label double"
    df = spark.createDataFrame(rows, kinds)
    calls, total = [], lr._total
    monkeypatch.setattr(lr, "_total", lambda *a: calls.append(1) or total(*a))
    m = kind(3, step=0.5, iters=6)
    m.update(df, 0)
    x, y, w = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.zeros(3)
    for t in range(1, 7):
        z = x @ w
        p = z if kind is lr.StreamingLinearRegression else 1 / (1 + np.exp(-z))
        w = w - 0.5 / math.sqrt(t) * ((p - y) @ x) / len(rows)
    assert np.allclose(m.w, w, atol=1e-12)
    assert len(calls) == passes
    for row in odd:
        with pytest.raises(Exception, match="null among"):
            m.update(df.union(spark.createDataFrame([row], kinds)), 1)
    assert np.allclose(m.w, w, atol=1e-12) and m.last == 0


@pytest.mark.parametrize("kind, win, slide", [("timestamp_ntz", "1 hour", "15 minutes"), ("timestamp", "50 minutes", "20 minutes")])
def test_window_users_on_a_stream_are_those_of_the_batch_in_few_rows_of_state(spark, tmp, kind, win, slide):
    """Users that come again or are null, times that are null or before 1970, windows in two blocks, parts from several batches."""
    from skyframe.operators import clicks as ck
    from skyframe.session import ship_package
    ship_package(spark)
    df = spark.range(260_000).select(
        F.when(F.col("id") % 1000 != 7, F.col("id") * 7919 % 4001).alias("user_id"),
        F.when(F.col("id") % 5000 != 3, F.timestamp_seconds(F.lit(-86_400) + F.col("id") * 104_729 % 259_200)).cast(kind).alias("ts"))
    df = df.unionByName(df.limit(500)).unionByName(df.filter("user_id = 5"))
    seen = {}

    def write(batch, i):
        batch.write.mode("overwrite").parquet(f"{tmp}/pairs-{i}")
        seen["last"] = i

    q = st.run(ck.window_users(st.replay(spark, df, 3, folder=f"{tmp}/in"), win, slide), "complete", write)
    got, want = spark.read.parquet(f"{tmp}/pairs-{seen['last']}"), ck.window_users(df, win, slide)
    assert dict(got.dtypes) == dict(want.dtypes) and got.count() == want.count() > 500_000
    assert got.exceptAll(want).isEmpty()
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] < 2000
