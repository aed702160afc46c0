"""Change files with a manifest, the log of seen files, learners that fail
half-way, and sessions closed by timers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from skyframe.streaming import learners as lr
from skyframe.streaming import sinks as ssk
from skyframe.streaming import streams as st
from skyframe.streaming.custom_source import LineFilesStreamReader


def rows(df):
    return sorted(map(tuple, df.collect()))


def written(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_delta_sink_writes_what_changed(spark, tmp):
    path, keys = f"{tmp}/t", ["k"]
    write = ssk.upsert_delta(path, keys, order_col="at", compact_every=3)
    assert ssk.read_delta(spark, path, keys) is None
    write(spark.range(5000).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(0).alias("at")), 0)
    size = written(path)
    for _ in range(2):                                        # a replayed batch changes nothing
        write(spark.createDataFrame([(3, "b", 1), (3, "c", 2), (9000, "n", 1)], "k long, v string, at int"), 1)
    assert written(path) - size < size / 3
    got = {r.k: r.v for r in ssk.read_delta(spark, path, keys).collect()}
    assert len(got) == 5001 and got[3] == "c" and got[4] == "a" and got[9000] == "n"
    write(spark.createDataFrame([(4, "d", 0)], "k long, v string, at int"), 2)
    state = ssk.manifest(spark, path)
    assert state["base"] and not state["changes"] and state["batch"] == 2
    got = {r.k: r.v for r in ssk.read_delta(spark, path, keys).collect()}
    assert len(got) == 5001 and (got[3], got[4]) == ("c", "d")
    for i in range(3, 6):
        write(spark.createDataFrame([(4, f"e{i}", 0)], "k long, v string, at int"), i)
    assert {r.k: r.v for r in ssk.read_delta(spark, path, keys).collect()}[4] == "e5"
    assert not any(n.startswith("change-000000000000") for n in os.listdir(path))      # replaced two merges ago


def test_delta_sink_shows_no_uncommitted_batch(spark, tmp, monkeypatch):
    path, keys = f"{tmp}/t", ["k"]
    write = ssk.upsert_delta(path, keys)
    write(spark.createDataFrame([(1, "a")], "k int, v string"), 0)
    commit = ssk._commit
    monkeypatch.setattr(ssk, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        write(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), 1)
    assert rows(ssk.read_delta(spark, path, keys)) == [(1, "a")]
    monkeypatch.setattr(ssk, "_commit", commit)
    write(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), 1)
    assert rows(ssk.read_delta(spark, path, keys)) == [(1, "b"), (2, "c")]


@pytest.mark.parametrize("make", [
    lambda p: lr.StreamingKMeans([[0.0], [10.0]], decay=0.5, state_path=p),
    lambda p: lr.StreamingLinearRegression(1, step=0.1, iters=2, state_path=p),
    lambda p: lr.StreamingLogisticRegression(1, step=0.1, iters=2, state_path=p),
    lambda p: lr.StreamingABTest("g", "v", state_path=p)])
@pytest.mark.parametrize("where", ["_next", "_save_state"])
def test_a_failed_batch_is_applied_once(spark, tmp, monkeypatch, make, where):
    data = spark.createDataFrame([([1.0], 2.0, True, 1.0), ([2.0], 0.0, True, 2.0), ([9.0], 1.0, False, 4.0), ([8.0], 1.0, False, 6.0)],
                                 "features array<double>, label double, g boolean, v double")
    good, bad = make(f"{tmp}/a"), make(f"{tmp}/b")
    good.update(data, 0)
    good.update(data, 1)
    bad.update(data, 0)
    owner = type(bad) if where == "_next" else lr
    real = getattr(owner, where)
    fails = iter([True])

    def once(*args):
        out = real(*args)
        if next(fails, False):
            raise OSError("lost after the work")
        return out
    monkeypatch.setattr(owner, where, once)
    with pytest.raises(OSError):
        bad.update(data, 1)
    bad.update(data, 1)
    bad.update(data, 1)
    same = lambda m: {k: v.tolist() if hasattr(v, "tolist") else v for k, v in vars(m).items() if k != "state_path"}
    assert same(good) == same(bad)


def put(folder, name, text, mtime=None):
    with open(f"{folder}/.{name}", "w") as f:
        f.write(text)
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")
    if mtime:
        os.utime(f"{folder}/{name}", (mtime, mtime))


def names(reader, a, b):
    return [os.path.basename(p.path) for p in reader.partitions(a, b)]


def test_renamed_files_are_read_once(tmp):
    reader = LineFilesStreamReader(tmp)
    start = reader.initialOffset()
    assert reader.latestOffset() == start
    put(tmp, "new.txt", "one", 2_000_000_000)
    first = reader.latestOffset()
    assert names(reader, start, first) == ["new.txt"]
    put(tmp, "old.txt", "two", 1_000_000_000)              # landed later, written earlier
    second = reader.latestOffset()
    assert names(reader, first, second) == ["old.txt"] and reader.latestOffset() == second
    again = LineFilesStreamReader(tmp)                     # after a restart: the same files behind the same offsets
    assert names(again, start, first) == ["new.txt"] and names(again, first, second) == ["old.txt"]
    put(tmp, "more.txt", "three")
    third = again.latestOffset()
    assert names(again, second, third) == ["more.txt"] and names(again, start, third) == ["new.txt", "old.txt", "more.txt"]
    with open(f"{tmp}/_seen/{1:012d}.json") as f:
        assert json.load(f) == ["new.txt"]


def test_half_written_log_entry_is_not_an_entry(tmp):
    put(tmp, "a.txt", "one")
    os.makedirs(f"{tmp}/_seen")
    with open(f"{tmp}/_seen/{1:012d}.json.tmp", "w") as f:
        f.write('["a.t')
    reader = LineFilesStreamReader(tmp)
    assert names(reader, reader.initialOffset(), reader.latestOffset()) == ["a.txt"]


def test_timers_close_every_session(spark, tmp):
    events = spark.createDataFrame([("u", 10), ("u", 13), ("w", 20)], "id string, s long").select(
        F.col("id").alias("user"), F.col("s").cast("timestamp").alias("ts"))
    out = f"{tmp}/out"
    write = ssk.upsert_delta(out, ["id"])
    s = st.sessions_with_timeout(st.replay(spark, events, 1), "user", "ts", "1 second")
    st.run_until_expired(s, lambda b, i: write(b.filter("expired"), i), timeout_seconds=90)
    assert rows(ssk.read_delta(spark, out, ["id"]).select("id", "duration_ms", "num_events")) == [("u", 3000, 2), ("w", 0, 1)]
