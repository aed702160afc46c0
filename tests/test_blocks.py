import numpy as np
import pytest

from skyframe.ml import models as md


def _by_hand(rows, rank, iters, lam, start, alpha):
    users, items = (sorted({r[c] for r in rows}) for c in (0, 1))
    v, u, history = {i: np.array(start[i]) for i in items}, {}, []

    def solve(key, at, to, fixed):
        mine = [r for r in rows if r[at] == key]
        a, b = lam * len(mine) * np.eye(rank), np.zeros(rank)
        if alpha is not None:
            a = a + sum(np.outer(f, f) for f in fixed.values())
        for r in mine:
            f = fixed[r[to]]
            w = 1.0 if alpha is None else alpha * abs(r[2])
            a, b = a + w * np.outer(f, f), b + f * (r[2] if alpha is None else (1 + w) * (r[2] > 0))
        return np.linalg.solve(a, b)

    for _ in range(iters):
        u = {k: solve(k, 0, 1, v) for k in users}
        v = {k: solve(k, 1, 0, u) for k in items}
        history.append(float(np.sqrt(np.mean([(r[2] - u[r[0]] @ v[r[1]]) ** 2 for r in rows]))))
    return u, v, history


@pytest.mark.parametrize("alpha", [None, 0.5])
@pytest.mark.parametrize("size", [None, 40])
def test_als_in_blocks_with_hot_keys(spark, alpha, size):
    rng = np.random.default_rng(5)
    rows = [(f"u{a}", int(b) * 7, float(rng.integers(-1, 6))) for a in range(30) for b in range(25)
            if rng.random() < 0.2 or a == 3 or b == 4]
    odd = [(None, 7, 2.0), ("u1", None, 2.0), (None, None, None)]
    df = spark.createDataFrame(rows + odd, "user string, item long, rating double").repartition(3)
    u, v, history = md.als_by_hand(df, rank=3, iters=2, lam=0.1, alpha=alpha, rows_per_block=size)
    start = {r["id"]: r["f"] for r in md._init_factors(df.dropna().select("item").distinct(), "item", 3, 42).collect()}
    want_u, want_v, want = _by_hand(rows, 3, 2, 0.1, start, alpha)
    for table, expected in ((u, want_u), (v, want_v)):
        got = {r["id"]: r["f"] for r in table.collect()}
        assert sorted(got) == sorted(expected) and all(np.allclose(got[k], f) for k, f in expected.items())
    if alpha is None:
        assert history == pytest.approx(want)


def test_als_refuses_a_null_rating(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (2, 1, None)], "user int, item int, rating double")
    with pytest.raises(Exception):
        md.als_by_hand(df, rank=2, iters=1)
