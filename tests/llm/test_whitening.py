import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import whitening as wh


def plain(vectors, k=32):
    """(x, n, deviations, covariance, eigenvalues, axes) with Python's whole numbers and one dense decomposition."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    top = [[n * c - t for c, t in zip(r, s, strict=True)] for r in x]
    z = np.array([[t / n for t in r] for r in top])
    values, axes = np.linalg.eigh(z.T @ z / n)
    return z, [sum(t * t for t in r) for r in top], values[::-1][:k], axes[:, ::-1][:, :k], np.trace(z.T @ z / n)


def test_query_by_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    z, dev, values, axes, trace = plain([r.embedding for r in rows])
    got = wh.op12_embedding_whitening(spark, sf).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component) for r in got] == [(r.vec_id, c + 1) for r in rows for c in range(32)]
    assert [r.deviation for r in got[::32]] == dev and {r.n for r in got} == {len(rows)}
    mine = np.array([r.whitened for r in got]).reshape(len(rows), 32)
    want = z @ (axes / np.sqrt(values))
    assert np.abs(mine * np.sign((mine * want).sum(0)) - want).max() < 1e-8
    assert np.allclose([r.explained for r in got[:32]], values / trace, rtol=1e-9)
    off = np.abs(mine.T @ mine / len(rows) - np.eye(32)).max()
    assert {r.identity_error for r in got} == {got[0].identity_error} and off < 1e-9 and got[0].identity_error < 1e-9


@pytest.mark.parametrize("case", ["falling", "clustered", "copies", "low rank", "zero", "one", "narrow"])
def test_leading_pairs(case):
    rng = np.random.default_rng(3)
    d = {"one": 1, "narrow": 5}.get(case, 400)
    values = {"falling": 0.9 ** np.arange(d), "clustered": 64 + rng.standard_normal(d), "copies": np.r_[np.full(40, 9.0), np.ones(max(0, d - 40))], "low rank": np.r_[np.arange(20.0, 0, -1), np.zeros(max(0, d - 20))], "zero": np.zeros(d)}.get(case, np.arange(d, 0.0, -1))
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    a = (q * values) @ q.T
    calls = []
    got, axes, told = wh.leading(lambda w: (calls.append(w.shape[1]), a @ w)[1], d, 32, most=None if case != "clustered" else d)
    k = min(32, d)
    assert np.allclose(got, np.sort(values)[::-1][:k], atol=1e-10 * max(1, values.max())) and np.allclose(axes.T @ axes, np.eye(k), atol=1e-10)
    assert np.linalg.norm(a @ axes - axes * got, axis=0).max() <= 1e-10 * max(1, values.max()) and told["passes"] == len(calls)
    assert (told["breakdowns"] > 0) == (case in ("low rank", "zero"))


def test_restarts_reach_the_same_pairs():
    rng = np.random.default_rng(4)
    d = 600
    q, values = np.linalg.qr(rng.standard_normal((d, d)))[0], 1 / np.arange(1, d + 1) ** 0.7
    a = (q * values) @ q.T
    got, axes, told = wh.leading(lambda w: a @ w, d, 10, block=4, most=30)
    assert told["restarts"] > 2 and np.allclose(got, values[:10], rtol=1e-11) and np.linalg.norm(a @ axes - axes * got, axis=0).max() < 1e-12
    assert np.allclose(np.abs((axes * q[:, :10]).sum(0)), 1, atol=1e-9)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    good = rng.standard_normal((40, 3)).tolist()
    rows = [(i, v, "x") for i, v in enumerate(good)] + [(None, [0.5, -0.25, 1e3], "x"), (7, good[7], "y"), (7, good[7], "y")]
    bad = [(100, None, None), (101, [1.0, None, 2.0], ""), (102, [nan, 1.0, 1.0], ""), (103, [1.0, -inf, 1.0], ""), (104, [], ""), (105, [1.0, 2.0], ""), (106, [1e300, 0.0, 0.0], "")]
    df = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<double>, component string").withColumns({"x": F.lit(1), "n": F.lit(2)}).repartition(4)
    out = wh.whiten(wh.fit(df)).orderBy("id", "component").collect()
    z, dev, values, axes, trace = plain([r[1] for r in rows])
    assert len(out) == 43 * 3 and sorted(int(r.deviation) for r in out if r.component == 1) == sorted(dev) and out[0].id is None
    assert np.allclose([r.explained for r in out[:3]], values / trace) and out[0].identity_error < 1e-9
    assert sorted(round(abs(r.whitened), 6) for r in out) == sorted(np.abs(z @ (axes / np.sqrt(values))).ravel().round(6).tolist())
    assert wh.whiten(wh.fit(df.limit(0))).collect() == [] and wh.whiten(wh.fit(df.where("vec_id = 3"))).collect() == []
    assert {r.component for r in wh.whiten(wh.fit(df.where("vec_id in (3, 4)"))).collect()} == {1}


def test_large_numbers_stay_exact(spark):
    big = [(i, [float(2**46 + i * 3), float(-i)]) for i in range(30)]
    model = wh.fit(spark.createDataFrame(big, "vec_id long, embedding array<double>"))
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in big]
    s = [sum(c) for c in zip(*x, strict=True)]
    assert model.vectors.sums == s
    assert {r.id: int(r.deviation) for r in wh.whiten(model).collect()} == {i: sum((30 * c - t) ** 2 for c, t in zip(r, s, strict=True)) for i, r in enumerate(x)}
