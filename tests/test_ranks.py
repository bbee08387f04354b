"""Nearest ranks by brackets against sorted lists."""

import math
import random

from millrace.operators import aggregates as agg


def test_nearest_ranks(spark):
    rng = random.Random(61)
    groups = {"ties": [rng.randrange(5) for _ in range(3000)], "one": [7], "two": [1, 2], "same": [4] * 500, "wide": [rng.gauss(0, 1e6) for _ in range(60_000)], None: [float(i) for i in range(999)], "steps": [float(i // 100) for i in range(20_000)]}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("ties", None), ("nothing", None)]
    ranks = {"low": 0.0, "first": 0.0001, "p25": 0.25, "median": 0.5, "p95": 0.95, "top": 1.0}
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: tuple(r)[1:] for r in agg.nearest_ranks(df, "g", "v", ranks).collect()}
    want = {k: tuple(sorted(vs)[max(1, math.ceil(len(vs) * q)) - 1] for q in ranks.values()) for k, vs in groups.items()}
    assert got == want
    assert agg.nearest_ranks(df.limit(0), "g", "v", ranks).count() == 0


def test_many_groups_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(agg, "FEW_GROUPS", 3)
    df = spark.range(1000).selectExpr("id % 10 as g", "cast(id as double) as v")
    out = agg.nearest_ranks(df, "g", "v", {"median": 0.5})
    assert {r.g: r["median"] for r in out.collect()} == {g: float(g + 490) for g in range(10)}
