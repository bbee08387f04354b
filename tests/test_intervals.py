"""Overlap joins against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.intervals import overlap_join, overlap_totals

COLS = "k string, s long, e long, id long"


def side(rng, n, first):
    rows = []
    for i in range(n):
        s = rng.randrange(-500, 500)
        rows.append((rng.choice(["hot", "hot", "hot", "a", "b", None]), s if rng.random() > 0.03 else None, s + rng.choice([0, -3, 1, 1, 2, 5, 5, 9, 30, 200, 900]), first + i))
    return [*rows, *rows[:5]]


def join(a, b, **how):
    return overlap_join(a, b, (F.col("k"), F.col("k")), (F.col("s"), F.col("s")), (F.col("e"), F.col("e")), **how)


@pytest.mark.parametrize("how", [{}, {"width": 1}, {"hot": 7}, {"width": 3, "hot": 20}, {"width": 10_000}])
def test_all_pairs(spark, how):
    rng = random.Random(71)
    left, right = side(rng, 260, 0), side(rng, 200, 1000)
    got = join(spark.createDataFrame(left, COLS).repartition(4), spark.createDataFrame(right, COLS).repartition(3), **how).select("left.id", F.col("right.id").alias("other"))
    fine = lambda rows: [r for r in rows if None not in r and r[1] < r[2]]
    want = sorted((x[3], y[3]) for x in fine(left) for y in fine(right) if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    assert sorted(map(tuple, got.collect())) == want and want


def test_odd_sides(spark):
    none, one = spark.createDataFrame([], COLS), spark.createDataFrame([("a", 0, 2**40, 1), ("a", 5, 6, 2)], COLS)
    assert join(none, one).count() == join(one, none).count() == join(none, none).count() == 0
    assert sorted(map(tuple, join(one, one, width=1).select("left.id", "right.id").collect())) == [(1, 1), (1, 2), (2, 1), (2, 2)]
    plan = join(one, one)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def totals(a, b):
    return overlap_totals(a, b, (F.col("k"), F.col("k")), (F.col("s"), F.col("s")), (F.col("e"), F.col("e")), "id", "id")


def test_totals_of_all_pairs(spark):
    rng = random.Random(72)
    left, right = side(rng, 260, 0), side(rng, 200, 1000)
    got = totals(spark.createDataFrame(left, COLS).repartition(4), spark.createDataFrame(right, COLS).repartition(3))
    fine = lambda rows: [r for r in rows if None not in r and r[1] < r[2]]
    want = {}
    for x in fine(left):
        for y in fine(right):
            if x[0] == y[0] and x[1] < y[2] and y[1] < x[2]:
                n, total, least = want.get(x[3], (0, 0, y[3]))
                want[x[3]] = n + 1, total + min(x[2], y[2]) - max(x[1], y[1]), min(least, y[3])
    assert got.count() == len(want) and {r["id"]: (r["n"], r["total"], r["least"]) for r in got.collect()} == want


def test_totals_make_no_pairs(spark):
    none, far = spark.createDataFrame([], COLS), spark.createDataFrame([("a", -(2**40), 2**40, 1), ("a", 5, 6, 2)], COLS)
    assert totals(none, far).count() == totals(far, none).count() == totals(none, none).count() == 0
    assert sorted(map(tuple, totals(far, far).collect())) == [(1, 2, 2**41 + 1, 1), (2, 2, 2, 1)]
    n = 30_000  # all pairs of one key overlap: 900 million
    many = spark.range(n).selectExpr("'a' k", "-id s", "1 + id e", "id")
    assert totals(many, many).agg(F.sum("n"), F.min("least"), F.sum("total")).first()[:2] == (n * n, 0)
