"""Unions by precedence, conflict checks, bag differences and flattening."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_sources(frames: dict[str, DataFrame], limit: int | None = None, order: str | None = None) -> DataFrame:
    """All sources under a column `source`; each is cut to ceil(limit / sources) rows in order where a limit is given."""
    per = -(-limit // len(frames)) if limit else None
    cut = [(df.orderBy(order).limit(per) if per and order else df).withColumn("source", F.lit(k)) for k, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cut)


def first_non_empty(frames: list[DataFrame]) -> DataFrame:
    """Rows of the first frame that has any: one pass, by the smallest precedence present."""
    every = reduce(lambda a, b: a.unionByName(b), [df.withColumn("_prec", F.lit(i)) for i, df in enumerate(frames)])
    return every.join(F.broadcast(every.agg(F.min("_prec").alias("_prec"))), "_prec").drop("_prec")


def conflicts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys in both, ignoring case."""
    return a.select(F.lower(key).alias("key")).intersect(b.select(F.lower(key).alias("key")))


def added_and_resolved(now: DataFrame, baseline: DataFrame) -> DataFrame:
    """Bag differences both ways, marked."""
    return now.exceptAll(baseline).withColumn("change", F.lit("added")).unionByName(baseline.exceptAll(now).withColumn("change", F.lit("resolved")))
