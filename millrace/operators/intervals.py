"""Overlaps of intervals [start, end) under equal keys, by buckets of the axis; each pair comes once.

An interval stands in every bucket that it touches, and a pair is taken in the bucket where the later of the two starts.  Buckets are as
wide as the mean interval of the longer side, so an interval stands in few; very long ones stand in coarser buckets of
their own level (each level twice as wide as the one before), which the others look up.  A bucket with many rows on one side is dealt into
parts: that side's rows go to a part each, the other side's to all of them.

Pairs under one key grow with the square of its rows.  Where only totals are wanted, `overlap_totals` works them out without pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one side of a bucket that one part takes.
HOT = 5_000


def _level(length: Column, width: int) -> Column:
    """0 for intervals up to twice the width, then one more each time they are twice as long."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(length, F.lit(1)) / F.lit(2.0 * width)))).cast("int")


def _width(*sides: DataFrame) -> int:
    means = [s.agg(F.avg(F.col("_e") - F.col("_s"))).first()[0] for s in sides]
    return max(1, round(max([m for m in means if m is not None], default=1)))


def _dealt(near: DataFrame, far: DataFrame, hot: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a part: where `near` has more than `hot` rows in a bucket its rows are dealt, and `far`'s repeated."""
    at = ["_key", "_level", "_bucket"]
    parts = near.groupBy(*at).count().where(F.col("count") > hot).select(*at, F.ceil(F.col("count") / hot).cast("int").alias("_parts"))
    n = F.coalesce("_parts", F.lit(1))
    one = near.join(parts, at, "left").withColumn("_part", F.pmod(F.xxhash64("_s", "_e", F.to_json("_row")), n).cast("int")).drop("_parts")
    every = far.join(parts, at, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), n - 1))).drop("_parts")
    return one, every


def overlap_join(left: DataFrame, right: DataFrame, key: tuple[Column, Column], start: tuple[Column, Column], end: tuple[Column, Column], width: int | None = None, hot: int = HOT) -> DataFrame:
    """(left, right) structs of all pairs with equal keys and left.start < right.end and right.start < left.end.

    Starts and ends are whole numbers.  Rows with a null key, start or end, and intervals that are empty or backwards, pair with nothing.
    Repeated rows pair as often as they stand there.
    """
    sides = []
    for df, k, s, e in zip((left, right), key, start, end, strict=True):
        own = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), k.alias("_key"), s.cast("long").alias("_s"), e.cast("long").alias("_e"))
        sides.append(own.where("_key is not null and _s < _e"))
    width = width or _width(*sides)
    levels = [s.withColumn("_level", _level(F.col("_e") - F.col("_s"), width)) for s in sides]
    used = sorted({r[0] for s in levels for r in s.select("_level").distinct().collect()})  # some sixty at most: one for each power of two

    def standing(df: DataFrame, at: Column) -> DataFrame:
        """A row for each bucket of a level that the interval touches."""
        size = (F.lit(width) * F.pow(F.lit(2.0), at)).cast("long")
        floor = lambda x: F.floor(x / size).cast("long")
        return df.withColumn("_bucket", F.explode(F.sequence(floor(F.col("_s")), floor(F.col("_e") - 1))))

    if not used:
        used = [0]
    # a pair meets on the level of the longer interval: the longer stands on its own, the shorter on every level from its own up
    own = [standing(s, F.col("_level")) for s in levels]
    up = [standing(s.withColumn("_own", F.col("_level")).withColumn("_level", F.explode(F.filter(F.array(*map(F.lit, used)), lambda x: x >= F.col("_own")))), F.col("_level")).drop("_own") for s in levels]

    def meet(a: DataFrame, b: DataFrame, names: tuple[str, str], longer_only: bool) -> DataFrame:
        one, every = _dealt(a, b, hot)
        every = every.select(*(F.col(c).alias(f"{c}2") for c in every.columns))
        on = (F.col("_key") == F.col("_key2")) & (F.col("_level") == F.col("_level2")) & (F.col("_bucket") == F.col("_bucket2")) & (F.col("_part") == F.col("_part2"))
        size = (F.lit(width) * F.pow(F.lit(2.0), F.col("_level"))).cast("long")
        once = F.floor(F.greatest("_s", "_s2") / size).cast("long") == F.col("_bucket")
        got = one.join(every, on).where((F.col("_s") < F.col("_e2")) & (F.col("_s2") < F.col("_e")) & once)
        if longer_only:
            got = got.where(_level(F.col("_e2") - F.col("_s2"), width) < F.col("_level"))
        return got.select(F.col("_row").alias(names[0]), F.col("_row2").alias(names[1]))

    # left intervals on their level with right ones up to that level, then right ones with strictly shorter left ones
    return meet(own[0], up[1], ("left", "right"), False).unionByName(meet(own[1], up[0], ("right", "left"), True).select("left", "right"))


def _stretches(df: DataFrame, low: Column, high: Column) -> DataFrame:
    """A row (tier, node) for each of the longest aligned stretches [node * 2^tier, (node + 1) * 2^tier) that make up [low, high)."""
    tiers = df.withColumns({"_low": low, "_high": high}).where("_low < _high").withColumn("tier", F.explode(F.sequence(F.lit(0), F.ceil(F.log2(F.col("_high") - F.col("_low"))).cast("int"))))
    ends = tiers.withColumns({"_first": -F.expr("shiftright(-_low, tier)"), "_last": F.expr("shiftright(_high, tier)")}).where("_first < _last")
    odd = lambda c: F.when(F.col(c).bitwiseAND(F.lit(1).cast("long")) == 1, F.col(c) - int(c == "_last"))
    return ends.withColumn("node", F.explode(F.array(odd("_first"), odd("_last")))).where("node is not null").drop("_low", "_high", "_first", "_last")


def overlap_totals(left: DataFrame, right: DataFrame, key: tuple[Column, Column], start: tuple[Column, Column], end: tuple[Column, Column], by: str, least: str) -> DataFrame:
    """(by, n, total, least) over the pairs of overlap_join: how many, their common length, and the smallest `least` of the right side.

    In a pair the right interval holds the left one's start, or starts inside the left one.  Right intervals are added up by aligned stretches
    of the axis, each tier's twice as long as those before: their ends in the stretches around them (tiers from 0), they themselves in
    the stretches that they are made of (tiers from -1 down).  A left interval looks up the few that it is made of and those around its start, so work
    grows with the rows, and a key's rows are spread over its stretches.  Groups without a pair have no row.  Starts and ends are below 2^62.
    """
    sides = []
    for df, k, s, e, own in zip((left, right), key, start, end, (by, least), strict=True):
        sides.append(df.select(k.alias("_key"), s.cast("long").alias("_s"), e.cast("long").alias("_e"), F.col(own).alias("_own")).where("_key is not null and _s < _e"))
    # the highest tier that an interval of a side can be made of
    top_left, top_right = ((s.agg(F.max(F.col("_e") - F.col("_s"))).first()[0] or 1).bit_length() - 1 for s in sides)

    once = sides[1].groupBy("_key", "_s", "_e").agg(F.count("*").alias("_n"), F.min("_own").alias("low"))
    starts, stops = once.select("_key", F.col("_s").alias("_at"), F.col("_n").alias("n"), F.col("_n").alias("ends"), "low"), once.select("_key", F.col("_e").alias("_at"), F.lit(0).cast("long").alias("n"), (-F.col("_n")).alias("ends"), F.lit(None).cast(once.schema["low"].dataType).alias("low"))
    ends = starts.unionByName(stops).groupBy("_key", "_at").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"), F.min("low").alias("low"))
    ends = ends.withColumn("tier", F.explode(F.sequence(F.lit(0), F.lit(top_left)))).withColumn("node", F.expr("shiftright(_at, tier)"))
    inside = ends.select("_key", "tier", "node", "n", "ends", (F.col("ends") * (F.col("_at") - F.expr("shiftleft(node, tier)"))).alias("offset"), "low")
    around = _stretches(once, F.col("_s"), F.col("_e")).select("_key", (-1 - F.col("tier")).alias("tier"), "node", F.col("_n").alias("n"), F.lit(0).cast("long").alias("ends"), F.lit(0).cast("long").alias("offset"), "low")
    table = inside.unionByName(around).groupBy("_key", "tier", "node").agg(*(F.sum(c).alias(c) for c in ("n", "ends", "offset")), F.min("low").alias("low"))

    made_of = _stretches(sides[0], F.col("_s") + 1, F.col("_e"))
    start_in = sides[0].withColumn("tier", F.explode(F.sequence(F.lit(-1 - top_right), F.lit(-1)))).withColumn("node", F.expr("shiftright(_s, -1 - tier)"))
    # inside: from each start, and no longer from each end, to the end of the left interval
    common = F.when(F.col("tier") < 0, F.col("n") * (F.col("_e") - F.col("_s"))).otherwise(F.col("ends") * (F.col("_e") - F.expr("shiftleft(node, greatest(tier, 0))")) - F.col("offset"))
    found = made_of.unionByName(start_in).join(table, ["_key", "tier", "node"]).groupBy(F.col("_own").alias(by)).agg(F.sum("n").alias("n"), F.sum(common).alias("total"), F.min("low").alias("least"))
    return found.where("n > 0")
