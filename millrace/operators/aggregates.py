"""Aggregates with the record pipelines' null, tie and order rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def num(c: str) -> Column:
    """Number(x), or 0 where it isn't one."""
    return F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))


def group_first_count(df: DataFrame, key: str, order: str, values: list[str]) -> DataFrame:
    """First row's values and the number of rows, ranked by first appearance (rank needs order to be unique)."""
    return df.groupBy(key).agg(*[F.min_by(v, order).alias(v) for v in values], F.count("*").alias("n"), F.min(order).alias("first_seen"))


def arg_max(df: DataFrame, by: list[str], score: Column, order: str, values: list[str]) -> DataFrame:
    """Values of the best row; the first in order wins ties."""
    best = F.max_by(F.struct(*values), F.struct(score, -F.col(order))).alias("_b")
    return df.groupBy(*by).agg(best, F.count("*").alias("n")).select(*by, *[F.col(f"_b.{v}").alias(v) for v in values], "n")


def null_poisoned_sum(c: str) -> Column:
    """The sum, or null if any value is null."""
    return F.when(F.count_if(F.col(c).isNull()) == 0, F.sum(c))


def nearest_rank(c: str, q: float) -> Column:
    """sorted[ceil(n q) - 1], an actual value."""
    return F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {c})")


#: Groups whose bounds are broadcast.
FEW_GROUPS = 1000


def nearest_ranks(df: DataFrame, by: str, c: str, ranks: dict[str, float], pieces: int = 500) -> DataFrame:
    """(by, one column a rank): nearest_rank of each group that has values, without a group's values in one place.

    A mergeable sketch brackets each rank between two of the group's values.  One pass then counts what lies below a bracket, as one
    row a task, and the values inside it, one of `pieces` pieces of the group or less but for ties; only those are put in order.
    """
    rows = df.where(F.col(c).isNotNull()).select(F.col(by).alias("_by"), F.col(c).alias("_v"))
    accuracy = 20 * pieces
    margin, names = 2 / accuracy, list(ranks)  # the sketch is off by one in `accuracy` at most
    points = sorted({x for q in ranks.values() for x in (q - margin, q + margin) if 0 < x < 1})
    cuts = rows.groupBy("_by").agg(F.percentile_approx("_v", points or [0.5], accuracy).alias("_cuts"), F.count("*").alias("_n"))
    at = lambda x: F.get("_cuts", F.lit(points.index(x))) if x in points else F.lit(None)
    asked = [F.struct(F.lit(k).alias("name"), F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(ranks[k]))).cast("long").alias("rank"), at(ranks[k] - margin).alias("low"), at(ranks[k] + margin).alias("high")) for k in names]
    bounds = cuts.select(F.col("_by").alias("_of"), F.array(*asked).alias("_asked"))
    if rows.select("_by").distinct().limit(FEW_GROUPS + 1).count() <= FEW_GROUPS:
        bounds = F.broadcast(bounds)
    each = rows.join(bounds, F.col("_by").eqNullSafe(F.col("_of"))).select("_by", "_v", F.explode("_asked").alias("_a")).where("_a.high is null or _v <= _a.high")
    inside = F.when(F.col("_a.low").isNull() | (F.col("_v") >= F.col("_a.low")), F.col("_v"))
    counts = each.groupBy("_by", F.col("_a.name").alias("_name"), F.col("_a.rank").alias("_rank"), inside.alias("_v")).count()
    upto = F.sum("count").over(Window.partitionBy("_by", "_name").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    found = counts.withColumn("_upto", upto).where("_v is not null and _upto >= _rank")
    return found.groupBy(F.col("_by").alias(by)).agg(*[F.min(F.when(F.col("_name") == k, F.col("_v"))).alias(k) for k in names])


def recall(matched: Column, expected: Column) -> Column:
    """sum of matches over sum expected; 1 where nothing was expected."""
    return F.coalesce(F.try_divide(F.sum(matched).cast("double"), F.sum(expected).cast("double")), F.lit(1.0))


def histogram_with_zeros(df: DataFrame, by: str, values: DataFrame) -> DataFrame:
    """Counts, with values that never occur as 0."""
    return values.join(df.groupBy(by).agg(F.count("*").alias("n")), by, "left").select(by, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def fill_blanks(df: DataFrame, key: Column, order: str, values: list[str]) -> DataFrame:
    """One row a key: for each column the first non-blank value in order."""
    return df.groupBy(key.alias("key")).agg(*[F.min_by(F.when(F.col(v) != "", F.col(v)), F.when(F.col(v) != "", F.col(order))).alias(v) for v in values])
