"""Order-aware dedupe: the survivor is fixed by a sort key, not by whichever row a task sees first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row a key: the first by order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return keep_first(df, keys, [F.desc(c) for c in order])


def first_values(df: DataFrame, keys: list[str], order: Column, values: list[str]) -> DataFrame:
    """keep_first by aggregation: partial minima, so a hot key costs one row a task."""
    return df.groupBy(*keys).agg(*[F.min_by(v, order).alias(v) for v in values])


def collision_keys(df: DataFrame, base: Column, order: list[Column | str], name: str = "key") -> DataFrame:
    """base, base#2, base#3 ... in order."""
    w = Window.partitionBy("_base").orderBy(*order)
    n = F.row_number().over(w)
    return df.withColumn("_base", base).withColumn(name, F.when(n == 1, F.col("_base")).otherwise(F.concat("_base", F.lit("#"), n.cast("string")))).drop("_base")


def unique_nonempty(c: Column) -> Column:
    """Distinct non-empty texts of an array, in order."""
    return F.array_distinct(F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: x != ""))


def last_by_content(df: DataFrame, content: str, order: str, n: int) -> DataFrame:
    """The last occurrence of each content, newest n of them."""
    return keep_last(df.withColumn("_hash", F.sha2(content, 256)), ["_hash"], [order]).drop("_hash").orderBy(F.desc(order)).limit(n)


def collapse_runs(df: DataFrame, partition: list[str], order: list[str], value: str) -> DataFrame:
    """Drops rows whose value equals that of the row before."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_p", F.lag(value).over(w)).withColumn("_n", F.row_number().over(w)).where((F.col("_n") == 1) | ~F.col(value).eqNullSafe(F.col("_p"))).drop("_p", "_n")
