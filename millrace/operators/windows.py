"""Sessions, islands, slices, interleaving and per-group top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def gap_sessions(df: DataFrame, by: list[str], time: Column, order: list, gap_seconds: float) -> DataFrame:
    """session (from 1): a new one where the gap from the row before is over gap_seconds."""
    w = Window.partitionBy(*by).orderBy(*order)
    new = F.when(F.coalesce(F.col("_t") - F.lag("_t").over(w) > gap_seconds, F.lit(True)), 1).otherwise(0)
    return df.withColumn("_t", time).withColumn("_new", new).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_t", "_new")


def span_sessions(df: DataFrame, by: str, time: str, gap_seconds: float, span_seconds: float) -> DataFrame:
    """As gap_sessions, and a session may not last over span_seconds: an inherently sequential fold.

    Gap sessions are found first with windows; the fold runs inside each, so a hot key is spread over tasks.  A task reads its
    sessions one after the other in order of time, a batch of many at once, and carries only the last one's state on.
    """
    base = gap_sessions(df, [by], F.col(time), [time], gap_seconds).withColumnRenamed("session", "gap_session")
    names = [f.name for f in base.schema.fields]

    def fold(batches):
        import pyarrow as pa

        now, start, n = None, None, 0
        for b in batches:
            out = []
            for key, session, t in zip(*(b.column(names.index(c)).to_pylist() for c in (by, "gap_session", time)), strict=True):
                if now != (key, session):
                    now, start, n = (key, session), t, 1
                elif t is not None and (start is None or t - start > span_seconds):
                    start, n = t, n + 1
                out.append(n)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], names=[*names, "part"])

    schema = T.StructType([*base.schema.fields, T.StructField("part", T.LongType())])
    return base.repartition(by, "gap_session").sortWithinPartitions(by, "gap_session", time).mapInArrow(fold, schema)


def islands(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Runs of consecutive integers: (by, first, last, n); nulls are one run without bounds.

    One sort in as many parts as a shuffle has, and no hash table of the distinct values or of the runs: of each value's first row,
    those that begin or end a run are kept.
    """
    w = Window.partitionBy(*by).orderBy("_v")
    row = F.struct("_v")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gap = lambda a, b: F.when(a.isNull() | b.isNull(), True).when(a < b, a + 1 < b).otherwise(False)
    rows = df.select(*by, F.col(value).alias("_v")).repartition(parts, *by).withColumn("_b", F.lag(row).over(w))
    rows = rows.where(F.col("_b").isNull() | ~F.col("_b._v").eqNullSafe(F.col("_v"))).withColumn("_n", F.lead(row).over(w)).withColumn("_b", F.lag(row).over(w))
    ends = rows.select(*by, "_v", gap(F.col("_b._v"), F.col("_v")).alias("_first"), gap(F.col("_v"), F.col("_n._v")).alias("_last")).where("_first or _last")
    last = F.when(F.col("_last"), F.col("_v")).otherwise(F.lead("_v").over(w))
    return ends.withColumn("last", last).where("_first").select(*by, F.col("_v").alias("first"), "last", F.coalesce(F.col("last") - F.col("_v") + 1, F.lit(1)).cast("long").alias("n"))


def top_k_with_rest(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each group as (…, rank, more): more is the number left out, on the last row kept."""
    w = Window.partitionBy(*by).orderBy(*order)
    n = F.count("*").over(Window.partitionBy(*by))
    return df.withColumn("rank", F.row_number().over(w).cast("long")).withColumn("_n", n).where(F.col("rank") <= k).withColumn("more", F.when(F.col("rank") == k, F.col("_n") - k).otherwise(F.lit(0)).cast("long")).drop("_n")


def extreme_slice(df: DataFrame, value: str, by: list[str] = (), largest: bool = True) -> DataFrame:
    """Rows that hold the largest (smallest) value, over all or by group: an aggregate and a join, no global window."""
    agg = (F.max if largest else F.min)(value).alias("_x")
    if by:
        best = df.groupBy(*by).agg(agg)
        return df.join(best, list(by)).where(F.col(value) == F.col("_x")).drop("_x")
    return df.crossJoin(F.broadcast(df.agg(agg))).where(F.col(value) == F.col("_x")).drop("_x")  # one row


def interleave(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """round (from 1) orders rows breadth first: the first of every group, then the second of every group."""
    return df.withColumn("round", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))


def change(df: DataFrame, by: list[str], order: list, value: str) -> DataFrame:
    """Difference from the row before, and in percent (null where there is none, or it is 0)."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_b", before).withColumn("change", F.col(value) - F.col("_b")).withColumn("change_pct", F.try_divide(F.col("change"), F.col("_b")) * 100).drop("_b")


def evenly_spaced(duration: Column, n: int) -> Column:
    """n distinct, sorted whole positions between 10 and 90 % of a duration."""
    return F.array_sort(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.floor(duration * (0.1 + 0.8 * i / max(1, n - 1))).cast("long"))))
