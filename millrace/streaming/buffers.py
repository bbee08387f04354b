"""Bounded event state: batch forms (one pass of windows or aggregates) and Structured Streaming forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_ITEMS, MOST_AGE_S = 1000, 120
LEASE_TTL_S = 45


def ring_buffer(events: DataFrame, stream: str, arrival: str, ts: Column, now: Column, most: int = MOST_ITEMS, age_s: float = MOST_AGE_S) -> DataFrame:
    """What a buffer holds at `now`: the newest `most` arrivals after the last prefix that was too old.

    Age prunes only a prefix in arrival order, so an old event behind a fresh one survives: what counts is each
    stream's first fresh arrival, an aggregate.  The newest `most` are cut before the shuffle, so a stream that
    holds most events sends that many rows a task.
    """
    timed = events.withColumn("_ts", ts).withColumn("_fresh", now - F.col("_ts") <= age_s)
    first = timed.where("_fresh").groupBy(F.col(stream).alias("_s")).agg(F.min(arrival).alias("_first"))
    kept = timed.join(first, F.col(stream).eqNullSafe(F.col("_s"))).where(F.col(arrival) >= F.col("_first"))
    newest = F.row_number().over(Window.partitionBy(stream).orderBy(F.desc(arrival)))
    return kept.withColumn("_n", newest).where(F.col("_n") <= most).select(*events.columns)


def live_leases(beats: DataFrame, key: str, ts: Column, now: Column, ttl_s: float = LEASE_TTL_S) -> DataFrame:
    """(key, last, live): a lease lives while its last heartbeat is no older than the TTL."""
    return beats.groupBy(key).agg(F.max(ts).alias("last")).withColumn("live", now - F.col("last") <= ttl_s)


def lease_conflict(key: Column, other: Column, sep: str = "␟") -> Column:
    """Hierarchical keys conflict if equal or if one is a prefix of the other at a separator."""
    return (key == other) | F.startswith(key, F.concat(other, F.lit(sep))) | F.startswith(other, F.concat(key, F.lit(sep)))


def fresh_entries(entries: DataFrame, saved: Column, now: Column, ttl_s: float = 86_400.0) -> DataFrame:
    return entries.withColumn("expired", now - saved > ttl_s)


def retention(items: DataFrame, by: str, created: str, age_s: Column, size: str, protected: str, most_age_s: float, most_n: int, most_bytes: int, tie: str | None = None) -> DataFrame:
    """keep: unprotected rows go by age, then the oldest beyond a count, then beyond total bytes; protected rows stay.

    Protected rows take up room in the count and the bytes all the same.  Among rows of one age those with the larger `tie` count as newer.
    """
    aged = items.withColumn("_alive", F.col(protected) | (age_s <= most_age_s))
    order = [F.desc(protected), F.desc(created), *([F.desc(tie)] if tie else [])]
    newest = Window.partitionBy(by, "_alive").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = aged.withColumn("_rank", F.row_number().over(Window.partitionBy(by, "_alive").orderBy(*order)))
    counted = ranked.withColumn("_counted", F.col("_alive") & (F.col(protected) | (F.col("_rank") <= most_n)))
    totals = counted.withColumn("_bytes", F.sum(F.when(F.col("_counted"), F.col(size)).otherwise(0)).over(newest))
    return totals.withColumn("keep", F.col("_counted") & (F.col(protected) | (F.col("_bytes") <= most_bytes))).drop("_alive", "_rank", "_counted", "_bytes")


# ---------------------------------------------------------------- Structured Streaming


def read_folder(spark: SparkSession, folder: str, schema: T.StructType, files_a_batch: int = 10) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def dedupe(stream: DataFrame, keys: list[str], ts: str, lateness: str) -> DataFrame:
    """Incremental dedupe whose state is dropped once the watermark passes."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(keys)


def tumbling(stream: DataFrame, ts: str, width: str, lateness: str, by: list[str], value: str) -> DataFrame:
    return stream.withWatermark(ts, lateness).groupBy(F.window(ts, width), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def sessions(stream: DataFrame, ts: str, gap: str, lateness: str, by: list[str]) -> DataFrame:
    return stream.withWatermark(ts, lateness).groupBy(F.session_window(ts, gap), *by).agg(F.count("*").alias("n"))


def ring_buffer_stream(stream: DataFrame, by: str, seq: str, ts_s: str, most: int = MOST_ITEMS, age_s: float = MOST_AGE_S) -> DataFrame:
    """Size and newest event of each key's buffer after every batch, from bounded state of `most` pairs."""

    def update(key, frames, state):
        held = list(zip(*state.get, strict=True)) if state.exists else []
        for pdf in frames:
            held += [(int(a), float(b)) for a, b in zip(pdf[seq], pdf[ts_s], strict=True)]
        held.sort()
        now = max((t for _, t in held), default=0.0)
        head = 0
        while head < len(held) and now - held[head][1] > age_s:
            head += 1
        held = held[head:][-most:]
        state.update(([a for a, _ in held], [b for _, b in held]))
        import pandas as pd

        yield pd.DataFrame({"key": [key[0]], "size": [len(held)], "newest": [held[-1][0] if held else None]})

    kind = stream.schema[by].dataType.simpleString()
    return stream.groupBy(by).applyInPandasWithState(update, f"key {kind}, size long, newest long", "seqs array<long>, times array<double>", "update", "NoTimeout")


def drain(query_builder) -> None:
    """Runs a writer over all available input, then stops."""
    q = query_builder.trigger(availableNow=True).start()
    q.awaitTermination()


def settle(query_builder) -> None:
    """Like drain, but with the batch without data that lets timers and watermarks act on the last input."""
    q = query_builder.start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def upsert_sink(target: str, key: str, order: str):
    """foreachBatch function that merges each batch into a Parquet folder, newest row a key; batches are versioned by id,
    so replaying one replaces its own output."""

    def before(spark: SparkSession, epoch: int) -> DataFrame | None:
        """The newest version before an epoch; batches without rows may have left none."""
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        versions = [int(n[1:]) for n in found if n[:1] == "v" and n[1:].isdigit() and int(n[1:]) < epoch]
        return spark.read.parquet(f"{target}/v{max(versions)}") if versions else None

    def merge(batch: DataFrame, epoch: int) -> None:
        from ..operators.dedupe import keep_last

        old = before(batch.sparkSession, epoch)
        old = batch.limit(0) if old is None else old
        keep_last(old.unionByName(batch), [key], [order]).write.mode("overwrite").parquet(f"{target}/v{epoch}")

    return merge
