"""Observation sessions: range reads over streams, traces on disk, resumable ingestion, polling, change feeds."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import redact

#: Streams with the newest events each keeps, and the span they keep, in seconds.
STREAMS = {"action": 1000, "network": 1000, "console": 1000, "screenshot": 50, "state": 50, "error": 1000}
WINDOW_S = 120.0
#: Quiet rounds that end polling, where the expected count is reached and where it isn't; rounds at most.
STABLE, STABLE_UNREACHED, MOST_ROUNDS = 2, 10, 200


def session_events(events: DataFrame, ts: str, ident: str, stream: str = "stream", streams: list[str] | None = None, since=None, until=None) -> DataFrame:
    """Events of some streams in [since, until], merged by time, then id; the order is by sorting, not by stream."""
    out = events if streams is None else events.where(F.col(stream).isin(*streams))
    if since is not None:
        out = out.where(F.col(ts) >= since)
    if until is not None:
        out = out.where(F.col(ts) <= until)
    return out.orderBy(ts, ident)


def merge_order(ts: str, ident: str) -> list[Column]:
    return [F.col(ts).asc(), F.col(ident).asc()]


def write_trace(events: DataFrame, folder: str, ts: str, ident: str, stream: str, payload: str, error: str | None = None) -> dict:
    """A session as redacted JSON lines, a folder a stream, with summary.json; returns the receipt.

    Lines stand in order of time and id inside each part.  The summary holds counts alone, one row a stream.
    """
    safe = events.withColumn(payload, redact.text(F.col(payload)))
    safe.repartitionByRange(ts, ident).sortWithinPartitions(ts, ident).write.mode("overwrite").partitionBy(stream).json(f"{folder}/trace")
    counts = {r[stream]: r["n"] for r in events.groupBy(stream).agg(F.count("*").alias("n")).collect()}
    receipt = {"status": "failure" if error else "success", "events": sum(counts.values()), "streams": dict(sorted(counts.items())), "error": error}
    events.sparkSession.createDataFrame([(json.dumps(receipt),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/summary")
    return receipt


class ResumeError(ValueError):
    """A checkpoint that doesn't fit the request or the archive."""


def read_checkpoint(spark: SparkSession, path: str, source: str, name: str, archive: str) -> dict | None:
    """The checkpoint of an earlier run, checked against the request; None where there is none."""
    try:
        text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())  # one small file
    except Exception as e:  # noqa: BLE001  Spark reports a missing path in several classes
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    try:
        got = json.loads(text)
    except ValueError as e:
        raise ResumeError(f"could not parse {path}: {e}") from None
    cursor, count = got.get("cursor") if isinstance(got, dict) else "", got.get("count") if isinstance(got, dict) else -1
    if not isinstance(count, int) or count < 0 or not (cursor is None or isinstance(cursor, str) and cursor.strip()):
        raise ResumeError(f"{path} has an invalid shape")
    for k, want in (("source", source), ("name", name.lower()), ("archive", archive)):
        have = str(got.get(k) or "").lower() if k == "name" else got.get(k)
        if have != want:
            raise ResumeError(f"{k} mismatch: expected {want}, found {have}")
    if got.get("complete"):
        raise ResumeError(f"{path} is already marked complete")
    return got


def ingest(spark: SparkSession, source: str, name: str, archive: str, checkpoint: str, fetch: Callable[[str | None], tuple[DataFrame, str | None]], key: str, pages: int = 1000) -> dict:
    """Pages of a cursor appended to an archive, each key once, resumable after any page.

    fetch(cursor) gives a page and the next cursor (None: the end).  Every page is its own folder of the archive
    named by its number, so a page whose checkpoint was lost is written again in its place, never twice.  An
    archive whose rows differ in number from the checkpoint's, or that has no checkpoint, is refused.
    """
    state = read_checkpoint(spark, checkpoint, source, name, archive)
    done, cursor, count = (state["pages"], state["cursor"], state["count"]) if state else (0, None, 0)
    folders = [f"{archive}/page={i}" for i in range(done)]
    have = spark.read.parquet(*folders).count() if folders else 0
    if have != count:
        raise ResumeError(f"the archive holds {have} rows, the checkpoint says {count}")
    if not state and _exists(spark, archive):
        raise ResumeError(f"{archive} exists without a checkpoint")
    complete = False
    while not complete and done < pages:
        page, following = fetch(cursor)
        new = page.dropDuplicates([key])
        if folders:
            new = new.join(spark.read.parquet(*folders).select(key), key, "left_anti")
        new.write.mode("overwrite").parquet(f"{archive}/page={done}")
        folders.append(f"{archive}/page={done}")
        count += spark.read.parquet(folders[-1]).count()
        done, cursor, complete = done + 1, following, following is None
        state = {"source": source, "name": name.lower(), "archive": archive, "cursor": cursor, "count": count, "pages": done, "complete": complete}
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(checkpoint)
    return state


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(f"{path}/page=0").limit(0).collect()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise
    return True


def poll_until_stable(rounds: Callable[[int], tuple[DataFrame, int, bool]], key: str, order: str, limit: int | None = None, stable: int = STABLE, unreached: int = STABLE_UNREACHED, most: int = MOST_ROUNDS, keep: Callable[[DataFrame, int], DataFrame] | None = None) -> tuple[DataFrame, int]:
    """Rows of repeated reads of a growing source, each key once, until nothing new comes.

    rounds(i) gives the rows seen, how many are expected, and whether the end is in sight.  A round is quiet if it
    brings no new key at the end; `stable` quiet rounds end it, or `unreached` while fewer than expected are known.
    keep(rows, i) stores what is known (a written table on a cluster); by default it is recomputed.  Raises where
    it doesn't settle in `most` rounds.
    """
    from ..operators.dedupe import keep_first

    known, n, expected, quiet = None, 0, 0, 0
    for i in range(most):
        rows, wanted, at_end = rounds(i)
        rows = rows.withColumn("_round", F.lit(i))
        every = keep_first(known.unionByName(rows) if known is not None else rows, [key], ["_round", order])
        known = keep(every, i) if keep else every
        now, expected = known.count(), max(expected, wanted)
        if limit and now >= limit:
            return known.orderBy("_round", order).limit(limit).drop("_round"), i + 1
        quiet = quiet + 1 if now == n and at_end else 0
        n = now
        if quiet >= (stable if n >= expected else unreached):
            return known.drop("_round"), i + 1
    raise TimeoutError(f"not stable after {most} rounds")


def change_feed(snapshots: DataFrame, page: str, version: str, parent: list[str]) -> DataFrame:
    """Changes from each snapshot of a page to the next: match_children of all neighbouring versions at once.

    snapshots: page, version, parent columns, pos, key, fingerprint, kind, content.  The first version of a page
    is compared with nothing: all its nodes are added.
    """
    from pyspark.sql import Window

    from ..operators.snapshots import match_children

    versions = snapshots.select(page, version).distinct()
    before = F.lag(version).over(Window.partitionBy(page).orderBy(version))
    pairs = versions.withColumn("_before", before)
    old = snapshots.join(pairs.where("_before is not null").select(page, F.col("_before").alias(version), F.col(version).alias("_to")), [page, version]).drop(version).withColumnRenamed("_to", version)
    out = match_children(old, snapshots, [page, version, *parent])
    return out.where("change <> 'same'")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
