"""Queries of connectors and of state that outlives a batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import paged
from ..streaming import state
from ..streaming.buffers import drain, settle
from .registry import query, scratch

_PAGES_SQL = "SELECT page_id, url, length(html) AS n_chars, md5(html) AS html_md5 FROM pages"


def _item():
    return F.to_json(F.struct("page_id", "url", "html")).alias("item")


def _columns(items):
    got = F.from_json("item", "page_id long, url string, html string")
    return items.select(got.alias("p")).select("p.page_id", "p.url", F.length("p.html").cast("long").alias("n_chars"), F.md5("p.html").alias("html_md5"))


@query(_PAGES_SQL)
def paged_scan(t, spark):
    """All pages, written to a paged folder in two appends and read back in ranges of its pages."""
    paged.register(spark)
    folder = scratch(spark, "paged")
    for k in (0, 1):
        t("pages").where(F.pmod("page_id", F.lit(2)) == k).select(_item()).write.format("paged").mode("append").save(folder)
    return _columns(spark.read.format("paged").load(folder).where("page >= 0"))


@query(_PAGES_SQL)
def paged_stream(t, spark):
    """All pages through a stream of a paged folder into another: three runs of one checkpoint, while the source grows."""
    paged.register(spark)
    source, sink, checkpoint = (scratch(spark, f"paged-{x}") for x in ("source", "sink", "checkpoint"))
    for k in range(3):
        t("pages").where(F.pmod("page_id", F.lit(3)) == k).select(_item()).write.format("paged").mode("append").save(source)
        rows = spark.readStream.format("paged").load(source).select("item")
        q = rows.writeStream.format("paged").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append")
        drain(q)
    return _columns(spark.read.format("paged").load(sink))


#: Hours that a lease over `events` lives after its last event.
_LEASE_H = 6


def _requests(t, spark, folder):
    """Events as requests from a paged folder, in order of time."""
    kinds = "event_id long, user_id long, event_type string, us long"
    got = spark.readStream.format("paged").load(folder).select(F.from_json("item", kinds).alias("e")).select("e.*")
    root = F.coalesce(F.col("user_id").cast("string"), F.lit(""))
    return got.select(root.alias("root"), F.concat_ws(state.SEP, root, F.coalesce("event_type", F.lit(""))).alias("key"), F.lit("all").alias("run"), F.lit("acquire").alias("action"), F.timestamp_micros("us").alias("ts"), F.expr("us div 1000").alias("at"), F.col("event_id").alias("seq"))


@query(f"""
WITH e AS (SELECT event_id, coalesce(CAST(user_id AS VARCHAR), '') AS root, coalesce(CAST(user_id AS VARCHAR), '') || '␟' || coalesce(event_type, '') AS key, epoch_us(ts) // 1000 AS ms FROM events),
s AS (SELECT *, CASE WHEN ms - lag(ms) OVER w > {_LEASE_H} * 3600000 OR lag(ms) OVER w IS NULL THEN 1 ELSE 0 END AS starts FROM e WINDOW w AS (PARTITION BY key ORDER BY ms, event_id)),
n AS (SELECT *, sum(starts) OVER (PARTITION BY key ORDER BY ms, event_id) AS lease FROM s)
SELECT root, key, min(ms) AS acquired, max(ms) AS beat, count(*) AS beats, max(ms) + {_LEASE_H} * 3600000 >= (SELECT max(ms) FROM e) AS live FROM n GROUP BY root, key, lease""")
def lease_timers(t, spark):
    """Leases of a user and kind of event: those that a timer ended, and those that the state holds in the end; three runs of one checkpoint."""
    paged.register(state.enable(spark))
    source, sink, checkpoint = (scratch(spark, f"lease-{x}") for x in ("source", "sink", "checkpoint"))
    events = t("events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    cut = events.approxQuantile("us", [1 / 3, 2 / 3], 0.01)
    for low, high in zip([None, *cut], [*cut, None], strict=True):
        part = events.where((F.lit(low).isNull() | (F.col("us") > F.lit(low))) & (F.lit(high).isNull() | (F.col("us") <= F.lit(high))))
        part.select(F.to_json(F.struct("*")).alias("item")).write.format("paged").option("size", 1000).mode("append").save(source)
        settle(state.lease_events(_requests(t, spark, source), ttl_s=_LEASE_H * 3600, outcomes=["expired"]).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint))
    ended = spark.read.parquet(sink).select("root", "key", "acquired", "beat", "beats", F.lit(False).alias("live"))
    held = spark.read.format("statestore").option("stateVarName", "leases").load(checkpoint)
    live = held.select("key.root", F.col("user_map_key.key").alias("key"), "user_map_value.acquired", "user_map_value.beat", "user_map_value.beats", F.lit(True).alias("live"))
    return ended.unionByName(live)


@query("""
WITH days AS (SELECT coalesce(CAST(user_id AS VARCHAR), '') AS id, event_type AS node, date_diff('week', DATE '1970-01-05', CAST(ts AS DATE)) AS version, sum(CAST(round(value * 100) AS BIGINT)) AS total FROM events GROUP BY 1, 2, 3),
snaps AS (SELECT DISTINCT id, version FROM days),
ordered AS (SELECT id, version, lag(version) OVER (PARTITION BY id ORDER BY version) AS prior FROM snaps),
now AS (SELECT o.id, o.version, d.node, CAST(d.total AS VARCHAR) AS content FROM ordered o JOIN days d ON d.id = o.id AND d.version = o.version),
old AS (SELECT o.id, o.version, d.node, CAST(d.total AS VARCHAR) AS before FROM ordered o JOIN days d ON d.id = o.id AND d.version = o.prior)
SELECT id, version, node, CASE WHEN before IS NULL THEN 'added' WHEN content IS NULL THEN 'removed' ELSE 'modified' END AS change, content, before
FROM now FULL JOIN old USING (id, version, node) WHERE content IS DISTINCT FROM before""")
def change_stream(t, spark):
    """Weekly snapshots of each user's totals by kind of event, as a stream of changes; two runs of one checkpoint."""
    paged.register(state.enable(spark))
    source, sink, checkpoint = (scratch(spark, f"changes-{x}") for x in ("source", "sink", "checkpoint"))
    week = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("1970-01-05").cast("date")) / 7).alias("version")
    snaps = t("events").groupBy(F.coalesce(F.col("user_id").cast("string"), F.lit("")).alias("id"), F.col("event_type").alias("node"), week).agg(F.sum(F.round(F.col("value") * 100).cast("long")).cast("string").alias("content"))
    middle = snaps.agg(F.median("version")).first()[0]
    for later in (F.col("version") <= F.lit(middle), F.col("version") > F.lit(middle)):
        snaps.where(later).select(F.to_json(F.struct("*")).alias("item")).write.format("paged").option("size", 1000).mode("append").save(source)
        nodes = spark.readStream.format("paged").load(source).select(F.from_json("item", "id string, version long, node string, content string").alias("s")).select("s.*")
        drain(state.change_stream(nodes).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint))
    return spark.read.parquet(sink)
