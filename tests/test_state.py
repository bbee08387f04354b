"""Leases with timers and change feeds against plain simulations, with restarts and an initial state."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace.sources import paged
from millrace.streaming import state
from millrace.streaming.buffers import settle

TTL = 45_000


def simulate(rows, ttl, held=None, end=None):
    """Outcomes of (at, seq, key, run, action) of one root, one after another; leases left at the end."""
    held, out = dict(held or {}), []

    def expire(now):
        for beat, key in sorted((v[2], k) for k, v in held.items() if now - v[2] > ttl):
            out.append((key, held.pop(key)[0], "expired", None, beat + ttl))

    for at, _, key, run, action in sorted(rows):
        expire(at)
        mine = held.get(key)
        if action == "release":
            for k in sorted(k for k, v in held.items() if v[0] == run):
                held.pop(k)
                out.append((k, run, "released", None, at))
        elif action == "heartbeat" and (not mine or mine[0] != run):
            out.append((key, run, "ignored", mine[0] if mine else None, at))
        else:
            other = next((v[0] for k, v in sorted(held.items()) if v[0] != run and (k == key or k.startswith(key + state.SEP) or key.startswith(k + state.SEP))), None)
            if action == "acquire" and other:
                out.append((key, run, "refused", other, at))
            else:
                held[key] = (run, mine[1] if mine else at, at)
                out.append((key, run, "renewed" if mine else "acquired", None, at))
    if end is not None:
        expire(end)
    return out, held


def run_stream(spark, tmp_path, frames, build, sink="sink"):
    paged.register(state.enable(spark))
    source = f"file://{tmp_path}/source"
    for frame in frames:
        frame.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("item")).coalesce(1).write.format("paged").mode("append").save(source)
        settle(build(spark.readStream.format("paged").load(source)).writeStream.format("parquet").option("path", f"file://{tmp_path}/{sink}").option("checkpointLocation", f"file://{tmp_path}/checkpoint"))
    return spark.read.parquet(f"file://{tmp_path}/{sink}")


@pytest.mark.parametrize("cuts", [(100,), (30, 60, 100)])
def test_leases(spark, tmp_path, cuts):
    rng = random.Random(21)
    rows = []
    for root in ("p", "q"):
        at = 1_700_000_000_000
        for i in range(100):
            at += rng.choice([0, 1000, 10_000, TTL, TTL + 1, 60_000])
            key = rng.choice([root, f"{root}{state.SEP}s1", f"{root}{state.SEP}s1{state.SEP}x", f"{root}{state.SEP}s2", f"{root}{state.SEP}s11"])
            rows.append((root, i, at, key, rng.choice(["r1", "r2", "r3"]), rng.choice(["acquire", "acquire", "heartbeat", "release"])))
    held = {"p": {f"p{state.SEP}s2": ("r9", 1_699_999_990_000, 1_699_999_999_000)}}
    initial = spark.createDataFrame([("p", f"p{state.SEP}s2", "r9", 1_699_999_990_000, 1_699_999_999_000)], "root string, key string, run string, acquired long, beat long")
    frames = [spark.createDataFrame([r for r in rows if low <= r[1] < high], "root string, seq long, at long, key string, run string, action string") for low, high in zip((0, *cuts), cuts, strict=False)]

    def build(items):
        got = items.select(F.from_json("item", "root string, seq long, at long, key string, run string, action string").alias("r")).select("r.*", F.timestamp_millis("r.at").alias("ts"))
        return state.lease_events(got, lateness="1 day", ttl_s=TTL / 1000, initial=initial)

    got = run_stream(spark, tmp_path, frames, build)
    end = max(r[2] for r in rows) - 86_400_000
    for root in ("p", "q"):
        want, left = simulate([r[2:3] + r[1:2] + r[3:] for r in rows if r[0] == root], TTL, held.get(root), end)
        mine = [(r.key, r.run, r.outcome, r.holder, r.at) for r in got.where(F.col("root") == root).collect()]
        assert sorted(mine, key=repr) == sorted(want, key=repr)
        live = spark.read.format("statestore").option("stateVarName", "leases").load(f"file://{tmp_path}/checkpoint").where(F.col("key.root") == root)
        assert {r.k: (r.run, r.acquired, r.beat) for r in live.select(F.col("user_map_key.key").alias("k"), "user_map_value.*").collect()} == left


def test_timers_end_leases_without_new_requests(spark, tmp_path):
    rows = [("a", 1, 1000, "a", "r", "acquire"), ("b", 2, 1000 + TTL, "b", "r", "acquire"), ("b", 3, 1000 + TTL + 1, "b", "r", "heartbeat")]
    frames = [spark.createDataFrame([r], "root string, seq long, at long, key string, run string, action string") for r in rows]
    build = lambda items: state.lease_events(items.select(F.from_json("item", "root string, seq long, at long, key string, run string, action string").alias("r")).select("r.*", F.timestamp_millis("r.at").alias("ts")), ttl_s=TTL / 1000)
    got = run_stream(spark, tmp_path, frames, build)
    assert [(r.key, r.at) for r in got.where("outcome = 'expired'").collect()] == [("a", 1000 + TTL)]


def test_changes_against_full_comparison(spark, tmp_path):
    rng = random.Random(22)
    snaps, rows, want = {}, [], []
    for page in ("x", "y", ""):
        last = {}
        for version in range(8):
            now = {n: rng.choice(["1", "2", None]) for n in "abcdef" if rng.random() < 0.7} or {"a": "1"}
            rows += [(page, version, n, c) for n, c in now.items()]
            for n in now.keys() | last.keys():
                if n not in last:
                    want.append((page, version, n, "added", now[n], None))
                elif n not in now:
                    want.append((page, version, n, "removed", None, last[n]))
                elif now[n] != last[n]:
                    want.append((page, version, n, "modified", now[n], last[n]))
            last = now
    kinds = "id string, version long, node string, content string"
    frames = [spark.createDataFrame([r for r in rows if low <= r[1] < high], kinds) for low, high in ((0, 3), (3, 4), (4, 8))]
    got = run_stream(spark, tmp_path, frames, lambda items: state.change_stream(items.select(F.from_json("item", kinds).alias("s")).select("s.*")))
    assert sorted(map(tuple, got.select("id", "version", "node", "change", "content", "before").collect()), key=repr) == sorted(want, key=repr)


def test_a_root_has_one_timer_and_gives_chosen_outcomes():
    class Store:
        """State and timers of one root."""

        def __init__(self):
            self.leases, self.timers = {}, []
            self.iterator = lambda: iter(list(self.leases.items()))
            self.updateValue, self.removeKey, self.clear = self.leases.__setitem__, self.leases.pop, self.leases.clear
            self.getMapState, self.registerTimer = lambda *_: self, self.timers.append

    class Time:
        def __init__(self, at):
            self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: at

    request = Row("at", "seq", "key", "run", "action")
    store, leases = Store(), state.Leases(100, ["expired"])
    leases.init(store)
    feed = lambda *rows: list(leases.handleInputRows(("p",), iter([request(at, i, f"p{state.SEP}{k:02d}", "r", "acquire") for i, (at, k) in enumerate(rows)]), None))
    assert feed(*[(1000 + i, i) for i in range(50)]) == [] and store.timers == [1101]
    assert feed(*[(1060 + i, i) for i in range(40)]) == [] and store.timers == [1101]
    # the timer comes before the first lease ends, then at its end, then for the others
    fire = lambda at: [(r.key[-2:], r.at) for r in leases.handleExpiredTimer(("p",), Time(at), Time(at))]
    assert fire(1101) == [] and store.timers[1:] == [1141]
    assert fire(1145) == [(str(40 + i), 1140 + i) for i in range(5)] and store.timers[2:] == [1146]
    assert len(fire(5000)) == 45 and store.leases == {} and len(store.timers) == 3
    assert feed((6000, 1)) == [] and store.timers[3:] == [6101]
