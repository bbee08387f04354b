"""Keyed state with timers: leases that expire by event time, and change feeds against the last snapshot.

Both run as transformWithState over a state store that is kept on disk and checkpointed, so a key's state is bounded by what
is live, and a restart goes on from the last batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .buffers import LEASE_TTL_S

#: Between the parts of a lease's key: profile, session, site.
SEP = "␟"
LEASE_OUT = "root string, key string, run string, outcome string, holder string, acquired long, beat long, beats long, at long"
#: A row of LEASE_OUT, by place.
_OUT = Row("root", "key", "run", "outcome", "holder", "acquired", "beat", "beats", "at")
CHANGE_OUT = "id string, version long, node string, change string, content string, before string"


def enable(spark: SparkSession) -> SparkSession:
    """Arbitrary state needs the store that keeps state on disk."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark


def conflicts(key: str, other: str) -> bool:
    """Equal keys, or one above the other."""
    return key == other or key.startswith(other + SEP) or other.startswith(key + SEP)


class Leases(StatefulProcessor):
    """State of a root (the first part of a key): key -> run, acquired, beat, beats (times in milliseconds).

    acquire: refused while another run holds a conflicting lease that is live; the same run's lease is renewed.  heartbeat: renews
    what the same run holds under the key, else `ignored`.  release: all leases of the run in this root.  A lease is
    live while no more than the TTL has passed since its last beat.

    A batch reads a root's leases in one request to the state store, writes those that changed, and sets at most one timer.
    """

    def __init__(self, ttl_ms: int, outcomes: list[str] | None = None):
        self.ttl_ms, self.outcomes = ttl_ms, outcomes and frozenset(outcomes)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.leases = handle.getMapState("leases", "key string", "run string, acquired long, beat long, beats long")

    def _held(self) -> dict[str, tuple]:
        return {k[0]: tuple(v) for k, v in self.leases.iterator()}

    def _row(self, root: str, key: str, lease: tuple, outcome: str, at: int, holder: str | None = None, run: str | None = None) -> Iterator[Row]:
        if self.outcomes and outcome not in self.outcomes:
            return
        if run is None:
            yield _OUT(root, key, lease[0], outcome, holder, *lease[1:], at)
        else:
            yield _OUT(root, key, run, outcome, holder, None, None, None, at)

    def _expire(self, root: str, held: dict[str, tuple], now: int) -> Iterator[Row]:
        over = sorted((v[2], k) for k, v in held.items() if now - v[2] > self.ttl_ms)
        for beat, key in over:
            yield from self._row(root, key, held.pop(key), "expired", beat + self.ttl_ms)

    def _store(self, before: dict[str, tuple], held: dict[str, tuple]) -> None:
        """What a batch leaves.  A root with leases has a timer at or before the end of the first of them; one that comes
        too early, as that lease was renewed, is set again."""
        if not held and before:
            self.leases.clear()
            return
        for key in before.keys() - held.keys():
            self.leases.removeKey((key,))
        for key, lease in held.items():
            if before.get(key) != lease:
                self.leases.updateValue((key,), lease)
        first = min((lease[2] for lease in held.values()), default=None)
        if held and (not before or first < min(lease[2] for lease in before.values())):
            self.handle.registerTimer(first + self.ttl_ms + 1)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        root, held = key[0], self._held()
        before = dict(held)
        for r in sorted(rows, key=lambda r: (r.at, r.seq)):
            yield from self._expire(root, held, r.at)
            mine = held.get(r.key)
            if r.action == "release":
                for k in sorted(k for k, v in held.items() if v[0] == r.run):
                    yield from self._row(root, k, held.pop(k), "released", r.at)
                continue
            if r.action == "heartbeat" and (mine is None or mine[0] != r.run):
                yield from self._row(root, r.key, (), "ignored", r.at, mine[0] if mine else None, r.run)
                continue
            if r.action == "acquire" and (other := next((v[0] for k, v in sorted(held.items()) if v[0] != r.run and conflicts(r.key, k)), None)) is not None:
                yield from self._row(root, r.key, (), "refused", r.at, other, r.run)
                continue
            held[r.key] = (r.run, mine[1], r.at, mine[3] + 1) if mine else (r.run, r.at, r.at, 1)
            yield from self._row(root, r.key, held[r.key], "renewed" if mine else "acquired", r.at)
        self._store(before, held)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held, now = self._held(), max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        before = dict(held)
        yield from self._expire(key[0], held, now)
        self._store(before, held)
        if held:
            self.handle.registerTimer(min(v[2] for v in held.values()) + self.ttl_ms + 1)

    def handleInitialState(self, key: Any, initialState: Row, timerValues) -> None:
        r = initialState
        held = self._held()
        self._store(held, held | {r.key: (r.run, r.acquired, r.beat, 1)})


def lease_events(requests: DataFrame, lateness: str = "0 seconds", ttl_s: float = LEASE_TTL_S, initial: DataFrame | None = None, outcomes: list[str] | None = None) -> DataFrame:
    """What becomes of each request (root, key, run, action, ts, at in ms, seq), and of leases that run out: LEASE_OUT.

    Requests of one batch are taken in order of time.  outcomes: only rows of these are given (None: all).  initial: leases (root, key, run, acquired, beat) held at the start.
    """
    start = {"initialState": initial.groupBy("root")} if initial is not None else {}
    return requests.withWatermark("ts", lateness).groupBy("root").transformWithState(Leases(int(ttl_s * 1000), outcomes), LEASE_OUT, "Append", "EventTime", **start)


class Changes(StatefulProcessor):
    """State of a page: node -> content and version of the last snapshot."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.nodes = handle.getMapState("nodes", "node string", "content string")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = {k[0]: v[0] for k, v in self.nodes.iterator()}
        stored = dict(last)
        versions: dict[int, dict] = {}
        for r in rows:
            versions.setdefault(r.version, {})[r.node] = r.content
        for version in sorted(versions):
            now = versions[version]
            for node in sorted(now.keys() | last.keys()):
                old, new = last.get(node), now.get(node)
                change = "added" if node not in last else "removed" if node not in now else "modified" if old != new else None
                if change:
                    yield Row(id=key[0], version=version, node=node, change=change, content=new, before=old)
            last = now
        for node in stored.keys() - last.keys():
            self.nodes.removeKey((node,))
        for node, content in last.items():
            if node not in stored or stored[node] != content:
                self.nodes.updateValue((node,), (content,))


def change_stream(nodes: DataFrame) -> DataFrame:
    """Changes of each page's snapshots (id, version, node, content) against the one before: CHANGE_OUT.

    A snapshot arrives whole, in one batch; versions of a page arrive in order.
    """
    return nodes.groupBy("id").transformWithState(Changes(), CHANGE_OUT, "Append", "None")
