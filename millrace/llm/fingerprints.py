"""Operator 2: document fingerprints as improbable-feature digests.

* Features are all WINDOW-byte strings of a text.  Their entropy is kept in integers and updated as the
  window slides; a histogram of entropies over the whole corpus ranks them by rarity.
* Every run of NEAR features votes for its rarest (leftmost at ties); features with VOTES votes or more
  are selected, in order.
* Selected features go into a chain of Bloom filters of 256 bytes, 160 features each.
* Likeness: for each filter of the shorter chain, the best bit overlap with a filter of the other,
  normalised by what chance and the smaller filter allow; the mean of these.

Neighbours in id order come from ranges of ids: each range is one partition, and the first document of the
next range is sent along as a ghost row, so no global sort or single task is needed.  Texts are worked on in
pieces, so memory is bounded by a text and its digest, not by arrays over all its features.

Input cases: null is the empty text, which has no features and an empty filter (like only to another
empty one); texts shorter than a window are one feature; a null doc_id is the smallest; rows that repeat
a doc_id are ordered by text; a lone document is its own next one; an empty table gives an empty table;
other columns are ignored; an id that isn't a whole number raises.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NULL_ID, id_key, id_splits, partitions, schema_of, small_batches, tidy
from .parsing import mix

WINDOW = 32
NEAR = 32
VOTES = 8
FILTER_BITS = 2048
FEATURES = 160
PROBES = 5
LEVELS = 1001
#: Features of one text worked on at a time: longer texts are taken in overlapping pieces.
PIECE = 1 << 19
_COST = np.round(np.arange(WINDOW + 1) * np.log2(np.maximum(1, np.arange(WINDOW + 1))) * 65536).astype(np.int64)


def entropies(data: np.ndarray) -> np.ndarray:
    """Level 0 (one byte repeated) to 1000 (all bytes different) of every WINDOW-byte string."""
    n = len(data) - WINDOW + 1
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for d in range(1, WINDOW):
        same = (data[d:] == data[:-d]).view(np.uint8)
        before[d:] += same
        after[:-d] += same
    # cost(i): sum of c log c over the byte counts of window i; sliding takes data[i] out, puts data[i+W] in
    out = _COST[after[: n - 1]] - _COST[after[: n - 1].astype(np.int64) + 1]
    into = _COST[before[WINDOW:].astype(np.int64) + 1] - _COST[before[WINDOW:]]
    first = int(_COST[np.bincount(data[:WINDOW], minlength=256)].sum())
    cost = np.empty(n, np.int64)
    cost[0] = first
    # `before` looks at WINDOW - 1 bytes, so it never counts the byte just taken out
    np.cumsum(out + into, out=cost[1:])
    cost[1:] += first
    return (LEVELS - 1) - (cost * (LEVELS - 1)) // int(_COST[WINDOW])


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of texts laid end to end, texts under a window padded to one; starts, and number of features."""
    sizes = np.array([max(WINDOW, len(t)) if t else 0 for t in texts], np.int64)
    data = np.frombuffer(b"".join(t if len(t) >= WINDOW or not t else t.ljust(WINDOW, b"\0") for t in texts), np.uint8)
    return data, np.r_[0, np.cumsum(sizes)[:-1]], np.maximum(0, sizes - WINDOW + 1)


def level_counts(texts: list[bytes]) -> np.ndarray:
    """Features of each entropy level, over all texts."""
    long = [t for t in texts if len(t) >= PIECE + WINDOW]
    if long:
        cut = [t[a : a + PIECE + WINDOW - 1] for t in long for a in range(0, len(t) - WINDOW + 1, PIECE)]
        return sum((level_counts([c]) for c in cut), level_counts([t for t in texts if len(t) < PIECE + WINDOW]))
    data, start, n = _flat(texts)
    if not n.sum():
        return np.zeros(LEVELS, np.int64)
    at = np.repeat(start - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
    return np.bincount(entropies(data)[at], minlength=LEVELS)


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each level, the rarest first."""
    rank = np.empty(LEVELS, np.int64)
    rank[np.lexsort((np.arange(LEVELS), counts))] = np.arange(LEVELS)
    return rank


def _votes(texts: list[bytes], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes of all features of texts laid end to end, and the number of features of each."""
    data, start, n = _flat(texts)
    if not n.sum():
        return np.empty(0, np.int64), n
    doc = np.repeat(np.arange(len(texts)), n)
    at = np.repeat(start - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
    # features of each text, then room so that no vote reaches into the next one
    slot = np.arange(len(at)) + doc * (NEAR - 1)
    key = np.full(int(slot[-1]) + NEAR, np.iinfo(np.int64).max)
    key[slot] = (rank[entropies(data)[at]] << 32) | np.arange(len(at))
    best, have = key, 1
    while have < NEAR:
        step = min(have, NEAR - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    return np.bincount(best[slot] & 0xFFFFFFFF, minlength=len(at)), n


def selected(text: bytes, rank: np.ndarray) -> np.ndarray:
    """Selected features (their places) of one text of any length, in pieces.

    A feature's votes come from the NEAR - 1 features on either side, so a piece that far over its ends tells them.
    """
    n = max(0, max(WINDOW, len(text)) - WINDOW + 1) if text else 0
    places, most, first = [], -1, 0
    for a in range(0, n, PIECE):
        lo, hi = max(0, a - NEAR + 1), min(n, a + PIECE + NEAR - 1)
        votes = _votes([text[lo : hi + WINDOW - 1]], rank)[0][a - lo : a - lo + PIECE]
        places.append(a + np.flatnonzero(votes >= VOTES))
        if len(votes) and votes.max() > most:
            most, first = int(votes.max()), a + int(votes.argmax())
    found = np.concatenate(places) if places else np.empty(0, np.int64)
    return found if len(found) or not n else np.array([first])


def digest(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """Chain of filters of each text, as (filters, FILTER_BITS / 64) words."""
    words = FILTER_BITS // 64
    short = [t if len(t) < PIECE + WINDOW else b"" for t in texts]
    votes, n = _votes(short, rank)
    first = np.r_[0, np.cumsum(n)[:-1]]
    own = np.repeat(np.arange(len(texts)), n)
    hit = np.flatnonzero(votes >= VOTES)
    owners, places = [own[hit]], [hit - first[own[hit]]]
    none = (np.bincount(own[hit], minlength=len(texts)) == 0) & (n > 0)
    for k in np.flatnonzero(none):
        owners.append(np.array([k]))
        places.append(np.array([votes[first[k] : first[k] + n[k]].argmax()]))
    for k, t in enumerate(texts):
        if len(t) >= PIECE + WINDOW:
            got = selected(t, rank)
            owners.append(np.full(len(got), k))
            places.append(got)
    owner, place = np.concatenate(owners), np.concatenate(places)
    if not len(owner):
        return [np.zeros((1, words), np.uint64) for _ in texts]
    order = np.lexsort((place, owner))
    owner, place = owner[order], place[order]
    data, start, _ = _flat(texts)
    cells = data[(start[owner] + place)[:, None] + np.arange(WINDOW)].view("<u8").astype(np.uint64)
    h = np.zeros(len(owner), np.uint64)
    for c in range(WINDOW // 8):
        h = mix(h ^ cells[:, c] ^ np.uint64(c + 1))
    g = mix(h) | np.uint64(1)
    count = np.bincount(owner, minlength=len(texts))
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    chain = np.maximum(1, -(-count // FEATURES))
    base = np.r_[0, np.cumsum(chain)[:-1]]
    row = (base[owner] + nth // FEATURES) * FILTER_BITS
    bits = np.zeros(int(chain.sum()) * FILTER_BITS, np.uint8)
    for p in range(PROBES):
        bits[row + ((h + np.uint64(p) * g) >> np.uint64(53)).astype(np.int64)] = 1
    packed = np.packbits(bits).view(np.uint64).reshape(-1, words)
    return [packed[b : b + c] for b, c in zip(base.tolist(), chain.tolist(), strict=True)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if len(a) > len(b):
        a, b = b, a
    na, nb = np.bitwise_count(a).sum(1, dtype=np.int64), np.bitwise_count(b).sum(1, dtype=np.int64)
    if not na.any() or not nb.any():
        return float(not na.any() and not nb.any())
    total = 0.0
    for f, k in zip(a, na.tolist(), strict=True):
        both = np.bitwise_count(b & f).sum(1, dtype=np.int64)
        chance = k * nb / FILTER_BITS
        room = np.minimum(k, nb) - chance
        total += float(np.clip((both - chance) / np.maximum(room, 1e-9), 0.0, 1.0).max())
    return total / len(a)


def as_text(chain: np.ndarray) -> str:
    return f"{len(chain)}:{base64.b64encode(chain.tobytes()).decode()}"


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s.partition(":")[2]), np.uint64).reshape(-1, FILTER_BITS // 64)


def fit_rarity(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Rarity ranks of entropy levels over every window of every document (at most LEVELS rows come back)."""
    import pyarrow as pa

    def run(batches):
        total = np.zeros(LEVELS, np.int64)
        for b in batches:
            for s in small_batches(pa.Table.from_batches([b]), 100_000, "text", 1 << 20):
                total += level_counts([t or b"" for t in s.column("text").to_pylist()])
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["level", "n"])

    got = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(tidy(run), schema_of(level="long", n="long")).groupBy("level").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(LEVELS, np.int64)
    for r in got:
        counts[r.level] = r.n
    return rarity(counts)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """(key, text, part, ghost) dealt and sorted so that the next row of a part is the next document by descending id.

    Ghost rows repeat the first document of the next part (cyclically) and stand last.
    """
    spark = docs.sparkSession
    rows = docs.select(id_key(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = partitions(spark)
    splits = np.array(id_splits(rows, F.col("key"), n), np.int64)

    @F.pandas_udf("int")
    def part_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splits, key.to_numpy(), "left").astype(np.int32))

    parted = rows.withColumn("part", part_of("key"))
    heads = sorted((r.part, r.head) for r in rows.select("key").withColumn("part", part_of("key")).groupBy("part").agg(F.max("key").alias("head")).collect())
    # the head of each part also goes to the part above it; that of the highest to the lowest
    target = [(h, heads[(i + 1) % len(heads)][0]) for i, (_, h) in enumerate(heads)]
    ghosts = spark.createDataFrame(target, "key long, part int")  # at most n rows
    more = parted.drop("part").join(F.broadcast(ghosts), "key").select("key", "text", "part", F.lit(1).alias("ghost"))
    every = parted.select("key", "text", "part", F.lit(0).alias("ghost")).unionByName(more)
    return every.repartitionById(len(splits) + 1, "part").sortWithinPartitions("part", "ghost", F.desc("key"), "text"), len(heads)


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rank: np.ndarray | None = None) -> DataFrame:
    """doc_id, n_chars, edited (the edited text's SHA-256), fingerprint, edited_fingerprint, near_edited, near_next."""
    import pyarrow as pa

    schema = schema_of(doc_id="long", n_chars="long", edited_sha256="string", fingerprint="string", edited_fingerprint="string", near_edited="double", near_next="double")
    rank = fit_rarity(docs, text_col) if rank is None else rank
    dealt, parts = with_next(docs, id_col, text_col)
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)

    def solve(rows: list[tuple]):
        """rows: (key, text, part, ghost); all but those without a next row in their part come out."""
        pairs = [i for i in range(len(rows) - 1) if not rows[i][3] and rows[i][2] == rows[i + 1][2]]
        edited = []
        for i in pairs:
            t, u = rows[i][1], rows[i + 1][1]
            half = len(t) // 2
            edited.append((t[: len(t) - half] + u[:half]).encode())
        own = digest([r[1].encode() for r in rows], rank)
        new = digest(edited, rank)
        out = [(None if rows[i][0] == NULL_ID else rows[i][0], len(rows[i][1]), hashlib.sha256(e).hexdigest(), as_text(own[i]), as_text(f), likeness(own[i], f), likeness(own[i], own[i + 1])) for i, e, f in zip(pairs, edited, new, strict=True)]
        cols = list(zip(*out, strict=True)) or [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True)], names=schema.names)

    def run(batches):
        held: list[tuple] = []
        size = 0
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("key", "text", "part", "ghost")), strict=True):
                held.append(row)
                size += len(row[1])
                if size >= 1 << 19 and len(held) > 1:
                    yield solve(held)
                    held, size = held[-1:], len(held[-1][1])
        if len(held) > 1:
            yield solve(held)

    return dealt.mapInArrow(tidy(run), schema)


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
