"""Operator 9: SimHash near-duplicates by bit-sliced comparison.

* Fingerprints: 64 majority bits over the XXH64 of every word shingle, repeats included.
* Candidates: two fingerprints within radius r agree on one of r+1 blocks of bits, so the mask of a
  block and the masked value name a bucket.  Buckets over a bound are split again by blocks of their
  remaining bits (still exact), so no group lands in one task.
* Comparison: bit planes stored vertically; one carry-save step a plane updates the distances of 64
  pairs a word; words whose pairs all exceed the radius are abandoned.  Larger buckets are compared by
  tiles of 64 queries, several buckets at once.
* Only a spanning forest of each bucket's links leaves a task; `components` joins the rest.

Input cases: null or blank text has no words and gets fingerprint 0, linked like any other; repeated
rows keep their own output rows; an empty table gives an empty table; extra columns are ignored; an id
that isn't a whole number raises.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, save, schema_of, tidy
from .components import components

#: Buckets above this many fingerprints are split by further bits, as often as bits remain.
BUCKET = 2048
#: Words of 64 pairs that are compared together (64 planes: 2 MB), and rows that a task looks for buckets in together.
TILE_WORDS, ROWS = 4096, 1 << 16
_ALL = (1 << 64) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# ---------------------------------------------------------------- fingerprints


def fingerprint(texts: list[bytes | None], shingle: int = 3, seed: int = 42, chunk: int = 100_000) -> np.ndarray:
    """Unsigned fingerprints of UTF-8 texts, with counters of bounded size whatever a text's length."""
    from xxhash import xxh64_intdigest as h64

    ones = np.zeros((len(texts), 64), dtype=np.int64)
    totals = np.zeros(len(texts), dtype=np.int64)
    got: list[int] = []
    rows: list[tuple[int, int]] = []

    def flush() -> None:
        if got:
            bits = np.unpackbits(np.array(got, dtype=">u8").view(np.uint8)).reshape(-1, 64)
            sums = np.add.reduceat(bits, [at for _, at in rows], axis=0, dtype=np.int32)
            np.add.at(ones, [k for k, _ in rows], sums)
            got.clear()
            rows.clear()

    for k, text in enumerate(texts):
        words = text.lower().split() if text else []
        n = len(words)
        if not n:
            continue
        totals[k] = max(1, n - shingle + 1)
        for a in range(0, max(1, n - shingle + 1), chunk):
            part = words[a : a + chunk + shingle - 1]
            rows.append((k, len(got)))
            got.extend(h64(b" ".join(x), seed) for x in zip(*(part[i:] for i in range(shingle)), strict=False)) if n >= shingle else got.append(h64(b" ".join(words), seed))
            if len(got) >= chunk:
                flush()
    flush()
    bits = (2 * ones > totals[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1).view(">u8").reshape(-1).astype(np.uint64)


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's bits as a signed long."""
    import pyarrow as pa

    def run(batches):
        from .common import small_batches

        for b in batches:
            for s in small_batches(pa.Table.from_batches([b]), 2000, "text"):
                fp = fingerprint(s.column("text").to_pylist(), shingle, seed).astype(np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([s.column("doc_id").combine_chunks() if s.column("doc_id").num_chunks != 1 else s.column("doc_id").chunk(0), pa.array(fp)], names=["doc_id", "fp"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return src.mapInArrow(tidy(run), schema_of(doc_id="long", fp="long"))


# ---------------------------------------------------------------- bit-sliced distances


def planes(fps: np.ndarray) -> np.ndarray:
    """64 bit planes of n fingerprints, each packed into ceil(n/64) words."""
    n = len(fps)
    bits = np.unpackbits(np.ascontiguousarray(fps, dtype=np.uint64).view(np.uint8).reshape(n, 8), axis=1, bitorder="little").T
    words = -(-n // 64)
    packed = np.zeros((64, words * 8), dtype=np.uint8)
    got = np.packbits(bits, axis=1, bitorder="little")
    packed[:, : got.shape[1]] = got
    return packed.view(np.uint64)


def within(x: np.ndarray, n: int, radius: int, block: int = 64, over: np.ndarray | None = None) -> np.ndarray:
    """Positions of the n pairs at distance <= radius, from the planes of their XOR; over: lanes that don't count.

    counters holds the distances in vertical binary: plane by plane, a carry-save add ripples the
    new bit up; a carry out of the top, or a value above the radius, marks the pair as over.
    Words whose pairs are all over are abandoned once they are half of all, while there are more than a block.
    """
    words = x.shape[1]
    n = int(n)
    depth = max(1, radius.bit_length())
    counters = np.zeros((depth, words), dtype=np.uint64)
    over = np.zeros(words, dtype=np.uint64) if over is None else over.copy()
    if n % 64:
        over[-1] |= np.uint64(_ALL ^ ((1 << (n % 64)) - 1))
    at = np.arange(words)
    while len(x):
        for carry in x[:4]:
            for c in counters:
                up = c & carry
                c ^= carry
                carry = up
            over |= carry
        if radius + 1 < (1 << depth):  # a value of the counter itself may exceed the radius
            over |= _above(counters, radius)
        x = x[4:]
        alive = over != np.uint64(_ALL)
        k = np.count_nonzero(alive)
        if not k:
            return np.empty(0, dtype=np.int64)
        if len(at) > block and 2 * k <= len(at):
            x, counters, over, at = x[:, alive], counters[:, alive], over[alive], at[alive]
    word, lane = np.nonzero(np.unpackbits((~over).view(np.uint8), bitorder="little").reshape(-1, 64))
    return 64 * at[word] + lane


def _above(counters: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose vertical value is over the radius."""
    more = np.zeros(counters.shape[1], dtype=np.uint64)
    same = np.full(counters.shape[1], _ALL, dtype=np.uint64)
    for d in range(counters.shape[0] - 1, -1, -1):
        if radius >> d & 1:
            same &= counters[d]
        else:
            more |= same & counters[d]
            same &= ~counters[d]
    return more


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Indices of the edges that join two trees so far."""
    parent: dict[int, int] = {}

    def find(v: int) -> int:
        while (p := parent.setdefault(v, v)) != v:
            parent[v] = v = parent[p]
        return v

    kept = []
    for k, (u, v) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        ru, rv = find(u), find(v)
        if ru != rv:
            parent[max(ru, rv)] = min(ru, rv)
            kept.append(k)
    return kept


def _tiles(f: np.ndarray):
    """All pairs of a bucket by 64 queries at a time: (first, words, planes of XOR, lanes that aren't pairs).

    A query meets the words from its own on, so a tile's word k is that of query first + k // words.
    """
    p, full, n = planes(f), np.uint64(_ALL), len(f)
    for t in range(p.shape[1]):
        q = f[64 * t : 64 * t + 64]
        bits = np.where((q >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1), full, np.uint64(0))
        words = p.shape[1] - t
        over = np.zeros((len(q), words), np.uint64)
        over[:, 0] = full >> np.arange(63, 63 - len(q), -1, dtype=np.uint64)  # itself and those before it
        if n % 64:
            over[:, -1] |= np.uint64(_ALL ^ ((1 << (n % 64)) - 1))
        yield 64 * t, words, (p[:, None, t:] ^ bits[:, :, None]).reshape(64, -1), over.reshape(-1)


def bucket_links(group: np.ndarray, fps: np.ndarray, radius: int, small: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest for rows sorted by group, each group being one bucket."""
    n = len(group)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.empty(0, dtype=np.int64)
    sizes = np.diff(np.r_[starts, n])
    out_a, out_b = [], []
    # Small buckets together: compare each row with the d-th after it, for all buckets at once.
    few = np.repeat(sizes <= small, sizes)
    pos = np.flatnonzero(few)
    for d in range(1, small):
        pos = pos[pos + d < n]
        pos = pos[group[pos] == group[np.minimum(pos + d, n - 1)]]
        if not len(pos):
            break
        for lo in range(0, len(pos), 1 << 16):
            at = pos[lo : lo + (1 << 16)]
            hit = within(planes(fps[at] ^ fps[at + d]), len(at), radius)
            out_a.append(fps[at[hit]])
            out_b.append(fps[at[hit] + d])
    # Large buckets: tiles of 64 queries against the words from theirs on, those of several buckets in one comparison.
    label = np.arange(n)
    held: list[tuple] = []

    def compare() -> None:
        x, over = (np.concatenate([h[k] for h in held], axis=-1) for k in (4, 5))
        hit = within(x, 64 * x.shape[1], radius, over=over)
        ends = np.cumsum([len(h[5]) for h in held])
        tile = np.searchsorted(ends, hit >> 6, side="right")
        start, size, first, words = np.array([h[:4] for h in held]).T
        word = (hit >> 6) - np.r_[0, ends][tile]
        a = start[tile] + first[tile] + word // words[tile]
        b = start[tile] + first[tile] + 64 * (word % words[tile]) + (hit & 63)
        new = label[a] != label[b]
        for s, m, i, j in zip(start[tile[new]].tolist(), size[tile[new]].tolist(), a[new].tolist(), b[new].tolist(), strict=True):
            if label[i] != label[j]:
                own = label[s : s + m]
                own[own == label[j]] = label[i]
                out_a.append(fps[i : i + 1])
                out_b.append(fps[j : j + 1])
        held.clear()

    waiting = 0
    for s, size in zip(starts[sizes > small], sizes[sizes > small], strict=True):
        for first, words, x, over in _tiles(fps[s : s + size]):
            held.append((s, size, first, words, x, over))
            waiting += len(over)
            if waiting >= TILE_WORDS:
                compare()
                waiting = 0
    if held:
        compare()
    if not out_a:
        none = np.empty(0, dtype=np.uint64)
        return none, none
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    kept = _forest(a, b)
    return a[kept], b[kept]


# ---------------------------------------------------------------- distributed search


def _blocks(bits: list[int], parts: int) -> list[int]:
    """Masks of `parts` nearly equal groups of bit positions."""
    return [sum(1 << b for b in bits[len(bits) * i // parts : len(bits) * (i + 1) // parts]) for i in range(parts)]


def _split(mask: int, radius: int) -> list[int]:
    """Finer masks for a bucket: its remaining bits in radius+1 blocks, one of which two near members share."""
    rest = [b for b in range(64) if not mask >> b & 1]
    return [mask | m for m in _blocks(rest, radius + 1)] if len(rest) > radius else []


def links(distinct: DataFrame, radius: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) of fingerprints within the radius: a spanning forest of each bucket, so components are exact.

    distinct: column fp, each value once.
    """
    import pyarrow as pa

    spark = distinct.sparkSession
    bucket = max(bucket, 1 << radius)  # a mask that leaves `radius` bits has no larger bucket
    masks = _blocks(list(range(64)), radius + 1)
    keyed = distinct.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    ready = None
    while True:
        keyed = keyed.withColumn("val", F.col("fp").bitwiseAND(F.col("mask")))
        finer = {m: _split(m, radius) for m in masks}
        hot = None
        if any(finer.values()):  # else no bits are left to split by
            hot = save(keyed.groupBy("mask", "val").count().where(F.col("count") > bucket).select("mask", "val"), "hot")
        if hot is None or hot.isEmpty():
            ready = keyed if ready is None else ready.unionByName(keyed)
            break
        cold = keyed.join(hot, ["mask", "val"], "left_anti")
        ready = cold if ready is None else ready.unionByName(cold)
        # at most (radius + 1) ** level masks, whatever the number of fingerprints
        used = {r.mask % (1 << 64) for r in hot.select("mask").distinct().collect()}
        rows = [(_signed(m), _signed(x)) for m in sorted(used) for x in finer[m]]
        table = spark.createDataFrame(rows, "mask long, finer long")
        whole = keyed.join(hot, ["mask", "val"], "left_semi")
        keyed = save(whole.join(F.broadcast(table), "mask").select("fp", F.col("finer").alias("mask")).distinct(), "split")
        masks = sorted({x for m in used for x in finer[m]})

    def run(batches):
        def done(mask, val, fp):
            group = np.cumsum(np.r_[0, (mask[1:] != mask[:-1]) | (val[1:] != val[:-1])])
            a, b = bucket_links(group, fp, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["u", "v"])

        left, rows, enough = [], 0, ROWS
        for b in batches:
            cols = [np.asarray(b.column(c).to_numpy(zero_copy_only=False)) for c in ("mask", "val", "fp")]
            cols[2] = cols[2].astype(np.int64).view(np.uint64)
            left.append(cols)
            rows += len(cols[0])
            if rows < enough:
                continue
            cols = [np.concatenate(x) for x in zip(*left, strict=True)]
            cut = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = cut[-1] + 1 if len(cut) else 0  # the last bucket may go on in the next batch
            if cut:
                yield done(*(x[:cut] for x in cols))
            left = [[x[cut:] for x in cols]]
            rows -= cut
            enough = rows + ROWS
        if rows:
            yield done(*(np.concatenate(x) for x in zip(*left, strict=True)))

    dealt = ready.select("mask", "val", "fp").repartition(partitions(spark), "mask", "val").sortWithinPartitions("mask", "val", "fp")
    return dealt.mapInArrow(tidy(run), schema_of(u="long", v="long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """One row a document: doc_id, fp (long), component_id (smallest id reachable over links, itself included)."""
    prints = save(with_fingerprints(docs, id_col, text_col, shingle, seed), "prints")
    classes = save(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    roots = components(links(classes.select("fp"), radius))
    joined = save(classes.join(roots.withColumnRenamed("node", "fp"), "fp"), "joined")
    lowest = joined.groupBy("root").agg(F.min("low").alias("component"))
    linked = joined.join(lowest, "root").select("fp", "component")
    table = classes.join(linked, "fp", "left").select("fp", F.coalesce("component", "low").alias("component_id"))
    return prints.join(table, "fp").select("doc_id", "fp", "component_id")


def op9_simhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
