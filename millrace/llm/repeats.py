"""Operator 10: removal of repeated 100-byte strings by parsing, in the manner of prefix-free parsing.

1. Parse: rolling-hash triggers cut every text into phrases (see `parsing`); equal 100-byte strings have
   equal triggers.  Trigger hashes are counted, and a Bloom filter of those seen twice lets all other
   phrases go unshuffled: nothing in them repeats.
2. Parse order: equal phrases are grouped to their first place in the corpus.  Every other place of a
   phrase is removed whole.
3. Dictionary and parse combine, a trigger's class at a time (equal strings are always in one class): the
   class's phrases are ranked by first place, which is the suffix order of the parse as far as it decides
   between equal strings; their suffixes are sorted by bytes, then by that rank; of a run of equal suffixes
   all but the first in corpus order go.

Minima are aggregated before they are shuffled; phrases of one trigger beyond HOT are compared by hashed
windows grouped the same way instead of in one task.

What is compared: the strings themselves in step 3.  In step 2 phrases are equal if their triggers' 64-bit
hashes and, by another alphabet, 64-bit hashes of the whole phrase are; comparing bytes there
would shuffle each repeated phrase, over twice the input.  Among p phrases of which each shares a trigger
with c others, p c / 2**65 false matches are expected: under 1e-6 for 1e11 phrases and c = 100.

Input cases: null or short text loses nothing; a null doc_id sorts first; an empty table gives an empty
table; other columns are ignored.  Rows are known by (doc_id, text): rows equal in both count as one
document, each with that document's result; rows that share an id only are documents of their own, ordered
by a hash of their texts (XXH64, signed), each with its own result.  A doc_id that isn't a whole number raises.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloom
from .common import id_key, partitions, save, schema_of, small_batches, tidy
from .parsing import MOST, SIZE, Hashes, mix, phrases

#: More distinct phrases than this with one trigger are compared by a shuffle of windows.
HOT = 20_000
#: Bytes of texts parsed together.
BUFFER = 1 << 19


def _buffers(batches):
    """(keys, offsets in their texts, cuts, bytes) of texts laid end to end; long texts in overlapping pieces."""
    import pyarrow as pa

    for b in batches:
        for s in small_batches(pa.Table.from_batches([b]), 1 << 20, "text", BUFFER):
            keys, offs, parts = [], [], []
            for k, t in zip(s.column("key").to_pylist(), s.column("text").to_pylist(), strict=True):
                if t is None or len(t) < SIZE:
                    continue
                if len(t) <= MOST // 2:
                    keys.append(k)
                    offs.append(0)
                    parts.append(t)
                    continue
                step = MOST // 2 - SIZE + 1
                for a in range(0, len(t) - SIZE + 1, step):
                    piece = t[a : a + MOST // 2]
                    yield [k], [a], np.zeros(1, np.int64), np.frombuffer(piece, np.uint8)
            if parts:
                sizes = np.array([len(p) for p in parts])
                yield keys, offs, np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64), np.frombuffer(b"".join(parts), np.uint8)


def _parsed(batches):
    """For each buffer: bytes, key, offset in text, position, number of windows, trigger hash, phrase hash, repeat in its own text."""
    before = np.empty(0, np.uint64)  # phrases of a long text's earlier pieces
    for keys, offs, cuts, data in _buffers(batches):
        hashes = Hashes(data)
        kmers = hashes.sliding(32)
        trigger, first, last = phrases(cuts, kmers, len(data))
        text = np.searchsorted(cuts, first, "right") - 1
        core, whole = kmers[trigger], Hashes(data, 1).of(first, last + SIZE)
        # a phrase seen before in the same text is a repeat whatever the corpus holds
        seen = mix(core ^ mix(whole ^ text.astype(np.uint64)))
        _, at = np.unique(seen, return_index=True)
        again = np.ones(len(first), dtype=bool)
        again[at] = False
        if offs[0]:
            again |= np.isin(seen, before)
        before = np.union1d(before, seen) if offs[0] else seen if len(keys) == 1 else before[:0]
        yield data, np.array(keys, np.int64)[text], np.array(offs, np.int64)[text] + first - cuts[text], first, last - first + 1, core, whole, again


def _batch(**cols):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(v.view(np.int64) if getattr(v, "dtype", None) == np.uint64 else v) for v in cols.values()], names=list(cols))


def _place(key: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix(mix(key.view(np.uint64)) ^ at.astype(np.uint64))


def _suffix_repeats(key: np.ndarray, at: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(phrase index, window) of every window whose 100 bytes come earlier, in corpus order, among the phrases given.

    Phrases of several triggers may be given together: suffixes of different classes are never equal.
    """
    # the parse: each phrase's rank by its first place
    rank = np.empty(len(texts), np.int64)
    rank[np.lexsort((at, key))] = np.arange(len(texts))
    # the dictionary: suffixes of all phrases, of which those with a hash of their own need no sorting
    data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.r_[0, np.cumsum(sizes)[:-1]]
    n = sizes - SIZE + 1
    which = np.repeat(np.arange(len(texts)), n)
    window = np.arange(len(which)) - np.repeat(np.r_[0, np.cumsum(n)[:-1]], n)
    start = base[which] + window
    h = Hashes(data).of(start, start + SIZE)
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    twin = np.zeros(len(h), bool)
    twin[order[1:][same]] = True
    twin[order[:-1][same]] = True
    which, window, start = which[twin], window[twin], start[twin]
    if not len(start):
        return which, window
    words = np.zeros(len(data) - 8, np.uint64)
    for j in range(8):
        words = (words << np.uint64(8)) | data[j : len(data) - 8 + j]
    cols = [words[start + o] for o in (*range(0, SIZE - 8, 8), SIZE - 8)]
    order = np.lexsort((window, rank[which], *cols[::-1]))
    equal = np.ones(len(order) - 1, bool)
    for c in cols:
        equal &= c[order][1:] == c[order][:-1]
    late = order[1:][equal]
    return which[late], window[late]


def _runs(key: np.ndarray, at: np.ndarray, which: np.ndarray, window: np.ndarray):
    """Removed windows as (key, first, number) of consecutive ones."""
    order = np.lexsort((window, which))
    which, window = which[order], window[order]
    new = np.r_[True, (which[1:] != which[:-1]) | (window[1:] != window[:-1] + 1)] if len(which) else np.empty(0, bool)
    first = np.flatnonzero(new)
    n = np.diff(np.r_[first, len(which)])
    return _batch(key=key[which[first]], at=at[which[first]] + window[first], n=n)


def ranked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, text): key is a long of its own for each (doc_id, text), in corpus order.

    That is the id itself while ids are unique, which one count over ids tells.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), id_key(id_col).alias("key"), F.col(text_col).cast("binary").alias("text"))
    if rows.groupBy("key").count().where("count > 1").isEmpty():
        return rows
    rows = rows.withColumn("same", F.xxhash64("text"))
    names = rows.select("key", "same").distinct().repartitionByRange(partitions(docs.sparkSession), "key", "same").sortWithinPartitions("key", "same")
    names = save(names.withColumn("place", F.monotonically_increasing_id()), "places")
    return save(rows.join(names, ["key", "same"]).select("doc_id", F.col("place").alias("key"), "text"), "ranked")


def repeated_windows(src: DataFrame, hot: int = HOT) -> DataFrame:
    """(key, at, n): runs of n windows of 100 bytes, from byte `at` of text `key`, that all start earlier too."""
    spark = src.sparkSession
    src = src.select("key", "text")

    def triggers(batches):
        for _, _, _, _, _, core, _, again in _parsed(batches):
            yield _batch(core=core[~again])

    twice = save(src.mapInArrow(tidy(triggers), schema_of(core="long")).groupBy("core").count().where("count > 1").select("core"), "triggers")
    repeated = bloom.build(twice, twice.count())

    def candidates(batches):
        field = bloom.load(repeated)
        for _, key, at, _, n, core, whole, again in _parsed(batches):
            keep = again | bloom.contains(field, core)
            yield _batch(core=core[keep], whole=whole[keep], key=key[keep], at=at[keep], n=n[keep], again=again[keep])

    found = save(src.mapInArrow(tidy(candidates), schema_of(core="long", whole="long", key="long", at="long", n="long", again="boolean")), "phrases")
    places = found.where("not again")
    # one place a document and phrase, so the smallest key has one offset
    firsts = save(places.groupBy("core", "whole").agg(F.min("key").alias("k"), F.min_by("at", "key").alias("a"), F.count("*").alias("times")), "firsts")
    later = places.join(firsts.where("times > 1").select("core", "whole", "k", "a"), ["core", "whole"]).where("key <> k").select("key", "at", "n")
    removed = found.where("again").select("key", "at", "n").unionByName(later)

    several = save(firsts.groupBy("core").agg(F.count("*").alias("m")).where("m > 1"), "several")
    shared = save(firsts.join(several, "core").select(F.col("k").alias("key"), F.col("a").alias("at"), "m"), "shared")
    n_shared = shared.count()
    if not n_shared:
        return removed

    def hashed(batches):
        for b in batches:
            yield _batch(h=_place(b.column(0).to_numpy(), b.column(1).to_numpy()))

    wanted = bloom.build(shared.select("key", "at").mapInArrow(tidy(hashed), schema_of(h="long")), n_shared)

    def dictionary(batches):
        import pyarrow as pa

        field = bloom.load(wanted)
        for data, key, at, first, n, core, _, again in _parsed(batches):
            keep = np.flatnonzero(~again & bloom.contains(field, _place(key, at)))
            raw = data.tobytes()
            texts = [raw[a : a + m + SIZE - 1] for a, m in zip(first[keep].tolist(), n[keep].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(core[keep].view(np.int64)), pa.array(key[keep]), pa.array(at[keep]), pa.array(texts, pa.binary())], names=["core", "key", "at", "bytes"])

    entries = src.mapInArrow(tidy(dictionary), schema_of(core="long", key="long", at="long", bytes="binary"))
    crowded = save(several.where(F.col("m") > hot).select("core"), "crowded")
    if not crowded.isEmpty():
        entries = save(entries, "entries")
        removed = removed.unionByName(_crowded_repeats(entries.join(crowded, "core", "left_semi")))
        entries = entries.join(crowded, "core", "left_anti")

    def resolve(batches):
        import pyarrow as pa

        held: pa.Table | None = None

        def done(t):
            key, at = t.column("key").to_numpy(), t.column("at").to_numpy()
            return _runs(key, at, *_suffix_repeats(key, at, t.column("bytes").to_pylist()))

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]) if held is not None else t
            core = t.column("core").to_numpy()
            if t.num_rows < 8000:  # gather some groups before sorting
                held = t
                continue
            cut = int(np.searchsorted(core, core[-1]))  # rows are sorted by core; the last group may go on
            if cut:
                yield done(t.slice(0, cut))
            held = t.slice(cut)
        if held is not None and held.num_rows:
            yield done(held)

    dealt = entries.repartition(partitions(spark), "core").sortWithinPartitions("core")
    return removed.unionByName(dealt.mapInArrow(tidy(resolve), schema_of(key="long", at="long", n="long")))


def _crowded_repeats(entries: DataFrame) -> DataFrame:
    """The same for triggers with very many phrases: window hashes (128 bits) to their first place, by aggregation."""

    def windows(batches):
        for b in batches:
            key, at = b.column("key").to_numpy(), b.column("at").to_numpy()
            for k, a, t in zip(key, at, b.column("bytes").to_pylist(), strict=True):
                data = np.frombuffer(t, np.uint8)
                n = len(t) - SIZE + 1
                yield _batch(h=Hashes(data).sliding(SIZE), g=Hashes(data, 1).sliding(SIZE), key=np.full(n, k), at=a + np.arange(n))

    rows = save(entries.mapInArrow(tidy(windows), schema_of(h="long", g="long", key="long", at="long")), "windows")
    first = rows.groupBy("h", "g").agg(F.min(F.struct("key", "at")).alias("f"), F.count("*").alias("times")).where("times > 1")
    return rows.join(first, ["h", "g"]).where("key <> f.key or at <> f.at").select("key", "at", F.lit(1).cast("long").alias("n"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary: the remaining bytes) of every document."""
    import pyarrow as pa

    src = ranked(docs, id_col, text_col)
    runs = repeated_windows(src, hot).groupBy("key").agg(F.collect_list("at").alias("ats"), F.collect_list("n").alias("ns"))
    rows = src.join(runs, "key", "left")

    def cut(batches):
        for b in batches:
            texts, ats, ns = (b.column(c).to_pylist() for c in ("text", "ats", "ns"))
            out = []
            for t, a, m in zip(texts, ats, ns, strict=True):
                t = t or b""
                if not a:
                    out.append((len(t), 0, 0, t))
                    continue
                a = np.array(a)
                edge = np.zeros(len(t) + 1, np.int32)
                np.add.at(edge, a, 1)
                np.add.at(edge, a + np.array(m) + SIZE - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                out.append((len(t), int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()), np.frombuffer(t, np.uint8)[~gone].tobytes()))
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.select("doc_id", "text", "ats", "ns").mapInArrow(tidy(cut), schema_of(doc_id="long", n_bytes="long", n_removed="long", n_spans="long", kept="binary"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(docs: list[tuple[int | None, str | None]], size: int = SIZE) -> list[tuple[int | None, int, int, int, str]]:
    """The contract by a set of all strings seen so far, for tests."""
    from xxhash import xxh64_intdigest

    def place(row):
        h = xxh64_intdigest((row[1] or "").encode(), 42)
        return (row[0] is not None, row[0] or 0, h - (1 << 64) * (h >> 63), row[1] or "")

    seen: set[bytes] = set()
    out, now, before = [], None, set()
    for doc, text in sorted(docs, key=place):
        t = (text or "").encode()
        if (doc, t) != now:
            seen |= before
            now, before = (doc, t), set()
        gone = np.zeros(len(t), bool)
        own: set[bytes] = set()
        for a in range(len(t) - size + 1):
            x = t[a : a + size]
            if x in seen or x in own:
                gone[a : a + size] = True
            own.add(x)
        before |= own
        spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        out.append((doc, len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out
