"""Operator 5: benchmark decontamination by a generalised suffix automaton.

Items are dealt to shards of bounded size; a task a shard builds its automaton, lays it out in flat arrays
and writes them to the shared folder.  Tasks over documents map those files one at a time, so memory stays
bounded however large the benchmark is, and nothing is broadcast or gathered on the driver.  Documents
stream through in one pass without a shuffle: only runs of words that all occur in a shard's items can
match.  All runs of some megabytes of text are walked in step, keeping each one's state and longest
matching length; a match of a window or more marks the window's words.

Words: ASCII letters lower-cased, then runs of digits, a-z and non-ASCII characters.  A window is 13
consecutive item words; a shorter, non-empty item is one window.

Input cases: null or wordless text has no words, no hits and is not contaminated; an item without
words never occurs; items with a null id give hits and spans but aren't listed in items; repeated item
ids count once; repeated documents keep their rows; empty tables on either side are fine; other columns
are passed through only by `remove_contamination`; ids of any type are kept as they are.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays
from .common import put_bytes, save, schema_of, shared_folder, small_batches, tidy

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WINDOW = 13
#: A document is contaminated if at least one in this many of its words is hit.
COVERAGE = 20
#: Bytes of item text in one automaton; building one takes about forty times as much, its file about six.
SHARD_BYTES = 4 << 20
#: Bytes of documents walked together, and steps of one walk: longer runs are walked in overlapping pieces.
SLICE_BYTES = 16 << 20
STEPS = 256
#: Stands for a null item id inside the automata.
NO_ID = "\0null"


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


class Automaton:
    """Builds the suffix automaton of several word sequences, with the items that each window belongs to."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.len = [-1], [0]
        used = [(k, w) for k, w in items if w]
        for _, words in used:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.shortest = min([window, *(len(w) for _, w in used)])
        n = len(self.len)
        self.names = sorted({k for k, _ in used})
        number = {k: i for i, k in enumerate(self.names)}
        self.items: list[set | None] = [None] * n
        self.short: list[set | None] = [None] * n
        for k, words in used:
            v = 0
            for i, w in enumerate(words):
                v = self.next[v][w]
                if i + 1 >= window:
                    u = self._holding(v, window)
                    self.items[u] = (self.items[u] or set()) | {number[k]}
            if len(words) < window:
                u = self._holding(v, len(words))
                self.short[u] = (self.short[u] or set()) | {(len(words), number[k])}
        #: The state that holds the window-long suffix of each state's strings, and the nearest one up the
        #: links (itself included) where short items end.
        self.at, self.ends = [0] * n, [0] * n
        for v in sorted(range(n), key=self.len.__getitem__)[1:]:
            up = self.link[v]
            self.at[v] = v if self.len[up] < window else self.at[up]
            self.ends[v] = v if self.short[v] else self.ends[up]

    def arrays(self) -> dict[str, np.ndarray]:
        """The automaton as flat arrays: edges sorted by state and word, lists of items by offsets."""
        words = sorted(self.next[0])
        number = {w: i for i, w in enumerate(words)}
        edges = sorted((v * len(words) + number[w], to) for v, out in enumerate(self.next) for w, to in out.items())
        short = [sorted(x or ()) for x in self.short]
        names = [k.encode() for k in self.names]
        return {
            "size": np.array([self.window, self.shortest, len(words)], np.int64),
            "words": np.frombuffer(b" ".join(words) or b" ", np.uint8),
            "names": np.frombuffer(b"".join(names) or b" ", np.uint8),
            "name_from": np.cumsum([0, *map(len, names)]).astype(np.int64),
            "edge": np.array([k for k, _ in edges], np.int64),
            "to": np.array([to for _, to in edges], np.int32),
            "link": np.array(self.link, np.int32),
            "len": np.array(self.len, np.int32),
            "at": np.array(self.at, np.int32),
            "ends": np.array(self.ends, np.int32),
            "item_from": np.cumsum([0, *(len(x or ()) for x in self.items)]).astype(np.int64),
            "item": np.array([k for x in self.items for k in sorted(x or ())], np.int32),
            "short_from": np.cumsum([0, *map(len, short)]).astype(np.int64),
            "short_len": np.array([n for x in short for n, _ in x], np.int32),
            "short_item": np.array([k for x in short for _, k in x], np.int32),
        }

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Half-open word ranges inside occurrences of windows, and the items that occur, of one text."""
        flat = Slice([words])
        hits = Walk(self.arrays()).hits(flat)
        return flat.spans(hits)[0], flat.items([hits])[0]

    def _holding(self, v: int, size: int) -> int:
        while self.len[self.link[v]] >= size:
            v = self.link[v]
        return v

    def _extend(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.len
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, q, w)
        cur = len(length)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, w)
        return cur

    def _clone(self, p: int, q: int, w: bytes) -> int:
        new = len(self.len)
        self.next.append(dict(self.next[q]))
        self.len.append(self.len[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = new
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        return new


class Slice:
    """Words of some texts, numbered: each distinct one once."""

    def __init__(self, texts: list[list[bytes]]):
        self.counts = np.array([len(w) for w in texts], np.int64)
        self.start = np.r_[0, np.cumsum(self.counts)]
        every = [w for t in texts for w in t]
        self.words = {w: i for i, w in enumerate(dict.fromkeys(every))}
        self.ids = np.fromiter(map(self.words.__getitem__, every), np.int32, len(every))

    def runs(self, known: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of known words inside texts, at least `shortest` long."""
        a, b = self.runs_of(known[self.ids])
        keep = b - a >= shortest
        return a[keep], b[keep]

    def runs_of(self, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of runs of flagged words; a run ends with its text."""
        edge = np.zeros(len(flags) + 1, bool)
        edge[self.start] = True
        new = flags & (edge[:-1] | np.r_[True, ~flags[:-1]])[: len(flags)]
        last = flags & (edge[1:] | np.r_[~flags[1:], True])[: len(flags)]
        return np.flatnonzero(new), np.flatnonzero(last) + 1

    def spans(self, hits: Hits) -> list[list[tuple[int, int]]]:
        """Merged word ranges of each text."""
        edge = np.zeros(len(self.ids) + 1, np.int64)
        np.add.at(edge, hits.start, 1)
        np.add.at(edge, hits.end, -1)
        hit = np.cumsum(edge[:-1]) > 0
        a, b = self.runs_of(hit)
        text = np.searchsorted(self.start, a, "right") - 1
        out: list[list[tuple[int, int]]] = [[] for _ in self.counts]
        for k, x, y in zip(text.tolist(), (a - self.start[text]).tolist(), (b - self.start[text]).tolist(), strict=True):
            out[k].append((x, y))
        return out

    def items(self, hits: list[Hits]) -> list[set[str]]:
        """Names of the items that occur in each text."""
        out: list[set[str]] = [set() for _ in self.counts]
        for h in hits:
            text = np.searchsorted(self.start, h.owner, "right") - 1
            for k, i in set(zip(text.tolist(), h.item.tolist(), strict=True)):
                out[k].add(h.names[i])
        return out


class Hits:
    """Word ranges inside occurrences, and (word, item) pairs: that an item occurs in the text of that word."""

    def __init__(self, start, end, owner, item, names):
        self.start, self.end, self.owner, self.item, self.names = start, end, owner, item, names


class Walk:
    """An automaton's flat arrays, walked by all runs of a slice in step."""

    def __init__(self, a: dict[str, np.ndarray]):
        self.a = a
        self.window, self.shortest, self.n_words = a["size"].tolist()
        blob, at = a["names"].tobytes(), a["name_from"].tolist()
        self.names = [blob[x:y].decode() for x, y in zip(at, at[1:], strict=False)]
        self.vocabulary = dict(zip(a["words"].tobytes().split(), range(self.n_words), strict=False))

    def _lists(self, offsets: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in lists of each state, end to end, and which state each belongs to."""
        n = offsets[states + 1] - offsets[states]
        which = np.repeat(np.arange(len(states)), n)
        return np.repeat(offsets[states] - (np.cumsum(n) - n), n) + np.arange(len(which)), which

    def hits(self, s: Slice) -> Hits:
        a, window, n_words = self.a, self.window, self.n_words
        none = np.empty(0, np.int64)
        if not n_words or not len(s.ids):
            return Hits(none, none, none, none, self.names)
        look = self.vocabulary.get
        word = np.fromiter((look(w, -1) for w in s.words), np.int64, len(s.words))
        first, last = s.runs(word >= 0, self.shortest)
        # pieces of long runs overlap by a window less one, so each window lies in one whole
        pieces = np.maximum(1, -(-(last - first - window + 1) // STEPS))
        run = np.repeat(np.arange(len(first)), pieces)
        nth = np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = first[run] + nth * STEPS
        end = np.minimum(last[run], begin + STEPS + window - 1)
        order = np.argsort(begin - end, kind="stable")  # the longest first: those still walking are a prefix
        begin, end = begin[order], end[order]
        steps = end - begin
        state, size = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
        link, length, edge, to = a["link"], a["len"], a["edge"], a["to"]
        found_at, found_state, ends_at, ends_state, ends_size = [], [], [], [], []
        for k in range(int(steps[0]) if len(steps) else 0):
            n = int(np.searchsorted(-steps, -k, "left"))  # pieces of more than k words
            at = begin[:n] + k
            w = word[s.ids[at]]
            cur, have = state[:n], size[:n]
            todo = np.arange(n)
            while len(todo):
                key = cur[todo] * n_words + w[todo]
                place = np.minimum(np.searchsorted(edge, key), len(edge) - 1)
                ok = edge[place] == key
                go = todo[ok]
                cur[go] = to[place[ok]]
                have[go] += 1
                todo = todo[~ok]
                cur[todo] = link[cur[todo]]
                have[todo] = length[cur[todo]]
            long = np.flatnonzero(have >= window)
            found_at.append(at[long])
            found_state.append(a["at"][cur[long]])
            some = np.flatnonzero(a["ends"][cur])
            ends_at.append(at[some])
            ends_state.append(a["ends"][cur[some]])
            ends_size.append(have[some])
        if not found_at:
            return Hits(none, none, none, none, self.names)
        at, states = np.concatenate(found_at), np.concatenate(found_state)
        place, which = self._lists(a["item_from"], states)
        start, stop, owner, item = [at - window + 1], [at + 1], [at[which]], [a["item"][place]]
        # short items: those of the state and of all states up its links that have some
        at, states, have = np.concatenate(ends_at), np.concatenate(ends_state).astype(np.int64), np.concatenate(ends_size)
        while len(states):
            place, which = self._lists(a["short_from"], states)
            n = a["short_len"][place].astype(np.int64)
            fits = n <= have[which]
            place, which, n = place[fits], which[fits], n[fits]
            start.append(at[which] - n + 1)
            stop.append(at[which] + 1)
            owner.append(at[which])
            item.append(a["short_item"][place])
            up = a["ends"][link[states]]
            more = up > 0
            at, have, states = at[more], have[more], up[more].astype(np.int64)
        return Hits(*map(np.concatenate, (start, stop, owner, item)), self.names)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def build_shards(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> list[str]:
    """Automaton files in the shared folder, each built by the task that holds its items."""
    import pyarrow as pa

    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit(NO_ID)).alias("k"), F.col(text_col).cast("binary").alias("t")).where("t is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // shard_bytes))
    folder = shared_folder(spark, "automata")

    def build(batches):
        shards: dict[int, list] = {}
        for b in batches:
            for i, k, t in zip(*(b.column(c).to_pylist() for c in ("shard", "k", "t")), strict=True):
                shards.setdefault(i, []).append((k, t))
        for i in sorted(shards):
            made = Automaton(sorted((k, words_of(t)) for k, t in shards.pop(i)), window)
            put_bytes(f"{folder}/{i:05d}.automaton", arrays.dump(made.arrays()))
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64())], names=["shard"])

    # by text as well as id, so that items without an id are spread
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("k", "t"), F.lit(n)).cast("int")).repartitionById(n, "shard")
    told = save(dealt.mapInArrow(tidy(build), schema_of(shard="long")), "shards").collect()  # one row a shard
    return [f"{folder}/{i:05d}.automaton" for i in sorted(r.shard for r in told)]


def with_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shard_bytes: int = SHARD_BYTES, slice_bytes: int = SLICE_BYTES // 4) -> DataFrame:
    """doc_id, n_words, items (sorted ids that occur), spans (merged word ranges as start, end, start, end, ...), cut (text without them)."""
    import pyarrow as pa

    uris = build_shards(benchmark, window=window, shard_bytes=shard_bytes)

    def solved(table):
        texts = table.column("text").to_pylist()
        flat = Slice([words_of(t) for t in texts])
        # one shard's vocabulary in memory at a time; a single one stays for the next slice
        hits = [(one or Walk(arrays.load(u))).hits(flat) for u in uris]
        spans = flat.spans(Hits(*(np.concatenate([getattr(h, c) for h in hits]) for c in ("start", "end", "owner", "item")), None)) if hits else [[] for _ in texts]
        items = flat.items(hits)
        cut = [_cut(t, x) if x else t for t, x in zip(texts, spans, strict=True)]
        return pa.RecordBatch.from_arrays(
            [table.column("doc_id").combine_chunks(), pa.array(flat.counts), pa.array([sorted(x - {NO_ID}) for x in items], pa.list_(pa.string())),
             pa.array([[p for ab in x for p in ab] for x in spans], pa.list_(pa.int64())), pa.array([None if c is None else c.decode() for c in cut], pa.string())],
            names=["doc_id", "n_words", "items", "spans", "cut"],
        )

    one: Walk | None = None

    def run(batches):
        nonlocal one
        one = Walk(arrays.load(uris[0])) if len(uris) == 1 else None
        held, size = [], 0
        for b in batches:
            for part in small_batches(pa.Table.from_batches([b]), 20_000, "text", SLICE_BYTES if len(uris) > 1 else slice_bytes):
                held.append(part)
                size += part.nbytes
                if len(uris) == 1 or size >= SLICE_BYTES:
                    yield solved(pa.concat_tables(held))
                    held, size = [], 0
        if held:
            yield solved(pa.concat_tables(held))

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(tidy(run), f"doc_id {kind}, n_words long, items array<string>, spans array<bigint>, cut string")


def _cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the bytes from the first to the last word of each span."""
    at = [m.span() for m in WORD.finditer(text.lower())]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, text[last:]])


def _n_hit() -> Column:
    return F.expr("aggregate(transform(spans, (x, i) -> if(i % 2 = 1, x, -x)), 0L, (s, x) -> s + x)")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES // 4) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items, spans, cut, contaminated."""
    hits = with_hits(docs, benchmark, id_col, text_col, slice_bytes=slice_bytes).withColumn("n_hit", _n_hit())
    return hits.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * COVERAGE >= F.col("n_words")))


def remove_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES // 4) -> DataFrame:
    """Documents over the coverage limit go; from the others, spans of hit words are cut.  Keeps all columns.

    Rows travel through the automaton whole, so no join back is needed.
    """
    names = docs.columns
    # all but what the cut text gives anew
    packed = docs.select(F.struct(F.lit(True).alias("row"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names) if c not in (text_col, "n_chars")]).alias("row"), F.col(text_col).alias("text"))
    scored = contamination(packed, benchmark, "row", "text", slice_bytes).where(~F.col("contaminated"))
    out = [F.col("cut").alias(c) if c == text_col else F.char_length("cut").cast("long").alias(c) if c == "n_chars" else F.col(f"doc_id.c{i}").alias(c) for i, c in enumerate(names)]
    return scored.select(*out)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def brute_force(texts: list[str | None], items: list[tuple[str, str | None]]) -> list[tuple[int, int, int, str, bool]]:
    """The contract word for word, for tests."""
    split = [(k, words_of(t.encode())) for k, t in items if t]
    out = []
    for t in texts:
        w = words_of(t.encode() if t else None)
        hit, found = [False] * len(w), set()
        for k, iw in split:
            for win in [iw[j : j + WINDOW] for j in range(len(iw) - WINDOW + 1)] if len(iw) >= WINDOW else [iw] * bool(iw):
                for i in range(len(w) - len(win) + 1):
                    if w[i : i + len(win)] == win:
                        found.add(k)
                        hit[i : i + len(win)] = [True] * len(win)
        n = sum(hit)
        out.append((len(w), n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n > 0 and COVERAGE * n >= len(w)))
    return out
