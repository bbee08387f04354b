"""Operator 4: toxicity by compression distance under two zstandard dictionaries.

* Both dictionaries are trained by zstandard: one on ordinary text, one on toxic text.  Toxic documents are mostly
  ordinary prose, so the trained toxic dictionary is pruned by what the method measures: of each segment that piece
  stays with which windows of toxic documents compress better than windows of ordinary ones do, if there is one.
  Training goes on in rounds over the toxic documents that aren't told yet.
* What remains continues the ordinary dictionary, so both code common text alike, and the difference of a
  window's two compressed lengths is its gain.
* Lengths come in whole bytes, and a match costs about three, as much as a short word itself.  So text is coded
  with SPREAD bytes a byte by a fixed code before it is trained on or compressed: a matched word then saves
  several bytes, while the two dictionaries still see the same text.
* A text is cut into overlapping windows of a fixed length.  All that share a string of GRAM bytes with the toxic
  dictionary, strings common in ordinary text left aside, are compressed under both; the others can't gain.
  Its features are the largest gain, the sum of gains, and the numbers of windows and of those that gain; a
  logistic function, calibrated on other training documents than the dictionaries', turns them into a probability.

Bounds on training: TRAIN_DOCS documents a label, chosen by hash, and of each for the dictionaries TRAIN_WINDOWS
windows spread over the text, cut before they are collected.  Calibration collects numbers, not texts.

Input cases: null and empty text has one empty window, without gain; without both labels in training the score is
0; long texts are scored over all windows, a bounded number at a time; repeated rows keep their rows; a document
with several labels counts once for each; an empty table gives an empty table; other columns are ignored; an id
that isn't a whole number raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import schema_of, small_batches, tidy
from .sampling import by_hash

TRAIN_DOCS = 2000
TRAIN_WINDOWS = 8
#: Bytes of a window, and from one to the next.
LENGTH, STEP = 256, 224
#: An optimal parse: greedy ones gain and lose bytes by chance.
LEVEL = 16
SPREAD = 3
#: Bytes of the ordinary dictionary, and of a trained toxic one before it is pruned, in segments.
ORDINARY, CANDIDATES, SEGMENT, GRAM = 16384, 8192, 16, 5
ROUNDS, TRIALS = 12, 60
#: Gain of a window that counts, in bytes; deviations and ratio of rates by which a segment must tell the classes apart.
HIT, TOLD, MOST, LEAST, DEVIATIONS, RATIO = 3, 3, 24, 2, 2.0, 3.0
#: Deviations that a shorter piece may lose.
SLACK = 0.05
THRESHOLD = 0.3
#: Share of ordinary windows in which a string that tells may stand.
COMMON = 0.02
#: Threads of the driver that judge segments; workers use one each.
THREADS = 4
#: Windows compressed in one call.
TOGETHER = 8192


def windows(text: bytes) -> Iterator[bytes]:
    """All windows of a text, overlapping; at least one."""
    yield text[:LENGTH]
    for a in range(STEP, len(text) - (LENGTH - STEP), STEP):
        yield text[a : a + LENGTH]


_CODE = np.random.default_rng(7).integers(0, 256, (256, SPREAD), dtype=np.uint8)


#: The last bytes of a dictionary aren't indexed.
_TAIL = bytes(16)


def spread(data: bytes) -> bytes:
    return _CODE[np.frombuffer(data, np.uint8)].tobytes()


class Grams:
    """Which windows share a string of GRAM bytes with a dictionary's continuation; others can't gain from it.

    A table of hashes, so some more windows than those pass, which are compressed for nothing.  Strings that stand in
    over COMMON of the windows of `plain` don't count: they tell nothing.
    """

    def __init__(self, extra: bytes, plain: list[list[bytes]] = ()):
        self.table = np.zeros(1 << 18, bool)
        if len(extra) >= GRAM:
            self.table[self.hashes(np.frombuffer(extra, np.uint8))] = True
        if plain:
            ws = [[w] for d in plain for w in d]
            self.table &= _presence(ws) <= COMMON * len(ws)

    @staticmethod
    def hashes(data: np.ndarray) -> np.ndarray:
        h = np.zeros(len(data) - GRAM + 1, np.uint32)
        for i in range(GRAM):
            h = h * np.uint32(0x01000193) ^ data[i : len(data) - GRAM + 1 + i]
        return (h * np.uint32(0x9E3779B1)) >> np.uint32(14)

    @staticmethod
    def places(ws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all strings of windows laid end to end, and the windows' ends."""
        data = np.frombuffer(b"".join(ws), np.uint8)
        return Grams.hashes(data) if len(data) >= GRAM else np.empty(0, np.uint32), np.cumsum([len(w) for w in ws])

    def of(self, places: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Which windows share one."""
        hashes, ends = places
        return np.unique(np.searchsorted(ends, np.flatnonzero(self.table[hashes]), "right"))


class Coder:
    """Compressed lengths of windows, spread, under the ordinary dictionary (of spread text) and a continuation of it."""

    def __init__(self, ordinary: bytes, extra: bytes = b"", threads: int = 1):
        import zstandard as z

        self.threads = threads
        params = z.ZstdCompressionParameters.from_level(LEVEL, format=z.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
        data = z.ZstdCompressionDict(ordinary + spread(extra) + _TAIL)
        data.precompute_compress(compression_params=params)
        self.coder = z.ZstdCompressor(compression_params=params, dict_data=data)

    def lengths(self, ws: list[bytes]) -> np.ndarray:
        import zstandard as z

        out = [np.empty(0, np.int64)]
        for lo in range(0, len(ws), TOGETHER):
            some = ws[lo : lo + TOGETHER]
            size = np.array([len(w) for w in some], np.uint64) * np.uint64(SPREAD)
            at = np.cumsum(size) - size
            got = self.coder.multi_compress_to_buffer(z.BufferWithSegments(spread(b"".join(some)) or b"\0", np.stack([at, size], 1).astype(np.uint64).tobytes()), threads=self.threads if len(some) > 64 else 1)
            out.append(np.array([len(got[i]) for i in range(len(got))], np.int64))
        return np.concatenate(out)


class CompressionModel:
    """The two dictionaries and the calibration."""

    def __init__(self, ordinary: bytes, toxic: bytes, grams: Grams, weights: list[float]):
        self.ordinary, self.toxic, self.grams, self.weights = ordinary, toxic, grams, weights
        self._coders: tuple[Coder, Coder] | None = None

    def __getstate__(self):
        return self.ordinary, self.toxic, self.grams, self.weights

    def __setstate__(self, state):
        self.__init__(*state)

    def gains(self, ws: list[bytes]) -> np.ndarray:
        """Bytes that the toxic dictionary saves on each window."""
        if self._coders is None:
            self._coders = Coder(self.ordinary), Coder(self.ordinary, self.toxic)
        plain, toxic = self._coders
        out, at = np.zeros(len(ws), np.int64), self.grams.of(Grams.places(ws))
        some = [ws[i] for i in at.tolist()]
        out[at] = plain.lengths(some) - toxic.lengths(some)
        return out

    def features(self, texts: list[str | None]) -> np.ndarray:
        """(largest gain, sum of gains, windows, windows that gain) of each text."""
        out = np.zeros((len(texts), 4))
        held: list[bytes] = []
        owner: list[int] = []

        def flush() -> None:
            g, k = self.gains(held), np.array(owner, np.int64)
            np.maximum.at(out[:, 0], k, g)
            np.add.at(out[:, 1], k, np.maximum(g, 0))
            np.add.at(out[:, 2], k, 1)
            np.add.at(out[:, 3], k, g >= HIT)
            held.clear()
            owner.clear()

        for k, t in enumerate(texts):
            for w in windows((t or "").lower().encode()):
                held.append(w)
                owner.append(k)
                if len(held) == TOGETHER:
                    flush()
        if held:
            flush()
        return out

    def score_of(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(features) @ np.array(self.weights), -500, 500)))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return self.score_of(self.features(texts))


def _design(x: np.ndarray) -> np.ndarray:
    """Intercept, scaled features, and steps of the largest gain and the number of hits: a calibration that need not be linear."""
    top, total, n, hits = x.T
    size = np.log1p(n)
    steps = [top >= t for t in (2, 4, 6, 8, 12)] + [hits >= t for t in (1, 2, 3)]
    return np.column_stack([np.ones(len(x)), top / 10, np.log1p(total) / 3, np.minimum(4, total / np.maximum(1, n) / 3), size / 5, np.log1p(total) * size / 15, np.minimum(1, hits / np.maximum(1, n)) * 2, *steps])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    keep = np.eye(x.shape[1]) * ridge
    keep[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def trained(samples: list[bytes], size: int, segment: int | None = None) -> bytes:
    """A zstandard dictionary of samples; their bytes themselves where there are too few to train on."""
    import zstandard as z

    try:
        return z.train_dictionary(size, samples, level=LEVEL, **({"k": segment, "d": 6} if segment else {})).as_bytes()
    except z.ZstdError:
        return b"".join(samples)[-size:]


class _Trial:
    """What toxic and ordinary documents save by a continuation of the ordinary dictionary."""

    def __init__(self, ordinary: bytes, toxic: list[list[bytes]], plain: list[list[bytes]]):
        self.ordinary = ordinary
        self.sides = []
        for docs in (toxic, plain):
            ws = [w for d in docs for w in d]
            self.sides.append((ws, np.repeat(np.arange(len(docs)), [len(d) for d in docs]), len(docs)))
        self.places = [Grams.places(ws) for ws, _, _ in self.sides]
        coder = Coder(ordinary, threads=THREADS)
        self.start = [coder.lengths(ws) for ws, _, _ in self.sides]
        self.kept, self.now = b"", self.start

    def lengths(self, extra: bytes) -> list[np.ndarray]:
        """Of all windows, by what is kept and extra; only those that extra touches are compressed anew."""
        grams, coder, out = Grams(extra), Coder(self.ordinary, self.kept + extra, THREADS), []
        for (ws, _, _), places, now in zip(self.sides, self.places, self.now, strict=True):
            at = grams.of(places)
            new = now.copy()
            new[at] = np.minimum(now[at], coder.lengths([ws[i] for i in at.tolist()]))
            out.append(new)
        return out

    def keep(self, extra: bytes) -> None:
        self.now, self.kept = self.lengths(extra), self.kept + extra

    def savings(self, before: list[np.ndarray], after: list[np.ndarray]) -> list[np.ndarray]:
        """Bytes that the documents of each class save over all of their windows, none counting for over MOST."""
        return [np.minimum(MOST, np.bincount(owner, np.maximum(a - b, 0), n)) for (_, owner, n), a, b in zip(self.sides, before, after, strict=True)]

    def of(self, extra: bytes) -> float:
        """Deviations between the classes' mean savings over what is there now."""
        x, y = self.savings(self.now, self.lengths(extra))
        return float((x.mean() - y.mean()) / np.sqrt(x.var() / len(x) + y.var() / len(y) + 1e-3))

    def tells(self, extra: bytes) -> bool:
        """Whether the classes differ by enough, and in the rate of documents that it tells as well."""
        x, y = (v >= TOLD for v in self.savings(self.now, self.lengths(extra)))
        return x.sum() >= LEAST and x.mean() >= RATIO * (y.sum() + 0.5) / len(y) and self.of(extra) > DEVIATIONS


def _presence(docs: list[list[bytes]]) -> np.ndarray:
    """In how many documents each hashed string of GRAM bytes stands."""
    out = np.zeros(1 << 18, np.int32)
    for d in docs:
        data = np.frombuffer(b" ".join(d), np.uint8)
        if len(data) >= GRAM:
            out[np.unique(Grams.hashes(data))] += 1
    return out


def _grown(segment: bytes, at: int, judge: _Trial) -> tuple[float, bytes]:
    """The string of GRAM bytes at a place of a segment, made longer while that tells more."""
    lo, hi = at, at + GRAM
    best = judge.of(segment[lo:hi])
    if best <= DEVIATIONS / 2:
        return best, segment[lo:hi]
    for step in ((-1, 0), (0, 1)):
        x, y, worse = lo, hi, 0
        while worse < 2 and 0 <= x + step[0] and y + step[1] <= len(segment):
            x, y = x + step[0], y + step[1]
            z = judge.of(segment[x:y])
            if z > best + SLACK:
                lo, hi, best, worse = x, y, z, 0
            else:
                worse += 1
    return best, segment[lo:hi]


def prune(toxic: list[list[bytes]], plain: list[list[bytes]], ordinary: bytes) -> bytes:
    """The pieces of trained toxic dictionaries that tell windows of toxic documents from ordinary ones.

    Each round trains on one half of the toxic documents, those not told yet, and judges on the other half, so a
    piece that only its own documents hold doesn't pass.  Of a trained segment, the string of GRAM bytes whose
    presence differs most is tried first and grown; the gains decide.
    """
    halves = [toxic[::2], toxic[1::2]] if len(toxic) > 3 else [toxic, toxic]
    judges = [_Trial(ordinary, h, plain) for h in halves]
    stands = [_presence(h) for h in (*halves, plain)]
    idle, tried = 0, [set(), set()]
    for r in range(ROUNDS):
        source, judge, mine = judges[r % 2], judges[(r + 1) % 2], (r + 1) % 2
        told = source.savings(source.start, source.now)[0] >= TOLD
        left = [w[a : a + 64] for d, t in zip(halves[r % 2], told, strict=True) if not t for w in d for a in range(0, len(w), 64)]
        content = trained(left, CANDIDATES, SEGMENT) if left else b""
        content = content[-(len(content) // SEGMENT) * SEGMENT :] if len(content) >= SEGMENT else b""
        n, m = len(halves[mine]), len(plain)
        found: dict[bytes, tuple[float, bytes, int]] = {}
        for a in range(0, len(content), SEGMENT):
            segment = content[a : a + SEGMENT]
            h = Grams.hashes(np.frombuffer(segment, np.uint8))
            x, y = stands[mine][h] / n, stands[2][h] / m
            p = (x * n + y * m + 1) / (n + m + 2)
            z = (x - y) / np.sqrt(p * (1 - p) * (1 / n + 1 / m))
            at = int(z.argmax())
            gram = segment[at : at + GRAM]
            if z[at] > DEVIATIONS and gram not in tried[mine] and z[at] > found.get(gram, (0.0,))[0]:
                found[gram] = (float(z[at]), segment, at)
        taken = 0
        for gram, (_, segment, at) in sorted(found.items(), key=lambda f: -f[1][0])[:TRIALS]:
            tried[mine].add(gram)
            z, piece = _grown(segment, at, judge)
            if z > DEVIATIONS and judge.tells(piece):
                taken += 1
                for t in judges:
                    t.keep(piece)
        idle = 0 if taken else idle + 1
        if idle == 3:  # neither half has anything more to tell the other
            break
    return judges[0].kept


def fit_dictionaries(toxic: list[list[bytes]], plain: list[list[bytes]]) -> CompressionModel:
    """A model without calibration from documents given as lists of windows."""
    ordinary = trained([spread(w) for d in plain for w in d], ORDINARY)
    kept = prune(toxic, plain, ordinary)
    return CompressionModel(ordinary, kept, Grams(kept, plain), [])


def calibrate(model: CompressionModel, x: np.ndarray, y: np.ndarray, rate: float | None = None) -> CompressionModel:
    """rate: share of toxic rows in the table, which the sample's isn't."""
    w = logistic(_design(x), y)
    if rate is not None and 0 < rate < 1:
        w[0] += np.log(rate / (1 - rate)) - np.log(max(0.5, (y == 1).sum()) / max(0.5, (y == 0).sum()))
    model.weights = w.tolist()
    return model


def fit(texts: list[str | None], labels: list[int], rate: float | None = None) -> CompressionModel | None:
    """Dictionaries from every second document of a label, calibration from the others; None without both labels."""
    pos, neg = ([t for t, y in zip(texts, labels, strict=True) if y == v] for v in (1, 0))
    if not pos or not neg:
        return None
    cut = lambda docs: [list(windows((t or "").lower().encode()))[:TRAIN_WINDOWS] for t in docs]
    model = fit_dictionaries(cut(pos[::2]), cut(neg[::2]))
    rest = [*(pos[1::2] or pos), *(neg[1::2] or neg)]
    y = np.r_[np.ones(len(pos[1::2] or pos)), np.zeros(len(neg[1::2] or neg))]
    return calibrate(model, model.features(rest), y, rate)


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> CompressionModel | None:
    known = labels.where(~held_out(id_col)).select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").distinct()
    sizes = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    sample = by_hash(known, "doc_id", "y", TRAIN_DOCS).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)))
    # bounded by TRAIN_DOCS rows a label
    rows = docs.select(F.col(id_col).alias("doc_id"), F.lower(F.col(text_col)).alias("text")).where("text <> ''").join(F.broadcast(sample), "doc_id")
    # windows of LENGTH characters, spread over the text, cut in the JVM so that long texts stay there
    spread = F.expr(f"transform(sequence(0, {TRAIN_WINDOWS - 1}), i -> substring(text, cast(i * greatest(0, char_length(text) - {LENGTH}) / {TRAIN_WINDOWS - 1} as int) + 1, {LENGTH}))")
    parts = {(r.y, r.half) for r in sample.select("y", "half").distinct().collect()}
    split = len(parts) == 4  # else there are too few to split: all serve for both
    got = (rows.where("half = 0") if split else rows).select("doc_id", "y", F.array_distinct(spread).alias("ws")).collect()
    of = lambda v: [[w.encode()[:LENGTH] for w in r.ws] for r in sorted(got, key=lambda r: (r.doc_id, r.ws)) if r.y == v]
    toxic, plain = of(1), of(0)
    if not toxic or not plain:
        return None
    model = fit_dictionaries(toxic, plain)
    marks = sorted(with_features(rows.where("half = 1") if split else rows, model).collect())
    if len({r.y for r in marks}) < 2:
        return None
    rate = sizes.get(1, 0) / max(1, sum(sizes.values()))
    return calibrate(model, np.array([r[1:] for r in marks], float), np.array([r.y for r in marks]), rate)


def with_features(rows: DataFrame, model: CompressionModel) -> DataFrame:
    """(y, top, total, n, hits) of rows (y, text)."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            for s in small_batches(pa.Table.from_batches([b]), 1000, "text", 4 << 20):
                x = model.features(s.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([s.column("y").combine_chunks(), *(pa.array(c) for c in x.T)], names=["y", "top", "total", "n", "hits"])

    return rows.select("y", "text").mapInArrow(tidy(run), schema_of(y="int", top="double", total="double", n="double", hits="double"))


def with_toxicity(docs: DataFrame, model: CompressionModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every document."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            for s in small_batches(pa.Table.from_batches([b]), 1000, "text", 4 << 20):
                scores = model.scores(s.column("text").to_pylist()) if model else np.zeros(s.num_rows)
                yield pa.RecordBatch.from_arrays([s.column("doc_id").combine_chunks(), pa.array(scores)], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), schema_of(doc_id="long", score="double"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = with_toxicity(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
