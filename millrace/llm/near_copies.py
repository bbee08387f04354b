"""Near copies by exact Jaccard similarity of word shingles, for the pipeline.

* SimHash candidates: of each set's SimHash of 256 bits every 64-bit word is searched by operator 9's block buckets and
  bit-sliced comparison; texts that have a word within NEAR bits of one another are linked.
* Candidates beyond: with one order of all shingles, two sets at similarity s or more share one of the first
  n - ceil(s n) + 1 shingles of each (prefix filter), so no pair is missed.  The order is by levels of how
  common a shingle is, then by hash.  Levels are Bloom filters of bounded size, filled from a sample: as any
  fixed order will do, what a filter lets in wrongly changes the work only, never the result.
* Fingerprints: a SimHash of each set's shingles drops pairs beyond RADIUS bits.  At similarity 0.8 they differ
  in about 39 of 256 bits, so more than 75 is 6 deviations away, and so is 75 from the 128 of unlike texts; sets
  under FEW shingles are never dropped.
* Families: SimHash links join texts; members of a small group are linked by their candidate pairs, those of a large one to the group's
  smallest member; the components of these links are families, outside of which nobody has a near copy.
* Verification: each text travels to its family once.  All pairs of a family are compared there, by counts of
  common shingles (a product of incidence matrices), and only a spanning forest of the true links comes out.
  A family too large for one task is cut into blocks by set size, and blocks meet two at a time, unless their
  sizes rule the similarity out.

Input cases: null or blank texts are copies of one another; a text under one shingle is one shingle; an empty
table gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import bloom, simhash
from .common import partitions, save, schema_of, small_batches, tidy
from .components import components
from .parsing import mix

SHINGLE = 5
#: Least similarity, as a fraction.
OVER, UNDER = 4, 5
RADIUS, FEW = 75, 64
#: 64-bit words of a fingerprint.
WIDE = 4
#: Bits that words of near fingerprints differ in at most, and fingerprints of a bucket that is searched whole.
NEAR, NEAR_BUCKET = 3, 2048
#: Groups above BIG give no pairs; levels start at HOT / 8, HOT / 4, ... 8 HOT of one in SAMPLE texts.
BIG, SAMPLE, HOT = 64, 16, 16
LEVELS = (0.125, 0.5, 1, 2, 8)
#: Texts, and shingles, of a block.
BLOCK, BLOCK_SHINGLES = 2048, 2_000_000
#: Shingles counted in one matrix product.
COLUMNS = 2048
#: Bytes of texts whose shingles a worker has at a time.
SLICE_BYTES = 2 << 20
#: Rows that are broadcast rather than met through a Bloom filter: some hundred kilobytes.
SMALL = 4_000


_SALT = np.array([0, *mix(np.arange(1, WIDE, dtype=np.uint64))], np.uint64)


def text_hash(text_col: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary")))


def shingles(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    from xxhash import xxh64_intdigest as h64

    words = text.lower().split() if text else []
    if len(words) < shingle:
        return np.array([h64(b" ".join(words), 42)] if words else [], dtype=np.uint64)
    return np.unique(np.array([h64(b" ".join(x), 42) for x in zip(*(words[i:] for i in range(shingle)), strict=False)], dtype=np.uint64))


def is_near(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return UNDER * both >= OVER * (len(a) + len(b) - both)


def prefix(s: np.ndarray, common: np.ndarray | list[np.ndarray]) -> np.ndarray:
    """The shingles of which similar sets share one; an empty set has the key 0.

    common: shingles that come last, or fields of Bloom filters, each of shingles later than the one before.
    """
    n = len(s)
    if not n:
        return np.zeros(1, dtype=np.uint64)
    if isinstance(common, list):
        level = sum((bloom.contains(f, s).astype(np.int8) for f in common), np.zeros(n, np.int8))
        s = s[np.argsort(level, kind="stable")]
    elif len(common):
        late = np.isin(s, common, assume_unique=True)
        s = np.concatenate([s[~late], s[late]])
    return s[: n + (-OVER * n // UNDER) + 1]


def set_fingerprint(s: np.ndarray) -> np.ndarray:
    """Majority bits of a set's hashes and of hashes made from them: WIDE words."""
    if not len(s):
        return np.zeros(WIDE, np.uint64)
    ones = np.zeros(64 * WIDE, np.int64)
    for lo in range(0, len(s), 1 << 16):
        part = s[lo : lo + (1 << 16), None] ^ _SALT
        part[:, 1:] = mix(part[:, 1:])
        ones += np.unpackbits(part.astype(">u8").view(np.uint8), axis=1).sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > len(s)).view(">u8").astype(np.uint64)


_FP = [f"f{i}" for i in range(WIDE)]


def _prints(texts: DataFrame, levels: list[str], whole: bool = False) -> DataFrame:
    """(node, n, f0, f1, ..., keys) of texts (node, text); levels: Bloom filters of common shingles; whole: keys are all shingles."""
    import pyarrow as pa

    def run(batches):
        common = [bloom.read(u) for u in levels]
        for b in batches:
            for part in small_batches(pa.Table.from_batches([b]), 2000, "text", SLICE_BYTES):
                sets = [shingles(t) for t in part.column("text").to_pylist()]
                keys = sets if whole else [prefix(s, common) for s in sets]
                flat = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
                fps = np.array([set_fingerprint(s) if not whole else np.zeros(WIDE, np.uint64) for s in sets], np.uint64).reshape(-1, WIDE).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node").combine_chunks(), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(np.ascontiguousarray(fps[:, i])) for i in range(WIDE)),
                     pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(flat))],
                    names=["node", "n", *_FP, "keys"],
                )

    return texts.mapInArrow(tidy(run), f"node long, n long, {', '.join(f'{c} long' for c in _FP)}, keys array<bigint>")


def _like(a: str, b: str) -> Column:
    """Sizes allow the similarity, and fingerprints are within the radius."""
    sizes = f"{UNDER} * least({a}n, {b}n) >= {OVER} * greatest({a}n, {b}n)"
    apart = " + ".join(f"bit_count({a}{c} ^ {b}{c})" for c in _FP)
    return F.expr(f"{sizes} and (least({a}n, {b}n) < {FEW} or {apart} <= {RADIUS})")


# ---------------------------------------------------------------- comparison inside a task


def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Numbers of common shingles of each set of a with each of b, over the shingles that both sides have."""
    out = np.zeros((len(a), len(b)), np.float32)
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(flat_a, flat_b)
    if a is b:  # a shingle of one set only is in no intersection but its own set's
        values, times = np.unique(flat_a, return_counts=True)
        shared = values[times > 1]
    sides = []
    for sets, flat in ((a, flat_a), (b, flat_b)):
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.searchsorted(shared, flat)
        ok = at < len(shared)
        ok[ok] = shared[at[ok]] == flat[ok]
        order = np.argsort(at[ok], kind="stable")
        sides.append((at[ok][order], row[ok][order]))
    for lo in range(0, len(shared), COLUMNS):
        grids = []
        for (at, row), n in zip(sides, out.shape, strict=True):
            x, y = np.searchsorted(at, [lo, lo + COLUMNS])
            grid = np.zeros((n, min(COLUMNS, len(shared) - lo)), np.float32)
            grid[row[x:y], at[x:y] - lo] = 1
            grids.append(grid)
        out += grids[0] @ grids[1].T
    return out


def near_pairs(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Whether each set of a is a near copy of each of b, which may be the same list."""
    na, nb = (np.array([len(x) for x in s], np.int64) for s in (a, b))
    both = _common(a, b)
    if a is b:
        np.fill_diagonal(both, na)
    return (UNDER * both >= OVER * (na[:, None] + nb[None, :] - both))


def _stars(near: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what a symmetric matrix joins: each row with the first row of its component."""
    left, out = np.ones(len(near), bool), []
    for i in range(len(near)):
        if left[i]:
            reach, now = np.zeros(len(near), bool), np.array([i])
            reach[i] = True
            while len(now):
                new = near[now].any(0) & ~reach
                reach |= new
                now = np.flatnonzero(new)
            left &= ~reach
            out += [(i, int(j)) for j in np.flatnonzero(reach) if j != i]
    return out


def links_within(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the near copies among some sets."""
    if len(sets) > 3:
        return _stars(near_pairs(sets, sets))
    root, out = list(range(len(sets))), []
    for i, a in enumerate(sets):
        for j in range(i):
            if root[i] != root[j] and is_near(a, sets[j]):
                root = [root[j] if r == root[i] else r for r in root]
                out.append((j, i))
    return out


def links_between(a: list[np.ndarray], b: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join what near copies between two blocks join; positions count through a, then b."""
    near, n = near_pairs(a, b), len(a)
    whole = np.zeros((n + len(b),) * 2, bool)
    whole[:n, n:], whole[n:, :n] = near, near.T
    return _stars(whole)


# ---------------------------------------------------------------- families


def without(rows: DataFrame, gone: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose keys (null equals null) aren't in gone, a saved table of keys; few rows are shuffled for it."""
    same = lambda a, b: [a[c].eqNullSafe(b[c]) for c in on]
    n = gone.count()
    if n <= SMALL:
        small = F.broadcast(gone)
        return rows.join(small, same(rows, small), "left_anti")
    clear, suspects = bloom.split(rows, gone, on, n)
    return clear.unionByName(suspects.join(gone, same(suspects, gone), "left_anti"))


def by_simhash(prints: DataFrame) -> DataFrame:
    """Links (u, v) of texts whose fingerprints have a word within NEAR bits of one another; prints: node and the words.

    Words of equal value hang on the smallest node that has it; of others, operator 9's search gives a spanning forest.
    """
    each = prints.select("node", F.explode(F.array_distinct(F.array(*_FP))).alias("fp"))
    words = save(each.groupBy("fp").agg(F.min("node").alias("low"), F.count("*").alias("k")), "words")
    same = each.join(words.where("k > 1"), "fp").where("node <> low").select(F.col("low").alias("u"), F.col("node").alias("v"))
    near = save(simhash.links(words.select("fp"), NEAR, NEAR_BUCKET), "alike")
    for end in "uv":
        near = near.join(words.select(F.col("fp").alias(end), F.col("low").alias(f"{end}_low")), end)
    return same.union(near.selectExpr("u_low as u", "v_low as v"))


def _families(texts: DataFrame) -> DataFrame:
    """(node, family, n): texts that may have near copies, all of them in the same family."""
    sample = texts.where(F.pmod(F.col("node"), F.lit(SAMPLE)) == 0)
    seen = _prints(sample, [], whole=True).select(F.explode("keys").alias("key"))
    common = save(seen.groupBy("key").count().where(F.col("count") >= max(2, HOT * LEVELS[0])), "common")
    levels = []
    for part in LEVELS:
        level = common.where(F.col("count") >= max(2, HOT * part)).select("key")
        if (n := level.count()) or not levels:
            levels.append(bloom.build(level, n))
    prints = save(_prints(texts, levels), "prints")
    alike = save(by_simhash(prints), "alike-texts")
    keyed = prints.select(F.explode("keys").alias("key"), "node", "n", *_FP)
    sizes = save(keyed.groupBy("key").agg(F.count("*").alias("k"), F.min("node").alias("low")).where("k > 1"), "sizes")
    # most keys stand alone: a filter of the others spares them the shuffle
    repeated = bloom.may_hold(bloom.build(sizes.select("key"), sizes.count()))
    members = save(keyed.where(repeated("key")).join(sizes, "key"), "members")
    few = members.where(F.col("k") <= BIG)
    pairs = few.alias("a").join(few.alias("b"), F.expr("a.key = b.key and a.node < b.node") & _like("a.", "b.")).selectExpr("a.node as u", "b.node as v")
    stars = members.where((F.col("k") > BIG) & (F.col("node") != F.col("low"))).select(F.col("low").alias("u"), F.col("node").alias("v"))
    found = components(alike.union(pairs).union(stars)).distinct()
    return save(found.select("node", F.col("root").alias("family")).join(prints.select("node", "n"), "node"), "families")


def _blocks(placed: DataFrame) -> DataFrame:
    """(node, family, n, block): blocks of about BLOCK texts and BLOCK_SHINGLES shingles, in order of set size.

    Counts of (family, size, hash digit) are summed up in order, so no family is sorted in one task.
    """
    keyed = placed.withColumn("digit", F.pmod(F.xxhash64("node"), F.lit(256)))
    weight = F.greatest(F.lit(1.0 / BLOCK), F.col("n") / F.lit(float(BLOCK_SHINGLES)))
    cells = keyed.groupBy("family", "n", "digit").agg(F.sum(weight).alias("w"))
    before = Window.partitionBy("family").orderBy("n", "digit").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("family", "n", "digit", F.floor(F.coalesce(F.sum("w").over(before), F.lit(0.0))).cast("int").alias("block"))
    return keyed.join(cells, ["family", "n", "digit"]).select("node", "family", "n", "block")


def _by_group(rows: DataFrame, group: str, compare) -> DataFrame:
    """Links (u, v) that compare(nodes, sets, sides) finds in each group of (group, side, node, text)."""
    import pyarrow as pa

    def run(batches):
        now, nodes, sets, sides = None, [], [], []
        us, vs = [], []

        def done():
            for i, j in compare(nodes, sets, sides) if len(nodes) > 1 else ():
                us.append(min(nodes[i], nodes[j]))
                vs.append(max(nodes[i], nodes[j]))

        for b in batches:
            for g, side, node, text in zip(*(b.column(c).to_pylist() for c in (group, "side", "node", "text")), strict=True):
                if g != now:
                    done()
                    now, nodes, sets, sides = g, [], [], []
                    if len(us) > 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
                        us, vs = [], []
                nodes.append(node)
                sets.append(shingles(text))
                sides.append(side)
        done()
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    dealt = rows.repartition(partitions(rows.sparkSession), group).sortWithinPartitions(group)
    return dealt.select(group, "side", "node", "text").mapInArrow(tidy(run), schema_of(u="long", v="long"))


def _one_family(nodes, sets, sides) -> list[tuple[int, int]]:
    return links_within(sets)


def _two_blocks(nodes, sets, sides) -> list[tuple[int, int]]:
    a, b = ([i for i, s in enumerate(sides) if s == k] for k in (0, 1))
    if not b:  # a block with itself
        return links_within(sets)
    if not a:
        return []
    both = a + b
    return [(both[i], both[j]) for i, j in links_between([sets[i] for i in a], [sets[j] for j in b])]


def _texts_of(texts: DataFrame, placed: DataFrame) -> DataFrame:
    """Texts with the columns of their rows in placed (node, ...); others aren't shuffled, but for a Bloom filter's errors."""
    n = placed.count()
    if n <= SMALL:
        return texts.join(F.broadcast(placed), "node")
    return bloom.split(texts, placed.select("node"), ["node"], n)[1].join(placed, "node")


def near_copies(texts: DataFrame) -> DataFrame:
    """Texts (node long, text binary; a node once) to rows (node, root) of all texts with near copies."""
    placed = _families(texts)
    sizes = placed.groupBy("family").agg(F.count("*").alias("k"), F.sum("n").alias("w"))
    large = save(sizes.where((F.col("k") > BLOCK) | (F.col("w") > BLOCK_SHINGLES)).select("family"), "large")
    small = save(placed.join(large, "family", "left_anti").select("node", "family"), "small")
    links = _by_group(_texts_of(texts, small).withColumn("side", F.lit(0)), "family", _one_family)
    if not large.isEmpty():
        blocks = save(_blocks(placed.join(large, "family")), "blocks")
        spans = blocks.groupBy("family", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
        a, b = (spans.select("family", *[F.col(c).alias(f"{c}{k}") for c in ("block", "least", "most")]) for k in "ab")
        meet = a.join(b, "family").where(f"blocka <= blockb and {UNDER} * mosta >= {OVER} * leastb")
        meet = save(meet.select("family", "blocka", "blockb", F.concat_ws(":", "family", "blocka", "blockb").alias("meeting")), "meetings")
        sent = meet.select("family", F.col("blocka").alias("block"), "meeting", F.lit(0).alias("side")).union(meet.where("blocka < blockb").select("family", "blockb", "meeting", F.lit(1)))
        rows = _texts_of(texts, blocks.select("node", "family", "block")).join(sent, ["family", "block"])
        links = links.union(_by_group(rows, "meeting", _two_blocks))
    return components(links)
