import re

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash as sh
from millrace.llm.components import components


def plain(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def classes(fps, radius=2):
    fps = [int(f) for f in fps]
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def near_groups(n=12, size=40, seed=0):
    rng = np.random.default_rng(seed)
    out = set()
    for base in rng.integers(0, 2**63, n).tolist():
        for _ in range(size):
            f = base
            for k in rng.integers(0, 64, rng.integers(0, 4)):
                f ^= 1 << int(k)
            out.add(f)
    return np.array(sorted(out), dtype=np.uint64)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_bit_sliced_distances(radius):
    x = np.random.default_rng(radius).integers(0, 2**63, 1000).astype(np.uint64)
    x[::3] &= np.uint64(0x8041)
    want = np.flatnonzero(np.bitwise_count(x) <= radius)
    assert (sh.within(sh.planes(x), len(x), radius) == want).all()


@pytest.mark.parametrize("bucket", [2048, 8])
def test_links_give_the_components_of_all_pairs(spark, bucket):
    fps = near_groups()
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    roots = {int(np.int64(r.node).view(np.uint64)): int(np.int64(r.root).view(np.uint64)) for r in components(sh.links(df, 2, bucket)).collect()}
    want = classes(fps)
    groups = lambda m: sorted(sorted(f for f in want if m.get(f, f) == r) for r in {m.get(f, f) for f in want})
    assert groups(roots) == groups(want)


def test_components_of_a_long_path(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(7, 7), (500, 501)], "u long, v long")
    got = {r.node: r.root for r in components(path).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500}
    assert components(path.limit(0)).count() == 0


def test_query_by_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    fps = {i: plain(t) for i, t in docs}
    roots = classes(sorted(set(fps.values())))
    low = {}
    for i, f in fps.items():
        low[roots[f]] = min(i, low.get(roots[f], i))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in sh.op9_simhash_near_dups(spark, sf).collect()}
    assert got == {i: (f"{f:016x}", low[roots[f]]) for i, f in fps.items()}


def test_odd_documents(odd_docs, no_docs):
    got = sh.near_duplicates(odd_docs).collect()
    assert len(got) == 9 and {r.component_id for r in got if r.doc_id in (1, 2)} == {1} and {r.component_id for r in got if r.doc_id in (3, 4, 6)} == {3}
    assert sh.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("size", [17, 63, 64, 65, 200, 700])
def test_large_buckets_are_compared_together(monkeypatch, size):
    """Same components as all pairs of each bucket, in a number of comparisons that doesn't grow by one a row."""
    rng = np.random.default_rng(size)
    fps = np.unique(np.concatenate([near_groups(3, size // 5, k) for k in range(8)] + [rng.integers(0, 2**63, 8 * size).astype(np.uint64)]))
    fps = rng.permutation(fps)[: 6 * size]
    group = np.arange(len(fps)) // size
    calls = []
    whole = sh.within
    monkeypatch.setattr(sh, "within", lambda *a, **k: calls.append(1) or whole(*a, **k))
    a, b = sh.bucket_links(group, fps, 3)
    place = {int(f): i for i, f in enumerate(fps)}
    assert all((int(x) ^ int(y)).bit_count() <= 3 and group[place[int(x)]] == group[place[int(y)]] for x, y in zip(a, b, strict=True))
    root = {int(f): int(f) for f in fps}
    for x, y in zip(a, b, strict=True):
        old, new = root[int(x)], root[int(y)]
        assert old != new  # a forest
        root = {k: new if v == old else v for k, v in root.items()}
    for g in range(6):
        own = classes(fps[group == g], 3)
        assert len(set(own.values())) == len({root[f] for f in own}) and all(root[f] == root[r] for f, r in own.items())
    assert len(calls) < 20 + len(fps) * size // 64 // sh.TILE_WORDS * 2
    assert len(a)


def test_search_of_several_arrow_batches(spark, monkeypatch):
    """Buckets that go on in later batches, and tasks that are given less than they wait for, lose no link."""
    monkeypatch.setattr(sh, "ROWS", 50)
    fps = near_groups(20, 60, 4)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "23")
    try:
        roots = {int(np.int64(r.node).view(np.uint64)): int(np.int64(r.root).view(np.uint64)) for r in components(sh.links(df, 3)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = classes(fps, 3)
    groups = lambda m: sorted(sorted(f for f in want if m.get(f, f) == r) for r in {m.get(f, f) for f in want})
    assert groups(roots) == groups(want)
