import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from millrace.llm import near_copies as nc
from millrace.llm.common import save
from millrace.llm.components import components


def sets(text):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def survivors(rows):
    """One (doc_id, text) of each group of texts at Jaccard 0.8 or more, by all pairs."""
    texts = sorted({t for _, t in rows}, key=str)
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    held = {t: sets(t) for t in texts}
    for k, a in enumerate(texts):
        for b in texts[:k]:
            both = len(held[a] & held[b])
            if 5 * both >= 4 * (len(held[a]) + len(held[b]) - both):
                root[find(a)] = find(b)
    best = {}
    for i, t in rows:
        g = find(t)
        best[g] = min(best.get(g, (True, 0)), (i is None, i or 0))
    return sorted(best.values())


def planted(n=30, size=4, seed=5, line=""):
    """Documents of random words, each with copies in which some words are other ones."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(20, 300))]
        for k in range(size):
            w = list(words)
            for _ in range(k * len(w) // 100):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            out.append((len(out), f"{' '.join(w)} {line}".strip()))
    return out


def stage(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(((r.doc_id is None, r.doc_id or 0) for r in cp.drop_near_duplicates(spark, docs, "").collect()))


@pytest.mark.parametrize("big, hot", [(64, 16), (2, 2)])
def test_planted_near_copies(spark, monkeypatch, big, hot):
    monkeypatch.setattr(nc, "BIG", big)
    monkeypatch.setattr(nc, "HOT", hot)
    monkeypatch.setattr(nc, "SAMPLE", 2)
    rows = planted(line="one very common line that stands in each of these documents") + planted(1, 60, 9)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    want = survivors(rows)
    assert len(want) < len(rows) - 60
    assert stage(spark, rows) == want


def test_stage_on_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((False, r.doc_id) for r in cp.drop_near_duplicates(spark, docs, sf).collect()) == survivors(rows)


def test_simhash_gives_candidates_of_its_own(spark, monkeypatch):
    """With no shingle in common prefixes, what is linked is linked by SimHash alone, and a near fingerprint isn't enough."""
    texts = [t for _, t in planted(12, 1, 8)]
    rows = [(10 * i + k, f"{t} {k}" if k else t) for i, t in enumerate(t + " " + " ".join(f"z{j}" for j in range(100)) for t in texts) for k in range(3)]
    monkeypatch.setattr(nc, "prefix", lambda s, common: s[:0])
    left = stage(spark, rows)
    assert set(survivors(rows)) <= set(left) and len(left) <= 18 and len(survivors(rows)) == 12
    prints = save(nc._prints(spark.createDataFrame([(i, t.encode()) for i, t in rows], "node long, text binary"), []), "prints")
    assert not any(r["keys"] for r in prints.collect())
    words = {r.node: [r[c] % 2**64 for c in nc._FP] for r in prints.collect()}
    near = {(a, b) for a in words for b in words if a < b and any((x ^ y).bit_count() <= nc.NEAR for x in words[a] for y in words[b])}
    root = {r.node: r.root for r in components(nc.by_simhash(prints)).collect()}
    assert near and all(root[a] == root[b] for a, b in near) and set(root) == {i for p in near for i in p}


def test_repeated_and_null_ids(spark):
    a, b, c, d = (t for _, t in planted(4, 1, 3))
    rows = [(1, a), (1, a), (2, a), (2, b), (None, b), (None, c), (None, c), (None, d), (7, d), (8, None), (9, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = cp.drop_near_duplicates(spark, docs, "")
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, a), (2, b), (None, c), (7, d), (8, None)], key=str)
    assert cp.drop_near_duplicates(spark, docs.where(F.lit(False)), "").count() == 0


def test_prefixes_meet():
    rng = np.random.default_rng(1)
    for n in range(1, 60):
        both = rng.integers(0, 2**63, n).astype(np.uint64)
        for more in range(n // 4 + 1):
            a, b = np.unique(both), np.unique(np.r_[both, rng.integers(0, 2**63, more).astype(np.uint64)])
            assert nc.is_near(a, b) and set(nc.prefix(a, both[:2])) & set(nc.prefix(b, both[:2]))


def test_losers_and_families_through_bloom_filters(spark, monkeypatch):
    monkeypatch.setattr(nc, "SMALL", 0)
    monkeypatch.setattr(nc, "BLOCK", 16)
    rows = planted(line="one very common line that stands in each of these documents") + planted(2, 60, 9) + planted(3, 1, 3)
    rows = [(i if i % 9 else None, t) for i, (_, t) in enumerate(rows)] + [(5, rows[0][1]), (6, None)]
    assert stage(spark, rows) == survivors(rows)


@pytest.mark.parametrize("seed", range(6))
def test_links_of_blocks(seed):
    rng = np.random.default_rng(seed)
    base = [rng.integers(0, 2**63, 120).astype(np.uint64) for _ in range(3)]
    def make():
        s = base[rng.integers(3)].copy()
        s[rng.integers(0, 120, rng.integers(0, 22))] = rng.integers(0, 2**63)
        return np.unique(s)
    sets = [make() for _ in range(40)]
    true = {(i, j) for i in range(40) for j in range(i) if nc.is_near(sets[i], sets[j])}
    far = [int(np.bitwise_count(nc.set_fingerprint(sets[i]) ^ nc.set_fingerprint(sets[j])).sum()) for i, j in true]
    assert max(far) <= nc.RADIUS

    def groups(links):
        root = list(range(40))
        for i, j in links:
            root = [root[j] if r == root[i] else r for r in root]
        return [root.index(r) for r in root]

    assert groups(nc.links_within(sets)) == groups(true)
    a, b = list(range(0, 40, 2)), list(range(1, 40, 2))
    both = a + b
    between = [(both[i], both[j]) for i, j in nc.links_between([sets[i] for i in a], [sets[j] for j in b])]
    assert groups(between) == groups({(i, j) for i, j in true if (i - j) % 2})
