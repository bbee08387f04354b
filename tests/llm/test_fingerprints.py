import collections
import hashlib

import numpy as np

from millrace.llm import fingerprints as fp


def test_entropy_levels_match_counting():
    x = np.random.default_rng(0).integers(97, 104, 400).astype(np.uint8)
    for i, e in enumerate(fp.entropies(x)):
        cost = sum(int(fp._COST[c]) for c in collections.Counter(x[i : i + fp.WINDOW].tolist()).values())
        assert e == 1000 - cost * 1000 // int(fp._COST[fp.WINDOW])


def test_equal_texts_equal_digests_whatever_is_beside_them():
    rank = fp.rarity(np.arange(fp.LEVELS)[::-1])
    a, b = (b"a quite plain text, number %d, " * 9 % tuple(range(9)), b"another text altogether " * 40)
    alone, beside = fp.digest([a], rank)[0], fp.digest([b, b"", a, b"x"], rank)
    assert (alone == beside[2]).all() and fp.likeness(alone, beside[2]) == 1.0
    assert fp.likeness(beside[1], beside[1]) == 1.0 and fp.likeness(beside[1], alone) == 0.0
    assert (fp.from_text(fp.as_text(alone)) == alone).all()


def expected(docs):
    """doc_id -> (n_chars, sha of the edited text), by a plain loop."""
    order = sorted(docs, key=lambda d: (-(d[0] if d[0] is not None else -(2**63)), d[1] or ""))
    out = []
    for k, (i, t) in enumerate(order):
        t, u = t or "", order[(k + 1) % len(order)][1] or ""
        h = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[: len(t) - h] + u[:h]).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_neighbours_by_brute_force(spark, odd_docs, no_docs):
    got = fp.with_fingerprints(odd_docs).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == expected([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert fp.with_fingerprints(no_docs).count() == 0
    one = fp.with_fingerprints(odd_docs.where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_query(spark, sf):
    out = fp.op2_document_fingerprints(spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    assert sorted(zip(out.doc_id.tolist(), out.n_chars.tolist(), out.edited_sha256, strict=True), key=repr) == expected(list(zip(docs.doc_id.tolist(), docs.text, strict=True)))
    assert (out.near_edited > out.near_next).mean() > 0.9 and out.near_edited.between(0, 1).all()
    same = docs.merge(out, on="doc_id").groupby("text").fingerprint.nunique()
    assert same.max() == 1


def plain_digest(text, rank):
    """The digest by its rules, feature by feature: the places selected and the bits set, filter by filter."""
    t = text.ljust(fp.WINDOW, b"\0") if text else b""
    n = max(0, len(t) - fp.WINDOW + 1)
    levels = [int(rank[int(fp.entropies(np.frombuffer(t[i : i + fp.WINDOW], np.uint8))[0])]) for i in range(n)]
    votes = collections.Counter(min(range(i, min(n, i + fp.NEAR)), key=lambda j: (levels[j], j)) for i in range(n))
    places = [i for i in range(n) if votes[i] >= fp.VOTES] or ([max(range(n), key=lambda i: (votes[i], -i))] if n else [])
    mask = (1 << 64) - 1

    def mix(h):
        for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            h = (h ^ (h >> 33)) * m & mask
        return h ^ (h >> 33)

    filters = [set() for _ in range(max(1, -(-len(places) // fp.FEATURES)))]
    for k, i in enumerate(places):
        h = 0
        for c in range(fp.WINDOW // 8):
            h = mix(h ^ int.from_bytes(t[i + 8 * c : i + 8 * c + 8], "little") ^ (c + 1))
        g = mix(h) | 1
        filters[k // fp.FEATURES] |= {(h + p * g & mask) >> 53 for p in range(fp.PROBES)}
    return places, filters


def plain_likeness(a, b):
    a, b = sorted((a, b), key=len)
    if not any(a) or not any(b):
        return float(not any(a) and not any(b))
    best = []
    for f in a:
        one = []
        for g in b:
            chance = len(f) * len(g) / fp.FILTER_BITS
            room = min(len(f), len(g)) - chance
            one.append(min(1.0, max(0.0, (len(f & g) - chance) / max(room, 1e-9))))
        best.append(max(one))
    return sum(best) / len(a)


def bits_of(chain):
    return [{int(i) for i in np.flatnonzero(np.unpackbits(row.view(np.uint8)))} for row in chain]


def test_digest_and_likeness_by_plain_rules(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(fp, "FEATURES", 12)
    words = [bytes(rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8)) for _ in range(60)]
    draw = lambda n: b" ".join(words[i] for i in rng.integers(0, 60, n))
    texts = [b"", b"short", draw(6), draw(40), draw(120), b"aaaaaaaa" * 20, draw(90) + "grüße 漢字".encode() * 5]
    rank = fp.rarity(fp.level_counts(texts))
    got = fp.digest(texts, rank)
    plain = [plain_digest(t, rank)[1] for t in texts]
    assert [bits_of(g) for g in got] == plain
    for i in range(len(texts)):
        for j in range(len(texts)):
            if len(plain[i]) != len(plain[j]) or i == j:
                assert abs(fp.likeness(got[i], got[j]) - plain_likeness(plain[i], plain[j])) < 1e-12
    monkeypatch.setattr(fp, "PIECE", 64)  # all but the shortest are worked on in pieces
    assert [bits_of(g) for g in fp.digest(texts, rank)] == plain
    assert (fp.level_counts(texts) == sum(np.bincount(fp.entropies(np.frombuffer(t.ljust(fp.WINDOW, b"\0"), np.uint8)), minlength=fp.LEVELS) for t in texts if t)).all()
