import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import parsing
from millrace.llm import repeats as rp


def corpus(seed, n=120):
    rng = random.Random(seed)
    shared = ["".join(rng.choices("abcdefgh é", k=rng.randint(90, 400))) for _ in range(10)]
    docs = []
    for i in range(n):
        t = ""
        for _ in range(rng.randint(0, 5)):
            t += rng.choice(shared) if rng.random() < 0.6 else "".join(rng.choices("abcdefgh", k=rng.randint(0, 150)))
            t += "-" * rng.randint(50, 300) if rng.random() < 0.2 else ""
            t = t[rng.randint(0, len(t)) :] if rng.random() < 0.3 else t
        docs.append((i * 3, t if i % 17 else None))
    return docs


def test_equal_windows_have_equal_triggers():
    rng = np.random.default_rng(0)
    same = rng.integers(0, 256, 150).astype(np.uint8)
    offsets = []
    for k in range(5):
        data = np.concatenate([rng.integers(0, 256, 200 + k).astype(np.uint8), same, rng.integers(0, 256, 300).astype(np.uint8)])
        trigger, first, last = parsing.phrases(np.zeros(1, np.int64), parsing.Hashes(data).sliding(parsing.W), len(data))
        assert first[0] == 0 and last[-1] == len(data) - parsing.SIZE and (first[1:] == last[:-1] + 1).all()
        at = np.repeat(trigger, last - first + 1)[200 + k : 200 + k + 51]
        offsets.append((at - 200 - k).tolist())
    assert all(o == offsets[0] for o in offsets)


@pytest.mark.parametrize(("seed", "hot"), [(0, rp.HOT), (1, 3)])
def test_brute_force(spark, seed, hot):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in rp.remove_repeats(df, hot=hot).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect())
    assert got == rp.brute_force(docs)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(rp, "MOST", 2048)
    rng = random.Random(5)
    block = "".join(rng.choices("abcdef", k=700))
    docs = [(1, "".join(rng.choices("abcdef", k=3000)) + block + "x" * 400 + block), (2, "y" + block * 3)]
    got = list(rp._parsed(iter(spark.createDataFrame([(k, t.encode()) for k, t in docs], "key long, text binary").toArrow().to_batches())))
    assert len(got) > 3  # long texts were cut
    places = [(int(k), int(a) + j) for _, key, at, _, n, _, _, _ in got for k, a, m in zip(key, at, n, strict=True) for j in range(int(m))]
    assert len(places) == len(set(places)) == sum(len(t) - 99 for _, t in docs)


def test_query_by_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in rp.op10_suffix_array_dedup(spark, sf).collect()) == rp.brute_force(docs)


def test_odd_documents(odd_docs, no_docs):
    got = rp.remove_repeats(odd_docs).collect()
    assert len(got) == 9 and {r.n_removed for r in got if r.doc_id != 5} == {0}
    assert next(r for r in got if r.doc_id == 5).n_removed > 0 and rp.remove_repeats(no_docs).count() == 0


def test_rows_that_share_an_id(spark):
    rng = random.Random(9)
    block, other = ("".join(rng.choices("abcdefgh", k=700)) for _ in range(2))
    docs = [(1, "x" * 50 + block), (1, "short"), (2, block[100:]), (2, other), (2, other), (None, block[:300]), (None, other + block), (None, None), (3, other[:250]), (None, "")]
    docs += [(None, "".join(rng.choices("abcdefgh", k=rng.randint(0, 400))) + other[: rng.randint(0, 500)]) for _ in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = sorted((tuple(r) for r in rp.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()), key=repr)
    assert got == sorted(rp.brute_force(docs), key=repr)
    assert sum(r[2] for r in got) > 2000


def test_parse_rank_decides_between_equal_suffixes():
    rng = random.Random(3)
    same = "".join(rng.choices("abcdefgh", k=130)).encode()
    texts = [b"q" * 20 + same, same + b"z", same]
    which, window = rp._suffix_repeats(np.array([7, 2, 7]), np.array([0, 50, 900]), texts)
    got = {(int(i), int(w)) for i, w in zip(which, window, strict=True)}
    assert got == {(0, 20 + w) for w in range(31)} | {(2, w) for w in range(31)}
