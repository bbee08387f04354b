import hashlib
import random

import pytest

from millrace.llm import decontaminate as dc


@pytest.mark.parametrize("seed", range(40))
def test_automaton_by_brute_force(seed):
    rng = random.Random(seed)
    words = lambda n, letters: " ".join(rng.choice(letters) for _ in range(n))
    items = [(str(k), words(rng.randint(0, 22), "abc")) for k in range(rng.randint(0, 6))]
    texts = [words(rng.randint(0, 50), "abcd") + " " + (rng.choice(items)[1] if items else "") + " " + words(rng.randint(0, 9), "abc") for _ in range(6)]
    a = dc.Automaton([(k, dc.words_of(t.encode())) for k, t in items])
    for t, want in zip(texts, dc.brute_force(texts, items), strict=True):
        spans, found = a.stream(dc.words_of(t.encode()))
        n = sum(q - p for p, q in dc.merged(spans))
        assert (n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()) == want[1:4]


def test_query_by_brute_force(spark, sf):
    out = {r.doc_id: tuple(r)[1:] for r in dc.op5_benchmark_decontamination(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert [out[r.doc_id] for r in docs] == dc.brute_force([r.text for r in docs], items)


def test_many_shards_give_the_same(spark, sf):
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    one = sorted((r.doc_id, tuple(r.spans), tuple(r.items)) for r in dc.with_hits(docs, bench).collect())
    many = sorted((r.doc_id, tuple(r.spans), tuple(r.items)) for r in dc.with_hits(docs, bench, shard_bytes=2000).collect())
    assert one == many


def test_odd_documents(spark, odd_docs, no_docs):
    text = "The same words stand here again and again, in one plain line of prose."
    bench = spark.createDataFrame([("x", text), ("x", text), (None, text), ("y", None), ("z", "!!")], "item_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.items, r.contaminated) for r in dc.contamination(odd_docs, bench).collect()}
    assert got[1] == got[2] == (14, 14, ["x"], True) and got[3] == (0, 0, [], False)
    kept = dc.remove_contamination(odd_docs, bench)
    assert kept.columns == odd_docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "5", "6", "7", "None"]
    assert dc.contamination(no_docs, bench).count() == 0 and dc.contamination(odd_docs, bench.limit(0)).where("contaminated").count() == 0


def test_spans_are_cut(spark):
    item = " ".join(f"q{i}" for i in range(13))
    rest = " ".join(f"w{i}" for i in range(400))
    docs = spark.createDataFrame([(1, f"{rest}. {item}! end", 0)], "doc_id long, text string, n_chars long")
    row = dc.remove_contamination(docs, spark.createDataFrame([("i", item)], "item_id string, text string")).first()
    assert row.text == f"{rest}. ! end" and row.n_chars == len(row.text)


def test_pipeline_walks_small_slices(spark, monkeypatch):
    import corpus_pipeline as cp

    given, item = [], " ".join(f"q{i}" for i in range(13))
    docs = spark.createDataFrame([(i, f"{'w ' * i}{item if i % 3 else ''} end") for i in range(300, 340)], "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([("i", item)], "item_id string, text string")
    found = [sorted(map(str, dc.with_hits(docs, bench, slice_bytes=n).collect())) for n in (500, 1 << 20)]
    assert found[0] == found[1]
    monkeypatch.setattr(dc, "remove_contamination", lambda docs, bench, slice_bytes: given.append(slice_bytes) or docs)
    cp.decontaminate_benchmark(spark, docs, "/root/testdata/sf0.001")
    assert given == [1 << 20]


@pytest.mark.parametrize("shard_bytes", [dc.SHARD_BYTES, 40])
def test_items_without_id(spark, shard_bytes):
    words = [f"item{i}" for i in range(40)]
    bench = spark.createDataFrame([(None, " ".join(words[:20])), (None, " ".join(words[20:])), ("b", "short one"), ("c", None)], "item_id string, text string")
    docs = spark.createDataFrame([(1, " ".join(words[2:17])), (2, "x " + " ".join(words[20:36]) + " short one"), (3, "clean words")], "doc_id long, text string")
    got = {r.doc_id: (list(r["items"]), list(r.spans)) for r in dc.with_hits(docs, bench, shard_bytes=shard_bytes).collect()}
    assert got == {1: ([], [0, 15]), 2: (["b"], [1, 19]), 3: ([], [])}
    assert [r.doc_id for r in dc.remove_contamination(docs, bench).collect()] == [3]


def test_runs_longer_than_a_walk(spark, monkeypatch):
    monkeypatch.setattr(dc, "STEPS", 5)
    rng = random.Random(4)
    items = [("a\nb", " ".join(rng.choices("abc", k=40))), ("short", "a b a"), (None, " ".join(rng.choices("abc", k=16)))]
    named = [(k or dc.NO_ID, dc.words_of(t.encode())) for k, t in items]
    text = " ".join([*rng.choices("abc", k=70), items[0][1], *rng.choices("abc", k=30), items[2][1]])
    spans, found = dc.Automaton(named).stream(dc.words_of(text.encode()))
    want = dc.brute_force([text], [(k or dc.NO_ID, t) for k, t in items])[0]
    assert sum(q - p for p, q in spans) == want[1] and len(found) == want[2] == 3


def test_arrays_in_a_file(tmp_path):
    from millrace.llm import arrays

    made = dc.Automaton([("x", [b"a", b"b", b"a"])]).arrays()
    (tmp_path / "f").write_bytes(b"".join(arrays.dump(made)))
    got = arrays.load(str(tmp_path / "f"))
    assert {k: v.tolist() for k, v in got.items()} == {k: v.tolist() for k, v in made.items()}
