import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from millrace.llm import decontaminate as dc
from millrace.llm.common import modest_batches, save
from millrace.llm.tokens import encoder


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = []
    for name, stage in cp.STAGES:
        out = save(stage(spark, docs, sf), name)
        if name != cp.STAGES[-1][0]:
            assert out.columns == docs.columns
        kept.append(docs)
        docs = out
    whole, named, single, clean, mixed = kept
    text = {r.doc_id: r.text for r in whole.collect()}
    assert named.count() == whole.count()  # every document has letters
    assert single.count() == len(set(text.values())) or single.count() < len(set(text.values()))
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    left = {r.doc_id for r in single.collect()}
    judged = {i: b[4] for i, b in zip(sorted(left), dc.brute_force([text[i] for i in sorted(left)], items), strict=True)}
    assert {r.doc_id for r in clean.collect()} == {i for i, bad in judged.items() if not bad}
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in clean.collect())
    # the mix is the stored order, and the last stage encodes in it
    stored = [r.doc_id for r in mixed.orderBy("_metadata.file_name", "_metadata.row_index").select("doc_id").collect()]
    assert [r.doc_id for r in docs.orderBy("start").collect()] == stored
    body = {r.doc_id: r.text for r in mixed.collect()}
    e = encoder()
    n = {r.doc_id: r.n_tokens for r in docs.collect()}
    assert all(n[i] == len(np.frombuffer(e.ids([body[i]])[0], e.dtype)) + 1 for i in body)


def test_run_and_order(spark, sf):
    assert [n for n, _ in cp.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_files"]
    assert cp.run(spark, sf).count() > 0


def test_odd_documents(spark, odd_docs, no_docs, sf):
    for docs in (odd_docs, no_docs):
        now = docs
        for name, stage in cp.STAGES:
            now = save(stage(spark, now, sf), name)
        assert now.columns[:3] == ["doc_id", "start", "n_tokens"]
    assert now.count() == 0


def test_stages_remove_what_the_one_before_made(spark, odd_docs):
    import os

    from millrace.llm import common

    made = []

    @common.stage
    def make(spark, docs, sf_dir):
        made.append(common.local_path(common.shared_folder(spark, "own")))
        os.makedirs(made[-1])
        return save(docs.select("doc_id"), "inner")

    first = save(make(spark, odd_docs, ""), "kept")
    make(spark, odd_docs, "")
    assert os.path.exists(made[0])
    make(spark, first, "")
    assert not os.path.exists(made[0]) and first.count() == 9


def test_stages_compose_without_writing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lazy = cp.drop_near_duplicates(spark, docs, sf)
    then = cp.decontaminate_benchmark(spark, lazy, sf)
    other = cp.identify_language(spark, docs, sf)
    kept = save(lazy, "kept")
    assert then.count() == cp.decontaminate_benchmark(spark, kept, sf).count() and other.count() > kept.count() > 0


def test_a_run_owns_its_tables(spark, sf):
    from concurrent.futures import ThreadPoolExecutor

    from millrace.llm import common

    with ThreadPoolExecutor(2) as pool:
        outs = list(pool.map(lambda _: cp.run(spark, sf), range(2)))
    assert len({tuple(sorted(map(tuple, o.collect()))) for o in outs}) == 1
    assert common._open.get() == () or all(s.folders for s in common._open.get())


def test_clashing_names(spark, odd_docs, sf):
    names = ["_id", "_node", "_own", "position", "_src", "_i", "_j", "_at", "_w", "_row", "_bin", "_cell", "_digest", "_tail", "_hot", "_key", "node", "root", "file", "row", "lang_pred", "a.b"]
    docs = odd_docs.withColumns({c: F.lit(f"own {i}") for i, c in enumerate(names)})
    now = docs
    for name, stage in cp.STAGES[:-1]:
        now = save(stage(spark, now, sf), name)
        assert now.columns == docs.columns
        for i, c in enumerate(names):
            assert now.where(F.col(f"`{c}`") != f"own {i}").isEmpty() and now.where(F.col(f"`{c}`").isNull()).isEmpty(), (name, c)
    assert cp.STAGES[-1][1](spark, now, sf).count() == now.count() > 0


def test_batches_of_stages_stay_within_arrows_pool(spark):
    keys = [f"spark.sql.{k}" for k in ("execution.arrow.maxRecordsPerBatch", "execution.arrow.maxBytesPerBatch", "parquet.columnarReaderBatchSize")]
    own = {k: spark.conf.get(k) for k in keys}

    def sizes(batches):
        for b in batches:
            yield b.from_pydict({"rows": [b.num_rows], "size": [b.nbytes]}, schema=told)

    import pyarrow as pa

    told = pa.schema([("rows", pa.int64()), ("size", pa.int64())])
    try:
        for k in keys:
            spark.conf.unset(k)
        modest_batches(spark)
        found = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 4000) as text").mapInArrow(sizes, "rows long, size long").collect()
        assert sum(r.rows for r in found) == 3000 and max(r.size for r in found) <= 4 << 20
        assert int(spark.conf.get(keys[2])) <= 512
        spark.conf.set(keys[1], "16m")
        modest_batches(spark)
        assert spark.conf.get(keys[1]) == "16m"
    finally:
        for k in keys:
            spark.conf.set(k, own[k])
