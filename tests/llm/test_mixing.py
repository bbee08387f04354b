import oracle
from pyspark.sql import functions as F

from millrace.llm import mixing as mx


def test_matches_sql(spark, duck, sf):
    got_cols, got, want_cols, want = oracle.both(spark, duck, mx.op3_mix_sources, mx.ORACLE_SQL, sf)
    assert got_cols == want_cols and got == want


def test_deviation_is_under_one_block(spark):
    sizes = {"a": 600, "b": 300, "c": 150, "d": 40}
    docs = spark.createDataFrame([(i, s) for s, n in sizes.items() for i in range(ord(s) * 1000, ord(s) * 1000 + n)], "doc_id long, source string")
    weights = {"a": 0.5, "b": 0.3, "c": 0.15, "d": 0.05}
    rows = mx.mix_sources(docs, weights, cycle=100).orderBy("slot").collect()
    assert [r.position for r in rows] == list(range(len(rows))) and len({r.doc_id for r in rows}) == sum(sizes.values())
    share = {s: sum(1 for r in rows if r.source == s and r.slot < 100) / 100 for s in sizes}
    first_gone = min(max(r.slot for r in rows if r.source == s) for s in sizes)
    seen = dict.fromkeys(sizes, 0)
    for r in rows:
        if r.slot > first_gone:
            break
        seen[r.source] += 1
        assert r.release <= r.slot < r.deadline
        assert all(abs(seen[s] - share[s] * (r.slot + 1)) < 1 + 1e-9 for s in sizes)
    assert all(abs(share[s] - weights[s]) < 0.03 for s in sizes)


def test_cells_of_one_id_are_cut_without_changing_the_order(spark):
    rows = [(i if i % 3 else None, "ab"[i % 2], f"t{i}") for i in range(300)] + [(7, "a", "same")] * 4
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    one, many = (sorted(tuple(r) for r in mx.mix_sources(docs, hot_cell=h).select("position", "slot", "source", "text").collect()) for h in (mx.HOT_CELL, 2))
    assert one == many and [r[0] for r in one] == list(range(304))


def test_no_python_on_executors(spark, sf):
    plan = mx.op3_mix_sources(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_odd_documents(odd_docs, no_docs):
    out = mx.mix_sources(odd_docs.withColumn("slot", F.lit("clash")), block=2)
    assert out.count() == 9 and [r.position for r in out.orderBy("position").collect()] == list(range(9))
    assert dict(out.dtypes)["slot"] == "bigint" and mx.mix_sources(no_docs).count() == 0
