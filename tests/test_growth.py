"""Plans whose work must grow with the rows: what made them grow faster doesn't come back."""

from pyspark.sql import functions as F

from millrace.functions import redact
from millrace.plans.catalogue import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_redaction_reads_a_text_few_times(spark):
    df = spark.createDataFrame([("token=abc, Bearer xyz",), ("plain",), (None,)], "raw string")
    assert plan(df.select(redact.text(F.col("raw")).alias("t"))).count("raw#") < 20
    assert [r.t for r in df.select(redact.text(F.col("raw")).alias("t")).collect()] == ["token=[REDACTED], Bearer [REDACTED]", "plain", None]


def test_own_aggregate_takes_counted_values(spark, tmp_path):
    rows = [("A", 1.0)] * 3 + [("A", 4.0)] * 3 + [("B", 2.0), ("B", None), ("B", 7.5), ("B", 9.0), ("C", None), (None, 5.0)]
    spark.createDataFrame(rows, "l_returnflag string, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = QUERIES["own_aggregate"](spark, str(tmp_path))
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == {"A": (2.5, 3.0), "B": (7.5, 7.0), "C": (None, None), None: (5.0, 0.0)}
    below = got._jdf.queryExecution().optimizedPlan().toString()
    assert any(x.strip(" +-:").startswith("Aggregate [l_returnflag#") and "l_quantity#" in x.split("]")[0] for x in below.splitlines())


def test_no_sketch_for_every_value(spark, sf):
    lines = [x for x in plan(QUERIES["approximate_distinct"](spark, sf)).splitlines() if "approx_count_distinct" in x]
    assert lines and all("l_orderkey" not in x.split("keys=[")[1].split("]")[0] for x in lines)


def test_span_sessions_make_no_frame_a_session(spark, sf):
    got = plan(QUERIES["span_sessions"](spark, sf))
    assert "MapInArrow" in got and "FlatMapGroups" not in got


def test_elements_are_taken_apart_once(spark, sf):
    for name in ("select_links", "select_counts", "find_links", "main_content"):
        assert "MapInArrow" not in plan(QUERIES[name](spark, sf)), name
