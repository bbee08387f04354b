"""Scalar functions, quality rules, trees, sinks and event state on small values."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import redact, text, values
from millrace.operators import quality, shape, trees, windows
from millrace.sources import captures, sinks


def one(spark, f, *args):
    df = spark.createDataFrame([tuple(args)], ", ".join(f"c{i} {'string' if isinstance(a, (str, type(None))) else 'double' if isinstance(a, float) else 'long'}" for i, a in enumerate(args)))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(args))])).first()[0]


@pytest.mark.parametrize(
    ("f", "arg", "want"),
    [
        (values.compact_number, "1.2K", 1200), (values.compact_number, "3M views", 3_000_000), (values.compact_number, "none", 0), (values.digits_only, "1,234", 1234), (values.digits_only, "12a", None),
        (values.parse_bytes, "1.5MB", 1572864), (values.parse_bytes, "500", 500), (values.parse_bytes, "x", None), (values.format_bytes, 1536, "1.5 KB"), (values.clock, 3725, "1:02:05"), (values.clock, 65, "1:05"),
        (values.months, "3 semesters", 18.0), (values.epoch_date, 86400, "1970-01-02"), (values.epoch_date, None, ""), (values.is_iso_date, "2023-02-29", False), (values.is_iso_date, "2024-02-29", True),
        (values.force_z, "2024-01-01T00:00:00.123", "2024-01-01T00:00:00Z"), (values.relative_token, "posted 3d ago", "3d"), (values.host, "https://u@A.Example.com:8/x", "a.example.com"), (values.path, "http://x/a/b?q", "/a/b"),
        (text.strip_tags, "<p>a &amp;lt; <b>b</b></p>", "a &lt; b"), (text.collapse_space, " a  b ", "a b"), (text.word_count, " a  b ", 2), (text.safe_filename, "a/b c", "a_b_c"),
        (redact.url, "http://u:p@h/?token=abc&x=1", "http://[REDACTED]@h/?token=[REDACTED]&x=1"), (redact.text, "Bearer abc.def password=hunter2 x", "Bearer [REDACTED] password=[REDACTED] x"), (redact.text, '{"token": "s"}', '{"token":"[REDACTED]"}'),
    ],
)
def test_scalars(spark, f, arg, want):
    assert one(spark, f, arg) == want


def test_chunks_cut_at_lines():
    t = "a" * 90 + "\n\n" + "b" * 150
    got = text.chunks_of(t, 100)
    assert "".join(got) == t and got[0].endswith("\n\n") and all(len(c) <= 100 for c in got)
    assert text.chunks_of("", 100) == [""]


def test_markdown():
    page = "<html><body><article><h1>T</h1><p>one <b>two</b> <a href='/x'>three</a></p><ul><li>i</li></ul><script>no</script>" + "<p>" + "word " * 30 + "</p></article><p>outside</p></body></html>"
    md = text.to_markdown(text.main_content(page))
    assert "# T" in md and "one **two** [three](/x)" in md and "- i" in md and "no" not in md.split() and "outside" not in md


def test_quality_and_shape(spark):
    df = spark.createDataFrame([(1, "a", None), (2, " ", 0.0)], "id long, t string, v double")
    e = quality.Expect(row_count=(3, None), columns=["z"], types={"v": "number"}, patterns={"t": "^a$"}, not_empty=["t"], must_be_truthy=["v"])
    got = {(r.rule, r.row_index) for r in quality.failures(df, e, "id").collect()}
    assert got == {("rowCount", None), ("columns", None), ("types", 1), ("patterns", 2), ("notEmpty", 2), ("mustBeTruthy", 1), ("mustBeTruthy", 2)}
    assert quality.check_expect({"row_count": (2, 1), "x": 1}) == ["unknown key x", "row_count: min is over max"]
    assert shape.shape_of({"a": [{"b": None}], "c": "x" * 90}) == {"$": "object", "$.a": "array(1)", "$.a[0]": "object", "$.a[0].b": "null", "$.c": "string(len=90)"}
    nested = spark.createDataFrame([], "a struct<b struct<id string>>").schema
    assert quality.shape_violations(nested) == ["a is 2 deep, at most 1", "nested id a.b.id"]


def test_trees(spark):
    df = spark.createDataFrame([("t", 1, None, False), ("t", 2, 1, False), ("t", 3, 1, True), ("t", 4, 3, False), ("t", 5, 2, False)], "tree string, node int, parent int, gone boolean")
    flat = trees.flatten_forest(df, "tree", "node", "parent", "node", deleted="gone")
    assert [(r.node, r.depth) for r in flat.orderBy("path").collect()] == [(1, 0), (2, 1), (5, 2)]
    pages = spark.createDataFrame([(1, "<div id='a'><p>x<b>y</b></p><br></div>"), (2, None)], "id long, html string")
    got = [(r.id, r.node, r.parent, r.tag, r.text) for r in trees.html_nodes(pages, "id", "html").orderBy("id", "node").collect()]
    assert got == [(1, 0, None, "div", ""), (1, 1, 0, "p", "x"), (1, 2, 1, "b", "y"), (1, 3, 0, "br", "")]
    assert trees.markdown_table([["a", "b"], ["1"], ["x|y", "2"]]).split("\n")[2:] == ["| 1 |  |", "| x\\|y | 2 |"]


def test_span_sessions(spark):
    rows = [("u", float(t)) for t in (0, 10, 20, 35, 100, 130, 131)]
    got = windows.span_sessions(spark.createDataFrame(rows, "u string, at double"), "u", "at", 40.0, 30.0).orderBy("at").collect()
    assert [(r.gap_session, r.part) for r in got] == [(1, 1), (1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 2)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a,"b"', None)], "id int, t string, n string")
    assert sinks.to_csv(df) == 'id,t,n\n1,"a,""b""",\n' and sinks.to_csv(df.limit(0)) == ""
    assert json.loads(sinks.to_json(df)) == [{"id": 1, "t": 'a,"b"', "n": None}]
    assert sinks.to_plain(df) == 'id: 1\nt: a,"b"' and "1 items" in sinks.to_table(df) and sinks.to_markdown(df).startswith("| id | t | n |")
    assert "id: 1" in sinks.to_yaml(df)
    sinks.write_jsonl(spark.createDataFrame([("x y",)], "t string"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first()[0] == '{"t":"x\\u2028y"}'


def test_strict_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n\n{"id": 1}\n')
    with pytest.raises(ValueError, match="repeated"):
        captures.strict_jsonl(spark, str(tmp_path / "a.jsonl"), "id long")


def test_streams(spark, tmp_path):
    from millrace.streaming import buffers

    src = str(tmp_path / "in")
    spark.createDataFrame([("a", i, float(i * 30)) for i in range(10)], "k string, seq long, ts double").write.parquet(src)
    stream = spark.readStream.schema("k string, seq long, ts double").parquet(src)
    buffers.drain(buffers.ring_buffer_stream(stream, "k", "seq", "ts", most=3).writeStream.outputMode("update").format("memory").queryName("ring"))
    assert [tuple(r) for r in spark.table("ring").collect()] == [("a", 3, 9)]
    target = str(tmp_path / "out")
    merge = buffers.upsert_sink(target, "k", "seq")
    merge(spark.createDataFrame([("a", 1), ("a", 2)], "k string, seq long"), 0)
    merge(spark.createDataFrame([("a", 1), ("b", 1)], "k string, seq long"), 1)
    assert sorted(tuple(r) for r in spark.read.parquet(f"{target}/v1").collect()) == [("a", 2), ("b", 1)]


def test_transcripts():
    from millrace.operators import transcripts as tr

    segments = [(0.0, "one"), (5.0, "two."), (6.0, "three"), (40.0, "four"), (45.0, "five"), (75.0, "six"), (76.0, " ")]
    groups = tr.group_sentences(segments)
    assert groups == [(0.0, "one two."), (6.0, "three"), (40.0, "four five"), (75.0, "six")]
    assert tr.merge_sentences([(0.0, "a b c d."), (5.0, "e f g h."), (9.0, "really?"), (10.0, "i j k l.")]) == [(0.0, "a b c d. e f g h."), (9.0, "really?"), (10.0, "i j k l.")]


def test_commands(spark):
    from millrace.plans.hooks import Command, Commands

    seen, c = [], Commands()
    c.register(Command("x/list", lambda s, n: s.range(n), [{"name": "n", "type": "int", "default": 2}], ["id", "gone"]), "xl")
    c.before.append(lambda cmd, args: seen.append((cmd.name, args)))
    assert [tuple(r) for r in c.run(spark, "xl", {"n": "1"}).collect()] == [(0, "")] and seen == [("x/list", {"n": 1})]
    with pytest.raises(ValueError):
        c.register(Command("y", None, [{"name": "a"}, {"name": "a"}]))


def test_sqlite_and_protected(spark, tmp_path):
    import sqlite3

    from millrace.sources import exports

    with sqlite3.connect(tmp_path / "s.db") as db:
        db.execute("CREATE TABLE ItemTable (key TEXT, value BLOB)")
        db.executemany("INSERT INTO ItemTable VALUES (?, ?)", [("b", '{"x":1}'), ("a.1", "t")])
    assert [tuple(r) for r in exports.sqlite_keys(spark, str(tmp_path / "s.db")).collect()] == [("a.1", "t"), ("b", '{"x":1}')]
    assert one(spark, lambda c: redact.protected(c, ["secret answer", "no", "B"]), "secret answer, no notes; answer: B, Bob") == "[REDACTED], [REDACTED] notes; answer: [REDACTED], Bob"
    assert exports.error_envelope("E", "m", "h")["error"] == {"code": "E", "message": "m", "hint": "h"}


def test_markdown_titles_decode_closed_references_only(spark, tmp_path):
    import oracle

    from millrace.plans.catalogue import ORACLE, QUERIES

    ends = ["and&amp", "a&ampb", "&lt", "&amp;lt;", "x &amp; y", "q&quot;&#39;", "1&nbsp;2", "&copy", "a & b"]
    spark.createDataFrame([(i, f"<body><article><h1>Title {x}</h1><p>{'long enough text ' * 9}</p></article></body>") for i, x in enumerate(ends)], "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = oracle.duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    _, got, _, want = oracle.both(spark, con, QUERIES["markdown_titles"], ORACLE["markdown_titles"], str(tmp_path))
    assert got == want and len(got) == len(ends)


def test_islands(spark):
    low, high = -(2**63), 2**63 - 1
    values = [("a", x) for x in (3, 1, 2, 2, 7, None, None, 9, 8, 9, 20)] + [("b", None), (None, 5), (None, 5), (None, 6), ("c", 4), ("d", low), ("d", low + 1), ("d", low), ("d", high), ("d", high - 1), ("d", 0)]
    df = spark.createDataFrame(values, "k string, v long")
    got = {tuple(r) for r in windows.islands(df, ["k"], "v").collect()}
    assert got == {("a", None, None, 1), ("a", 1, 3, 3), ("a", 7, 9, 3), ("a", 20, 20, 1), ("b", None, None, 1), (None, 5, 6, 2), ("c", 4, 4, 1), ("d", low, low + 1, 2), ("d", high - 1, high, 2), ("d", 0, 0, 1)}


def test_islands_take_one_sort_and_no_hash_table(spark):
    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 7).alias("k"), "id")
    plan = windows.islands(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange hashpartitioning") == 1 and "HashAggregate" not in plan


def test_shapes_are_worked_out_a_slice_at_a_time(spark, monkeypatch):
    import json
    import subprocess
    import sys

    import pyarrow as pa

    texts = ['{"a": [1, {"b": null}]}', None, "no json", "[]", '"x"', "{}", "1e400", None] * 200 + ['{"a": {"b": true}}']
    seen, plain = [], shape.json.loads
    monkeypatch.setattr(shape.json, "loads", lambda x: seen.append(x) or plain(x))
    got = shape.shapes_of(pa.array(texts)).to_pylist()
    bad = (None, "no json")
    assert got == [None if x in bad else list(shape.shape_of(plain(x)).items()) for x in texts] and len(seen) == len(texts)
    assert shape.shapes_of(pa.array([], pa.string())).to_pylist() == []
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts[:8])], "id long, js string")
    assert [r.s for r in df.select("id", shape.shape("js").alias("s")).orderBy("id").collect()] == [None if x in bad else shape.shape_of(json.loads(x)) for x in texts[:8]]
    # a worker that only takes shapes needs no pandas
    assert subprocess.run([sys.executable, "-c", "import sys, millrace.operators.shape; sys.exit('pandas' in sys.modules)"]).returncode == 0
