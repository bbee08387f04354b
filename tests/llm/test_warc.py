import oracle

from millrace.llm import warc


def test_matches_sql(spark, duck, sf):
    got_cols, got, want_cols, want = oracle.both(spark, duck, warc.op8_warc_archive, warc.ORACLE_SQL, sf)
    assert got_cols == want_cols and got == want


def test_surt():
    assert warc.surt("HTTP://www.Example.com:8080/a?b#c") == "com,example,www:8080)/a?b" and warc.surt(None) == ")" and warc.surt("http://[bad") == ")http://[bad"


def test_lookups_and_odd_pages(spark):
    big = "<p>" + "x" * 200
    rows = [(i, f"http://h{i % 3}.example.com/{i}", big if i % 5 == 0 else f"<p>{i}") for i in range(700)]
    rows += [(800, None, None), (801, "bad url", ""), (None, "http://n.example.com/", big), (0, "http://h0.example.com/0", big), (802, "http://x.example.com/\r\nX: y", "é" * 70)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    folder, parts = warc.write_warc(pages)
    out = warc.read_warc(spark, folder, parts).collect()
    assert len(out) == len(rows)
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in out}
    assert kinds[None] == ("response", None) and kinds[5] == ("revisit", None) and kinds[1] == ("response", None)
    assert {r.page_id: r.payload_bytes for r in out}[802] == 140
    index = warc.CaptureIndex(folder, parts)
    for i, url, html in rows[:700:29]:
        found = [index.read(c) for c in index.captures(url)]
        assert any(h["WARC-Record-ID"] == f"<urn:x-page:{i}>" and (p is None or p == html.encode()) for h, p in found)
    assert index.captures("http://absent.example.com/") == []
    assert len(index.captures(None)) == 1
    folder, parts = warc.write_warc(pages.limit(0))
    assert warc.read_warc(spark, folder, parts).count() == 0


def test_clashing_columns_and_many_revisits(spark, monkeypatch):
    monkeypatch.setattr(warc, "SMALL", 0)
    rows = [(i, f"http://h{i % 7}.example.com/{i}", "y" * 150 if i % 3 else f"<p>{i}" + "z" * 120, "k", 1, "d", None) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, key string, refers_to int, digest string, surt string").repartition(3)
    folder, parts = warc.write_warc(pages)
    out = {r.page_id: r for r in warc.read_warc(spark, folder, parts).collect()}
    assert len(out) == 200 and out[1].refers_to is None and all(out[i].refers_to == 1 and out[i].record_type == "revisit" for i in range(2, 200) if i % 3)
    assert all(out[i].record_type == "response" and out[i].payload_bytes == len(rows[i][2]) for i in range(0, 200, 3))
