"""Queries over whole tables: all rows and part files, whatever their content."""

import re
from urllib.parse import quote

from millrace.operators import trees
from millrace.plans.catalogue import QUERIES


def test_stream_of_part_files(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    want = sorted((r.event_type, r["count"]) for r in events.dropDuplicates(["event_id"]).groupBy("event_type").count().collect())
    assert sorted((r.event_type, r.n) for r in QUERIES["stream_counts"](spark, str(tmp_path)).collect()) == want


def test_fetch_of_every_line(spark, sf):
    got = QUERIES["fetch_lookup_all"](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/lineitem.parquet").count() and got.where("l_linenumber > 1").count() > 0


def test_encoding_of_every_url(spark, tmp_path):
    urls = ["http://h/a b?x=1&y=%41+z#top", "http://h/é/漢😀", "http://h/!'()*~-_.;,@$[]{}|^`\"<>\\", "", None]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.encoded for r in QUERIES["url_encode_all"](spark, str(tmp_path)).collect()}
    assert got == {i: None if u is None else quote(u, safe="!'()*~-_.") for i, u in enumerate(urls)}


def test_redaction_of_every_text(spark, tmp_path):
    long = "é" * 49_990
    texts = [
        'say "token" : "s3cret", "session":"x y" and "name": "kept"', "Cookie: a=b; c=d\nkept", "set-cookie: xyz", "id eyJhbGciOiJIUzI1.eyJzdWIiOiIxMjM0.c2lnbmF0dXJlMTIz end",
        "Bearer abc password=hunter2;x api_key: k", long + " password=" + "p" * 90, long + " access_token=zz", "plain", "", None,
        "Negotiate YIIabc== and NTLM TlR access_token=abc123 session_id=zzz cookie=abcdef123", "{'password': 'hunter2'} {\"pwd\":\"x1\"}", "eyJhbGci.eyJzdWIi.c2ln",
    ]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.text for r in QUERIES["redact_all_texts"](spark, str(tmp_path)).collect()}
    m = "[REDACTED]"
    cut = lambda s: f"{s[:50_000]}\n...[truncated, {len(s) - 50_000} chars omitted]"
    want = [
        f'say "token":"{m}", "session":"x y" and "name": "kept"', f"Cookie: {m}; c=d\nkept", f"set-cookie: {m}", f"id {m[:-1]}_JWT] end",
        f"Bearer {m} password={m};x api_key={m}", cut(long + f" password={m}"), cut(long + f" access_token={m}"), "plain", "", None,
        f"Negotiate {m} and NTLM {m} access_token={m} session_id={m} cookie={m}", f"{{'password':'{m}'}} {{\"pwd\":\"{m}\"}}", "eyJhbGci.eyJzdWIi.c2ln",
    ]
    assert got == dict(enumerate(want))


def test_nodes_of_deep_and_long_pages(spark):
    page = "<div>" * 60 + "word " * 100 + "</div>" * 60 + "<p>x</p>" * 6000 + "<b>end"
    df = spark.createDataFrame([(1, page)], "id long, html string")
    whole = sorted(trees.html_nodes(df, "id", "html").collect(), key=lambda r: r.node)
    assert [r.tag for r in whole] == re.findall(r"<(\w+)", page)
    assert whole[59].depth == 59 and whole[59].text == ("word " * 100).strip() and whole[-1].text == "end"
    some = trees.html_nodes(df, "id", "html", most_depth=70, most_nodes=100, most_text=10).collect()
    assert len(some) == 100 and {r.cut_nodes for r in some} == {len(whole) - 100}
    assert sum(r.cut_text for r in some) == 499 - 10
    assert [(r.node, r.cut_nodes) for r in trees.html_nodes(df, "id", "html", most_nodes=0).collect()] == [(None, len(whole))]
