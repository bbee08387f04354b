"""The paged data source: web and folder, batch and stream, two-phase commit, stops and restarts."""

import json
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from millrace.sources import paged, store


@pytest.fixture(scope="module")
def web():
    """Pages of 7 of 100 items; each page fails once with a reset, and all requests are counted."""
    seen = Counter()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            q = parse_qs(urlsplit(self.path).query)
            offset = int(q["page"][0]) * 7 if "page" in q else int(q["offset"][0])
            seen[offset // 7] += 1
            if seen[offset // 7] == 1 and "flaky" in self.path:
                self.connection.close()
                return
            body = json.dumps({"data": {"rows": [{"id": i, "name": f"é {i}"} for i in range(offset, min(offset + 7, 100))]}, "meta": {"total": 100}}).encode()
            self.send_response(200)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", seen
    server.shutdown()


def load(spark, url, **options):
    paged.register(spark)
    return spark.read.format("paged").options(url=url, items="data.rows", size=7, allow_private="true", pause_s=0.01, pages_per_task=3, **options).load()


def ids(df):
    return sorted(r.id for r in df.select(F.get_json_object("item", "$.id").cast("int").alias("id")).collect())


@pytest.mark.parametrize("options", [{}, {"total": "meta.total"}, {"pages": 15}])
def test_web_pages(spark, web, options):
    url, seen = web
    df = load(spark, f"{url}/flaky?offset={{offset}}", **options)
    assert ids(df) == list(range(100)) and df.rdd.getNumPartitions() == 5
    assert df.where("place = 1 and page = 2").first().item == '{"id": 15, "name": "é 15"}'


def test_filters_reach_the_plan(spark, web):
    url, seen = web
    seen.clear()
    df = load(spark, f"{url}/?page={{page}}", pages=15).where("page >= 4 and page < 6")
    assert ids(df) == list(range(28, 42)) and set(seen) == {4, 5}
    seen.clear()
    assert ids(load(spark, f"{url}/?page={{page}}", pages=15).where("page in (0, 14, 99) and place > 0")) == [1, 2, 3, 4, 5, 6, 99] and set(seen) == {0, 14}
    assert ids(load(spark, f"{url}/?page={{page}}", pages=15).where("page > 40")) == []


def test_errors_are_raised(spark, web):
    with pytest.raises(Exception, match="private address"):
        paged.register(spark).read.format("paged").option("url", f"{web[0]}/?page={{page}}").option("pages", 1).option("retries", 0).load().collect()
    with pytest.raises(Exception, match="either"):
        spark.read.format("paged").load().collect()


def items(df):
    return sorted(r.item for r in df.select("item").collect())


def test_writing_commits_or_leaves_nothing(spark, tmp_path):
    paged.register(spark)
    folder = f"file://{tmp_path}/out"
    rows = spark.range(0, 1000, 1, 6).select(F.to_json(F.struct("id")).alias("item"))
    rows.write.format("paged").option("size", 50).mode("append").save(folder)
    before = items(spark.read.format("paged").load(folder))
    assert before == sorted(f'{{"id":{i}}}' for i in range(1000))
    bad = rows.withColumn("item", F.when(F.col("item") == '{"id":900}', F.raise_error(F.lit("lost"))).otherwise(F.col("item")))
    with pytest.raises(Exception, match="lost"):
        bad.write.format("paged").option("size", 50).mode("append").save(folder)
    assert items(spark.read.format("paged").load(folder)) == before
    rows.limit(3).write.format("paged").mode("append").save(folder)
    assert spark.read.format("paged").load(folder).count() == 1003
    with pytest.raises(Exception, match="only ever added"):
        rows.write.format("paged").mode("overwrite").save(folder)


def test_two_writers_get_pages_of_their_own(tmp_path):
    options = {"path": str(tmp_path), "size": "2"}
    a, b = paged.PagedWriter(options), paged.PagedWriter(options)
    done = [w.write(iter([(f'"{k}{i}"',) for i in range(5)])) for k, w in (("a", a), ("b", b))]
    threads = [threading.Thread(target=w.commit, args=([m],)) for w, m in zip((a, b), done, strict=True)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    pages = paged.FolderPages(options)
    assert pages.count() == 6 and sorted(x for p in range(6) for x in pages.rows(p)) == sorted(f'"{k}{i}"' for k in "ab" for i in range(5))


def test_writers_of_different_sizes_clash_on_their_first_page(tmp_path, monkeypatch):
    options = {"path": str(tmp_path), "size": "2"}
    a, b = paged.PagedWriter(options), paged.PagedWriter(options)
    long, short = a.write(iter([(f'"a{i}"',) for i in range(5)])), b.write(iter([('"b"',)]))
    put = store.put

    def late(uri, data, new=False):
        """b commits after a has counted the pages, before a's manifest is there."""
        monkeypatch.setattr(store, "put", put)
        b.commit([short])
        put(uri, data, new)

    monkeypatch.setattr(store, "put", late)
    a.commit([long])
    pages = paged.FolderPages(options)
    assert [x for p in range(pages.count()) for x in pages.rows(p)] == ['"b"', *(f'"a{i}"' for i in range(5))]


def test_a_batch_is_known_among_those_of_other_writers(tmp_path):
    options = {"path": str(tmp_path), "size": "2"}
    one, two, batch = paged.PagedStreamWriter(options), paged.PagedStreamWriter(options | {"writer": "a.b"}), paged.PagedWriter(options)
    put = lambda w, x, *n: w.commit([w.write(iter([(x,)]))], *n)
    for w, x, *n in ((one, "0", 0), (two, "1", 0), (one, "2", 1), (batch, "3"), (one, "2", 1), (two, "1", 0), (one, "0", 0), (two, "4", 1)):
        put(w, x, *n)
    pages = paged.FolderPages(options)
    assert [pages.rows(p) for p in range(pages.count())] == [["0"], ["1"], ["2"], ["3"], ["4"]]


def test_stream_stops_between_batches_and_resumes(spark, sf, tmp_path):
    paged.register(spark)
    source, sink, checkpoint = (f"file://{tmp_path}/{x}" for x in ("source", "sink", "checkpoint"))
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", F.to_json(F.struct("page_id", "url", "html")).alias("item"))
    feed = lambda k: pages.where(F.col("page_id") % 3 == k).select("item").write.format("paged").option("size", 10).mode("append").save(source)

    def run(fail=False):
        rows = spark.readStream.format("paged").option("pages_per_task", 2).load(source).select("item")
        if fail:
            rows = rows.withColumn("item", F.when(F.get_json_object("item", "$.page_id").cast("int") % 3 == 1, F.raise_error(F.lit("killed"))).otherwise(F.col("item")))
        q = rows.writeStream.format("paged").option("size", 7).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(sink)
        q.awaitTermination(120)

    feed(0)
    run()
    feed(1)
    with pytest.raises(Exception, match="killed"):
        run(fail=True)
    feed(2)
    run()
    run()
    assert items(spark.read.format("paged").load(sink)) == sorted(r.item for r in pages.collect())
    # the sink's commit is lost to the checkpoint: the batch comes again, and adds nothing
    log = sorted(p for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())[-1]
    log.unlink()
    (log.parent / f".{log.name}.crc").unlink(missing_ok=True)
    run()
    assert items(spark.read.format("paged").load(sink)) == sorted(r.item for r in pages.collect())
    assert store.names(f"{sink}/_manifest") and not [n for n in store.names(f"{sink}/data") if n.endswith("tmp")]


def test_batches_are_small_unless_the_session_says_otherwise(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        assert spark.conf.get(key) == paged.BATCH
        paged.register(spark)
        assert spark.conf.get(key) == paged.SMALL_BATCH
        spark.conf.set(key, "16m")
        assert paged.register(spark).conf.get(key) == "16m"
    finally:
        spark.conf.set(key, own)
