"""Queries of step pipelines, expressions, filters, sorting and limits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import filters, js
from .pipeline import indexed as pipeline_index
from .pipeline import run
from .registry import query


@query("""SELECT CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS rank, o_orderkey AS id, o_totalprice AS price,
  'order ' || CAST(o_orderkey AS VARCHAR) AS label FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def top_orders_ranked(t, spark):
    spec = [
        {"filter": "item.o_orderstatus === 'F'"},
        {"map": {"id": "${{ item.o_orderkey }}", "k": "${{ Number(item.o_totalprice) }}"}},
        {"sort": {"by": "k", "order": "desc"}},
        {"limit": "${{ args.limit }}"},
        {"map": {"rank": "${{ index + 1 }}", "id": "${{ item.id }}", "price": "${{ item.k }}", "label": "order ${{ item.id }}"}},
    ]
    return run(spec, t("orders"), ["o_orderkey"], {"limit": 20})


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def select_path(t, spark):
    df = t("events").select("event_id", F.from_json("props", "k bigint").alias("p"))
    return run([{"map": {"event_id": "${{ item.event_id }}", "k": "${{ item.p.k }}"}}], df, ["event_id"], ordered=False)


@query("""SELECT p_partkey AS id, upper(p_name) AS name, CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS kind,
  CAST(p_size AS BIGINT) * 2 + 1 AS twice, least(p_retailprice, 1500.0) AS capped FROM part""")
def map_project(t, spark):
    spec = [{"map": {"id": "${{ item.p_partkey }}", "name": "${{ item.p_name | upper }}", "kind": "${{ item.p_size > 25 ? 'large' : 'small' }}", "twice": "${{ item.p_size * 2 + 1 }}", "capped": "${{ Math.min(item.p_retailprice, 1500) }}"}}]
    return run(spec, t("part"), ["p_partkey"], ordered=False)


@query("SELECT doc_id, lang FROM documents WHERE text IS NOT NULL AND text <> '' AND n_chars IS NOT NULL AND n_chars <> 0 AND NOT coalesce(source = 'src0', false)")
def filter_truthy(t, spark):
    return run([{"filter": "item.text && item.n_chars && !(item.source === 'src0')"}, {"map": {"doc_id": "${{ item.doc_id }}", "lang": "${{ item.lang }}"}}], t("documents"), ["doc_id"], ordered=False)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50")
def sort_numeric_limit(t, spark):
    return run([{"sort": "o_totalprice"}, {"limit": 50}], t("orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def sort_desc_limit(t, spark):
    return run([{"sort": {"by": "o_totalprice", "order": "desc"}}, {"limit": 50}], t("orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query("SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS r, count(*) OVER () AS n FROM customer) WHERE r <= n - 10")
def limit_negative(t, spark):
    return run([{"limit": -10}], t("customer").select("c_custkey"), ["c_custkey"], ordered=False)


@query("SELECT p_partkey, p_brand FROM part ORDER BY CAST(regexp_extract(p_brand, '(\\d+)', 1) AS BIGINT), p_partkey LIMIT 40")
def sort_natural(t, spark):
    return run([{"sort": "p_brand"}, {"limit": 40}], t("part").select("p_partkey", "p_brand"), ["p_partkey"])


@query("SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS BIGINT) AS rank FROM customer")
def rank_index(t, spark):
    return run([{"sort": {"by": "c_acctbal", "order": "desc"}}, {"map": {"c_custkey": "${{ item.c_custkey }}", "rank": "${{ index + 1 }}"}}], t("customer"), ["c_custkey"], ordered=False)


@query("""SELECT c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS r FROM customer) WHERE r > 5 AND r <= 25""")
def offset_limit(t, spark):
    from ..sources.captures import offset_page

    df = t("customer").select("c_custkey", "c_acctbal").withColumn("k", F.struct("c_acctbal", "c_custkey"))
    return offset_page(df, "k", 5, 20).drop("k")


@query("""SELECT l.l_orderkey, l.l_linenumber, o.o_orderstatus, CASE WHEN o.o_orderkey IS NULL THEN 'not found' END AS error
  FROM lineitem l LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON l.l_orderkey = o.o_orderkey""")
def fetch_lookup_all(t, spark):
    """Every line, so that many ask for the same key."""
    details = t("orders").where("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus")
    return run([{"fetch": {"table": "details", "key": "item.l_orderkey", "on": "o_orderkey"}}], t("lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], tables={"details": details}, ordered=False)


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN json_extract_string(props, '$.k') END AS k, CASE event_id % 4 WHEN 1 THEN '2' END AS second, event_id % 4 < 2 AS parsed, CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN ' [1, 2]' WHEN 2 THEN '{broken' ELSE 'plain' END AS raw FROM events""")
def evaluate_auto_parse(t, spark):
    """Text that looks like JSON becomes a value; what doesn't parse stays text."""
    raw = F.expr("case event_id % 4 when 0 then props when 1 then ' [1, 2]' when 2 then '{broken' else 'plain' end")
    out = run([{"evaluate": "raw"}], t("events").select("event_id", raw.alias("raw")), ["event_id"], ordered=False)
    v = F.col("raw_json")
    return out.select("event_id", F.try_variant_get(v, "$.k", "string").alias("k"), F.try_variant_get(v, "$[1]", "string").alias("second"), v.isNotNull().alias("parsed"), "raw")


@query("SELECT page_id, url FROM pages WHERE contains(url, 'page=')")
def intercept_capture(t, spark):
    return run([{"intercept": {"table": "pages", "capture": "page=", "order": "page_id"}}], t("pages"), ["page_id"], tables={"pages": t("pages").select("page_id", "url")}, ordered=False)


@query("""SELECT page_id, regexp_extract(url, '://([^/?#:]+)', 1) || '.html' AS path,
  CASE WHEN row_number() OVER (PARTITION BY regexp_extract(url, '://([^/?#:]+)', 1) ORDER BY page_id) = 1 THEN 'planned' ELSE 'conflict' END AS status FROM pages""")
def download_plan(t, spark):
    df = t("pages").select("page_id", F.regexp_extract("url", "://([^/?#:]+)", 1).alias("host"))
    return run([{"download": {"path": "${{ item.host }}.html"}}], df, ["page_id"], ordered=False).drop("host")


@query("""SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
  CASE WHEN length(p_name) > 8 THEN left(p_name, 8) || '...' ELSE p_name END AS short, replace(p_name, '#', '-') AS dashed,
  coalesce(nullif(p_type, ''), 'none') AS kind FROM part""")
def text_filters(t, spark):
    spec = [{"map": {"p_partkey": "${{ item.p_partkey }}", "slug": "${{ item.p_name | slugify }}", "short": "${{ item.p_name | truncate(8) }}", "dashed": "${{ item.p_name | replace('#','-') }}", "kind": "${{ item.p_type | default(none) }}"}}]
    return run(spec, t("part"), ["p_partkey"], ordered=False)


@query("""SELECT page_id, regexp_extract(url, '(\\.[^./\\\\]*)$', 1) AS ext, CASE WHEN regexp_extract(url, '([^/\\\\]*)$', 1) = '' THEN url ELSE regexp_extract(url, '([^/\\\\]*)$', 1) END AS base FROM pages""")
def text_basename_ext(t, spark):
    return run([{"map": {"page_id": "${{ item.page_id }}", "ext": "${{ item.url | ext }}", "base": "${{ item.url | basename }}"}}], t("pages"), ["page_id"], ordered=False)


@query("""SELECT page_id, replace(replace(replace(replace(replace(url_encode(url), '%21', '!'), '%27', chr(39)), '%28', '('), '%29', ')'), '%2A', '*') AS encoded FROM pages""")
def url_encode_all(t, spark):
    """Every page's url, with the characters that encoding is about."""
    return t("pages").select("page_id", filters.url_encode(F.col("url")).alias("encoded"))


@query("""SELECT doc_id, CAST(length(lang) AS BIGINT) AS n, 'x' || lang || '-' || coalesce(source, 'null') AS tag, lang = 'en' AS english, CASE WHEN n_chars > 1000 THEN 'long' ELSE 'short' END AS size, least(CASE WHEN lang = 'en' THEN n_chars ELSE n_chars + 10 END, 2000)::DOUBLE AS most,
  CASE WHEN lang = '' OR lang IS NULL THEN 'none' ELSE lang END || '!' AS marked, strftime(make_timestamp(doc_id * 1000000000), '%Y-%m-%d') AS day, n_chars % 7 = 0 OR lang <> 'en' AS either, (n_chars - doc_id * 2)::BIGINT AS math, upper(left(lang, 1)) AS letter, contains(text, 'the') AS has_the, n_chars::DOUBLE / 4 AS quarter,
  regexp_extract(text, '^([^ ]*)', 1) AS word, CAST(n_chars AS VARCHAR) || ' chars' AS told FROM documents""")
def expression_corpus(t, spark):
    """The forms that templates of the language use: paths, defaults, ternaries, calls, dates, methods, interpolation."""
    spec = [{"map": {
        "doc_id": "${{ item.doc_id }}", "n": "${{ item.lang | length }}", "tag": "x${{ item.lang }}-${{ item.source ?? 'null' }}", "english": "${{ item.lang === 'en' }}", "size": "${{ item.n_chars > 1000 ? 'long' : 'short' }}",
        "most": "${{ Math.min(item.lang === 'en' ? item.n_chars : item.n_chars + 10, 2000) }}", "marked": "${{ (item.lang || 'none') + '!' }}", "day": "${{ new Date(item.doc_id * 1000000).toISOString().slice(0, 10) }}", "either": "${{ item.n_chars % 7 === 0 || item.lang !== 'en' }}",
        "math": "${{ item.n_chars - item.doc_id * 2 }}", "letter": "${{ item.lang.slice(0, 1).toUpperCase() }}", "has_the": "${{ item.text.includes('the') }}", "quarter": "${{ Number(item.n_chars) / 4 }}", "word": "${{ item.text.split(' ')[0] }}", "told": "${{ `${item.n_chars} chars` }}",
    }}]
    return run(spec, t("documents"), ["doc_id"], ordered=False).withColumn("n", F.col("n").cast("long"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def iso_dates(t, spark):
    df = t("orders").select("o_orderkey", F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ms"))
    return run([{"map": {"o_orderkey": "${{ item.o_orderkey }}", "day": "${{ new Date(item.ms).toISOString().slice(0, 10) }}"}}], df, ["o_orderkey"], ordered=False)


@query("SELECT o_orderkey, floor(o_totalprice * 100 + 0.5) / 100 AS price, CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE 0 END AS DOUBLE) AS even FROM orders")
def number_coercion(t, spark):
    text = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit(" "))).otherwise("")
    return t("orders").select("o_orderkey", js.round_half_up(F.col("o_totalprice")).alias("price"), js.number(text, T.StringType()).alias("even"))


@query("SELECT n_name, r_name, CAST(n_nationkey AS BIGINT) AS i FROM nation JOIN region ON n_regionkey = r_regionkey")
def select_array_rows(t, spark):
    """A struct holding an array of structs is selected by path into rows."""
    nested = t("region").join(t("nation"), F.col("r_regionkey") == F.col("n_regionkey")).groupBy("r_name").agg(F.sort_array(F.collect_list(F.struct(F.col("n_nationkey").cast("long").alias("i"), "n_name", "r_name"))).alias("items"))
    df = nested.select("r_name", F.struct("items").alias("result"))
    return run([{"select": "result.items"}], df, ["r_name"], ordered=False).select("n_name", "r_name", "i")


@query("SELECT a.o_orderkey, a.o_orderdate AS left_date, b.o_orderkey AS right_key FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders) a LEFT JOIN (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders WHERE o_orderstatus <> 'P') b ON a.r = b.r")
def zip_positions(t, spark):
    """Two tables side by side by position, each in its own order; the shorter one ends in nulls."""
    o = t("orders")
    left = pipeline_index(o.select("o_orderkey", F.col("o_orderdate").alias("left_date")), [F.col("o_orderkey")])
    right = pipeline_index(o.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("right_key"), "o_totalprice"), [F.desc("o_totalprice"), F.asc("right_key")])
    return left.join(right, "_index", "left").select("o_orderkey", "left_date", "right_key")


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice AS bid, next AS ask, 'order ' || l_orderkey || ' of ' || n AS label FROM (
  SELECT l_orderkey, l_linenumber, l_extendedprice, lead(l_extendedprice) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice) AS next, count(*) OVER (PARTITION BY l_orderkey) AS n, l_linenumber - 1 AS i FROM lineitem)""")
def zip_root(t, spark):
    """map over one array of a document, with `root` reading another one at the same index, and the document's fields."""
    line = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_extendedprice")))
    docs = t("lineitem").groupBy("l_orderkey").agg(line.alias("lines"))
    docs = docs.select("l_orderkey", "lines", F.transform(F.slice("lines", 2, 1_000_000), lambda x: x["l_extendedprice"]).alias("asks"))
    spec = [{"map": {"select": "lines", "l_orderkey": "${{ root.l_orderkey }}", "l_linenumber": "${{ item.l_linenumber }}", "bid": "${{ data[index].l_extendedprice }}", "ask": "${{ root.asks[index] }}", "label": "order ${{ root.l_orderkey }} of ${{ data.length }}"}}]
    return run(spec, docs, ["l_orderkey"], ordered=False)


@query("""
WITH e AS (SELECT event_id, event_id % 5 AS m, CASE event_id % 5 WHEN 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) WHEN 2 THEN 0 WHEN 4 THEN NULL ELSE event_id % 100 END AS n FROM events)
SELECT event_id AS id, CASE m WHEN 2 THEN 'null' WHEN 4 THEN 'undefined' ELSE CAST(CAST(n AS BIGINT) AS VARCHAR) END AS k, coalesce(n, 0) * 2 AS twice, m = 1 AS is_text,
  CASE m WHEN 2 THEN CAST(event_id AS VARCHAR) ELSE 'undefined' END AS x, CASE m WHEN 1 THEN CAST(event_id % 100 AS VARCHAR) || '!' WHEN 3 THEN CAST(event_id % 100 AS VARCHAR) || '!' WHEN 2 THEN 'null!' WHEN 4 THEN 'undefined!' ELSE CAST(CAST(n AS BIGINT) AS VARCHAR) || '!' END AS shout
FROM e WHERE m IN (2, 4) OR n > 30""")
def variant_paths(t, spark):
    """Paths into values of mixed runtime types: numbers, numbers as text, null, lists and nothing at all."""
    raw = F.expr("""case event_id % 5 when 0 then props when 1 then concat('{"k": "', event_id % 100, '"}') when 2 then concat('{"k": null, "deep": [{"x": ', event_id, '}]}') when 3 then concat('{"k": [', event_id % 100, ']}') else '{"deep": {"x": true}}' end""")
    steps = [{"evaluate": "raw"}, {"filter": "item.raw_json.k > 30 || item.raw_json.deep"}, {"map": {"id": "${{ item.event_id }}", "k": "${{ String(item.raw_json.k) }}", "twice": "${{ Number(item.raw_json.k || 0) * 2 }}", "is_text": "${{ item.raw_json.k === String(item.raw_json.k) }}", "x": "${{ String(item.raw_json.deep[0].x) }}", "shout": "${{ String(item.raw_json.k + '!') }}"}}]
    return run(steps, t("events").select("event_id", raw.alias("raw")), ["event_id"], ordered=False)


@query("SELECT page_id, url AS decoded, url AS again FROM pages")
def url_decode_all(t, spark):
    """Urls encoded and decoded again, by the filters and by functions of expressions."""
    rows = t("pages").select("page_id", "url")
    out = run([{"map": {"page_id": "${{ item.page_id }}", "decoded": "${{ item.url | urlencode | urldecode }}", "again": "${{ decodeURIComponent(encodeURIComponent(item.url)) }}"}}], rows, ["page_id"], ordered=False)
    return out
