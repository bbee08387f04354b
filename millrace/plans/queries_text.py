"""Queries of scalar functions, page classifiers, quality rules, shapes, trees and event state."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import redact, text, values
from ..functions.js import round_half_up
from ..operators import pages as pg
from ..operators import quality, shape, trees
from ..sources import captures
from ..streaming import buffers
from .registry import query

_EPOCH = "unix_micros(cast(ts as timestamp)) / 1e6"


@query("""SELECT o_orderkey, CAST(CASE o_orderkey % 6 WHEN 0 THEN k * 1000 + 500 WHEN 1 THEN k * 1000000 WHEN 2 THEN k WHEN 3 THEN 0 WHEN 4 THEN k ELSE 1000 + k END AS BIGINT) AS n FROM (SELECT o_orderkey, o_orderkey % 1000 AS k FROM orders)""")
def compact_numbers(t, spark):
    """A unit counts only right after its number: '3 months ago' is 3, '5 books' is 5."""
    c = F.expr("element_at(array(concat(k, '.5K'), concat(k, 'm likes'), concat(k, ' months ago'), 'none', concat(k, ' books'), concat('1,', lpad(cast(k as string), 3, '0'))), cast(o_orderkey % 6 as int) + 1)")
    return t("orders").withColumn("k", F.col("o_orderkey") % 1000).select("o_orderkey", values.compact_number(c).alias("n"))


@query("""SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 2 = 0 THEN floor((CAST(o_orderkey % 100 AS DOUBLE) + 0.5) * 1048576 + 0.5) ELSE NULL END AS BIGINT) AS bytes,
  CASE WHEN o_orderkey % 7200 >= 3600 THEN (o_orderkey % 7200) // 3600 || ':' || lpad(CAST((o_orderkey % 3600) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') ELSE (o_orderkey % 3600) // 60 || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') END AS clock FROM orders""")
def parse_bytes(t, spark):
    c = F.expr("if(o_orderkey % 2 = 0, concat(o_orderkey % 100, '.5MB'), 'big')")
    return t("orders").select("o_orderkey", values.parse_bytes(c).alias("bytes"), values.clock(F.col("o_orderkey") % 7200).alias("clock"))


@query("""SELECT p_partkey, floor(p_retailprice * 100 + 0.5) / 100 AS value, CASE WHEN p_partkey % 2 = 0 THEN 'USD' ELSE 'EUR' END AS currency FROM part""")
def price_parse(t, spark):
    c = F.concat(F.lit("from "), F.when(F.col("p_partkey") % 2 == 0, "$").otherwise("€"), F.format_number("p_retailprice", 2), F.lit(" each"))
    p = values.price(c)
    return t("part").select("p_partkey", p["value"].alias("value"), p["currency"].alias("currency"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, CAST((hour(ts + INTERVAL 330 MINUTE) * 60 + minute(ts + INTERVAL 330 MINUTE)) AS BIGINT) AS minute, event_id % 31 < 28 AS valid FROM events""")
def date_functions(t, spark):
    ts = F.col("ts").cast("timestamp")
    text_date = F.concat(F.lit("2023-02-"), F.lpad((F.col("event_id") % 31 + 1).cast("string"), 2, "0"))
    return t("events").select("event_id", values.epoch_date(F.unix_seconds(ts)).alias("day"), values.minute_of_day(ts, "Asia/Kolkata").alias("minute"), values.is_iso_date(text_date).alias("valid"))


@query("""WITH u AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN regexp_replace(url, '^(https?://[^/?#]+)', '\\1:8443') WHEN 1 THEN regexp_replace(url, '^(https?://[^/?#]+).*$', '\\1/i/api/graphql/abc123/Op' || page_id || '?v=1')
    WHEN 2 THEN regexp_replace(url, '^(https?://[^/?#]+).*$', '\\1') WHEN 3 THEN repeat('no url ', 20) || page_id ELSE replace(url, 'https://', 'https://u:p@') END AS url FROM pages),
  p AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host, regexp_extract(url, '^[a-z]+://(?:[^/?#@]*@)?[^/?#:]+(:\\d+)?([^?#]*)', 2) AS path FROM u)
  SELECT page_id, host, CASE page_id % 5 WHEN 0 THEN 'GET ' || host || ':8443' || CASE path WHEN '' THEN '/' ELSE path END WHEN 1 THEN 'Op' || page_id WHEN 3 THEN 'GET ' || left(url, 119) || '…' ELSE 'GET ' || host || CASE path WHEN '' THEN '/' ELSE path END END AS key,
    host = 'example.com' OR ends_with(host, '.example.com') AS inside FROM p""")
def page_host(t, spark):
    """Urls with ports, user names and GraphQL paths among them, and texts that are no urls."""
    url = F.expr("""case page_id % 5 when 0 then regexp_replace(url, '^(https?://[^/?#]+)', '$1:8443') when 1 then regexp_replace(url, '^(https?://[^/?#]+).*$', concat('$1/i/api/graphql/abc123/Op', page_id, '?v=1'))
      when 2 then regexp_replace(url, '^(https?://[^/?#]+).*$', '$1') when 3 then concat(repeat('no url ', 20), page_id) else replace(url, 'https://', 'https://u:p@') end""")
    h = values.host(F.col("url"))
    return t("pages").select("page_id", url.alias("url")).select("page_id", h.alias("host"), values.request_key(F.lit("get"), F.col("url")).alias("key"), values.in_domain(h, F.lit("example.com")).alias("inside"))


@query("""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', ' '), '&amp;', '&'), '[\\s\\x{00A0}\\x{202F}]+', ' ', 'g')) AS text FROM pages""")
def strip_html(t, spark):
    return t("pages").select("page_id", text.strip_tags(F.col("html")).alias("text"))


@query()
def article_markdown(t, spark):
    """HTML parsing has no SQL form: tested on fixed pages."""
    return t("pages").select("page_id", text.article_markdown("html").alias("markdown"))


@query("""WITH RECURSIVE s AS (SELECT doc_id, text AS x, length(text) AS n FROM documents WHERE text IS NOT NULL),
  c AS (SELECT doc_id, x, n, -1 AS pos, 0 AS a, 0 AS b FROM s UNION ALL
    SELECT doc_id, x, n, pos + 1, b, CASE WHEN n - b <= 1010 THEN n
      WHEN contains(substr(x, b + 860, 151), chr(10) || chr(10)) THEN b + 859 + 152 - strpos(reverse(substr(x, b + 860, 151)), chr(10) || chr(10))
      WHEN contains(substr(x, b + 860, 151), chr(10)) THEN b + 859 + 152 - strpos(reverse(substr(x, b + 860, 151)), chr(10)) ELSE b + 1010 END
    FROM c WHERE b < n OR (n = 0 AND pos = -1))
  SELECT doc_id, CAST(pos AS INTEGER) AS pos, substr(x, a + 1, b - a) AS chunk FROM c WHERE pos >= 0""")
def chunks(t, spark):
    """Every chunk with its cut: of 1010 characters at most, the window for a line end being the last 151."""
    return t("documents").select("doc_id", F.posexplode(text.chunks("text", F.lit(1010))).alias("pos", "chunk"))


@query("""WITH r AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
    '(?i)\\b(Bearer|Basic|Negotiate|NTLM)\\s+[A-Za-z0-9\\-._~+/]+=*', '\\1 [REDACTED]', 'g'),
    '(?i)(?:"(password|passwd|pwd|token|secret|api_key|apikey|access_token|session_id)"\\s*:\\s*"(.*?)")', '"\\1":"[REDACTED]"', 'g'),
    '(?i)(token|secret|password|api_key|apikey|access_token|session_id)[=:]\\s*[''"]?[^''"\\s,;}&]+[''"]?', '\\1=[REDACTED]', 'g'),
    '(?i)(cookie[=:]\\s*)[^\\n;]{3,}', '\\1[REDACTED]', 'g'),
    'eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}', '[REDACTED_JWT]', 'g') AS text FROM documents)
  SELECT doc_id, CASE WHEN length(text) > 50000 THEN left(text, 50000) || chr(10) || '...[truncated, ' || (length(text) - 50000) || ' chars omitted]' ELSE text END AS text FROM r""")
def redact_all_texts(t, spark):
    """All documents by all rules, long ones cut."""
    return t("documents").select("doc_id", redact.text(F.col("text")).alias("text"))


@query("""WITH s AS (SELECT doc_id, text || CASE doc_id % 8 WHEN 0 THEN ' Authorization: Negotiate YIIabc+/=='
      WHEN 1 THEN ' {"pwd": "x1", "name": "kept", "session_id" : "s p"}' WHEN 2 THEN ' access_token=abc123&x=1 my_token: zzz; end' WHEN 3 THEN chr(10) || 'Cookie: a=b; c' || chr(10) || 'cookie=abcdef123'
      WHEN 4 THEN ' id eyJhbGciOiJIUzI1.eyJzdWIiOiIxMjM0.c2lnbmF0dXJlMTIz end' WHEN 5 THEN repeat(' filler text', 4600) ELSE '' END AS text FROM documents),
  r AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
    '(?i)\\b(Bearer|Basic|Negotiate|NTLM)\\s+[A-Za-z0-9\\-._~+/]+=*', '\\1 [REDACTED]', 'g'),
    '(?i)(?:"(password|passwd|pwd|token|secret|api_key|apikey|access_token|session_id)"\\s*:\\s*"(.*?)")', '"\\1":"[REDACTED]"', 'g'),
    '(?i)(token|secret|password|api_key|apikey|access_token|session_id)[=:]\\s*[''"]?[^''"\\s,;}&]+[''"]?', '\\1=[REDACTED]', 'g'),
    '(?i)(cookie[=:]\\s*)[^\\n;]{3,}', '\\1[REDACTED]', 'g'),
    'eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}', '[REDACTED_JWT]', 'g') AS text FROM s)
  SELECT doc_id, CASE WHEN length(text) > 50000 THEN left(text, 50000) || chr(10) || '...[truncated, ' || (length(text) - 50000) || ' chars omitted]' ELSE text END AS text FROM r""")
def redact_planted_texts(t, spark):
    """All documents, with secrets of every kind planted in them."""
    planted = F.expr("""concat(text, case doc_id % 8 when 0 then ' Authorization: Negotiate YIIabc+/=='
      when 1 then ' {"pwd": "x1", "name": "kept", "session_id" : "s p"}' when 2 then ' access_token=abc123&x=1 my_token: zzz; end' when 3 then '\nCookie: a=b; c\ncookie=abcdef123'
      when 4 then ' id eyJhbGciOiJIUzI1.eyJzdWIiOiIxMjM0.c2lnbmF0dXJlMTIz end' when 5 then repeat(' filler text', 4600) else '' end)""")
    return t("documents").select("doc_id", redact.text(planted).alias("text"))


@query("""SELECT page_id, regexp_replace(regexp_replace(replace(url, '://', '://u:p@') || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'token=abc&amp;csrf=1&page=2&session_id=9', '(?i)(https?://)[^/\\s@]+@', '\\1[REDACTED]@', 'g'),
  '(?i)(\\?|&(?:amp;)?)(token|key|secret|password|auth|access_token|api_key|session_id|csrf|xsrf)=[^&"''\\s<>]*', '\\1\\2=[REDACTED]', 'g') AS url FROM pages""")
def redact_urls(t, spark):
    more = F.concat(F.replace("url", F.lit("://"), F.lit("://u:p@")), F.when(F.contains("url", F.lit("?")), "&").otherwise("?"), F.lit("token=abc&amp;csrf=1&page=2&session_id=9"))
    return t("pages").select("page_id", redact.url(more).alias("url"))


@query("""SELECT event_id, '[REDACTED]' AS password, 'Bearer [REDACTED]' AS note, CAST(value AS DOUBLE) AS value, '[REDACTED]' AS inner_csrf, 'kept' AS inner_name, 'http://h/?token=[REDACTED]' AS url,
  CASE WHEN event_id % 2 = 0 THEN 102 ELSE 3 END AS n, CASE WHEN event_id % 2 = 0 THEN '[truncated, 2 items omitted]' END AS last, '[REDACTED]' AS x_xsrf, 'text/html' AS accept FROM events""")
def redact_values(t, spark):
    """Nested values: secret names at any depth, urls, arrays over 100 items and header maps."""
    v = F.struct(F.lit("p").alias("password"), F.lit("Bearer abc.def").alias("note"), F.col("value").cast("double").alias("value"), F.struct(F.lit("t").alias("csrf"), F.lit("kept").alias("name")).alias("inner"), F.lit("http://h/?token=abc").alias("url"),
                 F.transform(F.sequence(F.lit(1), F.when(F.col("event_id") % 2 == 0, 102).otherwise(3)), lambda i: i.cast("string")).alias("items"), F.create_map(F.lit("X-XSRF-Token"), F.lit("q"), F.lit("accept"), F.lit("text/html")).alias("headers"))
    rows = t("events").select("event_id", v.alias("v"))
    out = rows.select("event_id", redact.value(F.col("v"), rows.schema["v"].dataType).alias("v"))
    size = F.when(F.startswith(F.element_at("v.items", -1), F.lit("[")), F.size("v.items") + 1).otherwise(F.size("v.items"))
    return out.select("event_id", "v.password", "v.note", "v.value", F.col("v.inner.csrf").alias("inner_csrf"), F.col("v.inner.name").alias("inner_name"), "v.url", size.alias("n"),
                      F.when(F.size("v.items") > 100, F.element_at("v.items", -1)).alias("last"), F.col("v.headers")["X-XSRF-Token"].alias("x_xsrf"), F.col("v.headers")["accept"].alias("accept"))


@query("""WITH p AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 403 WHEN 1 THEN 200 WHEN 2 THEN 503 ELSE 404 END AS status, page_id % 12 AS kind, html FROM pages),
  q AS (SELECT page_id, status, kind, CASE kind WHEN 0 THEN 'datadome captcha ' || html WHEN 1 THEN '<title>Just a moment</title>' || html WHEN 5 THEN '<p>captcha</p>' WHEN 7 THEN repeat('x', 20001) || 'just a moment'
      WHEN 9 THEN '<main id="root"></main><script>var a = 1</script>' WHEN 3 THEN '<div class=a data-page="app">hi</div><script src=x></script>' WHEN 11 THEN '<div id="__next"></div><script></script>' WHEN 8 THEN '{"a": 1}' WHEN 10 THEN '  <HTML lang=en>' ELSE html END AS body FROM p)
  SELECT page_id,
    regexp_matches(left(body, 20000), '(?i)cf-chl|cf-mitigated|just a moment|verify you are human|checking your browser|enable javascript and cookies') OR kind = 6
      OR (status IN (403, 429, 503) AND (kind IN (2, 4) OR regexp_matches(left(body, 20000), '(?i)cloudflare|datadome|perimeterx|px-captcha|akamai|captcha|__cf_bm'))) AS challenge,
    kind IN (3, 9) AS shell, kind IN (9) OR regexp_matches(body, '(?i)^\\s*<(?:!doctype|html|head|body|title)(?:[\\s>/]|$)') AS login,
    CASE kind WHEN 0 THEN 'aliyun_waf' WHEN 1 THEN 'cloudflare' WHEN 2 THEN 'akamai' WHEN 3 THEN 'geetest' WHEN 4 THEN 'aliyun_waf' WHEN 5 THEN 'cloudflare' WHEN 6 THEN 'aliyun_waf' END AS vendor FROM q""")
def classify_pages(t, spark):
    """Pages, and bodies of each kind that the rules tell apart, with headers, cookies and captured bodies."""
    p = t("pages").select("page_id", "html", F.expr("element_at(array(403, 200, 503, 404), cast(page_id % 4 as int) + 1)").alias("status"), (F.col("page_id") % 12).alias("kind"))
    body = F.expr("""case kind when 0 then concat('datadome captcha ', html) when 1 then concat('<title>Just a moment</title>', html) when 5 then '<p>captcha</p>' when 7 then concat(repeat('x', 20001), 'just a moment')
      when 9 then '<main id="root"></main><script>var a = 1</script>' when 3 then '<div class=a data-page="app">hi</div><script src=x></script>' when 11 then '<div id="__next"></div><script></script>' when 8 then '{"a": 1}' when 10 then '  <HTML lang=en>' else html end""")
    headers = F.expr("case kind when 2 then map('Server', 'cloudflare') when 4 then map('X-DataDome-CID', 'perimeterx') when 6 then map('cf-mitigated', 'challenge') when 8 then map('content-security-policy', 'https://cloudflare.com') end")
    cookies = F.expr("case kind when 0 then array('a', 'acw_tc') when 1 then array('cf_clearance') when 2 then array('bm_sz', '_abck') when 6 then array('ssxmod_itna2', '_abck') when 7 then array('my_abck') end")
    bodies = F.expr("case kind when 3 then array(null, 'GeeTest v4') when 4 then array('akamai', concat('var arg1 = ''', repeat('A1', 16), '''')) when 5 then array('Cloudflare Ray ID: 1') end")
    kind = F.when(F.col("kind") == 9, "text/HTML; charset=x").otherwise("application/json")
    q = p.withColumns({"body": body, "headers": headers, "cookies": cookies, "bodies": bodies, "ct": kind})
    return q.select("page_id", pg.is_challenge(F.col("status"), F.col("headers"), F.col("body")).alias("challenge"), pg.is_js_shell(F.col("body")).alias("shell"), pg.is_login_wall(F.col("ct"), F.col("body")).alias("login"), pg.vendor(F.col("cookies"), F.col("bodies")).alias("vendor"))


@query("""WITH e AS (SELECT event_id, event_id % 8 AS kind, CASE WHEN event_id % 10 = 0 THEN 401 WHEN event_id % 10 < 8 THEN 200 ELSE 500 END AS status, CASE event_id % 3 WHEN 0 THEN 'text/html' WHEN 1 THEN 'application/json' ELSE 'text/plain' END AS ct, event_id % 7 = 0 AS noisy FROM events),
  s AS (SELECT event_id, status, (CASE WHEN status = 200 THEN 0.15 ELSE 0 END + CASE ct WHEN 'application/json' THEN 0.20 WHEN 'text/html' THEN -0.25 ELSE 0.05 END - CASE WHEN noisy THEN 0.30 ELSE 0 END
    + CASE kind WHEN 0 THEN 0.30 WHEN 1 THEN -0.15 WHEN 2 THEN -0.15 WHEN 3 THEN 0.12 + 0.05 * 3 + 0.20 WHEN 4 THEN 0.12 - 0.08 * 2 WHEN 5 THEN -0.25 WHEN 6 THEN 0.05 ELSE 0 END)::DOUBLE AS raw FROM e),
  r AS (SELECT event_id, status, CASE WHEN status = 401 THEN 0.05 ELSE floor(greatest(0, least(1, raw)) * 100 + 0.5) / 100 END AS score FROM s)
  SELECT event_id, score, CASE WHEN status = 401 THEN 'blocked' WHEN score >= 0.65 THEN 'likely_data' WHEN score >= 0.35 THEN 'maybe_data' ELSE 'noise' END AS verdict FROM r""")
def endpoint_scores(t, spark):
    """Captured responses with bodies of every kind: arrays, objects, markup, text and none."""
    return _responses(t).select("event_id", "score", "verdict")


def _responses(t):
    body = F.expr("""element_at(array('[1, 2]', '[]', '{}', '{"items": [{"id": 1}], "title": "x"}', '{"event": "view", "clientId": "c"}', ' <html>', 'a plain text of over twenty characters', null), cast(event_id % 8 as int) + 1)""")
    e = t("events").select("event_id", "user_id", F.expr("case when event_id % 10 = 0 then 401 when event_id % 10 < 8 then 200 else 500 end").alias("status"), F.expr("element_at(array('text/html', 'application/json', 'text/plain'), cast(event_id % 3 as int) + 1)").alias("content_type"), F.expr("if(event_id % 7 = 0, '/api/metrics', '/api/list')").alias("url"), body.alias("body"))
    e = e.withColumn("b", pg.body_evidence("body"))
    score = pg.endpoint_score(F.col("status"), F.col("content_type"), F.col("url").rlike(pg.NOISE_URL), *[F.col(f"b.{c}") for c in ("items", "keys", "business", "tracking", "nested", "html", "words")])
    return e.withColumn("score", score).withColumn("verdict", pg.evidence_class(F.col("score"), F.col("status")))


@query("""WITH e AS (SELECT event_id, user_id, event_id % 8 AS kind, CASE WHEN event_id % 10 = 0 THEN 401 WHEN event_id % 10 < 8 THEN 200 ELSE 500 END AS status, CASE event_id % 3 WHEN 0 THEN 'text/html' WHEN 1 THEN 'application/json' ELSE 'text/plain' END AS ct, event_id % 7 = 0 AS noisy FROM events),
  s AS (SELECT event_id, user_id, status, ct, (CASE WHEN status = 200 THEN 0.15 ELSE 0 END + CASE ct WHEN 'application/json' THEN 0.20 WHEN 'text/html' THEN -0.25 ELSE 0.05 END - CASE WHEN noisy THEN 0.30 ELSE 0 END
    + CASE kind WHEN 0 THEN 0.30 WHEN 1 THEN -0.15 WHEN 2 THEN -0.15 WHEN 3 THEN 0.12 + 0.05 * 3 + 0.20 WHEN 4 THEN 0.12 - 0.08 * 2 WHEN 5 THEN -0.25 WHEN 6 THEN 0.05 ELSE 0 END)::DOUBLE AS raw FROM e),
  r AS (SELECT event_id, user_id, status, ct, CASE WHEN status = 401 THEN 0.05 ELSE floor(greatest(0, least(1, raw)) * 100 + 0.5) / 100 END AS score FROM s),
  v AS (SELECT *, CASE WHEN status = 401 THEN 'blocked' WHEN score >= 0.65 THEN 'likely_data' WHEN score >= 0.35 THEN 'maybe_data' ELSE 'noise' END AS verdict FROM r)
  SELECT user_id, event_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_id) AS rank FROM v WHERE verdict <> 'noise' OR score > 0 QUALIFY rank <= 8""")
def endpoint_evidence(t, spark):
    """The eight best responses of each site."""
    return pg.top_evidence(_responses(t), "user_id", "event_id").select("user_id", "event_id", "score", "rank")


@query("""WITH e AS (SELECT event_id, user_id, event_id % 8 AS kind, CASE WHEN event_id % 10 = 0 THEN 401 WHEN event_id % 10 < 8 THEN 200 ELSE 500 END AS status, CASE event_id % 3 WHEN 0 THEN 'text/html' WHEN 1 THEN 'application/json' ELSE 'text/plain' END AS ct, event_id % 7 = 0 AS noisy FROM events),
  s AS (SELECT event_id, user_id, status, ct, (CASE WHEN status = 200 THEN 0.15 ELSE 0 END + CASE ct WHEN 'application/json' THEN 0.20 WHEN 'text/html' THEN -0.25 ELSE 0.05 END - CASE WHEN noisy THEN 0.30 ELSE 0 END
    + CASE kind WHEN 0 THEN 0.30 WHEN 1 THEN -0.15 WHEN 2 THEN -0.15 WHEN 3 THEN 0.12 + 0.05 * 3 + 0.20 WHEN 4 THEN 0.12 - 0.08 * 2 WHEN 5 THEN -0.25 WHEN 6 THEN 0.05 ELSE 0 END)::DOUBLE AS raw FROM e),
  r AS (SELECT event_id, user_id, status, ct, CASE WHEN status = 401 THEN 0.05 ELSE floor(greatest(0, least(1, raw)) * 100 + 0.5) / 100 END AS score FROM s),
  v AS (SELECT *, CASE WHEN status = 401 THEN 'blocked' WHEN score >= 0.65 THEN 'likely_data' WHEN score >= 0.35 THEN 'maybe_data' ELSE 'noise' END AS verdict FROM r),
  k AS (SELECT * FROM v WHERE verdict <> 'noise' OR score > 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_id) <= 8),
  c AS (SELECT user_id, count(*) FILTER (WHERE verdict IN ('likely_data', 'maybe_data')) AS n FROM k GROUP BY user_id),
  a AS (SELECT user_id, count(*) FILTER (WHERE status = 401) AS f, count(*) FILTER (WHERE ct = 'application/json') AS j, user_id % 3 = 0 AS ssr FROM v GROUP BY user_id)
  SELECT a.user_id, a.f AS auth_failures, a.j AS json_responses, coalesce(c.n, 0) AS candidates, CASE WHEN a.f >= 2 AND a.j >= 1 THEN 'D' WHEN a.ssr THEN 'B' WHEN coalesce(c.n, 0) >= 1 THEN 'A' ELSE 'C' END AS pattern FROM a LEFT JOIN c USING (user_id)""")
def site_patterns(t, spark):
    """Each site's pattern from its captured responses."""
    return pg.site_patterns(_responses(t), "user_id", "event_id", F.col("user_id") % 3 == 0)


@query("SELECT doc_id FROM documents WHERE contains(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), 'the') AND contains(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), 'license')")
def token_search(t, spark):
    return t("documents").where(text.matches_all(F.col("text"), "License, THE")).select("doc_id")


@query("""SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS BIGINT) AS words, CAST(ceil(length(text) / 4.0) AS BIGINT) AS tokens FROM documents""")
def word_and_token_counts(t, spark):
    return t("documents").select("doc_id", text.word_count(F.col("text")).alias("words"), values.token_estimate(F.col("text")).alias("tokens"))


@query("""SELECT rule, detail, row_index FROM (
  SELECT 'patterns' AS rule, 'event_type: no match for ^(view|click|purchase)$' AS detail, event_id AS row_index FROM events WHERE NOT regexp_matches(event_type, '^(view|click|purchase)$')
  UNION ALL SELECT 'notEmpty', 'props is empty', event_id FROM events WHERE props IS NULL OR trim(props) = ''
  UNION ALL SELECT 'mustNotContain', 'props contains 7', event_id FROM events WHERE contains(props, '7')
  UNION ALL SELECT 'mustBeTruthy', 'value is falsy', event_id FROM events WHERE value IS NULL OR value = 0
  UNION ALL SELECT 'types', 'user_id: expected string', event_id FROM events
  UNION ALL SELECT 'columns', 'missing column nothing', NULL
  UNION ALL SELECT 'rowCount', 'rows: ' || count(*), NULL FROM events HAVING count(*) > 10)""")
def quality_failures(t, spark):
    e = quality.Expect(row_count=(1, 10), columns=["event_id", "nothing"], types={"user_id": "string", "value": "number|null"}, patterns={"event_type": "^(view|click|purchase)$"}, not_empty=["props"], must_not_contain={"props": ["7"]}, must_be_truthy=["value"])
    return quality.failures(t("events"), e, "event_id")


@query("""SELECT c AS "column", string_agg(DISTINCT k, '|' ORDER BY k) AS types FROM (
    SELECT 'doc_id' AS c, CASE WHEN doc_id IS NULL THEN 'null' ELSE 'number' END AS k FROM documents UNION ALL SELECT 'lang', CASE WHEN lang IS NULL THEN 'null' ELSE 'string' END FROM documents
    UNION ALL SELECT 'quality', CASE WHEN quality IS NULL THEN 'null' ELSE 'number' END FROM documents LEFT JOIN labels USING (doc_id) UNION ALL SELECT 'toxic', CASE WHEN toxic IS NULL THEN 'null' ELSE 'number' END FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'words', 'array' FROM documents) GROUP BY c""")
def derive_fixture(t, spark):
    return quality.derive(t("documents").select("doc_id", "lang", F.split("lang", " ").alias("words")).join(t("labels"), "doc_id", "left"))


@query("""SELECT v.r AS rule, coalesce(n, 0) AS n, coalesce(s, 0) AS subjects FROM (VALUES ('short'), ('long'), ('unnamed')) v(r) LEFT JOIN (SELECT CASE WHEN n_chars < 200 THEN 'short' ELSE 'long' END AS rule, count(*) AS n, count(DISTINCT source) AS s FROM documents WHERE n_chars < 200 OR n_chars > 5000 GROUP BY 1) f ON v.r = f.rule""")
def convention_audit(t, spark):
    found = t("documents").where("n_chars < 200 or n_chars > 5000").select(F.when(F.col("n_chars") < 200, "short").otherwise("long").alias("rule"), F.col("source").alias("subject"))
    return quality.audit(found, ["short", "long", "unnamed"])


@query("""SELECT event_id, v.path, CASE v.path WHEN '$' THEN 'object' WHEN '$.k' THEN 'number' WHEN '$.tags' THEN CASE WHEN event_id % 3 = 0 THEN 'array(0)' ELSE 'array(2)' END WHEN '$.tags[0]' THEN CASE WHEN event_id % 3 = 1 THEN 'string' ELSE 'string(len=90)' END
    WHEN '$.user' THEN 'object' WHEN '$.user.id' THEN 'null' WHEN '$["a b"]' THEN 'boolean' ELSE 'object(empty)' END AS kind, event_id % 3 <> 0 OR v.path IS NOT NULL AS has_k
  FROM events, (VALUES ('$'), ('$.k'), ('$.tags'), ('$.tags[0]'), ('$.user'), ('$.user.id'), ('$["a b"]'), ('$.none')) v(path) WHERE NOT (event_id % 3 = 0 AND v.path = '$.tags[0]')""")
def infer_shape(t, spark):
    """Every path of every event's JSON, nested values added, with its type."""
    tags = F.expr("""case event_id % 3 when 0 then '[]' when 1 then '["x", "y"]' else concat('["', repeat('z', 90), '", 1]') end""")
    js = F.concat(F.expr("substring(props, 1, length(props) - 1)"), F.lit(', "tags": '), tags, F.lit(', "user": {"id": null}, "a b": true, "none": {}}'))
    s = t("events").select("event_id", shape.shape(js).alias("s"))
    return s.select("event_id", F.explode("s").alias("path", "kind"), shape.has_fields(F.col("s"), ["k", "user"]).alias("has_k"))


@query("""WITH n AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN NULL ELSE turn - turn % 3 END AS parent FROM conversations),
  k AS (SELECT conv_id, turn, parent FROM n WHERE parent IS NULL OR EXISTS (SELECT 1 FROM n p WHERE p.conv_id = n.conv_id AND p.turn = n.parent AND p.parent IS NULL))
  SELECT conv_id, turn, CASE WHEN parent IS NULL THEN 0 ELSE 1 END::BIGINT AS depth, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS place FROM k""")
def reply_tree(t, spark):
    from pyspark.sql import Window

    nodes = t("conversations").selectExpr("conv_id", "turn", "if(turn % 3 = 0, null, turn - turn % 3) parent")
    flat = trees.flatten_forest(nodes, "conv_id", "turn", "parent", "turn", most_depth=2)
    return flat.select("conv_id", "turn", "depth", F.row_number().over(Window.partitionBy("conv_id").orderBy("path")).cast("long").alias("place"))


@query("""WITH n AS (SELECT conv_id, turn, length(text) AS v, CASE WHEN turn % 3 = 0 THEN NULL ELSE turn - turn % 3 END AS parent FROM conversations),
  k AS (SELECT * FROM n WHERE parent IS NULL OR EXISTS (SELECT 1 FROM n p WHERE p.conv_id = n.conv_id AND p.turn = n.parent AND p.parent IS NULL))
  SELECT a.conv_id, a.turn, CAST(sum(b.v) AS BIGINT) AS total, count(*) AS size FROM k a JOIN k b ON a.conv_id = b.conv_id AND (a.turn = b.turn OR b.parent = a.turn) GROUP BY a.conv_id, a.turn""")
def subtree_rollup(t, spark):
    nodes = t("conversations").selectExpr("conv_id", "turn", "length(text) v", "if(turn % 3 = 0, null, turn - turn % 3) parent")
    return trees.subtree_sums(trees.flatten_forest(nodes, "conv_id", "turn", "parent", "turn", most_depth=2), "conv_id", "turn", "v")


@query("""SELECT coalesce(o.p_partkey, n.p_partkey) AS p_partkey, CASE WHEN o.p_partkey IS NULL THEN 'added' WHEN n.p_partkey IS NULL THEN 'removed' WHEN o.p_name IS DISTINCT FROM n.p_name THEN 'modified' ELSE 'same' END AS change
  FROM (SELECT p_partkey, p_name FROM part WHERE p_partkey % 5 <> 0) o FULL OUTER JOIN (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN p_name || '!' ELSE p_name END AS p_name FROM part WHERE p_partkey % 7 <> 0) n ON o.p_partkey = n.p_partkey""")
def tree_diff(t, spark):
    p = t("part").select("p_partkey", "p_name")
    return trees.tree_diff(p.where("p_partkey % 5 <> 0"), p.where("p_partkey % 7 <> 0").selectExpr("p_partkey", "if(p_partkey % 4 = 0, concat(p_name, '!'), p_name) p_name"), ["p_partkey"], "p_name")


@query("""SELECT conv_id, turn, CAST(spent AS BIGINT) AS spent FROM (SELECT conv_id, turn, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY role, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spent FROM conversations) WHERE spent <= 400""")
def budgeted_selection(t, spark):
    return trees.within_budget(t("conversations").select("conv_id", "turn", "role", F.length("text").alias("cost")), "conv_id", "role", "turn", "cost", 400).select("conv_id", "turn", "spent")


@query()
def html_nodes(t, spark):
    """DOM rows of every page; HTML parsing has no SQL form: tested on fixed pages."""
    return trees.html_nodes(t("pages"), "page_id", "html")


@query("""SELECT page_id, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS pos, trim(regexp_replace(unnest(x), '<[^>]*>', '', 'g')) AS text FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li\\b[^>]*>(.*?)</li>', 1) AS x FROM pages)""")
def html_list_scan(t, spark):
    """Every list item of every page."""
    return captures.html_list(t("pages").select("page_id", "html"), "html", "li")


@query("SELECT p_partkey, p_name AS title, '/p/' || p_partkey AS link, CAST(0 AS INTEGER) AS pos FROM part")
def feed_scan(t, spark):
    xml = F.concat(F.lit("<rss><item><title><![CDATA["), "p_name", F.lit("]]></title><link>/p/"), F.col("p_partkey").cast("string"), F.lit("</link></item></rss>"))
    return captures.feed_items(t("part").select("p_partkey", xml.alias("xml")), "xml", "item", ["title", "link"])


@query("SELECT s_suppkey, s_name AS name, '1=2' AS odd FROM supplier")
def dotenv_scan(t, spark):
    c = captures.dotenv(F.concat(F.lit("# note\nNAME=x\nODD=1=2\nNAME="), "s_name"))
    return t("supplier").select("s_suppkey", c["NAME"].alias("name"), c["ODD"].alias("odd"))


@query("SELECT event_id FROM events WHERE event_id > 100 AND event_id < 200 ORDER BY event_id LIMIT 50")
def key_range_scan(t, spark):
    return captures.key_range(t("events").select("event_id"), "event_id", 100, 200, 50)


@query("SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY (CASE WHEN c_custkey < 50 THEN 0 ELSE 1 END), c_custkey) AS r FROM customer) WHERE r <= 80")
def paginated_scan(t, spark):
    c = t("customer").select("c_custkey")
    return captures.paginated([c.where("c_custkey < 50"), c], "c_custkey", 80)


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'missing' WHEN (SELECT epoch(max(ts)) FROM events) - epoch(ts) > 86400 THEN 'expired' ELSE 'ok' END AS status FROM events""")
def cache_scan(t, spark):
    e = t("events").withColumn("s", F.expr(_EPOCH))
    now = e.agg(F.max("s").alias("now"))
    return e.crossJoin(F.broadcast(now)).select("event_id", captures.cache_status(F.when(F.col("event_id") % 5 != 0, F.col("s")), F.col("props"), F.col("now")).alias("status"))


@query("""WITH n AS (SELECT max(ts) AS now FROM events), e AS (SELECT event_id, event_type, max(CASE WHEN epoch(now) - epoch(ts) <= 86400 * 5 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fresh, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS r FROM events, n)
  SELECT event_id, event_type FROM e WHERE fresh = 1 AND r <= 40""")
def ring_buffer(t, spark):
    e = t("events")
    now = e.agg(F.max(F.expr(_EPOCH)).alias("now"))  # one row
    return buffers.ring_buffer(e.crossJoin(F.broadcast(now)), "event_type", "event_id", F.expr(_EPOCH), F.col("now"), 40, 86400.0 * 5).select("event_id", "event_type")


@query("""SELECT user_id, max(ts) AS last, (SELECT epoch(max(ts)) FROM events) - epoch(max(ts)) <= 86400 AS live FROM events GROUP BY user_id""")
def lease_live(t, spark):
    e = t("events")
    now = e.agg(F.max(F.expr(_EPOCH)).alias("now"))
    out = buffers.live_leases(e.withColumn("s", F.expr(_EPOCH)), "user_id", F.col("s"), F.lit(0.0), 0.0).drop("live")
    return out.crossJoin(F.broadcast(now)).select("user_id", F.expr("cast(timestamp_micros(cast(round(last * 1e6) as bigint)) as timestamp_ntz)").alias("last"), (F.col("now") - F.col("last") <= 86400).alias("live"))


@query("""WITH i AS (SELECT event_id, user_id, event_type = 'purchase' AS prot, CAST(floor(value * 10) AS BIGINT) + 1 AS size, (SELECT max(event_id) FROM events) - event_id AS age FROM events),
  a AS (SELECT *, prot OR age <= 5000 AS alive FROM i), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, alive ORDER BY prot DESC, event_id DESC) AS r FROM a),
  c AS (SELECT *, alive AND (prot OR r <= 30) AS counted FROM r),
  b AS (SELECT *, sum(CASE WHEN counted THEN size ELSE 0 END) OVER (PARTITION BY user_id, alive ORDER BY prot DESC, event_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM c)
  SELECT event_id, counted AND (prot OR total <= 6000) AS keep FROM b""")
def retention_prune(t, spark):
    e = t("events")
    items = e.crossJoin(F.broadcast(e.agg(F.max("event_id").alias("top")))).selectExpr("event_id", "user_id", "event_type = 'purchase' as prot", "cast(floor(value * 10) as bigint) + 1 as size", "top - event_id as age")
    return buffers.retention(items, "user_id", "event_id", F.col("age"), "size", "prot", 5000, 30, 6000).select("event_id", "keep")


@query("SELECT event_type, count(*) AS n, floor(sum(value) * 100 + 0.5) / 100 AS total, time_bucket(INTERVAL 1 DAY, ts) AS day FROM events GROUP BY event_type, day")
def tumbling_windows(t, spark):
    e = t("events").withColumn("ts", F.col("ts").cast("timestamp"))
    w = e.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"), round_half_up(F.sum("value")).alias("total"))
    return w.select("event_type", "n", "total", F.col("window.start").cast("timestamp_ntz").alias("day"))


@query("""SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT user_id, ts, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 12 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events)) GROUP BY user_id, s""")
def session_windows(t, spark):
    e = t("events").withColumn("ts", F.col("ts").cast("timestamp"))
    w = e.groupBy(F.session_window("ts", "12 hours"), "user_id").agg(F.count("*").alias("n"))
    return w.select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("start"), "n")


@query("SELECT event_type, count(*) AS n FROM (SELECT DISTINCT event_id, event_type FROM events) GROUP BY event_type")
def stream_counts(t, spark):
    """The events table replayed as a stream into a memory table, deduplicated on the way."""
    import uuid

    src = t("events")
    stream = spark.readStream.schema(src.schema).parquet(t.path("events")[:-1] + "[t]")  # a glob: the stream takes no path of a single file
    name = f"stream_counts_{uuid.uuid4().hex[:8]}"
    counts = stream.dropDuplicates(["event_id"]).groupBy("event_type").agg(F.count("*").alias("n"))
    buffers.drain(counts.writeStream.outputMode("complete").format("memory").queryName(name))
    return spark.table(name)


@query("""SELECT conv_id, turn, CAST(greatest(sum(c) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1, 0) % 2 AS BIGINT) AS speaker FROM (
  SELECT conv_id, turn, CASE WHEN role = 'user' AND coalesce(lag(regexp_matches(rtrim(x), '[.!?]["'')\\]]*$')) OVER (PARTITION BY conv_id ORDER BY turn), true) THEN 1 ELSE 0 END AS c
  FROM (SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN '>> ' ELSE 'x' END || text AS x FROM conversations))""")
def speaker_turns(t, spark):
    from ..operators import transcripts

    df = t("conversations").select("conv_id", "turn", F.concat(F.when(F.col("role") == "user", ">> ").otherwise("x"), "text").alias("text"))
    return transcripts.with_speakers(df, "conv_id", "turn", "text").select("conv_id", "turn", "speaker")


@query("""WITH RECURSIVE s AS (SELECT conv_id, turn * 7.0::DOUBLE AS tt, trim(text, ' ' || chr(10) || chr(9)) AS text FROM conversations WHERE trim(text, ' ' || chr(10) || chr(9)) <> ''),
  e AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY tt) AS r FROM s),
  g AS (SELECT conv_id, r, tt, text, tt AS start, text AS joined, 1 AS g FROM e WHERE r = 1 UNION ALL
    SELECT e.conv_id, e.r, e.tt, e.text,
      CASE WHEN regexp_matches(g.text, '[.!?]["'')\\]]*\\s*$') OR e.tt - g.tt > 20 OR e.tt - g.start > 30 THEN e.tt ELSE g.start END,
      CASE WHEN regexp_matches(g.text, '[.!?]["'')\\]]*\\s*$') OR e.tt - g.tt > 20 OR e.tt - g.start > 30 THEN e.text ELSE g.joined || ' ' || e.text END,
      CASE WHEN regexp_matches(g.text, '[.!?]["'')\\]]*\\s*$') OR e.tt - g.tt > 20 OR e.tt - g.start > 30 THEN g.g + 1 ELSE g.g END
    FROM g JOIN e ON e.conv_id = g.conv_id AND e.r = g.r + 1),
  o AS (SELECT conv_id, start, joined AS text, g, len(list_filter(regexp_split_to_array(joined, '\\s+'), lambda x: x <> '')) AS words FROM g QUALIFY row_number() OVER (PARTITION BY conv_id, g ORDER BY r DESC) = 1),
  m AS (SELECT conv_id, g, start, text, words, 1 AS k FROM o WHERE g = 1 UNION ALL
    SELECT o.conv_id, o.g, CASE WHEN ends_with(o.text, '?') OR o.words <= 3 OR ends_with(m.text, '?') OR m.words + o.words > 80 OR o.start - m.start > 45 THEN o.start ELSE m.start END,
      CASE WHEN ends_with(o.text, '?') OR o.words <= 3 OR ends_with(m.text, '?') OR m.words + o.words > 80 OR o.start - m.start > 45 THEN o.text ELSE m.text || ' ' || o.text END,
      CASE WHEN ends_with(o.text, '?') OR o.words <= 3 OR ends_with(m.text, '?') OR m.words + o.words > 80 OR o.start - m.start > 45 THEN o.words ELSE m.words + o.words END,
      CASE WHEN ends_with(o.text, '?') OR o.words <= 3 OR ends_with(m.text, '?') OR m.words + o.words > 80 OR o.start - m.start > 45 THEN m.k + 1 ELSE m.k END
    FROM m JOIN o ON o.conv_id = m.conv_id AND o.g = m.g + 1)
  SELECT conv_id, start, text FROM m QUALIFY row_number() OVER (PARTITION BY conv_id, k ORDER BY g DESC) = 1""")
def transcript_groups(t, spark):
    """Sentence groups, then merged neighbours: two sequential folds a conversation."""
    from ..operators import transcripts

    return transcripts.grouped(t("conversations").withColumn("at", F.col("turn") * 7.0), "conv_id", "at", "text", merge=True)


@query("""SELECT domain, '/' AS path, name, domain || chr(9) || 'FALSE' || chr(9) || '/' || chr(9) || 'TRUE' || chr(9) || '0' || chr(9) || name || chr(9) || value AS line FROM (
  SELECT 'u' || user_id || '.example.com' AS domain, event_type AS name, CAST(arg_max(event_id, event_id) AS VARCHAR) AS value FROM events GROUP BY user_id, event_type)""")
def cookie_jar(t, spark):
    from ..sources import exports

    df = t("events").select("event_id", F.concat(F.lit("u"), "user_id", F.lit(".example.com")).alias("domain"), F.lit("/").alias("path"), F.col("event_type").alias("name"), F.col("event_id").cast("string").alias("value"), F.lit(True).alias("secure"), F.lit(None).cast("long").alias("expires"))
    return exports.netscape_cookies(df, "event_id")


@query("SELECT n_nationkey, CAST(p AS INTEGER) AS pos, CASE WHEN p = 0 THEN n_name ELSE 'x' END AS ref, CASE WHEN p = 0 THEN 'a' ELSE n_name END AS note FROM nation, (VALUES (0), (1)) v(p)")
def delimited_scan(t, spark):
    from ..sources import exports

    df = t("nation").select("n_nationkey", F.concat("n_name", F.lit(" | a\n\nx|"), "n_name").alias("text"))
    return exports.delimited(df, "text", ["ref", "note"])


@query("SELECT p_partkey, replace(p_name, 'Part', '[REDACTED]') AS name FROM part")
def redact_protected(t, spark):
    return t("part").select("p_partkey", redact.protected(F.col("p_name"), ["Part"]).alias("name"))


@query("SELECT p_partkey, '---' || chr(10) || 'title: \"' || p_name || '\"' || chr(10) || 'url: \"/p/' || p_partkey || '\"' || chr(10) || '---' || chr(10) || chr(10) || p_type || chr(10) AS doc FROM part")
def article_sink(t, spark):
    from ..sources import exports

    return t("part").select("p_partkey", exports.article(F.col("p_name"), F.concat(F.lit("/p/"), "p_partkey"), F.col("p_type")).alias("doc"))


@query("SELECT s_suppkey, CAST(floor((s_suppkey + 100) * 0.5) AS BIGINT) AS middle, CAST(3 AS BIGINT) AS n FROM supplier")
def evenly_spaced(t, spark):
    from ..operators import windows

    spots = windows.evenly_spaced((F.col("s_suppkey") + 100).cast("double"), 3)
    return t("supplier").select("s_suppkey", spots[1].alias("middle"), F.size(spots).cast("long").alias("n"))


@query("""WITH h AS (SELECT doc_id, text, substr(text, 1, 400) AS head FROM documents), b AS (SELECT *, strpos(reverse(head), chr(10) || chr(10)) AS back FROM h)
  SELECT doc_id, CASE WHEN length(text) <= 400 THEN text WHEN back > 0 AND back < 200 THEN substr(head, 1, 400 - back - 1) ELSE head END AS head FROM b""")
def paragraph_heads(t, spark):
    """The beginning of every text, cut at a blank line where one is near."""
    return t("documents").select("doc_id", text.truncate_at_paragraph(F.col("text"), 400).alias("head"))
