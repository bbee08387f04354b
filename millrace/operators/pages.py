"""Page classifiers, anti-bot evidence and endpoint scores."""

from __future__ import annotations

import json
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import clamp01

#: Headers that describe the response itself; those that decide alone; body markers that decide
#: alone; markers that count only with one of the statuses.
CHALLENGE_HEADERS = r"(?i)^(?:server|cf-mitigated|cf-chl-[\w-]+|x-datadome[\w-]*|set-cookie)$"
DECISIVE_HEADERS = r"(?i)^(?:cf-mitigated|cf-chl-[\w-]+)$"
DECISIVE = r"(?i)cf-chl|cf-mitigated|just a moment|verify you are human|checking your browser|enable javascript and cookies"
CORROBORATING = r"(?i)cloudflare|datadome|perimeterx|px-captcha|akamai|captcha|__cf_bm"
STATUSES = (403, 429, 503)
HEAD = 20_000
#: Vendors in order of precedence, with patterns of cookie names and of bodies.
VENDORS = (
    ("aliyun_waf", (r"^acw_sc__v2$", r"^acw_tc$", r"^ssxmod_itna"), (r"arg1\s*=\s*['\"][0-9A-F]{30,}", r"(?i)/ntc_captcha/")),
    ("cloudflare", (r"^__cf_bm$", r"^cf_clearance$", r"^__cfduid$"), (r"(?i)Cloudflare Ray ID", r"(?i)Checking your browser before accessing", r"(?i)cf-chl-")),
    ("akamai", (r"^_abck$", r"^bm_sz$", r"^bm_sv$"), (r"(?i)akamai",)),
    ("geetest", (), (r"(?i)geetest", r"(?i)gt_captcha")),
)
#: Urls of telemetry; keys that business data has, and that tracking data has.
NOISE_URL = r"(?i)(?:analytics|beacon|collect|telemetry|tracking|sentry|doubleclick|google-analytics|googletagmanager|adservice|/ads?(?:[/?#]|$)|metrics?|pixel|personalization|experiment|/events?(?:[/?#]|$))"
BUSINESS_KEY = r"(?i)^(?:data|items?|results?|records?|list|rows?|edges?|nodes?|timeline|users?|title|name|text|content|body|price|amount|id|url|avatar|nickname|desc|comments?|likes?|shares?|total|page|cursor|next|rank|score|date|time|author)$"
TRACKING_KEY = r"(?i)^(?:event|events|trace|traceid|sessionid|clientid|visitorid|experiment|abtest|beacon|analytics|metrics?|pixel|log|logs)$"


def is_challenge(status: Column, headers: Column, body: Column) -> Column:
    """A challenge page instead of the answer; headers is a map, null headers and body count as empty."""
    head = F.substring(F.coalesce(body, F.lit("")), 1, HEAD)
    pairs = F.map_entries(headers)
    hit = lambda pattern, test: F.coalesce(F.exists(pairs, lambda e: e["key"].rlike(pattern) & test(e)), F.lit(False))
    decisive = hit(DECISIVE_HEADERS, lambda e: e["value"].rlike("(?i)challenge|1")) | head.rlike(DECISIVE)
    named = hit(CHALLENGE_HEADERS, lambda e: F.concat_ws(":", e["key"], e["value"]).rlike(CORROBORATING))
    return decisive | (F.coalesce(status.isin(*STATUSES), F.lit(False)) & (named | head.rlike(CORROBORATING)))


def challenge_of(status: int | None, headers: dict[str, str] | None, body: str | None) -> bool:
    """is_challenge of one answer, for clients."""
    headers, head = headers or {}, (body or "")[:HEAD]
    if re.search(DECISIVE, head) or any(re.search(DECISIVE_HEADERS, k) and re.search("(?i)challenge|1", v) for k, v in headers.items()):
        return True
    named = "\n".join(f"{k}:{v}" for k, v in headers.items() if re.search(CHALLENGE_HEADERS, k))
    return status in STATUSES and bool(re.search(CORROBORATING, f"{named}\n{head}"))


def is_js_shell(body: Column) -> Column:
    """An app root, at least one script, and under 500 characters besides scripts and tags."""
    root = body.rlike(r"""(?i)<(?:div|main)[^>]+(?:id|data-[^=]+)=["'](?:root|app)["']""")
    left = F.regexp_replace(F.regexp_replace(body, r"(?i)<script[\s\S]*?</script>", ""), r"<[^>]+>", "")
    return F.coalesce(root & body.rlike(r"(?i)<script\b") & (F.length(F.regexp_replace(left, r"^\s+|\s+$", "")) < 500), F.lit(False))


def is_login_wall(content_type: Column, body: Column) -> Column:
    """A page where JSON was asked for: by its type, or by what the body starts with."""
    html = F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("text/html"))
    return html | F.coalesce(body.rlike(r"(?i)^\s*<(?:!doctype|html|head|body|title)(?:[\s>/]|$)"), F.lit(False))


def vendor(cookies: Column, bodies: Column) -> Column:
    """The first vendor with a matching cookie name (array) or captured body (array); null without any."""

    def some(values: Column, patterns: tuple[str, ...]) -> Column:
        if not patterns:
            return F.lit(False)
        hit = lambda x: F.coalesce(reduce(lambda a, b: a | b, [x.rlike(p) for p in patterns]), F.lit(False))
        return F.coalesce(F.exists(values, hit), F.lit(False))

    out = F.lit(None).cast("string")
    for name, of_cookies, of_bodies in reversed(VENDORS):
        out = F.when(some(cookies, of_cookies) | some(bodies, of_bodies), name).otherwise(out)
    return out


def _count(value, pattern: re.Pattern, depth: int = 0) -> int:
    if depth > 4 or not isinstance(value, (dict, list)):
        return 0
    if isinstance(value, list):
        return sum(_count(x, pattern, depth + 1) for x in value[:3])
    return sum(bool(pattern.search(k)) + _count(x, pattern, depth + 1) for k, x in value.items())


def _has_items(value, depth: int = 0) -> bool:
    if depth > 4 or not isinstance(value, (dict, list)):
        return False
    return len(value) > 0 if isinstance(value, list) else any(_has_items(x, depth + 1) for x in value.values())


def evidence_of(body: str | None) -> dict:
    """What a captured body says: a text, an array or an object, and what its keys look like (to depth 4)."""
    out = dict.fromkeys(("html", "words", "items", "keys", "business", "tracking", "nested"))
    text = (body or "").strip()
    if not text:
        return out
    try:
        value = json.loads(text)
    except ValueError:
        value = text
    if isinstance(value, str):
        out["html"] = bool(re.search(r"^\s*<|<!doctype html|<html", value, re.I))
        out["words"] = len(value.strip())
    elif isinstance(value, list):
        out["items"] = len(value)
    elif isinstance(value, dict):
        out |= {"keys": len(value), "business": _count(value, re.compile(BUSINESS_KEY)), "tracking": _count(value, re.compile(TRACKING_KEY)), "nested": _has_items(value)}
    return out


_EVIDENCE = T.StructType([T.StructField(k, T.BooleanType() if k in ("html", "nested") else T.LongType()) for k in ("html", "words", "items", "keys", "business", "tracking", "nested")])


@F.pandas_udf(_EVIDENCE)
def body_evidence(bodies: pd.Series) -> pd.DataFrame:
    """evidence_of in Arrow batches: keys are counted through nested JSON of any shape."""
    return pd.DataFrame([evidence_of(b) for b in bodies], columns=_EVIDENCE.names, dtype=object)


def endpoint_score(status: Column, content_type: Column, noisy: Column, items: Column, keys: Column, business: Column, tracking: Column, nested: Column | None = None, html: Column | None = None, words: Column | None = None) -> Column:
    """0 to 1: how likely a response is data; 401 and 403 are 0.05.

    items: length of a top-level array; keys, business, tracking, nested: of a top-level object; html, words: of a
    body that is no JSON.  All are null where they don't apply.
    """
    nested, html, words = (x if x is not None else F.lit(None).cast(t) for x, t in ((nested, "boolean"), (html, "boolean"), (words, "long")))
    t = F.lower(F.coalesce(content_type, F.lit("")))
    s = F.when((status >= 200) & (status < 300), 0.15).otherwise(0.0)
    s = s + F.when(F.contains(t, F.lit("json")), 0.20).when(F.contains(t, F.lit("html")), -0.25).when(t.rlike("javascript|text"), 0.05).otherwise(0.0)
    s = s + F.when(noisy, -0.30).otherwise(0.0)
    s = s + F.when(html, -0.25).when(words > 20, 0.05).otherwise(0.0)
    s = s + F.when(items > 0, 0.30).when(items == 0, -0.15).otherwise(0.0)
    s = s + F.when(keys == 0, -0.15).when(keys > 0, 0.12).otherwise(0.0)
    s = s + F.when(business.isNotNull(), F.least(F.lit(0.30), 0.05 * business)).otherwise(0.0)  # least() skips nulls
    s = s + F.when(nested, 0.20).otherwise(0.0)
    s = s - F.when(business == 0, F.least(F.lit(0.25), 0.08 * tracking)).otherwise(0.0)
    return F.when(status.isin(401, 403), 0.05).otherwise(clamp01(s))


def evidence_class(score: Column, status: Column | None = None) -> Column:
    graded = F.when(score >= 0.65, "likely_data").when(score >= 0.35, "maybe_data").otherwise("noise")
    return graded if status is None else F.when(status.isin(401, 403), "blocked").otherwise(graded)


def top_evidence(responses: DataFrame, site: str, order: str, most: int = 8) -> DataFrame:
    """The responses of each site that may be data, best score first, ties in order: rank from 1, at most `most`.

    responses: site, order, score and verdict columns.  Noise with a score of 0 is no evidence.
    """
    w = Window.partitionBy(site).orderBy(F.desc("score"), order)
    some = responses.where((F.col("verdict") != "noise") | (F.col("score") > 0))
    return some.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= most)


def site_patterns(responses: DataFrame, site: str, order: str, ssr: Column) -> DataFrame:
    """(site, auth_failures, json_responses, candidates, pattern) from captured responses (status, content_type, score,
    verdict); candidates are counted among the evidence of `top_evidence`, as a reader of a report sees it."""
    json_type = F.coalesce(F.col("content_type").rlike("(?i)json"), F.lit(False))
    all_of = responses.groupBy(site).agg(F.count_if(F.col("status").isin(401, 403)).alias("auth_failures"), F.count_if(json_type).alias("json_responses"), F.bool_or(ssr).alias("_ssr"))
    good = top_evidence(responses, site, order).groupBy(site).agg(F.count_if(F.col("verdict").isin("likely_data", "maybe_data")).alias("candidates"))
    both = all_of.join(good, site, "left").withColumn("candidates", F.coalesce("candidates", F.lit(0)))
    return both.select(site, "auth_failures", "json_responses", "candidates", site_pattern(F.col("auth_failures"), F.col("json_responses"), F.col("_ssr"), F.col("candidates")).alias("pattern"))


def site_pattern(auth_failures: Column, json_responses: Column, ssr: Column, candidates: Column) -> Column:
    """D, B, A or C by the decision tree over a site's aggregates."""
    return F.when((auth_failures >= 2) & (json_responses >= 1), "D").when(ssr, "B").when(candidates >= 1, "A").otherwise("C")
