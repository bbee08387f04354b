"""Number, date and URL scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compact_number(c: Column, missing: int | None = 0) -> Column:
    """1.2K, 3M, 1,234 -> whole number; text without a number -> missing.  A unit follows its number at once."""
    t = F.replace(F.lower(c), F.lit(","), F.lit(""))
    pattern = r"(\d+(?:\.\d+)?)(k|m)?"
    n = F.regexp_extract(t, pattern, 1).try_cast("double")
    unit = F.regexp_extract(t, pattern, 2)
    scale = F.when(unit == "k", 1e3).when(unit == "m", 1e6).otherwise(1.0)
    return F.coalesce(F.floor(n * scale + 0.5), F.lit(missing)).cast("long")


#: Fixed symbols of currencies.
CURRENCIES = {"$": "USD", "€": "EUR", "£": "GBP", "₹": "INR", "¥": "JPY"}


def price(c: Column) -> Column:
    """struct(text, value, currency) of the first price in a text."""
    text = F.regexp_extract(c, r"([$€£₹¥]\s*\d[\d,]*(?:\.\d+)?)", 1)
    symbol = F.substring(text, 1, 1)
    code = F.lit(None).cast("string")
    for s, k in CURRENCIES.items():
        code = F.when(symbol == s, k).otherwise(code)
    return F.struct(F.nullif(text, F.lit("")).alias("text"), F.regexp_replace(text, r"[^\d.]", "").try_cast("double").alias("value"), code.alias("currency"))


def digits_only(c: Column) -> Column:
    """A count such as 1,234, else null."""
    t = F.replace(F.trim(c), F.lit(","), F.lit(""))
    return F.when(t.rlike(r"^\d+$"), t.try_cast("long"))


_UNITS = ("B", "KB", "MB", "GB", "TB")


def parse_bytes(c: Column) -> Column:
    """'1.5MB' -> bytes, base 1024; bare numbers are bytes; anything else is null."""
    t = F.upper(F.trim(c))
    pattern = r"^(\d+(?:\.\d+)?)\s*([KMGT]?B)?$"
    unit = F.regexp_extract(t, pattern, 2)
    scale = F.lit(1.0)
    for i, u in enumerate(_UNITS):
        scale = F.when(unit == u, float(1024**i)).otherwise(scale)
    return F.when(t.rlike(pattern), F.floor(F.regexp_extract(t, pattern, 1).try_cast("double") * scale + 0.5).cast("long"))


def format_bytes(c: Column) -> Column:
    """1536 -> 1.5 KB."""
    out = F.concat(c.cast("string"), F.lit(" B"))
    for i, u in enumerate(_UNITS[1:], 1):
        scaled = F.floor(c / float(1024**i) * 10 + 0.5) / 10
        out = F.when(c >= 1024**i, F.concat(scaled.cast("string"), F.lit(f" {u}"))).otherwise(out)
    return out


def clock(c: Column) -> Column:
    """Seconds as m:ss, or h:mm:ss from an hour on."""
    s = c.cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    h, m, r = F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60
    return F.when(h > 0, F.concat(h.cast("string"), F.lit(":"), two(m), F.lit(":"), two(r))).otherwise(F.concat(m.cast("string"), F.lit(":"), two(r)))


def clamp01(c: Column) -> Column:
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)) * 100 + 0.5) / 100


def token_estimate(c: Column) -> Column:
    return F.ceil(F.length(c) / 4).cast("long")


def months(c: Column, semester: int = 6) -> Column:
    """'2 years', '3 semesters', '18 months' -> months."""
    n = F.regexp_extract(c, r"(\d+(?:\.\d+)?)", 1).try_cast("double")
    t = F.lower(c)
    return F.when(F.contains(t, F.lit("semester")), n * semester).when(F.contains(t, F.lit("year")), n * 12).when(F.contains(t, F.lit("month")), n)


def epoch_date(c: Column, millis: bool = False) -> Column:
    """Epoch seconds (or milliseconds) -> YYYY-MM-DD in UTC; null -> ''."""
    t = F.timestamp_millis(c.cast("long")) if millis else F.timestamp_seconds(c.cast("long"))
    return F.coalesce(F.date_format(t, "yyyy-MM-dd"), F.lit(""))


def is_iso_date(c: Column) -> Column:
    """A calendar date that exists, written YYYY-MM-DD."""
    return F.coalesce(c.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(c, "yyyy-MM-dd").isNotNull(), F.lit(False))


def force_z(c: Column) -> Column:
    """Fractions of seconds off, Z at the end."""
    return F.concat(F.regexp_replace(F.regexp_replace(c, r"\.\d+", ""), "Z$", ""), F.lit("Z"))


def minute_of_day(c: Column, zone: str) -> Column:
    t = F.from_utc_timestamp(c, zone)
    return (F.hour(t) * 60 + F.minute(t)).cast("long")


def relative_token(c: Column) -> Column:
    """3d, 2mo, 5h in a text, or ''."""
    return F.regexp_extract(c, r"(?:^|\s)(\d+\s?(?:mo|yr|[smhdwy]))(?:\s|$|\W)", 1)


def seconds_nanos_iso(seconds: Column, nanos: Column) -> Column:
    return F.date_format(F.timestamp_micros(seconds.cast("long") * 1_000_000 + F.floor(nanos / 1000).cast("long")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def date_range(c: Column) -> Column:
    """'Jan 2020 - Present' -> struct(start, end)."""
    parts = F.split(c, r"\s+[-–—]\s+")
    return F.struct(F.trim(F.get(parts, F.lit(0))).alias("start"), F.trim(F.get(parts, F.lit(1))).alias("end"))


def host(c: Column) -> Column:
    """Lower-case host of a URL."""
    return F.lower(F.regexp_extract(c, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def path(c: Column) -> Column:
    return F.regexp_extract(c, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def in_domain(h: Column, domain: Column) -> Column:
    """The domain itself or a subdomain of it."""
    return (h == domain) | F.endswith(h, F.concat(F.lit("."), domain))


#: Ports that a URL of the scheme doesn't write.
PORTS = {"http": "80", "https": "443"}


def authority(c: Column) -> Column:
    """Host and port of a URL, the scheme's own port left out."""
    scheme = F.lower(F.regexp_extract(c, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1))
    port = F.regexp_extract(c, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?[^/?#:]+:(\d+)", 1)
    usual = F.lit(False)
    for k, v in PORTS.items():
        usual = usual | ((scheme == k) & (port == v))
    return F.when((port == "") | usual, host(c)).otherwise(F.concat(host(c), F.lit(":"), port))


def request_key(method: Column, url: Column) -> Column:
    """GraphQL operation of the path where there is one, else METHOD host+path; what is no URL is cut at 120 characters."""
    p = path(url)
    p = F.when(p == "", "/").otherwise(p)
    parts = F.filter(F.split(p, "/"), lambda x: x != "")
    tail = F.slice(parts, F.array_position(parts, "graphql").cast("int") + 1, F.size(parts) + 1)
    operation = F.when(F.contains(p, F.lit("/graphql/")) & (F.array_position(parts, "graphql") > 0), F.coalesce(F.get(tail, F.lit(1)), F.get(tail, F.lit(0))))
    m = F.upper(method)
    raw = F.when(F.length(url) <= 120, url).otherwise(F.concat(F.substring(url, 1, 119), F.lit("…")))
    is_url = url.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?[^/?#:\s]+")
    return F.when(is_url, F.coalesce(operation, F.concat(m, F.lit(" "), authority(url), p))).otherwise(F.concat(m, F.lit(" "), raw))
