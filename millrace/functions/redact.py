"""Redaction of secrets in URLs, headers, text and nested values."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MASK = "[REDACTED]"
#: Names of headers whose values are secret.
HEADERS = ("authorization", "cookie", "set-cookie", "proxy-authorization", "x-api-key", "x-auth-token", "x-csrf-token", "x-xsrf-token")
#: Fixed value: fields with such a name are secret, wherever the name holds one of these.
KEYS = r"(?i)(password|passwd|pwd|token|secret|authorization|cookie|set-cookie|api[_-]?key|access[_-]?token|refresh[_-]?token|session[_-]?id|csrf|xsrf)"
#: Fixed value: query parameters whose values are secret, also after an escaped ampersand.
PARAMETERS = r"""(?i)(\?|&(?:amp;)?)(token|key|secret|password|auth|access_token|api_key|session_id|csrf|xsrf)=[^&"'\s<>]*"""
USER = r"(?i)(https?://)[^/\s@]+@"
#: Patterns of secrets in text and what stands for them, in this order.
RULES = (
    (r"(?i)\b(Bearer|Basic|Negotiate|NTLM)\s+[A-Za-z0-9\-._~+/]+=*", "$1 [REDACTED]"),
    (r"""(?i)(["'])(password|passwd|pwd|token|secret|api_key|apikey|access_token|session_id)\1\s*:\s*(["'])(.*?)\3""", "$1$2$1:$3[REDACTED]$3"),
    (r"""(?i)(token|secret|password|api_key|apikey|access_token|session_id)[=:]\s*['"]?[^'"\s,;}&]+['"]?""", "$1=[REDACTED]"),
    (r"(?i)(cookie[=:]\s*)[^\n;]{3,}", "$1[REDACTED]"),
    (r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", "[REDACTED_JWT]"),
)
#: What a text must hold for a rule to match: a cheap test that spares most texts the pattern.
_HINTS = (r"(?i)(bearer|basic|negotiate|ntlm)\s", r"""(?i)(password|passwd|pwd|token|secret|api_?key|session_id)["']""", r"(?i)(token|secret|password|api_?key|session_id)[=:]", r"(?i)cookie[=:]", "eyJ")
#: What a text that any rule matches holds: the hints in one pattern, so that other texts are read once.
_ANY = r"""(?i)(?:bearer|basic|negotiate|ntlm)\s|(?:password|passwd|pwd|token|secret|api_?key|session_id)["'=:]|cookie[=:]|eyJ"""
MOST = 50_000
DEPTH, ITEMS, FIELDS = 5, 100, 100
DEEP = "[truncated: max depth reached]"


def url(c: Column) -> Column:
    """User information, and values of secret query parameters."""
    return F.regexp_replace(F.regexp_replace(c, USER, "$1[REDACTED]@"), PARAMETERS, "$1$2=[REDACTED]")


def _bound(c: Column, f) -> Column:
    """f of a value worked out once; written out, each use in f would work it out again, and uses within uses multiply."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def text(c: Column, most: int = MOST) -> Column:
    """Auth schemes, quoted secrets, key=value secrets, cookies and JWTs; then cut, saying how much is left out."""

    def rule(pattern: str, to: str, hint: str):
        return lambda x: F.when(x.rlike(hint), F.regexp_replace(x, pattern, to)).otherwise(x)

    ruled = c
    for (pattern, to), hint in zip(RULES, _HINTS, strict=True):
        ruled = _bound(ruled, rule(pattern, to, hint))

    def cut(x: Column) -> Column:
        rest = F.concat(F.lit("\n...[truncated, "), (F.length(x) - most).cast("string"), F.lit(" chars omitted]"))
        return F.when(F.length(x) > most, F.concat(F.substring(x, 1, most), rest)).otherwise(x)

    return F.when(c.rlike(_ANY), _bound(ruled, cut)).otherwise(cut(c))


def _open(allow: tuple[str, ...]) -> list[str]:
    return [a.lower() for a in allow]


def headers(c: Column, allow: tuple[str, ...] = ()) -> Column:
    """A map of headers: secret ones masked, as are other names that say so; the rest redacted as text."""
    keep = _open(allow)

    def one(k, v):
        lower = F.lower(k)
        return F.when((lower.isin(*HEADERS) | k.rlike(KEYS)) & ~lower.isin(*keep), MASK).otherwise(text(v))

    return F.transform_values(c, one)


def value(c: Column, t: T.DataType, depth: int = 0, name: str | None = None, allow: tuple[str, ...] = (), most_depth: int = DEPTH, most_items: int = ITEMS, most_fields: int = FIELDS) -> Column:
    """Nested values, driven by the schema.

    Fields and map keys with secret names are masked, whatever their type; texts redacted (a field `url` as a URL).
    From most_depth on, a container is the text DEEP.  An array of texts over most_items ends with a text that
    says how many were left out; other arrays are cut to most_items, as their elements can't hold a text.
    A struct over most_fields gets a field __truncated__.  Numbers and booleans stay.
    """
    if name is not None and re.search(KEYS, name) and name.lower() not in _open(allow):
        return F.lit(MASK)
    if isinstance(t, T.StringType):
        return url(c) if name == "url" else text(c)
    if not isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
        return c
    if depth >= most_depth:
        return F.when(c.isNotNull(), F.lit(DEEP))
    down = dict(allow=allow, most_depth=most_depth, most_items=most_items, most_fields=most_fields)
    if isinstance(t, T.ArrayType):
        out = F.transform(F.slice(c, 1, most_items), lambda x: value(x, t.elementType, depth + 1, **down))
        if not isinstance(t.elementType, T.StringType):
            return out
        more = F.concat(F.lit("[truncated, "), (F.size(c) - most_items).cast("string"), F.lit(" items omitted]"))
        return F.when(F.size(c) > most_items, F.concat(out, F.array(more))).otherwise(out)
    if isinstance(t, T.MapType):
        if not isinstance(t.valueType, T.StringType):
            return F.transform_values(c, lambda k, v: value(v, t.valueType, depth + 1, **down))
        if name is not None and "headers" in name.lower():
            return headers(c, allow)
        secret = lambda k: k.rlike(KEYS) & ~F.lower(k).isin(*_open(allow))
        return F.transform_values(c, lambda k, v: F.when(secret(k), MASK).when(F.lower(k) == "url", url(v)).otherwise(text(v)))
    fields = [value(c.getField(f.name), f.dataType, depth + 1, "url" if f.name.lower() == "url" else f.name, **down).alias(f.name) for f in t.fields[:most_fields]]
    if len(t.fields) > most_fields:
        fields.append(F.lit(f"[{len(t.fields) - most_fields} fields omitted]").alias("__truncated__"))
    return F.when(c.isNotNull(), F.struct(*fields))


def protected(c: Column, values: list[str]) -> Column:
    """Given values masked wherever they stand: short ones (to 3 characters) only as whole words, single letters only
    as the whole text or after an answer label."""
    for v in sorted(values, key=len, reverse=True):
        q = re.escape(v)
        if len(v) > 3:
            c = F.replace(c, F.lit(v), F.lit(MASK))
        elif len(v) > 1:
            c = F.regexp_replace(c, rf"(?<![A-Za-z0-9]){q}(?![A-Za-z0-9])", MASK)
        elif v:
            c = F.when(F.trim(c) == v, MASK).otherwise(F.regexp_replace(c, rf"(?i)(\b(?:answer|option|choice)\s*[:=]?\s*){q}(?![A-Za-z0-9])", r"$1\[REDACTED\]"))
    return c
