"""The 18 template filters, each Column -> Column; a filter on a type it doesn't apply to leaves the value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import js


def default(c: Column, t: T.DataType, value: str = "") -> tuple[Column, T.DataType]:
    """Replaces null and ''; the argument is an integer if it reads as one."""
    if isinstance(t, T.StringType):
        return F.coalesce(F.when(c != "", c), F.lit(value)), t
    if isinstance(t, T.NullType):
        n = value if isinstance(value, int) else int(value) if str(value).lstrip("-").isdigit() and str(int(value)) == value else None
        return (F.lit(n), T.LongType()) if n is not None else (F.lit(value), T.StringType())
    if js.is_numeric(t):
        n = value if isinstance(value, (int, float)) else int(value) if str(value).lstrip("-").isdigit() else None
        return (F.coalesce(c, F.lit(n)), t) if n is not None else (F.coalesce(js.string(F.when(c.isNotNull(), c), t), F.lit(value)), T.StringType())
    return c, t


def join(c: Column, t: T.DataType, sep: str = ", ") -> tuple[Column, T.DataType]:
    if not isinstance(t, T.ArrayType):
        return c, t
    return F.array_join(F.transform(c, lambda x: js.string(x, t.elementType, "")), sep), T.StringType()


def _on_string(f: Callable[..., Column]):
    def run(c: Column, t: T.DataType, *args) -> tuple[Column, T.DataType]:
        return (f(c, *args), t) if isinstance(t, T.StringType) else (c, t)

    return run


def _truncate(c: Column, n: int | str = 50) -> Column:
    n = int(n)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def keys(c: Column, t: T.DataType) -> tuple[Column, T.DataType]:
    out = T.ArrayType(T.StringType())
    if isinstance(t, T.MapType):
        return F.map_keys(c).cast("array<string>"), out
    if isinstance(t, T.StructType):
        return F.when(c.isNotNull(), F.array(*[F.lit(n) for n in t.names])), out
    if isinstance(t, T.ArrayType):
        return F.when(F.size(c) == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(c) - 1), lambda i: i.cast("string"))), out
    return c, t


def length(c: Column, t: T.DataType) -> tuple[Column, T.DataType]:
    if isinstance(t, T.ArrayType):
        return F.when(c.isNotNull(), F.size(c)), T.IntegerType()
    return (F.length(c), T.IntegerType()) if isinstance(t, T.StringType) else (c, t)


def _element(i: int):
    def run(c: Column, t: T.DataType) -> tuple[Column, T.DataType]:
        return (F.try_element_at(c, F.lit(i)), t.elementType) if isinstance(t, T.ArrayType) else (c, t)

    return run


def json(c: Column, t: T.DataType) -> tuple[Column, T.DataType]:
    """JSON text of any value; a missing value is null."""
    if isinstance(t, T.StringType):
        text = F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"^\{\"v\":(.*)\}$", 1)
        return F.when(c.isNull(), "null").otherwise(text), T.StringType()
    if isinstance(t, (T.StructType, T.MapType, T.ArrayType)):
        return F.coalesce(F.to_json(c), F.lit("null")), T.StringType()
    return js.string(c, t), T.StringType()


def _slugify(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "-"), "^-|-$", "")


def _ext(c: Column) -> Column:
    return F.regexp_extract(c, r"(\.[^./\\]*)$", 1)


def _basename(c: Column) -> Column:
    last = F.element_at(F.split(c, r"[/\\]"), -1)
    return F.when(last == "", c).otherwise(last)


def url_encode(c: Column) -> Column:
    """encodeURIComponent: form encoding with spaces as %20 and !'()*~ left alone."""
    out = F.url_encode(c)
    for a, b in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def url_decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


FILTERS: dict[str, Callable[..., tuple[Column, T.DataType]]] = {
    "default": default,
    "join": join,
    "upper": _on_string(F.upper),
    "lower": _on_string(F.lower),
    "trim": _on_string(js.trim),
    "truncate": _on_string(_truncate),
    "replace": _on_string(lambda c, a="", b="": F.replace(c, F.lit(a), F.lit(b)) if a else c),
    "keys": keys,
    "length": length,
    "first": _element(1),
    "last": _element(-1),
    "json": json,
    "slugify": _on_string(_slugify),
    "sanitize": _on_string(lambda c: F.regexp_replace(c, r'[<>:"/\\|?*\x00-\x1f]', "_")),
    "ext": _on_string(_ext),
    "basename": _on_string(_basename),
    "urlencode": _on_string(url_encode),
    "urldecode": _on_string(url_decode),
}
