"""JavaScript values of runtime type: VARIANT columns with the coercions that the value at hand asks for.

SQL null is undefined (a path that isn't there); a VARIANT null is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import js

NAN = float("nan")
_KINDS = {"BIGINT": "number", "DOUBLE": "number", "FLOAT": "number", "DECIMAL": "number", "BOOLEAN": "boolean", "VOID": "null", "ARRAY": "array", "OBJECT": "object", "": "undefined"}


def let(f, *cols: Column) -> Column:
    """f over values that are worked out once, however often f's expression names them."""
    bound = F.struct(*[c.alias(f"v{i}") for i, c in enumerate(cols)])
    return F.get(F.transform(F.array(bound), lambda x: f(*[x[f"v{i}"] for i in range(len(cols))])), F.lit(0))


def is_variant(t: T.DataType) -> bool:
    return isinstance(t, T.VariantType)


def kind(c: Column) -> Column:
    """undefined, null, boolean, number, string, array or object."""
    word = F.coalesce(F.regexp_extract(F.schema_of_variant(c), "^[A-Z]+", 0), F.lit(""))
    names = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, F.when(c.isNull(), "").otherwise(word)), F.lit("string"))


def _as(c: Column, path: str, of: str) -> Column:
    return F.try_variant_get(c, path, of)


def text_of(c: Column) -> Column:
    """The string that a value is, null where it is none."""
    return F.when(kind(c) == "string", _as(c, "$", "string"))


def elements(c: Column) -> Column:
    return _as(c, "$", "array<variant>")


def field(c: Column, key) -> tuple[Column, T.DataType]:
    """value[key]: a field of an object, an element of an array; length of arrays and strings."""
    named = "$['" + str(key).replace("\\", "\\\\").replace("'", "\\'") + "']"
    got = _as(c, named, "variant")
    if str(key).isdigit():
        got = F.coalesce(_as(c, f"$[{key}]", "variant"), got)
    if key == "length":
        got = F.coalesce(got, let(lambda x: F.coalesce(F.size(elements(x)), F.length(text_of(x))).cast("long").cast("variant"), c))
    return got, T.VariantType()


def element(c: Column, at: Column) -> tuple[Column, T.DataType]:
    return F.get(elements(c), at.cast("int")), T.VariantType()


def truthy(c: Column) -> Column:
    return let(_truthy, c)


def _truthy(c: Column) -> Column:
    k, n = kind(c), _as(c, "$", "double")
    return F.coalesce(F.when(k == "boolean", _as(c, "$", "boolean")).when(k == "number", (n != 0) & ~F.isnan(n)).when(k == "string", _as(c, "$", "string") != "").otherwise(k.isin("array", "object")), F.lit(False))


def number(c: Column) -> Column:
    """Number(value): arrays count as their joined text, objects and what is missing as NaN."""
    return let(_number, c)


def _number(c: Column) -> Column:
    k = kind(c)
    out = F.when(k == "number", _as(c, "$", "double")).when(k == "null", 0.0).when(k == "boolean", F.when(_as(c, "$", "boolean"), 1.0).otherwise(0.0))
    return F.coalesce(out.when(k.isin("string", "array"), let(js.number_of_string, _string(c, "undefined"))), F.lit(NAN))


def _scalar(c: Column, missing: str, null: str) -> Column:
    k = kind(c)
    out = F.when(k == "undefined", missing).when(k == "null", null).when(k == "number", js.string(_as(c, "$", "double"), T.DoubleType()))
    return out.when(k == "object", "[object Object]").when(k == "array", F.to_json(c)).otherwise(_as(c, "$", "string"))


def string(c: Column, missing: str = "undefined") -> Column:
    """String(value): arrays join their elements, null and missing ones as nothing; arrays inside arrays stay JSON."""
    return let(lambda x: _string(x, missing), c)


def _string(c: Column, missing: str) -> Column:
    joined = F.array_join(F.transform(elements(c), lambda x: _scalar(x, "", "")), ",")
    return F.when(kind(c) == "array", joined).otherwise(_scalar(c, missing, "null"))


def wrapped(c: Column, t: T.DataType) -> Column:
    """A typed value as VARIANT; a null of it is null, not undefined."""
    if is_variant(t):
        return c
    null = F.parse_json(F.lit("null"))
    if isinstance(t, T.NullType):
        return null
    if isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.to_variant_object(c), null)
    return F.coalesce(c.cast("variant"), null)


def equal(a: Column, b: Column, strict: bool) -> Column:
    """=== of runtime types (objects by their content); == also across numbers, strings and booleans, and null with undefined."""
    return let(lambda x, y: _equal(x, y, strict), a, b)


def _equal(a: Column, b: Column, strict: bool) -> Column:
    ka, kb = kind(a), kind(b)
    same = F.when(ka.isin("undefined", "null"), F.lit(True)).when(ka == "number", _number(a) == _number(b)).when(ka == "boolean", _as(a, "$", "boolean") == _as(b, "$", "boolean")).when(ka == "string", _as(a, "$", "string") == _as(b, "$", "string")).otherwise(F.to_json(a) == F.to_json(b))
    same = F.when((ka == "number") & (F.isnan(_number(a)) | F.isnan(_number(b))), False).otherwise(same)
    if strict:
        return F.coalesce((ka == kb) & same, F.lit(False))
    none_a, none_b = ka.isin("undefined", "null"), kb.isin("undefined", "null")
    x, y = _number(a), _number(b)
    return F.coalesce(F.when(none_a | none_b, none_a & none_b).when(ka == kb, same).otherwise((x == y) & ~F.isnan(x) & ~F.isnan(y)), F.lit(False))


def compare(op: str, a: Column, b: Column) -> Column:
    """< > <= >=: texts among themselves by code points, all else as numbers; NaN is never less or more."""
    return let(lambda x, y: _compare(op, x, y), a, b)


def _compare(op: str, a: Column, b: Column) -> Column:
    def by(x: Column, y: Column) -> Column:
        return {"<": x < y, ">": x > y, "<=": x <= y, ">=": x >= y}[op]

    x, y = _number(a), _number(b)
    texts = (kind(a) == "string") & (kind(b) == "string")
    return F.coalesce(F.when(texts, by(text_of(a), text_of(b))).otherwise(by(x, y) & ~F.isnan(x) & ~F.isnan(y)), F.lit(False))


def plus(a: Column, b: Column) -> Column:
    """Texts, arrays and objects are joined as text, all else is added."""
    return let(_plus, a, b)


def _plus(a: Column, b: Column) -> Column:
    texts = kind(a).isin("string", "array", "object") | kind(b).isin("string", "array", "object")
    return F.when(texts, F.concat(_string(a, "undefined"), _string(b, "undefined")).cast("variant")).otherwise((_number(a) + _number(b)).cast("variant"))
