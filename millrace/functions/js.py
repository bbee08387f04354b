"""JavaScript value semantics on Columns: truthiness, Number(), String(), natural order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
#: Decimal numerals that Number() accepts; hexadecimal is handled apart.
_DECIMAL = r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)$"
_HEX = r"^0[xX][0-9a-fA-F]{1,15}$"
_JS_SPACE = r"[\s ﻿  -     　]"


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC)


def trim(c: Column) -> Column:
    """String.prototype.trim: all Unicode space, not only U+0020."""
    return F.regexp_replace(c, f"^{_JS_SPACE}+|{_JS_SPACE}+$", "")


def truthy(c: Column, dtype: T.DataType) -> Column:
    """null, false, 0, NaN and '' are falsy; everything else, '0' and empty arrays included, is truthy. Never null."""
    if isinstance(dtype, T.VariantType):
        return variant.truthy(c)
    if isinstance(dtype, T.NullType):
        return F.lit(False)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.coalesce((c != 0) & ~F.isnan(c), F.lit(False))
    if is_numeric(dtype):
        return F.coalesce(c != 0, F.lit(False))
    if isinstance(dtype, T.StringType):
        return F.coalesce(c != "", F.lit(False))
    return c.isNotNull()


def number_of_string(c: Column) -> Column:
    """Number(string): '' is 0, hexadecimal and padded numerals count, anything else is NaN; null stays null."""
    t = trim(c)
    nan = F.lit(float("nan"))
    value = (
        F.when(t == "", F.lit(0.0))
        .when(t.rlike(_HEX), F.conv(F.substring(t, 3, 15), 16, 10).cast("double"))
        .when(t.rlike(_DECIMAL), t.try_cast("double"))
        .when(t.isin("Infinity", "+Infinity"), F.lit(float("inf")))
        .when(t == "-Infinity", F.lit(float("-inf")))
        .otherwise(nan)
    )
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(value)


def number(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.VariantType):
        return variant.number(c)
    if isinstance(dtype, T.NullType):
        return F.lit(0.0)
    if isinstance(dtype, T.StringType):
        return F.coalesce(number_of_string(c), F.lit(float("nan")))
    if isinstance(dtype, T.BooleanType):
        return F.when(c, 1.0).otherwise(0.0)
    if is_numeric(dtype):
        return F.coalesce(c.cast("double"), F.lit(0.0))
    return F.lit(float("nan"))


def string(c: Column, dtype: T.DataType, missing: str = "null") -> Column:
    """String(x): whole doubles print without a fraction; null prints as `missing`."""
    if isinstance(dtype, T.VariantType):
        return variant.string(c, "undefined" if missing == "null" else missing)  # SQL null is undefined here
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
        text = F.when(F.isnan(c), "NaN").when(whole, F.when(F.abs(c) < 1e15, c).cast("long").cast("string")).otherwise(c.cast("string"))
    elif isinstance(dtype, T.ArrayType):
        text = F.array_join(c.cast("array<string>"), ",", "")
    elif isinstance(dtype, (T.StructType, T.MapType)):
        text = F.lit("[object Object]")
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(missing))


def round_half_up(c: Column, digits: int = 2) -> Column:
    """Math.round(x * 10**digits) / 10**digits: halves go towards +infinity."""
    scale = float(10**digits)
    return F.floor(c.cast("double") * scale + 0.5) / scale


def natural_key(c: Column) -> Column:
    """Sorts like a numeric-aware comparison on ASCII: digit runs by value, other runs by lower case; null is ''."""
    runs = F.regexp_extract_all(F.lower(F.coalesce(c.cast("string"), F.lit(""))), F.lit(r"\d+|\D+"), F.lit(0))
    return F.transform(runs, lambda r: F.when(r.rlike(r"^\d"), F.concat(F.lit("0"), F.lpad(F.regexp_replace(r, "^0+", ""), 40, "0"))).otherwise(F.concat(F.lit("1"), r)))


from . import variant  # noqa: E402  its coercions need those above
