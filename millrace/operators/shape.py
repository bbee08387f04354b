"""Shapes of JSON values: a flat map from path to type."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEPTH, TEXT, BYTES = 6, 80, 2048
#: Texts whose shapes are Python values at once; of a batch's others there are Arrow's bytes only.
SLICE = 512


def shape_of(value, path: str = "$", depth: int = 0, out: dict[str, str] | None = None) -> dict[str, str]:
    """Objects by key, arrays by their first element, long texts with their length; to DEPTH levels and BYTES bytes."""
    out = {} if out is None else out
    if sum(len(k) + len(v) for k, v in out.items()) > BYTES:
        out.setdefault("$truncated", "true")
        return out
    if isinstance(value, dict):
        out[path] = "object" if value else "object(empty)"
        if depth < DEPTH:
            for k, v in value.items():
                shape_of(v, f"{path}.{k}" if k.isidentifier() else f"{path}[{json.dumps(k)}]", depth + 1, out)
    elif isinstance(value, list):
        out[path] = f"array({len(value)})"
        if value and depth < DEPTH:
            shape_of(value[0], f"{path}[0]", depth + 1, out)
    elif isinstance(value, str):
        out[path] = f"string(len={len(value)})" if len(value) > TEXT else "string"
    else:
        out[path] = "null" if value is None else "boolean" if isinstance(value, bool) else "number"
    return out


def shapes_of(texts: pa.Array) -> pa.Array:
    """Shapes of JSON texts as an array of maps; a text that doesn't parse has none."""
    def one(x):
        try:
            return shape_of(json.loads(x))
        except (TypeError, ValueError):
            return None

    def part(at: int):
        found = [one(x) for x in texts.slice(at, SLICE).to_pylist()]
        offsets, n = [], 0
        for x in found:
            offsets.append(None if x is None else n)
            n += len(x or ())
        paths, kinds = [k for x in found for k in x or ()], [v for x in found for v in (x or {}).values()]
        return pa.MapArray.from_arrays(pa.array([*offsets, n], pa.int32()), pa.array(paths, pa.string()), pa.array(kinds, pa.string()))

    return pa.concat_arrays([part(at) for at in range(0, max(1, len(texts)), SLICE)])


@F.arrow_udf(T.MapType(T.StringType(), T.StringType()))
def shape(texts: pa.Array) -> pa.Array:
    """Shape of JSON texts; a text that doesn't parse has none."""
    return shapes_of(texts)


def has_fields(shapes: Column, fields: list[str]) -> Column:
    """Every field is a segment of some path."""
    segments = F.flatten(F.transform(F.map_keys(shapes), lambda p: F.split(F.regexp_replace(p, r"\[\d+\]", ""), r"\.")))
    return F.size(F.array_except(F.array(*map(F.lit, fields)), segments)) == 0
