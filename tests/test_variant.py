"""Expressions over values of runtime type, against the same expressions worked out by JavaScript's rules in Python."""

import json
import math

import pytest
from pyspark.sql import functions as F

from millrace.plans.pipeline import run

VALUES = [1, 0, -2.5, 10, "10", "2", "", "abc", " 7 ", True, False, None, [], [1, 2], ["a", None], [5], {"k": 1}, "MISSING"]


def kind(v):
    return "undefined" if v == "MISSING" else "null" if v is None else "boolean" if isinstance(v, bool) else "number" if isinstance(v, (int, float)) else "string" if isinstance(v, str) else "array" if isinstance(v, list) else "object"


def text(v):
    k = kind(v)
    if k == "array":
        return ",".join("" if x is None else text(x) for x in v)
    return {"undefined": "undefined", "null": "null", "object": "[object Object]"}.get(k) or (str(v).lower() if k == "boolean" else (str(int(v)) if v == int(v) else str(v)) if k == "number" else v)


def number(v):
    k = kind(v)
    if k in ("string", "array"):
        s = text(v).strip()
        try:
            return float(s) if s else 0.0
        except ValueError:
            return math.nan
    return {"undefined": math.nan, "null": 0.0, "object": math.nan}[k] if k in ("undefined", "null", "object") else float(v)


def truthy(v):
    return kind(v) in ("array", "object") or kind(v) in ("boolean", "number", "string") and bool(v)


def strict(a, b):
    return kind(a) == kind(b) and (kind(a) in ("undefined", "null") or a == b)


def less(a, b):
    return a < b if kind(a) == kind(b) == "string" else number(a) < number(b)


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i * 100 + j, json.dumps({k: v for k, v in (("a", a), ("b", b)) if v != "MISSING"} | {"deep": {"list": [{"x": i}, {"x": j}]}})) for i, a in enumerate(VALUES) for j, b in enumerate(VALUES)]
    return spark.createDataFrame(data, "id long, raw string").repartition(3)


def pairs():
    return {i * 100 + j: (a, b) for i, a in enumerate(VALUES) for j, b in enumerate(VALUES)}


CASES = {
    "item.v.a === item.v.b": strict,
    "item.v.a !== 10": lambda a, b: not strict(a, 10),
    "item.v.a == '10'": lambda a, b: False if kind(a) in ("undefined", "null") else text(a) == "10" if kind(a) == "string" else number(a) == 10,
    "item.v.a < item.v.b": less,
    "item.v.a > 1": lambda a, b: number(a) > 1,
    "item.v.a >= '2'": lambda a, b: a >= "2" if kind(a) == "string" else number(a) >= 2,
    "!item.v.a": lambda a, b: not truthy(a),
    "item.v.a && item.v.b": lambda a, b: truthy(a) and truthy(b),
    "item.v.a == null": lambda a, b: kind(a) in ("undefined", "null"),
    "(item.v.a ?? 3) === 3": lambda a, b: kind(a) in ("undefined", "null"),
    "item.v.a.includes(1)": lambda a, b: 1 in a if kind(a) == "array" else "1" in a if kind(a) == "string" and a != "MISSING" else False,
}


@pytest.mark.parametrize("expr", CASES)
def test_conditions(rows, expr):
    got = {r.id for r in run([{"filter": expr}], rows.select("id", F.parse_json("raw").alias("v")), ["id"], ordered=False).collect()}
    assert got == {i for i, (a, b) in pairs().items() if CASES[expr](a, b)}


def test_mapped_values(rows):
    steps = [{"map": {
        "id": "${{ item.id }}", "n": "${{ Number(item.v.a) }}", "t": "${{ String(item.v.a) }}", "mixed": "<${{ item.v.a }}>", "sum": "${{ String(item.v.a + item.v.b) }}", "product": "${{ item.v.a * 2 }}", "or": "${{ String(item.v.a || 'none') }}",
        "upper": "${{ item.v.a.toUpperCase() }}", "deep": "${{ Number(item.v.deep.list[1].x) }}", "size": "${{ Number(item.v.deep.list.length) }}", "index": "${{ Number(item.v.deep.list[0].x) }}", "gone": "${{ String(item.v.deep.nothing.here) }}", "d": "${{ item.v.a | default('-') | upper | json }}",
    }}]
    same = lambda x, y: x == y or isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y)
    for r in run(steps, rows.select("id", F.parse_json("raw").alias("v")), ["id"], ordered=False).collect():
        a, b = pairs()[r.id]
        i, j = divmod(r.id, 100)
        joined = kind(a) in ("string", "array", "object") or kind(b) in ("string", "array", "object")
        total = text(a) + text(b) if joined else "NaN" if math.isnan(number(a) + number(b)) else text(number(a) + number(b))
        fallback = a if kind(a) not in ("undefined", "null") and a != "" else "-"
        shown = json.dumps(fallback.upper() if isinstance(fallback, str) else fallback, separators=(",", ":"))
        want = {"n": number(a), "t": text(a), "mixed": f"<{text(a)}>", "sum": total, "product": number(a) * 2, "or": text(a) if truthy(a) else "none", "upper": a.upper() if kind(a) == "string" else None, "deep": float(j), "size": 2.0, "index": float(i), "gone": "undefined", "d": shown}
        for k, w in want.items():
            assert same(r[k], w), (k, a, b, r[k], w)


def test_sorting(spark):
    sort = lambda values: [r.id for r in run([{"sort": {"by": "v"}}], spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "id long, raw string").select("id", F.parse_json("raw").alias("v")), ["id"]).collect()]
    assert sort([10, "9", 2.5, None, "-1"]) == [3, 4, 2, 1, 0]
    assert sort(["b10", "b9", "a"]) == [2, 1, 0]


def test_what_has_no_meaning_raises(spark):
    from millrace.plans.jsexpr import ExpressionError

    df = spark.sql("select parse_json('1') as v")
    with pytest.raises(ExpressionError):
        run([{"map": {"x": "${{ item.v[item.v] }}"}}], df, [], ordered=False)
