"""Data contracts: every rule turns into rows (rule, detail, row_index); all row rules share one scan."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import js

_SCHEMA = "rule string, detail string, row_index long"


@dataclass
class Expect:
    """A contract; see failures() for what each part checks."""

    row_count: tuple[int | None, int | None] = (None, None)
    columns: list[str] = field(default_factory=list)
    types: dict[str, str] = field(default_factory=dict)
    patterns: dict[str, str] = field(default_factory=dict)
    not_empty: list[str] = field(default_factory=list)
    must_not_contain: dict[str, list[str]] = field(default_factory=dict)
    must_be_truthy: list[str] = field(default_factory=list)


def check_expect(e: dict) -> list[str]:
    """Problems of a contract given as a dict."""
    known = {f for f in Expect.__dataclass_fields__}
    out = [f"unknown key {k}" for k in e if k not in known]
    lo, hi = e.get("row_count", (None, None))
    if lo is not None and hi is not None and lo > hi:
        out.append("row_count: min is over max")
    return out


def json_type(t: T.DataType) -> str:
    if isinstance(t, T.StringType):
        return "string"
    if isinstance(t, T.BooleanType):
        return "boolean"
    if isinstance(t, T.ArrayType):
        return "array"
    if isinstance(t, (T.StructType, T.MapType, T.VariantType)):
        return "object"
    return "number" if js.is_numeric(t) else "string"


def failures(df: DataFrame, e: Expect, index: str) -> DataFrame:
    """Failure rows of df under a contract; index names the column that numbers rows."""
    spark = df.sparkSession
    tests: list[tuple[str, str, Column]] = []
    fixed: list[tuple[str, str, int | None]] = [("columns", f"missing column {c}", None) for c in e.columns if c not in df.columns]
    schema = {f.name: f.dataType for f in df.schema.fields}
    for c, kinds in e.types.items():
        allowed = kinds.split("|")
        if c in schema and "any" not in allowed:
            kind = json_type(schema[c])
            actual = F.when(F.col(c).isNull(), "null").otherwise(kind)
            tests.append(("types", f"{c}: expected {kinds}", ~actual.isin(*allowed)))
    for c, p in e.patterns.items():
        if c in schema:
            tests.append(("patterns", f"{c}: no match for {p}", F.col(c).isNotNull() & ~F.col(c).cast("string").rlike(p)))
    for c in e.not_empty:
        if c in schema:
            tests.append(("notEmpty", f"{c} is empty", F.coalesce(js.trim(F.col(c).cast("string")) == "", F.lit(True))))
    for c, words in e.must_not_contain.items():
        for w in words if c in schema else ():
            tests.append(("mustNotContain", f"{c} contains {w}", F.contains(F.col(c).cast("string"), F.lit(w))))
    for c in e.must_be_truthy:
        if c in schema:
            tests.append(("mustBeTruthy", f"{c} is falsy", ~js.truthy(F.col(c), schema[c])))
    out = spark.createDataFrame(fixed, _SCHEMA)
    if tests:
        hits = F.array_compact(F.array(*[F.when(bad, F.struct(F.lit(r).alias("rule"), F.lit(d).alias("detail"))) for r, d, bad in tests]))
        out = out.unionByName(df.select(F.col(index).cast("long").alias("row_index"), F.explode(hits).alias("f")).select("f.rule", "f.detail", "row_index"))
    lo, hi = e.row_count
    if lo is not None or hi is not None:
        n = df.agg(F.count("*").alias("n"))
        bad = reduce(lambda a, b: a | b, [F.col("n") < lo] * (lo is not None) + [F.col("n") > hi] * (hi is not None))
        out = out.unionByName(n.where(bad).select(F.lit("rowCount").alias("rule"), F.concat(F.lit("rows: "), F.col("n").cast("string")).alias("detail"), F.lit(None).cast("long").alias("row_index")))
    return out


def derive(df: DataFrame) -> DataFrame:
    """(column, types): the JSON types seen in each column, sorted and joined by |, from one pass."""
    kinds = [F.array_join(F.sort_array(F.collect_set(F.when(F.col(f.name).isNull(), "null").otherwise(json_type(f.dataType)))), "|").alias(f.name) for f in df.schema.fields]
    one = df.agg(*kinds)
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("types")) for c in df.columns])).alias("x")).select("x.*")


def shape_violations(schema: T.StructType, most_keys: int = 12, most_depth: int = 1, id_names: tuple[str, ...] = ("id", "url", "slug", "key", "uuid")) -> list[str]:
    """Rows with too many keys, too deep, or with ids below the top level."""
    out = [f"{len(schema.fields)} keys, at most {most_keys}"] * (len(schema.fields) > most_keys)

    def depth(t: T.DataType) -> int:
        if isinstance(t, T.ArrayType):
            return depth(t.elementType)
        return 1 + max((depth(f.dataType) for f in t.fields), default=0) if isinstance(t, T.StructType) else 0

    def nested(t: T.DataType, path: str):
        if isinstance(t, T.ArrayType):
            yield from nested(t.elementType, path)
        elif isinstance(t, T.StructType):
            for f in t.fields:
                if path and f.name.lower() in id_names:
                    yield f"{path}.{f.name}"
                yield from nested(f.dataType, f"{path}.{f.name}" if path else f.name)

    for f in schema.fields:
        if (d := depth(f.dataType)) > most_depth:
            out.append(f"{f.name} is {d} deep, at most {most_depth}")
    return out + [f"nested id {p}" for p in nested(schema, "")]


def audit(findings: DataFrame, rules: list[str]) -> DataFrame:
    """(rule, n, subjects) with rules that found nothing as 0."""
    known = findings.sparkSession.createDataFrame([(r,) for r in rules], "rule string")
    got = findings.groupBy("rule").agg(F.count("*").alias("n"), F.count_distinct("subject").alias("subjects"))
    return known.join(got, "rule", "left").select("rule", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("subjects", F.lit(0)).alias("subjects"))


def assert_schema(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drift detection: raises where the columns aren't the expected ones, else returns df."""
    if df.columns != columns:
        raise ValueError(f"columns changed: {df.columns}, expected {columns}")
    return df
