"""Named queries: a callable over (spark, folder) and, where SQL can say the same, its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_base

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the folder that the cluster shares."""
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a function (t, spark) -> DataFrame, where t(name) reads a table of the folder and t.path(name) is its path."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            t = partial(table, spark, sf_dir)
            t.path = lambda name: f"{sf_dir}/{name}.parquet"
            return f(t, spark)

        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


class ArgumentError(ValueError):
    pass


def coerce(specs: list[dict], given: dict) -> dict:
    """Command arguments: required, number and boolean coercion, choices; defaults are taken as they are."""
    out = {}
    for s in specs:
        name, kind = s["name"], s.get("type", "string")
        v = given.get(name)
        if v in (None, ""):
            if s.get("required"):
                raise ArgumentError(f"{name} is required")
            if "default" in s:
                out[name] = s["default"]
            continue
        if kind in ("int", "number"):
            try:
                v = float(v)
            except (TypeError, ValueError):
                raise ArgumentError(f"{name} is not a number") from None
            if v != v:
                raise ArgumentError(f"{name} is not a number")
            v = int(v) if v == int(v) else v
        elif kind in ("bool", "boolean"):
            if str(v).lower() not in ("true", "1", "false", "0"):
                raise ArgumentError(f"{name} is not a boolean")
            v = str(v).lower() in ("true", "1")
        if s.get("choices") and v not in s["choices"]:
            raise ArgumentError(f"{name} must be one of {s['choices']}")
        out[name] = v
    if unknown := set(given) - {s["name"] for s in specs}:
        raise ArgumentError(f"unknown argument {sorted(unknown)[0]}")
    return out
