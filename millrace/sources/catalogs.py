"""Catalogues, archives and federated sources: many small inputs, some of which fail."""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def manifests(df: DataFrame, name: str, text: str, schema: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(entries, errors) of manifests given as JSON arrays, a row a source.

    A manifest that doesn't parse, or an entry without a required field, becomes a row (name, error) of the second
    table and never fails the others.
    """
    parsed = F.from_json(text, T.ArrayType(T.StructType.fromDDL(schema)), {"mode": "PERMISSIVE"})
    is_array = F.try_parse_json(text).isNotNull() & F.startswith(F.ltrim(text), F.lit("["))
    rows = df.select(name, F.when(is_array, parsed).alias("_a"))
    entries = rows.where(F.col("_a").isNotNull()).select(name, F.posexplode("_a").alias("pos", "_e"))
    missing = F.concat_ws(", ", *[F.when(F.col(f"_e.{c}").isNull(), F.lit(c)) for c in required])
    good = entries.where(missing == "").select(name, "pos", "_e.*")
    bad = rows.where(F.col("_a").isNull()).select(name, F.lit("not a list of entries").alias("error"))
    return good, bad.unionByName(entries.where(missing != "").select(name, F.concat(F.lit("entry "), F.col("pos").cast("string"), F.lit(" lacks "), missing).alias("error")))


def newest_first(df: DataFrame, part: str, order: list[Column], limit: int, most_parts: int | None = None) -> DataFrame:
    """The first `limit` rows, newest partition first: only as many partitions are read as it takes.

    Partitions are counted from metadata where the table is partitioned by `part`; the counts come back, a row a
    partition, and the rest is pruned by a literal predicate.
    """
    counts = sorted(((r[part], r["count"]) for r in df.groupBy(part).count().collect() if r[part] is not None), reverse=True)
    wanted, n = [], 0
    for value, k in counts[:most_parts]:
        if n >= limit:
            break
        wanted.append(value)
        n += k
    return df.where(F.col(part).isin(*wanted) if wanted else F.lit(False)).orderBy(F.desc(part), *order).limit(limit)


def federated(spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], limit: int, order: str) -> tuple[DataFrame | None, DataFrame]:
    """(rows, failures): at most ceil(limit / sources) rows of each source, cut to the limit; a failing source is a
    row of the second table.  Sources are read where the result is; here only their plans are made and tried."""
    cap = math.ceil(limit / max(1, len(sources)))
    frames, failed = [], []
    for i, (name, make) in enumerate(sources.items()):
        try:
            df = make()
            df.schema  # noqa: B018  analysis errors belong to the source that has them
            frames.append(df.orderBy(order).limit(cap).select(F.lit(i).alias("_i"), F.lit(name).alias("source"), "*"))
        except Exception as e:  # noqa: BLE001  whatever a source raises is its own failure
            failed.append((name, str(e).split("\n")[0][:200]))
    errors = spark.createDataFrame(failed, "source string, error string")
    if not frames:
        return None, errors
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.orderBy("_i", order).limit(limit).drop("_i"), errors


def with_facts(df: DataFrame, facts: DataFrame) -> DataFrame:
    """Every row with the columns of a one-row table; raises while the plan is built if that has more than one row."""
    if facts.limit(2).count() > 1:
        raise ValueError("facts must be one row")
    return df.join(F.broadcast(facts), F.lit(True), "left")


def folder_sizes(files: DataFrame, path: str, size: str) -> DataFrame:
    """(folder, files, bytes) of every folder with all below it, from (path, size) rows."""
    parts = F.split(F.regexp_replace(path, "/[^/]*$", ""), "/")
    up = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    return files.select(F.explode(up).alias("folder"), F.col(size).alias("_s")).where("folder <> ''").groupBy("folder").agg(F.count("*").alias("files"), F.sum("_s").alias("bytes"))


def enrich(rows: DataFrame, details: DataFrame, key: str, on: str, fields: list[str]) -> DataFrame:
    """Rows with the fields of their details; a row whose detail is missing or broken stays, with an error."""
    right = details.select(F.col(on).alias("_k"), *[F.col(c).alias(f"_{c}") for c in fields], F.col("error").alias("_error"), F.lit(True).alias("_found"))
    out = rows.join(right, F.col(key) == F.col("_k"), "left")
    bad = F.when(F.col("_found").isNull(), "not found").otherwise(F.col("_error"))
    return out.select(*rows.columns, *[F.when(bad.isNull(), F.col(f"_{c}")).alias(c) for c in fields], bad.alias("error"))


def fixture(path: str) -> dict | list:
    """A JSON fixture, read on the driver; a file that doesn't parse raises with its name."""
    with open(path, encoding="utf-8") as f:
        try:
            return json.load(f)
        except ValueError as e:
            raise ValueError(f"{path}: {e}") from None


def first_hits(text: Column, metrics: dict[str, str]) -> list[Column]:
    """One column a metric: the first match of its pattern's group as a whole number, commas out, else null."""
    def one(pattern: str) -> Column:
        hit = F.replace(F.regexp_extract(text, pattern, 1), F.lit(","), F.lit(""))
        return F.when(hit != "", hit).try_cast("long")

    return [one(p).alias(k) for k, p in metrics.items()]
