"""Scans over captured payloads: feeds, HTML lists, dotenv, JSONL, key ranges, pages of results, caches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _tag(c: Column, tag: str) -> Column:
    body = F.regexp_extract(c, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)
    return F.trim(F.regexp_replace(body, r"(?s)^<!\[CDATA\[(.*)\]\]>$", "$1"))


def feed_items(df: DataFrame, xml: str, item: str, tags: list[str]) -> DataFrame:
    """Atom (<entry>) or RSS (<item>) elements as rows, one column a tag, with their position."""
    parts = F.regexp_extract_all(F.col(xml), F.lit(rf"(?is)<{item}\b.*?</{item}>"), F.lit(0))
    rows = df.select(*[c for c in df.columns if c != xml], F.posexplode(parts).alias("pos", "_x"))
    return rows.select(*[c for c in rows.columns if c != "_x"], *[_tag(F.col("_x"), t).alias(t) for t in tags])


def html_list(df: DataFrame, html: str, element: str) -> DataFrame:
    """Elements of a page as rows of visible text."""
    parts = F.regexp_extract_all(F.col(html), F.lit(rf"(?is)<{element}\b[^>]*>(.*?)</{element}>"), F.lit(1))
    return df.select(*[c for c in df.columns if c != html], F.posexplode(parts).alias("pos", "_x")).withColumn("text", F.trim(F.regexp_replace("_x", "<[^>]*>", ""))).drop("_x")


def definition_map(html: Column) -> Column:
    """<dt>k</dt><dd>v</dd> pairs as a map; the first of equal keys wins."""
    keys = F.regexp_extract_all(html, F.lit(r"(?is)<dt[^>]*>(.*?)</dt>"), F.lit(1))
    values = F.regexp_extract_all(html, F.lit(r"(?is)<dd[^>]*>(.*?)</dd>"), F.lit(1))
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    return F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.when(F.map_contains_key(m, p["k"]), m).otherwise(F.map_concat(m, F.create_map(p["k"], p["v"]))))


def dotenv(text: Column) -> Column:
    """k=v lines as a map; comments skipped, the first = splits, the last of equal keys wins."""
    lines = F.filter(F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(x)), lambda x: ~F.startswith(x, F.lit("#")) & F.contains(x, F.lit("=")))
    entries = F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("k"), F.trim(F.regexp_extract(x, "^[^=]*=(.*)$", 1)).alias("v")))
    last = F.filter(entries, lambda e: F.element_at(F.filter(entries, lambda o: o["k"] == e["k"]), -1)["v"] == e["v"])
    return F.map_from_entries(F.array_distinct(last))


def strict_jsonl(spark: SparkSession, path: str, schema: str, key: str = "id") -> DataFrame:
    """Every non-blank line must parse and keys must be unique; otherwise an error that names what is wrong."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    again = df.groupBy(key).count().where("count > 1").limit(1).collect()
    if again:
        raise ValueError(f"{key} {again[0][key]!r} is repeated")
    return df


def key_range(df: DataFrame, seq: str, after=None, before=None, limit: int | None = None) -> DataFrame:
    """Exclusive key range in order."""
    if after is not None:
        df = df.where(F.col(seq) > after)
    if before is not None:
        df = df.where(F.col(seq) < before)
    return df.orderBy(seq).limit(limit) if limit is not None else df


def offset_page(df: DataFrame, order: str, offset: int, limit: int) -> DataFrame:
    """slice(offset, offset + limit); limit 0 is no limit."""
    out = df.orderBy(order).offset(offset)
    return out.limit(limit) if limit else out


def paginated(pages: list[DataFrame], key: str, limit: int) -> DataFrame:
    """Pages of results in page order, first occurrence of each key, cut at a limit."""
    from ..operators.dedupe import keep_first

    every = reduce(lambda a, b: a.unionByName(b), [p.withColumn("_page", F.lit(i)) for i, p in enumerate(pages)])
    return keep_first(every, [key], ["_page", key]).orderBy("_page", key).limit(limit).drop("_page")


def positional(c: Column, names: list[str]) -> list[Column]:
    """Positional arrays to named columns."""
    return [F.get(c, F.lit(i)).alias(n) for i, n in enumerate(names)]


def cache_status(saved: Column, body: Column, now: Column, ttl_s: float = 86_400.0) -> Column:
    """ok, missing, expired or corrupt."""
    return F.when(saved.isNull(), "missing").when(F.try_parse_json(body).isNull() & body.isNotNull(), "corrupt").when(now - saved > ttl_s, "expired").otherwise("ok")
