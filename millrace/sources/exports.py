"""Cookie jars, articles, error envelopes, key-value stores and delimited output."""

from __future__ import annotations

import sqlite3

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import keep_last


def netscape_cookies(df: DataFrame, order: str) -> DataFrame:
    """One tab-separated line a (domain, path, name), the last in order winning; columns as named below."""
    d = keep_last(df, ["domain", "path", "name"], [order])
    flag = lambda c: F.when(c, "TRUE").otherwise("FALSE")
    line = F.concat_ws("\t", "domain", flag(F.startswith("domain", F.lit("."))), "path", flag(F.col("secure")), F.coalesce("expires", F.lit(0)).cast("string"), "name", "value")
    return d.select("domain", "path", "name", line.alias("line"))


def article(title: Column, url: Column, body: Column, author: Column | None = None) -> Column:
    """Markdown with front matter; quotes in values are escaped."""
    field = lambda k, c: F.concat(F.lit(f'{k}: "'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('\\"')), F.lit('"\n'))
    return F.concat(F.lit("---\n"), field("title", title), field("url", url), *([field("author", author)] if author is not None else []), F.lit("---\n\n"), F.coalesce(body, F.lit("")), F.lit("\n"))


def error_envelope(code: str, message: str, hint: str | None = None, **more) -> dict:
    """The structured row that a failed command yields."""
    return {"ok": False, "error": {"code": code, "message": message, **({"hint": hint} if hint else {}), **more}}


def sqlite_keys(spark: SparkSession, path: str, table: str = "ItemTable", prefix: str = "") -> DataFrame:
    """(key, value) pairs of a SQLite key-value table, in key order; a driver-side read of a local application file."""
    if not table.isidentifier():
        raise ValueError(f"bad table name {table!r}")
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        rows = db.execute(f"SELECT key, CAST(value AS TEXT) FROM {table} WHERE substr(key, 1, ?) = ? ORDER BY key", (len(prefix), prefix)).fetchall()
    return spark.createDataFrame(rows, "key string, value string")


def delimited(df: DataFrame, text: str, names: list[str], sep: str = "|") -> DataFrame:
    """Lines of a text as rows of named, trimmed fields."""
    import re

    rows = df.select(*[c for c in df.columns if c != text], F.posexplode(F.filter(F.split(text, r"\r?\n"), lambda x: x != "")).alias("pos", "_line"))
    parts = F.split("_line", re.escape(sep))
    return rows.select(*[c for c in rows.columns if c != "_line"], *[F.trim(F.get(parts, F.lit(i))).alias(n) for i, n in enumerate(names)])
