"""Weighted top-k, suggestions and version order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.js import round_half_up

#: Fixed weights of the engagement score.
WEIGHTS = {"likes": 1.0, "retweets": 3.0, "replies": 2.0, "bookmarks": 5.0}
VIEWS_WEIGHT = 0.5


def engagement(likes: Column, retweets: Column, replies: Column, bookmarks: Column, views: Column) -> Column:
    n = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    raw = n(likes) * WEIGHTS["likes"] + n(retweets) * WEIGHTS["retweets"] + n(replies) * WEIGHTS["replies"] + n(bookmarks) * WEIGHTS["bookmarks"] + F.log10(F.greatest(n(views), F.lit(0.0)) + 1) * VIEWS_WEIGHT
    return F.greatest(F.lit(0.0), round_half_up(raw))


def top_n(df: DataFrame, score: str, order: str, n: int) -> DataFrame:
    """The n best, ties in order; n <= 0 leaves the table as it is."""
    return df.orderBy(F.desc(score), F.asc(order)).limit(n) if n > 0 else df


def semver_key(c: Column) -> Column:
    """Sortable: numeric parts, then releases over pre-releases."""
    core = F.regexp_extract(c, r"^v?(\d+(?:\.\d+)*)", 1)
    parts = F.transform(F.split(core, r"\."), lambda x: F.coalesce(x.try_cast("long"), F.lit(0)))
    return F.struct(F.slice(F.concat(parts, F.array(*[F.lit(0).cast("long")] * 4)), 1, 4), F.when(c.rlike(r"^v?[\d.]+$"), 1).otherwise(0), c)


def suggestions(candidates: DataFrame, name: str, token: str, n: int = 3) -> DataFrame:
    """Closest names by (distance, length, name); the cut-off is 2 for tokens of 8 characters or more, else 1."""
    most = 2 if len(token) >= 8 else 1
    d = F.levenshtein(F.col(name), F.lit(token), most)
    return candidates.withColumn("distance", d).where((F.col("distance") >= 0) & (F.col("distance") <= most)).orderBy("distance", F.length(name), name).limit(n)
