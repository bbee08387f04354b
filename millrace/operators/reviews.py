"""Merging judgements: verdict lattices, bags of pairs, ranked answers, scored candidates, pairing advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Verdicts from worst to best, and findings kept.
RED, ORANGE, GREEN = "likely_missing", "review_suggested", "no_update_needed"
MOST_FINDINGS = 5
#: Commands that list things, commands that show one, and columns that name one.
LISTING = (
    "search", "hot", "recent", "trending", "top", "feed", "popular", "list", "best", "newest", "latest", "rising", "controversial", "home", "timeline", "browse", "discover", "jobs",
    "unanswered", "bounties", "tag", "user", "venue", "category", "subreddit", "question",
)
DETAIL = (
    "read", "article", "paper", "post", "detail", "view", "job", "page", "book", "movie", "show-detail", "chapter", "tweet", "video", "track", "note", "review", "item", "product", "episode",
    "thread", "comment-detail", "profile-detail", "shop",
)
ID_COLUMN = r"(?i:^id$|_id$|^short_id$|^jk$|^tid$|^bvid$|^aid$|^asin$|^sku$|^isbn$|^doi$|^slug$|^hn_id$|^username$|^handle$|^uri$)|Id$"


def merge_verdicts(reviews: DataFrame, by: list[str], order: str) -> DataFrame:
    """One row a group: verdict, confidence, n_findings, findings, limitations.

    reviews: verdict, confidence (high, medium, low), available, findings (array of structs changed, evidence,
    suggested), limitations (array of texts).  Any red makes red: high if a red one is, one step lower where
    orange ones disagree.  Else any orange makes orange: low if one is.  Groups without an available review are
    `unavailable`.  Of findings equal in all three fields one counts; the first five in order are kept.
    Limitations are those of all reviews, distinct and sorted.
    """
    said = lambda v: F.coalesce(F.col("available") & (F.col("verdict") == v), F.lit(False))
    bad = lambda v, c: F.bool_or(said(v) & F.coalesce(F.col("confidence") == c, F.lit(False)))
    heads = reviews.groupBy(*by).agg(
        F.bool_or("available").alias("_any"), F.bool_or(said(RED)).alias("_red"), F.bool_or(said(ORANGE)).alias("_orange"), bad(RED, "high").alias("_high"), bad(ORANGE, "low").alias("_low"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("limitations")))).alias("limitations"),
    )
    key = ["changed", "evidence", "suggested"]
    rows = reviews.where("available").select(*by, F.col(order).alias("_at"), F.posexplode("findings").alias("_pos", "_f")).select(*by, "_at", "_pos", "_f.*")
    first = rows.groupBy(*by, *key).agg(F.min(F.struct("_at", "_pos")).alias("_first"))
    n = first.groupBy(*by).agg(F.count("*").alias("_n"))
    # the five smallest places: partial top-k by a bounded window after the distinct
    top = first.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("_first"))).where(F.col("_r") <= MOST_FINDINGS)
    top = top.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", *key))), lambda x: F.struct(*[x[k].alias(k) for k in key])).alias("findings"))
    every = heads.join(n, by, "left").join(top, by, "left")
    found = F.col("_red") | F.col("_orange")
    red = F.when(F.col("_high") & ~F.col("_orange"), "high").when(F.col("_high") | ~F.col("_orange"), "medium").otherwise("low")
    return every.select(
        *by,
        F.when(~F.col("_any"), "unavailable").when(F.col("_red"), RED).when(F.col("_orange"), ORANGE).otherwise(GREEN).alias("verdict"),
        F.when(F.col("_red"), red).when(F.col("_low"), "low").otherwise("medium").alias("confidence"),
        F.when(found, F.least(F.coalesce("_n", F.lit(0)), F.lit(MOST_FINDINGS))).otherwise(F.lit(0)).cast("long").alias("n_findings"),
        F.when(found, F.col("findings")).alias("findings"),
        "limitations",
    )


def pair_counts(turns: DataFrame, conv: str, order: str, role: str, text: str) -> DataFrame:
    """(prompt, reply, n): how often each prompt is first answered by each reply, blank replies left out."""
    w = Window.partitionBy(conv).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    reply = F.first(F.when(F.col(role) == "assistant", F.col(text)), ignorenulls=True).over(w)
    clean = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    rows = turns.withColumn("reply", reply).where((F.col(role) == "user") & (F.trim("reply") != "")).select(clean(F.col(text)).alias("prompt"), "reply")
    return rows.where("prompt <> ''").groupBy("prompt", "reply").agg(F.count("*").alias("n"))


def new_pairs(now: DataFrame, baseline: DataFrame) -> DataFrame:
    """Pairs that occur more often than in the baseline, with how much oftener (a bag difference)."""
    b = baseline.select("prompt", "reply", F.col("n").alias("_b"))
    return now.join(b, ["prompt", "reply"], "left").select("prompt", "reply", (F.col("n") - F.coalesce("_b", F.lit(0))).alias("n")).where("n > 0")


def ranked_answers(answers: DataFrame, question: str, accepted: Column, score: str, order: str) -> DataFrame:
    """rank (from 1) in each question: accepted answers first, then by score, ties in order."""
    w = Window.partitionBy(question).orderBy(F.when(F.coalesce(accepted, F.lit(False)), 0).otherwise(1), F.coalesce(F.col(score), F.lit(0)).desc(), F.col(order))
    return answers.withColumn("rank", F.row_number().over(w).cast("long"))


def best_count(candidates: DataFrame, by: list[str], text: str, signal: Column, in_button: Column, excluded: Column) -> DataFrame:
    """The most likely vote count of each group as text: a positive whole number, 4 for standing in a button, 3 for a
    vote signal, 1 for a button signal; then the larger number, then the smaller text.  Groups without one have ''."""
    t = F.trim(F.coalesce(F.col(text), F.lit("")))
    value = F.when(t.rlike(r"^\d+$"), t.try_cast("decimal(38,0)"))
    s = F.lower(F.coalesce(signal, F.lit("")))
    score = F.when(in_button, 4).otherwise(0) + F.when(F.contains(s, F.lit("vote")), 3).otherwise(0) + F.when(F.contains(s, F.lit("button")), 1).otherwise(0)
    ok = (value > 0) & ~F.coalesce(excluded, F.lit(False))
    # one minimum a group: negated score and value, then the text itself
    best = F.min(F.when(ok, F.struct((-score).alias("s"), (-value).alias("v"), t.alias("t"))))
    return candidates.groupBy(*by).agg(F.coalesce(best["t"], F.lit("")).alias("count"))


def unpaired_listings(commands: DataFrame) -> DataFrame:
    """Listing commands of sites that also read details, without a column that names a detail.

    commands: site, name, access, columns (array), takes_url (whether its main argument may be a url).  A column
    `url` names a detail only where a detail command takes one.
    """
    detail = F.col("name").isin(*DETAIL) & (F.col("access") == "read")
    both = commands.groupBy("site").agg(F.bool_or(detail).alias("_d"), F.bool_or(detail & F.col("takes_url")).alias("_u")).where("_d").select("site", "_u")
    listing = commands.where(F.col("name").isin(*LISTING)).join(both, "site")
    named = F.coalesce(F.exists("columns", lambda c: c.rlike(ID_COLUMN) | (F.col("_u") & (F.lower(c) == "url"))), F.lit(False))
    return listing.where(~named).select("site", "name")
