"""Queries over the elements of pages: selectors, locators and main content."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import content, dom, selectors, treematch
from ..operators.trees import checkpointed
from .registry import query


def _nodes(t):
    """The elements of all pages, taken apart once: plans read them in many places."""
    return checkpointed(dom.dom(t("pages"), "page_id", "html"))


@query(r"""
WITH items AS (SELECT page_id, regexp_extract_all(regexp_extract(html, '<nav><ul>(.*?)</ul></nav>', 1, 's'), '<li><a href="([^"]*)">([^<]*)</a></li>', 1, 's') AS hrefs,
  regexp_extract_all(regexp_extract(html, '<nav><ul>(.*?)</ul></nav>', 1, 's'), '<li><a href="([^"]*)">([^<]*)</a></li>', 2, 's') AS texts FROM pages),
each AS (SELECT page_id, unnest(hrefs) AS href, unnest(texts) AS text, unnest(range(1, len(hrefs) + 1)) AS k FROM items),
odd AS (SELECT * FROM each WHERE k % 2 = 1 AND href LIKE '/%')
SELECT page_id AS page, count(*) OVER (PARTITION BY page_id) AS matches, row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS nth, href,
  substr(trim(replace(replace(replace(replace(text, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')), 1, 120) AS text FROM odd""")
def select_links(t, spark):
    """Every other link of each page's menu."""
    nodes = _nodes(t)
    return selectors.find(nodes, "nav > ul > li:nth-child(odd) > a[href^='/']").select("page", "matches", "nth", F.col("attrs")["href"].alias("href"), "text")


@query(r"""
SELECT page_id AS page, CAST(len(regexp_extract_all(html, '<li>')) AS BIGINT) AS items, CAST(len(regexp_extract_all(html, '<div class="ad">')) AS BIGINT) AS ads FROM pages""")
def select_counts(t, spark):
    """Items anywhere in a list below the body, and advertisements that come right after a menu, of each page."""
    nodes = _nodes(t)
    kinds = {"items": "body ul li", "ads": "nav ~ div.ad, nav + div.ad"}
    hits = None
    for name, css in kinds.items():
        one = selectors.select(nodes, css).select("page", F.lit(name).alias("kind"))
        hits = one if hits is None else hits.unionByName(one)
    counts = hits.groupBy("page").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in kinds))
    return nodes.where("node = 0").select("page").join(counts, "page", "left").select("page", *(F.coalesce(k, F.lit(0)).alias(k) for k in kinds))


@query()
def find_links(t, spark):
    """Links of all pages by role and a part of their name."""
    nodes = _nodes(t)
    return selectors.find_semantic(nodes, role="link", name="th").select("page", "matches", "nth", "node", "role", "text")


@query()
def main_content(t, spark):
    """The scored content of every page, as html."""
    nodes = _nodes(t)
    return content.main_html(t("pages"), "page_id", "html", nodes)


def _tree(turns):
    """Conversations as trees: a user's turn stands under the conversation, what follows it under the turn, and lines under their turn."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    placed = turns.withColumn("user", F.max(F.when(F.col("role") == "user", F.col("turn"))).over(w))
    place = lambda by: F.row_number().over(Window.partitionBy("conv_id", "above").orderBy(by)) - 1
    above = F.when(F.col("user").isNull() | (F.col("user") == F.col("turn")), 0).otherwise(F.col("user") * 1000 + 1000)
    talk = placed.select("conv_id", (F.col("turn") * 1000 + 1000).alias("node"), above.alias("above"), F.concat_ws(":", "role", "name").alias("key"), F.md5("text").alias("fingerprint"), F.col("role").alias("kind"), F.col("text").alias("content"))
    lines = placed.select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    lines = lines.select("conv_id", (F.col("turn") * 1000 + 1001 + F.col("i")).alias("node"), (F.col("turn") * 1000 + 1000).alias("above"), F.lit(None).cast("string").alias("key"), F.md5("line").alias("fingerprint"), F.lit("line").alias("kind"), F.col("line").alias("content"))
    inner = talk.unionByName(lines).withColumn("pos", place("node")).withColumnRenamed("above", "parent")
    roots = turns.select("conv_id").distinct().select("conv_id", F.lit(0).alias("node"), F.lit(None).cast("int").alias("parent"), F.lit(0).alias("pos"), F.lit("conversation").alias("key"), F.lit("").alias("fingerprint"), F.lit("root").alias("kind"), F.lit("").alias("content"))
    return roots.unionByName(inner)


@query()
def match_trees(t, spark):
    """Trees of all conversations against a later version: some turns gone, some renamed, some with other words, all renumbered."""
    turns = t("conversations").where("conv_id is not null and turn is not null")
    fate = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(10))
    first = turns.withColumn("name", F.col("turn").cast("string"))
    later = turns.where(fate != 0).select("conv_id", (F.col("turn") + 3).alias("turn"), "role", F.when(fate == 1, F.concat(F.lit("renamed "), F.col("turn"))).otherwise(F.col("turn").cast("string")).alias("name"), F.when(fate == 2, F.concat("text", F.lit("\nOne more line."))).otherwise(F.col("text")).alias("text"))
    return treematch.match_trees(_tree(first), _tree(later), "conv_id")
