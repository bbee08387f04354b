"""The main content of pages, by scores of blocks over element tables (see `dom`).

Paragraphs give points to what stands around them: all to the parent, half to the next, then less.  An element's points, with a
start by its tag and names, count as far as its text isn't link text.  The best element of a page is its content, together with siblings
that are good enough.  Sums over subtrees are differences of running sums in document order, and points are dealt to the ancestors that
each row names, so nothing is done element by element in Python.

Where no page content is found this way, the first of the fallback selectors with at least 80 characters is taken.  Lengths are of
characters that aren't white space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dom import ANCESTORS, BLOCK, attribute
from .selectors import parse
from .trees import checkpointed

#: Names that tell for and against content, elements left out, elements that are paragraphs, points by tag.
UNLIKELY = r"(?i)-ad-|ai2html|banner|breadcrumbs|combx|comment|community|cover-wrap|disqus|extra|footer|gdpr|header|legends|menu|related|remark|replies|rss|shoutbox|sidebar|skyscraper|social|sponsor|supplemental|ad-break|agegate|pagination|pager|popup|yom-remote"
MAYBE = r"(?i)and|article|body|column|content|main|shadow"
GOOD = r"(?i)article|body|content|entry|hentry|h-entry|main|page|pagination|post|text|blog|story"
BAD = r"(?i)-ad-|hidden|^hid$| hid$| hid |^hid |banner|combx|comment|com-|contact|footer|gdpr|masthead|media|meta|outbrain|promo|related|scroll|share|shoutbox|sidebar|skyscraper|sponsor|shopping|tags|widget"
UNLIKELY_ROLES = ("menu", "menubar", "complementary", "navigation", "alert", "alertdialog", "dialog")
OUT = ("script", "style", "noscript", "template", "head", "title", "nav", "aside", "footer", "form", "button", "input", "select", "textarea", "iframe", "object", "embed", "svg")
PARAGRAPHS = ("p", "pre", "td", "blockquote")
START = {5: ("div",), 3: ("pre", "td", "blockquote"), -3: ("address", "ol", "ul", "dl", "dd", "dt", "li", "form"), -5: ("h1", "h2", "h3", "h4", "h5", "h6", "th")}
LEAST_PARAGRAPH, NAME_POINTS = 25, 25
SHARES = (1, 2, 6, 9, 12)
LEAST_SIBLING, SIBLING_SHARE, LONG, FEW_LINKS = 10.0, 0.2, 80, 0.25
FALLBACKS = ("main", "[role='main']", "#main-content", "#main", "#content", ".content", "article", "body")
LEAST_FALLBACK = 80


def _names() -> Column:
    return F.concat_ws(" ", attribute("class"), attribute("id"))


def _inside(df: DataFrame, flag: str, name: str) -> DataFrame:
    """Adds whether an element lies inside one that has the flag, or has it itself."""
    running = Window.partitionBy("page").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.coalesce(F.max(F.when(F.col(flag), F.col("end"))).over(running) >= F.col("node"), F.lit(False)))


def measured(nodes: DataFrame) -> DataFrame:
    """page, node, end, parent, tag, names, out, and len, links, commas of all the kept text inside."""
    hidden = attribute("hidden").isNotNull() | (attribute("aria-hidden") == "true") | F.coalesce(attribute("style"), F.lit("")).rlike(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")
    unlikely = (_names().rlike(UNLIKELY) & ~_names().rlike(MAYBE) | F.coalesce(attribute("role"), F.lit("")).isin(*UNLIKELY_ROLES)) & ~F.col("tag").isin("body", "a", "article", "main", "html")
    flagged = nodes.select("page", "node", "end", "parent", "above", "tag", "chars", "commas", _names().alias("names"), F.coalesce(F.col("tag").isin(*OUT) | hidden | unlikely, F.lit(False)).alias("drop"), (F.col("tag") == "a").alias("link"))
    flagged = _inside(_inside(flagged, "drop", "out"), "link", "linked")
    kept = lambda c: F.when(~F.col("out"), F.col(c)).otherwise(0)
    own = flagged.withColumns({"chars": kept("chars"), "commas": kept("commas"), "in_links": F.when(F.col("linked"), kept("chars")).otherwise(0)})
    running = Window.partitionBy("page").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    sums = own.withColumns({f"s_{c}": F.sum(c).over(running) for c in ("chars", "commas", "in_links")})
    ends = sums.select(F.col("page").alias("_page"), F.col("node").alias("_end"), *(F.col(f"s_{c}").alias(f"e_{c}") for c in ("chars", "commas", "in_links")))
    total = lambda c: (F.col(f"e_{c}") - F.col(f"s_{c}") + F.col(c)).cast("long")
    both = sums.join(ends, (F.col("page") == F.col("_page")) & (F.col("end") == F.col("_end")))
    return both.select("page", "node", "end", "parent", "above", "tag", "names", "out", total("chars").alias("len"), total("in_links").alias("links"), total("commas").alias("commas"))


def _density() -> Column:
    return F.when(F.col("len") == 0, 0.0).otherwise(F.col("links") / F.col("len"))


def scores(sized: DataFrame) -> DataFrame:
    """page, node, parent, names, len, links, score of the elements that paragraphs gave points to."""
    blocks = sized.where(F.col("tag").isin(*BLOCK) & ~F.col("out")).select(F.col("page").alias("_page"), F.col("parent").alias("_parent")).distinct()
    plain = sized.join(blocks, (F.col("page") == F.col("_page")) & (F.col("node") == F.col("_parent")), "left_anti").where(F.col("tag") == "div")
    paragraphs = sized.where(F.col("tag").isin(*PARAGRAPHS)).unionByName(plain).where(~F.col("out") & (F.col("len") >= LEAST_PARAGRAPH))
    points = F.lit(1) + F.col("commas") + F.least(F.floor(F.col("len") / 100), F.lit(3))
    given = paragraphs.select("page", F.posexplode("above").alias("level", "node"), points.alias("points"))
    share = F.col("points") / F.element_at(F.array(*map(F.lit, SHARES[:ANCESTORS])), F.col("level") + 1)
    start = F.lit(0)
    for n, tags in START.items():
        start = F.when(F.col("tag").isin(*tags), n).otherwise(start)
    named = F.when(F.col("names").rlike(GOOD), NAME_POINTS).otherwise(0) - F.when(F.col("names").rlike(BAD), NAME_POINTS).otherwise(0)
    total = given.where("node > 0").groupBy("page", "node").agg(F.sum(share).alias("points"))
    own = sized.where(~F.col("out") & ~F.col("tag").isin("html"))
    return own.join(total, ["page", "node"]).select("page", "node", "parent", "tag", "names", "len", "links", F.round((F.col("points") + start + named) * (1 - _density()), 6).alias("score"))


def main_blocks(nodes: DataFrame) -> DataFrame:
    """(page, source, node, score): the elements that make up each page's content; `source` is scored or fallback.  Pages without content have no row."""
    sized = checkpointed(measured(nodes))
    scored = checkpointed(scores(sized))
    best = scored.groupBy("page").agg(F.max(F.struct("score", (-F.col("node")).alias("first"), "parent", "names")).alias("b")).select(F.col("page").alias("_page"), F.col("b.score").alias("top"), (-F.col("b.first")).alias("_top"), F.col("b.parent").alias("_parent"), F.col("b.names").alias("_names"))
    best = best.where("top > 0")
    beside = sized.where(~F.col("out")).join(best, (F.col("page") == F.col("_page")) & (F.col("parent") == F.col("_parent")))
    beside = beside.join(scored.select("page", "node", "score"), ["page", "node"], "left")
    bonus = F.when((F.col("names") != "") & (F.col("names") == F.col("_names")), F.col("top") * SIBLING_SHARE).otherwise(0.0)
    fit = F.coalesce(F.col("score") + bonus >= F.greatest(F.lit(LEAST_SIBLING), F.col("top") * SIBLING_SHARE), F.lit(False))
    said = (F.col("tag") == "p") & (((F.col("len") > LONG) & (_density() < FEW_LINKS)) | ((F.col("len") <= LONG) & (F.col("len") >= LEAST_PARAGRAPH) & (F.col("links") == 0)))
    chosen = beside.where((F.col("node") == F.col("_top")) | fit | said).select("page", F.lit("scored").alias("source"), "node", "score")

    rest = nodes.join(best.select(F.col("_page").alias("page")), "page", "left_anti")
    tests = F.array(*[F.when(parse(css)[0][0].test, rank) for rank, css in enumerate(FALLBACKS)])
    back = rest.select("page", "node", F.explode(F.array_compact(tests)).alias("rank")).groupBy("page", "rank").agg(F.min("node").alias("node"))
    long = back.join(nodes.where("node = 0").select("page", F.col("text").alias("_text")), "page").join(rest.select("page", "node", "start", "stop"), ["page", "node"])
    enough = F.char_length(F.trim(F.substring("_text", F.col("start") + 1, F.col("stop") - F.col("start")))) >= LEAST_FALLBACK
    taken = long.where(enough).groupBy("page").agg(F.min_by("node", "rank").alias("node")).select("page", F.lit("fallback").alias("source"), "node", F.lit(None).cast("double").alias("score"))
    return chosen.unionByName(taken)


def main_html(pages: DataFrame, id_col: str, html_col: str, nodes: DataFrame) -> DataFrame:
    """(page, source, content): the html of each page's content, its elements in order."""
    parts = main_blocks(nodes).join(nodes.select("page", "node", "source_from", "source_to"), ["page", "node"])
    spans = parts.groupBy("page").agg(F.first("source").alias("source"), F.array_sort(F.collect_list(F.struct("node", "source_from", "source_to"))).alias("spans"))
    html = pages.select(F.col(id_col).alias("page"), F.col(html_col).alias("_html"))
    cut = F.array_join(F.transform("spans", lambda s: F.substring(F.col("_html"), s["source_from"] + 1, s["source_to"] - s["source_from"])), "\n")
    return spans.join(html, "page").select("page", "source", cut.alias("content"))
