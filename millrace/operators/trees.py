"""Adjacency tables: depth-first flattening, subtrees, rollups, diffs and budgets."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_base


def flatten_forest(nodes: DataFrame, tree: str, node: str, parent: str, order: str, most_depth: int | None = None, per_level: int | None = None, deleted: str | None = None) -> DataFrame:
    """Rows with depth and path (array of sibling ranks: sorting by it is depth first).

    Children of deleted nodes vanish with them; siblings beyond per_level are left out.  One join a level,
    on (tree, parent), of the frontier only.  Without most_depth all levels come: each is checkpointed, and the
    first empty one is the end.
    """
    live = nodes.where(~F.col(deleted)) if deleted else nodes
    rank = F.row_number().over(Window.partitionBy(tree, parent).orderBy(order, node))
    ranked = live.withColumn("_rank", rank)
    if per_level:
        ranked = ranked.where(F.col("_rank") <= per_level)
    level = ranked.where(F.col(parent).isNull()).withColumn("depth", F.lit(0).cast("long")).withColumn("path", F.array("_rank"))
    out = level
    d = 0
    while most_depth is None or d < most_depth:
        d += 1
        if most_depth is None:
            level = checkpointed(level)
            out = level if d == 1 else out.unionByName(level)
            if level.isEmpty():
                break
        up = level.select(F.col(tree).alias("_t"), F.col(node).alias("_p"), F.col("path").alias("_path"))
        level = ranked.join(up, (F.col(tree) == F.col("_t")) & (F.col(parent) == F.col("_p"))).withColumn("depth", F.lit(d).cast("long")).withColumn("path", F.concat("_path", F.array("_rank"))).drop("_t", "_p", "_path")
        out = out if most_depth is None else out.unionByName(level)
    return out.drop("_rank")


def checkpointed(df: DataFrame) -> DataFrame:
    """df cut off from its lineage, in the folder that the cluster shares."""
    context = df.sparkSession.sparkContext
    base = shared_base(df.sparkSession)
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return df.checkpoint()


def subtree_sums(flat: DataFrame, tree: str, node: str, value: str) -> DataFrame:
    """(tree, node, total, size): sums over each node's descendants, itself included, by prefixes of paths."""
    up = flat.select(tree, F.col(value).alias("_v"), F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda i: F.slice("path", 1, i))).alias("path"))
    sums = up.groupBy(tree, "path").agg(F.sum("_v").alias("total"), F.count("*").alias("size"))
    return flat.select(tree, node, "path").join(sums, [tree, "path"]).select(tree, node, "total", "size")


def tree_diff(old: DataFrame, new: DataFrame, key: list[str], content: str) -> DataFrame:
    """Full outer join on the key: change is added, removed, modified or same."""
    o, n = old.select(*key, F.col(content).alias("_old")), new.select(*key, F.col(content).alias("_new"))
    both = o.withColumn("_in_old", F.lit(True)).join(n.withColumn("_in_new", F.lit(True)), key, "full_outer")
    kind = F.when(F.col("_in_old").isNull(), "added").when(F.col("_in_new").isNull(), "removed").when(~F.col("_old").eqNullSafe(F.col("_new")), "modified").otherwise("same")
    return both.select(*key, kind.alias("change"))


def within_budget(nodes: DataFrame, doc: str, priority: str, pos: str, cost: str, budget: int) -> DataFrame:
    """Nodes in order of (priority, position) while their running cost stays within a document's budget."""
    w = Window.partitionBy(doc).orderBy(priority, pos).rowsBetween(Window.unboundedPreceding, 0)
    return nodes.withColumn("spent", F.sum(cost).over(w)).where(F.col("spent") <= budget)


class _Nodes(HTMLParser):
    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

    def __init__(self, most_depth: int | None, most_nodes: int | None, most_text: int | None):
        super().__init__(convert_charrefs=True)
        none = float("inf")
        self.most_depth, self.most_nodes, self.most_text = (none if m is None else m for m in (most_depth, most_nodes, most_text))
        self.rows: list[list] = []
        self.texts: list[list[str]] = []
        self.stack: list[tuple[int, str]] = []
        self.cut = 0

    def handle_starttag(self, tag, attrs):
        if len(self.rows) >= self.most_nodes or len(self.stack) >= self.most_depth:
            self.cut += 1
            at = -1
        else:
            at = len(self.rows)
            a = dict(attrs)
            self.rows.append([at, next((i for i, _ in reversed(self.stack) if i >= 0), None), len(self.stack), tag, a.get("id"), a.get("class")])
            self.texts.append([])
        if tag not in self.VOID:
            self.stack.append((at, tag))

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][1] == tag:
                del self.stack[i:]
                break

    def handle_data(self, data):
        at = self.stack[-1][0] if self.stack else -1
        if at >= 0 and data.strip():
            self.texts[at].append(data.strip())

    def nodes(self, counts: bool) -> list[list]:
        out = []
        for r, parts in zip(self.rows, self.texts, strict=True):
            t = " ".join(parts)
            kept = t if len(t) <= self.most_text else t[: self.most_text]
            out.append([*r, kept, *([self.cut, len(t) - len(kept)] if counts else [])])
        return out


#: Characters of html whose nodes are given together.
BATCH = 1 << 20


def html_nodes(pages: DataFrame, id_col: str, html_col: str, most_depth: int | None = None, most_nodes: int | None = None, most_text: int | None = None) -> DataFrame:
    """(id, node, parent, depth, tag, dom_id, class, text) of every page, in Arrow batches.

    All nodes with their whole texts; with a budget, also cut_nodes (nodes left out of the page) and cut_text (characters
    left out of the node's text), and a page without any node left has one row with the counts alone.
    """
    counts = any(m is not None for m in (most_depth, most_nodes, most_text))
    names = ["id", "node", "parent", "depth", "tag", "dom_id", "class", "text"] + ["cut_nodes", "cut_text"] * counts

    def run(batches):
        frame = lambda rows: pd.DataFrame(rows, columns=names).astype({"parent": "Int64", "node": "Int64", "depth": "Int64"})
        for pdf in batches:
            rows, size = [], 0
            for i, page in zip(pdf[id_col], pdf[html_col], strict=True):
                p = _Nodes(most_depth, most_nodes, most_text)
                p.feed(page or "")
                p.close()
                rows += [[i, *r] for r in p.nodes(counts)]
                if p.cut and not p.rows:
                    rows.append([i, *[None] * 7, p.cut, 0])
                size += len(page or "")
                if size >= BATCH:
                    yield frame(rows)
                    rows, size = [], 0
            yield frame(rows)

    return pages.select(id_col, html_col).mapInPandas(run, "id long, node long, parent long, depth long, tag string, dom_id string, class string, text string" + ", cut_nodes long, cut_text long" * counts)


def markdown_table(rows: list[list[str]]) -> str:
    """Ragged rows padded to a Markdown table; the first row is the header."""
    n = max(map(len, rows), default=0)
    pad = [[str(c).replace("|", "\\|") for c in r] + [""] * (n - len(r)) for r in rows]
    lines = ["| " + " | ".join(r) + " |" for r in pad]
    return "\n".join([lines[0], "| " + " | ".join(["---"] * n) + " |", *lines[1:]]) if lines else ""
