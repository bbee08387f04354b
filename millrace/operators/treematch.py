"""Two versions of trees matched from the roots down, all trees at once and a level at a time.

A level takes the children of the pairs found on the one before, matches them pair by pair (`snapshots.match_children`:
by key, then by fingerprint, then by place and kind) and hands its own pairs down; so a child is compared with those of the
parent that its own was matched with, whatever key or place that has.  Subtrees whose root found no match are closed whole: none of
their nodes is looked at again, and all come out as added or removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .snapshots import match_children
from .trees import checkpointed

_PAIR = ["_po", "_pn"]
#: Parent of roots.
_NONE = -1


def match_trees(old: DataFrame, new: DataFrame, tree: str, most_levels: int = 10_000) -> DataFrame:
    """(tree, old_node, new_node, change) of every node of both versions, once.

    old, new: the tree's column, node, parent (null at roots), pos (different under one parent), key (null: none), fingerprint,
    kind, content.  Nodes are whole numbers of 0 and more.  change is same, modified, added or removed.  A tree in one version only
    is added or removed whole; so are nodes that no root reaches.  One job a level.
    """
    cols = ["pos", "key", "fingerprint", "kind", "content"]
    side = lambda df, name: df.select(tree, F.col("node").cast("long").alias(name), F.coalesce(F.col("parent").cast("long"), F.lit(_NONE)).alias("_parent"), *cols)
    olds, news = checkpointed(side(old, "old_node")), checkpointed(side(new, "new_node"))
    trees = olds.select(tree).distinct().join(news.select(tree).distinct(), tree)
    pairs = trees.select(tree, F.lit(_NONE).cast("long").alias("_po"), F.lit(_NONE).cast("long").alias("_pn"))
    found = None
    for _ in range(most_levels):
        under = lambda df, by: df.join(pairs.select(F.col(tree).alias("_tree"), *_PAIR), (F.col(tree) == F.col("_tree")) & (F.col("_parent") == F.col(by))).drop("_tree", "_parent")  # noqa: B023, E731
        a, b = checkpointed(under(olds, "_po")), checkpointed(under(news, "_pn"))  # each is read a dozen times
        if a.isEmpty() or b.isEmpty():
            break
        met = match_children(a, b, [tree, *_PAIR]).where("old_pos is not null and new_pos is not null")
        key = [tree, *_PAIR]
        met = met.join(a.select(*key, F.col("pos").cast("long").alias("old_pos"), "old_node"), [*key, "old_pos"]).join(b.select(*key, F.col("pos").cast("long").alias("new_pos"), "new_node"), [*key, "new_pos"])
        level = checkpointed(met.select(tree, "old_node", "new_node", "change"))
        if level.isEmpty():
            break
        found = level if found is None else found.unionByName(level)
        pairs = level.select(tree, F.col("old_node").alias("_po"), F.col("new_node").alias("_pn"))
    else:
        raise RuntimeError(f"deeper than {most_levels} levels")
    none = F.lit(None).cast("long")
    gone, came = olds.select(tree, "old_node"), news.select(tree, "new_node")
    if found is not None:
        gone, came = gone.join(found.select(tree, "old_node"), [tree, "old_node"], "left_anti"), came.join(found.select(tree, "new_node"), [tree, "new_node"], "left_anti")
    out = gone.select(tree, "old_node", none.alias("new_node"), F.lit("removed").alias("change")).unionByName(came.select(tree, none.alias("old_node"), "new_node", F.lit("added").alias("change")))
    return out if found is None else found.unionByName(out)
