"""Page snapshots as node tables: finding, references, scopes, matching two versions, budgets, readable text.

A node table has one row a node: page, node (place in document order, from 0), depth, and what the operator
names.  A subtree is the run of nodes after its root that are deeper than it.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Matches listed, and characters of their text.
MOST_MATCHES, MOST_TEXT = 50, 120
#: Roles that take part in interaction, that carry content, and that only group others.
INTERACTIVE = ("button", "link", "textbox", "searchbox", "checkbox", "radio", "combobox", "listbox", "menuitem", "menuitemcheckbox", "menuitemradio", "option", "slider", "spinbutton", "switch", "tab", "treeitem")
CONTENT = ("article", "cell", "columnheader", "gridcell", "heading", "listitem", "main", "navigation", "region", "rowheader")
STRUCTURAL = ("generic", "group", "list", "none", "presentation", "RootWebArea", "WebArea")


def selector(css: str) -> Column:
    """A compound selector (tag, #id, .class, or *) as a test of tag, dom_id and class."""
    if not css or not re.fullmatch(r"(?:[a-zA-Z][\w-]*|\*)?(?:[#.][\w-]+)*", css):
        raise ValueError(f"not a selector that can be used here: {css!r}")
    out = F.lit(True)
    for kind, name in re.findall(r"([#.]?)([\w-]+|\*)", css):
        if kind == "#":
            out = out & (F.col("dom_id") == name)
        elif kind == ".":
            out = out & F.array_contains(F.split(F.col("class"), r"\s+"), name)
        elif name != "*":
            out = out & (F.col("tag") == name.lower())
    return F.coalesce(out, F.lit(False))


def find(nodes: DataFrame, page: str, test: Column, limit: int = MOST_MATCHES, most_text: int = MOST_TEXT) -> DataFrame:
    """(page, matches, nth, node, tag, text): the first matches of each page in document order, with how many there are.

    Pages without a match have no row.
    """
    w = Window.partitionBy(page).orderBy("node")
    hits = nodes.where(test)
    counts = hits.groupBy(page).agg(F.count("*").alias("matches"))
    first = hits.withColumn("nth", F.row_number().over(w).cast("long") - 1).where(F.col("nth") < limit)
    return first.join(counts, page).select(page, "matches", "nth", "node", "tag", F.substring(F.trim(F.coalesce("text", F.lit(""))), 1, most_text).alias("text"))


def with_refs(nodes: DataFrame, page: str, first: int = 1) -> DataFrame:
    """Adds ref (numbered in document order, null where none) and nth (place among equal role and name, null if alone).

    Interactive roles have a reference, content roles too if they have a name; only nodes that stand for an
    element (backend) and aren't ignored do.
    """
    eligible = F.coalesce(~F.col("ignored") & F.col("backend").isNotNull() & (F.col("role").isin(*INTERACTIVE) | (F.col("role").isin(*CONTENT) & (F.coalesce("name", F.lit("")) != ""))), F.lit(False))
    w = Window.partitionBy(page, "_e").orderBy("node")
    same = Window.partitionBy(page, "_e", "role", F.coalesce("name", F.lit("")))
    nth = F.when(F.col("_e") & (F.count("*").over(same) > 1), F.row_number().over(same.orderBy("node")).cast("long") - 1)
    ref = F.when(F.col("_e"), F.row_number().over(w).cast("long") + (first - 1))
    return nodes.withColumn("_e", eligible).withColumns({"ref": ref, "nth": nth}).drop("_e")


def scope(nodes: DataFrame, page: str, roots: DataFrame) -> DataFrame:
    """The subtrees of roots (page, node), one a page; pages without a root stay whole, with scope document."""
    r = roots.select(F.col(page).alias("_page"), F.col("node").alias("_root"))
    heads = nodes.join(r, (F.col(page) == F.col("_page")) & (F.col("node") == F.col("_root"))).groupBy("_page", "_root").agg(F.min("depth").alias("_depth"))
    marked = nodes.join(heads, F.col(page) == F.col("_page"), "left")
    # the first node after the root that isn't deeper ends its subtree
    end = marked.where("node > _root and depth <= _depth").groupBy("_page").agg(F.min("node").alias("_end"))
    out = marked.join(end.withColumnRenamed("_page", "_p"), F.col(page) == F.col("_p"), "left")
    inside = F.col("_root").isNull() | ((F.col("node") >= F.col("_root")) & (F.col("_end").isNull() | (F.col("node") < F.col("_end"))))
    return out.where(inside).select(*nodes.columns, F.when(F.col("_root").isNull(), "document").otherwise("part").alias("scope"))


def open_modal(nodes: DataFrame, page: str) -> DataFrame:
    """(page, node) of the last open modal of each page: modal itself, or a dialog that says so."""
    modal = ~F.col("ignored") & (F.coalesce("modal", F.lit(False)) | (F.col("role").isin("dialog", "alertdialog") & F.coalesce("aria_modal", F.lit(False))))
    return nodes.where(modal).groupBy(page).agg(F.max("node").alias("node"))


def match_children(old: DataFrame, new: DataFrame, parent: list[str]) -> DataFrame:
    """Children of equal parents matched in three rounds; (parent, old_pos, new_pos, change).

    old, new: parent columns, pos, key (null for texts), fingerprint, kind and content.  First by key, then by
    fingerprint, each the k-th with the k-th of those left, then those of one kind at the same position.
    change is added, removed, modified or same.
    """
    left = old.select(*parent, F.col("pos").alias("old_pos"), "key", "fingerprint", F.col("kind").alias("_ok"), F.col("content").alias("_oc"))
    right = new.select(*parent, F.col("pos").alias("new_pos"), "key", "fingerprint", F.col("kind").alias("_nk"), F.col("content").alias("_nc"))

    def matched(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
        nth = lambda df, pos: df.where(F.col(on).isNotNull()).withColumn("_k", F.row_number().over(Window.partitionBy(*parent, on).orderBy(pos)))
        return nth(a, "old_pos").join(nth(b, "new_pos").select(*parent, on, "_k", "new_pos", "_nc"), [*parent, on, "_k"]).select(*parent, "old_pos", "new_pos", "_oc", "_nc")

    def rest(df: DataFrame, pairs: DataFrame, pos: str) -> DataFrame:
        return df.join(pairs.select(*parent, pos), [*parent, pos], "left_anti")

    by_key = matched(left, right, "key")
    left, right = rest(left, by_key, "old_pos"), rest(right, by_key, "new_pos")
    by_print = matched(left, right, "fingerprint")
    left, right = rest(left, by_print, "old_pos"), rest(right, by_print, "new_pos")
    at = left.join(right.select(*parent, F.col("new_pos"), F.col("new_pos").alias("old_pos"), "_nk", "_nc"), [*parent, "old_pos"]).where("_ok = _nk").select(*parent, "old_pos", "new_pos", "_oc", "_nc")
    left, right = rest(left, at, "old_pos"), rest(right, at, "new_pos")
    pairs = by_key.unionByName(by_print).unionByName(at).withColumn("change", F.when(F.col("_oc").eqNullSafe(F.col("_nc")), "same").otherwise("modified")).drop("_oc", "_nc")
    none = F.lit(None).cast("long")
    gone = left.select(*parent, F.col("old_pos").cast("long"), none.alias("new_pos"), F.lit("removed").alias("change"))
    came = right.select(*parent, none.alias("old_pos"), F.col("new_pos").cast("long"), F.lit("added").alias("change"))
    return pairs.withColumns({"old_pos": F.col("old_pos").cast("long"), "new_pos": F.col("new_pos").cast("long")}).unionByName(gone).unionByName(came)


def selected(costs: pd.DataFrame, budget: int) -> list[int]:
    """Nodes (as positions) that fit a budget, of one page's rows in document order.

    Columns: parent (position or -1), priority (0 to 4), identity and full (costs).  If everything fits it is all
    taken.  Else priorities go in turn, document order within, and in priority 2 the first child of every
    container before the second of any; a node takes the ancestors it lacks along, at their identity cost, and
    is left out where they don't fit.  What is there for identity only is upgraded where its turn and room come.
    """
    parent, priority, identity, full = (costs[c].tolist() for c in ("parent", "priority", "identity", "full"))
    n = len(parent)
    if sum(full) <= budget:
        return list(range(n))
    rounds: dict[int, int] = {}
    order = []
    for i in range(n):
        turn = 0
        if priority[i] == 2:
            turn = rounds.get(parent[i], 0)
            rounds[parent[i]] = turn + 1
        order.append((priority[i], turn, i))
    spent, cost = 0, dict[int, int]()
    for _, _, i in sorted(order):
        chain, at = [], parent[i]
        while at >= 0 and at not in cost:
            chain.append(at)
            at = parent[at]
        more = full[i] - cost.get(i, 0) + sum(identity[a] for a in chain)
        if spent + more <= budget:
            spent += more
            cost |= {a: identity[a] for a in chain} | {i: full[i]}
    return sorted(cost)


def select_in_budget(nodes: DataFrame, page: str, budget: int) -> DataFrame:
    """The nodes of each page that `selected` keeps; a page is one group, bounded by its own size."""
    names = nodes.columns

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", kind="stable").reset_index(drop=True)
        at = {n: i for i, n in enumerate(pdf["node"])}
        pdf["_parent"] = [at.get(p, -1) if pd.notna(p) else -1 for p in pdf["parent"]]
        rows = pdf.assign(parent=pdf["_parent"])
        return pdf.iloc[selected(rows, budget)][names]

    return nodes.groupBy(page).applyInPandas(fold, nodes.schema)


#: Fixed values of the readable text: roles dropped alone, roles dropped with all below, roles that are numbered,
#: grouping roles, texts that only decorate, and what marks advertisements and boilerplate, dropped with all below.
NOISE = ("none", "presentation", "separator", "paragraph", "tooltip", "status")
NOISE_SUBTREES = ("contentinfo",)
NUMBERED = ("button", "link", "textbox", "checkbox", "radio", "combobox", "tab", "menuitem", "option", "switch", "slider", "spinbutton", "searchbox")
GROUPS = ("list", "listitem", "group", "toolbar", "tablist", "navigation", "region", "complementary", "search", "article", "paragraph", "figure")
DECORATION = ("•", "·", "|", "—", "-", "/", "\\")
AD_WORDS = ("sponsored", "advertisement")
AD_URLS = ("googleadservices.com/pagead/", "alb.reddit.com/cr?", "doubleclick.net/", "ads.example.com/track/")
BOILERPLATE = ("back to top", "scroll to top", "go to top")


def _dropped(role: str, text: str) -> bool:
    return role in NOISE or (role in ("generic", "img") and not text) or (role in ("generic", "text") and text.strip() in DECORATION)


def _dropped_below(role: str, text: str) -> bool:
    lower = text.lower()
    return role in NOISE_SUBTREES or any(w in lower for w in (*AD_WORDS, *BOILERPLATE)) or any(u in text for u in AD_URLS)


def _parents(depths: list[int]) -> list[int]:
    """The nearest row before each that is less deep, -1 where there is none."""
    out, path = [], []
    for i, d in enumerate(depths):
        while path and depths[path[-1]] >= d:
            path.pop()
        out.append(path[-1] if path else -1)
        path.append(i)
    return out


def readable(rows: list[tuple[int, str, str]], most_text: int = 200) -> list[str]:
    """Lines of (depth, role, text) rows, by parent pointers and counts that go up them.

    Noise goes, advertisements go with all below them; of a heading or link and the equal link right inside it one stays,
    and a text that says what it stands in goes; groups without text that hold nothing go, those that hold one row are joined to it.
    Interactive rows are numbered before anything is said once.
    """
    noise = [_dropped(role, text) for _, role, text in rows]
    ads = [not out and _dropped_below(role, text) for out, (_, role, text) in zip(noise, rows, strict=True)]
    under = []  # whether a row is an advertisement or below one
    for i, p in enumerate(_parents([r[0] for r in rows])):
        under.append(ads[i] or (p >= 0 and under[p]))
    rows = [r for r, out, ad in zip(rows, noise, under, strict=True) if not out and not ad]

    labels, number = [], 0
    for _, role, text in rows:
        label = f'{role} "{text}"' if text else role
        label = label[:most_text] + "…" * (len(label) > most_text)
        number += role in NUMBERED
        labels.append(f"[@{number}] {label}" if role in NUMBERED else label)

    depths = [r[0] for r in rows]
    parent = _parents(depths)
    gone, staying = [False] * len(rows), set()  # (parent, depth) of rows that stay
    for i, (depth, role, text) in enumerate(rows):
        follows = i + 1 < len(rows) and rows[i + 1] == (depth + 1, "link", text) and bool(text)
        if gone[i]:
            continue
        p = parent[i]
        while p >= 0 and gone[p]:
            p = parent[p]
        if role in ("generic", "text") and p >= 0 and (p, depth) not in staying and text and rows[p][2] == text:
            gone[i] = True
        elif role == "link" and follows:
            gone[i] = True
        else:
            staying.add((p, depth))
            if role == "heading" and follows:
                gone[i + 1] = True

    rows, labels = ([x for x, out in zip(xs, gone, strict=True) if not out] for xs in (rows, labels))
    depths, gone = [r[0] for r in rows], [False] * len(rows)
    below, direct = [0] * len(rows), [0] * len(rows)  # rows that stay below each
    parent = _parents(depths)
    for i in range(len(rows) - 1, -1, -1):
        gone[i] = rows[i][1] in GROUPS and not rows[i][2] and not below[i]
        if (p := parent[i]) >= 0:
            below[p] += below[i] + (not gone[i])
            direct[p] += not gone[i] and depths[i] == depths[p] + 1
    out, joined = [], set()
    for i, (depth, role, text) in enumerate(rows):
        if gone[i] or i in joined:
            continue
        line = labels[i]
        if role in GROUPS and not text and below[i] == direct[i] == 1:
            only = next(j for j in range(i + 1, len(rows)) if not gone[j])
            joined.add(only)
            line += f" > {labels[only]}"
        out.append("  " * depth + line)
    return out


def readable_pages(nodes: DataFrame, page: str, most_text: int = 200) -> DataFrame:
    """(page, text) of every page's nodes (node, depth, role, text): a fold a page, bounded by the page's size."""
    kind = nodes.schema[page].dataType.simpleString()

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", kind="stable")
        rows = list(zip(pdf["depth"].astype(int), pdf["role"], pdf["text"].fillna(""), strict=True))
        return pd.DataFrame({page: [pdf[page].iloc[0]], "text": ["\n".join(readable(rows, most_text))]})

    return nodes.select(page, "node", "depth", "role", "text").groupBy(page).applyInPandas(fold, f"{page} {kind}, text string")
