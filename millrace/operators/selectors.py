"""CSS selectors and semantic locators over element tables (see `dom`), as structural joins.

A selector is matched from left to right, all pages at once.  Children and siblings are equi-joins on (page, parent);
descendants need no join: labels nest, so an element lies inside one of the matches before it exactly where the largest `end`
among them reaches it, a running maximum in document order.  No pairs of elements are ever made.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import js
from .dom import attribute, with_texts

#: Characters shown of a match's text, and attributes shown.
MOST_TEXT = 120
SHOWN = ("id", "class", "name", "type", "placeholder", "aria-label", "title", "href", "value", "role", "data-testid")
#: What a semantic locator looks among, test-id attributes in order, roles of tags and of input types.
CANDIDATES = "a[href], button, input, textarea, select, option, [role], [aria-label], [aria-labelledby], [data-testid], [data-test], [test-id], label, [contenteditable='true']"
TEST_IDS = ("data-testid", "data-test", "test-id")
TAG_ROLES = {"button": "button", "textarea": "textbox", "select": "combobox", "option": "option"}
INPUT_ROLES = {"button": "button", "submit": "button", "reset": "button", "checkbox": "checkbox", "radio": "radio", "range": "slider", "search": "searchbox"}


class SelectorError(ValueError):
    pass


_NAME = r"-?(?:[A-Za-z_\u0080-￿]|\\.)(?:[\w\u0080-￿-]|\\.)*"
_SIMPLE = re.compile(
    rf"""(?P<tag>\*|{_NAME})|\#(?P<id>(?:[\w\u0080-￿-]|\\.)+)|\.(?P<cls>{_NAME})"""
    rf"""|\[\s*(?P<attr>{_NAME})\s*(?:(?P<op>[~|^$*]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<bare>[^\s\]"']+))\s*(?P<fold>[iI])?\s*)?\]"""
    r"""|:(?P<pseudo>[a-z-]+)(?:\((?P<arg>[^()]*(?:\([^()]*\)[^()]*)*)\))?""",
    re.X,
)
_NTH = re.compile(r"(?:(?P<a>[+-]?\d*)n\s*(?:(?P<sign>[+-])\s*(?P<b>\d+))?|(?P<only>[+-]?\d+))")


@dataclass
class Step:
    combinator: str
    test: Column


def _plain(name: str) -> str:
    return re.sub(r"\\(.)", r"\1", name)


def _nth(k: Column, formula: str) -> Column:
    """Whether k = a n + b for some n of 0 or more."""
    text = {"odd": "2n+1", "even": "2n"}.get(formula.strip(), formula.strip())
    m = _NTH.fullmatch(text)
    if not m:
        raise SelectorError(f"not a position: {formula!r}")
    if m["only"] is not None:
        return k == int(m["only"])
    a = int({"": "1", "+": "1", "-": "-1"}.get(m["a"], m["a"]))
    b = int((m["sign"] or "+") + (m["b"] or "0"))
    if a == 0:
        return k == b
    return (F.pmod(k - b, F.lit(abs(a))) == 0) & (k >= b if a > 0 else k <= b)


def _attr(m: re.Match) -> Column:
    have, op = attribute(m["attr"].lower()), m["op"]
    if not op:
        return have.isNotNull()
    want = next(x for x in (m["dq"], m["sq"], m["bare"]) if x is not None)
    if m["fold"]:
        have, want = F.lower(have), want.lower()
    w = F.lit(want)
    if op == "=":
        return have == w
    if op == "|=":
        return (have == w) | F.startswith(have, F.lit(want + "-"))
    if op == "~=":
        return F.array_contains(F.split(have, r"[ \t\n\f\r]+"), w) if want and not re.search(r"\s", want) else F.lit(False)
    return {"^=": F.startswith, "$=": F.endswith, "*=": F.contains}[op](have, w) if want else F.lit(False)


def _pseudo(name: str, arg: str | None) -> Column:
    nth, back = F.col("nth"), F.col("siblings") - F.col("nth") + 1
    kind, kind_back = F.col("kind_nth"), F.col("kinds") - F.col("kind_nth") + 1
    fixed = {
        "first-child": nth == 1, "last-child": back == 1, "only-child": F.col("siblings") == 1, "first-of-type": kind == 1, "last-of-type": kind_back == 1, "only-of-type": F.col("kinds") == 1,
        "root": F.col("parent") == 0, "empty": (F.col("end") == F.col("node")) & (F.col("stop") == F.col("start")),
        "checked": attribute("checked").isNotNull() | attribute("selected").isNotNull(), "disabled": attribute("disabled").isNotNull(), "enabled": attribute("disabled").isNull() & F.col("tag").isin("button", "input", "select", "textarea", "option", "optgroup", "fieldset"),
    }
    if name in fixed and arg is None:
        return fixed[name]
    counted = {"nth-child": nth, "nth-last-child": back, "nth-of-type": kind, "nth-last-of-type": kind_back}
    if name in counted and arg is not None:
        return _nth(counted[name], arg)
    if name in ("not", "is", "where") and arg is not None:
        inner = F.lit(False)
        for one in parse(arg):
            if len(one) > 1:
                raise SelectorError(f":{name}() takes compound selectors")
            inner = inner | one[0].test
        return ~inner if name == "not" else inner
    raise SelectorError(f"unknown :{name}")


def parse(css: str) -> list[list[Step]]:
    """A selector list as chains of steps; anything that isn't understood raises."""
    out, steps, test, combinator, at = [], [], None, "", 0

    def end_compound():
        nonlocal test
        if test is None:
            raise SelectorError(f"a selector is missing in {css!r}")
        steps.append(Step(combinator, F.coalesce(test, F.lit(False)) & (F.col("node") > 0)))
        test = None

    text = css.strip()
    while at < len(text):
        if m := re.compile(r"\s*([>+~,])\s*|\s+").match(text, at):
            end_compound()
            if m[1] == ",":
                out.append(steps)
                steps, combinator = [], ""
            else:
                combinator = m[1] or " "
            at = m.end()
            continue
        m = _SIMPLE.match(text, at)
        if not m or m["tag"] and test is not None:
            raise SelectorError(f"unexpected {text[at : at + 10]!r} in {css!r}")
        if m["tag"]:
            one = F.lit(True) if m["tag"] == "*" else F.col("tag") == _plain(m["tag"]).lower()
        elif m["id"]:
            one = attribute("id") == _plain(m["id"])
        elif m["cls"]:
            one = F.array_contains(F.split(attribute("class"), r"[ \t\n\f\r]+"), _plain(m["cls"]))
        elif m["attr"]:
            one = _attr(m)
        else:
            one = _pseudo(m["pseudo"], m["arg"])
        one = F.coalesce(one, F.lit(False))
        test = one if test is None else test & one
        at = m.end()
    end_compound()
    return [*out, steps]


def _next(hits: DataFrame, nodes: DataFrame, step: Step) -> DataFrame:
    """Elements that pass the step's test and stand to one of hits as its combinator says."""
    some, own = nodes.where(step.test), nodes.columns
    if step.combinator == ">":
        above = hits.select(F.col("page").alias("_page"), F.col("node").alias("_node"))
        return some.join(above, (F.col("page") == F.col("_page")) & (F.col("parent") == F.col("_node")), "left_semi")
    if step.combinator == "+":
        before = hits.select(F.col("page").alias("_page"), F.col("parent").alias("_parent"), (F.col("nth") + 1).alias("_nth"))
        return some.join(before, (F.col("page") == F.col("_page")) & (F.col("parent") == F.col("_parent")) & (F.col("nth") == F.col("_nth")), "left_semi")
    if step.combinator == "~":
        first = hits.groupBy(F.col("page").alias("_page"), F.col("parent").alias("_parent")).agg(F.min("nth").alias("_first"))
        return some.join(first, (F.col("page") == F.col("_page")) & (F.col("parent") == F.col("_parent"))).where(F.col("nth") > F.col("_first")).select(*own)
    # an element comes before a hit at the same place: nothing lies inside itself
    both = some.withColumn("_reach", F.lit(None).cast("int")).unionByName(hits.withColumn("_reach", F.col("end")))
    running = Window.partitionBy("page").orderBy("node", F.col("_reach").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    return both.withColumn("_far", F.max("_reach").over(running)).where(F.col("_reach").isNull() & (F.col("_far") >= F.col("node"))).select(*own)


def select(nodes: DataFrame, css: str) -> DataFrame:
    """Elements of all pages that match a selector list, each once, with the columns of the table."""
    chains = []
    for steps in parse(css):
        hits = nodes.where(steps[0].test)
        for step in steps[1:]:
            hits = _next(hits, nodes, step)
        chains.append(hits)
    if len(chains) == 1:
        return chains[0]
    out = chains[0]
    for c in chains[1:]:
        out = out.unionByName(c)
    return out.withColumn("_again", F.row_number().over(Window.partitionBy("page", "node").orderBy("end"))).where("_again = 1").drop("_again")


def _listed(hits: DataFrame, nodes: DataFrame, role: Column, limit: int | None, most_text: int) -> DataFrame:
    w = Window.partitionBy("page")
    counted = hits.withColumns({"matches": F.count("*").over(w), "place": F.row_number().over(w.orderBy("node")).cast("long") - 1})
    if limit is not None:
        counted = counted.where(F.col("place") < limit)
    shown = F.map_filter(F.map_from_entries(F.array(*[F.struct(F.lit(a).alias("k"), attribute(a).alias("v")) for a in SHOWN])), lambda k, v: v.isNotNull() & (v != ""))
    text = F.substring(js.trim(F.col("content")), 1, most_text)
    return with_texts(counted, nodes).select("page", "matches", F.col("place").alias("nth"), "node", "tag", F.coalesce(role, F.lit("")).alias("role"), text.alias("text"), shown.alias("attrs"))


def find(nodes: DataFrame, css: str, limit: int | None = None, most_text: int = MOST_TEXT) -> DataFrame:
    """(page, matches, nth, node, tag, role, text, attrs): the matches of each page, or the first of them, with how many there are; pages without one have no row."""
    return _listed(select(nodes, css), nodes, attribute("role"), limit, most_text)


def role_of() -> Column:
    """The role attribute, else what the tag stands for."""
    kind = F.lower(F.coalesce(attribute("type"), F.lit("")))
    given, tag = attribute("role"), F.col("tag")
    by_input = F.lit("textbox")
    for k, v in INPUT_ROLES.items():
        by_input = F.when(kind == k, v).otherwise(by_input)
    native = F.when((tag == "a") & (F.coalesce(attribute("href"), F.lit("")) != ""), "link").when(tag == "input", by_input)
    for k, v in TAG_ROLES.items():
        native = native.when(tag == k, v)
    return F.when(F.coalesce(given, F.lit("")) != "", given).otherwise(native.otherwise(""))


def _folded(c: Column) -> Column:
    return F.lower(js.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s ﻿]+", " ")))


def with_names(hits: DataFrame, nodes: DataFrame) -> DataFrame:
    """Elements with content, label_text and accessible: the parts of their names, joined by spaces."""
    key = ["page", "node"]
    named = with_texts(nodes.where(attribute("id").isNotNull()), nodes, "said")
    first = named.groupBy("page", attribute("id").alias("id")).agg(F.min_by("said", "node").alias("said"))
    labels = with_texts(nodes.where("tag = 'label'"), nodes, "said")
    fors = labels.where(attribute("for").isNotNull()).groupBy("page", attribute("for").alias("id")).agg(F.min_by("said", "node").alias("for_text"))
    around = labels.select("page", F.col("node").alias("label"), F.col("said").alias("around"))
    refs = hits.select(*key, F.posexplode(F.split(attribute("aria-labelledby"), r"\s+")).alias("i", "id")).where("id <> ''")
    by_id = refs.join(first, ["page", "id"]).groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "said"))), lambda s: s["said"]), " ").alias("by_id"))
    out = with_texts(hits, nodes).withColumn("id", F.when(attribute("id") != "", attribute("id")))
    out = out.join(fors, ["page", "id"], "left").join(around, ["page", "label"], "left").join(by_id, key, "left")
    label = F.concat_ws(" ", "for_text", "around")
    parts = [attribute("aria-label"), F.col("by_id"), label, attribute("alt"), attribute("title"), attribute("placeholder"), attribute("value"), F.col("content")]
    return out.withColumns({"label_text": label, "accessible": F.concat_ws(" ", *[F.when(p != "", p) for p in parts])})


def find_semantic(nodes: DataFrame, role: str = "", name: str = "", label: str = "", text: str = "", testid: str = "", limit: int | None = None, most_text: int = MOST_TEXT) -> DataFrame:
    """Like find, by role (equal) and by parts of name, label, text and test id (contained), without regard to case and space."""
    fold = lambda s: " ".join(s.split()).lower()
    hits = select(nodes, CANDIDATES)
    if role:
        hits = hits.where(_folded(role_of()) == fold(role))
    if testid:
        hits = hits.where(F.contains(_folded(F.coalesce(*[F.when(attribute(a) != "", attribute(a)) for a in TEST_IDS])), F.lit(fold(testid))))
    own = hits.columns
    if name or label or text:
        hits = with_names(hits, nodes)
        for want, of in ((name, "accessible"), (label, "label_text"), (text, "content")):
            if fold(want):
                hits = hits.where(F.contains(_folded(F.col(of)), F.lit(fold(want))))
    return _listed(hits.select(*own), nodes, role_of(), limit, most_text)
