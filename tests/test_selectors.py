"""Selectors and semantic locators against a plain walk over the elements of random pages."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import dom, selectors


class Element:
    def __init__(self, row, page):
        self.row, self.page, self.kids, self.up = row, page, [], None
        self.node, self.tag, self.attrs = row["node"], row["tag"], row["attrs"]
        self.text = page[row["start"] : row["stop"]]

    def above(self):
        e = self.up
        while e is not None and e.node:
            yield e
            e = e.up

    def place(self):
        return self.up.kids.index(self)

    def before(self):
        return self.up.kids[: self.place()]

    def alike(self):
        return [k for k in self.up.kids if k.tag == self.tag]

    def cls(self, name):
        return name in (self.attrs.get("class") or "").split()


def tree(html):
    rows = dom.elements(html)
    all_ = [Element(r, rows[0]["text"]) for r in rows]
    for e in all_[1:]:
        e.up = all_[e.row["parent"]]
        e.up.kids.append(e)
    return all_[1:]


def random_page(rng):
    words = ["Save", "the  File", "größe", "x", ""]

    def one(depth):
        tag = rng.choice(["div", "p", "a", "span", "ul", "li", "label", "input", "button", "section", "b"])
        attrs = ""
        for name, values in (("class", ["a", "b", "a b", "ab", ""]), ("id", ["one", "two", "three"]), ("href", ["/x", "/x.pdf", "http://h/x"]), ("data-k", ["v", "v-w", "w v"]), ("for", ["one", "two"]), ("aria-labelledby", ["one two", "two"]), ("aria-label", ["Close it"]), ("role", ["button", "tab"]), ("type", ["checkbox", "submit", "text"]), ("data-testid", ["Main-Btn"]), ("value", ["Ok"])):
            if rng.random() < 0.22:
                attrs += f' {name}="{rng.choice(values)}"'
        inside = rng.choice(words) + "".join(one(depth + 1) for _ in range(rng.choice([0, 0, 1, 2, 3]) if depth < 5 else 0)) + rng.choice(words)
        return f"<{tag}{attrs}>" + ("" if tag == "input" else inside + f"</{tag}>" * (rng.random() < 0.9))

    return "<!DOCTYPE html><body>" + "".join(one(0) for _ in range(6))


CSS = {
    "div > a[href]": lambda e: e.tag == "a" and "href" in e.attrs and e.up.tag == "div",
    "div a": lambda e: e.tag == "a" and any(u.tag == "div" for u in e.above()),
    "#one": lambda e: e.attrs.get("id") == "one",
    "div.a.b, p#two , *.ab": lambda e: e.tag == "div" and e.cls("a") and e.cls("b") or e.tag == "p" and e.attrs.get("id") == "two" or e.cls("ab"),
    "ul > li + li": lambda e: e.tag == "li" and e.up.tag == "ul" and e.place() > 0 and e.up.kids[e.place() - 1].tag == "li",
    "span ~ b": lambda e: e.tag == "b" and any(k.tag == "span" for k in e.before()),
    "section div > span b": lambda e: e.tag == "b" and any(u.tag == "span" and u.up.tag == "div" and any(v.tag == "section" for v in u.up.above()) for u in e.above()),
    ".a .a .a": lambda e: e.cls("a") and sum(u.cls("a") for u in e.above()) >= 2,
    "p ~ div a + span": lambda e: e.tag == "span" and e.place() > 0 and e.up.kids[e.place() - 1].tag == "a" and any(u.tag == "div" and any(k.tag == "p" for k in u.before()) for u in e.up.kids[e.place() - 1].above()),
    "[href^='http'], [href$=\".pdf\"]": lambda e: e.attrs.get("href", "").startswith("http") or e.attrs.get("href", "").endswith(".pdf"),
    "[data-k~=v]": lambda e: "v" in e.attrs.get("data-k", "").split(),
    "[data-k|=v]": lambda e: e.attrs.get("data-k") is not None and (e.attrs["data-k"] == "v" or e.attrs["data-k"].startswith("v-")),
    "[class*='b' ]:not(.b)": lambda e: "b" in e.attrs.get("class", "") and not e.cls("b"),
    "[aria-label='CLOSE it' i]": lambda e: e.attrs.get("aria-label") == "Close it",
    "li:nth-child(2n+1)": lambda e: e.tag == "li" and e.place() % 2 == 0,
    ":nth-child(-n+2)": lambda e: e.place() < 2,
    ":nth-last-child(3)": lambda e: len(e.up.kids) - e.place() == 3,
    "a:first-of-type": lambda e: e.tag == "a" and e.alike()[0] is e,
    "div :nth-of-type(even)": lambda e: e.alike().index(e) % 2 == 1 and any(u.tag == "div" for u in e.above()),
    "*:last-child:first-child": lambda e: len(e.up.kids) == 1,
    "body > :is(div, p):not([id]):not(:first-child)": lambda e: e.up.tag == "body" and e.tag in ("div", "p") and "id" not in e.attrs and e.place() > 0,
    "b:empty": lambda e: e.tag == "b" and not e.kids and not e.text,
}


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(31)
    html = {i: random_page(rng) for i in range(300)} | {360: "", 361: "no elements", 362: "<p>one<p>two<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3"}
    nodes = dom.dom(spark.createDataFrame([*html.items(), (363, None)], "page_id long, html string").repartition(4), "page_id", "html")
    return nodes.cache(), {i: tree(h) for i, h in html.items()}


@pytest.mark.parametrize("css", CSS)
def test_selectors(pages, css):
    nodes, trees = pages
    want = {(i, e.node) for i, es in trees.items() for e in es if CSS[css](e)}
    got = [(r.page, r.node) for r in selectors.select(nodes, css).select("page", "node").collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_labels(pages):
    nodes, trees = pages
    for r in nodes.where("node > 0").collect():
        e = trees[r.page][r.node - 1]
        inside = [x.node for x in trees[r.page] if any(u is e for u in x.above())]
        assert r.end == max(inside, default=r.node) and r.depth == 1 + len(list(e.above())) and r.nth == e.place() + 1 and r.siblings == len(e.up.kids)
    assert [e.tag for e in trees[362]] == ["p", "p", "ul", "li", "li", "table", "tr", "td", "td", "tr", "td"] and [e.row["depth"] for e in trees[362]] == [1, 1, 1, 2, 2, 1, 2, 3, 3, 2, 3]


def test_plan_has_no_nested_loops(pages):
    plan = selectors.select(pages[0], "section div > span b, a + b ~ i")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_listing(pages):
    nodes, trees = pages
    got = {(r.page, r.nth): r for r in selectors.find(nodes, "div", limit=2, most_text=7).collect()}
    for i, es in trees.items():
        divs = [e for e in es if e.tag == "div"]
        for k, e in enumerate(divs[:2]):
            r = got.pop((i, k))
            assert (r.matches, r.node, r.text) == (len(divs), e.node, e.text.strip()[:7]) and r.attrs == {k: v for k, v in e.attrs.items() if v and k in selectors.SHOWN}
    assert not got


def said(e, es):
    by_id = {}
    for x in es:
        by_id.setdefault(x.attrs.get("id"), x)
    labels = [x.text for x in es if x.tag == "label" and x.attrs.get("for") == e.attrs.get("id")][:1] if e.attrs.get("id") else []
    around = next((u.text for u in [e, *e.above()] if u.tag == "label"), None)
    label = " ".join([*labels, *([around] if around is not None else [])])
    refs = " ".join(by_id[x].text for x in e.attrs.get("aria-labelledby", "").split() if x in by_id)
    parts = [e.attrs.get("aria-label"), refs, label, e.attrs.get("alt"), e.attrs.get("title"), e.attrs.get("placeholder"), e.attrs.get("value"), e.text]
    return label, " ".join(p for p in parts if p)


def native(e):
    kind = e.attrs.get("type", "").lower()
    return e.attrs.get("role") or {"button": "button", "textarea": "textbox", "select": "combobox", "option": "option"}.get(e.tag) or ("link" if e.tag == "a" and e.attrs.get("href") else selectors.INPUT_ROLES.get(kind, "textbox") if e.tag == "input" else "")


@pytest.mark.parametrize("want", [{"role": "button"}, {"role": "Link", "text": "save"}, {"name": "the file"}, {"label": "größe"}, {"testid": "main", "name": "ok"}, {"name": "close it", "role": "tab"}])
def test_semantic(pages, want):
    nodes, trees = pages
    fold = lambda s: re.sub(r"\s+", " ", s).strip().lower()
    wanted = set()
    for i, es in trees.items():
        for e in es:
            a = e.attrs
            if not (e.tag == "a" and "href" in a or e.tag in ("button", "input", "textarea", "select", "option", "label") or {"role", "aria-label", "aria-labelledby", "data-testid"} & a.keys()):
                continue
            label, name = said(e, es)
            fine = all({"role": lambda v, e=e: fold(native(e)) == fold(v), "name": lambda v, n=name: fold(v) in fold(n), "label": lambda v, x=label: fold(v) in fold(x), "text": lambda v, e=e: fold(v) in fold(e.text), "testid": lambda v, a=a: fold(v) in fold(a.get("data-testid", ""))}[k](v) for k, v in want.items())
            if fine:
                wanted.add((i, e.node))
    got = {(r.page, r.node) for r in selectors.find_semantic(nodes, limit=10_000, **want).collect()}
    assert got == wanted and wanted


@pytest.mark.parametrize("css", ["", "div >", "a,,b", "a:hover", "[x", "div(", "a:nth-child(x)", ":not(a b)", "> a"])
def test_what_is_not_understood_raises(css):
    with pytest.raises(selectors.SelectorError):
        selectors.parse(css)


def test_odd_table(spark):
    none = spark.createDataFrame([], "page_id string, html string")
    assert selectors.find(dom.dom(none, "page_id", "html"), "a b").count() == 0
    deep = spark.createDataFrame([("x", "<div>" * 3000 + "<a href=y>end</a>")], "page_id string, html string")
    assert selectors.find(dom.dom(deep, "page_id", "html"), "div div > a").select("text").first().text == "end" and F is not None


def test_every_link_of_long_menus(spark, tmp_path):
    """Pages with more matches than a listing shows: select_links has the rows of its SQL, find_links each link."""
    import duckdb
    import oracle

    from millrace.plans.catalogue import ORACLE, QUERIES

    menu = lambda n: "".join(f'<li><a href="/a{i}">the {i} &amp; more</a></li>' for i in range(n))
    rows = [(i, f"http://h/{i}", f"<html><body><nav><ul>{menu(n)}</ul></nav><p>x</p></body></html>") for i, n in enumerate([0, 1, 99, 100, 101, 102, 700])]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    columns, got, named, want = oracle.both(spark, con, QUERIES["select_links"], ORACLE["select_links"], str(tmp_path))
    assert columns == named and got == want and len(got) == 1 + 50 + 50 + 51 + 51 + 350
    links = {(r.page, r.nth): r.matches for r in QUERIES["find_links"](spark, str(tmp_path)).collect()}
    assert links == {(i, k): n for i, n in enumerate([0, 1, 99, 100, 101, 102, 700]) for k in range(n)}
