"""Main content against a plain walk over each page's elements."""

import random
import re

import pytest

from millrace.operators import content as ct
from millrace.operators import dom


def walk(html):
    """[(node, score)] of the chosen elements, or the fallback's node, element by element."""
    rows = dom.elements(html)
    kids = {r["node"]: [] for r in rows}
    for r in rows[1:]:
        kids[r["parent"]].append(r["node"])
    names = [" ".join(x for x in (r["attrs"].get("class"), r["attrs"].get("id")) if x is not None) for r in rows]
    out = [False] * len(rows)
    for r in rows:
        a, i = r["attrs"], r["node"]
        own = r["tag"] in ct.OUT or "hidden" in a or a.get("aria-hidden") == "true" or bool(re.search(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", "")))
        own |= (bool(re.search(ct.UNLIKELY, names[i])) and not re.search(ct.MAYBE, names[i]) or a.get("role") in ct.UNLIKELY_ROLES) and r["tag"] not in ("body", "a", "article", "main", "html")
        out[i] = own or (r["parent"] is not None and out[r["parent"]])

    def size(i, what, linked=False):
        if out[i]:
            return 0
        linked |= rows[i]["tag"] == "a"
        own = rows[i]["commas"] if what == "commas" else rows[i]["chars"] if what == "len" or linked else 0
        return own + sum(size(k, what, linked) for k in kids[i])

    above = lambda i: [] if rows[i]["parent"] is None else [rows[i]["parent"], *above(rows[i]["parent"])]
    inlink = lambda i: any(rows[u]["tag"] == "a" for u in above(i))
    n = {i: (size(i, "len"), size(i, "links", inlink(i)), size(i, "commas")) for i in range(len(rows))}
    points = {}
    for r in rows[1:]:
        i = r["node"]
        block = r["tag"] in ct.PARAGRAPHS or r["tag"] == "div" and not any(rows[k]["tag"] in dom.BLOCK and not out[k] for k in kids[i])
        if block and not out[i] and n[i][0] >= ct.LEAST_PARAGRAPH:
            p = 1 + n[i][2] + min(n[i][0] // 100, 3)
            for level, u in enumerate(above(i)[:5]):
                points[u] = points.get(u, 0) + p / (1, 2, 6, 9, 12)[level]
    density = lambda i: n[i][1] / n[i][0] if n[i][0] else 0.0
    score = {}
    for i, p in points.items():
        if i and not out[i] and rows[i]["tag"] != "html":
            start = next((k for k, tags in ct.START.items() if rows[i]["tag"] in tags), 0)
            named = 25 * bool(re.search(ct.GOOD, names[i])) - 25 * bool(re.search(ct.BAD, names[i]))
            score[i] = (p + start + named) * (1 - density(i))
    best = max(score, key=lambda i: (round(score[i], 6), -i), default=None)
    if best is not None and round(score[best], 6) > 0:
        got, top = [], score[best]
        for k in kids[rows[best]["parent"]]:
            if out[k]:
                continue
            bonus = 0.2 * top if names[k] and names[k] == names[best] else 0
            fit = k in score and score[k] + bonus >= max(10, 0.2 * top) - 1e-9
            said = rows[k]["tag"] == "p" and (n[k][0] > 80 and density(k) < 0.25 or 25 <= n[k][0] <= 80 and n[k][1] == 0)
            if k == best or fit or said:
                got.append((k, round(score[k], 4) if k in score else None))
        return "scored", got
    text = rows[0]["text"]
    tests = [lambda r: r["tag"] == "main", lambda r: r["attrs"].get("role") == "main", *(lambda r, x=x: r["attrs"].get("id") == x for x in ("main-content", "main", "content")), lambda r: "content" in r["attrs"].get("class", "").split(), lambda r: r["tag"] == "article", lambda r: r["tag"] == "body"]
    for t in tests:
        r = next((r for r in rows[1:] if t(r)), None)
        if r and len(text[r["start"] : r["stop"]].strip(" ")) >= 80:
            return "fallback", [(r["node"], None)]
    return None, []


def random_page(rng):
    prose = lambda k: " ".join(rng.choice(["some", "words,", "of", "prose", "that", "go", "on,", "größe"]) for _ in range(k))
    link = lambda: f"<a href=/{rng.randrange(9)}>{prose(rng.randrange(1, 5))}</a>"

    def block(depth):
        kind = rng.choice(["p", "p", "p", "div", "section", "ul", "nav", "pre", "table", "article", "script", "h2", "blockquote"])
        attr = rng.choice(["", "", "", ' class="content"', ' class="sidebar"', ' id="main"', ' class="post entry"', ' class="share"', ' role="navigation"', " hidden", ' style="display: none"', ' id="comment-3"'])
        if kind in ("p", "pre", "h2", "blockquote", "script"):
            return f"<{kind}{attr}>{prose(rng.randrange(40))}{link() * rng.randrange(3)}</{kind}>"
        if kind == "ul":
            return f"<ul{attr}>" + "".join(f"<li>{link()}{prose(rng.randrange(12))}" for _ in range(rng.randrange(5))) + "</ul>"
        if kind == "table":
            return f"<table{attr}><tr><td>{prose(20)}<td>{prose(3)}</table>"
        inner = "".join(block(depth + 1) for _ in range(rng.randrange(1, 5))) if depth < 4 else prose(30)
        return f"<{kind}{attr}>{inner or prose(30)}</{kind}>"

    return f"<html><head><title>t</title></head><body>{''.join(block(0) for _ in range(rng.randrange(7)))}</body></html>"


PLAIN = "<html><body><div class='menu'><a href=/>Home</a> <a href=/x>More of it</a></div><div class='layout'><p>" + "A sentence of the story, which goes on. " * 8 + "</p><p>" + "And a second one, as long. " * 9 + "</p></div><div id='footer'>All rights, always.</div></body></html>"


def chosen(spark, html):
    pages = spark.createDataFrame(list(html.items()), "page_id long, html string").repartition(4)
    nodes = dom.dom(pages, "page_id", "html").cache()
    got = {}
    for r in ct.main_blocks(nodes).orderBy("page", "node").collect():
        source, picked = got.setdefault(r.page, (r.source, []))
        picked.append((r.node, None if r.score is None else round(r.score, 4)))
    return got, pages, nodes


def test_random_pages(spark):
    rng = random.Random(41)
    html = {i: random_page(rng) for i in range(150)} | {150: "", 151: None, 152: "<body>" + "short", 153: "<body><main>" + "text " * 40 + "</main>", 154: "<body><a href=/>" + "link " * 40 + "</a></body>"}
    got, _, _ = chosen(spark, html)
    want = {i: walk(h or "") for i, h in html.items()}
    assert got == {i: w for i, w in want.items() if w[0]}
    assert {w[0] for w in want.values()} == {"scored", "fallback", None}


def test_menus_and_footers_stay_out(spark):
    got, pages, nodes = chosen(spark, {1: PLAIN})
    content = ct.main_html(pages, "page_id", "html", nodes).first()
    assert content.source == "scored" and content.content.startswith("<div class='layout'>") and content.content.endswith("</div>") and "rights" not in content.content and "Home" not in content.content


@pytest.mark.parametrize(("html", "cuts"), [("<a><b>x</b >y</a>z", ["<a><b>x</b >y</a>", "<b>x</b >"]), ("<p>é\n<br>a<p>b", ["<p>é\n<br>a", "<br>", "<p>b"]), ("<ul><li>1<li>2</ul>", ["<ul><li>1<li>2</ul>", "<li>1", "<li>2"])])
def test_html_of_elements(html, cuts):
    assert [html[r["source_from"] : r["source_to"]] for r in dom.elements(html)[1:]] == cuts


def test_every_given_page(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    nodes = dom.dom(pages, "page_id", "html")
    got = {}
    for r in ct.main_blocks(nodes).orderBy("page", "node").collect():
        got.setdefault(r.page, (r.source, []))[1].append((r.node, None if r.score is None else round(r.score, 4)))
    want = {r.page_id: walk(r.html or "") for r in pages.collect()}
    assert got == {i: w for i, w in want.items() if w[0]} and got
