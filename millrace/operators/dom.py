"""Pages as element tables with interval labels.

A row is an element: node is its place in document order, end the last place inside it, so x lies inside a where
a.node < x.node <= a.end.  Row 0 of a page is the document itself and holds the text of the whole page once; an element's
text is that text from `start` to `stop`.  nth and siblings count elements under one parent from 1, kind_nth and kinds those of the same
tag; above are the nearest ANCESTORS elements around it, from the parent on; label is the nearest label around the element or itself.  chars and commas count what stands in the element but in none inside it
(without white space); its html is the page's from `source_from` to `source_to`.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = "node int, end int, parent int, above array<int>, depth int, nth int, siblings int, kind_nth int, kinds int, label int, tag string, attrs map<string,string>, start int, stop int, chars int, commas int, source_from int, source_to int, text string"
#: Elements without an end, and those whose start ends an open one: by tag, what is ended, and within what it is looked for.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
ENDS = {tag: (("p",), ("button", "table", "td", "th")) for tag in BLOCK} | {"li": (("li", "p"), ("ul", "ol")), "dt": (("dt", "dd", "p"), ("dl",)), "dd": (("dt", "dd", "p"), ("dl",)), "option": (("option",), ("select", "datalist")), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}
#: Commas of several scripts.
COMMAS = re.compile("[\u002c\u060c\ufe50\ufe10\ufe11\u2e41\u2e34\u2e32\uff0c]")
ANCESTORS = 5
#: Bytes of html whose elements are given together.
BATCH = 2 << 20


class Elements(HTMLParser):
    """Elements of one page, in document order."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = [{"node": 0, "parent": None, "above": [], "depth": 0, "label": None, "tag": "#document", "attrs": {}, "start": 0, "chars": 0, "commas": 0, "source_from": 0}]
        self.open, self.parts, self.size = [0], [], 0
        self.html, self.lines = html, [0, *(m.end() for m in re.finditer("\n", html))]

    def spot(self) -> int:
        """Where in the html the tag at hand begins."""
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        ended, within = ENDS.get(tag, ((), ()))
        spot = self.spot()
        for i in range(len(self.open) - 1, 0, -1):
            name = self.rows[self.open[i]]["tag"]
            if name in ended:
                self.shut(i, spot)
            elif name in within:
                break
        node, above = len(self.rows), self.rows[self.open[-1]]
        self.rows.append({"node": node, "parent": above["node"], "above": [above["node"], *above["above"]][:ANCESTORS], "depth": above["depth"] + 1, "label": node if tag == "label" else above["label"], "tag": tag, "attrs": {k: v or "" for k, v in reversed(attrs)}, "start": self.size, "chars": 0, "commas": 0, "source_from": spot})
        self.open.append(node)
        if tag in VOID:
            self.shut(len(self.open) - 1, spot + len(self.get_starttag_text() or ""))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.rows[self.open[i]]["tag"] == tag:
                spot = self.spot()
                if i + 1 < len(self.open):
                    self.shut(i + 1, spot)
                self.shut(i, self.html.find(">", spot) + 1 or len(self.html))
                break

    def handle_data(self, data):
        self.parts.append(data)
        self.size += len(data)
        own = self.rows[self.open[-1]]
        own["chars"] += sum(map(len, data.split()))
        own["commas"] += len(COMMAS.findall(data))

    def shut(self, i: int, spot: int) -> None:
        for node in self.open[i:]:
            self.rows[node] |= {"end": len(self.rows) - 1, "stop": self.size, "source_to": spot}
        del self.open[i:]

    def finish(self) -> list[dict]:
        self.close()
        self.shut(0, len(self.html))
        among, alike = Counter(), Counter()
        for r in self.rows[1:]:
            among[r["parent"]] += 1
            alike[r["parent"], r["tag"]] += 1
            r["nth"], r["kind_nth"] = among[r["parent"]], alike[r["parent"], r["tag"]]
        for r in self.rows[1:]:
            r["siblings"], r["kinds"] = among[r["parent"]], alike[r["parent"], r["tag"]]
        self.rows[0]["text"] = "".join(self.parts)
        return self.rows


def elements(html: str | None) -> list[dict]:
    parser = Elements(html or "")
    parser.feed(html or "")
    return parser.finish()


def dom(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """page and SCHEMA: the elements of every page.  Null html is a page without elements; pages are known by their id."""
    from pyspark.sql.pandas.types import to_arrow_schema

    own = T.StructType([T.StructField("page", pages.schema[id_col].dataType)])
    schema = T.StructType(own.fields + T._parse_datatype_string(SCHEMA).fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([list(r[f.name].items()) if f.name == "attrs" else r.get(f.name) for r in rows], f.type) for f in arrow], schema=arrow)

        rows, size = [], 0
        for b in batches:
            for page, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows += [{"page": page, **r} for r in elements(html)]
                size += len(html or "")
                if size >= BATCH:
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)

    return pages.select(id_col, html_col).mapInArrow(run, schema)


def attribute(name: str) -> Column:
    return F.try_element_at("attrs", F.lit(name))


def with_texts(hits: DataFrame, nodes: DataFrame, name: str = "content") -> DataFrame:
    """Elements with the text inside them, cut from their page's text."""
    whole = nodes.where("node = 0").select(F.col("page").alias("_page"), F.col("text").alias("_text"))
    return hits.join(whole, F.col("page") == F.col("_page")).withColumn(name, F.substring("_text", F.col("start") + 1, F.col("stop") - F.col("start"))).drop("_page", "_text")
