"""Text scalars: white space, HTML, chunks, file names, request keys, lists with caps."""

from __future__ import annotations

import html as _html
import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def collapse_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[\s\x{00A0}\x{202F}]+", " "))


#: Fixed table of the named entities that occur most.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def strip_tags(c: Column) -> Column:
    """Tags out, common entities decoded (&amp; last), space collapsed; all in the JVM."""
    out = F.regexp_replace(c, r"<[^>]*>", "")
    for a, b in ENTITIES.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return collapse_space(out)


@F.pandas_udf(T.StringType())
def decode_entities(s: pd.Series) -> pd.Series:
    """All named, decimal and hexadecimal entities."""
    return s.map(lambda x: None if x is None else _html.unescape(x))


def block_text(c: Column) -> Column:
    """HTML to text with block rules: code in backticks, list items as dashes, links as text (url), breaks as newlines."""
    rules = [
        (r"(?is)<pre[^>]*>\s*<code[^>]*>(.*?)</code>\s*</pre>", "\n```\n$1\n```\n"), (r"(?is)<code[^>]*>(.*?)</code>", "`$1`"), (r'(?is)<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>', "$2 ($1)"),
        (r"(?i)<br\s*/?>", "\n"), (r"(?i)<li[^>]*>", "\n- "), (r"(?i)</p>", "\n\n"), (r"<[^>]*>", ""),
    ]
    for a, b in rules:
        c = F.regexp_replace(c, a, b)
    for a, b in ENTITIES.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(c, r"\n{3,}", "\n\n"))


class _Markdown(HTMLParser):
    SKIP = {"script", "style", "noscript", "template", "svg"}
    BLOCK = {"p", "div", "section", "article", "ul", "ol", "table", "tr", "blockquote", "pre", "header", "footer", "main"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = self.pre = 0
        self.links: list[str] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in self.SKIP:
            self.skip += 1
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "br":
            self.out.append("\n")
        elif tag == "li":
            self.out.append("\n- ")
        elif tag in ("strong", "b"):
            self.out.append("**")
        elif tag in ("em", "i"):
            self.out.append("_")
        elif tag == "a":
            self.links.append(a.get("href") or "")
            self.out.append("[")
        elif tag == "img":
            self.out.append(f"![{a.get('alt') or ''}]({a.get('src') or ''})")
        elif tag == "pre":
            self.pre += 1
            self.out.append("\n\n```\n")
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag in self.BLOCK:
            self.out.append("\n\n")

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.skip = max(0, self.skip - 1)
        elif tag in ("strong", "b"):
            self.out.append("**")
        elif tag in ("em", "i"):
            self.out.append("_")
        elif tag == "a" and self.links:
            self.out.append(f"]({self.links.pop()})")
        elif tag == "pre" and self.pre:
            self.pre -= 1
            self.out.append("\n```\n\n")
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag in self.BLOCK or re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data if self.pre else re.sub(r"\s+", " ", data))


def to_markdown(page: str) -> str:
    p = _Markdown()
    p.feed(page)
    p.close()
    text = re.sub(r"[ \t]+\n", "\n", "".join(p.out))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


#: Order in which the main content of a page is looked for.
MAIN = (r"<article\b.*?</article>", r"<main\b.*?</main>", r"<body\b.*?</body>")
LEAST_CONTENT = 80


def main_content(page: str) -> str:
    """The first container with enough visible text, else the whole page."""
    for pattern in MAIN:
        m = re.search(pattern, page, re.S | re.I)
        if m and len(re.sub(r"<[^>]*>|\s+", " ", m[0]).strip()) >= LEAST_CONTENT:
            return m[0]
    return page


@F.pandas_udf(T.StringType())
def html_to_markdown(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else to_markdown(x))


@F.pandas_udf(T.StringType())
def article_markdown(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else to_markdown(main_content(x)))


def only_references(page: str, names: tuple[str, ...]) -> str:
    """The page with every & that doesn't begin one of these closed references written as a reference itself, so that it is read as it stands."""
    return re.sub(rf"&(?!(?:{'|'.join(map(re.escape, names))});)", "&amp;", page)


def article_markdown_of(c: Column, names: tuple[str, ...]) -> Column:
    """article_markdown where only the closed references named are decoded; others, and those without a semicolon, stay."""

    @F.pandas_udf(T.StringType())
    def markdown(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else to_markdown(only_references(main_content(x), names)))

    return markdown(c)


@F.pandas_udf(T.StringType())
def absolute_urls(page: pd.Series, base: pd.Series) -> pd.Series:
    """href and src attributes made absolute."""
    def one(x, b):
        return None if x is None else re.sub(r'((?:href|src)=")([^"]*)(")', lambda m: m[1] + urljoin(b or "", m[2]) + m[3], x)

    return pd.Series([one(x, b) for x, b in zip(page, base, strict=True)])


def chunks_of(text: str, size: int = 20000) -> list[str]:
    """Pieces of at most size characters, cut after a blank line, else a line end, in the last 15 % (rounded down); joined they are the text."""
    size, out, at = max(100, min(200000, size)), [], 0
    while len(text) - at > size:
        end = at + size
        low = max(at + 1, end - max(1, int(size * 0.15)))
        cut = next((p + len(s) for s in ("\n\n", "\n") if (p := text.rfind(s, low, end)) >= 0), end)
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]] if at < len(text) or not out else out


@F.pandas_udf(T.ArrayType(T.StringType()))
def chunks(s: pd.Series, size: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else chunks_of(x, int(n)) for x, n in zip(s, size, strict=True)])


def truncate_at_paragraph(c: Column, n: int) -> Column:
    """At most n characters, back to the last blank line where there is one in the second half."""
    head = F.substring(c, 1, n)
    back = F.locate("\n\n", F.reverse(head))
    snapped = F.when((back > 0) & (back < n / 2), F.substring(head, F.lit(1), F.lit(n) - back - 1)).otherwise(head)
    return F.when(F.length(c) > n, snapped).otherwise(c)


def bounded(c: Column, n: int) -> Column:
    """At most n characters including a marker that says how many were cut."""
    cut = lambda size: F.concat(F.lit("…[+"), (F.length(c) - size).cast("string"), F.lit("]"))
    keep = F.greatest(F.lit(0), F.lit(n) - F.length(cut(F.lit(n))) - 1)
    return F.when(F.length(c) > n, F.concat(F.substring(c, F.lit(1), keep), cut(keep))).otherwise(c)


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"\s+"), lambda x: x != "")).cast("long")


def capped_list(c: Column, cap: int, sep: str = ", ") -> Column:
    """Joined, with (+N) for what a cap leaves out."""
    shown = F.array_join(F.slice(c, 1, cap), sep)
    return F.when(F.size(c) > cap, F.concat(shown, F.lit(" (+"), (F.size(c) - cap).cast("string"), F.lit(")"))).otherwise(shown)


def safe_filename(c: Column, most: int = 200) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(c, r'[<>:"/\\|?*\x00-\x1f]', "_"), r"\s+", "_"), 1, most)


def search_tokens(query: str) -> list[str]:
    return [t for t in re.split(r"[^a-z0-9]+", query.lower()) if t]


def matches_all(hay: Column, query: str) -> Column:
    """Every token of the query is a substring of the text, both reduced to [a-z0-9 ]."""
    flat = F.regexp_replace(F.lower(hay), r"[^a-z0-9]+", " ")
    out = F.lit(True)
    for t in search_tokens(query):
        out = out & F.contains(flat, F.lit(t))
    return out
