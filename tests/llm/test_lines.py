from collections import defaultdict

import oracle
import pytest
from pyspark.sql import functions as F

from millrace.llm import lines as ln


def plain(docs, min_docs=2, min_chars=10):
    """[(id, text)] -> [(lines, dropped, text)] by one dictionary; a null id is the smallest."""
    key = lambda x: "".join(c.lower() if c in ln.string.ascii_uppercase else c for c in x.strip(ln.WHITE))
    order = lambda i: -(2**63) if i is None else i
    held = defaultdict(set)
    for i, t in docs:
        for x in (t or "").split("\n"):
            held[key(x)].add(order(i))
    out = []
    for i, t in docs:
        whole = (t or "").split("\n")
        keep = [x for x in whole if len(key(x)) < min_chars or len(held[key(x)]) < min_docs or order(i) == min(held[key(x)])]
        out.append((i, len(whole), len(whole) - len(keep), None if t is None else "\n".join(keep)))
    return sorted(out, key=repr)


LINE = "A line of its own length"
ROWS = [
    (5, f"{LINE}\nshort\n{LINE.upper()}\n"), (3, f"  {LINE}\t\nshort\nanother line, only here"), (9, f"{LINE}\x0b\n\n\r\nother words of nine"), (9, f"{LINE}\nrow that shares its id"),
    (None, "a line without an id\nand more"), (None, "a line without an id"), (11, "A LINE WITHOUT AN ID"), (12, None), (13, ""), (14, "\n\n"),
    (15, "ÄÖÜ größe line\nnine char"), (16, "äÖÜ größe line\nNINE CHAR"), (17, "ÄÖÜ GRößE LINE\xa0"), (17, "ÄÖÜ größe line"), (18, "\n".join(f"line number {i % 700}" for i in range(3000))), (19, "line number 13\nline number 0013"),
]


def test_matches_sql(spark, duck, sf):
    got_cols, got, want_cols, want = oracle.both(spark, duck, ln.op13_line_dedup, ln.ORACLE_SQL, sf)
    assert got_cols == want_cols and got == want and any(r[got_cols.index("n_dropped")] for r in got)


@pytest.mark.parametrize(("min_docs", "min_chars"), [(2, 10), (3, 10), (2, 0), (4, 1)])
def test_plain_rule(spark, min_docs, min_chars):
    docs = spark.createDataFrame(ROWS * 2, "doc_id long, text string").repartition(5)
    got = ln.dedupe_lines(docs, min_docs=min_docs, min_chars=min_chars).select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(ROWS * 2, min_docs, min_chars)


def test_odd_documents(odd_docs, no_docs):
    docs = odd_docs.withColumns({"n_lines": F.lit("clash"), "gone": F.lit(1), "lines": F.lit(2), "own": F.lit(3), "row": F.lit(4), "doc": F.lit(5), "a.b": F.lit(6)})
    out = ln.dedupe_lines(docs)
    assert out.columns == [*(c for c in docs.columns if c != "n_lines"), "n_lines", "n_dropped"] and out.count() == 9
    assert {tuple(out.select("gone", "lines", "own", "row", "doc", "`a.b`").first())} == {(1, 2, 3, 4, 5, 6)}
    assert out.where("doc_id = 2 and n_dropped = 1 and text = ''").count() == 2 and out.where("doc_id = 3 and text is null").count() == 1
    assert ln.dedupe_lines(no_docs).count() == 0
    with pytest.raises(ValueError, match="two documents"):
        ln.dedupe_lines(odd_docs, min_docs=1)
