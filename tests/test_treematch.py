"""Trees of two versions against a plain recursion."""

import random

from pyspark.sql import functions as F

from millrace.operators.treematch import match_trees

KINDS = "doc long, node long, parent long, pos int, key string, fingerprint string, kind string, content string"


def recursion(old, new):
    """{(old, new, change)} of rows (node, parent, pos, key, fingerprint, kind, content) of one tree."""
    kids = lambda rows, p: sorted((r for r in rows if r[1] == p), key=lambda r: r[2])
    out = set()

    def below(rows, r):
        return [r, *(x for k in kids(rows, r[0]) for x in below(rows, k))]

    def match(po, pn):
        a, b = kids(old, po), kids(new, pn)
        pairs = []
        for by in (3, 4):
            for value in {r[by] for r in a if r[by] is not None}:
                pairs_now = list(zip([r for r in a if r[by] == value], [r for r in b if r[by] == value], strict=False))
                pairs += pairs_now
            a = [r for r in a if all(r is not p[0] for p in pairs)]
            b = [r for r in b if all(r is not p[1] for p in pairs)]
        for r in list(a):
            other = next((x for x in b if x[2] == r[2] and x[5] == r[5]), None)
            if other:
                pairs.append((r, other))
                a.remove(r)
                b.remove(other)
        for x, y in pairs:
            out.add((x[0], y[0], "same" if x[6] == y[6] else "modified"))
            match(x[0], y[0])
        out.update((x[0], None, "removed") for r in a for x in below(old, r))
        out.update((None, x[0], "added") for r in b for x in below(new, r))

    match(None, None)
    return out


def grow(rng, depth=0, parent=None, rows=None):
    rows = [] if rows is None else rows
    for pos in range(rng.randrange(1, 4)):
        node = len(rows)
        rows.append((node, parent, pos, rng.choice([None, "a", "b", "c", "d"]), rng.choice(["f", "g", "h"]), rng.choice(["x", "y"]), rng.choice("123")))
        if depth < 4 and rng.random() < 0.6:
            grow(rng, depth + 1, node, rows)
    return rows


def changed(rng, rows):
    """Some nodes go with all below them, others change key, place or content, all get new numbers."""
    gone = set()
    for r in rows:
        if rng.random() < 0.08 or r[1] in gone:
            gone.add(r[0])
    kept = [r for r in rows if r[0] not in gone]
    names = {r[0]: i for i, r in zip(rng.sample(range(len(kept)), len(kept)), kept, strict=True)}
    out = []
    for parent in {r[1] for r in kept}:
        kids = [r for r in kept if r[1] == parent]
        if rng.random() < 0.3:
            rng.shuffle(kids)
        for pos, r in enumerate(kids):
            out.append((names[r[0]], None if parent is None else names[parent], pos, rng.choice([r[3], r[3], r[3], "e", None]), rng.choice([r[4], r[4], "k"]), r[5], rng.choice([r[6], r[6], "9"])))
    return out


def test_random_trees(spark):
    rng = random.Random(51)
    olds = {i: grow(rng) for i in range(40)}
    news = {i: changed(rng, rows) for i, rows in olds.items()}
    olds[98], news[99] = grow(rng), grow(rng)
    frame = lambda trees: spark.createDataFrame([(i, *r) for i, rows in trees.items() for r in rows], KINDS).repartition(4)
    got = {}
    for r in match_trees(frame(olds), frame(news), "doc").collect():
        assert (r.old_node, r.new_node, r.change) not in got.setdefault(r.doc, set())
        got[r.doc].add((r.old_node, r.new_node, r.change))
    want = {i: recursion(olds.get(i, []), news.get(i, [])) for i in {*olds, *news}}
    assert got == {i: w for i, w in want.items() if w}
    assert {c for w in want.values() for _, _, c in w} == {"same", "modified", "added", "removed"}


def test_children_of_a_renamed_and_moved_parent_are_the_same(spark):
    old = [(1, 0, None, 0, "root", "r", "x", ""), (1, 1, 0, 0, "menu", "m", "x", "Menu"), (1, 2, 1, 0, "k", "t", "x", "text"), (1, 3, 0, 1, "other", "o", "x", "")]
    new = [(1, 0, None, 0, "root", "r", "x", ""), (1, 1, 0, 0, "other", "o", "x", ""), (1, 5, 0, 1, "bar", "m", "x", "Bar"), (1, 6, 5, 0, "k", "t", "x", "text")]
    got = {tuple(r)[1:] for r in match_trees(spark.createDataFrame(old, KINDS), spark.createDataFrame(new, KINDS), "doc").collect()}
    assert got == {(0, 0, "same"), (1, 5, "modified"), (2, 6, "same"), (3, 1, "same")}


def test_empty(spark):
    none = spark.createDataFrame([], KINDS)
    one = spark.createDataFrame([(1, 0, None, 0, "a", "a", "x", "")], KINDS)
    assert match_trees(none, none, "doc").count() == 0
    assert [r.change for r in match_trees(none, one, "doc").collect()] == ["added"] and [r.change for r in match_trees(one, none, "doc").collect()] == ["removed"]
    assert match_trees(one, one, "doc").where(F.col("change") == "same").count() == 1
