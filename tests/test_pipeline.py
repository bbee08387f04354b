"""Step pipelines and expressions on small tables."""

import pytest

from millrace.plans import pipeline as pl
from millrace.plans.jsexpr import ExpressionError
from millrace.plans.registry import ArgumentError, coerce


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame([(0, "Alpha", 10, "Alice"), (1, "Beta", 30, "Bob"), (2, "Gamma", 20, "Charlie")], "pos int, title string, score int, author string")


def go(df, spec, **args):
    return [tuple(r) for r in pl.run(spec, df, ["pos"], args).collect()]


def column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "pos int, value string")


def test_map_index_and_interpolation(posts):
    out = go(posts, [{"map": {"t": "${{ item.title | upper }}", "rank": "${{ index + 1 }}", "s": "s=${{ item.score }}!", "none": "${{ item.gone ?? 'x' }}"}}])
    assert out == [("ALPHA", 1, "s=10!", "x"), ("BETA", 2, "s=30!", "x"), ("GAMMA", 3, "s=20!", "x")]


def test_filter_truthiness(posts):
    assert [r[1] for r in go(posts, [{"filter": "item.score > 10 && item.title"}])] == ["Beta", "Gamma"]
    assert go(posts, [{"filter": "item.missing"}]) == []
    assert len(go(posts, [{"filter": "!item.missing || item.score === 99"}])) == 3


def test_sort_limit_rank(posts):
    spec = [{"sort": {"by": "score", "order": "desc"}}, {"limit": "${{ args.n }}"}, {"map": {"rank": "${{ index + 1 }}", "t": "${{ title }}"}}]
    assert go(posts, spec, n=2) == [(1, "Beta"), (2, "Gamma")]


@pytest.mark.parametrize(("n", "want"), [(2, 2), (-1, 2), (0, 0), ("x", 0), (1.9, 1), (None, 0), (99, 3)])
def test_limit(posts, n, want):
    assert len(go(posts, [{"limit": n}])) == want


@pytest.mark.parametrize(
    ("values", "want"),
    [(["99", "1000", "250"], ["99", "250", "1000"]), (["10.0", "9.5", "100.0"], ["9.5", "10.0", "100.0"]), (["2", "0x10", "1a"], ["0x10", "1a", "2"]), (["1a", "2", "0x10"], ["0x10", "1a", "2"]), (["3", None, "1"], [None, "1", "3"]), (["a10", "a9", ""], ["", "a9", "a10"])],
)
def test_sort_modes(spark, values, want):
    assert [r[1] for r in go(column(spark, values), [{"sort": "value"}])] == want


def test_blank_numbers_sort_last_descending(spark):
    assert [r[1] for r in go(column(spark, ["1", " ", "3"]), [{"sort": {"by": "value", "order": "desc"}}])] == ["3", "1", " "]


EXPRESSIONS = [
    ("item.score > 5 ? 'hi' : 'lo'", "hi"), ("Math.min(item.score, 3) + 1", 4.0), ("item.none || 'x' + item.title", "xAlpha"), ("item.title.slice(0, -1) | slugify", "alph"),
    ("new Date(864000000).toISOString().slice(0, 10)", "1970-01-11"), ("Number('0x1f') / 2", 15.5), ("encodeURIComponent('a b!')", "a%20b!"), ("'a' + 'b'", "ab"), ("`t:${item.title}`", "t:Alpha"),
    ("item.title.length", 5), ("item.title | truncate(3)", "Alp..."), ("item.none | default(7)", 7), ("item.title | nofilter", "Alpha"), ("'x/y.tar.gz' | ext", ".gz"), ("'a/b/c' | basename", "c"),
    ("'a:b*c' | sanitize", "a_b_c"), ("'%41' | urldecode", "A"), ("item.title | json", '"Alpha"'), ("7 % 4", 3.0), ("1 / 0", float("inf")), ("item.score.toFixed(1)", "10.0"), ("!item.none", True), ("item.title?.toLowerCase()", "alpha"),
]


@pytest.mark.parametrize(("text", "want"), EXPRESSIONS)
def test_expressions(posts, text, want):
    assert go(posts, [{"limit": 1}, {"map": {"v": "${{ " + text + " }}"}}]) == [(want,)]


def test_arrays(spark):
    df = spark.createDataFrame([(0, ["a", "b"], [])], "pos int, xs array<string>, no array<string>")
    spec = [{"map": {"j": "${{ item.xs | join('-') }}", "f": "${{ item.xs | first }}", "l": "${{ item.xs | last }}", "n": "${{ item.xs.length }}", "i": "${{ item.xs[1] }}", "gone": "${{ item.xs[9] ?? '' }}", "k": "${{ item.xs | keys | join('') }}", "e": "${{ item.no | first }}"}}]
    assert go(df, spec) == [("a-b", "a", "b", 2, "b", "", "01", None)]


@pytest.mark.parametrize("text", ["item.constructor", "process.exit()", "item.", "foo(", "a" * 2001, "item.title.nope()", "this"])
def test_bad_expressions_raise_at_plan_time(posts, text):
    with pytest.raises(ExpressionError):
        pl.run([{"map": {"v": "${{ " + text + " }}"}}], posts, ["pos"])


def test_unknown_step(posts):
    with pytest.raises(pl.PipelineError):
        pl.run([{"nope": 1}], posts, ["pos"])
    assert pl.validate([{"a": 1, "b": 2}, {"sort": "x"}]) == ["step 0: must have exactly one key"]


def test_own_step_and_pass_through(posts):
    from dataclasses import replace

    pl.register_step("double", lambda st, p: replace(st, df=st.df.union(st.df)))
    assert len(go(posts, [{"navigate": "x"}, {"double": None}, {"click": "y"}])) == 6


def test_topk_plan_has_no_full_sort(posts):
    df = pl.run([{"sort": "score"}, {"limit": 2}], posts, ["pos"], ordered=False)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_filter_is_pushed_down(spark, sf):
    df = pl.run([{"filter": "item.o_orderstatus === 'F'"}, {"map": {"k": "${{ item.o_orderkey }}"}}], spark.read.parquet(f"{sf}/orders.parquet"), ["o_orderkey"], ordered=False)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "EqualNullSafe(o_orderstatus,F)" in plan and "o_totalprice" not in plan


def test_arguments():
    specs = [{"name": "n", "type": "int", "default": 5}, {"name": "q", "required": True}, {"name": "b", "type": "bool"}, {"name": "c", "choices": ["x"]}]
    assert coerce(specs, {"q": "a", "b": "0"}) == {"n": 5, "q": "a", "b": False}
    for bad in ({}, {"q": "a", "n": "x"}, {"q": "a", "b": "maybe"}, {"q": "a", "c": "y"}, {"q": "a", "z": 1}):
        with pytest.raises(ArgumentError):
            coerce(specs, bad)
