"""Step pipelines: a list of one-key steps compiled to one lazily built DataFrame.

Order model: a table carries sort keys rather than a dense ordinal.  `index` is worked out only where an
expression reads it, after every limit that comes before; sort followed by limit becomes one top-k.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import js, variant
from .jsexpr import FORBIDDEN, Compiler, ExpressionError, Value, literal, names_in, outer_parts, render, trees_of


class PipelineError(ValueError):
    """Unknown step or bad parameters; raised while the plan is built."""


@dataclass
class State:
    """A table, the columns that order it, and what expressions may read besides the row."""

    df: DataFrame
    order: list[Column]
    args: dict = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    small: bool = False  # bounded by a limit, so a single-partition window is fine


PASS_THROUGH = ("navigate", "click", "type", "fill", "wait", "press")
_STEPS: dict[str, Callable[[State, object], State]] = {}


def register_step(name: str, handler: Callable[[State, object], State]) -> None:
    """Adds a step, table to table; the built-in ones go the same way."""
    _STEPS[name] = handler


def step(name: str):
    def add(f):
        register_step(name, f)
        return f

    return add


def known_steps() -> list[str]:
    return sorted(_STEPS)


def validate(spec: list[dict]) -> list[str]:
    """Problems of a spec: every step has one key, which is a known step."""
    out = []
    for i, s in enumerate(spec):
        if not isinstance(s, dict) or len(s) != 1:
            out.append(f"step {i}: must have exactly one key")
        elif next(iter(s)) not in _STEPS:
            out.append(f"step {i}: unknown step {next(iter(s))!r}")
    return out


def optimise(spec: list[dict]) -> list[dict]:
    """Drops identity steps and merges neighbouring limits; fusing projections is left to Catalyst."""
    out: list[dict] = []
    for s in spec:
        (name, params), = s.items()
        if name in PASS_THROUGH:
            continue
        if name == "limit" and out and "limit" in out[-1] and all(isinstance(x, int) and x >= 0 for x in (params, out[-1]["limit"])):
            out[-1] = {"limit": min(params, out[-1]["limit"])}
            continue
        out.append(s)
    return out


def run(spec: list[dict], df: DataFrame, order: list[str | Column], args: dict | None = None, tables: dict[str, DataFrame] | None = None, ordered: bool = True) -> DataFrame:
    """The table a spec makes of df, whose rows stand in the order of the given columns.

    ordered=False leaves out the final sort, where the reader doesn't need the rows in order.
    """
    if problems := validate(spec):
        raise PipelineError("; ".join(problems))
    keys = {f"_o{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)}
    state = State(df.withColumns(keys), [F.col(k).asc_nulls_first() for k in keys], args or {}, tables or {})
    for s in optimise(spec):
        (name, params), = s.items()
        state = _STEPS[name](state, params)
    visible = [c for c in state.df.columns if not c.startswith("_o")]
    out = state.df.orderBy(*state.order) if ordered else state.df
    return out.select(*[F.col(f"`{c}`") for c in visible])


# ---------------------------------------------------------------- scope


def _scope(state: State, df: DataFrame, extra: dict[str, Value] | None = None) -> Compiler:
    visible = [f for f in df.schema.fields if not f.name.startswith("_o") and f.name != "_index"]
    item = Value(F.struct(*[F.col(f"`{f.name}`") for f in visible]), T.StructType(visible))
    args = T.StructType([T.StructField(k, literal(v).type) for k, v in state.args.items()])
    values = F.struct(*[F.lit(v).alias(k) for k, v in state.args.items()]) if state.args else F.struct(F.lit(None).alias("_"))
    scope = {"item": item, "args": Value(values, args)}
    if "_index" in df.columns:
        scope["index"] = Value(F.col("_index"), T.LongType())
    return _Direct(scope | (extra or {}), {f.name: Value(F.col(f"`{f.name}`"), f.dataType) for f in visible}, state.args)


class _Direct(Compiler):
    """Reads item.x as the column x, so that scans stay pruned and predicates can be pushed down."""

    def __init__(self, scope, columns, args):
        super().__init__(scope)
        self.columns, self.args = columns, args

    def _get(self, obj, key):
        if key[0] == "lit" and key[1] in FORBIDDEN:
            raise ExpressionError(f"{key[1]} may not be used")
        if obj == ("name", "item") and key[0] == "lit":
            return self.columns.get(str(key[1]), literal(None))
        if obj == ("name", "args") and key[0] == "lit":
            return literal(self.args.get(str(key[1])))
        return super()._get(obj, key)

    def _name(self, name):
        if name in self.scope:
            return self.scope[name]
        if name not in self.columns:
            raise ExpressionError(f"unknown name {name}")
        return self.columns[name]


class _Selected(_Direct):
    """Also knows what was worked out on the source row before its array became rows."""

    def __init__(self, scope, columns, args, known: dict[str, Value]):
        super().__init__(scope, columns, args)
        self.known = known

    def node(self, n):
        return self.known[repr(n)] if repr(n) in self.known else super().node(n)


def _reads_index(params) -> bool:
    import re

    text = " ".join(map(str, params.values())) if isinstance(params, dict) else str(params)
    return bool(re.search(r"\bindex\b", text))


def with_index(state: State) -> DataFrame:
    """Adds _index from 0 in row order.  After a limit one small partition is sorted; else ranges are numbered."""
    if state.small:
        return state.df.withColumn("_index", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*state.order)).cast("long") - 1)
    return dense_index(state.df, state.order)


def dense_index(df: DataFrame, order: list[Column], pieces: int = 64) -> DataFrame:
    """_index from 0 without sorting all rows in one task: counts of ranges of the first key, then rows in each.

    The first key is ranked by approximate quantiles: Spark's sketch where it is numeric, those of a bounded sample
    of values where it is a text.  Other types fall back to a single window, which is meant for small tables.
    """
    name = "_o0" if "_o0" in df.columns else None
    dtype = df.schema[name].dataType if name else T.StringType()
    if not (name and (js.is_numeric(dtype) or isinstance(dtype, T.StringType))):
        return df.withColumn("_index", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("long") - 1)
    if js.is_numeric(dtype):
        cuts = sorted(set(df.select(F.col(name).cast("double").alias("k")).approxQuantile("k", [i / pieces for i in range(1, pieces)], 0.001)))
        cuts = [float(c) for c in cuts]
    else:
        cuts = text_cuts(df, name, pieces)
    descending = "DESC" in str(order[0])
    below = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(name))) if cuts else F.lit(0)
    cut = df.withColumn("_oc", F.coalesce(-below if descending else below, F.lit(pieces if descending else -1)))
    counts = cut.groupBy("_oc").count()
    before = Window.partitionBy(F.lit(0)).orderBy("_oc").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("_oc", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_ob"))
    inside = Window.partitionBy("_oc").orderBy(*order)
    return cut.join(F.broadcast(base), "_oc").withColumn("_index", F.row_number().over(inside) - 1 + F.col("_ob")).drop("_oc", "_ob")


def text_cuts(df: DataFrame, name: str, pieces: int, most: int = 20_000) -> list[str]:
    """Texts near a column's quantiles, from about `most` of its values chosen by hash; in Spark's order, by bytes."""
    values = df.select(F.col(name).alias("k")).where("k is not null")
    n = values.count()
    some = values.where(F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < int(min(1.0, most / max(1, n)) * (1 << 30))) if n > most else values
    got = sorted({r.k for r in some.distinct().collect()}, key=str.encode)
    return [got[len(got) * i // pieces] for i in range(1, pieces)] if len(got) >= pieces else got


def indexed(df: DataFrame, order: list[Column]) -> DataFrame:
    """Adds _index from 0 in the given order, for tables outside a step pipeline."""
    first = order[0]
    name = first._jc.toString().split(" ")[0]
    return dense_index(df.withColumn("_o0", F.col(name)), [_renamed(first, {name: "_o0"}), *order[1:]]).drop("_o0")


# ---------------------------------------------------------------- steps


@step("select")
def _select(state: State, path: str) -> State:
    """A dotted path: an array of structs becomes rows, a struct its columns, anything else a column `value`."""
    c = _scope(state, state.df)
    v = c(path)
    keep = [x for x in state.df.columns if x.startswith("_o")]
    if isinstance(v.type, T.ArrayType):
        df = state.df.select(*keep, F.posexplode(v.col).alias("_op", "value"))
        df = df.withColumnRenamed("_op", f"_o{len(keep)}")
        if isinstance(v.type.elementType, T.StructType):
            df = df.select(*[x for x in df.columns if x != "value"], "value.*")
        return replace(state, df=df, order=[*state.order, F.col(f"_o{len(keep)}").asc()], small=False)
    if isinstance(v.type, T.StructType):
        return replace(state, df=state.df.select(*keep, F.inline(F.array(v.col))))
    return replace(state, df=state.df.select(*keep, v.col.alias("value")))


@step("map")
def _map(state: State, template: dict) -> State:
    """Columns by templates over args, item and index; with `select`, of the rows of an array.

    After a select, `root` is the row that the array stands in and `data` the array; both are read before the
    array becomes rows, so root.other[index] pairs two arrays without carrying either along.  `index` then
    counts from 0 in each array, as it does wherever a document is one row.
    """
    template = dict(template)
    if "select" in template:
        path = template.pop("select")
        if any(names_in(x) & {"root", "data"} for t in template.values() for x in trees_of(t)):
            return _map_selected(state, path, template)
        state = _select(state, path)
    df = with_index(state) if _reads_index(template) else state.df
    compiler = _scope(state, df)
    keep = [c for c in df.columns if c.startswith("_o")]
    return replace(state, df=df.select(*keep, *[render(t, compiler).col.alias(k) for k, t in template.items()]))


def _map_selected(state: State, path: str, template: dict) -> State:
    source = _scope(state, state.df)
    array = source(path)
    if not isinstance(array.type, T.ArrayType):
        raise PipelineError(f"{path} is not an array")
    visible = [f for f in state.df.schema.fields if not f.name.startswith("_o")]
    source.scope |= {"root": Value(F.struct(*[F.col(f"`{f.name}`") for f in visible]), T.StructType(visible)), "data": array}
    whole, at_index = {}, {}
    for t in template.values():
        for tree in trees_of(t):
            a, b = outer_parts(tree)
            whole |= {repr(n): source.node(n) for n in a}
            at_index |= {repr(("get", n, ("name", "index"))): source.node(n) for n in b}
    for v in at_index.values():
        if not isinstance(v.type, T.ArrayType):
            raise ExpressionError("[index] needs an array")
    order = [c for c in state.df.columns if c.startswith("_o")]
    rows = F.transform(array.col, lambda x, i: F.struct(x.alias("item"), *[F.get(v.col, i).alias(f"z{k}") for k, v in enumerate(at_index.values())]))
    df = state.df.select(*order, *[v.col.alias(f"_h{k}") for k, v in enumerate(whole.values())], F.posexplode(rows).alias("_index", "_row"))
    element = array.type.elementType
    fields = element.fields if isinstance(element, T.StructType) else [T.StructField("value", element)]
    columns = {f.name: Value(F.col("_row.item").getField(f.name) if isinstance(element, T.StructType) else F.col("_row.item"), f.dataType) for f in fields}
    scope = source.scope | {"item": Value(F.col("_row.item"), element), "index": Value(F.col("_index"), T.LongType())}
    known = {n: Value(F.col(f"_h{k}"), v.type) for k, (n, v) in enumerate(whole.items())}
    known |= {n: Value(F.col(f"_row.z{k}"), v.type.elementType) for k, (n, v) in enumerate(at_index.items())}
    compiler = _Selected(scope, columns, state.args, known)
    position = f"_o{len(order)}"
    out = df.select(*order, F.col("_index").cast("long").alias(position), *[render(t, compiler).col.alias(k) for k, t in template.items()])
    return replace(state, df=out, order=[*state.order, F.col(position).asc()], small=False)


@step("filter")
def _filter(state: State, expression: str) -> State:
    """Keeps rows whose expression is truthy; the scope is args, item and index."""
    df = with_index(state) if _reads_index(expression) else state.df
    return replace(state, df=df.where(_scope(state, df).condition(expression)).drop("_index"))


def numeric_column(df: DataFrame, c: Column) -> bool:
    """A text column sorts as numbers if some value is one and no other is anything but blank."""
    t = js.trim(c)
    n = js.number_of_string(c)
    blank = F.coalesce(t == "", F.lit(True))
    got = df.agg(F.bool_and(blank | ~F.isnan(n)).alias("every"), F.bool_or(~blank & ~F.isnan(n)).alias("some")).first()
    return bool(got["every"]) and bool(got["some"])


def sort_key(df: DataFrame, name: str) -> Column:
    t = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if js.is_numeric(t) or isinstance(t, (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(t, T.VariantType):
        c, t = F.when(~variant.kind(c).isin("undefined", "null"), variant.string(c)), T.StringType()
    if isinstance(t, T.StringType):
        if numeric_column(df, c):
            return F.when(js.trim(c) == "", F.lit(None).cast("double")).otherwise(js.number_of_string(c))
        return js.natural_key(c)
    return js.natural_key(c.cast("string"))


@step("sort")
def _sort(state: State, params) -> State:
    """Stable: ties keep their order in either direction. Blanks come first ascending, last descending."""
    name, order = (params, "asc") if isinstance(params, str) else (params.get("by"), params.get("order", "asc"))
    if name not in state.df.columns:
        return state
    key = sort_key(state.df, name)
    old = [c for c in state.df.columns if c.startswith("_o")]
    names = {c: f"_o{i + 1}" for i, c in enumerate(old)}
    df = state.df.select(key.alias("_o0"), *[F.col(c).alias(names[c]) for c in old], *[F.col(f"`{c}`") for c in state.df.columns if c not in old])
    descending = order == "desc"
    first = F.col("_o0").desc_nulls_last() if descending else F.col("_o0").asc_nulls_first()
    rest = [_renamed(c, names) for c in state.order]
    return replace(state, df=df, order=[first, *rest])


def _renamed(c: Column, names: dict[str, str]) -> Column:
    """The same sort order over a renamed column."""
    text = c._jc.toString()
    name = text.split(" ")[0]
    out = F.col(names.get(name, name))
    if "DESC" in text:
        return out.desc_nulls_last() if "NULLS LAST" in text else out.desc_nulls_first()
    return out.asc_nulls_last() if "NULLS LAST" in text else out.asc_nulls_first()


def slice_end(value) -> int | None:
    """The end of slice(0, Number(value)): NaN and missing are 0, fractions are cut, infinity is no end."""
    try:
        n = float(value if value not in ("", None) else 0)
    except (TypeError, ValueError):
        return 0
    return 0 if n != n else None if n == float("inf") else int(n)


@step("limit")
def _limit(state: State, params) -> State:
    """The first n rows; a negative n drops rows from the end."""
    import re

    if isinstance(params, str) and (m := re.fullmatch(r"\s*\$\{\{\s*args\.(\w+)\s*\}\}\s*", params)):
        params = state.args.get(m[1])
    n = slice_end(params)
    if n is None:
        return state
    if n < 0:
        rows = dense_index(state.df, state.order) if not state.small else with_index(state)
        total = rows.agg(F.count("*").alias("n"))
        return replace(state, df=rows.crossJoin(F.broadcast(total)).where(F.col("_index") < F.col("n") + n).drop("_index", "n"))
    return replace(state, df=state.df.orderBy(*state.order).limit(n), small=n <= 100_000 or state.small)


@step("fetch")
def _fetch(state: State, params: dict) -> State:
    """A dependent fetch as a left lookup join on captured responses; what can't be had becomes an error field.

    params: table (name in tables), key (expression over the row), on (column of the table); or table, url (a
    template) and params (templates, appended as a form-encoded query): the table then has url and status, and
    a status that isn't 2xx is an error.
    """
    table = state.tables[params["table"]]
    if "url" in params:
        return _fetch_url(state, params, table)
    key = _scope(state, state.df)(params["key"])
    right = table.withColumnRenamed(params["on"], "_okey")
    taken = [c for c in right.columns if c != "_okey"]
    right = right.select("_okey", *[F.col(c).alias(f"_of_{c}") for c in taken], F.lit(True).alias("_ofound"))
    base = state.df.drop(*[c for c in taken if c in state.df.columns])
    out = base.withColumn("_okv", key.col).join(right, F.col("_okv") == F.col("_okey"), "left")
    error = F.when(F.col("_ofound").isNull(), F.lit("not found")).alias("error")
    return replace(state, df=out.select(*base.columns, *[F.col(f"_of_{c}").alias(c) for c in taken], error))


def _fetch_url(state: State, params: dict, table: DataFrame) -> State:
    from ..sources.web import with_query

    text = str(params["url"]) + " ".join(map(str, (params.get("params") or {}).values()))
    df = with_index(state) if _reads_index(text) else state.df
    scope = _scope(state, df)
    as_text = lambda v: js.string(v.col, v.type, "undefined")
    asked = with_query(as_text(render(params["url"], scope)), {k: as_text(render(v, scope)) for k, v in (params.get("params") or {}).items()})
    taken = [c for c in table.columns if c not in ("url", "status")]
    right = table.select(F.col("url").alias("_ourl"), F.col("status").alias("_ostatus"), *[F.col(f"`{c}`").alias(f"_of_{c}") for c in taken])
    base = df.drop("_index", *taken)
    out = base.withColumn("_oasked", asked).join(right, F.col("_oasked") == F.col("_ourl"), "left")
    ok = F.col("_ostatus").between(200, 299)
    error = F.when(F.col("_ostatus").isNull(), F.concat(F.lit("no response from "), F.col("_oasked"))).when(~ok, F.concat(F.lit("HTTP "), F.col("_ostatus").cast("string"), F.lit(" from "), F.col("_oasked")))
    return replace(state, df=out.select(*[F.col(f"`{c}`") for c in base.columns], *[F.when(ok, F.col(f"`_of_{c}`")).alias(c) for c in taken], error.alias("error")))


@step("evaluate")
def _evaluate(state: State, params) -> State:
    """Text that looks like JSON is parsed to VARIANT; text that doesn't parse stays as it is."""
    name = params if isinstance(params, str) else params["column"]
    return replace(state, df=state.df.withColumn(f"{name}_json", F.try_parse_json(F.when(js.trim(F.col(name)).rlike(r"^[\[{]"), F.col(name)))))


def _capture(state: State, params: dict) -> State:
    """Captured responses whose url contains a pattern, then an optional select."""
    df = state.tables[params.get("table", "captures")]
    hit = df.where(F.contains(F.col("url"), F.lit(params["capture"])))
    keys = {"_o0": F.col(params.get("order", "url"))}
    found = replace(state, df=hit.withColumns(keys), order=[F.col("_o0").asc_nulls_first()], small=False)
    return _select(found, params["select"]) if "select" in params else found


register_step("intercept", _capture)
register_step("tap", _capture)


@step("snapshot")
def _snapshot(state: State, params) -> State:
    """Replaces the table by a captured page table."""
    name = params if isinstance(params, str) else params.get("table", "pages")
    df = state.tables[name]
    return replace(state, df=df.withColumn("_o0", F.col(df.columns[0])), order=[F.col("_o0").asc_nulls_first()], small=False)


@step("download")
def _download(state: State, params: dict) -> State:
    """Plans destinations: the first row that claims a path gets it, later ones report a conflict."""
    path = render(params["path"], _scope(state, state.df)).col
    claim = Window.partitionBy("path").orderBy(*state.order)
    return replace(state, df=state.df.withColumn("path", path).withColumn("status", F.when(F.row_number().over(claim) == 1, "planned").otherwise("conflict")))


for _name in PASS_THROUGH:
    register_step(_name, lambda state, params: state)
