"""Compiler from the expression language of step templates to Columns.

A recursive-descent parser gives a small tree; compiling resolves paths against a scope of named values
with Spark types, so every expression stays in the JVM.  What the language subset doesn't have raises
ExpressionError when the plan is built: nothing turns into null silently.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import filters, js, variant


class ExpressionError(ValueError):
    pass


@dataclass
class Value:
    col: Column
    type: T.DataType


#: Names that expressions may never use.
FORBIDDEN = {"constructor", "prototype", "__proto__", "eval", "Function", "process", "require", "import", "globalThis", "window", "this"}
LIMIT = 2000
_TOKEN = re.compile(
    r"""\s*(?:(?P<num>\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)|(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<tpl>`(?:[^`\\]|\\.)*`)"""
    r"""|(?P<id>[A-Za-z_$][\w$]*)|(?P<op>===|!==|\?\?|\?\.|&&|\|\||==|!=|<=|>=|[-+*/%!<>?:.,()\[\]|]))"""
)


def tokens(text: str) -> list[tuple[str, str]]:
    if len(text) > LIMIT:
        raise ExpressionError(f"longer than {LIMIT} characters")
    out, at = [], 0
    text = text.rstrip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ExpressionError(f"unexpected {text[at:at + 10]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class Parser:
    LEVELS = (("??",), ("||",), ("&&",), ("===", "!==", "==", "!="), ("<", ">", "<=", ">="), ("+", "-"), ("*", "/", "%"))

    def __init__(self, text: str):
        self.toks, self.at = tokens(text), 0

    def peek(self, *ops: str) -> bool:
        return self.at < len(self.toks) and self.toks[self.at][0] == "op" and self.toks[self.at][1] in ops

    def take(self, *ops: str) -> str:
        if not self.peek(*ops):
            raise ExpressionError(f"expected {' or '.join(ops)}")
        self.at += 1
        return self.toks[self.at - 1][1]

    def parse(self):
        """An expression, then `| filter(args)` any number of times."""
        node = self.ternary()
        while self.peek("|"):
            self.take("|")
            name, args = self.name(), []
            if self.peek("("):
                args = self.arguments()
            node = ("filter", name, node, args)
        if self.at != len(self.toks):
            raise ExpressionError(f"unexpected {self.toks[self.at][1]!r}")
        return node

    def name(self) -> str:
        if self.at >= len(self.toks) or self.toks[self.at][0] != "id":
            raise ExpressionError("expected a name")
        self.at += 1
        return self.toks[self.at - 1][1]

    def ternary(self):
        cond = self.binary(0)
        if self.peek("?"):
            self.take("?")
            a = self.ternary()
            self.take(":")
            return ("if", cond, a, self.ternary())
        return cond

    def binary(self, level: int):
        if level == len(self.LEVELS):
            return self.unary()
        node = self.binary(level + 1)
        while self.peek(*self.LEVELS[level]):
            node = ("op", self.take(*self.LEVELS[level]), node, self.binary(level + 1))
        return node

    def unary(self):
        if self.peek("!", "-", "+"):
            return ("unary", self.take("!", "-", "+"), self.unary())
        if self.at < len(self.toks) and self.toks[self.at] == ("id", "new"):
            self.at += 1
        return self.postfix(self.primary())

    def arguments(self) -> list:
        self.take("(")
        out = []
        while not self.peek(")"):
            out.append(self.ternary())
            if not self.peek(")"):
                self.take(",")
        self.take(")")
        return out

    def postfix(self, node):
        while True:
            if self.peek(".", "?."):
                self.take(".", "?.")
                if self.peek("["):
                    continue
                kind, text = self.toks[self.at] if self.at < len(self.toks) else ("", "")
                if kind == "num" and text.isdigit():
                    self.at += 1
                    node = ("get", node, ("lit", int(text)))
                else:
                    node = ("get", node, ("lit", self.name()))
            elif self.peek("["):
                self.take("[")
                node = ("get", node, self.ternary())
                self.take("]")
            elif self.peek("("):
                node = ("call", node, self.arguments())
            else:
                return node

    def primary(self):
        if self.at >= len(self.toks):
            raise ExpressionError("unexpected end")
        kind, text = self.toks[self.at]
        if kind == "op":
            if text == "(":
                self.take("(")
                node = self.ternary()
                self.take(")")
                return node
            raise ExpressionError(f"unexpected {text!r}")
        self.at += 1
        if kind == "num":
            return ("lit", float(text) if re.search("[.eE]", text) else int(text))
        if kind == "str":
            return ("lit", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1]))
        if kind == "tpl":
            parts = re.split(r"\$\{([^}]*)\}", text[1:-1])
            return ("template", [("lit", p) if i % 2 == 0 else Parser(p).parse() for i, p in enumerate(parts)])
        if text in ("true", "false"):
            return ("lit", text == "true")
        if text in ("null", "undefined"):
            return ("lit", None)
        if text in FORBIDDEN:
            raise ExpressionError(f"{text} may not be used")
        return ("name", text)


NUM, STR, BOOL, NULL = T.DoubleType(), T.StringType(), T.BooleanType(), T.NullType()


def literal(v) -> Value:
    kind = NULL if v is None else BOOL if isinstance(v, bool) else T.LongType() if isinstance(v, int) else NUM if isinstance(v, float) else STR
    return Value(F.lit(v), kind)


def _any(*values: Value) -> bool:
    return any(variant.is_variant(v.type) for v in values)


def _common(a: Value, b: Value) -> tuple[Column, Column, T.DataType]:
    if _any(a, b):
        return variant.wrapped(a.col, a.type), variant.wrapped(b.col, b.type), T.VariantType()
    if isinstance(a.type, T.NullType):
        return a.col, b.col, b.type
    if isinstance(b.type, T.NullType) or a.type == b.type:
        return a.col, b.col, a.type
    if js.is_numeric(a.type) and js.is_numeric(b.type):
        return a.col.cast("double"), b.col.cast("double"), NUM
    missing = F.lit(None).cast("string")
    return F.when(a.col.isNotNull(), js.string(a.col, a.type)).otherwise(missing), F.when(b.col.isNotNull(), js.string(b.col, b.type)).otherwise(missing), STR


class Compiler:
    """scope: name -> Value; names not in it are read as item.<name>."""

    def __init__(self, scope: dict[str, Value]):
        self.scope = scope

    def __call__(self, text: str) -> Value:
        return self.node(Parser(text).parse())

    def node(self, n) -> Value:
        return getattr(self, "_" + n[0])(*n[1:])

    def _lit(self, v) -> Value:
        return literal(v)

    def _name(self, name: str) -> Value:
        if name in self.scope:
            return self.scope[name]
        if "item" in self.scope:
            return self._field(self.scope["item"], name)
        raise ExpressionError(f"unknown name {name}")

    def _field(self, v: Value, key) -> Value:
        if key in FORBIDDEN:
            raise ExpressionError(f"{key} may not be used")
        t = v.type
        if variant.is_variant(t):
            return Value(*variant.field(v.col, key))
        if isinstance(t, T.StructType):
            return Value(v.col.getField(str(key)), t[str(key)].dataType) if str(key) in t.names else literal(None)
        if isinstance(t, T.MapType):
            return Value(F.try_element_at(v.col, F.lit(key).cast(t.keyType)), t.valueType)
        if isinstance(t, T.ArrayType):
            if key == "length":
                return Value(F.size(v.col), T.IntegerType())
            if isinstance(key, int) or (isinstance(key, str) and key.isdigit()):
                return Value(F.get(v.col, F.lit(int(key))), t.elementType)
            return literal(None)
        if isinstance(t, T.StringType) and key == "length":
            return Value(F.length(v.col), T.IntegerType())
        return literal(None)

    def _get(self, obj, key) -> Value:
        v = self.node(obj)
        if key[0] == "lit":
            return self._field(v, key[1])
        k = self.node(key)
        if variant.is_variant(v.type) and js.is_numeric(k.type):
            return Value(*variant.element(v.col, k.col))
        if isinstance(v.type, T.ArrayType) and js.is_numeric(k.type):
            return Value(F.get(v.col, k.col.cast("int")), v.type.elementType)
        if isinstance(v.type, T.MapType):
            return Value(F.try_element_at(v.col, k.col.cast(v.type.keyType)), v.type.valueType)
        raise ExpressionError("a computed key needs an array or a map")

    def truth(self, n) -> Column:
        """Truthiness of a node; operands of && || ! keep their own types."""
        if n[0] == "op" and n[1] in ("&&", "||"):
            a, b = self.truth(n[2]), self.truth(n[3])
            return a & b if n[1] == "&&" else a | b
        if n[0] == "unary" and n[1] == "!":
            return ~self.truth(n[2])
        v = self.node(n)
        return js.truthy(v.col, v.type)

    def condition(self, text: str) -> Column:
        return self.truth(Parser(text).parse())

    def _if(self, c, a, b) -> Value:
        x, y, t = _common(self.node(a), self.node(b))
        return Value(F.when(self.truth(c), x).otherwise(y), t)

    def _template(self, parts) -> Value:
        return Value(F.concat(*[js.string(v.col, v.type, "undefined") for v in map(self.node, parts)]), STR)

    def _unary(self, op: str, x) -> Value:
        if op == "!":
            return Value(~self.truth(x), BOOL)
        v = self.node(x)
        n = js.number(v.col, v.type)
        return Value(-n if op == "-" else n, NUM)

    def _op(self, op: str, left, right) -> Value:
        a, b = self.node(left), self.node(right)
        if op == "??":
            x, y, t = _common(a, b)
            return Value(F.when(variant.kind(x).isin("undefined", "null"), y).otherwise(x) if _any(a, b) else F.coalesce(x, y), t)
        if op in ("||", "&&"):
            x, y, t = _common(a, b)
            keep = self.truth(left)
            return Value(F.when(keep if op == "||" else ~keep, x).otherwise(y), t)
        if op in ("===", "!==", "==", "!="):
            strict = len(op) == 3
            if _any(a, b):
                same = variant.equal(variant.wrapped(a.col, a.type), variant.wrapped(b.col, b.type), strict)
                return Value(~same if op[0] == "!" else same, BOOL)
            comparable = type(a.type) is type(b.type) or js.is_numeric(a.type) and js.is_numeric(b.type) or NULL in (a.type, b.type)
            if comparable:
                x, y, _ = _common(a, b)
                same = x.eqNullSafe(y)
            elif strict:
                same = a.col.isNull() & b.col.isNull()
            else:
                same = F.when(a.col.isNull() | b.col.isNull(), a.col.isNull() & b.col.isNull()).otherwise(js.number(a.col, a.type) == js.number(b.col, b.type))
            return Value(~same if op[0] == "!" else same, BOOL)
        if _any(a, b) and op in ("<", ">", "<=", ">=", "+"):
            x, y = variant.wrapped(a.col, a.type), variant.wrapped(b.col, b.type)
            return Value(variant.plus(x, y), T.VariantType()) if op == "+" else Value(variant.compare(op, x, y), BOOL)
        both_text = isinstance(a.type, T.StringType) and isinstance(b.type, T.StringType)
        if op == "+" and (isinstance(a.type, T.StringType) or isinstance(b.type, T.StringType)):
            return Value(F.concat(js.string(a.col, a.type, "undefined"), js.string(b.col, b.type, "undefined")), STR)
        if op in ("<", ">", "<=", ">="):
            x, y = (a.col, b.col) if both_text else (js.number(a.col, a.type), js.number(b.col, b.type))
            ok = {"<": x < y, ">": x > y, "<=": x <= y, ">=": x >= y}[op]
            return Value(F.coalesce(ok if both_text else ok & ~F.isnan(x) & ~F.isnan(y), F.lit(False)), BOOL)
        if op in "+-*" and all(isinstance(v.type, (T.IntegerType, T.LongType)) for v in (a, b)):
            x, y = a.col.cast("long"), b.col.cast("long")
            x, y = F.coalesce(x, F.lit(0)), F.coalesce(y, F.lit(0))
            return Value({"+": x + y, "-": x - y, "*": x * y}[op], T.LongType())
        x, y = js.number(a.col, a.type), js.number(b.col, b.type)
        if op in "+-*":
            return Value({"+": x + y, "-": x - y, "*": x * y}[op], NUM)
        if op == "%":
            return Value(F.when(y == 0, float("nan")).otherwise(x - y * F.when(F.try_divide(x, y) < 0, F.ceil(F.try_divide(x, y))).otherwise(F.floor(F.try_divide(x, y)))), NUM)
        by_zero = F.when((x == 0) | F.isnan(x), float("nan")).when(x > 0, float("inf")).otherwise(float("-inf"))
        return Value(F.when(y == 0, by_zero).otherwise(F.try_divide(x, y)), NUM)

    def _filter(self, name: str, x, args) -> Value:
        v = self.node(x)
        f = filters.FILTERS.get(name)
        if f is None:  # an unknown filter leaves the value
            return v
        if variant.is_variant(v.type):
            return self._variant_filter(name, v, args)
        given = []
        for a in args:
            if a[0] == "name":
                given.append(a[1])
            elif a[0] == "lit":
                given.append(a[1])
            else:
                raise ExpressionError(f"arguments of {name} are literals")
        return Value(*f(v.col, v.type, *given))

    def _variant_filter(self, name: str, v: Value, args) -> Value:
        """Text filters change strings and leave other values; default, length, json, join, first and last go by the value."""
        f, given = filters.FILTERS[name], [a[1] for a in args]
        text, kind, items = variant.text_of(v.col), variant.kind(v.col), variant.elements(v.col)
        if name == "default":
            return Value(F.when(kind.isin("undefined", "null") | (text == ""), F.lit(given[0] if given else "").cast("variant")).otherwise(v.col), v.type)
        if name == "json":
            return Value(F.to_json(v.col), STR)
        if name in ("first", "last"):
            return Value(F.when(kind == "array", F.get(items, F.lit(0) if name == "first" else F.size(items) - 1)).otherwise(v.col), v.type)
        if name == "length":
            return Value(*variant.field(v.col, "length"))
        if name == "join":
            joined = F.array_join(F.transform(items, lambda x: variant.string(x, "")), str(given[0]) if given else ", ")
            return Value(F.when(kind == "array", joined.cast("variant")).otherwise(v.col), v.type)
        if name == "keys":
            names = F.map_keys(F.try_variant_get(v.col, "$", "map<string,variant>"))
            return Value(F.when(kind == "object", names), T.ArrayType(STR))
        col, kept = f(text, STR, *given)
        if not isinstance(kept, T.StringType):
            raise ExpressionError(f"{name} can't be used on values of runtime type")
        return Value(F.when(kind == "string", col.cast("variant")).otherwise(v.col), v.type)

    # ------------------------------------------------------------ calls

    def _call(self, callee, args) -> Value:
        if callee[0] == "name":
            return self._function(callee[1], args)
        if callee[0] == "get" and callee[2][0] == "lit":
            if callee[1] == ("name", "Math"):
                return self._math(callee[2][1], [self.node(a) for a in args])
            if callee[1] == ("name", "JSON") and callee[2][1] == "stringify":
                v = self.node(args[0])
                return Value(*filters.json(v.col, v.type))
            return self._method(self.node(callee[1]), callee[2][1], args)
        raise ExpressionError("not a function")

    def _function(self, name: str, args) -> Value:
        v = self.node(args[0]) if args else literal(None)
        if name == "Number":
            return Value(js.number(v.col, v.type), NUM)
        if name == "String":
            return Value(js.string(v.col, v.type), STR)
        if name == "Boolean":
            return Value(js.truthy(v.col, v.type), BOOL)
        if name == "encodeURIComponent":
            return Value(filters.url_encode(js.string(v.col, v.type)), STR)
        if name == "decodeURIComponent":
            return Value(filters.url_decode(js.string(v.col, v.type)), STR)
        if name == "Date":  # milliseconds since the epoch, or an ISO string
            if js.is_numeric(v.type):
                return Value(F.timestamp_millis(v.col.cast("long")), T.TimestampType())
            return Value(v.col.try_cast("timestamp"), T.TimestampType())
        raise ExpressionError(f"unknown function {name}")

    def _math(self, name: str, args: list[Value]) -> Value:
        xs = [js.number(a.col, a.type) for a in args]
        one = {"floor": F.floor, "ceil": F.ceil, "abs": F.abs, "sqrt": F.sqrt, "log10": F.log10, "log": F.log, "trunc": lambda c: F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)), "round": lambda c: F.floor(c + 0.5)}
        if name in one:
            return Value(one[name](xs[0]).cast("double"), NUM)
        if name in ("min", "max"):
            return Value(xs[0] if len(xs) == 1 else (F.least if name == "min" else F.greatest)(*xs), NUM)
        if name == "pow":
            return Value(F.pow(xs[0], xs[1]), NUM)
        raise ExpressionError(f"unknown function Math.{name}")

    def _method(self, v: Value, name: str, args) -> Value:
        given = [self.node(a) for a in args]
        if variant.is_variant(v.type):
            if name == "includes" and given:  # of a string, or of an array
                want = variant.wrapped(given[0].col, given[0].type)
                within = F.contains(variant.text_of(v.col), variant.string(want))
                among = F.exists(variant.elements(v.col), lambda x: variant.equal(x, want, True))
                return Value(F.coalesce(within, among, F.lit(False)), BOOL)
            if name == "toFixed":
                v = Value(variant.number(v.col), NUM)
            elif name == "join":
                return Value(F.array_join(F.transform(variant.elements(v.col), lambda x: variant.string(x, "")), args[0][1] if args else ","), STR)
            elif name != "toString":
                v = Value(variant.text_of(v.col), STR)  # methods of strings; other values have none and give null
        plain = [a[1] if a[0] == "lit" else -a[2][1] if a[0] == "unary" and a[1] == "-" and a[2][0] == "lit" else None for a in args]
        if isinstance(v.type, T.TimestampType):
            if name == "toISOString":
                return Value(F.date_format(v.col, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), STR)
            if name == "getTime":
                return Value(F.unix_millis(v.col), T.LongType())
        if js.is_numeric(v.type) and name == "toFixed":
            return Value(F.regexp_replace(F.format_number(js.round_half_up(v.col, plain[0] or 0), plain[0] or 0), ",", ""), STR)
        if name == "toString":
            return Value(js.string(v.col, v.type), STR)
        if isinstance(v.type, T.StringType):
            c = v.col
            simple = {"toUpperCase": F.upper, "toLowerCase": F.lower, "trim": js.trim}
            if name in simple:
                return Value(simple[name](c), STR)
            if name in ("slice", "substring"):
                start, end = (plain + [None, None])[:2]
                start = start or 0
                n = F.length(c)
                lo = F.lit(start) if start >= 0 else F.greatest(n + start, F.lit(0))
                hi = n if end is None else F.lit(end) if end >= 0 else n + end
                return Value(F.substring(c, lo + 1, F.greatest(hi - lo, F.lit(0))), STR)
            if name in ("includes", "startsWith", "endsWith"):
                f = {"includes": F.contains, "startsWith": F.startswith, "endsWith": F.endswith}[name]
                return Value(F.coalesce(f(c, given[0].col), F.lit(False)), BOOL)
            if name == "indexOf":
                return Value((F.instr(c, plain[0]) - 1).cast("long"), T.LongType())
            if name == "split":
                return Value(F.split(c, re.escape(str(plain[0]))), T.ArrayType(STR))
            if name in ("replace", "replaceAll") and plain[0] is not None:
                count = F.instr(c, plain[0])
                all_of = F.replace(c, F.lit(plain[0]), F.lit(plain[1]))
                once = F.when(count > 0, F.concat(F.substring(c, F.lit(1), count - 1), F.lit(plain[1]), F.substring(c, count + len(plain[0]), F.length(c)))).otherwise(c)
                return Value(all_of if name == "replaceAll" else once, STR)
            if name == "padStart":
                return Value(F.when(F.length(c) >= plain[0], c).otherwise(F.lpad(c, plain[0], plain[1] if len(plain) > 1 else " ")), STR)
        if isinstance(v.type, T.ArrayType):
            if name == "join":
                return Value(*filters.join(v.col, v.type, plain[0] if plain else ","))
            if name == "includes":
                return Value(F.coalesce(F.array_contains(v.col, given[0].col), F.lit(False)), BOOL)
            if name == "slice":
                start, end = (plain + [None, None])[:2]
                n = F.size(v.col)
                lo = F.lit(start or 0) if (start or 0) >= 0 else F.greatest(n + start, F.lit(0))
                hi = n if end is None else F.lit(end) if end >= 0 else n + end
                return Value(F.slice(v.col, lo + 1, F.greatest(F.least(hi, n) - lo, F.lit(0))), v.type)
        raise ExpressionError(f"unknown method {name}")


_WHOLE = re.compile(r"^\s*\$\{\{(?P<x>(?:(?!\}\}).)*)\}\}\s*$", re.S)
_PART = re.compile(r"\$\{\{(.*?)\}\}", re.S)


def trees_of(template) -> list:
    """Parse trees of a template's expressions."""
    if not isinstance(template, str):
        return []
    if m := _WHOLE.match(template):
        return [Parser(m["x"].strip()).parse()]
    return [Parser(x.strip()).parse() for x in _PART.findall(template)]


def names_in(tree) -> set[str]:
    """Names that a tree reads: args, item, root, ..., but not fields, methods or functions."""
    if not isinstance(tree, (tuple, list)) or not tree:
        return set()
    if isinstance(tree, list):
        return set().union(*map(names_in, tree))
    kind = tree[0]
    if kind == "name":
        return {tree[1]}
    if kind == "filter":
        return names_in(tree[2])
    if kind == "call":
        callee = tree[1]
        of = set() if callee[0] == "name" or callee[0] == "get" and callee[1] in (("name", "Math"), ("name", "JSON")) else names_in(callee)
        return of | names_in(tree[2])
    return set().union(*map(names_in, tree[1:]))


#: What belongs to the row that an array was selected from, rather than to the array's element.
OUTER = {"root", "data", "args"}


def outer_parts(tree) -> tuple[list, list]:
    """(trees read from the source row alone, trees of arrays that are read at `index`), the largest ones of each."""
    names = names_in(tree)
    if names & {"root", "data"} and names <= OUTER:
        return [tree], []
    if isinstance(tree, tuple) and tree[0] == "get" and tree[2] == ("name", "index") and names_in(tree[1]) & {"root", "data"} and names_in(tree[1]) <= OUTER:
        return [], [tree[1]]
    whole, at_index = [], []
    for part in tree if isinstance(tree, list) else tree[1:]:
        if isinstance(part, (tuple, list)):
            a, b = outer_parts(part)
            whole += a
            at_index += b
    return whole, at_index


def render(template, compiler: Compiler) -> Value:
    """A template: one ${{...}} keeps its type; mixed text is concatenated; anything else is a literal."""
    if not isinstance(template, str):
        return literal(template)
    if m := _WHOLE.match(template):
        return compiler(m["x"].strip())
    parts = _PART.split(template)
    if len(parts) == 1:
        return literal(template)
    cols = [F.lit(p) if i % 2 == 0 else (lambda v: js.string(v.col, v.type, "undefined"))(compiler(p.strip())) for i, p in enumerate(parts)]
    return Value(F.concat(*cols), STR)
