"""Operator 11: cheapest repair of conversations by a min-plus scan over 4x4 matrices (see `minplus`).

1. Equal rows are counted, and flags worked out, in the JVM.  A text that stands in several turns of a conversation is told by the
   smallest turn that has its role and text; a light row marks the later ones.
2. Rows are dealt by ranges of (conversation, turn), so a conversation of any length is spread over tasks.  A task repairs
   the conversations that lie within its range.  Its first and last one, and any beyond SEGMENT turns or BUFFER bytes, may
   go on elsewhere or be too long to hold: of those it gives segments, each with its product of matrices, and the turns that aren't
   certain to be deleted.
3. Segments are multiplied as a tree: first those of a task, then FAN neighbours at a time.
4. The audit that comes out is cut into the segments' parts, each goes to the turns of its segment, and the edits are applied.

Memory of a task is bounded by BUFFER and a segment; an audit is one string, so a conversation has at most some 2**30 edits.
The hash of a repaired conversation is one chain over its text: for conversations of stage 4 a task streams it in order.

Order within a conversation: turn (nulls first), then role, then MD5 of the text; equal rows are adjacent.

Input cases: a null role or text counts as one space, a null id is a conversation of its own, null turns come first and count for
no gap.  Initials are first characters; roles that begin otherwise than with s, u or a (an empty one too) can't stay.  Repeated
rows count as often as they stand there.  Empty texts are blank.  Very long texts pass through one at a time.  Other columns
are ignored.  An empty table gives an empty table.  Equal texts are those of equal MD5.  A turn that isn't a whole number raises.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import minplus
from .common import partitions, save, schema_of, tidy

WHITE = " \t\n\x0b\x0c\r"
#: Turns of a segment, bytes of text that a task holds of one conversation, and segments multiplied in one step.
SEGMENT = 1 << 14
BUFFER = 4 << 20
FAN = 16
#: Rows and bytes of text in a batch that a task gives.
OUT_ROWS, OUT_BYTES = 4000, 4 << 20
LEGAL = {"su", "ua", "au"}
COUNTS = ("blank", "duplicate", "truncated", "illegal")


# -- what one task does ------------------------------------------------------------------------------------------


@dataclass
class Segment:
    """Successive turns of a conversation: their kinds, counts, and what neighbours need to know."""

    kinds: list[str] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(COUNTS, 0))
    turns: int = 0
    low: int | None = None
    high: int | None = None
    first: str | None = None
    last: str | None = None

    def add(self, turn: int | None, role: str, copies: int, blank: bool, again: bool, cut: bool) -> None:
        initial = role[:1] or "-"
        if self.last is not None:
            self.counts["illegal"] += self.last + initial not in LEGAL
        self.counts["illegal"] += copies - 1
        self.first, self.last = self.first or initial, initial
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        if blank or again:
            self.counts["blank" if blank else "duplicate"] += copies
            self.kinds.append("d" * copies)
        else:
            kind = initial if initial in "sua" else "x"
            self.counts["truncated"] += cut
            self.counts["duplicate"] += copies - 1
            self.kinds.append((kind.upper() if cut else kind) + "d" * (copies - 1))

    def state(self, part: int, sub: int, kinds: str) -> dict:
        return {"cells": minplus.product(kinds), "segments": [(part, sub, len(kinds))], **self.counts, **{k: getattr(self, k) for k in ("turns", "low", "high", "first", "last")}}


def join_states(a: dict, b: dict) -> dict:
    """Of two neighbours in order: the product, and counts with what happens at the seam."""
    out = {"cells": minplus.times(a["cells"], b["cells"]), "segments": [*a["segments"], *b["segments"]]}
    out |= {k: a[k] + b[k] for k in COUNTS}
    if a["last"] and b["first"]:
        out["illegal"] += a["last"] + b["first"] not in LEGAL
    out["turns"] = a["turns"] + b["turns"] - (a["high"] is not None and a["high"] == b["low"])
    out |= {"low": b["low"] if a["low"] is None else a["low"], "high": a["high"] if b["high"] is None else b["high"]}
    return out | {"first": a["first"] or b["first"], "last": b["last"] or a["last"]}


def packed(state: dict) -> str:
    return json.dumps(state)


def unpacked(text: str) -> dict:
    out = json.loads(text)
    out["cells"] = tuple(None if c is None else tuple(c) for c in out["cells"])
    return out


def finished(state: dict) -> tuple:
    """gaps, the four counts, cost, audit."""
    gaps = 0 if state["low"] is None else state["high"] - state["low"] + 1 - state["turns"]
    return (gaps, *(state[k] for k in COUNTS), *minplus.cheapest(state["cells"]))


def edits(audit: str, kinds: str, turns: Iterator[tuple[str, str]], place: int, odd: bool) -> Iterator[tuple[int, str, str, str]]:
    """(place, role, text, edit) of the repaired turns; `turns` gives role and text of those whose kind isn't `d`."""
    at = 0
    for letter in audit:
        if letter == "I":
            role, text = minplus.role_at(place, odd), ""
        else:
            at += 1
            turn = None if kinds[at - 1] == "d" else next(turns)
            if letter == "D":
                continue
            role, text = turn if letter == "K" else (minplus.role_at(place, odd), turn[1])
        yield place, role, text, letter
        place += 1


def odd_length(audit: str) -> bool:
    return bool((len(audit) - audit.count("D")) % 2)


class _Out:
    """Rows of a wide table as Arrow batches of bounded size."""

    def __init__(self, schema):
        import pyarrow as pa

        self.schema, self.names, self.rows, self.held, self.pa = schema, schema.names, [], 0, pa

    def put(self, **cols) -> None:
        self.rows.append(cols)
        self.held += len(cols.get("text") or "") + len(cols.get("state") or "") + len(cols.get("audit") or "")

    def full(self) -> bool:
        return len(self.rows) >= OUT_ROWS or self.held >= OUT_BYTES

    def batch(self):
        rows, self.rows, self.held = self.rows, [], 0
        return self.pa.RecordBatch.from_arrays([self.pa.array([r.get(n) for r in rows], t) for n, t in zip(self.names, self.schema.types, strict=True)], names=self.names)


def _arrow(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


SCAN = "conv {}, tag string, part int, sub int, at int, kinds string, place long, role string, text string, edit string, state string, sha string, audit string, cost long, gaps long, blank long, duplicate long, truncated long, illegal long"


class _Conversation:
    """Turns of one conversation as they pass a task; `spread`: it may have more of them elsewhere."""

    def __init__(self, out: _Out, conv, part: int, spread: bool, turns: bool, most: int, buffer: int):
        self.out, self.conv, self.part, self.spread, self.turns, self.most, self.buffer = out, conv, part, spread, turns, most, buffer
        self.segment, self.held, self.size, self.bytes, self.sub = Segment(), [], 0, 0, 0

    def add(self, turn, role, text, copies, blank, again, cut) -> None:
        while copies:
            take = min(copies, self.most - self.size)
            self.segment.add(turn, role, take, blank, again, cut)
            if not (blank or again):
                if self.spread:
                    self.out.put(conv=self.conv, tag="turn", part=self.part, sub=self.sub, at=self.size, role=role, text=text)
                else:
                    self.held.append((self.size, role, text))
                    self.bytes += len(text)
            copies, self.size, again = copies - take, self.size + take, True
            if not self.spread and (self.size == self.most or self.bytes > self.buffer):
                self.spill()
            if self.size == self.most:
                self.cut()

    def spill(self) -> None:
        """From now on turns aren't held."""
        self.spread = True
        for at, role, text in self.held:
            self.out.put(conv=self.conv, tag="turn", part=self.part, sub=self.sub, at=at, role=role, text=text)
        self.held, self.bytes = [], 0

    def cut(self) -> None:
        kinds = "".join(self.segment.kinds)
        self.out.put(conv=self.conv, tag="segment", part=self.part, sub=self.sub, kinds=kinds, state=packed(self.segment.state(self.part, self.sub, kinds)))
        self.segment, self.size, self.sub = Segment(), 0, self.sub + 1

    def close(self, last: bool) -> None:
        if last and not self.spread:
            self.spill()
        if self.spread:
            if self.size or not self.sub:
                self.cut()
            return
        kinds = "".join(self.segment.kinds)
        gaps, *counts, cost, audit = finished(self.segment.state(self.part, 0, kinds))
        sha = hashlib.sha256()
        for place, role, text, edit in edits(audit, kinds, ((r, t) for _, r, t in self.held), 0, odd_length(audit)):
            sha.update(f"{chr(10) * (place > 0)}{role}:{text}".encode())
            if self.turns:
                self.out.put(conv=self.conv, tag="repaired", place=place, role=role, text=text, edit=edit)
        self.out.put(conv=self.conv, tag="whole", sha=sha.hexdigest(), audit=audit, cost=cost, gaps=gaps, **dict(zip(COUNTS, counts, strict=True)))


# -- Spark ---------------------------------------------------------------------------------------------------------


def _key(c: Column) -> Column:
    return F.struct(c.isNotNull().alias("has"), c.alias("turn"))


def counted(rows: DataFrame) -> DataFrame:
    """Equal rows once, with copies and flags.  rows: conv, turn, role, text, copies (0: the conversation is there, the row isn't)."""
    there = F.col("copies") > 0
    rows = rows.select("conv", *(F.when(there, F.coalesce(c, F.lit(" ")) if c in ("role", "text") else F.col(c)).alias(c) for c in ("turn", "role", "text")), "copies")
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    return rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumns({"tie": F.md5("text"), "blank": F.ltrim(bare, F.lit(WHITE)) == "", "cut": ~F.right(bare, F.lit(1)).isin(".", "!", "?")})


def marked(rows: DataFrame) -> DataFrame:
    """The rows, and before each whose role and text stand in an earlier turn a row with mark 0."""
    light = rows.where("copies > 0 and not blank").select("conv", "turn", "role", "tie")
    several = save(light.groupBy("conv", "role", "tie").agg(F.min(_key(F.col("turn"))).alias("first"), F.count("*").alias("k")).where("k > 1").select(*(F.col(c).alias(f"{c}_") for c in ("conv", "role", "tie")), "first"), "several")
    later = light.join(several, F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("role") == F.col("role_")) & (F.col("tie") == F.col("tie_"))).where(_key(F.col("turn")) > F.col("first"))
    marks = later.select("conv", "turn", "role", "tie", F.lit(0).alias("mark"), *(F.lit(None).cast(t).alias(c) for c, t in (("text", "string"), ("copies", "long"), ("blank", "boolean"), ("cut", "boolean"))))
    return rows.select("conv", "turn", "role", "tie", F.lit(1).alias("mark"), "text", "copies", "blank", "cut").unionByName(marks)


def scanned(rows: DataFrame, turns: bool, segment: int, buffer: int) -> DataFrame:
    """Whole conversations, repaired turns, segments and their turns (by tag) of rows dealt by ranges."""
    order = ["conv", "turn", "role", "tie"]
    schema = T._parse_datatype_string(SCAN.format(rows.schema["conv"].dataType.simpleString()))
    arrow = _arrow(schema)

    def run(batches):
        from pyspark import TaskContext

        part, out, now, mark = TaskContext.get().partitionId(), _Out(arrow), None, None
        for b in batches:
            for conv, turn, role, tie, kind, text, copies, blank, cut in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        now.close(False)
                    now = _Conversation(out, conv, part, now is None, turns, segment, buffer)
                if kind == 0:
                    mark = (turn, role, tie)
                elif copies:
                    now.add(turn, role, text, copies, blank, mark == (turn, role, tie), cut)
                    mark = None
                if out.full():
                    yield out.batch()
        if now is not None:
            now.close(True)
        if out.rows:
            yield out.batch()

    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order, "mark").select(*order, "mark", "text", "copies", "blank", "cut")
    return dealt.mapInArrow(tidy(run), schema)


@F.udf(T.StringType(), useArrow=True)
def _multiplied(states):
    parts = [unpacked(s) for s in states]
    while len(parts) > 1:
        pairs = [join_states(a, b) for a, b in zip(parts[::2], parts[1::2], strict=False)]
        parts = pairs + parts[len(pairs) * 2 :]
    return packed(parts[0])


def multiplied(segments: DataFrame) -> DataFrame:
    """conv, state: the product of each conversation's segments in order, as a tree over tasks."""
    parts = (segments.agg(F.max("part")).first()[0] or 0) + 1
    state = _multiplied(F.transform(F.array_sort(F.collect_list(F.struct("at", "state"))), lambda s: s["state"])).alias("state")
    tree = segments.withColumn("at", F.col("sub")).groupBy("conv", "part").agg(state).withColumnRenamed("part", "at")
    step = 1
    while step < parts:
        step *= FAN
        tree = save(tree.groupBy("conv", F.expr(f"at div {FAN}").cast("int").alias("up")).agg(state).withColumnRenamed("up", "at"), "tree")
    return tree.select("conv", "state")


def _slices(whole: DataFrame) -> DataFrame:
    """The audit's part for each segment, with the place of its first repaired turn; the last segment has the inserts at the end."""
    schema = T._parse_datatype_string(f"conv {whole.schema['conv'].dataType.simpleString()}, part int, sub int, slice string, place long, odd boolean")
    arrow = _arrow(schema)

    def run(batches):
        out = _Out(arrow)
        for b in batches:
            for conv, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                state = unpacked(text)
                audit, place, at = minplus.cheapest(state["cells"])[1], 0, 0
                for k, (part, sub, n) in enumerate(state["segments"]):
                    end = at
                    while n:
                        n -= audit[end] != "I"
                        end += 1
                    piece = audit[at:] if k + 1 == len(state["segments"]) else audit[at:end]
                    out.put(conv=conv, part=part, sub=sub, slice=piece, place=place, odd=odd_length(audit))
                    place, at = place + len(piece) - piece.count("D"), end
                    if out.full():
                        yield out.batch()
        if out.rows:
            yield out.batch()

    return whole.select("conv", "state").mapInArrow(tidy(run), schema)


def applied(scan: DataFrame, whole: DataFrame) -> DataFrame:
    """conv, place, role, text, edit of conversations in segments: each segment's turns meet its part of the audit."""
    key = ["conv", "part", "sub"]
    none = lambda **cols: [F.lit(None).cast(t).alias(c) for c, t in cols.items()]
    heads = _slices(whole).select(*key, F.lit(-2).alias("at"), "slice", "place", "odd", *none(kinds="string", role="string", text="string"))
    kinds = scan.where("tag = 'segment'").select(*key, F.lit(-1).alias("at"), *none(slice="string", place="long", odd="boolean"), "kinds", *none(role="string", text="string"))
    turns = scan.where("tag = 'turn'").select(*key, "at", *none(slice="string", place="long", odd="boolean", kinds="string"), "role", "text")
    schema = T._parse_datatype_string(f"conv {scan.schema['conv'].dataType.simpleString()}, place long, role string, text string, edit string")
    arrow = _arrow(schema)

    def run(batches):
        out = _Out(arrow)
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        row = next(rows, None)
        while row is not None:
            conv, _, _, _, piece, place, odd = row[:7]
            kinds = next(rows)[7]
            ahead = []

            def own():
                for r in rows:
                    if r[3] < 0:
                        ahead.append(r)
                        return
                    yield r[8], r[9]

            mine = own()
            for spot, role, text, edit in edits(piece, kinds, mine, place, odd):
                out.put(conv=conv, place=spot, role=role, text=text, edit=edit)
                if out.full():
                    yield out.batch()
            for _ in mine:  # none is left: the audit has a letter for each turn
                pass
            row = ahead[0] if ahead else None
        if out.rows:
            yield out.batch()

    dealt = heads.unionByName(kinds).unionByName(turns).repartition(*key).sortWithinPartitions(*key, "at")
    return dealt.select(*key, "at", "slice", "place", "odd", "kinds", "role", "text").mapInArrow(tidy(run), schema)


def digests(turns: DataFrame) -> DataFrame:
    """conv, sha: SHA-256 of `role:text`, joined by newlines in order; streamed."""
    schema = T._parse_datatype_string(f"conv {turns.schema['conv'].dataType.simpleString()}, sha string")
    arrow = _arrow(schema)

    def run(batches):
        out, now, sha = _Out(arrow), None, None
        for b in batches:
            for conv, place, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if sha is None or conv != now:
                    if sha is not None:
                        out.put(conv=now, sha=sha.hexdigest())
                    now, sha = conv, hashlib.sha256()
                sha.update(f"{chr(10) * (place > 0)}{role}:{text}".encode())
        if sha is not None:
            out.put(conv=now, sha=sha.hexdigest())
            yield out.batch()

    return turns.repartition("conv").sortWithinPartitions("conv", "place").select("conv", "place", "role", "text").mapInArrow(tidy(run), schema)


@F.udf(schema_of(gaps="long", blank="long", duplicate="long", truncated="long", illegal="long", cost="long", audit="string"), useArrow=True)
def _finished(state):
    return finished(unpacked(state))


@dataclass
class Repaired:
    """summary: a row for each conversation; turns: its repaired turns (None where they weren't asked for)."""

    summary: DataFrame
    turns: DataFrame | None


def repair(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies: Column | None = None, turns: bool = True, segment: int = SEGMENT, buffer: int = BUFFER) -> Repaired:
    """summary: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.  turns: conv_id, place, role, text, edit.

    copies: how often a row counts, 1 by default; a conversation whose rows all count 0 times has none left.
    """
    of = lambda c: F.col(f"`{c}`")
    rows = convs.select(of(conv_col).alias("conv"), of(turn_col).cast("long").alias("turn"), of(role_col).cast("string").alias("role"), of(text_col).cast("string").alias("text"), (F.lit(1) if copies is None else copies).cast("long").alias("copies"))
    scan = save(scanned(marked(save(counted(rows), "turns")), turns, segment, buffer), "scan")
    whole = save(multiplied(scan.where("tag = 'segment'").select("conv", "part", "sub", "state")), "whole")
    spread = applied(scan, whole)
    if turns:
        spread = save(spread, "spread")
    sha = digests(spread).withColumnRenamed("conv", "conv_")
    numbers = ("gaps", *COUNTS, "cost")
    found = whole.select("conv", _finished("state").alias("f")).join(sha, F.col("conv").eqNullSafe(F.col("conv_")), "left")
    empty = hashlib.sha256().hexdigest()
    summary = scan.where("tag = 'whole'").select("conv", *numbers, "audit", "sha").unionByName(found.select("conv", *(F.col(f"f.{c}").alias(c) for c in (*numbers, "audit")), F.coalesce("sha", F.lit(empty)).alias("sha")))
    names = lambda df: df.withColumnRenamed("conv", "conv_id")
    done = scan.where("tag = 'repaired'").select("conv", "place", "role", "text", "edit").unionByName(spread) if turns else None
    return Repaired(names(summary).withColumnRenamed("sha", "repaired_sha256"), done if done is None else names(done))


def damaged(convs: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with planted faults, by crc32 of `conv_id:turn` (nulls: one space) modulo 20, and how often each counts."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    rows = convs.select("conv_id", "turn", F.when(fate == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"))
    return rows, F.col("copies")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, copies = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    out = repair(rows, copies=copies, turns=False).summary
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _oracle() -> str:
    white = " || ".join(f"chr({ord(c)})" for c in WHITE)
    add = lambda x, c, letter: f"CASE WHEN {x} = 'z' THEN 'z' ELSE printf('%06d', CAST(left({x}, 6) AS INTEGER) + {c}) || substr({x}, 7) || '{letter}' END"
    may = "NOT must"
    return f"""
WITH RECURSIVE tab AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, d: xor(c >> 1, (c & 1) * 3988292384)) AS c FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i))),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
fated AS (SELECT conv_id, turn, role, text,
  xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), CAST(4294967295 AS BIGINT)) % 20 AS fate FROM keyed, tab),
left_over AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS again FROM fated WHERE fate <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), again) AS i, trim(text, {white}) AS bare FROM left_over),
judged AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
  left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM numbered),
turns AS (SELECT conv_id, i, role, text, initial, fault IN ('blank', 'duplicate') AS must, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS cut FROM judged),
ids AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000' AS x0, 'z' AS x1, '000002I' AS x2, '000004II' AS x3 FROM ids
  UNION ALL
  SELECT conv_id, i, y0, y1, z2, least(y3, {add("z2", 2, "I")}) FROM (
    SELECT *, least(y2, {add("least(y0, y1, y3)", 2, "I")}) AS z2 FROM (
      SELECT w.conv_id, t.i, {add("x0", 3, "D")} AS y0,
        least({add("x1", 3, "D")}, CASE WHEN {may} AND initial = 's' THEN {add("x0", "cut", "K")} ELSE 'z' END) AS y1,
        least({add("x2", 3, "D")}, CASE WHEN {may} AND initial = 'u' THEN {add("least(x0, x1, x3)", "cut", "K")} WHEN {may} THEN {add("least(x0, x1, x3)", "cut + 2", "R")} ELSE 'z' END) AS y2,
        least({add("x3", 3, "D")}, CASE WHEN {may} AND initial = 'a' THEN {add("x2", "cut", "K")} WHEN {may} THEN {add("x2", "cut + 2", "R")} ELSE 'z' END) AS y3
      FROM walk w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1))),
best AS (SELECT conv_id, CAST(left(x, 6) AS BIGINT) AS cost, substr(x, 7) AS audit FROM (SELECT conv_id, least(x0, x3) AS x FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)),
letters AS (SELECT conv_id, unnest(string_split(audit, '')) AS e, unnest(range(1, length(audit) + 1)) AS j FROM best WHERE audit <> ''),
placed AS (SELECT *, sum(CASE WHEN e = 'I' THEN 0 ELSE 1 END) OVER w AS i, sum(CASE WHEN e = 'D' THEN 0 ELSE 1 END) OVER w - 1 AS p, sum(CASE WHEN e = 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id) AS m
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY j ROWS UNBOUNDED PRECEDING)),
said AS (SELECT a.conv_id, string_agg(CASE WHEN e = 'K' THEN t.role WHEN (p - m % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE t.text END, chr(10) ORDER BY j) AS whole
  FROM placed a LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM a.conv_id AND t.i = a.i WHERE e <> 'D' GROUP BY a.conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, {", ".join(f"count(*) FILTER (WHERE fault = '{c}') AS {c}" for c in COUNTS[:3])},
  count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
SELECT ids.conv_id, {", ".join(f"coalesce({c}, 0) AS {c}" for c in ("gaps", *COUNTS))}, b.cost, b.audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM ids JOIN best b ON b.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN said s ON s.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


ORACLE_SQL = _oracle()
