"""Operator 3 (native): Pfair mixing of sources to target weights, with DataFrame and SQL functions only.

Weights are integers a_s of a cycle of Q slots.  Block i of source s is released at floor((i-1) Q / a_s)
and due at ceil(i Q / a_s); in every slot, the released block with the earliest deadline goes (ties: first
source).  All of a source's blocks are due by the end of the cycle, so the schedule repeats, and only one
cycle is worked out, once, by an array fold over Q slots; block i then has slot
Q * ((i-1) div a_s) + offset((i-1) mod a_s).  In every prefix of the slots each source that still has
blocks is less than one block away from its weight.  When a source has run out its slots stay empty, so
the others share them in the same proportions.  Every row is kept exactly once.

A source's rows are numbered in the order of md5(seed:id), without sorting a source in one task: counts by
(source, digest prefix) give offsets, and rows are numbered inside such cells.  The prefix grows with the
largest source, and a cell that is too large all the same (one id, or null, in very many rows) is cut by a
hash of the whole row.  The dense position is found in the same way over ranges of slots of a fixed width.

Input cases: a null source is a source of its own; a null id is ordered as an empty text; rows that repeat
an id are ordered by a hash of the row between themselves, and all kept; an empty table gives an empty table; columns
that clash with the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import packed, save, unpacked

#: Slots in a cycle: the resolution of weights.  Raised where there are many sources.
CYCLE = 1000
#: Rows in one numbering cell, on average, and at which a cell is cut further.
CELL = 50_000
HOT_CELL = 1_000_000
#: Rows at most in one range of slots that positions are counted in.
RANGE = 5_000
#: Ranges of slots counted together when their counts are summed up.
TOP = 4096


def source_weights(counts: DataFrame, weights: dict[str, float] | None, cycle: int) -> DataFrame:
    """(src, n, a): sizes and integer weights that sum to the cycle, by largest remainder, each at least 1.

    weights None: in proportion to the square root of a source's rows, between equal shares and its own.
    Sources that a given dict leaves out get its smallest weight.  One row a source.
    """
    if weights is None:
        raw = F.sqrt(F.col("n").cast("double"))
    else:
        least = min(weights.values(), default=1.0)
        raw = F.lit(float(least))
        for k, v in weights.items():
            raw = F.when(F.col("src") == F.lit(f"s:{k}"), F.lit(float(v))).otherwise(raw)
    every = Window.partitionBy(F.lit(0))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("rest"), "src")
    w = counts.withColumn("raw", raw).withColumn("sources", F.count("*").over(every))
    # one slot each, the other slots by weight
    w = w.withColumn("share", F.round(F.col("raw") * (F.lit(cycle) - F.col("sources")) / F.sum("raw").over(every), 9))
    w = w.withColumn("whole", F.floor("share")).withColumn("rest", F.col("share") - F.col("whole"))
    left = F.lit(cycle) - F.col("sources") - F.sum("whole").over(every)
    return w.select("src", "n", (1 + F.col("whole") + F.when(F.row_number().over(order) <= left, 1).otherwise(0)).cast("long").alias("a"))


def cycle_offsets(weights: DataFrame, cycle: int) -> DataFrame:
    """(src, j, slot): slot of a source's j-th block (from 0) in one cycle, earliest deadline first.

    One row with one array entry a source is folded over the cycle's slots; size is bounded by the
    number of sources and the cycle, not by rows.
    """
    one = weights.groupBy().agg(F.sort_array(F.collect_list(F.struct("src", "a"))).alias("srcs"))
    # each step chooses x, binds it by a one-element transform, then counts it
    fold = f"""
      aggregate(
        sequence(0, {cycle} - 1),
        named_struct('k', transform(srcs, s -> 0L), 'out', cast(array() as array<int>)),
        (st, t) -> element_at(transform(
          array(array_min(filter(
            transform(srcs, (s, i) -> named_struct(
              'due', ((st.k[i] + 1) * {cycle} + s.a - 1) div s.a,
              'i', if(st.k[i] < s.a and st.k[i] * {cycle} div s.a <= t, i, -1))),
            c -> c.i >= 0)).i),
          x -> named_struct(
            'k', transform(st.k, (n, i) -> if(i = x, n + 1L, n)),
            'out', concat(st.out, array(x)))), 1),
        st -> st.out)"""
    slots = one.select("srcs", F.posexplode(F.expr(fold)).alias("slot", "i"))
    by = Window.partitionBy("src").orderBy("slot")
    return slots.select(F.col("slot").cast("long"), F.expr("srcs[i].src").alias("src")).withColumn("j", F.row_number().over(by).cast("long") - 1)


def _cell(digest: Column, digits: int) -> Column:
    return F.substring(digest, 1, digits)


def _fine(digest: Column, tail: Column, digits: int = 4) -> Column:
    """Cells of a cell that is too large: the whole digest and some digits of the row's hash."""
    return F.concat(digest, F.substring(tail, 1, digits))


def mix_sources(
    docs: DataFrame, weights: dict[str, float] | None = None, source_col: str = "source", id_col: str = "doc_id", block: int = 1, seed: int = 0, cycle: int = CYCLE, hot_cell: int = HOT_CELL,
) -> DataFrame:
    """All rows with source_block, release, deadline, slot (orders the mix; one a block) and position (dense, from 0)."""
    added = ("source_block", "release", "deadline", "slot", "position")
    kept = [c for c in docs.columns if c not in added]
    src = F.coalesce(F.concat(F.lit("s:"), F.col(source_col).cast("string")), F.lit("null"))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    tail = F.lower(F.lpad(F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in kept])), 16, "0"))
    keyed = docs.select(packed(kept or [id_col]).alias("_own"), src.alias("_src"), digest.alias("_digest"), tail.alias("_tail"))

    coarse = save(keyed.groupBy(F.col("_src").alias("src"), _cell(F.col("_digest"), 3).alias("p3")).count(), "cells")
    sizes = coarse.groupBy("src").agg(F.sum("count").alias("n"))
    told = sizes.agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.count("*").alias("s")).first()
    if not told["n"]:
        return docs.select(*kept, *(F.lit(None).cast("long").alias(c) for c in added))
    cycle = max(cycle, 4 * told["s"])
    digits = 3
    while told["most"] > 16**digits * CELL:
        digits += 1
    cells = coarse if digits == 3 else save(keyed.groupBy(F.col("_src").alias("src"), _cell(F.col("_digest"), digits).alias("p3")).count(), "cells")
    keyed = keyed.withColumn("_cell", _cell(F.col("_digest"), digits))
    hot = save(cells.where(F.col("count") > hot_cell).select(F.col("src").alias("_src"), F.col("p3").alias("_cell")), "hot")
    if not hot.isEmpty():
        keyed = keyed.join(hot.withColumn("_hot", F.lit(True)), ["_src", "_cell"], "left").withColumn("_cell", F.when(F.col("_hot"), _fine(F.col("_digest"), F.col("_tail"))).otherwise(F.col("_cell"))).drop("_hot")
        cells = keyed.groupBy(F.col("_src").alias("src"), F.col("_cell").alias("p3")).count()
    before = Window.partitionBy("src").orderBy("p3").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(F.col("src").alias("_src"), F.col("p3").alias("_cell"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))

    table = save(source_weights(sizes, weights, cycle), "weights")
    offsets = save(cycle_offsets(table, cycle).join(table.select("src", "a"), "src").select(F.col("src").alias("_src"), F.col("j").alias("_j"), F.col("slot").alias("_at"), F.col("a").alias("_a")), "offsets")
    per = table.select(F.col("src").alias("_src"), F.col("a").alias("_w"))

    inside = Window.partitionBy("_src", "_cell").orderBy("_digest", "_tail")
    numbered = keyed.withColumn("_row", F.row_number().over(inside))
    numbered = numbered.join(cells, ["_src", "_cell"]).withColumn("_i", F.expr(f"(_row + _before - 1) div {block}"))
    # at most `cycle` and one row a source: sizes bounded by parameters
    slotted = numbered.join(F.broadcast(per), "_src").withColumn("_j", F.col("_i") % F.col("_w")).join(F.broadcast(offsets.drop("_a")), ["_src", "_j"])
    c = F.lit(cycle)
    out = slotted.select(
        "_own",
        (F.col("_i") + 1).alias("source_block"),
        F.expr(f"_i * {cycle} div _w").alias("release"),
        F.expr(f"((_i + 1) * {cycle} + _w - 1) div _w").alias("deadline"),
        (F.expr("_i div _w") * c + F.col("_at")).alias("slot"),
        "_digest",
        "_tail",
    )
    return _positions(out, block).select(*unpacked("_own", kept), *added)


def _positions(rows: DataFrame, block: int) -> DataFrame:
    """Dense position by slot: counts in ranges of slots that hold RANGE rows at most, then row numbers inside each.

    Counts are summed up in two levels, so one window sees a row for TOP ranges only.  The join and the numbering
    share one partitioning, by range.
    """
    binned = rows.withColumn("_bin", F.expr(f"slot div {max(1, RANGE // block)}"))
    counts = save(binned.groupBy("_bin").count(), "bins").withColumn("_top", F.expr(f"_bin div {TOP}"))
    before = lambda part, by: Window.partitionBy(part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    upto = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    tops = counts.groupBy("_top").agg(F.sum("count").alias("_n")).select("_top", upto("_n", before(F.lit(0), "_top")).alias("_from"))
    base = counts.join(tops, "_top").select("_bin", (F.col("_from") + upto("count", before("_top", "_bin"))).alias("_base"))
    inside = Window.partitionBy("_bin").orderBy("slot", "_digest", "_tail")
    return binned.join(base, "_bin").withColumn("position", F.row_number().over(inside) + F.col("_base") - 1)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    return mix_sources(docs)


ORACLE_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce('s:' || source, 'null') AS src, md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
sizes AS (SELECT src, count(*) AS n, sqrt(CAST(count(*) AS DOUBLE)) AS raw FROM d GROUP BY src),
shares AS (SELECT src, n, round(raw * ({CYCLE} - count(*) OVER ()) / sum(raw) OVER (), 9) AS share, count(*) OVER () AS sources FROM sizes),
parts AS (SELECT src, n, sources, CAST(floor(share) AS BIGINT) AS whole, share - floor(share) AS rest FROM shares),
w AS (SELECT src, n, row_number() OVER (ORDER BY src) AS i,
        CAST(1 + whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, src) <= {CYCLE} - sources - sum(whole) OVER () THEN 1 ELSE 0 END AS BIGINT) AS a FROM parts),
arr AS (SELECT list(a ORDER BY i) AS aa, count(*) AS s FROM w),
edf AS (
  SELECT -1 AS t, list_transform(aa, lambda x: CAST(0 AS BIGINT)) AS k, CAST(0 AS BIGINT) AS pick FROM arr
  UNION ALL
  SELECT t + 1, list_transform(range(1, s + 1), lambda i: k[i] + CASE WHEN i = p THEN 1 ELSE 0 END), p
  FROM (SELECT t, k, aa, s,
          list_min(list_transform(list_filter(range(1, s + 1), lambda i: k[i] < aa[i] AND k[i] * {CYCLE} // aa[i] <= t + 1),
            lambda i: ((k[i] + 1) * {CYCLE} + aa[i] - 1) // aa[i] * 1000000 + i)) % 1000000 AS p
        FROM edf, arr WHERE t < {CYCLE} - 1)),
offs AS (SELECT pick AS i, CAST(t AS BIGINT) AS spot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS j FROM edf WHERE t >= 0),
num AS (SELECT d.doc_id, d.source, d.digest, w.i, w.a, row_number() OVER (PARTITION BY d.src ORDER BY d.digest, d.doc_id) - 1 AS b FROM d JOIN w USING (src)),
slots AS (SELECT doc_id, source, digest, b + 1 AS source_block, b * {CYCLE} // a AS release, ((b + 1) * {CYCLE} + a - 1) // a AS deadline, b // a * {CYCLE} + spot AS slot
  FROM num JOIN offs ON offs.i = num.i AND offs.j = num.b % num.a)
SELECT doc_id, source, CAST(source_block AS BIGINT) AS source_block, CAST(release AS BIGINT) AS release, CAST(deadline AS BIGINT) AS deadline, CAST(slot AS BIGINT) AS slot,
  CAST(row_number() OVER (ORDER BY slot, digest, doc_id) - 1 AS BIGINT) AS position FROM slots
"""
