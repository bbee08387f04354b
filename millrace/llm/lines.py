"""Operator 13: lines that several documents hold stay in the first of them only.

1. Explode: every text is split at \\n; a line's key is the line without white space ([\\x20\\x09-\\x0D]) at its ends and
   with A-Z lower-cased.  Keys of at least `min_chars` code points go on, as 128-bit hashes with document, row and position.
2. Count: documents are counted for each hash.  Two or more are told by the smallest and largest id, which each
   task works out for its own lines first, so a line that all documents hold costs a row a task; a higher threshold counts
   distinct ids among those lines alone.
3. Drop: lines of a counted hash outside the hash's smallest id.  Only positions travel to the document, once.
4. Reassemble: the other lines of each text, by position.

Whole texts move in one shuffle, lines as five numbers.  Everything is DataFrame functions; a line that very many
documents hold makes a skewed key of a sort-merge join, which AQE splits (its other side has one row).

Input cases: null text counts as one empty line and stays null; empty text is one empty line.  A null id counts as
smaller than all others, and rows with null ids as one document.  Rows that share an id are one document when
documents are counted, so none loses a line to another of that id; each row is reassembled by itself (rows are told apart
by a 64-bit hash of their texts, within one id).  Other columns stay as they are; columns named n_lines and n_dropped
are replaced.  An empty table gives an empty table.  Keys of lines are equal if two 64-bit hashes of them
are.  An id that isn't a whole number raises.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_key, save

WHITE = " \t\n\x0b\x0c\r"
MIN_CHARS = 10
MIN_DOCS = 2


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE))


def ascii_lower(x: Column) -> Column:
    """A-Z alone in lower case: plain `lower` where all is ASCII, else letter by letter."""
    return F.when(F.char_length(x) == F.octet_length(x), F.lower(x)).otherwise(F.translate(x, string.ascii_uppercase, string.ascii_lowercase))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keyed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """doc, row, pos, h1, h2 of every line whose key is long enough."""
    text = F.col(f"`{text_col}`")
    lines = docs.select(id_key(f"`{id_col}`").alias("doc"), F.xxhash64(text).alias("row"), F.posexplode(split_lines(text)).alias("pos", "line"))
    key = lines.select("doc", "row", "pos", stripped(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return key.select("doc", "row", "pos", *(F.xxhash64(F.lit(i), ascii_lower(F.col("key"))).alias(f"h{i}") for i in (1, 2)))


def shared_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """h1, h2, first: hashes that at least `min_docs` documents hold, with the smallest of their ids."""
    two = lines.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").drop("last")
    if min_docs <= 2:
        return two
    held = lines.join(two, ["h1", "h2"]).select("h1", "h2", "first", "doc").distinct()
    return held.groupBy("h1", "h2", "first").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).drop("n")


def dedupe_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows and columns, texts without their dropped lines, with n_lines (before) and n_dropped."""
    if min_docs < 2:
        raise ValueError("a line is dropped where at least two documents hold it")
    text = F.col(f"`{text_col}`")
    lines = save(keyed_lines(docs, id_col, text_col, min_chars), "lines")
    shared = save(shared_lines(lines, min_docs), "shared")  # read again, the join below has exchanges of its own, which AQE can split
    gone = lines.join(shared, ["h1", "h2"]).where("doc > first").groupBy("doc", "row").agg(F.collect_set("pos").alias("gone"))

    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    own = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept) if c != text_col])
    whole = docs.select(own.alias("own"), id_key(f"`{id_col}`").alias("doc"), F.xxhash64(text).alias("row"), text.isNull().alias("void"), split_lines(text).alias("lines"))
    placed = whole.join(gone, ["doc", "row"], "left")
    n, lost = F.size("lines"), F.coalesce(F.size("gone"), F.lit(0))
    rest = F.transform(F.array_except(F.sequence(F.lit(0), n - 1), F.col("gone")), lambda i: F.get(F.col("lines"), i))
    told = F.when(~F.col("void"), F.array_join(F.when(F.col("gone").isNull(), F.col("lines")).otherwise(rest), "\n"))
    cols = [told.alias(c) if c == text_col else F.col(f"own.c{i}").alias(c) for i, c in enumerate(kept)]
    return placed.select(*cols, n.cast("long").alias("n_lines"), lost.cast("long").alias("n_dropped"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedupe_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS pos FROM split),
keyed AS (SELECT doc_id, pos, line,
  translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM lines),
shared AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
judged AS (SELECT doc_id, pos, line, first IS NOT NULL AND doc_id > first AS dropped FROM keyed LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
