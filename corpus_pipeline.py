"""A corpus pipeline: five stages over `documents`, each calling one operator of millrace.llm.

language ID -> SimHash near-dedup -> benchmark decontamination -> source mixing -> token files.
Every stage reads what its predecessor wrote as Parquet; the tables that a stage makes on the way are removed once its
result is written.  All but the last return the columns of documents; the mix takes effect as the stored order of rows, which the last
stage encodes in.  Other columns, whatever their names, pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, language, mixing, near_copies, tokenfile
from millrace.llm.common import Scope, packed, partitions, save, stage, unpacked
from millrace.session import ensure_importable

#: None: language ID, near-dedup and token files can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None

#: Bytes of encoded pieces that a worker keeps, and of texts that it walks together: executors here have been through other stages.
MEMO_BYTES, WALK_BYTES = 12 << 20, 1 << 20


@stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those scored close to an even guess; the rest stay unchanged."""
    ensure_importable(spark)
    return language.keep_identified(docs, language.train(docs))


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of texts linked by five-word Jaccard similarity of 0.8 or more.

    Candidates are texts near one another by SimHash, and those that share a shingle of their prefixes; all are checked exactly.

    Rows are known by (doc_id, text), so a repeated or null id costs no other text of that id; the smallest
    id of a group stays, null last, and of rows equal in both any one.
    """
    ensure_importable(spark)
    name = [F.col("doc_id").alias("_id"), near_copies.text_hash().alias("_node")]
    named = docs.select(*name, packed(docs.columns).alias("_own"))
    rows = save(named.groupBy("_id", "_node").count(), "rows")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_node").alias("node"))).alias("f")
    key = ["_id", "_node"]
    other = lambda groups: rows.join(groups, "_group").where("not (_id <=> f.id and _node = f.node)").select("_id", "_node")
    rows = rows.withColumn("_group", F.col("_node"))
    copies = save(other(rows.groupBy("_group").agg(first, F.count("*").alias("k")).where("k > 1")), "copies")
    texts = near_copies.without(docs.select(*name, "text"), copies, key).select(F.col("_node").alias("node"), F.col("text").cast("binary").alias("text"))
    roots = save(near_copies.near_copies(texts).distinct(), "roots")
    rows = rows.drop("_group").join(roots, F.col("_node") == F.col("node"), "left").select("_id", "_node", "count", F.coalesce("root", "_node").alias("_group"))
    losers = save(other(rows.groupBy("_group").agg(first)), "losers")
    again = save(rows.where(F.col("count") > 1).select(*key), "again")
    if again.isEmpty():
        kept = near_copies.without(named, losers, key)
    else:
        once = named.join(again, [named[c].eqNullSafe(again[c]) for c in key], "left_semi").dropDuplicates(key)
        kept = near_copies.without(near_copies.without(named, again, key).unionByName(once), losers, key)
    return kept.select(*unpacked("_own", docs.columns))


@stage
def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents over the coverage limit and cuts hit spans from the others."""
    ensure_importable(spark)
    return decontaminate.remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), slice_bytes=WALK_BYTES)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, stored in the order of the mix: part files in slot order, rows in slot order within."""
    ensure_importable(spark)
    order = save(mixing.mix_sources(docs.select("doc_id", "source")).select("doc_id", "position").groupBy("doc_id").agg(F.min("position").alias("position")), "order")
    # one plan at every size: documents are dealt by id once, then by position
    own = docs.select(F.col("doc_id").alias("_id"), packed(docs.columns).alias("_own"))
    order = order.select(F.col("doc_id").alias("_key"), F.col("position").alias("_position"))
    placed = own.join(order.hint("merge"), F.col("_id").eqNullSafe(F.col("_key")))
    return placed.repartitionByRange(partitions(spark), "_position").sortWithinPartitions("_position").select(*unpacked("_own", docs.columns))


@stage
def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents as coded files, in stored order where docs is read from files, else by id."""
    ensure_importable(spark)
    if docs.inputFiles():
        stored = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
        folder, parts = tokenfile.write_tokens(stored, order=["file", "row"], memo_bytes=MEMO_BYTES)
    else:
        folder, parts = tokenfile.write_tokens(docs, memo_bytes=MEMO_BYTES)
    return tokenfile.read_tokens(spark, folder, parts)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("source_mixing", mix_sources),
    ("token_files", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every result but the last is written to the shared folder and read again.

    Owns what its stages make, so pipelines that run side by side don't touch each other's tables.  The last stage's files
    are its result and stay.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, step in STAGES[:-1]:
        with Scope(spark) as scratch:
            made = step(spark, docs, sf_dir)
        with Scope(spark) as kept:
            docs = save(made, f"stage-{name}")
        scratch.clear()
        if before is not None:  # its documents have been read for the last time
            before.clear()
        before = kept
    with Scope(spark):
        return STAGES[-1][1](spark, docs, sf_dir)
