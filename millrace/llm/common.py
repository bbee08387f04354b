"""Shared plumbing: the folder all executors see, saved tables, and documents in key order.

Intermediate tables are written as Parquet into the folder named by ``spark.checkpoint.dir``
(own temporary folder only where that is unset, as in tests).  A lost executor therefore costs
a task retry, never a lost result: nothing is kept in executor-local storage.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from functools import lru_cache, wraps
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Key given to a null id wherever rows are ordered or joined by id; it sorts before all others.
NULL_ID = -(2**63)


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share; its name is read from the session."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not (context.master or "").startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='millrace-')}"
        context.setCheckpointDir(base)
    return base.rstrip("/")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, unique folder name in the shared folder (not yet made)."""
    made = f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"
    if (scope := _scope.get()) is not None:
        scope.folders.append(made)
    return made


class Scope:
    """Folders that were named while a result was built; whoever owns the scope removes them once the result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, []

    def __enter__(self):
        self.token = _scope.set(self)
        return self

    def __exit__(self, *error):
        _scope.reset(self.token)

    def _each(self):
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for folder in self.folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            yield path, path.getFileSystem(conf)

    def written(self) -> int:
        """When the last of the folders was finished, by its store's clock."""
        return max((fs.getFileStatus(p).getModificationTime() for p, fs in self._each() if fs.exists(p)), default=0)

    def clear(self) -> None:
        """Removes the folders; Spark frees shuffles that no frame refers to any more."""
        for path, fs in self._each():
            fs.delete(path, True)
        self.folders = []
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


_scope: ContextVar[Scope | None] = ContextVar("scope", default=None)
#: Scopes of stages that were called by themselves, by thread of control.
_open: ContextVar[tuple[Scope, ...]] = ContextVar("open", default=())


def stage(f):
    """A pipeline's stage (spark, docs, sf_dir) -> DataFrame, whose intermediate tables have an owner.

    Inside another scope (as in run()) that scope owns them.  A stage called by itself keeps them until a later stage
    is given documents that are files, none of them its own tables, and all written after it had built its result: that
    result has been written then, and is done with.  So what lies in the shared folder stays bounded by one stage where each result
    is written and read again, and stages that are composed without writing keep what they need.
    """

    @wraps(f)
    def run(spark, docs, sf_dir):
        modest_batches(spark)
        if _scope.get() is not None:
            return f(spark, docs, sf_dir)
        settle(spark, docs)
        with Scope(spark) as own:
            out = f(spark, docs, sf_dir)
        _open.set((*_open.get(), own))
        return out

    return run


def settle(spark: SparkSession, docs) -> None:
    """Clears the scopes of stages whose results have been written, as told by the files that docs reads."""
    if not _open.get() or docs is None:
        return
    files = docs.inputFiles()
    if not files:
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(files[0])
    since = path.getFileSystem(conf).getFileStatus(path).getModificationTime()
    left = []
    for scope in _open.get():
        names = {x.rsplit("/", 1)[-1] for x in scope.folders}
        if since >= scope.written() and not any(part in names for x in files for part in x.split("/")):
            scope.clear()
        else:
            left.append(scope)
    _open.set(tuple(left))


#: Rows and bytes of Arrow batches in a pipeline, and rows of a batch of Parquet, where the session has Spark's own: texts are long,
#: and a batch is held by the JVM, on its way, and by the worker.  A vector's buffer doubles as it grows; up to 4 MB it lies in
#: Arrow's pool, beyond in memory of its own that the JVM's process is slow to give back.
_BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "2m"),
    "spark.sql.parquet.columnarReaderBatchSize": ("4096", "512"),
}


def modest_batches(spark: SparkSession) -> None:
    for key, (default, own) in _BATCH.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, own)


def save(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    to = folder or shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(to)
    return spark.read.schema(df.schema).parquet(to)


class _Worker:
    """What a Python worker keeps between its tasks, and the function whose tasks it last ran."""

    caches: list[Callable[[], None]] = []
    owner: str | None = None


def kept(f):
    """lru_cache(maxsize=2) whose entries go as soon as the worker runs another function's tasks."""
    f = lru_cache(maxsize=2)(f)
    _Worker.caches.append(f.cache_clear)
    return f


def take_over(owner: str) -> None:
    """Workers are reused from stage to stage: the first task of another function empties all caches."""
    if _Worker.owner != owner:
        _Worker.owner = owner
        for clear in _Worker.caches:
            clear()
        give_back()


def give_back() -> None:
    """Freed memory goes back to the system, which a reused worker would otherwise hold on to."""
    gc.collect()
    try:
        import pyarrow as pa

        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)
    except (ImportError, OSError, AttributeError):  # no Arrow, or another C library: it keeps what it likes
        pass


def tidy(run):
    """An Arrow function whose tasks leave no more behind than the caches that its own next task wants."""
    owner = f"{run.__module__}.{run.__qualname__}"

    @wraps(run)
    def task(batches):
        take_over(owner)
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def local_path(uri: str) -> str | None:
    """The POSIX path of a file: URI or plain path (a mount that all machines share), else None."""
    u = urlparse(uri)
    return u.path if u.scheme in ("", "file") else None


def put_bytes(uri: str, chunks: Iterator[bytes]) -> int:
    """Write a file in one step: a retried or speculative task replaces it with equal bytes."""
    path, n = local_path(uri), 0
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        tmp = f"{path}.{uuid.uuid4().hex}.tmp"
        with open(tmp, "wb") as f:
            for c in chunks:
                n += len(c)
                f.write(c)
        os.replace(tmp, path)
        return n
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(tmp) as f:
        for c in chunks:
            n += len(c)
            f.write(c)
    store.move(tmp, path)
    return n


def open_input(uri: str):
    """A seekable binary reader of a file in the shared folder."""
    path = local_path(uri)
    if path is not None:
        return open(path, "rb")
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def packed(columns: list[str]) -> Column:
    """A user's columns as one struct, so that no name of theirs meets one of an operator's."""
    return F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])


def unpacked(own: str, columns: list[str]) -> list[Column]:
    return [F.col(own).getField(f"c{i}").alias(c) for i, c in enumerate(columns)]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_key(col: str = "doc_id") -> Column:
    """A never-null long to order and join by."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def id_splits(df: DataFrame, key: Column, n: int) -> list[int]:
    """At most n-1 ascending split points of a long key, near its quantiles (one pass over ids alone)."""
    ids = df.select(key.cast("double").alias("k"))
    at = [i / n for i in range(1, n)]
    found = ids.approxQuantile("k", at, 1.0 / (8 * n)) if at else []
    return sorted({int(x) for x in found})


def bucket_of(key: Column, splits: list[int]) -> Column:
    """0-based index of the range that a key falls in: how many splits are below it."""
    if not splits:
        return F.lit(0)
    # binary search by nested comparisons: depth log2(n)

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key <= F.lit(splits[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))

    return search(0, len(splits)).cast("int")


def schema_of(**cols: str) -> T.StructType:
    return T.StructType([T.StructField(k, _TYPES[v]) for k, v in cols.items()])


_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "binary": T.BinaryType(),
}


def small_batches(table, rows: int, byte_col: str, most: int = 8 << 20) -> Iterator:
    """Slices of an Arrow batch that hold at most `rows` rows and about `most` bytes of one column."""
    import pyarrow.compute as pc

    n = table.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(table.column(byte_col)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i in range(n):
        total += int(sizes[i])
        if total >= most or i + 1 - start >= rows:
            yield table.slice(start, i + 1 - start)
            start, total = i + 1, 0
    if start < n:
        yield table.slice(start)
