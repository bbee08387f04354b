"""Operator 7: token ids in binary files, coded by a static range asymmetric numeral system.

Steps, each a Spark job whose tasks write whole files into the shared folder under names fixed by the
partition, so a retried task replaces its file with an equal one:

1. documents are ranged by key and sorted, tokenised in order, and kept as raw id files, with counts;
2. the counts of all ids make one frequency table (at most one row for each vocabulary entry);
3. every raw file becomes a coded file: blocks, index of documents, directory of blocks, footer;
4. the coded files are read back, a task a file.

Input cases: null and empty text is the end id alone; a null doc_id sorts first and comes back as null;
rows that repeat a doc_id are ordered by text; an empty table gives no files and no rows; other columns
are ignored; an id that isn't a whole number raises.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import NULL_ID, id_key, kept, local_path, open_input, partitions, put_bytes, save, schema_of, shared_folder, small_batches, tidy
from .rans import BLOCK, Table, decode, encode

END_ID = 2
#: Bytes of texts encoded together: each distinct word of them is looked up once.
SLICE_BYTES = 8 << 20
_FOOT = struct.Struct("<QQQQQ4s")


# ---------------------------------------------------------------- one file


def file_chunks(doc_ids: np.ndarray, sizes: np.ndarray, blocks, table: Table):
    """A file's bytes from an iterable of id blocks."""
    yield b"RANSIDS1"
    at, first, directory = 8, 0, []
    for ids in blocks:
        data = encode(ids, table)
        directory.append((at, len(data), first, len(ids)))
        at += len(data)
        first += len(ids)
        yield data
    index = zlib.compress(np.concatenate([np.asarray(doc_ids), np.asarray(sizes)]).astype("<i8").tobytes(), 1)
    marks = np.array(directory, dtype="<u8").tobytes()
    yield index
    yield marks
    yield _FOOT.pack(at, len(index), len(directory), first, zlib.crc32(index + marks), b"END1")


class TokenFile:
    """Reader of one coded file: any block, or any range of ids, without the blocks before it."""

    def __init__(self, uri: str, table: Table):
        self.f, self.table = open_input(uri), table
        self.f.seek(0, os.SEEK_END)
        end = self.f.tell()
        at, n_index, n_blocks, self.n_tokens, crc, magic = _FOOT.unpack(self._at(end - _FOOT.size, _FOOT.size))
        if magic != b"END1":
            raise ValueError("not a token file")
        tail = self._at(at, n_index + 32 * n_blocks)
        if zlib.crc32(tail) != crc:
            raise ValueError("damaged index")
        flat = np.frombuffer(zlib.decompress(tail[:n_index]), "<i8")
        self.doc_ids, self.sizes = flat[: len(flat) // 2], flat[len(flat) // 2 :]
        self.blocks = np.frombuffer(tail[n_index:], "<u8").reshape(-1, 4).astype(np.int64)

    def _at(self, offset: int, size: int) -> bytes:
        self.f.seek(offset)
        return self.f.read(size)

    def block(self, k: int) -> np.ndarray:
        at, size, _, _ = self.blocks[k].tolist()
        return decode(self._at(at, size), self.table)

    def ids(self, start: int, n: int) -> np.ndarray:
        """n ids from a position in the file."""
        first = self.blocks[:, 2]
        lo = int(np.searchsorted(first, start, "right")) - 1
        out = []
        for k in range(max(lo, 0), len(self.blocks)):
            if first[k] >= start + n:
                break
            got = self.block(k)
            out.append(got[max(0, start - int(first[k])) : start + n - int(first[k])])
        return np.concatenate(out) if out else np.empty(0, np.uint32)

    def documents(self):
        """(doc_id, start in file, ids) in order, a block in memory at a time plus the document at hand."""
        k, have, pos = 0, np.empty(0, np.uint32), 0
        for doc, n in zip(self.doc_ids.tolist(), self.sizes.tolist(), strict=True):
            parts = []
            need = n
            while need:
                if not len(have):
                    have = self.block(k)
                    k += 1
                parts.append(have[:need])
                have = have[len(parts[-1]) :]
                need -= len(parts[-1])
            yield doc, pos, parts[0] if len(parts) == 1 else np.concatenate(parts)
            pos += n


# ---------------------------------------------------------------- Spark jobs


@kept
def _table(uri: str) -> Table:
    with open_input(uri) as f:
        return Table.load(f.read())


def _raw_chunks(f):
    """Documents of a raw file: (ids of documents, sizes, ids) a chunk."""
    while head := f.read(12):
        n_docs, size, width = struct.unpack("<III", head)
        meta = np.frombuffer(f.read(16 * n_docs), "<i8")
        yield meta[:n_docs], meta[n_docs:], np.frombuffer(_zstd(f.read(size)), "<u2" if width == 2 else "<u4")


def _zstd(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def write_tokens(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None, end_id: int = END_ID, order: list[str] | None = None, memo_bytes: int | None = None) -> tuple[str, list[tuple[int, int, int]]]:
    """Write all documents as coded files; (folder, [(part, documents, ids)] in order).

    memo_bytes: what a worker may keep of encoded pieces (None: the default); less costs time, never ids.
    order: columns to sort by (default: the document's id, then its text).  tokenizer_path None: the
    installed byte-level BPE.  The driver sees one row a part and one a vocabulary entry, never documents.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    by = [F.col(c) for c in order] if order else [id_key(id_col), F.col(text_col)]
    src = docs.select(id_key(id_col).alias("key"), F.col(text_col).alias("text"), *[c.alias(f"o{i}") for i, c in enumerate(by) if order])
    keys = [f"o{i}" for i in range(len(by))] if order else ["key", "text"]
    ranged = src.repartitionByRange(partitions(spark), *(keys if order else ["key"])).sortWithinPartitions(*keys).select("key", "text")

    def tokenise(batches):
        import zstandard
        from pyspark import TaskContext

        from .tokens import encoder

        part, enc, packer = TaskContext.get().partitionId(), None, zstandard.ZstdCompressor(level=1)
        counts, n_docs, n_ids = None, 0, 0

        def chunks():
            nonlocal enc, counts, n_docs, n_ids
            for b in batches:
                for s in small_batches(pa.Table.from_batches([b]), 4000, "text", SLICE_BYTES if memo_bytes is None else max(1 << 20, memo_bytes // 12)):
                    if enc is None:
                        enc = encoder(tokenizer_path) if memo_bytes is None else encoder(tokenizer_path, memo_bytes)
                        counts = np.zeros(max(enc.size, end_id + 1), dtype=np.int64)
                    flat, sizes = enc.flat(s.column("text").to_pylist(), end_id)
                    sizes = sizes.astype("<i8")
                    counts += np.bincount(flat, minlength=len(counts))
                    n_docs, n_ids = n_docs + len(sizes), n_ids + int(sizes.sum())
                    data = packer.compress(flat.tobytes())
                    yield struct.pack("<III", len(sizes), len(data), enc.width) + s.column("key").to_numpy().astype("<i8").tobytes() + sizes.tobytes() + data

        first = next(made := chunks(), None)
        if first is None:
            return

        def again():
            yield first
            yield from made

        put_bytes(f"{folder}/raw-{part:05d}", again())
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, seen], pa.int64()), pa.array(np.r_[part, counts[seen]], pa.int64()), pa.array(np.r_[n_docs, np.zeros(len(seen), np.int64)], pa.int64()), pa.array(np.r_[n_ids, np.zeros(len(seen), np.int64)], pa.int64())], names=["token", "n", "docs", "ids"])

    told = save(ranged.mapInArrow(tidy(tokenise), schema_of(token="long", n="long", docs="long", ids="long")), "counts")
    parts = sorted((r.n, r.docs, r.ids) for r in told.where("token = -1").collect())
    found = told.where("token >= 0").groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 + max((r.token for r in found), default=0), dtype=np.int64)
    for r in found:
        counts[r.token] = r.n
    put_bytes(f"{folder}/table", iter([Table.of_counts(counts).dump()]))
    if not parts:
        return folder, []

    def code(batches):
        table = _table(f"{folder}/table")
        for b in batches:
            for i in b.column(0).to_pylist():
                part = parts[i][0]
                with open_input(f"{folder}/raw-{part:05d}") as f:
                    ids, sizes = [], []

                    def blocks(f=f, ids=ids, sizes=sizes):
                        have: list[np.ndarray] = []
                        n = 0
                        for d, s, x in _raw_chunks(f):
                            ids.append(d)
                            sizes.append(s)
                            have.append(x)
                            n += len(x)
                            if n >= BLOCK:
                                flat = np.concatenate(have)
                                cut = n - n % BLOCK
                                yield from (flat[a : a + BLOCK] for a in range(0, cut, BLOCK))
                                have, n = [flat[cut:]], n - cut
                        if n:
                            yield np.concatenate(have)

                    def file(b=blocks, ids=ids, sizes=sizes):
                        yield from file_chunks(_Late(ids), _Late(sizes), b(), table)

                    size = put_bytes(f"{folder}/ids-{part:05d}", file())
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([size], pa.int64())], names=["part", "bytes"])

    save(spark.range(0, len(parts), 1, len(parts)).mapInArrow(tidy(code), schema_of(part="long", bytes="long")), "coded")
    if (path := local_path(folder)) is not None:  # raw files are done with; elsewhere the folder's owner removes them
        for part, _, _ in parts:
            os.path.exists(f"{path}/raw-{part:05d}") and os.remove(f"{path}/raw-{part:05d}")
    return folder, parts


class _Late:
    """Arrays that are complete only once all blocks have been drawn."""

    def __init__(self, parts: list):
        self.parts = parts

    def __array__(self, dtype=None, copy=None):
        return np.concatenate(self.parts) if self.parts else np.empty(0, np.int64)


def read_tokens(spark: SparkSession, folder: str, parts: list[tuple[int, int, int]], with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document, from the coded files alone."""
    import pyarrow as pa

    schema = schema_of(doc_id="long", start="long", n_tokens="long", ids_crc32="long")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    if not parts:
        return spark.createDataFrame([], schema)
    base = np.r_[0, np.cumsum([n for _, _, n in parts])].tolist()

    def run(batches):
        table = _table(f"{folder}/table")
        for b in batches:
            for i in b.column(0).to_pylist():
                rows: list[tuple] = []
                held = 0
                for doc, at, ids in TokenFile(f"{folder}/ids-{parts[i][0]:05d}", table).documents():
                    rows.append((None if doc == NULL_ID else doc, base[i] + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), *([ids.astype(np.int32)] if with_ids else [])))
                    held += len(ids) if with_ids else 1
                    if held >= 1 << 16:
                        yield _batch(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, schema)

    def _batch(rows, schema):
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.list_(pa.int32())) for c in cols[4:])], names=schema.names)

    return spark.range(0, len(parts), 1, len(parts)).mapInArrow(tidy(run), schema)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, parts = write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return read_tokens(spark, folder, parts)
