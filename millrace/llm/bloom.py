"""Bloom filters of 64-bit hashes, of bounded size, in the shared folder.

A filter only spares rows a shuffle: what passes is checked exactly afterwards, so its error rate
costs time, never rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import kept, local_path, open_input, partitions, put_bytes, save, schema_of, shared_folder, tidy

PROBES = 4
#: Bits a key, while the whole stays under MOST_BITS (128 MB).
BITS_A_KEY = 16
MOST_BITS = 1 << 30


def _places(hashes: np.ndarray, bits: int):
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        yield ((hashes + step * np.uint64(i)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits.bit_length() + 1)


def build(hashes: DataFrame, n: int) -> str:
    """URI of a filter over the only column (long) of a table of about n rows."""
    import pyarrow as pa

    spark = hashes.sparkSession
    bits = 1 << 16
    while bits < min(MOST_BITS, BITS_A_KEY * n):
        bits *= 2
    folder = shared_folder(spark, "bloom")

    def run(batches):
        from pyspark import TaskContext

        part, field = TaskContext.get().partitionId(), None
        for b in batches:
            if b.num_rows:
                field = np.zeros(bits // 8, dtype=np.uint8) if field is None else field
                for at in _places(b.column(0).to_numpy().view(np.uint64), bits):
                    np.bitwise_or.at(field, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        if field is not None:
            put_bytes(f"{folder}/{part:05d}", iter([field.tobytes()]))
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64())], names=["part"])

    told = save(hashes.coalesce(min(64, partitions(spark))).mapInArrow(tidy(run), schema_of(part="long")), "blooms").collect()
    whole = np.zeros(bits // 8, dtype=np.uint8)
    for r in told:  # at most 64 parts, one in memory at a time
        with open_input(f"{folder}/{r.part:05d}") as f:
            whole |= np.frombuffer(f.read(), np.uint8)
    put_bytes(f"{folder}/whole", iter([whole.tobytes()]))
    return f"{folder}/whole"


def read(uri: str) -> np.ndarray:
    """A filter's bytes, mapped where the file is on a mount, so that tasks of a machine share them."""
    path = local_path(uri)
    if path is not None:
        return np.memmap(path, np.uint8, "r")
    with open_input(uri) as f:
        return np.frombuffer(f.read(), np.uint8)


@kept
def load(uri: str) -> np.ndarray:
    return read(uri)


def contains(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    ok = np.ones(len(hashes), dtype=bool)
    for at in _places(hashes, len(field) * 8):
        ok &= (field[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)
    return ok


def split(rows: DataFrame, keys: DataFrame, on: list[str], n: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose keys are surely not in a saved table of n keys, the others): only the others need a join."""
    from pyspark.sql import functions as F

    marked = rows.withColumn("_suspect", may_hold(build(keys.select(F.xxhash64(*on)), n))(F.xxhash64(*on)))
    return marked.where("not _suspect").drop("_suspect"), marked.where("_suspect").drop("_suspect")


def may_hold(uri: str):
    """A Column function: whether the filter may hold a long."""
    from pyspark.sql import functions as F

    @F.pandas_udf("boolean")
    def check(hashes: pd.Series) -> pd.Series:
        return pd.Series(contains(load(uri), hashes.to_numpy(np.int64).view(np.uint64)))

    return check
