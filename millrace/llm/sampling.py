"""Bounded samples of rows for fitting, chosen by hash: repeatable, spread over the table, no sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_hash(rows: DataFrame, id_col: str, group: str, most: int) -> DataFrame:
    """About `most` rows of each value of `group` (all of them where there are fewer), by a hash of the id.

    One pass over ids and groups gives the rates; the groups are assumed few (labels, languages).
    """
    counts = {r[group]: r["count"] for r in rows.groupBy(group).count().collect()}
    rate = F.lit(0.0)
    for k, n in counts.items():
        rate = F.when(F.col(group) == F.lit(k), F.lit(min(1.0, most / n))).otherwise(rate)
    return rows.where(F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), F.lit(1_000_000)) < rate * 1_000_000)
