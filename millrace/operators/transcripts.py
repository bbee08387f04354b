"""Transcript segments: sentence groups, speaker turns and merged sentences, one fold a transcript."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed limits, in seconds and words.
GAP_S, SPAN_S, MERGE_S, MERGE_WORDS, SHORT_WORDS = 20.0, 30.0, 45.0, 80, 3
_END = re.compile(r"[.!?][\"')\]]*\s*$")


def group_sentences(segments: list[tuple[float, str]]) -> list[tuple[float, str]]:
    """A group ends with a sentence, before a gap over GAP_S, or once it would span over SPAN_S."""
    out: list[tuple[float, list[str]]] = []
    last = None
    closed = True
    for start, text in segments:
        text = text.strip()
        if not text:
            continue
        if closed or (last is not None and start - last > GAP_S) or start - out[-1][0] > SPAN_S:
            out.append((start, []))
        out[-1][1].append(text)
        last, closed = start, bool(_END.search(text))
    return [(t, " ".join(parts)) for t, parts in out]


def merge_sentences(groups: list[tuple[float, str]]) -> list[tuple[float, str]]:
    """Neighbours join to at most MERGE_WORDS words and MERGE_S seconds; very short ones and questions stay alone."""
    out: list[tuple[float, str]] = []
    for start, text in groups:
        alone = text.endswith("?") or len(text.split()) <= SHORT_WORDS
        if out and not alone and not out[-1][1].endswith("?") and len((out[-1][1] + " " + text).split()) <= MERGE_WORDS and start - out[-1][0] <= MERGE_S:
            out[-1] = (out[-1][0], out[-1][1] + " " + text)
        else:
            out.append((start, text))
    return out


def grouped(df: DataFrame, by: str, start: str, text: str, merge: bool = False) -> DataFrame:
    """(by, start, text) groups of every transcript; a transcript is one task's group, bounded by its length."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(start, kind="stable")
        got = group_sentences(list(zip(pdf[start].astype(float), pdf[text].fillna(""), strict=True)))
        got = merge_sentences(got) if merge else got
        return pd.DataFrame({by: [pdf[by].iloc[0]] * len(got), "start": [g[0] for g in got], "text": [g[1] for g in got]})

    kind = df.schema[by].dataType.simpleString()
    return df.select(by, start, text).groupBy(by).applyInPandas(fold, f"{by} {kind}, start double, text string")


def speaker(by: str, order: str, text: Column) -> Column:
    """0 or 1: changes where a segment opens with >> and the one before ended a sentence."""
    w = Window.partitionBy(by).orderBy(order)
    change = F.when(F.startswith(F.trim(text), F.lit(">>")) & F.coalesce(F.lag(F.rtrim(text).rlike(r"[.!?][\"')\]]*$")).over(w), F.lit(True)), 1).otherwise(0)
    return change


def with_speakers(df: DataFrame, by: str, order: str, text: str) -> DataFrame:
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    marked = df.withColumn("_change", speaker(by, order, F.col(text)))
    return marked.withColumn("speaker", F.pmod(F.greatest(F.sum("_change").over(w) - 1, F.lit(0)), F.lit(2)).cast("long")).drop("_change")
