"""Operator 1: language identification by a byte convolutional network.

Filters of widths 2, 3 and 4 over bytes (a table of 256 x filters for each offset, so a convolution is a
few gathers), max pooling over a fixed-length window, and a softmax; trained in numpy on a bounded,
hash-chosen sample of labelled text.  A text is scored over all of its windows, weighted by length.

Bound on training: TRAIN_DOCS documents a language, TRAIN_WINDOWS windows of each, spread over the text.

Input cases: null text or text without a letter is `und` with score 0; without training rows every text
is `und`; long texts are scored window by window; repeated rows keep their rows; an empty table gives an
empty table; other columns are ignored (lang, source and doc_id are never inputs of a prediction).
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import take_over
from .sampling import by_hash

LENGTH = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
TRAIN_DOCS = 500
TRAIN_WINDOWS = 4


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter (Unicode's categories L*): digits, fractions and number signs aren't."""
    return bool(text) and any(map(str.isalpha, text))


def windows(text: bytes) -> np.ndarray:
    """All fixed-length windows of a text, the last padded with zeros."""
    n = max(1, -(-len(text) // LENGTH))
    out = np.zeros(n * LENGTH, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, LENGTH)


class ByteConvNet:
    def __init__(self, classes: list[str], seed: int = 0):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.tables = [rng.normal(0, 0.3 / w, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.dense = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(classes))).astype(np.float32)
        self.offset = np.zeros(len(classes), np.float32)

    def pooled(self, x: np.ndarray, where: bool = False):
        """Max-pooled filter outputs of windows x (n, LENGTH), and the positions they came from."""
        out, at = [], []
        for w, table in zip(WIDTHS, self.tables, strict=True):
            n = x.shape[1] - w + 1
            z = table[0][x[:, :n]]
            for k in range(1, w):
                z += table[k][x[:, k : k + n]]
            if where:
                p = z.argmax(1)
                at.append(p)
                out.append(np.take_along_axis(z, p[:, None], 1)[:, 0])
            else:
                out.append(z.max(1))
        return np.concatenate(out, 1), at

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(self.pooled(x)[0] + self.bias, 0)
        z = h @ self.dense + self.offset
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Cross-entropy of windows, weighted by class, and its gradient by each parameter: tables, bias, dense, offset."""
        raw, at = self.pooled(x, where=True)
        h = np.maximum(raw + self.bias, 0)
        z = h @ self.dense + self.offset
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        n = np.arange(len(x))
        loss = float(-(np.log(np.maximum(p[n, y], 1e-12)) * weight[y]).sum() / len(x))
        p[n, y] -= 1
        p *= weight[y][:, None] / len(x)
        gh = (p @ self.dense.T) * (h > 0)
        grads = []
        for i, w in enumerate(WIDTHS):
            g = np.zeros_like(self.tables[i])
            part = gh[:, i * FILTERS : (i + 1) * FILTERS]
            for k in range(w):  # only the window's best position sees the gradient
                np.add.at(g[k], (x[n[:, None], at[i] + k], np.arange(FILTERS)[None, :]), part)
            grads.append(g)
        return loss, [*grads, gh.sum(0), h.T @ p, p.sum(0)]

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 3e-3, seed: int = 1) -> ByteConvNet:
        """Adam on cross-entropy; classes weigh the same whatever their number of windows."""
        rng = np.random.default_rng(seed)
        params = [*self.tables, self.bias, self.dense, self.offset]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        weight = (len(y) / (len(self.classes) * np.maximum(1, np.bincount(y, minlength=len(self.classes))))).astype(np.float32)
        step = 0
        for _ in range(epochs):
            for lo in range(0, len(x), batch):
                if not lo:
                    order = rng.permutation(len(x))
                b = order[lo : lo + batch]
                _, grads = self.gradients(x[b], y[b], weight)
                step += 1
                for q, g, a, c in zip(params, grads, m, v, strict=True):
                    a += 0.1 * (g - a)
                    c += 0.001 * (g * g - c)
                    q -= rate * (a / (1 - 0.9**step)) / (np.sqrt(c / (1 - 0.999**step)) + 1e-8)
        return self

    def predict(self, texts: list[str | None], most: int = 512) -> list[tuple[str, float]]:
        """Label and probability of each text, over all of its windows."""
        total = np.zeros((len(texts), len(self.classes)))
        real = [has_letter(t) for t in texts]
        held: list[np.ndarray] = []
        owner: list[int] = []

        def flush() -> None:
            if held:
                x = np.concatenate(held)
                for lo in range(0, len(x), most):
                    part = x[lo : lo + most]
                    # a window counts by how much of it is text
                    np.add.at(total, owner[lo : lo + most], self.probabilities(part) * (part > 0).sum(1, keepdims=True))
                held.clear()
                owner.clear()

        for k, t in enumerate(texts):
            if real[k]:
                w = windows(t.lower().encode())
                held.append(w)
                owner.extend([k] * len(w))
                if len(owner) >= most:
                    flush()
        flush()
        total /= np.maximum(1e-12, total.sum(1, keepdims=True))
        best = total.argmax(1)
        return [(self.classes[c], float(min(1.0, total[k, c]))) if real[k] and total[k, c] > 0 else ("und", 0.0) for k, c in enumerate(best.tolist())]


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteConvNet | None:
    """A net from the rows that aren't held out; None where there are none."""
    rows = docs.where(~held_out(id_col)).select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where("lang is not null and text is not null")
    sample = by_hash(rows, "doc_id", "lang", TRAIN_DOCS)
    # whole windows spread over the text, cut in the JVM so that long texts stay there
    cut = F.expr(f"transform(sequence(0, {TRAIN_WINDOWS - 1}), i -> substring(text, cast(i * greatest(0, char_length(text) - {LENGTH}) / {TRAIN_WINDOWS - 1} as int) + 1, {LENGTH}))")
    got = sample.select("doc_id", "lang", F.explode(F.array_distinct(cut)).alias("w")).collect()
    got = sorted(((r.lang, r.w) for r in got if has_letter(r.w)), key=lambda r: (r[0], r[1]))
    classes = sorted({lang for lang, _ in got})
    if not classes:
        return None
    x = np.stack([windows(w.lower().encode()[:LENGTH])[0] for _, w in got])
    y = np.array([classes.index(lang) for lang, _ in got])
    return ByteConvNet(classes).fit(x, y)


def with_language(docs: DataFrame, net: ByteConvNet | None, text_col: str = "text") -> DataFrame:
    """All columns, with lang_pred and score (replacing columns of those names)."""
    net = net or ByteConvNet(["und"])

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        take_over("language")
        out = []
        for lo in range(0, len(texts), 256):
            out += net.predict(texts.iloc[lo : lo + 256].tolist())
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    return docs.withColumn("_found", predict(F.col(text_col))).withColumns({"lang_pred": F.col("_found.lang_pred"), "score": F.col("_found.score")}).drop("_found")


def keep_identified(docs: DataFrame, net: ByteConvNet | None, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """Documents with a language: `und` and scores under `least` (close to an even guess) go."""
    names = docs.columns
    return with_language(docs.withColumns({f"_keep{i}": F.col(f"`{c}`") for i, c in enumerate(names)}), net, text_col).where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(names)])


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = with_language(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
