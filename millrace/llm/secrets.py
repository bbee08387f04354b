"""Operator 6: secret scan by token efficiency, over fixed base patterns.

Base kinds (assign, access, hex) are matched by their patterns, then filtered by length.  The method
adds spans of kind `random`: runs of key-like characters whose characters-per-token ratio under a
tiktoken vocabulary is low, after known digests (hex of the usual lengths), UUIDs, plain numbers,
dates, addresses and one-case words are excluded.  One pass, no shuffle.

Input cases: null and empty text have no spans; offsets are code points, end exclusive; repeated rows
keep their rows; an empty table gives an empty table; other columns are ignored; an id that isn't a
whole number raises.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import schema_of, small_batches, tidy

#: Fixed patterns of the base kinds, in the order in which ties are listed.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Hex lengths of common digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGESTS = (32, 40, 56, 64, 96, 128)
CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{20,}")
KNOWN = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}|[0-9_=+/-]+|[A-Z]?[a-z]+(?:[-_/][A-Z]?[a-z]+)*|[A-Z]+(?:[-_/][A-Z]+)*|[-=_+/]+")
#: At most this many characters a token marks a random string.
MAX_RATIO = 2.0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    # a run of hex digits is maximal, so asking for 16 at once finds the same runs
    out += [(*m.span(), "hex") for m in LONG_HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def random_spans(text: str, base: list[tuple[int, int, str]], encode, max_ratio: float = MAX_RATIO) -> list[tuple[int, int, str]]:
    out = []
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        x = m[0]
        if KNOWN.fullmatch(x) or (len(x) in DIGESTS and re.fullmatch("[0-9a-fA-F]+", x)):
            continue
        if not re.search("[0-9]", x) and not (re.search("[a-z][A-Z]", x) and re.search("[A-Z]{2}", x)):
            continue
        if any(s < b and a < e for s, e, _ in base):
            continue
        if len(x) / len(encode(x)) <= max_ratio:
            out.append((a, b, "random"))
    return out


def vocabulary(path: str | None = None):
    """encode_ordinary of a tiktoken vocabulary file; by default the installed byte-level BPE."""
    import base64

    import tiktoken
    from public_tokenizers import PATTERN
    from public_tokenizers import path as installed

    with open(path or installed("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab_path: str | None = None, max_ratio: float = MAX_RATIO) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base (joined base spans), spans (joined, with random ones)."""
    import pyarrow as pa

    def run(batches):
        encode = None
        for b in batches:
            for s in small_batches(pa.Table.from_batches([b]), 4000, "text"):
                rows = []
                for t in s.column("text").to_pylist():
                    base = base_spans(t or "")
                    more = []
                    if t and CANDIDATE.search(t):
                        encode = encode or vocabulary(vocab_path)
                        more = random_spans(t, base, encode, max_ratio)
                    kinds = [k for _, _, k in base]
                    every = sorted([*base, *more], key=lambda s: (s[0], KINDS.index(s[2]), s[1])) if more else base
                    rows.append((*(kinds.count(k) for k in KINDS[:3]), joined(base), joined(every)))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([s.column("doc_id").combine_chunks(), *(pa.array(c, pa.int64()) for c in cols[:3]), *(pa.array(c, pa.string()) for c in cols[3:])], names=["doc_id", "n_assign", "n_access", "n_hex", "base", "spans"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(tidy(run), schema_of(doc_id="long", n_assign="long", n_access="long", n_hex="long", base="string", spans="string"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def brute_force(text: str | None) -> tuple[int, int, int, str]:
    """The base contract by match-then-filter, for tests."""
    t = text or ""
    spans = [(*m.span(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    spans += [(*m.span(), "access") for m in ACCESS.finditer(t) if len(m[0]) >= 18]
    spans += [(*m.span(), "hex") for m in HEX.finditer(t) if len(m[0]) >= 16]
    spans.sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    n = [sum(k == x for _, _, k in spans) for x in KINDS[:3]]
    return (*n, hashlib.sha256(joined(spans).encode()).hexdigest())
