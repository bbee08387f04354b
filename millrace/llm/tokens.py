"""Whole-text token ids from an installed tokenizer, each distinct piece encoded once a worker.

A byte-level BPE never merges across a pre-token, and a single space between two non-space characters
always starts one, so a text may be cut before such spaces: the ids of the pieces, joined, are the ids
of the text.  Pieces repeat much more than texts do, so their ids are kept in a bounded memo; the
library's BPE model runs on each new pre-token.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import kept

#: Bytes of pieces that a worker keeps in each of two generations; of other pre-tokens, half as many.
MEMO_BYTES = 80 << 20
#: Bytes of an entry besides its key and ids: two objects and their place in a table.
ENTRY = 190
#: Pre-tokens given to the library at once.
TOGETHER = 256
#: Pieces over this many characters aren't kept.
LONG = 40
#: White space other than space and line feed, and the pairs with those two that may not be cut between.
_SPACES = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACE = re.compile(r"\s")
_ASCII = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_ODD = re.compile("[<\x1c-\x1f\x85\u0530-\U0010ffff]")
_PLAIN_END = frozenset(".,;:!?")


def joined(text: str) -> bool:
    """Whether a space stands beside white space, or at an end; most texts are told by a few quick searches."""
    if text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text:
        return True
    return any(c in text for c in _ASCII) if text.isascii() else _SPACES.search(text) is not None


def pieces(text: str) -> list[str]:
    """Cut before every single space with a non-space on both sides; "".join(pieces) is the text."""
    parts = text.split(" ")
    out: list[str] = []
    cut = False  # may the next part start a piece
    for i, p in enumerate(parts):
        if not i:
            out.append(p)
        elif cut and p and not p[0].isspace():
            out.append(" " + p)
        else:
            out[-1] += " " + p
        cut = bool(p) and not p[-1].isspace()
    return out


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level BPE writes bytes as: printable Latin-1 as itself, the rest from U+0100 on."""
    kept = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Memo:
    """A table of bounded bytes: when the young generation is full it becomes the old one, and what is
    still asked for moves back into the new young one."""

    def __init__(self, most: int):
        self.most, self.size = most, 0
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, key: str) -> bytes | None:
        got = self.young.get(key)
        if got is None and (got := self.old.get(key)) is not None:
            self.put(key, got)
        return got

    def put(self, key: str, ids: bytes) -> None:
        if len(key) <= LONG:
            self.young[key] = ids
            self.size += ENTRY + len(key) + len(ids)

    def settle(self) -> None:
        """Called between texts, when nobody looks into the young generation."""
        if self.size > self.most:
            self.old, self.young, self.size = self.young, {}, 0


class Encoder:
    """flat(texts): ids of a slice of texts; ids(texts): those of each text, as little-endian bytes of `width`-byte unsigned integers."""

    def __init__(self, path: str, memo_bytes: int = MEMO_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if self.size < 1 << 16 else 4
        self.dtype = "<u2" if self.width == 2 else "<u4"
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.space = self.letters[ord(" ")]
        self.codes = [i.to_bytes(self.width, "little") for i in range(self.size)]
        import json

        import regex
        from public_tokenizers import PATTERN
        from public_tokenizers import path as installed

        def kind(t):
            c = json.loads(t.to_str())
            marked = all("<" in x["content"] and not _SPACE.search(x["content"]) for x in c["added_tokens"])
            return marked, c["pre_tokenizer"], c["normalizer"], {k: v for k, v in c["model"].items() if k not in ("vocab", "merges")}

        #: Pieces are cut by the installed byte-level BPE's rules; a tokenizer with others encodes whole texts.
        self.cuts = kind(self.tokenizer) == kind(Tokenizer.from_file(installed("byte_bpe_50k.json")))

        self.split = regex.compile(PATTERN).findall
        # a byte that UTF-8 never has, if no merge has its letter
        model, spare = json.loads(self.tokenizer.to_str())["model"], self.letters[0xC0]
        lone = self.cuts and not any(spare in (x if isinstance(x, str) else "".join(x)) for x in model["merges"])
        self.apart, self.apart_id = "\udcc0" if lone and spare in model["vocab"] else None, model["vocab"].get(spare)
        self.memo = Memo(memo_bytes)  # of " " + key
        self.tokens = Memo(memo_bytes // 2)  # of pre-tokens

    def whole(self, text: str) -> bytes:
        """The library's own path, for pieces out of the ordinary."""
        return b"".join(i.to_bytes(self.width, "little") for i in self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _bpe(self, token: str) -> bytes:
        if token.isascii() and token.isprintable():  # of these only the space has another letter
            word = token.replace(" ", self.space)
        else:
            word = token.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.codes[t.id] for t in self.model.tokenize(word)])

    def _pre_token(self, token: str) -> bytes:
        got = self.tokens.get(token)
        if got is None:
            got = self._bpe(token)
            self.tokens.put(token, got)
        return got

    def _word(self, part: str) -> bytes:
        """ids of " " + part for letters alone; plain words are pieces, and kept as such."""
        got = self.memo.get(part)
        if got is None:
            got = self._bpe(" " + part)
            self.memo.put(part, got)
        return got

    def first(self, part: str) -> bytes:
        """ids of a text's first piece, which has no space before it."""
        if not part or _ODD.search(part):
            return self.whole(part) if part else b""
        return b"".join(map(self._pre_token, self.split(part)))

    def piece(self, part: str) -> bytes:
        """ids of " " + part, where part is not empty and starts and ends with a non-space."""
        if part.isalpha():
            return self._bpe(" " + part)
        if part[-1] in _PLAIN_END and part[:-1].isalpha():
            return self._word(part[:-1]) + self._pre_token(part[-1])
        if _ODD.search(part):  # special tokens, unusual spaces, scripts whose tables may differ between libraries
            return self.whole(" " + part)
        return b"".join(map(self._pre_token, self.split(" " + part)))

    def _cut(self, text: str) -> bytes:
        """ids of a text with spaces out of the ordinary."""
        first, *rest = pieces(text)
        if any(p[-1:].isspace() or " " in p[1:] for p in rest):
            return b"".join([self.whole(first), *(self.whole(p) if p[-1].isspace() or " " in p[1:] else self.piece(p[1:]) for p in rest)])
        return b"".join([self.first(first), *(self.piece(p[1:]) for p in rest)])

    def _all(self, tokens: list[str]) -> list[bytes]:
        """_bpe() of many pre-tokens, some at a time, with a letter between them that no merge has."""
        if self.apart is None:
            return [self._bpe(t) for t in tokens]
        out, w = [], self.width
        for lo in range(0, len(tokens), TOGETHER):
            word = self.apart.join(tokens[lo : lo + TOGETHER]).encode("utf-8", "surrogateescape").decode("latin-1").translate(self.letters)
            ids = np.array([t.id for t in self.model.tokenize(word)], self.dtype)
            data, at = ids.tobytes(), (w * np.flatnonzero(ids == self.apart_id)).tolist()
            out += [data[a:b] for a, b in zip([0, *(x + w for x in at)], [*at, len(data)], strict=True)]
        return out

    def _mixed(self, parts: list[str]) -> list[bytes]:
        """piece() of parts without odd letters or white space but line feeds inside, taken apart by one search."""
        found = self.split("\n".join([" " + p for p in parts]))
        seen, old = self.tokens.young, self.tokens.old
        for t in [t for t in dict.fromkeys(found) if t not in seen and t in old]:
            self.tokens.put(t, old[t])
        fresh = [t for t in dict.fromkeys(found) if t not in seen]
        made = dict(zip(fresh, self._all(fresh), strict=True))
        for t, x in made.items():
            self.tokens.put(t, x)
        out, now = [], []
        for t in found:
            if now and t[0] == " ":  # only a part's first has a space, and the line feed before it is a pre-token
                out.append(b"".join(now[:-1]))
                now = []
            now.append(seen.get(t) or made[t])
        out.append(b"".join(now))
        return out

    def _new(self, words: list[str], got: list[bytes | None], used: np.ndarray) -> None:
        """Fills in the pieces of a slice's distinct words that the young generation hasn't."""
        young, old, grown = self.memo.young, self.memo.old, 0
        fresh: dict[str, int] = {}
        ended, mixed, done = [], [], []
        for at in [i for i, (x, u) in enumerate(zip(got, used.tolist(), strict=True)) if x is None and u]:
            p = words[at]
            if (x := old.get(p)) is not None:
                got[at] = x
                done.append(at)
            elif p.isalpha():
                fresh[p] = at
            elif p[-1] in _PLAIN_END and (core := p[:-1]).isalpha():
                ended.append(at)
                if core not in young and core not in old:
                    fresh.setdefault(core, -1)
            elif "\n" not in (p[0], p[-1]) and p.replace("\n", "").isprintable() and not _ODD.search(p):
                mixed.append(at)
            else:
                got[at] = self.piece(p)
                done.append(at)
        made = dict(zip(fresh, self._all([" " + p for p in fresh]), strict=True))
        for p, at in fresh.items():
            if at >= 0:
                got[at] = made[p]
                done.append(at)
            elif len(p) <= LONG:
                young[p] = made[p]
                grown += ENTRY + len(p) + len(made[p])
        for at in ended:
            core = words[at][:-1]
            got[at] = (made.get(core) or young.get(core) or old[core]) + self._pre_token(words[at][-1])
        if mixed:
            for at, x in zip(mixed, self._mixed([words[at] for at in mixed]), strict=True):
                got[at] = x
        for at in done + ended + mixed:
            p, x = words[at], got[at]
            if len(p) <= LONG:
                young[p] = x
                grown += ENTRY + len(p) + len(x)
        self.memo.size += grown

    def flat(self, texts: list[str | None], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice of texts, end to end, and how many each text has; end: an id after each text.

        Each distinct word of the slice is looked up once.
        """
        self.memo.settle()
        self.tokens.settle()
        plain = [self.cuts and bool(t) and not joined(t) for t in texts]
        parts = pc.split_pattern(pa.array([t if p else "" for t, p in zip(texts, plain, strict=True)], pa.string()), " ")
        begin = parts.offsets.to_numpy()[:-1]
        coded = parts.values.dictionary_encode()
        seq, n = coded.indices.to_numpy(), len(coded.dictionary)
        words = pc.binary_join(pa.ListArray.from_arrays([0, n], coded.dictionary), " ")[0].as_py().split(" ") if n else []
        rest = np.ones(len(seq), bool)
        rest[begin] = False
        used = np.zeros(len(words), bool)
        used[seq[rest]] = True  # as more than a text's first part
        got: list[bytes | None] = list(map(self.memo.young.get, words))
        self._new(words, got, used)
        heads = [self.first(words[k]) if p else (self._cut(t) if self.cuts else self.whole(t)) if t else b"" for t, p, k in zip(texts, plain, seq[begin].tolist(), strict=True)]
        # runs of ids: of words, of the texts' heads, and the end
        pool = [x or b"" for x in got] + heads + [b"" if end is None else end.to_bytes(self.width, "little")]
        seq = seq.astype(np.int32)
        seq[begin] = len(words) + np.arange(len(texts), dtype=np.int32)
        stop = np.r_[begin[1:], len(seq)]
        if end is not None:
            seq = np.insert(seq, stop, len(pool) - 1)
            begin = begin + np.arange(len(begin))
        size = np.fromiter(map(len, pool), np.int64, len(pool)) // self.width
        start = np.cumsum(size) - size
        n = size[seq]
        before = np.cumsum(n) - n
        ids = np.frombuffer(b"".join(pool), self.dtype)[np.repeat(start[seq] - before, n) + np.arange(int(n.sum()))]
        return ids, np.add.reduceat(n, begin) if len(begin) else n

    def ids(self, texts: list[str | None]) -> list[bytes]:
        flat, sizes = self.flat(texts)
        data, ends = flat.tobytes(), (np.cumsum(sizes) * self.width).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


@kept
def encoder(path: str | None = None, memo_bytes: int = MEMO_BYTES) -> Encoder:
    """The worker's encoder for a tokenizers file; by default the installed byte-level BPE."""
    from public_tokenizers import path as installed

    return Encoder(path or installed("byte_bpe_50k.json"), memo_bytes)
