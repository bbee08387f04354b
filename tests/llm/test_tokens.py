import random
import zlib

import numpy as np
import pytest

from millrace.llm import rans, tokenfile
from millrace.llm.tokens import encoder


@pytest.mark.parametrize("n", [0, 1, 5, rans.LANES - 1, rans.LANES, rans.LANES + 1, 50_000])
def test_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 50257).astype(np.uint32)
    table = rans.Table.load(rans.Table.of_counts(np.bincount(ids, minlength=50257)).dump())
    block = rans.encode(ids, table)
    assert (rans.decode(block, table) == ids).all()
    if n:
        with pytest.raises(ValueError):
            rans.decode(block[:-1] + bytes([block[-1] ^ 1]), table)


def test_one_symbol():
    ids = np.full(5000, 7, np.uint32)
    table = rans.Table.of_counts(np.bincount(ids))
    assert (rans.decode(rans.encode(ids, table), table) == ids).all()


def test_pieces_encode_like_whole_texts():
    e, rng = encoder(), random.Random(2)
    parts = ["a", "é", " ", "  ", "\n", "\t", "'s", "12", ".", "!!", "<|endoftext|>", "\x1c", "ß", "日本", "'", "-", "x", "the "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(1500)] + ["word " * 20_000]
    for t, got in zip(texts, e.ids(texts), strict=True):
        assert np.frombuffer(got, e.dtype).tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_a_slice_in_few_calls_of_the_library(monkeypatch):
    e, rng, calls = encoder(), random.Random(5), []
    e.tokenizer.encode("x")
    letters = "abcdefghijklmnoprstuvé"
    words = ["".join(rng.choices(letters, k=rng.randint(3, 9))) + rng.choice(["", "", ",", "(1)", ".\n\nX", "'s-"]) for _ in range(3000)]
    texts = [" ".join(words[i : i + 30]) for i in range(0, 3000, 30)] + ["", None, "\n", "x\n", "é\n é", "\nab cd", "a\xad b\x7fc d"]

    class Model:
        def tokenize(self, word, of=e.tokenizer.model.tokenize):
            calls.append(word)
            return of(word)

    monkeypatch.setattr(e, "model", Model())
    ids, sizes = e.flat(texts, tokenfile.END_ID)
    want = [[*e.tokenizer.encode(t or "", add_special_tokens=False).ids, tokenfile.END_ID] for t in texts]
    assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    assert len(calls) < 600  # one a word before
    assert e.flat([])[0].tolist() == []


def check(out, docs):
    e, start = encoder(), 0
    order = sorted(docs, key=lambda d: (-(2**63) if d[0] is None else d[0], d[1] or ""))
    got = sorted(out, key=lambda r: r.start)
    assert len(got) == len(order)
    for r, (i, t) in zip(got, order, strict=True):
        ids = np.array([*e.tokenizer.encode(t or "", add_special_tokens=False).ids, tokenfile.END_ID], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(tokenfile.op7_token_files(spark, sf).collect(), docs)


def test_odd_documents_and_ranges(spark, odd_docs, no_docs):
    folder, parts = tokenfile.write_tokens(odd_docs)
    rows = tokenfile.read_tokens(spark, folder, parts, with_ids=True).collect()
    check(rows, [(r.doc_id, r.text) for r in odd_docs.collect()])
    flat = np.concatenate([r.ids for r in sorted(rows, key=lambda r: r.start)])
    base = 0
    for part, _, n in parts:
        f = tokenfile.TokenFile(f"{folder}/ids-{part:05d}", tokenfile._table(f"{folder}/table"))
        for a, k in ((0, 3), (n // 2, 50), (n - 1, 9)):
            assert f.ids(a, k).tolist() == flat[base + a : base + min(n, a + k)].tolist()
        base += n
    folder, parts = tokenfile.write_tokens(no_docs)
    assert parts == [] and tokenfile.read_tokens(spark, folder, parts).count() == 0


def test_tokenizers_with_other_rules_encode_whole_texts():
    from pathlib import Path

    import public_tokenizers
    from millrace.llm.tokens import Encoder

    texts = ["a b  c", "Hello, world! it's 12 o'clock", " lead and trail ", "grüße\nfrom 漢字", "<|endoftext|> x", "", None]
    seen = set()
    for path in sorted(Path(public_tokenizers.__file__).parent.glob("*.json")):
        try:
            e = Encoder(str(path))
        except Exception:  # noqa: BLE001  not a tokenizers file
            continue
        seen.add(e.cuts)
        want = [e.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(x, e.dtype).tolist() for x in e.ids(texts)] == want
    assert True in seen


def test_one_look_tells_a_slot_its_frequency_and_place():
    table = rans.Table.of_counts(np.array([5, 0, 1, 90_000, 3]))
    slot = np.arange(1 << rans.BITS)
    assert (table.step >> np.uint64(rans.BITS) == table.freq[table.symbol]).all()
    assert (table.step & np.uint64((1 << rans.BITS) - 1) == slot - table.start[table.symbol]).all()
    alone = rans.Table.of_counts(np.array([0, 4]))  # its frequency takes a bit more
    assert (alone.step >> np.uint64(rans.BITS) == 1 << rans.BITS).all()
