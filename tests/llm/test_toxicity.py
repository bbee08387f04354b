import random

import numpy as np

from millrace.llm import toxicity as tx

BAD = ["worthless", "disgusting", "pathetic", "moron"]


def corpus(n, seed=0):
    rng = random.Random(seed)
    syll = ["th", "er", "in", "an", "ou", "re", "st", "tion", "ing", "he", "nd"]
    texts, labels = [], []
    for i in range(n):
        w = ["".join(rng.choices(syll, k=rng.randint(1, 4))) for _ in range(rng.randint(20, 80))]
        if i % 4 == 0:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        texts.append(" ".join(w))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_separates_held_out_texts():
    model = tx.fit(*corpus(800), 0.25)
    texts, labels = corpus(300, 1)
    pred = [s >= tx.THRESHOLD for s in model.scores(texts)]
    hit = sum(p and y for p, y in zip(pred, labels, strict=True)) / sum(labels)
    false = sum(p and not y for p, y in zip(pred, labels, strict=True)) / (len(labels) - sum(labels))
    assert hit > 0.9 and false < 0.05
    s = model.scores([None, "", "!!", "plain " * 50_000])
    assert ((0 <= s) & (s <= 1)).all() and s[0] == s[1]


def test_features_by_a_plain_loop_over_windows():
    import zstandard as z

    model = tx.fit(*corpus(400), 0.25)
    assert model.toxic and not any(model.toxic == w.encode() for w in BAD)
    texts = [*corpus(30, 2)[0], "", None, "plain words " * 400, " ".join(BAD) * 60, "Größe 漢字 " * 90]
    params = z.ZstdCompressionParameters.from_level(tx.LEVEL, format=z.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
    coders = [z.ZstdCompressor(compression_params=params, dict_data=z.ZstdCompressionDict(model.ordinary + tx.spread(x) + tx._TAIL)) for x in (b"", model.toxic)]
    table = model.grams.table
    for t, got in zip(texts, model.features(texts), strict=True):
        data, gains, at = (t or "").lower().encode(), [], 0
        while True:
            w = data[at : at + tx.LENGTH]
            told = any(table[tx.Grams.hashes(np.frombuffer(w[i : i + tx.GRAM], np.uint8))[0]] for i in range(len(w) - tx.GRAM + 1))
            a, b = (len(c.compress(tx.spread(w))) for c in coders) if told else (0, 0)
            gains.append(a - b)
            if at + tx.LENGTH >= len(data):
                break
            at += tx.STEP
        assert got.tolist() == [max(0, *gains), sum(max(0, g) for g in gains), len(gains), sum(g >= tx.HIT for g in gains)]


def test_too_few_labels():
    assert tx.fit(["a"], [1]) is None


def test_query_contract(spark, sf):
    import zlib

    out = tx.op4_toxicity(spark, sf).collect()
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (None, 0, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    few = tx.train(odd_docs, labels)  # one document a label is little to learn from, but not nothing
    assert few is not None and all(0 <= r.score <= 1 for r in tx.with_toxicity(odd_docs, few).collect())
    assert tx.train(odd_docs, labels.where("doc_id = 1")) is None
    model = tx.fit(*corpus(200), None)
    assert tx.with_toxicity(odd_docs, model).count() == 9 and tx.with_toxicity(no_docs, model).count() == 0
    assert {r.score for r in tx.with_toxicity(odd_docs, None).collect()} == {0.0}
