import numpy as np
import pytest

from millrace.llm import language as lg

TEXT = {"en": "the house and the water of that other man with what he had", "de": "das Haus und die Straße über den Fluß nicht für einen Mann", "fr": "la maison et l'eau de cet homme avec ce qu'il avait été où", "es": "la casa y el agua de ese señor con lo que él había años"}


def test_net_learns_and_scores_whole_texts():
    rng = np.random.default_rng(0)
    names = sorted(TEXT)
    draw = lambda k: " ".join(rng.choice(TEXT[k].split(), 40))
    x = np.stack([lg.windows(draw(k).encode()[: lg.LENGTH])[0] for k in names for _ in range(60)])
    y = np.repeat(np.arange(4), 60)
    net = lg.ByteConvNet(names).fit(x, y)
    got = net.predict([draw(k) for k in names] + [None, "", "12 !?", draw("de") * 50])
    assert [g[0] for g in got] == [*names, "und", "und", "und", "de"]
    assert all(0 <= s <= 1 for _, s in got) and got[4][1] == 0


def test_max_pooling_gradient_matches_differences():
    net = lg.ByteConvNet(["a", "b"], seed=3)
    x = np.random.default_rng(1).integers(97, 123, (2, lg.LENGTH)).astype(np.uint8)
    pooled, at = net.pooled(x, where=True)
    z = sum(net.tables[0][k][x[:, k : lg.LENGTH - 1 + k]] for k in range(2))
    assert np.allclose(pooled[:, : lg.FILTERS], z.max(1)) and (at[0] == z.argmax(1)).all()


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(5)
    net = lg.ByteConvNet(["a", "b", "c"], seed=4)
    net.tables = [t.astype(np.float64) for t in net.tables]
    net.bias, net.dense, net.offset = net.bias.astype(np.float64) + 0.05, net.dense.astype(np.float64), net.offset.astype(np.float64)
    x = rng.integers(97, 110, (6, lg.LENGTH)).astype(np.uint8)
    y, weight = np.array([0, 1, 2, 0, 1, 1]), np.array([1.0, 0.5, 2.0])
    _, grads = net.gradients(x, y, weight)
    params = [*net.tables, net.bias, net.dense, net.offset]
    for q, g in zip(params, grads, strict=True):
        spots = np.argwhere(np.abs(g) > np.abs(g).max() / 3)[:4]
        assert len(spots)
        for at in map(tuple, spots):
            keep, eps = q[at], 1e-6
            q[at] = keep + eps
            up = net.gradients(x, y, weight)[0]
            q[at] = keep - eps
            down = net.gradients(x, y, weight)[0]
            q[at] = keep
            assert abs((up - down) / (2 * eps) - g[at]) < 1e-5


def test_query_accuracy_and_contract(spark, sf):
    out = lg.op1_language_id(spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas().merge(out, on="doc_id")
    import zlib

    assert len(docs) == len(out) and all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(out.doc_id, out.held_out, strict=True))
    held = docs[docs.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.95


def test_odd_documents(spark, odd_docs, no_docs):
    net = lg.train(odd_docs)
    got = {r.doc_id: r for r in lg.with_language(odd_docs, net).collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[6].lang_pred == "und" and got[5].lang_pred != "und"
    assert lg.with_language(odd_docs, net).count() == 9 and lg.with_language(no_docs, lg.train(no_docs)).count() == 0
    kept = lg.keep_identified(odd_docs, net, 0.0)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 5, 7, None}
    assert [r.score for r in kept.where("doc_id = 1").collect()] == [1.0]  # the clashing column is the document's own


@pytest.mark.parametrize(("text", "is_language"), [("½ ² ①", False), ("Ⅷ ㈠ 12 _", False), ("५ ٣", False), ("ª", True), ("½ a", True), ("漢", True), ("", False), (None, False)])
def test_letters(text, is_language):
    assert lg.has_letter(text) == is_language


def test_forward_pass_by_plain_convolution():
    """All widths, pooling, softmax and the mean over windows, position by position."""
    rng = np.random.default_rng(9)
    net = lg.ByteConvNet(["a", "b", "c"], seed=4)
    net.bias = rng.normal(0, 0.1, net.bias.shape).astype(np.float32)
    net.offset = rng.normal(0, 0.1, net.offset.shape).astype(np.float32)
    text = "Some words of a text " * 30 + "and its end"
    data = text.lower().encode()
    total, weight = np.zeros(3), 0
    for lo in range(0, len(data), lg.LENGTH):
        piece = data[lo : lo + lg.LENGTH]
        x = list(piece) + [0] * (lg.LENGTH - len(piece))
        pooled = []
        for w, table in zip(lg.WIDTHS, net.tables, strict=True):
            pooled += [max(sum(float(table[k][x[p + k]][f]) for k in range(w)) for p in range(lg.LENGTH - w + 1)) for f in range(lg.FILTERS)]
        act = np.maximum(0, np.array(pooled) + net.bias)
        z = act @ net.dense + net.offset
        e = np.exp(z - z.max())
        total += e / e.sum() * len(piece)
        weight += len(piece)
    (lang, score), = net.predict([text])
    assert lang == net.classes[int(total.argmax())] and abs(score - total.max() / weight) < 1e-4
