"""The network: gradients, whole texts, held-out accuracy."""

import math

import numpy as np

from small import DOCS, frame, odd_documents, tuples, with_clashes
from termite.llm import language_id as L
from termite.session import table_path


def test_gradients_by_differences():
    rng = np.random.default_rng(3)
    net = L.new_network(["a", "b", "c"], seed=3)
    data = rng.integers(97, 105, (6, 4)).astype(np.uint8)
    label = np.array([0, 1, 2, 1])
    for p in net.parameters():
        p *= 0.3  # keep away from the clips' corners
    net.ahead, net.back = (L.Direction(*[x.astype(np.float64) for x in (d.x, d.gates, d.state)]) for d in (net.ahead, net.back))
    net.out, net.bias = net.out.astype(np.float64), net.bias.astype(np.float64)
    _, grads = L.gradients(net, data, label)
    for p, g in zip(net.parameters(), grads):
        for at in [tuple(rng.integers(0, n) for n in p.shape) for _ in range(4)] + [np.unravel_index(np.abs(g).argmax(), p.shape)]:
            was, step = p[at], 1e-3
            p[at] = was + step
            up = L.gradients(net, data, label)[0]
            p[at] = was - step
            down = L.gradients(net, data, label)[0]
            p[at] = was
            assert abs((up - down) / (2 * step) - g[at]) < 2e-3


def test_every_byte_counts_and_padding_does_not():
    net = L.new_network(["a", "b"])
    one = L.document_probabilities(net, [b"abc" * 100])
    with_others = L.document_probabilities(net, [b"", b"x" * 1000, b"abc" * 100, b"y"])
    assert np.allclose(one[0], with_others[2], atol=1e-5) and (with_others[0] == 0).all()
    data = np.frombuffer(b"abc".ljust(L.SEGMENT, b"\0"), np.uint8)[:, None]
    inside = np.arange(L.SEGMENT)[:, None] < 3
    assert np.isclose(L.label_segments(net, data, inside).sum(), 3, atol=1e-4)


def plain_probabilities(net, text):
    """Forward, backward and pooling one byte and one unit at a time."""
    def run(d, part):
        h, states = [0.0] * L.HIDDEN, []
        clip = lambda x: max(-1.0, min(1.0, x))
        units = range(L.HIDDEN)
        for b in part:
            gate = [(clip(d.x[b][i] + sum(h[j] * d.gates[j][i] for j in units)) + 1) / 2 for i in range(2 * L.HIDDEN)]
            z, r = gate[:L.HIDDEN], gate[L.HIDDEN:]
            c = [clip(d.x[b][2 * L.HIDDEN + i] + sum(r[j] * h[j] * d.state[j][i] for j in units)) for i in units]
            h = [h[i] + z[i] * (c[i] - h[i]) for i in units]
            states.append(h)
        return states

    total = [0.0] * len(net.languages)
    for at in range(0, len(text), L.SEGMENT):
        part = text[at:at + L.SEGMENT]
        for b, front, rear in zip(part, run(net.ahead, part), run(net.back, part[::-1])[::-1]):
            if chr(b).isalpha() or b > 127:
                logit = [net.bias[k] + sum(x * net.out[i][k] for i, x in enumerate(front + rear)) for k in range(len(total))]
                e = [math.exp(x) for x in logit]
                total = [t + x / sum(e) for t, x in zip(total, e)]
    return [t / max(sum(total), 1e-9) for t in total]


def test_forward_and_pooling_against_plain_loops():
    net = L.new_network(["a", "b", "c"], seed=5)
    texts = ["Ein kurzer Text, mit 12 Zahlen.".encode(), "é".encode() * 70, b"x" * L.SEGMENT, b"word and more " * 30, b"1 2 3", b""]
    for text, got in zip(texts, L.document_probabilities(net, texts)):
        assert np.allclose(got, plain_probabilities(net, text), atol=1e-4)


def test_training_rows_stay_where_they_are_read(spark):
    """No exchange of texts: the language counts travel, and repeated rows of an id give their pieces once."""
    seen = []
    fit, L.fit = L.fit, lambda pieces, labels: seen.append((pieces, labels)) or fit(pieces, labels)
    try:
        same = [(1, "the same text in each row", "en", "a", 1)] * 300
        L.train(frame(spark, same + [(2, "ein anderer Text", "de", "a", 1), (3, "the same text in each row", "en", "a", 1)]))
    finally:
        L.fit = fit
    assert sorted(seen[0][1]) == ["de", "en", "en"]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(table_path("/root/testdata/sf0.01", "documents"))
    rows = L.identify(docs).where("held_out").select("lang", "lang_pred", "score").collect()
    right = sum(r.lang == r.lang_pred for r in rows)
    assert len(rows) > 150 and right / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_documents(spark):
    rows = [r for r in odd_documents() if r[0] != 5] + [(30, "12 34 !?", "en", "a", 8)]
    got = L.identify(with_clashes(frame(spark, rows)))
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in got.collect() if r.doc_id is not None}
    assert got.count() == len(rows)
    assert all(by_id[i] == ("und", 0.0) for i in (1, 2, 3, 30))
    assert by_id[6][0] in ("en", "de", "fr") and 0 < by_id[6][1] <= 1
    nothing = L.identify(frame(spark, [(1, "text", None, "a", 1)])).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
    alone = L.identify(frame(spark, [(i, "text", "xx", "a", 1) for i in range(8)])).collect()
    assert {(r.lang_pred, round(r.score, 5)) for r in alone} == {("xx", 1.0)}
    assert L.identify(frame(spark, [], DOCS)).count() == 0
