import zlib

import numpy as np
import pytest

from nearcast.llm import langid

SF = "/root/testdata/sf0.001"


def test_gradients_match_differences():
    net = langid.Network(["a", "b", "c"], hidden=3, seed=4)
    net.weights = {k: w.astype(np.float64) for k, w in net.weights.items()}
    rng = np.random.default_rng(0)
    data = rng.integers(0, 5, (4, 6)).astype(np.int16)
    data[1, 4:] = data[3, 1:] = langid.PAD
    labels = np.array([0, 1, 2, 1])

    def loss():
        x = net.run(data).astype(np.float64)
        p = np.exp(x - x.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        mask = (data != langid.PAD).T
        return -(np.log(p[:, labels, np.arange(4)]) * mask).sum() / mask.sum()

    got = net.gradients(data, labels)
    for k, w in net.weights.items():
        places = [i for i in np.ndindex(w.shape) if abs(got[k][i]) > 1e-3][:12]
        assert places
        for i in places:
            old, e = w[i], 1e-2
            w[i] = old + e
            up = loss()
            w[i] = old - e
            down = loss()
            w[i] = old
            assert got[k][i] == pytest.approx((up - down) / (2 * e), rel=0.05, abs=2e-4)


def test_windows_do_not_depend_on_neighbours():
    net = langid.Network(["a", "b"], seed=2)
    texts = [b"x" * 300, b"", b"abc", bytes(range(200)) * 3]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    p = langid.probabilities(net, raw, ends - [len(t) for t in texts], ends)
    for t, row in zip(texts, p):
        if t:
            alone = langid.probabilities(net, np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t)]))
            assert np.allclose(row, alone[0], atol=1e-5) and row.sum() == pytest.approx(1, abs=1e-5)
    back = langid.Network(["a", "b"], seed=2)
    assert np.allclose(back.run(raw[None, :20].astype(np.int16)), net.run(np.tile(raw[:20].astype(np.int16), (3, 1)))[:, :, :1], atol=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert set(got) == set(truth)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out and truth[i]]
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in got.values())


def test_edge_rows(spark):
    rows = [(i, "the cat and the dog sat here " * 5, "en", "s") for i in range(40)]
    rows += [(i, "der hund und die katze saßen übel " * 5, "de", "s") for i in range(40, 80)]
    rows += [(100, None, "en", "s"), (101, "", "en", "s"), (102, "123 ... !!", "de", "s"), (None, "the cat and the dog", None, "s"),
             (103, "the cat and the dog sat " * 20_000, None, None), (100, "der hund und die katze", "zz", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").selectExpr(
        "*", "1 as k", "2 as u", "3 as th", "4 as n", "5 as i")
    got = langid.identify(df).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.lang_pred) for r in got if r.doc_id in (None, 100, 101, 102, 103)}
    assert by == {(100, "und"), (101, "und"), (102, "und"), (None, "en"), (103, "en"), (100, "de")}
    assert langid.identify(df.limit(0)).count() == 0
    unlabelled = langid.identify(df.where("doc_id = 103")).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]
