import math
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearcast.llm import perplexity as P


def brute_model(texts, order=4):
    """The same estimate with dictionaries."""
    counts = {order: Counter()}
    for t in texts:
        t = P.START * (order - 1) + t
        counts[order].update(t[i:i + order] for i in range(len(t) - order + 1))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    disc, ctx = {}, {}
    for n, c in counts.items():
        m = Counter(c.values())
        y = m[1] / (m[1] + 2 * m[2]) if m[1] + m[2] else 0.5
        disc[n] = [min(max(k - (k + 1) * y * (m[k + 1] / m[k] if m[k] else 0.5), 0.05), k - 0.05) for k in (1, 2, 3)]
        ctx[n] = defaultdict(list)
        for g, v in c.items():
            ctx[n][g[:-1]].append(v)

    def prob(h, w):
        n = len(h) + 1
        seen = ctx[n].get(h)
        lower = prob(h[1:], w) if n > 1 else 1 / (len(counts[1]) + 1)
        if not seen:
            return lower
        total = sum(seen)
        gamma = sum(disc[n][min(v, 3) - 1] for v in seen) / total
        c = counts[n].get(h + w, 0)
        return (c - disc[n][min(c, 3) - 1] if c else 0) / total + gamma * lower
    return prob


def test_model_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abcde é."), int(rng.integers(1, 200)))) for _ in range(40)]
    df = spark.createDataFrame([("en", P.START * 3 + t) for t in texts], "lang string, text string")
    model = P.Model([(r.gram, r.kind, r.value) for r in P.kneser_ney(df).collect()])
    prob = brute_model(texts)
    for t in texts[:5] + ["zzz", "a", "abc xyz é", "😀a"]:
        padded = P.START * 3 + t
        want = [math.log(prob(padded[i:i + 3], padded[i + 3])) for i in range(len(t))]
        got = model.score(np.array([ord(c) for c in padded], dtype=np.uint64))
        assert got == pytest.approx(want, abs=1e-9)
    # a distribution: the probabilities of all symbols and of one unseen symbol add up to one
    assert sum(prob("abc", w) for w in set("".join(texts)) | {"ß"}) == pytest.approx(1)


def test_table():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(1, 1 << 63, 5000).astype(np.uint64))
    t = P.Table(keys, np.arange(len(keys), dtype=float))
    assert np.array_equal(t.get(keys), np.arange(len(keys)))
    assert np.isnan(t.get(keys + np.uint64(1))).mean() > 0.99


def test_classifier_on_driver_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in P.classify(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == docs.count()
    kept = {q: np.mean([got[i].kept for i, x in truth.items() if x == q and i in got]) for q in (0, 1)}
    assert kept[1] > 0.98 and kept[0] < 0.6, kept


def test_edge_rows(spark):
    rows = [(i, f"plain words of text number {i} " * 5, "en", 1.0) for i in range(30)]
    rows += [(100, None, "en", 1.0), (101, "", "en", 1.0), (102, "#$%&" * 100, "en", 1.0), (None, "plain words of text ", None, 1.0),
             (103, "plain words of text number 5 " * 20_000, "zz", 1.0), (5, rows[5][1], "en", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(5, 1, 0), (None, 1, None)], "doc_id long, quality int, toxic int")
    got = P.classify(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].kept for i in (5, 100, 101, 102, 103, None)] == [True, False, False, False, True, True]
    assert by[100].perplexity is None and by[103].n_symbols == len(rows[-2][1])
    untrained = P.classify(docs, labels.limit(0)).collect()
    assert {r.doc_id: r.kept for r in untrained}[102] is True
    assert P.classify(docs.limit(0), labels).count() == 0


def test_threshold_is_a_quantile_of_good_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    scores = defaultdict(list)
    got = P.classify(docs, labels, quantile=0.9).collect()
    for r in got:
        if r.doc_id in good and r.score is not None:
            scores[r.lang].append(r.score)
    limit = {r.lang: r.threshold for r in got}
    for lang, x in scores.items():
        assert limit[lang] == pytest.approx(np.sort(x)[math.ceil(0.9 * len(x)) - 1]), lang


def test_counts_cover_every_trusted_text_whole(spark):
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abcde é😀\x00"), int(rng.integers(1, 60)))) for _ in range(400)] + ["ab" * 3000 + "qqqq"]
    docs = spark.createDataFrame([(i, t, "en" if i % 3 else "de") for i, t in enumerate(texts)] + [(9, None, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, int(i == 7)) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    want = Counter()
    for i, t in enumerate(texts):
        t = P.START * 3 + t
        want.update(("en" if i % 3 else "de", t[k:k + 4]) for k in range(len(t) - 3) if i != 7)
    for block in (50, 1 << 20):
        got = {(r.lang, r.gram): r.c for r in P.gram_counts(P.trusted_texts(docs, labels), block=block).collect()}
        assert got == want
    codes = np.arange(70_000, dtype=np.uint32)  # too many symbols for packed windows
    grams, count = P.count_windows(codes, np.ones(len(codes) - 3, dtype=bool), 4)
    assert len(grams) == len(codes) - 3 and set(count) == {1}


def test_shards_give_the_same_scores(spark):
    rng = np.random.default_rng(3)
    rows = [(i % 50 if i % 17 else None, "".join(rng.choice(list("abcdefg😀 é"), int(rng.integers(0, 80)))), ["en", "de", None, "zz"][i % 4])
            for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50) if i % 4 < 2], "doc_id long, quality int, toxic int")
    def key(r):
        return str(r.doc_id), str(r.lang), r.n_symbols, round(r.score or 0, 9), round(r.perplexity or 0, 9), round(r.threshold, 9), r.kept
    whole = sorted(map(key, P.classify(docs, labels).collect()))
    assert len(whole) == len(rows)
    assert sorted(map(key, P.classify(docs, labels, shard_rows=700).collect())) == whole


def test_models_are_built_without_python_objects(spark):
    """What the driver holds while it builds tables is a few arrays, not strings and tuples of every row."""
    n = 200_000
    gram = F.concat(*(F.expr(f"char(97 + cast(floor(id / {26 ** k}) % 26 as int))") for k in (3, 2, 1, 0)))
    rows = spark.range(n).select(F.lit("en").alias("lang"), gram.alias("gram"), F.lit("p").alias("kind"), (-1.0 - F.col("id")).alias("value"))
    rows = rows.unionByName(spark.createDataFrame([("en", "", "g", -9.0), ("de", "", "g", -8.0), ("de", "é", "p", -2.0)], rows.schema))
    P.shard_models(rows.where("kind = 'g'"), 0, 1)
    tracemalloc.start()
    models = P.shard_models(rows, 0, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 220 * n, peak / n
    assert models["en"].unseen == -9 and models["de"].unseen == -8
    ids = [0, 5, 26 ** 3 + 1, n - 1]
    text = np.concatenate([[97 + i // 26 ** k % 26 for k in (3, 2, 1, 0)] for i in ids]).astype(np.uint64)
    assert models["en"].score(text)[::4].tolist() == [-1.0 - i for i in ids]
    assert models["de"].score(np.array([0, 0, 0, ord("é")], dtype=np.uint64)).tolist() == [-2.0]
