"""Histogram boosted trees against the same rules in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearcast.operators import boosting as B

FEATURES = ["a", "b", "c"]
PARAMS = dict(max_depth=3, learning_rate=0.3, max_iter=12, min_rows=15, l2=1.0, max_leaves=6)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    n = 900
    a, b, c = rng.normal(size=n), rng.integers(0, 4, n).astype(float), rng.gamma(2, 3, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(1.5 * a - (b == 2) * 2 + 0.2 * c - 1)))).astype(float)
    data = [(float(a[i]), float(b[i]), None if i % 11 == 0 else float(c[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(data, "a double, b double, c double, y double").repartition(3).cache()


def numpy_fit(values, y, edges, start, p):
    """Best-first growth, one node at a time, over the same bins."""
    model = B.Boosted(edges, start, [])
    bins = model.binned(values).astype(int)
    raw = np.full(len(y), start)

    def cut(g, h, mask):
        best = None
        for j in range(bins.shape[1]):
            for b in np.unique(bins[mask, j]):
                left = mask & (bins[:, j] <= b)
                right = mask & ~left
                if min(left.sum(), right.sum()) < p["min_rows"]:
                    continue
                s = lambda m: g[m].sum() ** 2 / (h[m].sum() + p["l2"])
                gain = round(s(left) + s(right) - s(mask), 9)
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, j, b, left, right)
        return best
    for _ in range(p["max_iter"]):
        q = 1 / (1 + np.exp(-raw))
        g, h = q - y, q * (1 - q)
        leaves = [(np.ones(len(y), bool), 0)]
        while len(leaves) < p["max_leaves"]:
            options = [(cut(g, h, m), k) for k, (m, d) in enumerate(leaves) if d < p["max_depth"]]
            options = [o for o in options if o[0]]
            if not options:
                break
            best, k = max(options, key=lambda o: o[0][0])
            depth = leaves.pop(k)[1]
            leaves += [(best[3], depth + 1), (best[4], depth + 1)]
        for m, d in leaves:
            if d:
                raw[m] -= p["learning_rate"] * g[m].sum() / (h[m].sum() + p["l2"])
    return 1 / (1 + np.exp(-raw))


def test_equal_to_numpy(rows):
    model = B.fit(rows, FEATURES, "y", **PARAMS)
    assert len(model.trees) == 12 and all(t.feature.count(-1) <= 6 for t in model.trees)
    data = np.array([[np.nan if v is None else v for v in r] for r in rows.collect()])
    want = numpy_fit(data[:, :3], data[:, 3], model.edges, model.start, B.DEFAULTS | PARAMS)
    assert np.allclose(model.probability(data[:, :3]), want, atol=1e-9)
    # Spark scores the same, also after a round trip
    again = B.Boosted.from_json(model.to_json())
    got = [r.score for r in B.scored(rows, again, FEATURES).collect()]
    assert np.allclose(got, want, atol=1e-9)
    loss = lambda q: -np.mean(np.where(data[:, 3] > 0, np.log(q), np.log(1 - q)))
    assert loss(want) < 0.75 * loss(np.full(len(want), data[:, 3].mean()))


def test_edges_bound_the_bins(rows):
    edges = B.quantile_edges(rows, FEATURES)
    assert all(len(e) <= 254 and e == sorted(set(e)) for e in edges) and edges[1] == [0.0, 1.0, 2.0, 3.0]


def test_gaps(spark, rows):
    flat = rows.withColumn("a", F.lit(1.0)).withColumn("b", F.lit(None).cast("double"))
    model = B.fit(flat, ["a", "b"], "y", max_iter=5)  # nothing to split
    assert len(model.trees) == 1 and model.trees[0].feature == [-1]
    q = B.scored(flat, model, ["a", "b"]).agg(F.min("score"), F.max("score"), F.avg("y")).first()
    assert q[0] == q[1] == pytest.approx(q[2])
    with pytest.raises(ValueError):
        B.fit(rows.where("false"), FEATURES, "y")
    one = rows.withColumn("y", F.lit(1.0)).unionByName(rows.limit(5).withColumn("y", F.lit(None).cast("double")))
    assert B.fit(one, FEATURES, "y", max_iter=2, max_depth=2).start > 15


def test_bins_are_read_where_they_lie():
    import pyarrow as pa
    bins = np.arange(60, dtype=np.uint8).reshape(20, 3)
    batch = pa.RecordBatch.from_pydict({"bins": B._packed(bins)})
    assert batch.column("bins").to_pylist() == [r.tobytes() for r in bins]
    for part in (batch, batch.slice(7, 5), batch.slice(20)):
        got = B._bins(part, 3)
        assert got.tobytes() == b"".join(part.column("bins").to_pylist()) and (not len(got) or not got.flags.owndata)
