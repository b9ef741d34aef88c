import numpy as np
import pytest

from nearcast.llm import embeddings


def at_cosine(rng, x, c):
    y = rng.normal(size=len(x))
    y -= (y @ x) * x
    return c * x + np.sqrt(1 - c * c) * y / np.linalg.norm(y)


@pytest.mark.parametrize("n,d", [(500, 64), (50_000, 64), (10_000_000, 64), (10_000, 17)])
def test_recall_of_filters(n, d):
    """Pairs exactly at the threshold share a filter; unrelated vectors pass about as many as planned."""
    rng = np.random.default_rng(d)
    codes = embeddings.filters(d, n, 0.9)
    x = rng.normal(size=(200, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.stack([at_cosine(rng, v, 0.9) for v in x])
    hit, size = np.zeros(200, dtype=bool), 0
    for f in codes:
        sets = []
        for z in (x, y):
            row, found = f.decode(z)
            sets.append([set(found[row == k].tolist()) for k in range(200)])
        hit |= [bool(a & b) for a, b in zip(*sets)]
        size += np.mean([len(s) for s in sets[0]])
    assert hit.mean() >= 0.95  # exactly at the threshold; closer pairs share more
    assert size < 150


def test_code_error():
    rng = np.random.default_rng(0)
    for d in (2, 64, 300):
        x = rng.normal(size=(400, d)) * np.exp(rng.normal(size=(400, 1)))
        x[::3, 0] *= 10
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        q = embeddings.decoded(embeddings.coded(x)).astype(float)
        assert abs(q @ q.T - x @ x.T).max() < embeddings.CODE_ERROR


def brute(rows):
    ok = [r for r in rows if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1]) and any(r[1])]
    n = len(rows)
    where = [i for i, r in enumerate(rows) if r in ok]
    links, parent = [0] * n, list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a in where:
        for b in where:
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a < b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    small = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            small[find(i)] = min(small.get(find(i), r[0]), r[0])
    return sorted((r[0], links[i], small.get(find(i))) for i, r in enumerate(rows) if r[0] is not None)


def test_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    vectors = [v / np.linalg.norm(v) for v in rng.normal(size=(150, 64))]
    for k, c in ((0, .995), (1, .97), (2, .93), (3, .97)):
        vectors += [at_cosine(rng, vectors[k], c) for _ in range(40)]
    step = vectors[5]
    for _ in range(10):  # a chain that leaves its start
        step = at_cosine(rng, step, 0.95)
        vectors.append(step)
    vectors += vectors[:30] + [7.5 * vectors[2], -vectors[2]]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    rows += [(900, None), (901, [0.0] * 64), (902, [None] + [1.0] * 63), (903, [float("nan")] * 64), (904, [float("inf")] * 64),
             (905, []), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (908, [1e-30] * 64), (909, [1e30] * 64), (910, [1.0]), (3, [-1.0, 2.0])]
    df = spark.createDataFrame([(i, v, i, 1) for i, v in rows], "vec_id long, embedding array<float>, node long, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect())
    want = brute([(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows])
    assert len(got) == len(want)
    # pairs at the edge are found by the filters with a probability; all others are exact here
    assert sum(a == b for a, b in zip(got, want)) >= 0.99 * len(want)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_driver_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect())
    assert got == brute([(r.vec_id, r.embedding) for r in df.collect()])


def test_pairs_of_one_filter():
    """Two dimensions in one filter and any blocks: the same pairs as one by one."""
    rng = np.random.default_rng(8)
    unit = [x / np.linalg.norm(x) for d in (6, 9) for x in rng.normal(size=(60, d)) + 1.0]
    code = [embeddings.coded(x[None])[0] for x in unit]
    node, ball, block = np.arange(120) * 7 - 300, rng.integers(0, 30, 120), rng.integers(0, 2, 120)
    for blocks in (None, block):
        want = set()
        for i in range(120):
            for j in range(i):
                if len(unit[i]) == len(unit[j]) and ball[i] != ball[j] and (blocks is None or blocks[i] != blocks[j]) \
                        and embeddings.decoded([code[i]])[0] @ embeddings.decoded([code[j]])[0] >= 0.8:
                    want.add((min(node[i], node[j]), max(node[i], node[j])))
        got = embeddings.near_in(node, code, ball, 0.8, blocks)
        assert want and got.shape == (2, len(want)) and {tuple(p) for p in got.T.tolist()} == want
        assert np.array_equal(embeddings.distinct_pairs([got, got[:, ::-1]]), embeddings.distinct_pairs([got]))
    assert embeddings.distinct_pairs([got[:, :0]]).shape == (2, 0)


def test_blocks_lose_no_link(spark):
    rng = np.random.default_rng(6)
    middle = rng.normal(size=64)
    cone = [at_cosine(rng, middle / np.linalg.norm(middle), 0.96) for _ in range(90)]  # many balls near one direction
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(cone)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole, split = (sorted(map(tuple, embeddings.near_vectors(df, block=b).collect())) for b in (10_000, 12))
    assert whole == split and sum(r[1] for r in whole) > 1000
