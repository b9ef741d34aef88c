from collections import Counter

import numpy as np
import pytest

from nearcast.llm import minhash
from nearcast.llm.components import connected_components


def grams(text):
    w = (text or "").split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    both = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


def brute_components(texts):
    """Smallest id reachable over exact copies and pairs at 0.8 or more."""
    ids = sorted(texts)
    g = {i: grams(texts[i]) for i in ids}
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in ids:
        for j in ids:
            if i < j and g[i] and similarity(g[i], g[j]) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def prepared(texts):
    data = [t.encode() for t in texts]
    ends = np.cumsum([len(d) for d in data])
    raw = np.frombuffer(b"".join(data), np.uint8)
    return minhash.shingles(*minhash.word_hashes(raw, ends - [len(d) for d in data], ends))


def test_shingles_are_multisets():
    texts = ["a b c d e f", " a  b\nc\td e f ", "a b", "", "   ", "ab", "x y z " * 10, "f e d c b a", "é b c d e"]
    keys, n = prepared(texts)
    sets = [set(k.tolist()) for k in np.split(keys, np.cumsum(n)[:-1])]
    assert list(n) == [sum(grams(t).values()) for t in texts] == [len(s) for s in sets]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(sets[i] & sets[j]) == sum((grams(a) & grams(b)).values())


@pytest.mark.parametrize("common,own", [(80, 10), (50, 50), (400, 20), (3, 1)])
def test_agreement_is_weighted_jaccard(common, own):
    rng = np.random.default_rng(common)
    agree = []
    for _ in range(30):
        shared = rng.integers(1, 1 << 62, common).astype(np.uint64)
        a, b = (np.concatenate([shared, rng.integers(1, 1 << 62, own).astype(np.uint64)]) for _ in range(2))
        s = minhash.darts(np.concatenate([a, b]), np.array([len(a), len(b)]))
        assert (s != 0).all()
        agree.append((s[0] == s[1]).mean())
    assert np.mean(agree) == pytest.approx(common / (common + 2 * own), abs=0.04)


def test_components(spark):
    rng = np.random.default_rng(0)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1200)] + [(5000, i) for i in range(2000, 2300)]
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for p in pairs if p[0] != p[1] for x in p}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies(rng):
    """Groups whose members have between none and many words changed, a chain, copies, and unrelated texts."""
    words = [f"w{i}" for i in range(3000)]
    texts = {}
    for g in range(6):
        base = list(rng.choice(words, 160))
        for _ in range(25):
            t = list(base)
            for _ in range(int(rng.integers(0, 12))):
                t[int(rng.integers(len(t)))] = str(rng.choice(words))
            texts[len(texts)] = " ".join(t)
    chain = list(rng.choice(words, 200))
    for k in range(8):
        texts[len(texts)] = " ".join(chain[3 * k:] + list(rng.choice(words, 3 * k)))
    for _ in range(60):
        texts[len(texts)] = " ".join(rng.choice(words, int(rng.integers(1, 300))))
    for i in range(20):
        texts[len(texts)] = texts[i]
    texts |= {1000: "one two", 1001: "one  two", 1002: "", 1003: None, 1004: "", 1005: "the same line again and over " * 30,
              1006: "the same line again and over " * 31, 1007: "word " * 50_000, 1008: "word " * 50_001}
    return texts


def test_matches_brute_force(spark):
    texts = near_copies(np.random.default_rng(1))
    rows = [(i, t, "x") for i, t in texts.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    assert got == brute_components(texts)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (None, "q r s"), (3, None), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (None, 1, False), (None, None, True), (3, 3, True), (4, 4, True)], key=str)
    assert minhash.near_duplicates(df.limit(0)).count() == 0
