from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from nearcast.llm import substrings


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + 200] for d in data for i in range(len(d) - 199))
    out = []
    for d in data:
        mark = np.zeros(len(d), bool)
        for i in range(len(d) - 199):
            if seen[d[i:i + 200]] > 1:
                mark[i:i + 200] = True
        kept = bytes(b for b, m in zip(d, mark) if not m)
        edges = int(mark[:1].sum()) + int((mark[1:] & ~mark[:-1]).sum()) if len(mark) else 0
        out.append((len(d), int(mark.sum()), edges, sha256(kept).hexdigest()))
    return out


def texts(rng, n=60):
    def word():
        return "".join(rng.choice(list("abcdeéß"), rng.integers(1, 9)))
    passages = [" ".join(word() for _ in range(int(rng.integers(20, 120)))) for _ in range(8)]
    out = [None, "", "short", "x" * 1000, "ab" * 400, "abc" * 70, "y" * 199, "y" * 200, "z" * 201]
    for _ in range(n):
        t = " ".join(word() for _ in range(int(rng.integers(0, 200))))
        for _ in range(int(rng.integers(0, 4))):
            p = str(rng.choice(passages))
            a = int(rng.integers(0, 40))
            t += p[a:len(p) - int(rng.integers(0, 40))] + word()
        out.append(t)
    return out + out[20:30]


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for data in (b"banana" * 50, b"a" * 500, bytes(rng.integers(0, 3, 3000, dtype=np.uint8)), b"", b"x", bytes(rng.integers(0, 255, 700, dtype=np.uint8)) * 3):
        a = np.frombuffer(data, np.uint8)
        order = substrings.suffix_array(a)
        want = sorted(range(len(data)), key=lambda i: (data[i:i + 256], 0))
        assert [data[i:i + 256] for i in order] == [data[i:i + 256] for i in want]
        assert sorted(order.tolist()) == list(range(len(data)))
        got = substrings.common_prefixes(a, order, lanes=7)

        def common(x, y):
            k = 0
            while k < min(len(x), len(y)) and x[k] == y[k]:
                k += 1
            return k
        assert got.tolist() == [0] * min(1, len(data)) + [
            common(data[p:p + 256], data[q:q + 256]) for p, q in zip(order[:-1], order[1:])]


def test_runs_partition_windows():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 4, 5000, dtype=np.uint8)
    begins, ends = np.array([0, 100, 700, 700]), np.array([100, 700, 700, 5000])
    text, _, start, n, _ = substrings.runs_of(raw, begins, ends)
    seen = sorted((t, s + k) for t, s, m in zip(text, start, n) for k in range(m))
    assert seen == [(t, s) for t in range(4) for s in range(max(0, ends[t] - begins[t] - 199))]
    assert n.max() <= substrings.REACH


def test_long_texts_are_cut_without_losing_windows(monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK", 1000)
    raw = np.random.default_rng(2).integers(0, 4, 6000, dtype=np.uint8)
    sizes, offsets = np.array([50, 300, 3450, 0, 1001, 1199]), np.array([0, 50, 350, 3800, 3800, 4801])
    seen = []
    for at, end, number, begin, stop, shift in substrings.chunks(sizes, offsets):
        assert end - at <= 1000
        text, _, start, n, _ = substrings.runs_of(raw[at:end], begin, stop)
        seen += [(number[t], s + shift[t] + k) for t, s, m in zip(text, start, n) for k in range(m)]
    assert sorted(seen) == [(t, s) for t in range(6) for s in range(max(0, sizes[t] - 199))]


@pytest.mark.parametrize("shard_runs", [4000, 3])
def test_matches_brute_force(spark, monkeypatch, shard_runs):
    monkeypatch.setattr(substrings, "SHARD_RUNS", shard_runs)
    given = texts(np.random.default_rng(shard_runs))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(given)], "doc_id long, text string, th string, n int")
    got = {r.doc_id: tuple(r)[1:] for r in substrings.removed(df).collect()}
    assert got == dict(enumerate(brute(given)))
    clean = {r.doc_id: r for r in substrings.cleaned(df).collect()}
    assert len(clean) == len(given) and clean[0].text is None and clean[0].th == "x"
    assert all(len((clean[i].text or "").encode()) <= got[i][0] - got[i][1] for i in got)


def test_repeated_rows_null_ids_and_empty_table(spark):
    long = " ".join(f"word{i}" for i in range(100))
    rows = [(1, long), (1, long), (None, long + "!"), (None, "other " + long), (2, "q" * 150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in substrings.removed(df).collect()), key=str)
    assert got == sorted([(i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows]))], key=str)
    assert substrings.removed(df.limit(0)).count() == 0
