import re
from fractions import Fraction
from hashlib import sha256
from zlib import crc32

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from nearcast.llm import runs

SCHEMA = "doc_id long, text string"


def brute(words):
    """Every lag over the whole text; of equal stretches the smallest lag."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def found(words):
    return runs.runs(runs.word_numbers([str(w).encode() for w in words]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9)), max_size=6))
def test_repeated_phrases_against_every_lag(parts):
    words = [w for phrase, times in parts for w in phrase * times]
    assert found(words) == brute(words)


def test_random_words_against_every_lag():
    rng = np.random.default_rng(0)
    for _ in range(400):
        words = rng.integers(0, rng.choice([1, 2, 3, 40]), rng.integers(0, 150)).tolist()
        if len(words) > 10 and rng.random() < 0.7:
            a, p = rng.integers(len(words)), 1 + rng.integers(len(words) // 4)
            words = words[:a] + [words[a + (i - a) % p] if a + (i - a) % p < len(words) else words[i] for i in range(a, len(words))]
        assert found(words) == brute(words)


def test_long_texts_stay_near_linear():
    assert found(["a"] * 30_000) == [(0, 30_000, 1)]
    assert found(list(range(7000)) * 4) == [(0, 28_000, 7000)]
    assert found([*range(7000)] * 3 + [*range(6999)]) == []
    words = [1, 2] * 9000 + [3] + [1, 2] * 9000
    assert found(words) == [(0, 18_000, 2), (18_001, 18_000, 2)]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = (crc32(str(doc_id).encode()) if doc_id is not None else 1), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    rows = brute(words)
    best = min(rows, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in rows)]
    return (doc_id, len(rows), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2],
            sha256("".join(f"{s},{n},{q}\n" for s, n, q in rows).encode()).hexdigest(), sha256(" ".join(kept).encode()).hexdigest())


def check(df):
    got = sorted(map(tuple, runs.digests(df).collect()), key=str)
    assert got == sorted((expected(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)
    return got


def test_driver_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = check(docs)
    assert len(got) == 1000 and sum(r[1] > 0 for r in got) > 30


def test_nulls_spaces_repeated_rows_and_clashing_columns(spark):
    echo = next(i for i in range(1000) if crc32(str(i).encode()) % 10 == 0)
    texts = [None, "", " \t\n", "a", "a " * 6, "\x0b a\x0ba\x0ca\ra a a a a", "é è " * 9, "x " * 1500, "to be or not to be " * 4 + "end",
             "one two three four five six seven eight nine ten"]
    rows = [(i, t) for t in texts for i in (1, 1, None, echo)]
    df = spark.createDataFrame(rows, SCHEMA)
    check(df)
    for name in ("runs", "collapsed", "start", "length", "period", "best", "words", "a", "p", "g", "lang"):
        df = df.withColumn(name, df.text)
    check(df)
    assert runs.digests(df.limit(0)).collect() == []


def test_collapsed_text_keeps_first_periods(spark):
    df = spark.createDataFrame([(1, "see the cat the cat the cat the cat run"), (2, "a b c")], SCHEMA)
    rows = {r.doc_id: r for r in runs.periodic(df).collect()}
    assert rows[1].collapsed == "see the cat run" and [tuple(x) for x in rows[1].runs] == [(1, 8, 2)]
    assert rows[2].collapsed == "a b c" and rows[2].runs == []
