import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from nearcast.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(zip(w, w[1:], w[2:]))
    inside = set()
    for i in range(len(w) - 2):
        if seen[tuple(w[i:i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)


def test_counts_match_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = [None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "\n\nä ö\n ä ö\nä ö\n", "x\x0by\x0cz\rq", "   x ",
             "😀 " * 200, "a " * 5000, "|<># a\n|<># a"]
    texts += [" ".join(rng.choice(list("abcde\n\t"), rng.integers(1, 300))) for _ in range(200)]
    texts += [" ".join(rng.choice(["w%d" % i for i in range(400)], 20_000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit(None).cast("string"), "key": F.lit(1), "n": F.lit(2)})
    got = {r.doc_id: tuple(r)[1:] for r in quality.base_statistics(df).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def reference_mcd(x, steps=quality.STEPS):
    """The same estimate with numpy, exact quantiles, for one group."""
    floor = np.array(quality.FLOORS)
    med = np.sort(x, axis=0)[(len(x) + 1) // 2 - 1]
    mad = 1.4826 * np.sort(abs(x - med), axis=0)[(len(x) + 1) // 2 - 1]
    s = np.maximum(mad, floor)
    z = np.tanh((x - med) / s)
    best = None
    for cov in (np.diag(mad ** 2), np.cov(z.T, bias=True) * np.outer(s, s)):
        m = med
        for _ in range(steps):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov + np.diag(floor ** 2)), x - m)
            h = d <= np.sort(d)[int(np.ceil(quality.KEEP_SHARE * len(d))) - 1]
            m, cov = x[h].mean(0), np.cov(x[h].T, bias=True) * quality.CONSISTENCY
        det = np.linalg.slogdet(cov + np.diag(floor ** 2))[1]
        if best is None or det < best[0] - 1e-9:
            best = det, m, cov
    _, m, cov = best
    d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov + np.diag(floor ** 2)), x - m)
    h = d <= quality.REWEIGHT_CUT
    return x[h].mean(0), np.cov(x[h].T, bias=True)


def test_mcd_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal([1.6, .2, .1, .2], [.1, .3, .1, .1], (301, 4)) @ (np.eye(4) + .2)
    x[:80] += [0, 4, 0, 1]
    df = spark.createDataFrame([("k", *map(float, r)) for r in x], "key string, x0 double, x1 double, x2 double, x3 double")
    r = quality.mcd(df).collect()[0]
    m, cov = reference_mcd(x)
    assert np.allclose([r[f"m{i}"] for i in range(4)], m, atol=1e-6)
    assert np.allclose([r["c%d%d" % p] for p in quality.PAIRS], [cov[p] for p in quality.PAIRS], atol=1e-6)


def test_rejects_junk_and_keeps_clean(spark):
    rng = np.random.default_rng(2)
    words = ["w" + "abcdefgh"[i % 8] * (1 + i % 5) + str(i) for i in range(900)]
    rows = []
    for i in range(400):
        w = list(rng.choice(words, rng.integers(60, 300)))
        junk = i % 5 == 0
        rows.append((i, " ".join(x + ("###" if junk else "") for x in w), "en" if i % 3 else None, f"s{i // 5 % 2}"))
    rows += [(1000, None, "en", "s0"), (1001, "one two", "en", "s0"), (1002, "a b c d " * 50, "zz", None)]
    got = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string"), min_group=40).collect()}
    assert len(got) == 403
    assert all(got[i].kept == bool(i % 5) for i in range(400))
    assert not any(got[i].kept or not got[i].base_failed for i in (1000, 1001, 1002))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality.quality_rules(df).count() == 0


def test_windows_with_equal_hashes(spark):
    # the lowest 40 bits of the hashes of (w12622 x y) and (w2005369 x y) are equal
    texts = ["w12622 x y a b w2005369 x y", "w12622 x y w2005369 x y w12622 x y", "w1245330 x y q w1669206 x y q w1245330 x y q"]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.n_repeat_words for r in quality.base_statistics(df).collect()}
    assert got == {i: brute(t)[-1] for i, t in enumerate(texts)} and got[0] == 0


def test_small_groups_use_estimates_of_all_rows(spark):
    rng = np.random.default_rng(3)
    words = ["w" + "abcdefgh"[i % 8] * (1 + i % 5) + str(i) for i in range(900)]
    clean = lambda end="": " ".join(x + end for x in rng.choice(words, 150))
    rows = [(i, clean(), ("en", "de", None)[i % 3], "large") for i in range(300)]
    rows += [(1000, clean("###"), "en", "small"), (1001, clean(), "en", "small"), (1002, clean("###"), "fr", "large"),
             (1003, clean(), "fr", None), (1004, clean("###"), None, None), (1005, clean("###"), "de", None)]
    got = {r.doc_id: r.kept for r in quality.quality_rules(spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string"), min_group=40).collect()}
    assert all(got[i] for i in [*range(300), 1001, 1003])
    assert not any(got[i] for i in (1000, 1002, 1004, 1005))
