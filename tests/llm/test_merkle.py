from hashlib import sha256
from zlib import crc32

import pytest

from nearcast.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, text, lang, source, n = row
    fields = (doc_id, source, lang, n if n is None else n + more, text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree, i):
    for level in tree[:-1]:
        yield (level[i ^ 1] if i ^ 1 < len(level) else None), i % 2 == 0
        i //= 2


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    by_lang = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: levels([leaf(r) for r in by_lang[x]]) for x in langs}
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for i, r in enumerate(by_lang[x]):
            steps = [*way(trees[x], i), *way(top, k)]
            now = leaf(r, int(r[0] is not None and crc32(str(r[0]).encode()) % 7 == 0))
            for other, right in steps:
                now = digest(now) if other is None else digest(now, other) if right else digest(other, now)
            out.append((r[0], leaf(r), trees[x][-1][0], top[-1][0], digest(*(s for s, _ in steps if s)), now, now == top[-1][0]))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, merkle.audited(df).collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [1, 1, 1], [2049, 1, 7, 64]])
def test_every_proof_against_brute_force(spark, sizes):
    rows = [(1000 * k + i, f"text {i} é", None if k == 1 else f"l{k}", "s" if i % 3 else None, None if i % 5 == 4 else i)
            for k, n in enumerate(sizes) for i in range(n)]
    got = result(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows)
    untouched = [r for r in rows if crc32(str(r[0]).encode()) % 7 or r[4] is None]
    assert sum(r[-1] for r in got) == len(untouched)


def test_nulls_ties_repeated_rows_and_clashing_columns(spark):
    rows = [(None, None, None, None, None), (None, "", "", "", 0), (7, "a", "en", "s", 1), (7, "a", "en", "s", 1), (7, "b", "en", "s", 1),
            (8, "x" * 300_000, "en", "s", 1), (9, "ü", "é", "s", -1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(df) == brute(rows)
    for name in ("leaf", "root", "tree", "level", "place", "siblings", "height", "uid", "verified"):
        df = df.withColumn(name, df.text)
    assert result(df) == brute(rows)
    assert result(df.limit(0)) == []


def test_manifest_detects_each_changed_field(spark):
    rows = [(i, "t", "en", "s", 1) for i in range(5)]
    (root,) = {r[3] for r in result(spark.createDataFrame(rows, SCHEMA))}
    for k, value in enumerate((99, "u", "de", "r", 2)):
        changed = [*rows[:2], tuple(value if j == k else v for j, v in enumerate(rows[2])), *rows[3:]]
        assert {r[3] for r in result(spark.createDataFrame(changed, SCHEMA))} != {root}


def test_segments_double(spark):
    """Every round keeps the levels it needs only, and a leaf's segment has one element per level."""
    rows = spark.range(600).selectExpr("id as doc_id", "'a' as g", "sha2(string(id), 256) as leaf")
    out = merkle.manifest(rows, "g", ["doc_id"]).collect()
    assert {len(r.siblings) for r in out} == {10}
    assert {tuple(s.right for s in r.siblings) for r in out} == {tuple(not i >> k & 1 for k in range(10)) for i in range(600)}
