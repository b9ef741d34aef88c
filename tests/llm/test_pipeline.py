import numpy as np

import corpus_pipeline
from nearcast.llm import minhash, quality

from .test_minhash import brute_components
from .test_substrings import brute

SF = "/root/testdata/sf0.01"


def test_stages_in_order(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_dedup", "substring_dedup", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], SF).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
        if name != "packing":
            assert tables[-1].columns == columns and tables[-1].dtypes == docs.dtypes
    rows = [t.collect() for t in tables[:-1]]
    assert len(rows[0]) > len(rows[1]) or len(rows[0]) == len(rows[1])
    assert len(rows[1]) > len(rows[2]) > len(rows[3]) == len(rows[4]) > 0
    # near dedup: the smallest id of every brute-force component of its input
    parts = brute_components({r.doc_id: r.text for r in rows[2]})
    assert {r.doc_id for r in rows[3]} == set(parts.values())
    # substring dedup against counting every window of its input
    given = sorted(rows[3], key=lambda r: r.doc_id)
    want = {r.doc_id: b for r, b in zip(given, brute([r.text for r in given]))}
    for r in rows[4]:
        n_bytes, n_removed, n_spans, _ = want[r.doc_id]
        assert 0 <= (n_bytes - n_removed) - len(r.text.encode()) <= 6 * n_spans and r.n_chars == len(r.text)
    packed = tables[-1].collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows[4]}
    # clean documents come through the filters
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before = {r.doc_id for r in rows[0] if labels.get(r.doc_id) == 1 and len(r.text.split()) >= 60}
    assert np.mean([i in {r.doc_id for r in rows[2]} for i in before]) > 0.97


def test_rows_with_gaps(spark):
    # mostly words of its own: more than half in repeated windows would fail the base rules
    text = " ".join(f"the cat number{i} saw dog{i} on wall{i} near tree{i} at house{i} by lake{i}" for i in range(30))
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, None, None, 1), (None, text + " more", "en", "s", 1),
            (3, None, "en", "s", None), (4, "", "en", "s", 0), (5, "1 2 3", "en", "s", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(str(r.doc_id) for r in minhash.representatives(df).collect()) == ["1", "3", "4", "5", "None"]  # a null id has no near copies
    assert sorted(str(r.doc_id) for r in quality.passing(df).collect()) == ["1", "1", "2", "None"]
    empty = df.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
