"""Cases that were wrong before: parsing, overwrites, merges, joins and checks."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from nearcast.functions import cleaning as C
from nearcast.functions import timeutil as TU
from nearcast.operators import asof, modelling as ML, quality as Q, reports as R, views as V
from nearcast.operators.incremental import merge_into_path, write_partitions
from nearcast.sources import csvtext as CT, reload as RL
from nearcast.sources.zipcsv import read_zipped_csv, zip_errors


def _write(path, data):
    with open(path, "wb") as f:
        f.write(data)


def test_quoted_cells_blank_rows_and_own_headers(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "a.csv"), b'# c\nstation,note,valid\nATL,"he said ""x"", y",2025\nORD,"two\nlines",2024\n,,\n"a\\b",c,1\n')
    _write(os.path.join(tmp_dir, "b.csv"), b"valid,station\n30,MIA\n31,\xffB\n")
    df = CT.read_text_csv(spark, os.path.join(tmp_dir, "*.csv"), required=["station", "valid"])
    got = {(r.station, r.note, r.valid, r["__file"]) for r in df.collect()}
    assert got == {("ATL", 'he said "x", y', "2025", "a.csv"), ("ORD", "two\nlines", "2024", "a.csv"), ("a\\b", "c", "1", "a.csv"),
                   ("MIA", "", "30", "b.csv"), ("�B", "", "31", "b.csv")}
    with pytest.raises(ValueError, match="b.csv"):
        CT.read_text_csv(spark, os.path.join(tmp_dir, "*.csv"), required=["note"])


def test_archives_by_name_and_one_broken(spark, tmp_dir):
    for name, data in (("a.zip", "x,y,\n1,2,3\n4\n,\n"), ("b.zip", "y,x\n5,6\n")):
        with zipfile.ZipFile(os.path.join(tmp_dir, name), "w") as z:
            z.writestr("readme.txt", "no")
            z.writestr("t.CSV", data)
    _write(os.path.join(tmp_dir, "c.zip"), b"not a zip")
    got = {(r.x, r.y, r["__file"]) for r in read_zipped_csv(spark, os.path.join(tmp_dir, "*.zip")).collect()}
    assert got == {("1", "2", "a.zip"), ("4", "", "a.zip"), ("6", "5", "b.zip")}
    errors = zip_errors(spark, os.path.join(tmp_dir, "*.zip")).collect()
    assert len(errors) == 1 and errors[0].path.endswith("c.zip") and "BadZipFile" in errors[0].error


def test_small_numbers_and_overflow(spark):
    df = spark.createDataFrame([("0.00005",), ("0.10004",), ("123456789012345.6",), ("1" * 30,)], "v string")
    got = [r[0] for r in df.select(C.clean_numeric("v", strict=False)).collect()]
    assert [str(x) if x is None else float(x) for x in got] == [0.00005, 0.10004, 123456789012345.6, "None"]
    assert [r.v for r in C.numeric_violations(df, ["v"]).collect()] == ["1" * 30]


def test_merge_follows_a_key_to_another_partition(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    write_partitions(spark.createDataFrame([(1, "a", "p"), (2, "b", "p"), (3, "c", "q")], "k int, v string, part string"), path, ["part"])
    merge_into_path(spark, path, spark.createDataFrame([(1, "new", "q")], "k int, v string, part string"), ["k"], ["part"])
    assert {(r.k, r.v, r.part) for r in spark.read.parquet(path).collect()} == {(1, "new", "q"), (2, "b", "p"), (3, "c", "q")}
    merge_into_path(spark, path, spark.createDataFrame([(2, "moved", "q")], "k int, v string, part string"), ["k"], ["part"])
    spark.catalog.refreshByPath(path)
    assert {(r.k, r.v, r.part) for r in spark.read.parquet(path).collect()} == {(1, "new", "q"), (2, "moved", "q"), (3, "c", "q")}


def test_training_extract_does_not_leak_months(spark, tmp_dir):
    fact = spark.createDataFrame([(1, "2025-01"), (2, "2025-02"), (3, "2025-03")], "x int, year_month string")
    RL.training_extract(spark, fact, ["x", "year_month"], F.lit(True), "2025-03", tmp_dir)
    paths = RL.training_extract(spark, fact, ["x", "year_month"], F.lit(True), "2025-02", tmp_dir, force=True)
    read = {side: {r.x for r in spark.read.parquet(p).collect()} for side, p in paths.items()}
    assert read == {"train": {1}, "test": {2, 3}}


def test_backfill_isolates_failing_units(spark, tmp_dir):
    def load(unit):
        if unit["year_month"] == "2025-02":
            raise OSError("unreadable")
        n = 0 if unit["year_month"] == "2025-03" else 2
        return spark.range(n).select("id", F.lit(unit["year_month"]).alias("year_month"))
    units = [{"year_month": f"2025-0{m}"} for m in range(1, 5)]
    got = [(r.year_month, r.rows_loaded, r.status) for r in RL.backfill_each(spark, units, load, os.path.join(tmp_dir, "t"), ["year_month"]).collect()]
    assert got == [("2025-01", 2, "success"), ("2025-02", 0, "failed"), ("2025-03", 0, "failed"), ("2025-04", 2, "success")]
    stopped = RL.backfill_each(spark, units, load, os.path.join(tmp_dir, "u"), ["year_month"], stop_on_error=True).collect()
    assert [r.status for r in stopped] == ["success", "failed", "skipped", "skipped"]


def test_join_back_and_candidates_with_twins_and_null_times(spark):
    ev = spark.createDataFrame([(1, "a", "2025-01-01 10:00:00"), (2, "a", "2025-03-01 10:00:00"), (3, None, "2025-01-01 10:00:00")],
                               "id int, k string, t string").withColumn("t", F.col("t").cast("timestamp"))
    obs = spark.createDataFrame([("a", "2025-01-01 09:30:00", 9007199254740993, "x"), ("a", "2025-01-01 09:30:00", 9007199254740993, "y"),
                                 ("a", None, 5, "z"), ("a", "2025-01-01 10:30:00", 9007199254740992, "w")],
                                "k string, t string, oid long, v string").withColumn("t", F.col("t").cast("timestamp"))
    kw = dict(key="k", event_time="t", obs_time="t", window_hours=2, carry=["v", "oid"], obs_key="oid")
    got = {r.id: (r.match_status, r.obs_oid) for r in asof.nearest_asof(ev, obs, join_back=True, **kw).collect()}
    assert len(got) == 3 and got[1] == ("matched", 9007199254740993) and got[2][1] is None and got[3][1] is None
    text = obs.withColumn("loaded_at", F.lit("2025-01-01T00:00:00"))
    cand = asof.nearest_asof_candidates(ev, text, prefer=["loaded_at"], event_id="id", **kw).collect()
    assert {r.id: r.obs_oid for r in cand}[1] == 9007199254740993


def test_orders_of_reports(spark):
    df = spark.createDataFrame([("b", 2), ("a", None), ("z", 1)], "k string, n int")
    assert [r.k for r in df.orderBy(R.asc_nulls_first("n")).collect()] == ["a", "z", "b"]
    assert [r.k for r in df.orderBy(R.by_labels("k", ["z", "b"])).collect()] == ["z", "b", "a"]


def test_segments_and_importances(spark):
    s = spark.createDataFrame([("day", f"d{i}", i) for i in range(20)] + [("hour", "h", 99)], "segment_type string, segment string, n_rows int")
    assert [r.segment for r in V.top_segments(s, "day").sort("rank").collect()] == [f"d{i}" for i in range(19, 4, -1)]
    i = spark.createDataFrame([(f"f{i:02d}", float(i)) for i in range(15)], "feature string, importance_mean double")
    assert [r.feature for r in V.top_importances(i).sort("rank").collect()][0] == "f14" and V.top_importances(i).count() == 12


def test_scoped_share_and_readiness(spark):
    df = spark.createDataFrame([("A", "01", True)] * 9 + [("A", "01", False), ("B", "01", False), ("C", "01", True)], "s string, ym string, ok boolean")
    scope = spark.createDataFrame([("A", "01"), ("B", "01"), ("D", "01")], "s string, ym string")
    assert {r.s for r in Q.scoped_match_share(df, scope, ["s", "ym"], F.col("ok")).collect()} == {"B", "D"}
    a = spark.createDataFrame([("x", "2025-01"), ("x", "2025-02")], "u string, year_month string")
    got = {r.table_name: r for r in Q.full_readiness({"a": a, "b": a.limit(0)}, {"a": 2, "b": 1}, {"a": 2, "b": 1}, {"a": "u", "b": "u"}).collect()}
    assert (got["a"].decision, got["b"].decision, got["ALL"].decision) == ("GO", "NO_GO", "NO_GO")
    short = Q.full_readiness({"a": a, "b": a.where("year_month = '2025-01'")}, {"a": 1, "b": 1}, {"a": 1, "b": 1}, {"a": "u", "b": "u"})
    verdict = short.where("table_name = 'ALL'").first()
    assert verdict.decision == "GO" and "differ" in verdict.warning


def test_categories_come_from_training_rows(spark):
    train = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",)], "k string")
    frequent = ML.frequent_categories(train, ["k"], 3)
    assert frequent == {"k": ["a", "b"]}
    val = spark.createDataFrame([("c",), ("z",), (None,), ("a",)], "k string")
    assert [r.k for r in ML.with_categories(val, frequent).collect()] == [ML.OTHER, ML.OTHER, None, "a"]


def test_days_in_month():
    assert [TU.days_in_month(x) for x in ("2024-02", "2025-02", "2025-12")] == [29, 28, 31]
