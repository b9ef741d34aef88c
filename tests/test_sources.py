"""Landing scans, lineage, idempotent reloads, backfill, audit log, inventory, streaming ingest."""

import hashlib
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from nearcast.sources import csvtext as CT
from nearcast.sources import reload as RL
from nearcast.sources.zipcsv import read_zipped_csv
from nearcast.streaming.drop_ingest import start_drop_ingest

WEATHER = (b"# comment line\n\nstation, valid ,tmpf,,tmpf\n"
           b"ATL,2025-01-01 00:00, 40 ,x,41\n#c2\nATL,2025-01-01 01:00\n"
           b"ATL,2025-01-01 02:00,42,y,43,EXTRA\n\xff\xfeBAD,2025-01-01 03:00,44,z,45\n")


def _write(path, data: bytes):
    with open(path, "wb") as f:
        f.write(data)


def test_sanitize_headers():
    assert CT.sanitize_headers([" a ", "", "b", "a", None, "a"]) == ["a", None, "b", "a_1", None, "a_2"]


def test_text_csv_rules(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "weather_ATL_2025_01.csv"), WEATHER)
    _write(os.path.join(tmp_dir, "weather_ORD_2025_02.csv"), b"station,valid,tmpf,,tmpf\nORD,2025-02-01 00:00,30,q,31\n")
    df = CT.read_text_csv(spark, os.path.join(tmp_dir, "*.csv"), required=["station", "valid"])
    assert df.columns == ["station", "valid", "tmpf", "tmpf_1", "__file"]
    rows = sorted(tuple(r)[:4] for r in df.collect())
    assert ("ATL", "2025-01-01 00:00", "40", "41") in rows
    assert ("ATL", "2025-01-01 01:00", "", "") in rows            # short row padded
    assert ("ATL", "2025-01-01 02:00", "42", "43") in rows         # extra cell dropped
    assert any(r[0].endswith("BAD") and "�" in r[0] for r in rows)   # bad bytes replaced
    assert len(rows) == 5
    lin = CT.stamp_lineage(df, "run-1")
    yms = {r["year_month"] for r in lin.select("year_month").distinct().collect()}
    assert yms == {"2025-01", "2025-02"}
    with pytest.raises(ValueError):
        CT.read_text_csv(spark, os.path.join(tmp_dir, "*.csv"), required=["missing_col"])


def test_zipped_csv_and_allow_list(spark, tmp_dir):
    for ym, rows in (("2025_01", [("AA", "1", " atl "), ("DL", "2", "XYZ")]),
                     ("2025_02", [("UA", "3", "ORD"), ("WN", "4")])):
        zp = os.path.join(tmp_dir, f"flights_{ym}.zip")
        body = "Reporting_Airline,Flight_Number,Origin,\n" + "\n".join(",".join(r) for r in rows) + "\n"
        with zipfile.ZipFile(zp, "w") as zf:
            zf.writestr("readme.txt", "x")
            zf.writestr(f"On_Time_{ym}.csv", body)
    df = read_zipped_csv(spark, os.path.join(tmp_dir, "*.zip"))
    assert df.columns == ["Reporting_Airline", "Flight_Number", "Origin", "__file"]
    got = sorted(tuple(r)[:3] for r in df.collect())
    assert got == [("AA", "1", "atl"), ("DL", "2", "XYZ"), ("UA", "3", "ORD"), ("WN", "4", "")]
    allowed = spark.createDataFrame([("ATL",), ("ORD",)], "airport_code string")
    kept = sorted(r["Origin"] for r in CT.allow_list(df, "Origin", allowed, "airport_code").collect())
    assert kept == ["ORD", "atl"]                                   # stored value not uppercased


def _content_hash(spark, path):
    rows = sorted(str(tuple(r)) for r in spark.read.parquet(path).drop("loaded_at", "run_id").collect())
    return hashlib.md5("\n".join(rows).encode()).hexdigest()


def test_reload_is_idempotent_and_partition_scoped(spark, tmp_dir):
    target = os.path.join(tmp_dir, "raw")
    b1 = spark.createDataFrame([("2025-01", "a"), ("2025-01", "b"), ("2025-02", "c")], "year_month string, v string")
    r1 = {r["year_month"]: (r["rows_deleted"], r["rows_loaded"]) for r in RL.reload_partitions(spark, b1, target, ["year_month"]).collect()}
    assert r1 == {"2025-01": (0, 2), "2025-02": (0, 1)}
    h1 = _content_hash(spark, target)
    r2 = {r["year_month"]: (r["rows_deleted"], r["rows_loaded"]) for r in RL.reload_partitions(spark, b1, target, ["year_month"]).collect()}
    assert r2 == {"2025-01": (2, 2), "2025-02": (1, 1)}
    assert _content_hash(spark, target) == h1                       # re-run: same table
    b2 = spark.createDataFrame([("2025-01", "z")], "year_month string, v string")
    RL.reload_partitions(spark, b2, target, ["year_month"])
    got = sorted((r["year_month"], r["v"]) for r in spark.read.parquet(target).collect())
    assert got == [("2025-01", "z"), ("2025-02", "c")]              # only the touched month replaced


def test_backfill_failure_isolation_and_audit(spark, tmp_dir):
    target, log = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "audit")
    manifest = RL.month_manifest(spark, ["2025-01", "2025-02", "2025-03"])
    loaded = spark.createDataFrame([("2025-01", "a"), ("2025-03", "b")], "year_month string, v string")
    out = RL.backfill(spark, manifest, loaded, ["year_month"], target, ["year_month"], run_id="r1")
    st = {r["year_month"]: r["status"] for r in out.collect()}
    assert st == {"2025-01": "success", "2025-02": "failed", "2025-03": "success"}
    assert RL.backfill_summary(out)["exit_code"] == 1
    RL.audit_event(spark, log, "r1", "2025-02", "running")
    RL.audit_events(spark, log, out)
    state = {r["unit"]: r["status"] for r in RL.run_state(spark, log).collect()}
    assert state["2025-02"] == "failed" and state["2025-01"] == "success"
    assert RL.issues(spark, log).count() == 1


def test_inventory_and_set_difference(spark, tmp_dir):
    for n in ("weather_ATL_2025_01.csv", "weather_ATL_2025_02.csv", "weather_ORD_2025_01.csv", "notes.txt"):
        _write(os.path.join(tmp_dir, n), b"station,valid\n")
    inv = RL.file_inventory(spark, tmp_dir)
    assert inv.count() == 3
    loaded = spark.createDataFrame([("atl", "2025-01")], "station string, year_month string")
    missing = sorted(r["file_name"] for r in RL.files_not_loaded(inv, loaded).collect())
    assert missing == ["weather_ATL_2025_02.csv", "weather_ORD_2025_01.csv"]


def test_streaming_drop_ingest(spark, tmp_dir):
    landing, target, log = (os.path.join(tmp_dir, d) for d in ("landing", "raw", "audit"))
    os.makedirs(landing)
    _write(os.path.join(landing, "weather_ATL_2025_01.csv"), WEATHER)
    ckpt = os.path.join(tmp_dir, "ckpt")
    q = start_drop_ingest(spark, landing, target, log, ["station", "year_month"],
                          station_pattern=r"weather_([A-Za-z0-9]+)_", checkpoint=ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(target).count() == 4
    _write(os.path.join(landing, "weather_ORD_2025_01.csv"), b"station,valid,tmpf,,tmpf\nORD,2025-01-01 00:00,30,q,31\n")
    q = start_drop_ingest(spark, landing, target, log, ["station", "year_month"],
                          station_pattern=r"weather_([A-Za-z0-9]+)_", checkpoint=ckpt)
    q.awaitTermination(120)
    t = spark.read.parquet(target)
    assert t.count() == 5                                           # new file only, no double load
    assert {r["station"] for r in t.select("station").distinct().collect()} == {"ATL", "ORD"}


def test_idempotency_check(spark, tmp_dir):
    target = os.path.join(tmp_dir, "raw")
    b = spark.createDataFrame([("2025-01", "a", "run-x"), ("2025-02", "b", "run-x")], "year_month string, v string, run_id string")
    res = RL.idempotency_check(spark, lambda: RL.reload_partitions(spark, b, target, ["year_month"]), target)
    assert res["passed"] and res["first"][0] == 2


def test_merge_into_path_and_sinks(spark, tmp_dir):
    from nearcast.operators.incremental import merge_into_path
    from nearcast.sources.tables import read_mart
    path = os.path.join(tmp_dir, "tbl")
    t = spark.createDataFrame([(1, "a", "2025-01"), (2, "b", "2025-01"), (3, "c", "2025-02")],
                              "k int, v string, year_month string")
    merge_into_path(spark, path, t, ["k"], ["year_month"])
    b = spark.createDataFrame([(2, "B", "2025-01"), (4, "D", "2025-01")], "k int, v string, year_month string")
    res = merge_into_path(spark, path, b, ["k"], ["year_month"])
    assert res == {"rows_deleted": 2, "rows_loaded": 3}
    got = sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]
    out = RL.training_extract(spark, spark.read.parquet(path), ["k", "v", "year_month"], F.col("k") > 1,
                              "2025-02", os.path.join(tmp_dir, "extract"))
    assert spark.read.parquet(out["train"]).count() == 2 and spark.read.parquet(out["test"]).count() == 1
    paths = RL.export_marts({"m1": t}, os.path.join(tmp_dir, "marts"))
    assert read_mart(spark, paths[0]).count() == 3
    assert read_mart(spark, os.path.join(tmp_dir, "missing"), lambda: t).count() == 3
    RL.write_metrics(t, os.path.join(tmp_dir, "metrics_json"))
    RL.write_metrics(t, os.path.join(tmp_dir, "metrics_csv"), fmt="csv")
    assert spark.read.json(os.path.join(tmp_dir, "metrics_json")).count() == 3
