"""Windowed builds read their months only; whole tables are published by renames; emptied partitions go."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from nearcast.operators.incremental import merge_into_path, publish_table, recover_table, window_months
from nearcast.plans import flights as FL
from test_flights_flow import _raw

WINDOW = FL.Params(start_date="2025-01-01", end_date="2025-02-01")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_months():
    assert window_months("2025-01-01", "2025-02-01") == ("2025-01", "2025-01")
    assert window_months("2025-01-01", "2025-02-01", 2.0) == ("2024-12", "2025-02")
    assert window_months("2024-12-15", "2025-03-02", 30.0) == ("2024-12", "2025-03")


def test_windowed_scans_are_pruned(spark, tmp_dir):
    raw_f, raw_w, *_ = _raw(spark)
    for name, raw in (("f", raw_f), ("w", raw_w)):
        raw.withColumn("year_month", F.when(F.col("source_file") != "d", F.col("year_month"))).write.partitionBy(
            "year_month").parquet(f"{tmp_dir}/{name}")
    for stage, name, rows in ((FL.stg_flights, "f", 5), (FL.stg_weather, "w", 3)):
        raw = spark.read.parquet(f"{tmp_dir}/{name}")
        got = stage(raw, WINDOW)
        assert "PartitionFilters: [(isnull(year_month" in plan(got)
        assert sorted(map(str, got.collect())) == sorted(map(str, stage(raw, replace(WINDOW, prune_months=False)).collect()))
        assert got.count() == rows
    # a month label alone, padded on the weather side
    month = FL.stg_weather(spark.read.parquet(f"{tmp_dir}/w"), FL.Params(year_month="2025-11"))
    assert "year_month" in plan(month).split("PartitionFilters")[1].split("]")[0] and month.count() == 1


def test_failed_publication_keeps_the_old_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    publish_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string"), path, ["p"])
    broken = spark.createDataFrame([(1, "x"), (2, "y")], "k int, p string").withColumn(
        "k", F.when(F.col("k") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("k")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        publish_table(broken, path, ["p"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b")]
    assert os.listdir(tmp_dir) == ["t"]
    # the new table may be made from the old one
    publish_table(spark.read.parquet(path).where("k = 2"), path, ["p"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(2, "b")]
    # cut off between the renames
    os.rename(path, path + ".old")
    recover_table(spark, path)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(2, "b")]


def test_merge_drops_emptied_partitions_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    rows = [(1, "old", "a b/c"), (2, "stays", "z")]
    spark.createDataFrame(rows, "k int, v string, part string").write.partitionBy("part").parquet(path)
    untouched = sorted(os.listdir(os.path.join(path, "part=z")))
    merge_into_path(spark, path, spark.createDataFrame([(1, "new", "q")], "k int, v string, part string"), ["k"], ["part"])
    spark.catalog.refreshByPath(path)
    assert sorted(map(tuple, spark.read.parquet(path).select("k", "v", "part").collect())) == [(1, "new", "q"), (2, "stays", "z")]
    assert sorted(os.listdir(os.path.join(path, "part=z"))) == untouched
