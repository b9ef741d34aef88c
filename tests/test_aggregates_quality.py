"""Aggregates, roll-ups, dedupe, merge and quality checks on small inline frames."""

from datetime import datetime

from pyspark.sql import functions as F

from nearcast.operators import aggregates as A
from nearcast.operators import quality as Q
from nearcast.operators import reports as R
from nearcast.operators.dedupe import keep_latest
from nearcast.operators.incremental import keyed_merge, replace_partitions


def test_delay_measures_null_flag_not_counted(spark):
    df = spark.createDataFrame([("A", True, 10.0), ("A", None, None), ("A", False, 4.0), ("B", True, 20.0)],
                               "k string, f boolean, d double")
    got = {r["k"]: r for r in A.delay_aggregate(df, ["k"], F.col("f"), "d").collect()}
    assert got["A"][A.N] == 3 and got["A"][A.D] == 1
    assert got["A"][A.RATE] == 0.3333 and got["A"][A.AVG] == 7.0


def test_weighted_rollup_reproduces_rounded_mean(spark):
    agg = spark.createDataFrame([("A", 0, 2, 1, 0.5, 1.25), ("A", 1, 1, 0, 0.0, 3.0)],
                                "k string, h int, flight_count long, delayed_count long, "
                                "delay_rate_15 double, avg_dep_delay_minutes double")
    r = A.weighted_rollup(agg, ["k"]).first()
    assert r[A.N] == 3 and r[A.D] == 1 and r[A.RATE] == 0.3333
    assert r[A.AVG] == round((1.25 * 2 + 3.0 * 1) / 3, 2)


def test_pooled_labels(spark):
    agg = spark.createDataFrame([("x", "p", 2, 1, 0.5, 1.0), ("y", "p", 2, 2, 1.0, 3.0)],
                                "w string, p string, flight_count long, delayed_count long, "
                                "delay_rate_15 double, avg_dep_delay_minutes double")
    got = {(r["report"], r["bucket_value"]): r[A.N] for r in
           A.pooled_by_dimension(agg, ["w", "p"], ["by_w", "by_p"]).collect()}
    assert got == {("by_w", "x"): 2, ("by_w", "y"): 2, ("by_p", "p"): 4}


def test_null_order_like_reference(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", None), ("c", 1.0)], "k string, v double")
    got = [r["k"] for r in R.top_n(df, [R.desc_pg("v"), R.asc_pg("k")], 3).orderBy("rank").collect()]
    assert got == ["b", "a", "c"]


def test_keep_latest(spark):
    df = spark.createDataFrame([
        ("S", datetime(2025, 1, 1, 0, 0), datetime(2025, 2, 1), "f1", 1.0),
        ("S", datetime(2025, 1, 1, 0, 0), datetime(2025, 3, 1), "f0", 2.0),
        ("S", datetime(2025, 1, 1, 1, 0), datetime(2025, 2, 1), "f1", 3.0)],
        "station string, valid timestamp, loaded_at timestamp, source_file string, v double")
    got = {r["valid"]: r["v"] for r in keep_latest(df, ["station", "valid"], ["loaded_at", "source_file"]).collect()}
    assert got == {datetime(2025, 1, 1, 0, 0): 2.0, datetime(2025, 1, 1, 1, 0): 3.0}


def test_keyed_merge_semantics(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    batch = spark.createDataFrame([(1, "A", 10), (2, "B", 20), (4, "D", 40), (4, "D2", 41)],
                                  "k int, v string, extra int")
    got = sorted((r["k"], r["v"], r["extra"]) for r in keyed_merge(target, batch, ["k"]).collect())
    assert got == [(1, "A", 10), (2, "B", 20), (3, "c", None), (4, "D", 40), (4, "D2", 41)]


def test_replace_partitions(spark):
    target = spark.createDataFrame([("2025-01", 1), ("2025-01", 2), ("2025-02", 3)], "ym string, x int")
    batch = spark.createDataFrame([("2025-01", 9)], "ym string, x int")
    got = sorted(tuple(r) for r in replace_partitions(target, batch, ["ym"]).collect())
    assert got == [("2025-01", 9), ("2025-02", 3)]


def test_quality_checks_return_violations(spark):
    df = spark.createDataFrame([(1, "O", 10, 3), (1, "X", 5, 6), (2, None, 0, 0)],
                               "k int, s string, flight_count long, delayed_count long") \
        .withColumn("delay_rate_15", F.col("delayed_count") / F.greatest(F.col("flight_count"), F.lit(1)))
    assert Q.unique(df, ["k"]).count() == 1
    assert Q.accepted_values(df, "s", ["O", "F"]).count() == 1          # null passes
    assert Q.rates_valid(df).count() == 2
    assert Q.not_null(df, "s").count() == 1
    nn = {r["column_name"]: r["nulls"] for r in Q.not_null_counts(df, ["k", "s"]).collect()}
    assert nn == {"k": 0, "s": 1}
    rep = {r["name"]: (r["violations"], r["passed"]) for r in Q.run_suite({
        "uniq": lambda: Q.unique(df, ["k"]), "ok": lambda: Q.not_null(df, "k")}).collect()}
    assert rep == {"uniq": (1, False), "ok": (0, True)}
    ext = spark.createDataFrame([(100, 12, 500)], "row_count long, months long, unit_months long")
    gate = {r["stage"]: r["decision"] for r in Q.readiness(ext, [("s1", 12, 528), ("s2", 12, 400)]).collect()}
    assert gate == {"s1": "NO_GO", "s2": "GO"}


def test_dims_scalar_and_scope_helpers(spark):
    from nearcast.operators import dims as DM
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(1,)], "x int")
    assert DM.scalar_compare(a, b).count() == 1                       # unequal -> one row
    assert DM.scalar_compare(a, a).count() == 0
    withs = DM.with_scalars(a, b.agg(F.count(F.lit(1)).alias("n_b"))).collect()
    assert {r["n_b"] for r in withs} == {1}
    f = spark.createDataFrame([("ATL", "2025-01", 1), ("ATL", "2025-02", 2), ("ORD", "2025-01", 3)],
                              "airport_code string, year_month string, v int")
    scope = DM.scope_table(spark, [("ATL", "2025-01"), ("ORD", "2025-01")], ["airport_code", "year_month"])
    assert sorted(r["v"] for r in DM.scope_join(f, scope, ["airport_code", "year_month"]).collect()) == [1, 3]


def test_inventory_counts_and_running(spark):
    from nearcast.sources import reload as RL
    inv = spark.createDataFrame([("ATL", "2025", "01"), ("ATL", "2025", "02"), ("ORD", "2024", "12")],
                                "station string, year string, month string")
    c = {(r["station"], r["year"]): r["files"] for r in RL.inventory_counts(inv).collect()}
    assert c[("ATL", None)] == 2 and c[(None, "2025")] == 2 and c[(None, None)] == 3
    rc = RL.running_counts(spark.createDataFrame([("2025-01", 4), ("2025-02", 1)], "year_month string, rows long"))
    assert [r["running_rows"] for r in rc.orderBy("year_month").collect()] == [4, 5]
