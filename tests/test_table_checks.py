"""Checks that share one scan and one grouping per table."""

from pyspark.sql import functions as F

from nearcast.operators import quality as Q


def report(parts):
    return {r["name"]: (r["violations"], r["passed"]) for r in Q.run_checks(parts).collect()}


def checks(df, n="n"):
    return Q.table_checks(df, ["k"], rows={"null_v": F.col("v").isNull(), "big_v": F.col("v") > 10},
                          measures=[F.count_if(F.col("v") > 0).alias("positive")],
                          groups={"unique_k": F.col("n_rows") > 1, "share": F.col("positive") < 0.5 * F.col("n_rows")},
                          totals={"null_share": F.sum("rows null_v") > 0.2 * F.sum("n_rows")},
                          parity={"same_count": F.sum("n_rows")})


def test_one_pass_equals_single_checks(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 11), (3, -1), (None, 12), (None, None)], "k int, v int")
    other = spark.createDataFrame([(i,) for i in range(5)], "k int")
    got = report([checks(df), Q.table_checks(other, ["k"], parity={"same_count": -F.sum("n_rows")}),
                  Q.violations("plain", Q.not_null(df, "k"))])
    assert got == {"null_v": (2, False), "big_v": (2, False), "unique_k": (2, False), "share": (1, False),
                   "null_share": (1, False), "same_count": (1, False), "plain": (2, False)}
    assert got["unique_k"][0] == Q.unique(df, ["k"]).count()


def test_empty_tables_pass(spark):
    empty = spark.createDataFrame([], "k int, v int")
    got = report([checks(empty), Q.table_checks(empty, ["k"], parity={"same_count": -F.sum("n_rows")})])
    assert len(got) == 6 and set(got.values()) == {(0, True)}


def test_one_scan_per_table(spark, tmp_dir):
    spark.range(50).selectExpr("cast(id % 7 as int) k", "cast(id as int) v").write.parquet(f"{tmp_dir}/t")
    plan = Q.run_checks([checks(spark.read.parquet(f"{tmp_dir}/t"))])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1
