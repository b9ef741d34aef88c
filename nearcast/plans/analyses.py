"""The reference's analyses as parameterised DataFrame builders.

Column names are parameters, so the same builder serves the flight/weather
flow (``plans.flights``) and the driver-table analogues (``plans.queries``).
Each builder is one plan: grouping sets instead of UNION ALL of separate
scans, top-n through ``orderBy.limit``, and report parts glued by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearcast.functions import buckets as B
from nearcast.operators import aggregates as A
from nearcast.operators import reports as R

MEASURES = [A.N, A.D, A.RATE, A.AVG]
COVER = ["flights", "matched_flights", "match_pct"]


def hotspot_report(agg: DataFrame, key: str, hour: str, min_hour_flights: int = 100,
                   min_key_flights: int = 500, n: int = 10) -> DataFrame:
    """Top key-hours by rate / by mean delay / by volume, and top keys by rate."""
    k = [R.asc_pg(key), R.asc_pg(hour)]
    parts = [
        R.top_n(agg, [R.desc_pg(A.RATE), R.desc_pg(A.N), *k], n,
                where=F.col(A.N) >= min_hour_flights, label="top_delay_rate"),
        R.top_n(agg, [R.desc_pg(A.AVG), R.desc_pg(A.N), *k], n,
                where=F.col(A.N) >= min_hour_flights, label="top_avg_delay_minutes"),
        R.top_n(agg, [R.desc_pg(A.N), *k], n, label="busiest_hour"),
    ]
    per_key = A.weighted_rollup(agg, [key]).withColumn(hour, F.lit(None).cast("int"))
    parts.append(R.top_n(per_key, [R.desc_pg(A.RATE), R.desc_pg(A.N), R.asc_pg(key)], n,
                         where=F.col(A.N) >= min_key_flights, label="top_airport_delay_rate"))
    cols = ["report", key, hour, *MEASURES, "rank"]
    return R.tagged_union([p.select(*cols) for p in parts]).withColumn("rank", F.col("rank").cast("long"))


def route_report(agg: DataFrame, keys: list[str], min_flights: int = 50, n: int = 10) -> DataFrame:
    """Top routes by volume and by rate."""
    k = [R.asc_pg(c) for c in keys]
    parts = [R.top_n(agg, [R.desc_pg(A.N), *k], n, label="top_volume"),
             R.top_n(agg, [R.desc_pg(A.RATE), R.desc_pg(A.N), *k], n,
                     where=F.col(A.N) >= min_flights, label="top_delay_rate")]
    cols = ["report", *keys, *MEASURES, "rank"]
    return R.tagged_union([p.select(*cols) for p in parts]).withColumn("rank", F.col("rank").cast("long"))


def weather_bucket_report(agg: DataFrame, origin: str = "origin", min_combo_flights: int = 50,
                          n: int = 10) -> DataFrame:
    """Pooled by wind / precipitation / visibility + worst combinations."""
    pooled = A.pooled_by_dimension(
        agg, ["wind_speed_bucket", "precip_bucket", "visibility_bucket"],
        ["pooled_wind", "pooled_precip", "pooled_visibility"]) \
        .withColumn("origin", F.lit(None).cast("string")).withColumn("rank", F.lit(None).cast("long"))
    combos = agg.select(
        F.concat_ws(" | ", "wind_speed_bucket", "precip_bucket", "visibility_bucket").alias("bucket_value"),
        F.col(origin).alias("origin"), *MEASURES)
    worst = R.top_n(combos, [R.desc_pg(A.RATE), R.desc_pg(A.N), R.asc_pg("origin"), R.asc_pg("bucket_value")],
                    n, where=F.col(A.N) >= min_combo_flights, label="worst_weather_combo") \
        .withColumn("rank", F.col("rank").cast("long"))
    cols = ["report", "bucket_value", "origin", *MEASURES, "rank"]
    return pooled.select(*cols).unionByName(worst.select(*cols))


def coverage_grains(fact: DataFrame, key: str, ym: str, date: str, hour: str, matched: Column) -> DataFrame:
    """Match coverage by key, key-date and key-hour in one pass."""
    return A.grain_coverage(fact, [key, ym], {"airport": [], "date": [date], "hour": [hour]}, matched)


def coverage_overall(fact: DataFrame, key: str, ym: str, matched: Column, low_pct: float = 90.0,
                     key_out: str = "airport_code") -> DataFrame:
    """Overall + per-key coverage; keys under ``low_pct`` repeated as low_match_airport."""
    g = A.grain_coverage(fact, [ym], {"overall": [], "airport": [key]}, matched)
    g = g.select("grain", F.when(F.col("grain") == "overall", F.lit("ALL"))
                 .otherwise(F.col(key).cast("string")).alias(key_out),
                 ym, *COVER)
    low = g.filter((F.col("grain") == "airport") & (F.col("match_pct") < low_pct)) \
        .withColumn("grain", F.lit("low_match_airport"))
    return g.unionByName(low)


def unmatched_report(fact: DataFrame, key: str, ym: str, date: str, matched: Column,
                     sample: int = 20) -> DataFrame:
    """Key totals, worst days (< 100 % matched) and a sample of unmatched dates."""
    f = fact.withColumn("__m", matched).withColumn("__u", ~matched)
    g = f.groupingSets([[key, ym], [key, ym, date]], key, ym, date).agg(
        F.count(F.lit(1)).alias("flights"), F.count_if("__m").alias("matched_flights"),
        F.count_if("__u").alias("unmatched_flights"), F.grouping_id().alias("__gid"))
    g = g.withColumn("match_pct", A.safe_ratio(F.col("matched_flights"), F.col("flights"), 2, pct=True))
    totals = g.filter(F.col("__gid") == 1).withColumn("report", F.lit("airport_total"))
    worst = g.filter((F.col("__gid") == 0) & (F.col("match_pct") < 100)).withColumn("report", F.lit("worst_day"))
    samp = R.distinct_sample(f.filter("__u"), [key, ym, date], [F.col(date).desc(), F.col(key).asc()], sample) \
        .withColumn("report", F.lit("sample_unmatched"))
    cols = ["report", key, ym, date, "flights", "matched_flights", "unmatched_flights", "match_pct"]
    return R.tagged_union([totals.drop("__gid"), worst.drop("__gid"), samp]).select(*cols)


def lag_report(matched_fact: DataFrame, keys: list[str], lag: str) -> DataFrame:
    """Exact percentiles, before/at/after split and lag histogram."""
    f = matched_fact.filter(F.col(lag).isNotNull())
    pct = A.percentiles(f, keys, lag).withColumnRenamed("n", "matched_flights") \
        .withColumn("report", F.lit("percentile"))
    timing = B.timing_label(F.col(lag))
    split = f.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("matched_flights"),
        F.count_if(timing == "obs_before_dep").alias("obs_before_dep"),
        F.count_if(timing == "obs_at_dep").alias("obs_at_dep"),
        F.count_if(timing == "obs_after_dep").alias("obs_after_dep")).withColumn("report", F.lit("timing_split"))
    hist = f.groupBy(*keys, B.lag_bucket(F.col(lag)).alias("bucket")) \
        .agg(F.count(F.lit(1)).alias("matched_flights")).withColumn("report", F.lit("histogram"))
    cols = ["report", *keys, "bucket", "matched_flights", "lag_min", "lag_max", "lag_avg",
            "lag_p50", "lag_p90", "lag_p99", "obs_before_dep", "obs_at_dep", "obs_after_dep"]
    out = R.tagged_union([pct, split, hist])
    return out.withColumn("bucket", F.col("bucket").cast("string")).select(*cols)


def time_sanity_report(df: DataFrame, key: str, ts: str, hour_col: str = "dep_hour_utc") -> DataFrame:
    """Sanity-label counts and the UTC hour distribution of ok rows."""
    x = df.select(key, ts, B.sanity_label(F.col(ts)).alias("dep_time_sanity"))
    sanity = x.groupBy(key, "dep_time_sanity").agg(F.count(F.lit(1)).alias("flights")) \
        .withColumn("report", F.lit("sanity")).withColumn(hour_col, F.lit(None).cast("int"))
    hours = x.filter(F.col("dep_time_sanity") == "ok").groupBy(key, F.hour(ts).alias(hour_col)) \
        .agg(F.count(F.lit(1)).alias("flights")).withColumn("report", F.lit("hour_distribution")) \
        .withColumn("dep_time_sanity", F.lit("ok"))
    cols = ["report", key, "dep_time_sanity", hour_col, "flights"]
    return sanity.select(*cols).unionByName(hours.select(*cols))


def unmatched_top(fact: DataFrame, key: str, matched: Column, n: int = 10) -> DataFrame:
    """Unmatched count with total, HAVING > 0, top n."""
    g = fact.groupBy(key).agg(F.count(F.lit(1)).alias("flights"),
                              F.count_if(~matched).alias("unmatched_flights"))
    t = R.top_n(g, [R.desc_pg("unmatched_flights"), R.asc_pg(key)], n, where=F.col("unmatched_flights") > 0)
    return t.withColumn("rank", F.col("rank").cast("long"))
