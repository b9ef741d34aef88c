"""Registered queries on the driver tables: name -> (spark, sf_dir) -> DataFrame.

Every query reads whole driver tables (or DataFrames Spark derives from
them) and aliases every computed column to the name its oracle SQL uses.
Floats are rounded the way the reference rounds them (2 / 4 dp) or to 6 dp
where the reference keeps full precision, so engine-level last-bit
differences cannot change a result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearcast.operators import modelling as ML
from nearcast.operators import aggregates as A
from nearcast.operators import quality as DQ
from nearcast.operators import reports as R
from nearcast.operators.asof import exists_in_window, nearest_asof, nearest_asof_candidates
from nearcast.plans import analogues as X
from nearcast.plans import analyses as AN
from nearcast.session import scratch_path
from nearcast.sources.tables import load as _load
from nearcast.sources.zipcsv import archive_report, read_zipped_csv, write_zipped_csv

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


#: Rows of a time slice of ``nearest_asof_hot``; the flight flow's own limit is ``Params.split_rows``.
SLICE_ROWS = 1000
MEASURES = [A.N, A.D, A.RATE, A.AVG]


# ---------------------------------------------------------------- joins

@query("nearest_asof")
def nearest_asof_q(spark, sf):
    """Window-form nearest observation, every purchase kept."""
    # lag = microseconds / 6e7 has at most 8 decimals when it terminates, so
    # rounding to 8 dp never meets a half-way tie (6 dp would, 1 row in 60)
    return X.nearest(spark, sf).withColumn("lag_minutes", F.round("lag_minutes", 8))


@query("nearest_asof_minby")
def nearest_asof_minby_q(spark, sf):
    """J5-J6 cross-check form: bucketed range join + min_by; same result."""
    out = nearest_asof_candidates(X.purchases(spark, sf), X.observations(spark, sf),
                                  key="user_id", event_time="ts", obs_time="ts",
                                  window_hours=X.WINDOW_HOURS, event_id="event_id",
                                  carry=["event_id", "event_type", "value"], obs_key="event_id")
    return out.withColumn("lag_minutes", F.round("lag_minutes", 8))


@query("nearest_asof_hot")
def nearest_asof_hot_q(spark, sf):
    """J6 on four pooled stations and 30-day buckets: hot groups are cut into time slices."""
    def pooled(df):
        return df.withColumn("station", F.col("user_id") % 4)
    out = nearest_asof(pooled(X.purchases(spark, sf)), pooled(X.observations(spark, sf)).drop("user_id"), key="station",
                       event_time="ts", obs_time="ts", window_hours=X.WINDOW_HOURS, carry=["event_id"], obs_key="event_id",
                       bucket_hours=720, split_rows=SLICE_ROWS)
    return out.select("event_id", "station", "match_status", "obs_ts", "obs_event_id", F.round("lag_minutes", 8).alias("lag_minutes"))


@query("exists_in_window")
def exists_in_window_q(spark, sf):
    """Does any observation fall within the window?"""
    return exists_in_window(X.purchases(spark, sf), X.observations(spark, sf), key="user_id",
                            event_time="ts", obs_time="ts", window_hours=X.WINDOW_HOURS)


# ----------------------------------------------------------- aggregates

@query("delay_by_key_hour")
def delay_by_key_hour_q(spark, sf):
    """A1, A4, A5, P19."""
    return X.key_hour_agg(spark, sf)


@query("delay_by_route")
def delay_by_route_q(spark, sf):
    """A2."""
    return X.route_agg(spark, sf)


@query("delay_by_buckets")
def delay_by_buckets_q(spark, sf):
    """A3, P13."""
    return X.bucket_agg(spark, sf)


@query("rollup_weighted")
def rollup_weighted_q(spark, sf):
    """Key-hour -> key roll-up from rounded means."""
    return A.weighted_rollup(X.key_hour_agg(spark, sf), ["event_type"])


@query("pooled_dimensions")
def pooled_dimensions_q(spark, sf):
    """Pooled by each bucket dimension + worst combinations."""
    return AN.weather_bucket_report(X.bucket_agg(spark, sf), "origin", X.MIN_COMBO_FLIGHTS)


# ------------------------------------------------------- top reports

@query("top_reports")
def top_reports_q(spark, sf):
    """Tagged top-10 lists of key-hours and keys."""
    return AN.hotspot_report(X.key_hour_agg(spark, sf), "event_type", "event_hour",
                             X.MIN_HOUR_FLIGHTS, X.MIN_KEY_FLIGHTS)


@query("route_top")
def route_top_q(spark, sf):
    """Top routes by volume and by rate (volume >= 50)."""
    return AN.route_report(X.route_agg(spark, sf), X.ROUTE_KEYS, X.MIN_ROUTE_FLIGHTS)


# ------------------------------------------------ coverage and diagnostics

from nearcast.functions import buckets as B  # noqa: E402
from nearcast.operators.dedupe import keep_latest  # noqa: E402

COVER = ["flights", "matched_flights", "match_pct"]


@query("coverage_grains")
def coverage_grains_q(spark, sf):
    """Match coverage by key, key-date and key-hour in one grouping-sets pass."""
    return AN.coverage_grains(X.nearest_fact(spark, sf), "user_id", "year_month", "event_date",
                              "event_hour", F.col("is_matched"))


@query("coverage_overall")
def coverage_overall_q(spark, sf):
    """Overall + per-key rows, low-match keys repeated under their own label."""
    return AN.coverage_overall(_fact(spark, sf), "user_id", "year_month", F.col("is_matched"),
                               X.LOW_MATCH_PCT, key_out="user_key")


@query("coverage_by_month")
def coverage_by_month_q(spark, sf):
    """A10: coverage by month and by key-month."""
    f = X.nearest_fact(spark, sf)
    return A.grain_coverage(f, ["year_month"], {"month": [], "key_month": ["user_id"]},
                            F.col("is_matched"))


@query("unmatched_by_key")
def unmatched_by_key_q(spark, sf):
    """Unmatched count with total, HAVING > 0, top 10."""
    return AN.unmatched_top(X.nearest_fact(spark, sf), "user_id", F.col("is_matched"))


@query("row_counts")
def row_counts_q(spark, sf):
    """Rows, distinct keys, duplicates (lineitem has no natural key)."""
    from nearcast.sources.tables import load
    parts = [
        A.key_counts(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
        .withColumn("table_name", F.lit("lineitem")),
        A.key_counts(load(spark, sf, "orders"), ["o_orderkey"]).withColumn("table_name", F.lit("orders")),
        A.key_counts(X.nearest(spark, sf), ["event_id"]).withColumn("table_name", F.lit("nearest")),
    ]
    return R.tagged_union(parts)


@query("unmatched_by_date")
def unmatched_by_date_q(spark, sf):
    """Key totals, worst days (< 100 %), sample of unmatched dates."""
    return AN.unmatched_report(_fact(spark, sf), "user_id", "year_month", "event_date",
                               F.col("is_matched"))


@query("lag_distribution")
def lag_distribution_q(spark, sf):
    """Exact percentiles, timing split, lag histogram."""
    f = _fact(spark, sf).filter(F.col("match_status") == "matched")
    return AN.lag_report(f, ["obs_event_type", "year_month"], "lag_minutes")


@query("dep_time_distribution")
def dep_time_distribution_q(spark, sf):
    """Timestamp sanity labels and the UTC hour distribution."""
    return AN.time_sanity_report(_load_events(spark, sf), "event_type", "ts", "event_hour")


@query("dedupe_latest")
def dedupe_latest_q(spark, sf):
    """One row per (user, hour): latest ts, then highest id."""
    from nearcast.sources.tables import load
    ev = load(spark, sf, "events")
    return keep_latest(ev, ["user_id", F.date_trunc("hour", "ts").alias("ts_hour")],
                       ["ts", "event_id"], keep=["event_id", "ts", "event_type", "value"])


# ------------------------------------------------ cleaning, time, keys (P1-P12, H-DT)

from nearcast.functions import cleaning as C  # noqa: E402
from nearcast.functions import timeutil as TU  # noqa: E402
from nearcast.functions.keys import surrogate_key  # noqa: E402
from nearcast.operators import dims as DM  # noqa: E402

# The zone seed of the time-parsing analogue (order priority -> IANA zone).
PRIORITY_ZONES = [
    ("1-URGENT", "America/New_York"),
    ("2-HIGH", "America/Chicago"),
    ("3-MEDIUM", "America/Denver"),
    ("4-NOT SPECIFIED", "America/Phoenix"),
    ("5-LOW", "Pacific/Honolulu"),
]


def _raw_text(ev, *more):
    v = F.col("value").cast("string")
    raw = (F.when(F.col("event_type") == "error", F.lit("")).when(F.col("event_type") == "signup", F.lit("M"))
           .when(F.col("event_type") == "click", F.concat(F.lit(" "), v, F.lit(" "))).otherwise(v))
    trace = F.when(F.col("event_type") == "view", F.lit("T")).otherwise(raw)
    flag = (F.when(F.col("value") >= 75, F.lit("1.00")).when(F.col("value") >= 50, F.lit("0"))
            .when(F.col("value") >= 25, F.lit("")))
    return ev.select("event_id", "event_type", raw.alias("raw_value"), trace.alias("raw_trace"),
                     flag.alias("raw_flag"), *more)


@query("clean_fields")
def clean_fields_q(spark, sf):
    """Text tokens -> typed values, cancel-aware delay fields."""
    r = _raw_text(_load(spark, sf, "events"))
    cancelled = F.col("event_type") == "error"
    num = C.clean_numeric("raw_value")
    return r.select(
        "event_id", "raw_value", "raw_trace", "raw_flag",
        C.clean_text("raw_value").alias("text_clean"),
        num.cast("double").alias("num_clean"),
        C.clean_numeric_trace("raw_trace").cast("double").alias("num_trace"),
        C.clean_flag("raw_flag").alias("flag_clean"),
        cancelled.alias("is_cancelled"),
        C.null_if_cancelled(num, cancelled).cast("double").alias("delay_clean"),
        C.cancel_aware_flag("raw_flag", cancelled).alias("delay_15_flag"))


@query("hhmm_to_utc")
def hhmm_to_utc_q(spark, sf):
    """H-DT1-4, K3: HHMM text + date in an IANA zone -> UTC -> local round trip."""
    zones = spark.createDataFrame(PRIORITY_ZONES, "o_orderpriority string, zone string")
    o = _load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    x = DM.lookup(o, zones, "o_orderpriority", known_rows=len(PRIORITY_ZONES)).select(
        "o_orderkey", "zone", (F.col("o_orderkey") % 2500).cast("string").alias("hhmm"),
        F.to_date("o_orderdate").alias("d"))
    x = TU.with_local_and_utc(x, "d", [("hhmm", "local_ts", F.col("zone"), "utc_ts")])
    return x.select("o_orderkey", "zone", "hhmm", "local_ts", "utc_ts",
                    TU.utc_to_local(F.col("utc_ts"), F.col("zone")).alias("round_trip_ts"))


@query("surrogate_key")
def surrogate_key_q(spark, sf):
    """md5 of the pipe-joined key parts, nulls as ''."""
    o = _load(spark, sf, "orders")
    return o.select("o_orderkey", surrogate_key(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_sk"))


@query("dim_lookup")
def dim_lookup_q(spark, sf):
    """Dimension assembly with size-checked broadcast inner joins."""
    s = _load(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = _load(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    r = _load(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return DM.assemble(s, (n, "s_nationkey", "inner"), (r, "n_regionkey", "inner")) \
        .select("s_suppkey", "s_name", "n_name", "r_name")


@query("left_lookup")
def left_lookup_q(spark, sf):
    """Left dimension lookup; unknown keys keep a null attribute."""
    o = _load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = _load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return DM.lookup(o, c, "o_custkey", "left")


@query("missing_refs")
def missing_refs_q(spark, sf):
    """Distinct child keys without a parent."""
    li = _load(spark, sf, "lineitem")
    parts = [
        DM.missing_refs(li, "l_suppkey", _load(spark, sf, "supplier"), "s_suppkey")
        .select(F.lit("lineitem_suppkey").alias("check_name"), F.col("l_suppkey").alias("missing_key")),
        DM.missing_refs(li, "l_partkey", _load(spark, sf, "part"), "p_partkey")
        .select(F.lit("lineitem_partkey").alias("check_name"), F.col("l_partkey").alias("missing_key")),
        DM.missing_refs(li, "l_orderkey", _load(spark, sf, "orders"), "o_orderkey")
        .select(F.lit("lineitem_orderkey").alias("check_name"), F.col("l_orderkey").alias("missing_key")),
        DM.missing_refs(_load(spark, sf, "orders"), "o_custkey", _load(spark, sf, "customer"), "c_custkey")
        .select(F.lit("orders_custkey").alias("check_name"), F.col("o_custkey").alias("missing_key")),
    ]
    return R.tagged_union(parts)


@query("keyed_merge")
def keyed_merge_q(spark, sf):
    """delete+insert merge of a re-priced batch with a new column."""
    from nearcast.operators.incremental import keyed_merge
    o = _load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    batch = o.filter(F.col("o_orderstatus") == "O").select(
        "o_orderkey", "o_custkey", "o_orderstatus", (F.col("o_totalprice") + 1.0).alias("o_totalprice"),
        F.lit(1).alias("revision"))
    return keyed_merge(o, batch, ["o_orderkey"])


@query("zipped_csv_load")
def zipped_csv_load_q(spark, sf):
    """Orders written as one zipped CSV per year, read back as text by names, typed, checked against the archive report."""
    o = _load(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
        F.date_format("o_orderdate", "yyyy").alias("year"))
    path = scratch_path(spark, f"archives-{uuid.uuid4().hex}")
    write_zipped_csv(o, path, "year").write.format("noop").mode("overwrite").save()
    rows = read_zipped_csv(spark, path).groupBy(F.col("__file").alias("source_file")).agg(
        F.count("*").alias("n_rows"), F.countDistinct("o_custkey").alias("n_customers"), F.sum(F.col("cents").cast("long")).alias("cents"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"))
    report = archive_report(spark, path).select(
        F.element_at(F.split("path", "/"), -1).alias("source_file"), F.col("n_rows").alias("reported_rows"), F.col("error").isNull().alias("sound"))
    return rows.join(report, "source_file")


@query("month_reload")
def month_reload_q(spark, sf):
    """Partition reload - every month present in the batch is replaced whole.

    Batch: the 'F' orders re-loaded with line count and quantity recomputed
    from their lines; orders of a touched month missing from the batch are
    gone afterwards, untouched months stay.
    """
    from nearcast.operators.incremental import replace_partitions
    o = _load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                          F.date_format("o_orderdate", "yyyy-MM").alias("year_month"))
    lines = _load(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("l_quantity").alias("total_qty"))
    batch = o.filter(F.col("o_orderstatus") == "F").drop("o_totalprice") \
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    return replace_partitions(o, batch, ["year_month"])


@query("coverage_extent")
def coverage_extent_q(spark, sf):
    """Rows, months, min/max month, distinct unit-months and units.

    Two levels: (unit, month) pairs first (map-side partial counts), then
    the distinct counts run over the pair table instead of the raw rows.
    """
    li = _load(spark, sf, "lineitem").select("l_suppkey", F.date_format("l_shipdate", "yyyy-MM").alias("ym"))
    pairs = li.groupBy("l_suppkey", "ym").agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(F.sum("n").cast("long").alias("row_count"), F.count_distinct("ym").alias("months"),
                     F.min("ym").alias("min_month"), F.max("ym").alias("max_month"),
                     F.count(F.lit(1)).alias("unit_months"),
                     F.count_distinct("l_suppkey").alias("units"))


@query("quality_report")
def quality_report_q(spark, sf):
    """Q1-Q13, Q16: named checks -> (name, violations, passed).

    One scan and one grouping per table feeds all its checks (``table_checks``):
    orders by key, events by type and hour, the as-of result by user. Lineitem
    is read for its key, for its reference and for the route join, each time
    other columns of the file.
    """
    from nearcast.operators import quality as Q
    orders = _load(spark, sf, "orders")
    li = _load(spark, sf, "lineitem")
    ev = _load(spark, sf, "events")
    matched = F.col("match_status") == "matched"
    # the typed, cancel-aware fields of clean_fields, as columns of the event
    raw = _raw_text(ev, "ts", "value")
    cancelled = F.col("event_type") == "error"
    delay = C.null_if_cancelled(C.clean_numeric("raw_value"), cancelled).cast("double")
    flag = C.cancel_aware_flag("raw_flag", cancelled)
    purchase = F.col("event_type") == "purchase"
    return Q.run_checks([
        Q.table_checks(orders, ["o_orderkey"], rows={
            "not_null_orders_o_orderkey": F.col("o_orderkey").isNull(),
            "not_null_orders_o_orderdate": F.col("o_orderdate").isNull(),
            "accepted_values_o_orderstatus": ~F.col("o_orderstatus").isin("F", "O", "P")},
            groups={"unique_orders_o_orderkey": F.col("n_rows") > 1}),
        Q.table_checks(raw, ["event_type", F.hour("ts").alias("event_hour")],
                       rows={"cancelled_null_delay": cancelled & delay.isNotNull(),
                             "cancelled_null_flag": cancelled & flag.isNotNull()},
                       measures=[*A.delay_measures(F.col("value") >= X.DELAYED_AT, "value"),
                                 F.count_if(F.col("ts").isNull()).alias("null_ts")],
                       groups={"rates_valid_key_hour": Q.rate_violation()},
                       totals={"null_ts_share": F.sum("null_ts") > 0.01 * F.sum("n_rows")},
                       parity={"row_count_parity_nearest": -F.sum(F.when(purchase, F.col("n_rows")).otherwise(0))}),
        Q.table_checks(X.nearest(spark, sf), ["user_id"], rows={
            "accepted_values_match_status": ~F.col("match_status").isin("matched", "no_obs_in_window"),
            "match_flag_consistent": matched != F.col("obs_ts").isNotNull(),
            "matched_within_window": matched & ~F.coalesce(
                F.abs(F.col("lag_minutes")) <= X.WINDOW_HOURS * 60, F.lit(False))},
            measures=[F.count_if(matched).alias("n_matched")],
            groups={"match_share_by_user": F.col("n_matched") < F.lit(0.9) * F.col("n_rows")},
            parity={"row_count_parity_nearest": F.sum("n_rows")}),
        Q.table_checks(li, ["l_orderkey", "l_linenumber"], groups={"unique_lineitem_order_line": F.col("n_rows") > 1}),
        Q.violations("rates_valid_route", Q.rates_valid(X.route_agg(spark, sf))),
        Q.violations("refs_lineitem_suppkey",
                     DM.missing_refs(li, "l_suppkey", _load(spark, sf, "supplier"), "s_suppkey")),
    ])


# ------------------------------------------------ ranking metrics and folds

from nearcast.operators import metrics as MT  # noqa: E402

# Fixed analogue: the "model score" is a logistic curve of the event value and
# the target is "the event is an error".
SCORE_CENTER, SCORE_SCALE = 50.0, 25.0
SEGMENT_MIN_ROWS = 300


def scored_events(spark, sf):
    ev = _load(spark, sf, "events")
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("value") - SCORE_CENTER) / SCORE_SCALE))
    return ev.select("event_id", "ts", F.date_format("ts", "yyyy-MM-dd").alias("segment"),
                     score.alias("score"), (F.col("event_type") == "error").alias("target"))


def _round_all(df, cols, digits=6):
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


METRIC_COLS = ["pr_auc", "roc_auc", "brier", "positive_rate", "n_rows", "precision_at_recall_50",
               "lift_at_top_decile"]


@query("ranking_metrics")
def ranking_metrics_q(spark, sf):
    """Exact step AP, ROC-AUC, Brier, precision@recall 0.5, top-decile lift,
    trapezoid PR area."""
    m = MT.ranking_metrics(scored_events(spark, sf), "score", "target", trapezoid=True)
    return _round_all(m, METRIC_COLS + ["pr_auc_trapezoid"])


@query("segment_metrics")
def segment_metrics_q(spark, sf):
    """Per-day model vs constant-rate baseline average precision."""
    s = scored_events(spark, sf)
    base_rate = s.agg(F.avg(F.col("target").cast("double")).alias("base_score"))
    return ML.segment_report(s, "target", "segment", base_rate, min_rows=SEGMENT_MIN_ROWS)


@query("calibration_bins")
def calibration_bins_q(spark, sf):
    """10 quantile bins, mean score and positive share per non-empty bin."""
    c = MT.calibration_bins(scored_events(spark, sf), "score", "target", 10)
    return _round_all(c, ["mean_score", "positive_share"])


@query("pr_points")
def pr_points_q(spark, sf):
    """Precision and recall at every distinct threshold."""
    p = MT.pr_points(scored_events(spark, sf), "score", "target").drop("rank")
    return _round_all(p, ["threshold", "precision", "recall"])


# Fixed analogue: expanding-window folds over order months (train <= end; closed val range).
FOLDS = [("fold1", "1997-12", "1998-01", "1998-12"),
         ("fold2", "1998-06", "1998-07", "1998-12"),
         ("fold3", "1998-09", "1998-10", "1998-12")]
TEST_START = "1999-01"


def order_months(spark, sf):
    o = _load(spark, sf, "orders")
    return o.select("o_custkey", "o_orderpriority", "o_totalprice",
                    F.date_format("o_orderdate", "yyyy-MM").alias("year_month"),
                    (F.col("o_orderstatus") == "F").alias("target"))


@query("split_profile")
def split_profile_q(spark, sf):
    """train/test split profile and train rows by year."""
    o = order_months(spark, sf).withColumn(
        "split", F.when(F.col("year_month") < TEST_START, "train").otherwise("test"))
    prof = ML.split_profile(o, "target", "split", "year_month",
                            {"origins": "o_custkey", "airlines": "o_orderpriority"}, {"missing_price_pct": "o_totalprice"}) \
        .withColumn("report", F.lit("summary")).withColumn("year", F.lit(None).cast("string"))
    by_year = o.filter(F.col("split") == "train").groupBy(F.substring("year_month", 1, 4).alias("year")) \
        .agg(F.count(F.lit(1)).alias("rows"),
             F.round(F.avg(F.col("target").cast("double")), 4).alias("positive_rate")) \
        .withColumn("report", F.lit("train_by_year")).withColumn("split", F.lit("train"))
    return R.tagged_union([prof, by_year]).select(
        "report", "split", "year", "rows", "positive_rate", "months", "origins", "airlines",
        "missing_price_pct")


@query("expanding_folds")
def expanding_folds_q(spark, sf):
    """M7: rows and positive rate of each fold's train and validation range.

    Months are aggregated first (one row per month), so the range join with
    the fold table touches months, not orders.
    """
    per_month = order_months(spark, sf).groupBy("year_month").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("target").alias("p"))
    folds = F.broadcast(spark.createDataFrame(FOLDS, "fold string, train_end string, val_start string, val_end string"))
    j = per_month.crossJoin(folds)
    in_train = F.col("year_month") <= F.col("train_end")
    in_val = (F.col("year_month") >= F.col("val_start")) & (F.col("year_month") <= F.col("val_end"))
    g = j.groupBy("fold").agg(
        F.sum(F.when(in_train, F.col("n")).otherwise(0)).cast("long").alias("train_rows"),
        F.sum(F.when(in_train, F.col("p")).otherwise(0)).cast("long").alias("train_pos"),
        F.sum(F.when(in_val, F.col("n")).otherwise(0)).cast("long").alias("val_rows"),
        F.sum(F.when(in_val, F.col("p")).otherwise(0)).cast("long").alias("val_pos"))
    return g.select("fold", "train_rows", "val_rows",
                    F.round(A.safe_ratio(F.col("train_pos"), F.col("train_rows"), 6), 6).alias("train_positive_rate"),
                    F.round(A.safe_ratio(F.col("val_pos"), F.col("val_rows"), 6), 6).alias("val_positive_rate"))


# ------------------------------------------------ dashboard computations

from nearcast.operators import views as V  # noqa: E402

VIEW_AIRPORT = "purchase"
VIEW_CARRIERS = ["A", "R"]
OVERVIEW_MIN_FLIGHTS = 50


@query("airport_summaries")
def airport_summaries_q(spark, sf):
    """Per-key sums, rate and weighted mean (0 when empty)."""
    s = V.key_summary(X.key_hour_agg(spark, sf), ["event_type"])
    return _round_all(s, [A.RATE, A.AVG])


@query("airport_leaderboard")
def airport_leaderboard_q(spark, sf):
    """Per-key sums, clipped rate, >= 500 flights, top 10."""
    t = V.leaderboard(X.key_hour_agg(spark, sf), "event_type", X.MIN_KEY_FLIGHTS, 10)
    return _round_all(t.withColumn("rank", F.col("rank").cast("long")), [A.RATE])


@query("top_hours")
def top_hours_q(spark, sf):
    """One key's hours, minimum volume, top 5 by rate, with hour labels."""
    base = X.key_hour_agg(spark, sf).withColumn("hour_label", B.hour_label(F.col("event_hour")))
    t = R.top_n(base, [F.col(A.RATE).desc(), F.col(A.N).desc(), F.col("event_hour").asc()], 5,
                where=(F.col("event_type") == VIEW_AIRPORT) & (F.col(A.N) >= X.MIN_HOUR_FLIGHTS))
    return t.withColumn("rank", F.col("rank").cast("long"))


@query("bucket_rates")
def bucket_rates_q(spark, sf):
    """Pooled clipped rates per bucket of each dimension, display order."""
    base = X.bucket_agg(spark, sf)
    parts = [V.bucket_rates(base, c) for c in ("wind_speed_bucket", "precip_bucket", "visibility_bucket")]
    return _round_all(R.tagged_union(parts), [A.RATE])


@query("weather_summary")
def weather_summary_q(spark, sf):
    """Flights, delayed, rate and combination count (all keys, and >= 50 combos)."""
    base = X.bucket_agg(spark, sf)
    a = V.filtered_summary(base).withColumn("min_combo_flights", F.lit(0))
    b = V.filtered_summary(base.filter(F.col(A.N) >= X.MIN_COMBO_FLIGHTS)) \
        .withColumn("min_combo_flights", F.lit(X.MIN_COMBO_FLIGHTS))
    return _round_all(a.unionByName(b), [A.RATE])


@query("worst_combos")
def worst_combos_q(spark, sf):
    """Worst bucket combinations (>= 50 flights), labelled with their key, top 5."""
    base = X.bucket_agg(spark, sf).withColumn(
        "combo_label", F.concat(F.col("origin"), F.lit(" — "),
                                F.concat_ws(" · ", "wind_speed_bucket", "precip_bucket", "visibility_bucket")))
    t = R.top_n(base, [F.col(A.RATE).desc(), F.col(A.N).desc(), F.col("combo_label").asc()], 5,
                where=F.col(A.N) >= X.MIN_COMBO_FLIGHTS)
    return t.withColumn("rank", F.col("rank").cast("long"))


@query("precip_lift")
def precip_lift_q(spark, sf):
    """Heavy minus none pooled precipitation rate (null if either is absent)."""
    rates = V.bucket_rates(X.bucket_agg(spark, sf), "precip_bucket")
    return _round_all(V.rate_difference(rates, "bucket", A.RATE, "heavy", "none"), ["rate_lift"])


def _routes(spark, sf):
    return V.filter_routes(X.route_agg(spark, sf), "l_returnflag", "o_orderpriority", "o_orderstatus",
                           carriers=VIEW_CARRIERS)


@query("route_summary")
def route_summary_q(spark, sf):
    """Optional route filters, then route count, sums and rate."""
    s = V.filtered_summary(_routes(spark, sf)).withColumnRenamed("combo_count", "route_count")
    return _round_all(s, [A.RATE])


@query("top_routes")
def top_routes_q(spark, sf):
    """Top routes by volume and by rate (>= 50), with route labels and percent."""
    r = _routes(spark, sf).withColumn("route_label", B.route_label("o_orderpriority", "o_orderstatus"))
    r = r.withColumn("label", F.concat_ws(" ", "l_returnflag", "route_label")) \
        .withColumn("delay_rate_pct", V.rate_pct(F.col(A.RATE)))
    keys = [F.col(c).asc() for c in X.ROUTE_KEYS]
    parts = [R.top_n(r, [F.col(A.N).desc(), *keys], 10, label="top_volume"),
             R.top_n(r, [F.col(A.RATE).desc(), F.col(A.N).desc(), *keys], 10,
                     where=F.col(A.N) >= X.MIN_ROUTE_FLIGHTS, label="top_delay")]
    cols = ["report", *X.ROUTE_KEYS, "route_label", "label", A.N, A.RATE, "delay_rate_pct", "rank"]
    return R.tagged_union([p.select(*cols) for p in parts]).withColumn("rank", F.col("rank").cast("long"))


@query("carrier_leaderboard")
def carrier_leaderboard_q(spark, sf):
    """Per-carrier sums, clipped rate and percent, >= 200 flights."""
    return _round_all(V.leaderboard(X.route_agg(spark, sf), "l_returnflag", 200), [A.RATE])


@query("overview")
def overview_q(spark, sf):
    """Row counts, top key-hour by rate, busiest key-hour, precip rates, top route."""
    from nearcast.session import materialize
    # small aggregates, each read by several parts: materialise once; bucket and
    # route aggregates share one join and one grouping-sets pass
    kh = materialize(X.key_hour_agg(spark, sf))
    wb, cr = X.bucket_and_route_aggs(spark, sf)
    counts = kh.agg(F.count(F.lit(1)).alias("airport_hour_rows")) \
        .crossJoin(wb.agg(F.count(F.lit(1)).alias("weather_bucket_rows"))) \
        .crossJoin(cr.agg(F.count(F.lit(1)).alias("carrier_route_rows")))
    top = kh.filter(F.col(A.N) >= OVERVIEW_MIN_FLIGHTS).agg(F.min_by(
        F.struct("event_type", "event_hour", A.RATE),
        F.struct(-F.col(A.RATE), F.col("event_type"), F.col("event_hour"))).alias("t")) \
        .select(F.col("t.event_type").alias("top_airport"), F.col("t.event_hour").alias("top_airport_hour"),
                F.col(f"t.{A.RATE}").alias("top_airport_delay_rate"))
    busy = kh.agg(F.min_by(F.struct("event_type", "event_hour", A.N),
                           F.struct(-F.col(A.N), F.col("event_type"), F.col("event_hour"))).alias("t")) \
        .select(F.col("t.event_type").alias("busiest_airport"), F.col("t.event_hour").alias("busiest_hour"),
                F.col(f"t.{A.N}").alias("busiest_flights"))
    pr = V.bucket_rates(wb, "precip_bucket")
    precip = pr.agg(*[F.max(F.when(F.col("bucket") == b, F.col(A.RATE))).alias(f"precip_rate_{b}")
                      for b in B.PRECIP_LABELS])
    route = cr.agg(F.min_by(F.struct(*X.ROUTE_KEYS, A.N),
                            F.struct(-F.col(A.N), *[F.col(c) for c in X.ROUTE_KEYS])).alias("t")) \
        .select(*[F.col(f"t.{c}").alias(f"top_route_{c}") for c in X.ROUTE_KEYS],
                F.col(f"t.{A.N}").alias("top_route_flights"))
    out = counts.crossJoin(top).crossJoin(busy).crossJoin(precip).crossJoin(route)
    return _round_all(out, ["top_airport_delay_rate"] + [f"precip_rate_{b}" for b in B.PRECIP_LABELS])


def _load_events(spark, sf):
    return _load(spark, sf, "events")


# ------------------------------------------------ modelling (M1-M17, A30): rows-only checks


# Fixed analogue: order lines as training rows; target = ship delay >= 15 days.
MODEL_NUMERIC = ["l_quantity", "l_discount", "l_tax", "order_month", "sin_hour", "cos_hour"]
MODEL_CATEGORICAL = ["l_returnflag", "o_orderpriority"]
MODEL_FEATURES = MODEL_NUMERIC + MODEL_CATEGORICAL
MODEL_QUERIES = {"cv_metrics", "cv_summary", "boosted_cv", "holdout_report", "permutation_importance"}


def model_rows(spark, sf):
    ol = X.order_lines(spark, sf)
    ol = ol.select("l_orderkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "o_orderpriority",
                   F.month("o_orderdate").alias("order_month"), F.dayofmonth("o_orderdate").alias("day"),
                   F.date_format("o_orderdate", "yyyy-MM").alias("year_month"),
                   (F.col("ship_delay_days") >= X.SHIP_DELAYED_DAYS).cast("double").alias("target"))
    # cyclic feature of the day of month (M1 analogue: hour -> day)
    return ML.add_derived_features(ol.withColumn("__p", F.lit(None).cast("double")), "__p", "day").drop("__p")


def _prepared_rows(spark, sf):
    """Rows of all months, written once: every fold and fit reads them."""
    from nearcast.session import materialize
    return materialize(model_rows(spark, sf))


def _split_rows(spark, sf):
    """Training and test rows; the frequent categories are those of the training rows."""
    rows = _prepared_rows(spark, sf)
    train, test = (rows.filter(F.col("year_month") < TEST_START), rows.filter(F.col("year_month") >= TEST_START))
    frequent = ML.frequent_categories(train, MODEL_CATEGORICAL)
    return ML.with_categories(train, frequent), ML.with_categories(test, frequent)


def _cv(spark, sf):
    cat = _prepared_rows(spark, sf)
    return ML.cv_run(cat, FOLDS, "target", "analogue", features=MODEL_FEATURES,
                     models=("baseline", "logistic"), categorical=MODEL_CATEGORICAL,
                     key=["l_orderkey", "year_month"])


@query("cv_metrics")
def cv_metrics_q(spark, sf):
    """Expanding folds x (constant baseline, balanced logistic) -> metric rows."""
    return _round_all(_cv(spark, sf), METRIC_COLS)


@query("boosted_cv")
def boosted_cv_q(spark, sf):
    """Expanding folds x (constant baseline, histogram boosted trees, a small number of them)."""
    cv = ML.cv_run(_prepared_rows(spark, sf), FOLDS, "target", "analogue", features=MODEL_FEATURES, models=("baseline", "boosted"),
                   categorical=MODEL_CATEGORICAL, boost_params={"max_iter": 5, "max_depth": 3})
    return _round_all(cv, METRIC_COLS)


@query("cv_summary")
def cv_summary_q(spark, sf):
    """Mean and sample std of fold metrics per model."""
    s = ML.cv_summary(_cv(spark, sf))
    return _round_all(s, [c for c in s.columns if c not in ("model", "feature_set")])


@query("holdout_report")
def holdout_report_q(spark, sf):
    """Final fit on training months, holdout metrics vs baseline."""
    train, test = _split_rows(spark, sf)
    model = ML.logistic_pipeline(MODEL_FEATURES, "target", 300, MODEL_CATEGORICAL, train.count()) \
        .fit(ML.with_balanced_weights(train, "target"))
    rep = ML.holdout_report(model, train, test, "target")
    return _round_all(rep, METRIC_COLS + ["pr_auc_lift_abs", "pr_auc_lift_rel"])


@query("permutation_importance")
def permutation_importance_q(spark, sf):
    """Accuracy drop per shuffled feature, 3 repeats."""
    train, test = _split_rows(spark, sf)
    model = ML.logistic_pipeline(MODEL_FEATURES, "target", 100, MODEL_CATEGORICAL, train.count()) \
        .fit(ML.with_balanced_weights(train, "target"))
    return ML.permutation_importance(model, test, MODEL_FEATURES, "target", repeats=3, seed=42)


def _fact(spark, sf):
    """The as-of fact for reports that read it in several branches: materialised once."""
    from nearcast.session import materialize
    return materialize(X.nearest_fact(spark, sf))


# ---------------------------------------------------------------- derived columns, gates and orders

@query("calendar_columns")
def calendar_columns_q(spark, sf):
    """H-DT5, H-DT8, P19, M1, F13: calendar parts, epoch seconds, shifted instants and cyclic hours of every event."""
    e = _load(spark, sf, "events").withColumns(TU.calendar_features("ts"))
    e = ML.add_derived_features(e.withColumn("amount", F.when(F.col("value") > 50, F.col("value"))), "amount", "hour")
    return e.select("event_id", "hour", "dow_iso", "month", F.round(TU.epoch_seconds("ts"), 6).alias("epoch_s"),
                    TU.add_hours("ts", 2).alias("ts_plus_2h"), "is_precip", F.round("sin_hour", 9).alias("sin_hour"),
                    F.round("cos_hour", 9).alias("cos_hour"))


@query("model_buckets")
def model_buckets_q(spark, sf):
    """Order lines per model-side wind and precipitation label."""
    li = _load(spark, sf, "lineitem")
    return li.groupBy(B.model_wind_bucket(F.when(F.col("l_linenumber") != 3, F.col("l_quantity"))).alias("wind"),
                      B.model_precip_bucket(F.when(F.col("l_linenumber") != 2, 4 * F.col("l_discount"))).alias("precip")).agg(F.count("*").alias("n"))


@query("departure_anchors")
def departure_anchors_q(spark, sf):
    """Lines by the instant they count for: shipped ones by ship date, returned and open ones by order date."""
    ol = X.order_lines(spark, sf)
    actual = F.when(F.col("l_quantity") > 10, F.col("l_shipdate").cast("timestamp"))
    anchor, source = TU.departure_anchor(actual, F.col("o_orderdate").cast("timestamp"), F.col("l_returnflag") == "R")
    return ol.groupBy(source.alias("time_source"), TU.year_month(anchor).alias("year_month")).agg(
        F.count("*").alias("n"), F.count_if(F.col("ship_delay_days") >= X.SHIP_DELAYED_DAYS).alias("delayed"))


@query("station_month_gate")
def station_month_gate_q(spark, sf):
    """Station-months whose share of matched events is too low, or that have no event."""
    fact = X.nearest_fact(spark, sf).withColumn("station", F.col("user_id") % 20)
    scope = _load(spark, sf, "events").select((F.col("user_id") % 20).alias("station"), F.date_format("ts", "yyyy-MM").alias("year_month")) \
        .unionByName(spark.range(20).select(F.col("id").alias("station"), F.lit("1999-01").alias("year_month")))
    return DQ.scoped_match_share(fact, scope, ["station", "year_month"], F.col("is_matched"), 0.9)


@query("readiness_gate")
def readiness_gate_q(spark, sf):
    """Q15: go / no-go over two tables: rows, months, unit-months, a warning where the months differ."""
    o = _load(spark, sf, "orders").withColumn("year_month", F.date_format("o_orderdate", "yyyy-MM"))
    e = _load(spark, sf, "events").withColumn("year_month", F.date_format("ts", "yyyy-MM"))
    return DQ.full_readiness({"orders": o, "events": e}, {"orders": 60, "events": 60}, {"orders": 100, "events": 100},
                            {"orders": "o_orderstatus", "events": "event_type"})


@query("ordered_reports")
def ordered_reports_q(spark, sf):
    """L1 (ascending, nulls first), L3, L9, U4: reports in a stated order."""
    o = _load(spark, sf, "orders")
    by_priority = o.groupBy(F.col("o_orderpriority").alias("segment")).agg(F.count("*").alias("n_rows")).withColumn("segment_type", F.lit("priority"))
    by_status = o.groupBy(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("segment")).agg(F.count("*").alias("n_rows")) \
        .withColumn("segment_type", F.lit("status"))
    labelled = R.top_n(by_priority, [R.by_labels("segment", ["3-MEDIUM", "1-URGENT"]), F.col("segment").asc()], 4, label="labels")
    nulls = R.top_n(by_status, [R.asc_nulls_first("segment")], 3, label="nulls_first")
    top = V.top_segments(by_priority.unionByName(by_status), "priority", 3).withColumn("report", F.lit("segments"))
    return R.tagged_union([labelled, nulls, top]).select("report", "rank", "segment_type", "segment", "n_rows")
