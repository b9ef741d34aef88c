"""The reference's model flow on its own data: raw text -> staging -> intermediate -> marts.

Every model is a ``DataFrame -> DataFrame`` function; Catalyst sees the whole
chain. Two points are materialised on a real run (the joined table and the
fact), written by :func:`materialize` / :func:`build_months`.

Parameters mirror the reference's project variables: missing / trace
tokens, join window (hours), and one optional window - a single
``year_month`` or a half-open ``[start_date, end_date)`` on the local
flight date. Two documented deviations are options:

* K1: by default the monthly window filters the *local* flight date only,
  so evening departures on a month's last day are kept; ``strict_utc_window``
  also filters the UTC departure time, as the reference does (and loses them).
* K6: the observation side is padded by the join window in month mode too
  (the reference pads only in date-range mode); ``pad_month=False`` restores
  the reference behaviour.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearcast.functions import buckets as B
from nearcast.functions import cleaning as C
from nearcast.functions import timeutil as TU
from nearcast.functions.keys import surrogate_key
from nearcast.operators import aggregates as A
from nearcast.operators import dims as DM
from nearcast.operators.asof import nearest_asof
from nearcast.operators.dedupe import keep_latest
from nearcast.operators.incremental import padded_window_filter, publish_table, window_filter, write_partitions


@dataclass
class Params:
    missing_token: str = C.MISSING_TOKEN
    trace_token: str = C.TRACE_TOKEN
    window_hours: float = 2.0
    year_month: str | None = None
    start_date: str | None = None
    end_date: str | None = None
    strict_utc_window: bool = False
    pad_month: bool = True
    # raw rows are loaded under the month of their date (UTC for weather): a windowed build reads only those partitions
    prune_months: bool = True
    strict_numeric: bool = True
    # K2: actual departure = scheduled + departure delay (handles midnight
    # rollover); default keeps the reference's same-date parse of the HHMM text
    actual_from_delay: bool = False
    # skew: split (airport, day) groups with more than hot_threshold departures over `salt` tasks
    salt: int = 1
    hot_threshold: int | None = None
    # (airport, day) groups with more rows than this are cut into time slices
    split_rows: int | None = 2_000_000


# Raw flight column -> typed column.
FLIGHT_TEXT = [("Reporting_Airline", "reporting_airline"), ("Flight_Number_Reporting_Airline", "flight_number"),
               ("Tail_Number", "tail_number"), ("Origin", "origin"), ("OriginCityName", "origin_city_name"),
               ("OriginState", "origin_state"), ("Dest", "dest"), ("DestCityName", "dest_city_name"),
               ("DestState", "dest_state")]
FLIGHT_INT = [("Year", "flight_year"), ("Month", "flight_month"), ("DayOfWeek", "day_of_week")]
FLIGHT_TIMES = [("CRSDepTime", "crs_dep_time_local"), ("DepTime", "dep_time_local"),
                ("CRSArrTime", "crs_arr_time_local"), ("ArrTime", "arr_time_local"),
                ("WheelsOff", "wheels_off_local"), ("WheelsOn", "wheels_on_local")]
FLIGHT_CANCEL_AWARE = [("DepDelay", "dep_delay_minutes"), ("DepDelayMinutes", "dep_delay_minutes_nonneg"),
                       ("ArrDelay", "arr_delay_minutes"), ("ArrDelayMinutes", "arr_delay_minutes_nonneg")]
FLIGHT_CANCEL_FLAGS = [("DepDel15", "is_dep_delay_15_plus"), ("ArrDel15", "is_arr_delay_15_plus")]
FLIGHT_NUMERIC = [("CarrierDelay", "carrier_delay_minutes"), ("WeatherDelay", "weather_delay_minutes"),
                  ("NASDelay", "nas_delay_minutes"), ("SecurityDelay", "security_delay_minutes"),
                  ("LateAircraftDelay", "late_aircraft_delay_minutes"), ("TaxiOut", "taxi_out_minutes"),
                  ("TaxiIn", "taxi_in_minutes"), ("AirTime", "air_time_minutes"),
                  ("ActualElapsedTime", "actual_elapsed_minutes"), ("CRSElapsedTime", "scheduled_elapsed_minutes"),
                  ("Distance", "distance_miles")]

# Raw weather column -> typed column.
WEATHER_NUMERIC = [("tmpf", "temperature_f"), ("dwpf", "dewpoint_f"), ("relh", "relative_humidity_pct"),
                   ("drct", "wind_direction_deg"), ("sknt", "wind_speed_knots"), ("alti", "altimeter_inhg"),
                   ("mslp", "sea_level_pressure_hpa"), ("vsby", "visibility_miles"), ("gust", "wind_gust_knots"),
                   ("skyl1", "sky_layer_1_ft"), ("skyl2", "sky_layer_2_ft"), ("skyl3", "sky_layer_3_ft"),
                   ("skyl4", "sky_layer_4_ft"), ("feel", "feels_like_f"), ("snowdepth", "snow_depth_inches")]
WEATHER_TEXT = [("skyc1", "sky_cover_1"), ("skyc2", "sky_cover_2"), ("skyc3", "sky_cover_3"),
                ("skyc4", "sky_cover_4"), ("wxcodes", "weather_codes"), ("metar", "metar_raw")]
WEATHER_CARRY = ["weather_station_id", "temperature_f", "dewpoint_f", "relative_humidity_pct",
                 "wind_direction_deg", "wind_speed_knots", "precip_1hr_inches", "altimeter_inhg",
                 "sea_level_pressure_hpa", "visibility_miles", "wind_gust_knots", "sky_cover_1", "sky_cover_2",
                 "sky_cover_3", "sky_cover_4", "sky_layer_1_ft", "sky_layer_2_ft", "sky_layer_3_ft",
                 "sky_layer_4_ft", "weather_codes", "feels_like_f", "metar_raw", "snow_depth_inches", "loaded_at"]
LINEAGE = ["year_month", "source_file", "loaded_at", "run_id"]


def _opt(df: DataFrame, c: str):
    return F.col(c) if c in df.columns else F.lit(None).cast("string")


def stg_flights(raw: DataFrame, p: Params = Params()) -> DataFrame:
    """Typed, cancel-aware flights with surrogate key, windowed on the local date."""
    m = p.missing_token
    cancelled = C.clean_flag(_opt(raw, "Cancelled"))
    num = lambda c: C.clean_numeric(_opt(raw, c), m, strict=p.strict_numeric)
    cols = [C.clean_text(_opt(raw, s), m).alias(t) for s, t in FLIGHT_TEXT]
    cols.append(C.clean_text(_opt(raw, "FlightDate"), m).cast("date").alias("flight_date"))
    cols += [num(s).cast("int").alias(t) for s, t in FLIGHT_INT]
    cols += [C.clean_text(_opt(raw, s), m).alias(t) for s, t in FLIGHT_TIMES]
    cols += [cancelled.alias("is_cancelled"), C.clean_flag(_opt(raw, "Diverted")).alias("is_diverted"),
             C.clean_text(_opt(raw, "CancellationCode"), m).alias("cancellation_code")]
    cols += [C.null_if_cancelled(num(s), cancelled).alias(t) for s, t in FLIGHT_CANCEL_AWARE]
    cols += [C.cancel_aware_flag(_opt(raw, s), cancelled).alias(t) for s, t in FLIGHT_CANCEL_FLAGS]
    cols += [num(s).alias(t) for s, t in FLIGHT_NUMERIC]
    cols += [num("DistanceGroup").cast("int").alias("distance_group"), num("Flights").alias("flights_count")]
    cols += [_opt(raw, c).alias(c) for c in LINEAGE]
    typed = raw.select(*cols)
    typed = window_filter(typed, "flight_date", p.start_date, p.end_date, p.year_month, prune=p.prune_months)
    return typed.withColumn("flight_id", surrogate_key(
        "reporting_airline", "flight_number", "origin", F.col("flight_date").cast("string"), "crs_dep_time_local"))


def stg_weather(raw: DataFrame, p: Params = Params()) -> DataFrame:
    """Typed observations, one per (station, valid_utc), latest load wins."""
    m = p.missing_token
    num = lambda c: C.clean_numeric(_opt(raw, c), m, strict=p.strict_numeric)
    cols = [F.upper(C.clean_text(_opt(raw, "station"), m)).alias("station"),
            C.clean_text(_opt(raw, "valid"), m).cast("timestamp").alias("valid_utc")]
    cols += [num(s).alias(t) for s, t in WEATHER_NUMERIC]
    cols.append(C.clean_numeric_trace(_opt(raw, "p01i"), m, p.trace_token, strict=p.strict_numeric)
                .alias("precip_1hr_inches"))
    cols += [C.clean_text(_opt(raw, s), m).alias(t) for s, t in WEATHER_TEXT]
    cols += [_opt(raw, c).alias(c) for c in LINEAGE]
    typed = raw.select(*cols).filter(F.col("station").isNotNull() & F.col("valid_utc").isNotNull())
    if p.year_month and not p.pad_month:
        typed = window_filter(typed, "valid_utc", year_month=p.year_month)
    elif p.year_month or (p.start_date and p.end_date):
        lo, hi = TU.month_bounds(p.year_month) if p.year_month else (p.start_date, p.end_date)
        typed = padded_window_filter(typed, "valid_utc", lo, hi, p.window_hours, prune=p.prune_months)
    return keep_latest(typed, ["station", "valid_utc"], ["loaded_at", "source_file"])


def dim_airports(airports: DataFrame, timezones: DataFrame, stations: DataFrame) -> DataFrame:
    """airports x time zones x station map, inner on code (J1); all seeds are size-checked broadcasts."""
    tz = timezones.select("airport_code", "timezone")
    st = stations.select("airport_code", "weather_station_id", "station_source")
    return DM.assemble(airports.select("airport_code", "airport_name", "city", "state", "region"),
                       (tz, "airport_code", "inner"), (st, "airport_code", "inner"))


def departure_context(flights: DataFrame, dim: DataFrame, p: Params = Params()) -> DataFrame:
    """Origin (inner) and destination (left) zones, local -> UTC times, departure anchor (J2, J3, H-DT2-3, P18)."""
    o = dim.select(F.col("airport_code").alias("origin"), F.col("timezone").alias("origin_timezone"),
                   F.col("weather_station_id").alias("origin_weather_station_id"))
    d = dim.select(F.col("airport_code").alias("dest"), F.col("timezone").alias("dest_timezone"))
    f = DM.lookup(flights, o, "origin", "inner")
    f = DM.lookup(f, d, "dest", "left")
    f = (f.withColumnRenamed("crs_dep_time_local", "crs_dep_time_hhmm")
         .withColumnRenamed("dep_time_local", "dep_time_hhmm")
         .withColumnRenamed("crs_arr_time_local", "crs_arr_time_hhmm")
         .withColumnRenamed("arr_time_local", "arr_time_hhmm"))
    f = TU.with_local_and_utc(f, "flight_date", [
        ("crs_dep_time_hhmm", "crs_dep_time_local", F.col("origin_timezone"), "crs_dep_time_utc"),
        ("dep_time_hhmm", "dep_time_local", F.col("origin_timezone"), "actual_dep_time_utc"),
        ("crs_arr_time_hhmm", "crs_arr_time_local", F.col("dest_timezone"), "crs_arr_time_utc"),
        ("arr_time_hhmm", "arr_time_local", F.col("dest_timezone"), "arr_time_utc")])
    if p.actual_from_delay:
        delay_s = (F.col("dep_delay_minutes").cast("double") * 60).cast("long")
        f = f.withColumn("actual_dep_time_utc", F.when(
            F.col("dep_time_hhmm").isNotNull() & F.col("dep_delay_minutes").isNotNull(),
            F.timestamp_add("SECOND", delay_s, F.col("crs_dep_time_utc"))))
    anchor, source = TU.departure_anchor("actual_dep_time_utc", "crs_dep_time_utc", "is_cancelled")
    return f.withColumn("dep_time_utc", anchor).withColumn("dep_time_source", source)


def weather_enriched(weather: DataFrame, dim: DataFrame) -> DataFrame:
    """Observations keyed by airport through the station map."""
    a = dim.select(F.col("weather_station_id").alias("station"), "airport_code", "airport_name",
                   F.col("timezone").alias("airport_timezone"))
    return DM.lookup(weather, a, "station", "inner").withColumnRenamed("station", "weather_station_id")


def weather_at_departure(ctx: DataFrame, weather: DataFrame, p: Params = Params()) -> DataFrame:
    """Every flight with a known departure instant and its nearest observation within +/- N h."""
    f = ctx.filter(F.col("dep_time_utc").isNotNull())
    if p.strict_utc_window and p.start_date and p.end_date:
        f = f.filter((F.col("dep_time_utc") >= F.lit(p.start_date).cast("timestamp"))
                     & (F.col("dep_time_utc") < F.lit(p.end_date).cast("timestamp")))
    obs = weather.select(F.col("airport_code").alias("origin"), "valid_utc", *WEATHER_CARRY)
    out = nearest_asof(f, obs, key="origin", event_time="dep_time_utc", obs_time="valid_utc",
                       window_hours=p.window_hours, carry=WEATHER_CARRY, prefer=["loaded_at"],
                       prefix="w__", status_col="weather_match_status", lag_col="weather_obs_lag_minutes",
                       salt=p.salt, hot_threshold=p.hot_threshold, split_rows=None if p.salt > 1 else p.split_rows,
                       # weather rows are wide and unique per (airport, valid_utc) after W1:
                       # sort only their identity through the windows, join the columns back
                       join_back=True)
    ren = {"w__ts": "weather_valid_utc", "w__weather_station_id": "matched_weather_station_id",
           "w__loaded_at": "weather_loaded_at"}
    for c in out.columns:
        if c.startswith("w__"):
            out = out.withColumnRenamed(c, ren.get(c, c[3:]))
    return out


def fct_flights(joined: DataFrame) -> DataFrame:
    """33-column fact with calendar features and eligibility flags."""
    cal = TU.calendar_features("dep_time_utc")
    return joined.select(
        "flight_id", "reporting_airline", "flight_number", "origin", "dest", "flight_date", "year_month",
        "dep_time_utc", "dep_time_source", "origin_timezone",
        cal["hour"].alias("dep_hour_utc"), cal["dow_iso"].alias("dep_dow"), cal["month"].alias("dep_month"),
        "dep_delay_minutes", "is_dep_delay_15_plus", "is_cancelled", "is_diverted",
        (~F.col("is_cancelled") & ~F.col("is_diverted")).alias("is_analysis_eligible"),
        "weather_match_status", (F.col("weather_match_status") == "matched").alias("has_departure_weather"),
        "weather_valid_utc", "weather_obs_lag_minutes", "temperature_f", "dewpoint_f", "relative_humidity_pct",
        "wind_direction_deg", "wind_speed_knots", "wind_gust_knots", "precip_1hr_inches", "altimeter_inhg",
        "sea_level_pressure_hpa", "visibility_miles", "weather_codes")


def agg_delay_by_airport_hour(fct: DataFrame) -> DataFrame:
    """(A1)"""
    return A.delay_aggregate(fct, ["origin", "dep_hour_utc"], F.col("is_dep_delay_15_plus"),
                             "dep_delay_minutes", where=F.col("is_analysis_eligible"))


def agg_delay_by_carrier_route(fct: DataFrame) -> DataFrame:
    """(A2)"""
    return A.delay_aggregate(fct, ["reporting_airline", "origin", "dest"], F.col("is_dep_delay_15_plus"),
                             "dep_delay_minutes", where=F.col("is_analysis_eligible"))


def agg_delay_by_weather_bucket(fct: DataFrame) -> DataFrame:
    """(A3, P13)"""
    keys = ["origin", B.wind_bucket("wind_speed_knots").alias("wind_speed_bucket"),
            B.precip_bucket("precip_1hr_inches").alias("precip_bucket"),
            B.visibility_bucket("visibility_miles").alias("visibility_bucket")]
    return A.delay_aggregate(fct, keys, F.col("is_dep_delay_15_plus"), "dep_delay_minutes",
                             where=F.col("is_analysis_eligible") & F.col("has_departure_weather"))


def build_marts(raw_flights: DataFrame, raw_weather: DataFrame, airports: DataFrame, timezones: DataFrame,
                stations: DataFrame, p: Params = Params()) -> dict[str, DataFrame]:
    """The whole chain as lazy DataFrames (write the joined table and fact to materialise)."""
    dim = dim_airports(airports, timezones, stations)
    ctx = departure_context(stg_flights(raw_flights, p), dim, p)
    wx = weather_enriched(stg_weather(raw_weather, p), dim)
    joined = weather_at_departure(ctx, wx, p)
    fct = fct_flights(joined)
    return {"dim_airports": dim, "departure_context": ctx, "weather_enriched": wx, "joined": joined,
            "fct_flights": fct, "agg_delay_by_airport_hour": agg_delay_by_airport_hour(fct),
            "agg_delay_by_carrier_route": agg_delay_by_carrier_route(fct),
            "agg_delay_by_weather_bucket": agg_delay_by_weather_bucket(fct)}


def critical_suite(m: dict[str, DataFrame], p: Params = Params()) -> dict:
    """Data tests over built models (Q1-Q14, Q16); each returns violating rows."""
    from nearcast.operators import quality as Q
    fct, joined, ctx, dim = m["fct_flights"], m["joined"], m["departure_context"], m["dim_airports"]
    checks = {
        "not_null_fct_flight_id": lambda: Q.not_null(fct, "flight_id"),
        "unique_fct_flight_id": lambda: Q.unique(fct, ["flight_id"]),
        "accepted_values_match_status": lambda: Q.accepted_values(
            fct, "weather_match_status", ["matched", "no_obs_in_window"]),
        "accepted_values_dep_time_source": lambda: Q.accepted_values(fct, "dep_time_source", ["actual", "scheduled"]),
        "unique_airport_hour": lambda: Q.unique(m["agg_delay_by_airport_hour"], ["origin", "dep_hour_utc"]),
        "rates_valid_airport_hour": lambda: Q.rates_valid(m["agg_delay_by_airport_hour"]),
        "rates_valid_carrier_route": lambda: Q.rates_valid(m["agg_delay_by_carrier_route"]),
        "rates_valid_weather_bucket": lambda: Q.rates_valid(m["agg_delay_by_weather_bucket"]),
        "origins_in_dim": lambda: DM.missing_refs(ctx, "origin", dim, "airport_code"),
        "fct_row_count_parity": lambda: Q.count_parity(fct, joined),
        "cancelled_null_dep_delay": lambda: Q.implies(fct, F.col("is_cancelled"), F.col("dep_delay_minutes").isNull()),
        "cancelled_not_eligible": lambda: Q.implies(
            fct, F.col("is_cancelled") | F.col("is_diverted"), ~F.col("is_analysis_eligible")),
        "weather_flag_consistent": lambda: fct.filter(
            F.col("has_departure_weather") != (F.col("weather_match_status") == "matched")),
        "dep_time_utc_coverage": lambda: Q.max_null_share(ctx, "dep_time_utc", 0.01),
        "matched_within_window": lambda: Q.implies(
            joined, F.col("weather_match_status") == "matched",
            F.abs(F.col("weather_obs_lag_minutes")) <= p.window_hours * 60.0),
    }
    return checks


def materialize(spark, m: dict[str, DataFrame], out_dir: str, fresh: bool = False) -> dict[str, str]:
    """Write the joined table, then refresh the fact and the three aggregates from it.

    The joined table is partitioned by ``year_month`` and written with
    dynamic partition overwrite: the months present in this build are
    replaced (delete + insert by month), other months stay. ``fresh``
    replaces the whole table. Downstream models are rebuilt from the written
    table, which also cuts the lineage of the expensive join. Whole tables are
    written beside the old ones and put in their place by renames.
    """
    import os

    paths = {k: os.path.join(out_dir, k) for k in ("joined", "fct_flights", "agg_delay_by_airport_hour",
                                                   "agg_delay_by_carrier_route", "agg_delay_by_weather_bucket")}
    if fresh:
        publish_table(m["joined"], paths["joined"], ["year_month"])
    else:
        write_partitions(m["joined"], paths["joined"], ["year_month"])
    joined = spark.read.parquet(paths["joined"])
    fct = fct_flights(joined)
    publish_table(fct, paths["fct_flights"], ["year_month"])
    fct = spark.read.parquet(paths["fct_flights"])
    publish_table(agg_delay_by_airport_hour(fct), paths["agg_delay_by_airport_hour"])
    publish_table(agg_delay_by_carrier_route(fct), paths["agg_delay_by_carrier_route"])
    publish_table(agg_delay_by_weather_bucket(fct), paths["agg_delay_by_weather_bucket"])
    return paths


def build_months(spark, raw_flights: DataFrame, raw_weather: DataFrame, airports: DataFrame,
                 timezones: DataFrame, stations: DataFrame, start_ym: str, end_ym: str, out_dir: str,
                 resume_from: str | None = None, fresh: bool | None = None, p: Params = Params()) -> DataFrame:
    """Windowed build over an inclusive month range in one job.

    ``resume_from`` skips earlier months; ``fresh`` (replace the whole table)
    defaults to True only where the table has no month outside the range.
    Returns per-month rows and the running total of the whole joined table,
    for the built months.
    """
    from dataclasses import replace

    from nearcast.operators.incremental import month_counts
    from nearcast.session import path_exists
    months = TU.month_range(resume_from or start_ym, end_ym)
    lo, _ = TU.month_bounds(months[0])
    _, hi = TU.month_bounds(months[-1])
    q = replace(p, year_month=None, start_date=lo, end_date=hi)
    m = build_marts(raw_flights, raw_weather, airports, timezones, stations, q)
    if fresh is None:
        old = f"{out_dir}/joined"
        fresh = resume_from is None and (not path_exists(spark, old) or spark.read.parquet(old)
                                         .filter(~F.col("year_month").isin(months)).isEmpty())
    paths = materialize(spark, m, out_dir, fresh=fresh)
    return month_counts(spark.read.parquet(paths["joined"])).filter(F.col("year_month").isin(months))


def time_parsing_report(spark, samples: list[str | None] | None = None, day: str = "2025-01-15",
                        zone: str = "America/New_York") -> DataFrame:
    """HHMM samples -> local, UTC and round trip, for eyeballing (H-DT7)."""
    # The reference's literal HHMM samples.
    samples = samples if samples is not None else ["800", "1530", "1", "2400", None, "930", "745", "1200"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "sample_order int, hhmm string")
    loc = TU.hhmm_to_local(F.lit(day).cast("date"), F.col("hhmm"))
    utc = TU.local_to_utc(loc, zone)
    return df.select("sample_order", "hhmm", TU.hhmm_string("hhmm").alias("hhmm_padded"), loc.alias("local_ts"),
                     utc.alias("utc_ts"), TU.utc_to_local(utc, zone).alias("round_trip_local"))


# ----------------------------------------------------------------- named analyses

def _scoped(df: DataFrame, scope: list[tuple[str, str]] | None, key: str = "origin") -> DataFrame:
    """Restrict to (airport, year_month) scope rows (P26, J9); all rows when no scope."""
    if not scope:
        return df
    s = df.sparkSession.createDataFrame(scope, f"{key} string, year_month string")
    return DM.lookup(df, s, [key, "year_month"], "inner", known_rows=len(scope))


def _hour(df: DataFrame) -> DataFrame:
    return df.withColumn("dep_hour_utc", F.hour("dep_time_utc"))


def join_feasibility(ctx: DataFrame, weather: DataFrame, p: Params = Params(),
                     scope: list[tuple[str, str]] | None = None) -> DataFrame:
    """Share of flights with any observation within +/- N h, at 3 grains."""
    from nearcast.operators.asof import exists_in_window
    f = _scoped(ctx, scope).select("flight_id", "origin", "year_month", "flight_date", "dep_time_utc")
    obs = weather.select(F.col("airport_code").alias("origin"), "valid_utc")
    e = exists_in_window(f, obs, key="origin", event_time="dep_time_utc", obs_time="valid_utc",
                         window_hours=p.window_hours, flag="has_obs")
    from nearcast.plans import analyses as AN
    return AN.coverage_grains(_hour(e), "origin", "year_month", "flight_date", "dep_hour_utc", F.col("has_obs"))


def analyses(m: dict[str, DataFrame], p: Params = Params(), scope: list[tuple[str, str]] | None = None,
             year_month: str | None = None, low_match_pct: float = 90.0) -> dict[str, DataFrame]:
    """The reference's analyses over built models, by name.

    ``scope`` is the (airport, year_month) list the scoped analyses use;
    ``year_month`` the month of the month-wide coverage report.
    """
    from nearcast.plans import analyses as AN
    joined = m["joined"]
    scoped = _hour(_scoped(joined, scope))
    matched = F.col("weather_match_status") == "matched"
    month = joined.filter(F.col("year_month") == year_month) if year_month else joined
    return {
        "delay_by_airport_hour_top": AN.hotspot_report(m["agg_delay_by_airport_hour"], "origin", "dep_hour_utc"),
        "delay_by_weather_bucket": AN.weather_bucket_report(m["agg_delay_by_weather_bucket"]),
        "delay_carrier_route_top": AN.route_report(m["agg_delay_by_carrier_route"],
                                                   ["reporting_airline", "origin", "dest"]),
        "weather_join_coverage": AN.coverage_grains(scoped, "origin", "year_month", "flight_date",
                                                    "dep_hour_utc", matched),
        "weather_join_coverage_month": AN.coverage_overall(month, "origin", "year_month", matched, low_match_pct),
        "weather_join_unmatched": AN.unmatched_report(scoped, "origin", "year_month", "flight_date", matched),
        "weather_obs_lag_distribution": AN.lag_report(scoped.filter(matched), ["origin", "year_month"],
                                                      "weather_obs_lag_minutes"),
        "dep_time_distribution": AN.time_sanity_report(_scoped(m["departure_context"], scope), "origin",
                                                       "dep_time_utc"),
        "join_feasibility_coverage": join_feasibility(m["departure_context"], m["weather_enriched"], p, scope),
        "materialization_coverage_by_month": A.coverage_by(joined, ["year_month"], matched),
        "materialization_coverage_by_airport_month": A.coverage_by(joined, ["origin", "year_month"], matched),
        "materialization_unmatched_by_origin": AN.unmatched_top(joined, "origin", matched),
        "materialization_row_counts": A.key_counts(joined, ["flight_id"]),
    }


def validation_report(m: dict[str, DataFrame]) -> DataFrame:
    """Post-build validation: counts, duplicates, coverage by month, unmatched top 10, parity."""
    from nearcast.operators import reports as R
    joined, fct = m["joined"], m["fct_flights"]
    matched = F.col("weather_match_status") == "matched"
    rows = A.key_counts(joined, ["flight_id"]).select(
        F.lit("row_counts").alias("section"), F.lit(None).cast("string").alias("item"),
        F.col("row_count").cast("double").alias("v1"), F.col("duplicate_keys").cast("double").alias("v2"))
    cov = A.coverage_by(joined, ["year_month"], matched).select(
        F.lit("coverage_by_month").alias("section"), F.col("year_month").alias("item"),
        F.col("flights").cast("double").alias("v1"), F.col("match_pct").alias("v2"))
    from nearcast.plans import analyses as AN
    unm = AN.unmatched_top(joined, "origin", matched).select(
        F.lit("unmatched_top").alias("section"), F.col("origin").alias("item"),
        F.col("flights").cast("double").alias("v1"), F.col("unmatched_flights").cast("double").alias("v2"))
    par = joined.agg(F.count(F.lit(1)).alias("a")).crossJoin(fct.agg(F.count(F.lit(1)).alias("b"))).select(
        F.lit("fct_parity").alias("section"), F.lit(None).cast("string").alias("item"),
        F.col("a").cast("double").alias("v1"), (F.col("b") - F.col("a")).cast("double").alias("v2"))
    return R.tagged_union([rows, cov, unm, par])


def full_history_suite(m: dict[str, DataFrame], p: Params = Params()) -> dict:
    """Checks that stay valid over the whole history (Q16): keys, values, parity, window."""
    c = critical_suite(m, p)
    keep = ["not_null_fct_flight_id", "unique_fct_flight_id", "accepted_values_match_status",
            "fct_row_count_parity", "matched_within_window", "cancelled_not_eligible",
            "weather_flag_consistent"]
    return {k: c[k] for k in keep}
