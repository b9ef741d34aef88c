"""The flight/weather model flow end to end on an inline raw fixture."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from nearcast.operators import quality as Q
from nearcast.plans import analyses as AN
from nearcast.plans import flights as FL

FLIGHT_COLS = ["Reporting_Airline", "Flight_Number_Reporting_Airline", "Tail_Number", "Origin", "Dest",
               "FlightDate", "Year", "Month", "DayOfWeek", "CRSDepTime", "DepTime", "CRSArrTime", "ArrTime",
               "Cancelled", "Diverted", "DepDelay", "DepDel15", "Distance", "year_month", "source_file",
               "loaded_at", "run_id"]


def flight(al, no, o, d, date, crs, dep, canc="0.00", div="0.00", delay="0.00", d15="0.00"):
    return (al, no, "N1", o, d, date, date[:4], str(int(date[5:7])), "3", crs, dep, "1200", "1300",
            canc, div, delay, d15, "500.00", date[:7], "f.zip", "2025-02-01 00:00:00", "r1")


def _raw(spark):
    flights = [
        flight("AA", "1", "JFK", "ORD", "2025-01-15", "0800", "0805", delay="5.00"),
        flight("AA", "2", "JFK", "ORD", "2025-11-02", "0130", "0130"),            # fall-back hour
        flight("DL", "3", "PHX", "JFK", "2025-01-15", "0900", "", canc="1.00", d15=""),   # cancelled
        flight("DL", "4", "PHX", "XXX", "2025-01-15", "1000", "1030", delay="30.00", d15="1.00"),
        flight("UA", "5", "ZZZ", "JFK", "2025-01-15", "1000", "1000"),            # unknown origin: dropped
        flight("UA", "6", "JFK", "PHX", "2025-01-15", "2300", "2330", div="1.00", delay="30.00", d15=""),
    ]
    raw_f = spark.createDataFrame(flights, ", ".join(f"{c} string" for c in FLIGHT_COLS))
    wcols = ["station", "valid", "tmpf", "sknt", "p01i", "vsby", "year_month", "source_file", "loaded_at", "run_id"]
    obs = [
        ("kjfk", "2025-01-15 13:00", "30", "10", "T", "10", "2025-01", "a", "2025-02-01 00:00:00", "r"),
        ("KJFK", "2025-01-15 13:10", "31", "12", "0.02", "9", "2025-01", "a", "2025-02-01 00:00:00", "r"),
        ("KJFK", "2025-01-15 13:10", "99", "99", "0.50", "1", "2025-01", "b", "2025-03-01 00:00:00", "r"),  # later load
        ("KJFK", "2025-11-02 06:25", "40", "5", "M", "M", "2025-11", "c", "2025-12-01 00:00:00", "r"),
        ("KPHX", "2025-01-15 17:00", "70", "30", "", "2", "2025-01", "d", "2025-02-01 00:00:00", "r"),
    ]
    raw_w = spark.createDataFrame(obs, ", ".join(f"{c} string" for c in wcols))
    airports = spark.createDataFrame([("JFK", "n", "c", "NY", "NE"), ("ORD", "n", "c", "IL", "MW"),
                                      ("PHX", "n", "c", "AZ", "SW")],
                                     "airport_code string, airport_name string, city string, state string, region string")
    tz = spark.createDataFrame([("JFK", "America/New_York"), ("ORD", "America/Chicago"), ("PHX", "America/Phoenix")],
                               "airport_code string, timezone string")
    st = spark.createDataFrame([("JFK", "KJFK", "x"), ("ORD", "KORD", "x"), ("PHX", "KPHX", "x")],
                               "airport_code string, weather_station_id string, station_source string")
    return raw_f, raw_w, airports, tz, st


@pytest.fixture(scope="module")
def models(spark):
    p = FL.Params()
    return FL.build_marts(*_raw(spark), p), p


def test_flow_values(models):
    m, _ = models
    j = {r["flight_number"]: r for r in m["joined"].collect()}
    assert set(j) == {"1", "2", "3", "4", "6"}                       # unknown origin dropped (inner)
    assert j["1"]["dep_time_utc"] == datetime(2025, 1, 15, 13, 5)
    assert j["1"]["dep_time_source"] == "actual"
    # nearest to 13:05 is 13:00 and 13:10 at equal distance -> before wins
    assert j["1"]["weather_valid_utc"] == datetime(2025, 1, 15, 13, 0)
    assert float(j["1"]["precip_1hr_inches"]) == 0.0                  # trace -> 0
    assert j["2"]["dep_time_utc"] == datetime(2025, 11, 2, 6, 30)     # standard-time reading (K3)
    assert j["2"]["weather_obs_lag_minutes"] == 5.0
    assert j["3"]["dep_time_source"] == "scheduled" and j["3"]["dep_delay_minutes"] is None
    assert j["3"]["is_dep_delay_15_plus"] is None                     # cancelled + blank -> null (K12)
    assert j["6"]["is_dep_delay_15_plus"] is False                    # flown + blank -> false
    assert j["4"]["dest_timezone"] is None and j["4"]["crs_arr_time_utc"] is None   # left join
    assert j["4"]["weather_match_status"] == "matched"                # PHX 10:30 local = 17:30Z
    assert j["6"]["weather_match_status"] == "no_obs_in_window"


def test_flow_aggregates_and_reports(models):
    m, _ = models
    ah = {(r["origin"], r["dep_hour_utc"]): r for r in m["agg_delay_by_airport_hour"].collect()}
    assert ah[("PHX", 17)]["delayed_count"] == 1 and ah[("PHX", 17)]["delay_rate_15"] == 1.0
    assert ("PHX", 16) not in ah                                      # cancelled: not eligible
    wb = m["agg_delay_by_weather_bucket"].collect()
    assert {(r["origin"], r["wind_speed_bucket"]) for r in wb} == {
        ("JFK", "light_6_15kt"), ("JFK", "calm_0_5kt"), ("PHX", "strong_26plus_kt")}
    rep = AN.hotspot_report(m["agg_delay_by_airport_hour"], "origin", "dep_hour_utc", 1, 1).collect()
    assert {r["report"] for r in rep} == {"top_delay_rate", "top_avg_delay_minutes", "busiest_hour",
                                          "top_airport_delay_rate"}


def test_critical_suite_passes(models):
    m, p = models
    rep = {r["name"]: r["violations"] for r in Q.run_suite(FL.critical_suite(m, p)).collect()}
    assert all(v == 0 for v in rep.values()), rep


def test_month_window_and_strict_utc(spark, models):
    m, _ = models
    ctx = m["departure_context"]
    late = ctx.filter(F.col("flight_number") == "6").first()
    assert late["dep_time_utc"] == datetime(2025, 1, 16, 4, 30)      # local Jan 15, UTC Jan 16


def test_materialize_is_idempotent(spark, models, tmp_dir):
    m, _ = models
    paths = FL.materialize(spark, m, tmp_dir, fresh=True)
    n1 = spark.read.parquet(paths["joined"]).count()
    ah1 = sorted(tuple(r) for r in spark.read.parquet(paths["agg_delay_by_airport_hour"]).collect())
    FL.materialize(spark, m, tmp_dir)                                 # re-run: same months replaced
    assert spark.read.parquet(paths["joined"]).count() == n1
    assert sorted(tuple(r) for r in spark.read.parquet(paths["agg_delay_by_airport_hour"]).collect()) == ah1


def test_time_parsing_report(spark):
    r = {x["hhmm"]: x for x in FL.time_parsing_report(spark).collect()}
    assert r["800"]["utc_ts"] == datetime(2025, 1, 15, 13, 0)
    assert r["2400"]["local_ts"] == datetime(2025, 1, 16, 0, 0)
    assert r[None]["local_ts"] is None


def test_named_analyses_run(spark, models):
    m, p = models
    res = FL.analyses(m, p, scope=[("JFK", "2025-01"), ("PHX", "2025-01")], year_month="2025-01")
    for name, df in res.items():
        df.collect()
    cov = {(r["grain"], r["origin"]) for r in res["weather_join_coverage"].collect()}
    assert ("airport", "JFK") in cov and ("airport", "PHX") in cov
    feas = {r["origin"]: r["match_pct"] for r in res["join_feasibility_coverage"].filter("grain = 'airport'").collect()}
    assert feas["PHX"] == 100.0 and feas["JFK"] == 50.0       # JFK: the 23:30 local departure has none
    rep = {r["section"] for r in FL.validation_report(m).collect()}
    assert rep == {"row_counts", "coverage_by_month", "unmatched_top", "fct_parity"}
    suite = {r["name"]: r["violations"] for r in Q.run_suite(FL.full_history_suite(m, p)).collect()}
    assert all(v == 0 for v in suite.values())


def test_k2_midnight_rollover_option(spark):
    raw = spark.createDataFrame([flight("AA", "9", "JFK", "ORD", "2025-01-15", "2350", "0030", delay="40.00",
                                        d15="1.00")], ", ".join(f"{c} string" for c in FLIGHT_COLS))
    dim = spark.createDataFrame([("JFK", "America/New_York", "KJFK"), ("ORD", "America/Chicago", "KORD")],
                                "airport_code string, timezone string, weather_station_id string")
    same_day = FL.departure_context(FL.stg_flights(raw), dim).first()
    assert same_day["dep_time_utc"] == datetime(2025, 1, 15, 5, 30)   # reference parity: placed ~24 h early
    rolled = FL.departure_context(FL.stg_flights(raw), dim, FL.Params(actual_from_delay=True)).first()
    assert rolled["dep_time_utc"] == datetime(2025, 1, 16, 5, 30)


def test_build_months_windowed(spark, tmp_dir):
    counts = {r["year_month"]: (r["rows"], r["running_rows"])
              for r in FL.build_months(spark, *_raw(spark), "2025-01", "2025-11", tmp_dir).collect()}
    assert counts == {"2025-01": (4, 4), "2025-11": (1, 5)}
    # resume from November: January stays, November is rebuilt
    again = FL.build_months(spark, *_raw(spark), "2025-01", "2025-11", tmp_dir, resume_from="2025-11")
    assert {r["year_month"] for r in again.collect()} == {"2025-11"}
    assert spark.read.parquet(f"{tmp_dir}/joined").count() == 5
