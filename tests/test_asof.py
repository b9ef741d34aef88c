"""Nearest as-of join: FIXTURES edge frames + window form vs min_by form vs brute force."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from nearcast.operators.asof import exists_in_window, nearest_asof, nearest_asof_candidates

T0 = datetime(2025, 1, 15, 12, 0, 0)


def _frames(spark, events, obs):
    ev = spark.createDataFrame(events, "eid long, k string, t timestamp")
    ob = spark.createDataFrame(obs, "oid long, k string, t timestamp, loaded timestamp")
    return ev, ob


def _run(spark, events, obs, hours=2.0, **kw):
    ev, ob = _frames(spark, events, obs)
    out = nearest_asof(ev, ob, key="k", event_time="t", obs_time="t", window_hours=hours,
                       carry=["oid", "loaded"], prefer=["loaded"], obs_key="oid", **kw)
    return {r["eid"]: r for r in out.collect()}


def m(minutes=0, seconds=0):
    return T0 + timedelta(minutes=minutes, seconds=seconds)


def test_equal_distance_prefers_before(spark):
    r = _run(spark, [(1, "A", T0)], [(10, "A", m(-5), T0), (11, "A", m(5), T0)])
    assert r[1]["obs_oid"] == 10 and r[1]["lag_minutes"] == 5.0


def test_nearer_after_wins(spark):
    r = _run(spark, [(1, "A", T0)], [(10, "A", m(1), T0), (11, "A", m(-3), T0)])
    assert r[1]["obs_oid"] == 10 and r[1]["lag_minutes"] == -1.0


def test_closed_window_edges(spark):
    r = _run(spark, [(1, "A", T0), (2, "B", T0), (3, "C", T0)],
             [(10, "A", m(120), T0), (11, "B", m(-120), T0), (12, "C", m(120, 1), T0)])
    assert r[1]["match_status"] == "matched" and r[2]["match_status"] == "matched"
    assert r[3]["match_status"] == "no_obs_in_window" and r[3]["obs_oid"] is None


def test_duplicate_time_latest_load(spark):
    r = _run(spark, [(1, "A", T0)], [(10, "A", m(-2), m(-100)), (11, "A", m(-2), m(-50))])
    assert r[1]["obs_oid"] == 11


def test_no_obs_and_null_time(spark):
    ev = [(1, "A", T0), (2, "Z", T0), (3, "A", None), (4, None, T0)]
    r = _run(spark, ev, [(10, "A", m(-1), T0)])
    assert r[1]["match_status"] == "matched"
    assert r[2]["match_status"] == "no_obs_in_window"
    assert 3 not in r                      # null event time dropped (reference)
    assert r[4]["match_status"] == "no_obs_in_window"   # null key kept unmatched
    r2 = _run(spark, ev, [(10, "A", m(-1), T0)], keep_unmatchable=True)
    assert r2[3]["match_status"] == "no_obs_in_window"


def test_bucket_edge_pair(spark):
    # event just after midnight, observation just before: different day buckets
    t = datetime(2025, 1, 16, 0, 0, 30)
    ev = [(1, "A", t)]
    ob = [(10, "A", datetime(2025, 1, 15, 23, 59, 50), T0)]
    r = _run(spark, ev, ob)
    assert r[1]["obs_oid"] == 10


def _brute(events: pd.DataFrame, obs: pd.DataFrame, hours: float):
    out = {}
    n = hours * 3600
    for e in events.itertuples():
        c = obs[obs.k == e.k].copy()
        if e.t is None or pd.isna(e.t) or c.empty:
            out[e.eid] = None
            continue
        d = (c.t - e.t).dt.total_seconds()
        c = c.assign(absd=d.abs(), after=(d > 0).astype(int))
        c = c[c.absd <= n]
        if c.empty:
            out[e.eid] = None
            continue
        c = c.sort_values(["absd", "after", "loaded", "oid"], ascending=[True, True, False, False])
        out[e.eid] = int(c.iloc[0].oid)
    return out


def test_random_against_brute_force(spark):
    rng = np.random.default_rng(7)
    n_ev, n_ob = 400, 900
    base = np.datetime64("2025-01-01T00:00:00")
    ev_t = base + rng.integers(0, 5 * 86400, n_ev).astype("timedelta64[s]")
    ob_t = base + (rng.integers(0, 5 * 86400 // 60, n_ob) * 60).astype("timedelta64[s]")  # ties likely
    keys = np.array(["A", "B", "C"])
    events = pd.DataFrame({"eid": np.arange(n_ev), "k": rng.choice(keys, n_ev),
                           "t": pd.to_datetime(ev_t)})
    obs = pd.DataFrame({"oid": np.arange(1000, 1000 + n_ob), "k": rng.choice(keys, n_ob),
                        "t": pd.to_datetime(ob_t),
                        "loaded": pd.to_datetime(base + rng.integers(0, 3, n_ob).astype("timedelta64[D]"))})
    expect = _brute(events, obs, 1.5)
    ev = spark.createDataFrame([(int(a), b, c.to_pydatetime()) for a, b, c in events.itertuples(index=False)],
                               "eid long, k string, t timestamp")
    ob = spark.createDataFrame([(int(a), b, c.to_pydatetime(), d.to_pydatetime())
                                for a, b, c, d in obs.itertuples(index=False)],
                               "oid long, k string, t timestamp, loaded timestamp")
    kw = dict(key="k", event_time="t", obs_time="t", window_hours=1.5, carry=["oid"],
              prefer=["loaded"], obs_key="oid")
    w = {r["eid"]: r["obs_oid"] for r in nearest_asof(ev, ob, **kw).collect()}
    c = {r["eid"]: r["obs_oid"] for r in nearest_asof_candidates(ev, ob, event_id="eid", **kw).collect()}
    # small buckets force many bucket edges and replicated observations
    s = {r["eid"]: r["obs_oid"] for r in nearest_asof(ev, ob, bucket_hours=3.0, **kw).collect()}
    # salting: hot (key, bucket) groups split over sub-partitions, and all groups salted
    h = {r["eid"]: r["obs_oid"] for r in nearest_asof(ev, ob, salt=3, hot_threshold=20, **kw).collect()}
    a = {r["eid"]: r["obs_oid"] for r in nearest_asof(ev, ob, salt=4, **kw).collect()}
    jb = nearest_asof(ev, ob.withColumn("wide", F.concat(F.lit("w"), F.col("oid").cast("string"))),
                      join_back=True, **{**kw, "carry": ["oid", "wide"]}).collect()
    assert {r["eid"]: r["obs_oid"] for r in jb} == expect
    assert all(r["obs_wide"] == (None if r["obs_oid"] is None else f"w{r['obs_oid']}") for r in jb)
    assert w == expect
    assert c == expect
    assert s == expect
    assert h == expect
    assert a == expect
    ex = {r["eid"]: r["has_obs_in_window"] for r in exists_in_window(
        ev, ob, key="k", event_time="t", obs_time="t", window_hours=1.5).collect()}
    assert ex == {k: v is not None for k, v in expect.items()}


def test_window_form_plan_has_no_candidate_join(spark):
    ev, ob = _frames(spark, [(1, "A", T0)], [(10, "A", m(-5), T0)])
    out = nearest_asof(ev, ob, key="k", event_time="t", obs_time="t", window_hours=2,
                       carry=["oid"], obs_key="oid")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # one shuffle for the whole operator: events and observations together on (key, bucket)
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert out.filter(F.col("match_status") == "matched").count() == 1


def _hot_frames(spark, seed=3):
    """Half of all rows on one key, within one day; a burst of events and observations at one time."""
    rng = np.random.default_rng(seed)
    base = datetime(2025, 3, 1)
    n = 1200
    key = lambda: "HOT" if rng.random() < 0.5 else f"k{rng.integers(6)}"
    at = lambda k: base + timedelta(seconds=int(rng.integers(0, 86400 if k == "HOT" else 5 * 86400)))
    events, obs = [], []
    for i in range(n):
        k = key()
        events.append((i, k, base + timedelta(hours=9) if i % 5 == 0 else at(k)))
        k = key()
        obs.append((5000 + i, k, base + timedelta(hours=int(rng.integers(7, 11))) if i % 6 == 0 else at(k), base + timedelta(days=int(rng.integers(2)))))
    return events, [o for o in obs if not (o[1] == "HOT" and 14 <= o[2].hour < 19)]


def test_hot_group_is_cut_into_slices(spark):
    events, obs = _hot_frames(spark)
    want = _brute(pd.DataFrame(events, columns=["eid", "k", "t"]), pd.DataFrame(obs, columns=["oid", "k", "t", "loaded"]), 2.0)
    ev, ob = _frames(spark, [*events, (9998, None, T0), (9999, "none", T0)], obs)
    kw = dict(key="k", event_time="t", obs_time="t", window_hours=2.0, carry=["oid", "loaded"], prefer=["loaded"], obs_key="oid")
    for rows in (25, 90, 400, 10_000):
        got = {r.eid: r.obs_oid for r in nearest_asof(ev, ob, split_rows=rows, **kw).collect()}
        assert got == want | {9998: None, 9999: None}, rows
    back = {r.eid: (r.obs_oid, r.obs_loaded) for r in nearest_asof(ev, ob, split_rows=60, join_back=True, **kw).collect()}
    loaded = {o[0]: o[3] for o in obs}
    assert back == {k: (v, loaded.get(v)) for k, v in (want | {9998: None, 9999: None}).items()}
    flags = {r.eid: r.has_obs_in_window for r in exists_in_window(ev, ob, key="k", event_time="t", obs_time="t", window_hours=2.0, split_rows=50).collect()}
    assert flags == {k: v is not None for k, v in (want | {9998: None, 9999: None}).items()}


def test_slices_bound_the_largest_group(spark):
    from nearcast.operators import asof
    events, obs = _hot_frames(spark)
    ev, ob = _frames(spark, events, obs)
    n_us, bucket = 2 * 3_600_000_000, 86_400_000_000
    kind = ev.select(F.struct("eid", "k", "t")).schema[0].dataType
    o = asof._obs_rows(ob, "k", "t", ["oid"], ["loaded"], "oid", n_us, bucket, kind)
    us = F.unix_micros("t")
    e = ev.select(F.col("k").alias("__k"), F.floor(us / bucket).cast("long").alias("__b"), us.alias("__t"), F.lit(1).alias("__side"),
                  F.lit(None).cast(o.schema["__r"].dataType).alias("__r"), F.struct("eid", "k", "t").alias("__e"),
                  F.lit(None).cast(o.schema["__ob"].dataType).alias("__ob"))
    largest = lambda e, o: e.unionByName(o).groupBy("__k", "__b", "__s").count().agg(F.max("count")).first()[0]
    whole = largest(e.withColumn("__s", F.lit(0)), o.withColumn("__s", F.lit(0)))
    sliced = asof._sliced(e, o, 60)
    assert whole > 900 and largest(*sliced) <= 2 * 60
    # no observation is in two slices of a group but the two at the edges of each
    copies = sliced[1].filter("__k = 'HOT'").count()
    slices = asof.hot_slices(e, o, 60).filter("__k = 'HOT'").agg(F.sum(F.size("__bounds") + 1)).first()[0]
    assert copies <= o.filter("__k = 'HOT'").count() + 2 * slices
    assert asof.hot_slices(e, o, 10_000) is None


def test_no_hot_group_keeps_the_single_shuffle(spark):
    ev, ob = _frames(spark, [(1, "A", T0)], [(10, "A", m(-5), T0)])
    out = nearest_asof(ev, ob, key="k", event_time="t", obs_time="t", window_hours=2, carry=["oid"], obs_key="oid", split_rows=1000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
