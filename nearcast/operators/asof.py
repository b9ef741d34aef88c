"""Nearest observation within +/- N hours per key.

For each left row ("event", e.g. a departure) find the observation of the
same key whose time is closest to the event time, within a closed window of
``window_hours``. Ties: smaller |delta| first, then an observation at or
before the event beats one after it, then the preferred duplicate
(``prefer`` columns, descending - e.g. latest load), then a total order.
Every left row is kept (left join-back); rows without a match get status
``no_obs_in_window``.

Default plan (``nearest_asof``), linear in the input, no candidate pairs:

1. Time buckets of width B >= 2N. Each left row gets one bucket; each
   observation is copied to every bucket its [t-N, t+N] span touches (at most
   2 when B >= 2N, ~17 % extra rows for B = 1 day, N = 2 h). The shuffle key
   is (key, bucket), so one hot key is spread over its days instead of one task.
2. Union left rows and observations (one shuffle on (key, bucket)); in each
   partition take the last observation at or before the row (ascending
   running frame, observations before events at equal time) and the last
   observation strictly after it (descending running frame). Both frames are
   O(n) running aggregates over one sort each. Observations at equal time are
   ordered by preference, so the preferred duplicate is the one taken.
3. Compare the two deltas, keep the winner if within N.

Cross-check plan (``nearest_asof_candidates``): bucketed equi-join with the
closed range predicate, then ``min_by`` per left row over a struct ranking
key - the direct rendering of the row_number rule. It emits all candidate
pairs inside the window, so it is the test oracle, not the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearcast.session import materialize

MATCHED = "matched"
UNMATCHED = "no_obs_in_window"

_US_PER_HOUR = 3_600_000_000


def _bucket_micros(window_hours: float, bucket_hours: float | None) -> int:
    n = int(round(window_hours * _US_PER_HOUR))
    b = int(round((bucket_hours if bucket_hours else max(24.0, 2 * window_hours)) * _US_PER_HOUR))
    return max(b, 1, n)


def _obs_rows(obs: DataFrame, key: str, time: str, carry: list[str], prefer: list[str],
              obs_key: str | None, n_us: int, bucket: int, ev_type) -> DataFrame:
    """Observation rows of the union, copied to every bucket their closed window touches."""
    o = obs.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    t = F.unix_micros(F.col(time))
    # preference among observations at the same time: larger is preferred
    rank = F.struct(*[F.col(c) for c in prefer], *([F.col(obs_key)] if obs_key else []), F.lit(0).alias("__z"))
    lo = F.floor((t - F.lit(n_us)) / F.lit(bucket)).cast("long")
    hi = F.floor((t + F.lit(n_us)) / F.lit(bucket)).cast("long")
    return o.select(F.col(key).alias("__k"), F.explode(F.sequence(lo, hi)).alias("__b"), t.alias("__t"),
                    F.lit(0).alias("__side"), rank.alias("__r"), F.lit(None).cast(ev_type).alias("__e"),
                    F.struct(t.alias("t"), F.struct(*[F.col(c).alias(c) for c in carry]).alias("p")).alias("__ob"))


def nearest_asof(events: DataFrame, obs: DataFrame, *, key: str, event_time: str,
                 obs_time: str, window_hours: float, carry: list[str] | None = None,
                 prefer: list[str] | None = None, obs_key: str | None = None,
                 prefix: str = "obs_", status_col: str = "match_status",
                 lag_col: str = "lag_minutes", bucket_hours: float | None = None,
                 keep_unmatchable: bool = False, spread_buckets: int = 4096,
                 salt: int = 1, hot_threshold: int | None = None,
                 split_rows: int | None = None, join_back: bool = False) -> DataFrame:
    """Nearest-observation as-of join, window form (J6 + J7).

    ``events`` keep all their columns. Output adds ``{prefix}ts`` (the matched
    observation time), one ``{prefix}{c}`` per ``carry`` column, the status
    and the signed lag in minutes (event time - observation time; positive =
    observation before the event).

    Observations at the same time are ordered by ``prefer`` then ``obs_key``
    (ascending) inside both windows, so the preferred one is met last in
    either direction - the duplicate rule needs no extra aggregation.

    Rows with a null key cannot match and are kept as unmatched; rows with a
    null event time are dropped (the reference) unless ``keep_unmatchable``.
    Such rows get a null key and one of ``spread_buckets`` hash buckets, so
    they travel through the same single shuffle without forming a hot key.

    Skew: with ``salt`` > 1, the events of a hot (key, bucket) - more than
    ``hot_threshold`` events, found by a map-side pre-aggregated count; all
    pairs when no threshold is given - are split over ``salt`` sub-partitions
    by a hash of the event, and that pair's observations are copied to each
    sub-partition, so every sub-partition still sees every candidate and the
    result is unchanged.

    With ``split_rows``, a (key, bucket) with more rows than that, events and
    observations together, is cut into time slices of about as many rows
    (``_sliced``): both sides are split, no observation is copied, and the
    result is unchanged. Finding hot groups is one counted job; without one,
    the plan is the single shuffle above.

    ``join_back=True`` carries only the observation's identity (time, the
    ``prefer`` columns and ``obs_key``) through the union and both window
    sorts, and equi-joins the wide ``carry`` columns back afterwards on
    (key, time, identity) - cheaper when observation rows are wide. It needs
    observations unique per (key, time, prefer, obs_key), as after W1.
    """
    carry = list(carry if carry is not None else [c for c in obs.columns if c not in (key, obs_time)])
    prefer = list(prefer or [])
    if obs_key and obs_key not in carry:
        carry.append(obs_key)
    if join_back:
        ident = [c for c in prefer + ([obs_key] if obs_key else []) if c]
        out = nearest_asof(events, obs, key=key, event_time=event_time, obs_time=obs_time,
                           window_hours=window_hours, carry=ident, prefer=prefer, obs_key=obs_key,
                           prefix="__jb_", status_col=status_col, lag_col=lag_col,
                           bucket_hours=bucket_hours, keep_unmatchable=keep_unmatchable,
                           spread_buckets=spread_buckets, salt=salt, hot_threshold=hot_threshold, split_rows=split_rows)
        on = ["__jb_ts"] + [f"__jb_{c}" for c in ident]
        # one row per identity, so an event stays one row; an observation without key or time matches nothing
        wide = (obs.filter(F.col(key).isNotNull() & F.col(obs_time).isNotNull())
                .select(F.col(key).alias("__jb_k"), F.col(obs_time).alias("__jb_ts"),
                        *[F.col(c).alias(f"__jb_{c}") for c in ident],
                        *[F.col(c).alias(f"{prefix}{c}") for c in carry if c not in ident])
                .dropDuplicates(["__jb_k", *on]).withColumn("__jb_part", F.lit(0).cast("long")))
        # unmatched events join nothing; spread over parts of their own they form no hot group
        part = F.when(F.col(status_col) == F.lit(MATCHED), F.lit(0).cast("long")) \
            .otherwise(1 + F.pmod(F.xxhash64(F.col(event_time), F.monotonically_increasing_id()), F.lit(4096)))
        out = out.withColumn("__jb_left", part)
        cond = [out["__jb_left"] == wide["__jb_part"], out[key].eqNullSafe(wide["__jb_k"])] \
            + [out[c].eqNullSafe(wide[c]) for c in on]
        j = out.join(wide, cond, "left").drop(wide["__jb_ts"]).drop(*[wide[c] for c in on[1:]])
        j = j.drop("__jb_k", "__jb_part", "__jb_left")
        ren = {"__jb_ts": f"{prefix}ts", **{f"__jb_{c}": f"{prefix}{c}" for c in ident}}
        for a, b in ren.items():
            j = j.withColumnRenamed(a, b)
        cols = list(events.columns) + [status_col, f"{prefix}ts"] + [f"{prefix}{c}" for c in carry] + [lag_col]
        return j.select(*cols)
    bucket = _bucket_micros(window_hours, bucket_hours)
    n_us = int(round(window_hours * _US_PER_HOUR))
    ev_cols = events.columns
    ev_struct = F.struct(*[F.col(c) for c in ev_cols])
    ev_type = events.select(ev_struct).schema[0].dataType

    o = _obs_rows(obs, key, obs_time, carry, prefer, obs_key, n_us, bucket, ev_type)

    ev = events if keep_unmatchable else events.filter(F.col(event_time).isNotNull())
    matchable = F.col(key).isNotNull() & F.col(event_time).isNotNull()
    ev_t = F.unix_micros(F.col(event_time))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in ev_cols]), F.lit(spread_buckets))
    e = ev.select(F.when(matchable, F.col(key)).alias("__k"),
                  F.when(matchable, F.floor(ev_t / F.lit(bucket)).cast("long")).otherwise(spread).alias("__b"),
                  ev_t.alias("__t"), F.lit(1).alias("__side"),
                  F.lit(None).cast(o.schema["__r"].dataType).alias("__r"),
                  ev_struct.alias("__e"), F.lit(None).cast(o.schema["__ob"].dataType).alias("__ob"))

    if split_rows:
        e, o = _sliced(e, o, split_rows)
    elif salt > 1:
        e, o = _salt(e, o, salt, hot_threshold)
    else:
        e, o = e.withColumn("__s", F.lit(0)), o.withColumn("__s", F.lit(0))
    u = e.unionByName(o)
    part = Window.partitionBy("__k", "__b", "__s")
    w_back = part.orderBy(F.col("__t").asc(), F.col("__side").asc(), F.col("__r").asc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_fwd = part.orderBy(F.col("__t").desc(), F.col("__side").desc(), F.col("__r").asc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = (u.withColumn("__prev", F.last("__ob", ignorenulls=True).over(w_back))
          .withColumn("__next", F.last("__ob", ignorenulls=True).over(w_fwd))
          .filter(F.col("__side") == 1))

    d_prev = F.col("__t") - F.col("__prev.t")
    d_next = F.col("__next.t") - F.col("__t")
    prev_ok = F.col("__k").isNotNull() & F.col("__prev").isNotNull() & (d_prev <= F.lit(n_us))
    next_ok = F.col("__k").isNotNull() & F.col("__next").isNotNull() & (d_next <= F.lit(n_us))
    best = (F.when(prev_ok & (~next_ok | (d_prev <= d_next)), F.col("__prev"))
            .when(next_ok, F.col("__next")))
    out = u.select(*[F.col(f"__e.{c}").alias(c) for c in ev_cols], best.alias("__best"))
    return _finish(out, ev_cols, carry, prefix, status_col, lag_col, event_time)


def hot_slices(e: DataFrame, o: DataFrame, split_rows: int) -> DataFrame | None:
    """__k, __b, __bounds of the groups with more than ``split_rows`` rows; None if there are none.

    The bounds are times that cut a group into slices of about ``split_rows``
    rows, from Spark's mergeable quantile sketch. There are at most (all rows /
    ``split_rows``) hot groups and twice as many bounds.
    """
    from nearcast.operators.dims import bounded_broadcast
    times = e.filter(F.col("__k").isNotNull()).select("__k", "__b", "__t").unionByName(o.select("__k", "__b", "__t"))
    sizes = times.groupBy("__k", "__b").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > split_rows)
    sizes = materialize(sizes)
    most = sizes.agg(F.max("__n")).first()[0]
    if most is None:
        return None
    cuts = -(-most // split_rows)  # slices of the largest group
    found = times.join(bounded_broadcast(sizes), ["__k", "__b"]).groupBy("__k", "__b").agg(
        F.first("__n").alias("__n"), F.percentile_approx("__t", [i / cuts for i in range(1, cuts)], 20 * cuts).alias("__all"))
    slices = F.ceil(F.col("__n") / F.lit(split_rows)).cast("int")

    def bound(i: Column) -> Column:
        return F.get("__all", (F.floor(i * F.lit(cuts) / slices) - 1).cast("int"))
    return materialize(found.select("__k", "__b", F.transform(F.sequence(F.lit(1), slices - 1), bound).alias("__bounds")))


def _sliced(e: DataFrame, o: DataFrame, split_rows: int):
    """Cut hot (key, bucket) groups into time slices; no observation is copied to another slice's rows.

    A row's slice is the number of bounds before its time. Nearness needs of
    the other slices only the last observation before a slice and the first
    one after it; these two are added to every slice, from a table with a row
    per slice. Many events at one time have equal bounds; they are dealt over
    the slices between these, which see the observations of that time as the
    last ones before. Of observations at one time, the preferred one is kept.
    """
    from nearcast.operators.dims import bounded_broadcast
    hot = hot_slices(e, o, split_rows)
    none = F.lit(0)
    if hot is None:
        return e.withColumn("__s", none), o.withColumn("__s", none)
    bounds = bounded_broadcast(hot)
    below = F.size(F.filter("__bounds", lambda x: x < F.col("__t")))
    upto = F.size(F.filter("__bounds", lambda x: x <= F.col("__t")))
    dealt = below + F.pmod(F.xxhash64("__e"), (upto - below + 1).cast("long")).cast("int")
    e = e.join(bounds, ["__k", "__b"], "left").withColumn("__s", F.when(F.col("__bounds").isNull(), none).otherwise(dealt)).drop("__bounds")
    o = o.join(bounds, ["__k", "__b"], "left")
    cold = o.filter(F.col("__bounds").isNull()).withColumn("__s", none).drop("__bounds")
    split = o.filter(F.col("__bounds").isNotNull()).withColumn("__s", below) \
        .groupBy("__k", "__b", "__s", "__t").agg(F.max("__r").alias("__r"), F.max_by("__ob", "__r").alias("__ob"))
    ends = split.groupBy("__k", "__b", "__s").agg(F.min_by("__ob", "__t").alias("__first"), F.max_by("__ob", "__t").alias("__last"))
    every = hot.select("__k", "__b", F.explode(F.sequence(none, F.size("__bounds"))).alias("__s")).join(ends, ["__k", "__b", "__s"], "left")
    order = Window.partitionBy("__k", "__b").orderBy("__s")
    before = F.last("__last", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("__first", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    both = every.select("__k", "__b", "__s", F.array(before, after).alias("__two"))
    edge = both.select("__k", "__b", "__s", F.explode("__two").alias("__ob")).filter(F.col("__ob").isNotNull())
    kinds = {f.name: f.dataType for f in cold.schema}
    rows = [split.withColumn("__side", none).withColumn("__e", F.lit(None).cast(kinds["__e"])),
            edge.withColumns({"__t": F.col("__ob.t"), "__side": none, "__r": F.lit(None).cast(kinds["__r"]), "__e": F.lit(None).cast(kinds["__e"])})]
    for r in rows:
        cold = cold.unionByName(r.select(*cold.columns))
    return e, cold


def _salt(e: DataFrame, o: DataFrame, salt: int, hot_threshold: int | None):
    """Split hot (key, bucket) groups over ``salt`` sub-partitions (events hashed, observations copied)."""
    from nearcast.operators.dims import bounded_broadcast
    ev_salt = F.pmod(F.xxhash64(F.col("__e")), F.lit(salt)).cast("int")
    if hot_threshold is None:
        e = e.withColumn("__s", F.when(F.col("__k").isNotNull(), ev_salt).otherwise(F.lit(0)))
        o = o.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        return e, o
    hot = (e.filter(F.col("__k").isNotNull()).groupBy("__k", "__b").count()
           .filter(F.col("count") > hot_threshold).select("__k", "__b", F.lit(True).alias("__hot")))
    # at most (#events / hot_threshold) pairs; broadcast only behind the size check
    hot = bounded_broadcast(hot)
    e = e.join(hot, ["__k", "__b"], "left") \
        .withColumn("__s", F.when(F.col("__hot"), ev_salt).otherwise(F.lit(0))).drop("__hot")
    o = o.join(hot, ["__k", "__b"], "left") \
        .withColumn("__s", F.explode(F.sequence(F.lit(0), F.when(F.col("__hot"), F.lit(salt - 1))
                                                .otherwise(F.lit(0))))).drop("__hot")
    return e, o


def _finish(df: DataFrame, ev_cols: list[str], carry: list[str], prefix: str,
            status_col: str, lag_col: str, event_time: str) -> DataFrame:
    matched = F.col("__best").isNotNull()
    obs_ts = F.timestamp_micros(F.col("__best.t"))
    cols: list[Column] = [F.col(c) for c in ev_cols]
    cols.append(F.when(matched, F.lit(MATCHED)).otherwise(F.lit(UNMATCHED)).alias(status_col))
    cols.append(obs_ts.alias(f"{prefix}ts"))
    cols += [F.col(f"__best.p.{c}").alias(f"{prefix}{c}") for c in carry]
    cols.append(F.when(matched, (F.unix_micros(F.col(event_time)) - F.col("__best.t"))
                       / F.lit(60_000_000.0)).alias(lag_col))
    return df.select(*cols)


def nearest_asof_candidates(events: DataFrame, obs: DataFrame, *, key: str, event_time: str,
                            obs_time: str, window_hours: float, event_id: str,
                            carry: list[str] | None = None, prefer: list[str] | None = None,
                            obs_key: str | None = None, prefix: str = "obs_",
                            status_col: str = "match_status", lag_col: str = "lag_minutes",
                            bucket_hours: float | None = None) -> DataFrame:
    """Cross-check form: bucketed range join + ``min_by`` per event (J5 + J6).

    ``event_id`` must be unique on ``events``. Buckets default to the window
    width N, and observations are copied to the buckets their +/- N span
    touches (at most 3). An event therefore meets only observations within
    N + one bucket of itself, about 1.5x the in-window candidates the
    reference ranks, never all pairs of a key. The range predicate keeps the
    in-window ones, and ``min_by`` combines map-side.
    """
    carry = list(carry if carry is not None else [c for c in obs.columns if c not in (key, obs_time)])
    prefer = list(prefer or [])
    if obs_key and obs_key not in carry:
        carry.append(obs_key)
    bucket = _bucket_micros(window_hours, bucket_hours if bucket_hours else window_hours)
    n_us = int(round(window_hours * _US_PER_HOUR))

    o = (obs.filter(F.col(key).isNotNull() & F.col(obs_time).isNotNull())
         .select(F.col(key).alias("__k"), F.unix_micros(F.col(obs_time)).alias("__ot"),
                 *[F.col(c).alias(f"__p_{c}") for c in prefer],
                 F.struct(*[F.col(c).alias(c) for c in carry]).alias("__p")))
    o = o.withColumn("__b", F.explode(F.sequence(
        F.floor((F.col("__ot") - F.lit(n_us)) / F.lit(bucket)).cast("long"),
        F.floor((F.col("__ot") + F.lit(n_us)) / F.lit(bucket)).cast("long"))))
    ev = (events.filter(F.col(key).isNotNull() & F.col(event_time).isNotNull())
          .select(F.col(event_id).alias("__id"), F.col(key).alias("__k"),
                  F.unix_micros(F.col(event_time)).alias("__et")))
    ev = ev.withColumn("__b", F.floor(F.col("__et") / F.lit(bucket)).cast("long"))
    cand = ev.join(o, ["__k", "__b"]).filter(
        (F.col("__ot") >= F.col("__et") - F.lit(n_us)) & (F.col("__ot") <= F.col("__et") + F.lit(n_us)))
    # the greatest of: nearness, not after the event, then the preference columns and the key as they are
    liked = [F.col(f"__p_{c}") for c in prefer] + ([F.col("__p")[obs_key]] if obs_key else [])
    rank = F.struct((-F.abs(F.col("__ot") - F.col("__et"))).alias("d"),
                    F.when(F.col("__ot") <= F.col("__et"), 1).otherwise(0).alias("a"),
                    *[c.alias(f"x{i}") for i, c in enumerate(liked)])
    best = cand.groupBy("__id").agg(
        F.max_by(F.struct(F.col("__ot").alias("t"), F.col("__p").alias("p")),
                 rank).alias("__best"))
    out = events.filter(F.col(event_time).isNotNull()).join(
        best, events[event_id] == best["__id"], "left").drop("__id")
    return _finish(out, events.columns, carry, prefix, status_col, lag_col, event_time)


def exists_in_window(events: DataFrame, obs: DataFrame, *, key: str, event_time: str,
                     obs_time: str, window_hours: float, flag: str = "has_obs_in_window",
                     bucket_hours: float | None = None, split_rows: int | None = None) -> DataFrame:
    """Boolean per event: is there any observation within the closed window (J8)?

    Derived from the window-form nearest match (a match exists iff the nearest
    one is within N), so no candidate pairs are produced.
    """
    nn = nearest_asof(events, obs.select(key, obs_time), key=key, event_time=event_time,
                      obs_time=obs_time, window_hours=window_hours, carry=[],
                      status_col="__status", lag_col="__lag", prefix="__o_",
                      bucket_hours=bucket_hours, keep_unmatchable=True, split_rows=split_rows)
    return nn.withColumn(flag, F.col("__status") == F.lit(MATCHED)) \
        .drop("__status", "__lag", "__o_ts")
