"""DuckDB SQL for every registered query: the independent correctness oracle.

Written from the reference's SQL semantics (row_number ranking, filtered
counts, UNION ALL of separate group-bys) rather than from the Spark plans,
so a planning mistake in Spark shows up as a mismatch.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# ------------------------------------------------------------ shared CTEs

NEAREST = """
f AS (SELECT event_id, user_id, ts, value FROM events
      WHERE event_type = 'purchase' AND ts IS NOT NULL),
o AS (SELECT user_id, ts AS o_ts, event_id AS o_id, event_type AS o_type, value AS o_value
      FROM events WHERE event_type IN ('click', 'view')),
cand AS (
  SELECT f.event_id, o.o_ts, o.o_id, o.o_type, o.o_value,
         row_number() OVER (PARTITION BY f.event_id
                            ORDER BY abs(epoch_us(o.o_ts) - epoch_us(f.ts)),
                                     CASE WHEN o.o_ts <= f.ts THEN 0 ELSE 1 END,
                                     o.o_id DESC) AS rn
  FROM f JOIN o ON o.user_id = f.user_id
   AND o.o_ts >= f.ts - INTERVAL 6 HOUR AND o.o_ts <= f.ts + INTERVAL 6 HOUR),
nn AS (
  SELECT f.event_id, f.user_id, f.ts, f.value,
         CASE WHEN c.o_ts IS NOT NULL THEN 'matched' ELSE 'no_obs_in_window' END AS match_status,
         c.o_ts AS obs_ts, c.o_id AS obs_event_id, c.o_type AS obs_event_type,
         c.o_value AS obs_value,
         (epoch_us(f.ts) - epoch_us(c.o_ts)) / 60000000.0 AS lag_minutes
  FROM f LEFT JOIN cand c ON c.event_id = f.event_id AND c.rn = 1),
fact AS (
  SELECT nn.*, CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour,
         strftime(ts, '%Y-%m') AS year_month, match_status = 'matched' AS is_matched
  FROM nn)
"""

KEY_HOUR = """
key_hour AS (
  SELECT event_type, CAST(hour(ts) AS INTEGER) AS event_hour,
         count(*) AS flight_count,
         count(*) FILTER (WHERE value >= 75) AS delayed_count,
         round(CAST(count(*) FILTER (WHERE value >= 75) AS DOUBLE) / NULLIF(count(*), 0), 4)
           AS delay_rate_15,
         round(avg(value), 2) AS avg_dep_delay_minutes
  FROM events GROUP BY 1, 2)
"""

ORDER_LINES = """
ol AS (
  SELECT l.l_returnflag, l.l_quantity, l.l_discount, l.l_tax,
         o.o_orderpriority, o.o_orderstatus,
         datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS ship_delay_days
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
"""

MEASURES_SQL = """
         count(*) AS flight_count,
         count(*) FILTER (WHERE ship_delay_days >= 15) AS delayed_count,
         round(CAST(count(*) FILTER (WHERE ship_delay_days >= 15) AS DOUBLE)
               / NULLIF(count(*), 0), 4) AS delay_rate_15,
         round(avg(ship_delay_days), 2) AS avg_dep_delay_minutes
"""

ROUTE = f"""
route AS (
  SELECT l_returnflag, o_orderpriority, o_orderstatus, {MEASURES_SQL}
  FROM ol GROUP BY 1, 2, 3)
"""

BUCKETS = f"""
bucketed AS (
  SELECT l_returnflag AS origin,
         CASE WHEN l_quantity IS NULL THEN 'unknown' WHEN l_quantity <= 5 THEN 'calm_0_5kt'
              WHEN l_quantity <= 15 THEN 'light_6_15kt' WHEN l_quantity <= 25 THEN 'moderate_16_25kt'
              ELSE 'strong_26plus_kt' END AS wind_speed_bucket,
         CASE WHEN coalesce(l_discount * 4, 0) = 0 THEN 'none' WHEN l_discount * 4 <= 0.1 THEN 'light'
              WHEN l_discount * 4 <= 0.3 THEN 'moderate' ELSE 'heavy' END AS precip_bucket,
         CASE WHEN l_tax * 100 IS NULL THEN 'unknown' WHEN l_tax * 100 < 3 THEN 'low_under_3mi'
              WHEN l_tax * 100 <= 10 THEN 'medium_3_10mi' ELSE 'high_over_10mi' END AS visibility_bucket,
         ship_delay_days
  FROM ol),
buckets AS (
  SELECT origin, wind_speed_bucket, precip_bucket, visibility_bucket, {MEASURES_SQL}
  FROM bucketed GROUP BY 1, 2, 3, 4)
"""

ROLLUP_MEASURES = """
         CAST(sum(flight_count) AS BIGINT) AS flight_count,
         CAST(sum(delayed_count) AS BIGINT) AS delayed_count,
         round(CAST(sum(delayed_count) AS DOUBLE) / NULLIF(CAST(sum(flight_count) AS DOUBLE), 0), 4)
           AS delay_rate_15,
         round(sum(avg_dep_delay_minutes * flight_count) / NULLIF(CAST(sum(flight_count) AS DOUBLE), 0), 2)
           AS avg_dep_delay_minutes
"""

# ------------------------------------------------------------ joins

ORACLE["nearest_asof"] = f"""
WITH {NEAREST}
SELECT event_id, user_id, ts, value, match_status, obs_ts, obs_event_id, obs_event_type,
       obs_value, round(lag_minutes, 8) AS lag_minutes
FROM nn
"""

ORACLE["nearest_asof_minby"] = ORACLE["nearest_asof"]

ORACLE["nearest_asof_hot"] = """
WITH f AS (SELECT event_id, user_id % 4 AS station, ts FROM events WHERE event_type = 'purchase' AND ts IS NOT NULL),
o AS (SELECT user_id % 4 AS station, ts AS o_ts, event_id AS o_id FROM events WHERE event_type IN ('click', 'view')),
cand AS (
  SELECT f.event_id, o.o_ts, o.o_id,
         row_number() OVER (PARTITION BY f.event_id ORDER BY abs(epoch_us(o.o_ts) - epoch_us(f.ts)),
                            CASE WHEN o.o_ts <= f.ts THEN 0 ELSE 1 END, o.o_id DESC) AS rn
  FROM f JOIN o ON o.station = f.station AND o.o_ts >= f.ts - INTERVAL 6 HOUR AND o.o_ts <= f.ts + INTERVAL 6 HOUR)
SELECT f.event_id, f.station, CASE WHEN c.o_ts IS NOT NULL THEN 'matched' ELSE 'no_obs_in_window' END AS match_status,
       c.o_ts AS obs_ts, c.o_id AS obs_event_id, round((epoch_us(f.ts) - epoch_us(c.o_ts)) / 60000000.0, 8) AS lag_minutes
FROM f LEFT JOIN cand c ON c.event_id = f.event_id AND c.rn = 1
"""

ORACLE["exists_in_window"] = """
SELECT f.event_id, f.user_id, f.ts, f.value,
       EXISTS (SELECT 1 FROM events o
               WHERE o.event_type IN ('click', 'view') AND o.user_id = f.user_id
                 AND o.ts >= f.ts - INTERVAL 6 HOUR AND o.ts <= f.ts + INTERVAL 6 HOUR)
         AS has_obs_in_window
FROM events f WHERE f.event_type = 'purchase'
"""

# ------------------------------------------------------------ aggregates

ORACLE["delay_by_key_hour"] = f"WITH {KEY_HOUR} SELECT * FROM key_hour"

ORACLE["delay_by_route"] = f"WITH {ORDER_LINES}, {ROUTE} SELECT * FROM route"

ORACLE["delay_by_buckets"] = f"WITH {ORDER_LINES}, {BUCKETS} SELECT * FROM buckets"

ORACLE["rollup_weighted"] = f"""
WITH {KEY_HOUR}
SELECT event_type, {ROLLUP_MEASURES} FROM key_hour GROUP BY event_type
"""

ORACLE["pooled_dimensions"] = f"""
WITH {ORDER_LINES}, {BUCKETS},
by_wind AS (SELECT 'pooled_wind' AS report, wind_speed_bucket AS bucket_value,
                   NULL::VARCHAR AS origin, {ROLLUP_MEASURES}, NULL::BIGINT AS rank
            FROM buckets GROUP BY wind_speed_bucket),
by_precip AS (SELECT 'pooled_precip' AS report, precip_bucket AS bucket_value,
                     NULL::VARCHAR AS origin, {ROLLUP_MEASURES}, NULL::BIGINT AS rank
              FROM buckets GROUP BY precip_bucket),
by_vis AS (SELECT 'pooled_visibility' AS report, visibility_bucket AS bucket_value,
                  NULL::VARCHAR AS origin, {ROLLUP_MEASURES}, NULL::BIGINT AS rank
           FROM buckets GROUP BY visibility_bucket),
worst AS (
  SELECT 'worst_weather_combo' AS report,
         wind_speed_bucket || ' | ' || precip_bucket || ' | ' || visibility_bucket AS bucket_value,
         origin, flight_count, delayed_count, delay_rate_15, avg_dep_delay_minutes,
         row_number() OVER (ORDER BY delay_rate_15 DESC NULLS FIRST, flight_count DESC NULLS FIRST,
                                     origin, bucket_value) AS rank
  FROM buckets WHERE flight_count >= 50)
SELECT * FROM by_wind UNION ALL SELECT * FROM by_precip UNION ALL SELECT * FROM by_vis
UNION ALL SELECT * FROM worst WHERE rank <= 10
"""

ORACLE["top_reports"] = f"""
WITH {KEY_HOUR},
per_key AS (SELECT event_type, NULL::INTEGER AS event_hour, {ROLLUP_MEASURES}
            FROM key_hour GROUP BY event_type),
r1 AS (SELECT 'top_delay_rate' AS report, *, row_number() OVER (
         ORDER BY delay_rate_15 DESC NULLS FIRST, flight_count DESC NULLS FIRST, event_type, event_hour) AS rank
       FROM key_hour WHERE flight_count >= 50),
r2 AS (SELECT 'top_avg_delay_minutes' AS report, *, row_number() OVER (
         ORDER BY avg_dep_delay_minutes DESC NULLS FIRST, flight_count DESC NULLS FIRST, event_type, event_hour) AS rank
       FROM key_hour WHERE flight_count >= 50),
r3 AS (SELECT 'busiest_hour' AS report, *, row_number() OVER (
         ORDER BY flight_count DESC NULLS FIRST, event_type, event_hour) AS rank
       FROM key_hour),
r4 AS (SELECT 'top_airport_delay_rate' AS report, *, row_number() OVER (
         ORDER BY delay_rate_15 DESC NULLS FIRST, flight_count DESC NULLS FIRST, event_type) AS rank
       FROM per_key WHERE flight_count >= 500)
SELECT * FROM r1 WHERE rank <= 10 UNION ALL SELECT * FROM r2 WHERE rank <= 10
UNION ALL SELECT * FROM r3 WHERE rank <= 10 UNION ALL SELECT * FROM r4 WHERE rank <= 10
"""

ORACLE["route_top"] = f"""
WITH {ORDER_LINES}, {ROUTE},
v AS (SELECT 'top_volume' AS report, *, row_number() OVER (
        ORDER BY flight_count DESC NULLS FIRST, l_returnflag, o_orderpriority, o_orderstatus) AS rank
      FROM route),
r AS (SELECT 'top_delay_rate' AS report, *, row_number() OVER (
        ORDER BY delay_rate_15 DESC NULLS FIRST, flight_count DESC NULLS FIRST,
                 l_returnflag, o_orderpriority, o_orderstatus) AS rank
      FROM route WHERE flight_count >= 50)
SELECT * FROM v WHERE rank <= 10 UNION ALL SELECT * FROM r WHERE rank <= 10
"""

# ------------------------------------------------------------ coverage / diagnostics

COVER_SQL = """
         count(*) AS flights,
         count(*) FILTER (WHERE is_matched) AS matched_flights,
         round(100.0 * CAST(count(*) FILTER (WHERE is_matched) AS DOUBLE)
               / NULLIF(CAST(count(*) AS DOUBLE), 0), 2) AS match_pct
"""

ORACLE["coverage_grains"] = f"""
WITH {NEAREST}
SELECT 'airport' AS grain, user_id, year_month, NULL::DATE AS event_date, NULL::INTEGER AS event_hour,
       {COVER_SQL} FROM fact GROUP BY user_id, year_month
UNION ALL
SELECT 'date', user_id, year_month, event_date, NULL::INTEGER, {COVER_SQL}
FROM fact GROUP BY user_id, year_month, event_date
UNION ALL
SELECT 'hour', user_id, year_month, NULL::DATE, event_hour, {COVER_SQL}
FROM fact GROUP BY user_id, year_month, event_hour
"""

ORACLE["coverage_overall"] = f"""
WITH {NEAREST},
a AS (SELECT 'airport' AS grain, CAST(user_id AS VARCHAR) AS user_key, year_month, {COVER_SQL}
      FROM fact GROUP BY user_id, year_month),
ov AS (SELECT 'overall' AS grain, 'ALL' AS user_key, year_month, {COVER_SQL}
       FROM fact GROUP BY year_month)
SELECT * FROM ov UNION ALL SELECT * FROM a
UNION ALL SELECT 'low_match_airport', user_key, year_month, flights, matched_flights, match_pct
FROM a WHERE match_pct < 50.0
"""

ORACLE["coverage_by_month"] = f"""
WITH {NEAREST}
SELECT 'month' AS grain, year_month, NULL::BIGINT AS user_id, {COVER_SQL} FROM fact GROUP BY year_month
UNION ALL
SELECT 'key_month', year_month, user_id, {COVER_SQL} FROM fact GROUP BY year_month, user_id
"""

ORACLE["unmatched_by_key"] = f"""
WITH {NEAREST},
g AS (SELECT user_id, count(*) AS flights, count(*) FILTER (WHERE NOT is_matched) AS unmatched_flights
      FROM fact GROUP BY user_id HAVING count(*) FILTER (WHERE NOT is_matched) > 0),
r AS (SELECT *, row_number() OVER (ORDER BY unmatched_flights DESC NULLS FIRST, user_id) AS rank FROM g)
SELECT * FROM r WHERE rank <= 10
"""

ORACLE["row_counts"] = f"""
WITH {NEAREST}
SELECT 'lineitem' AS table_name, count(*) AS row_count,
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS distinct_keys,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_keys
FROM lineitem
UNION ALL
SELECT 'orders', count(*), count(DISTINCT o_orderkey), count(*) - count(DISTINCT o_orderkey) FROM orders
UNION ALL
SELECT 'nearest', count(*), count(DISTINCT event_id), count(*) - count(DISTINCT event_id) FROM nn
"""

ORACLE["unmatched_by_date"] = f"""
WITH {NEAREST},
by_date AS (
  SELECT user_id, year_month, event_date, count(*) AS flights,
         count(*) FILTER (WHERE is_matched) AS matched_flights,
         count(*) FILTER (WHERE NOT is_matched) AS unmatched_flights,
         round(100.0 * CAST(count(*) FILTER (WHERE is_matched) AS DOUBLE) / NULLIF(CAST(count(*) AS DOUBLE), 0), 2)
           AS match_pct
  FROM fact GROUP BY user_id, year_month, event_date),
totals AS (
  SELECT 'airport_total' AS report, user_id, year_month, NULL::DATE AS event_date, count(*) AS flights,
         count(*) FILTER (WHERE is_matched) AS matched_flights,
         count(*) FILTER (WHERE NOT is_matched) AS unmatched_flights,
         round(100.0 * CAST(count(*) FILTER (WHERE is_matched) AS DOUBLE) / NULLIF(CAST(count(*) AS DOUBLE), 0), 2)
           AS match_pct
  FROM fact GROUP BY user_id, year_month)
SELECT * FROM totals
UNION ALL
SELECT 'worst_day', user_id, year_month, event_date, flights, matched_flights, unmatched_flights, match_pct
FROM by_date WHERE match_pct < 100
UNION ALL
SELECT 'sample_unmatched', user_id, year_month, event_date, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE
FROM (SELECT DISTINCT user_id, year_month, event_date FROM fact WHERE NOT is_matched
      ORDER BY event_date DESC, user_id LIMIT 20)
"""

ORACLE["lag_distribution"] = f"""
WITH {NEAREST},
m AS (SELECT obs_event_type, year_month, lag_minutes,
             CASE WHEN lag_minutes > 0 THEN 'obs_before_dep' WHEN lag_minutes = 0 THEN 'obs_at_dep'
                  WHEN lag_minutes < 0 THEN 'obs_after_dep' END AS obs_timing
      FROM fact WHERE match_status = 'matched' AND lag_minutes IS NOT NULL)
SELECT 'percentile' AS report, obs_event_type, year_month, NULL::VARCHAR AS bucket,
       count(*) AS matched_flights,
       round(min(lag_minutes), 2) AS lag_min, round(max(lag_minutes), 2) AS lag_max,
       round(avg(lag_minutes), 2) AS lag_avg,
       round(quantile_cont(lag_minutes, 0.5), 2) AS lag_p50,
       round(quantile_cont(lag_minutes, 0.9), 2) AS lag_p90,
       round(quantile_cont(lag_minutes, 0.99), 2) AS lag_p99,
       NULL::BIGINT AS obs_before_dep, NULL::BIGINT AS obs_at_dep, NULL::BIGINT AS obs_after_dep
FROM m GROUP BY obs_event_type, year_month
UNION ALL
SELECT 'timing_split', obs_event_type, year_month, NULL, count(*), NULL, NULL, NULL, NULL, NULL, NULL,
       count(*) FILTER (WHERE obs_timing = 'obs_before_dep'),
       count(*) FILTER (WHERE obs_timing = 'obs_at_dep'),
       count(*) FILTER (WHERE obs_timing = 'obs_after_dep')
FROM m GROUP BY obs_event_type, year_month
UNION ALL
SELECT 'histogram', obs_event_type, year_month,
       CASE WHEN lag_minutes >= 60 THEN 'lag_gte_60m' WHEN lag_minutes >= 30 THEN 'lag_30_to_60m'
            WHEN lag_minutes >= 10 THEN 'lag_10_to_30m' WHEN lag_minutes > 0 THEN 'lag_0_to_10m'
            WHEN lag_minutes = 0 THEN 'lag_0m' WHEN lag_minutes >= -10 THEN 'lag_neg_0_to_10m'
            WHEN lag_minutes >= -30 THEN 'lag_neg_10_to_30m' WHEN lag_minutes >= -60 THEN 'lag_neg_30_to_60m'
            ELSE 'lag_lt_neg_60m' END,
       count(*), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM m GROUP BY obs_event_type, year_month, 4
"""

ORACLE["dep_time_distribution"] = """
WITH e AS (
  SELECT event_type, ts,
         CASE WHEN ts < TIMESTAMP '1970-01-01' THEN 'before_1970'
              WHEN ts >= TIMESTAMP '2030-01-01' THEN 'after_2030'
              WHEN ts IS NULL THEN 'null_dep_time' ELSE 'ok' END AS dep_time_sanity
  FROM events)
SELECT 'sanity' AS report, event_type, dep_time_sanity, NULL::INTEGER AS event_hour, count(*) AS flights
FROM e GROUP BY event_type, dep_time_sanity
UNION ALL
SELECT 'hour_distribution', event_type, 'ok', CAST(hour(ts) AS INTEGER), count(*)
FROM e WHERE dep_time_sanity = 'ok' GROUP BY event_type, hour(ts)
"""

ORACLE["dedupe_latest"] = """
SELECT user_id, ts_hour, event_id, ts, event_type, value FROM (
  SELECT user_id, date_trunc('hour', ts) AS ts_hour, event_id, ts, event_type, value,
         row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts)
                            ORDER BY ts DESC, event_id DESC) AS rn
  FROM events)
WHERE rn = 1
"""

# ------------------------------------------------------------ cleaning / time / keys

CLEAN = """
r AS (
  SELECT event_id, event_type,
         CASE WHEN event_type = 'error' THEN '' WHEN event_type = 'signup' THEN 'M'
              WHEN event_type = 'click' THEN ' ' || CAST(value AS VARCHAR) || ' '
              ELSE CAST(value AS VARCHAR) END AS raw_value,
         CASE WHEN value >= 75 THEN '1.00' WHEN value >= 50 THEN '0' WHEN value >= 25 THEN '' END AS raw_flag
  FROM events),
r2 AS (SELECT *, CASE WHEN event_type = 'view' THEN 'T' ELSE raw_value END AS raw_trace FROM r),
clean AS (
  SELECT event_id, raw_value, raw_trace, raw_flag,
         nullif(nullif(trim(raw_value), ''), 'M') AS text_clean,
         CAST(CASE WHEN trim(raw_value) IN ('', 'M') THEN NULL
                   ELSE CAST(trim(raw_value) AS DECIMAL(38,10)) END AS DOUBLE) AS num_clean,
         CAST(CASE WHEN trim(raw_trace) IN ('', 'M') THEN NULL WHEN trim(raw_trace) = 'T' THEN 0
                   ELSE CAST(trim(raw_trace) AS DECIMAL(38,10)) END AS DOUBLE) AS num_trace,
         CAST(coalesce(nullif(trim(raw_flag), ''), '0') AS DECIMAL(38,10)) = 1 AS flag_clean,
         event_type = 'error' AS is_cancelled,
         CASE WHEN event_type = 'error' THEN NULL
              ELSE CAST(CASE WHEN trim(raw_value) IN ('', 'M') THEN NULL
                             ELSE CAST(trim(raw_value) AS DECIMAL(38,10)) END AS DOUBLE) END AS delay_clean,
         CASE WHEN event_type = 'error' THEN NULL
              ELSE CAST(coalesce(nullif(trim(raw_flag), ''), '0') AS DECIMAL(38,10)) = 1 END AS delay_15_flag
  FROM r2)
"""

ORACLE["clean_fields"] = f"WITH {CLEAN} SELECT * FROM clean"

ORACLE["hhmm_to_utc"] = r"""
WITH z(o_orderpriority, zone) AS (VALUES
  ('1-URGENT', 'America/New_York'), ('2-HIGH', 'America/Chicago'), ('3-MEDIUM', 'America/Denver'),
  ('4-NOT SPECIFIED', 'America/Phoenix'), ('5-LOW', 'Pacific/Honolulu')),
x AS (SELECT o.o_orderkey, z.zone, CAST(o.o_orderkey % 2500 AS VARCHAR) AS hhmm,
             CAST(o.o_orderdate AS DATE) AS d
      FROM orders o JOIN z ON o.o_orderpriority = z.o_orderpriority),
p AS (SELECT *, lpad(regexp_replace(trim(coalesce(hhmm, '')), '\.0+$', ''), 4, '0') AS s FROM x),
l AS (
  SELECT o_orderkey, zone, hhmm,
         CASE WHEN d IS NULL THEN NULL
              WHEN trim(coalesce(hhmm, '')) IN ('', 'NA') THEN NULL
              WHEN TRY_CAST(substr(s, 1, 2) AS INTEGER) = 24 AND TRY_CAST(substr(s, 3, 2) AS INTEGER) = 0
                THEN CAST(d + INTERVAL 1 DAY AS TIMESTAMP)
              WHEN TRY_CAST(substr(s, 1, 2) AS INTEGER) IS NULL OR TRY_CAST(substr(s, 3, 2) AS INTEGER) IS NULL
                   OR TRY_CAST(substr(s, 1, 2) AS INTEGER) > 23 OR TRY_CAST(substr(s, 3, 2) AS INTEGER) > 59
                THEN NULL
              ELSE CAST(d AS TIMESTAMP) + to_minutes(TRY_CAST(substr(s, 1, 2) AS INTEGER) * 60
                                                     + TRY_CAST(substr(s, 3, 2) AS INTEGER))
         END AS local_ts
  FROM p)
SELECT o_orderkey, zone, hhmm, local_ts,
       timezone('UTC', timezone(zone, local_ts)) AS utc_ts,
       timezone(zone, timezone('UTC', timezone('UTC', timezone(zone, local_ts)))) AS round_trip_ts
FROM l
"""

ORACLE["surrogate_key"] = """
SELECT o_orderkey,
       md5(concat_ws('|', coalesce(CAST(o_orderkey AS VARCHAR), ''), coalesce(CAST(o_custkey AS VARCHAR), ''),
                     coalesce(o_orderstatus, ''), coalesce(o_orderpriority, ''),
                     coalesce(strftime(o_orderdate, '%Y-%m-%d'), ''))) AS order_sk
FROM orders
"""

ORACLE["dim_lookup"] = """
SELECT s.s_suppkey, s.s_name, n.n_name, r.r_name
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""

ORACLE["left_lookup"] = """
SELECT o.o_custkey, o.o_orderkey, c.c_mktsegment FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""

ORACLE["missing_refs"] = """
SELECT DISTINCT 'lineitem_suppkey' AS check_name, l_suppkey AS missing_key FROM lineitem l
WHERE l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)
UNION ALL
SELECT DISTINCT 'lineitem_partkey', l_partkey FROM lineitem l
WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL
SELECT DISTINCT 'lineitem_orderkey', l_orderkey FROM lineitem l
WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL
SELECT DISTINCT 'orders_custkey', o_custkey FROM orders o
WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
"""

ORACLE["keyed_merge"] = """
WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
b AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, 1 AS revision
      FROM orders WHERE o_orderstatus = 'O')
SELECT t.*, NULL::INTEGER AS revision FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM b
"""

ORACLE["coverage_extent"] = """
WITH li AS (SELECT l_suppkey, strftime(l_shipdate, '%Y-%m') AS ym FROM lineitem)
SELECT count(*) AS row_count, count(DISTINCT ym) AS months, min(ym) AS min_month, max(ym) AS max_month,
       count(DISTINCT concat_ws('-', CAST(l_suppkey AS VARCHAR), ym)) AS unit_months,
       count(DISTINCT l_suppkey) AS units
FROM li
"""

ORACLE["quality_report"] = f"""
WITH {NEAREST}, {KEY_HOUR}, {ORDER_LINES}, {ROUTE}, {CLEAN},
checks(name, violations) AS (
  SELECT 'not_null_orders_o_orderkey', count(*) FROM orders WHERE o_orderkey IS NULL
  UNION ALL SELECT 'not_null_orders_o_orderdate', count(*) FROM orders WHERE o_orderdate IS NULL
  UNION ALL SELECT 'unique_orders_o_orderkey', count(*) FROM
    (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
  UNION ALL SELECT 'unique_lineitem_order_line', count(*) FROM
    (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
  UNION ALL SELECT 'accepted_values_o_orderstatus', count(*) FROM orders
    WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O', 'P')
  UNION ALL SELECT 'accepted_values_match_status', count(*) FROM nn
    WHERE match_status IS NOT NULL AND match_status NOT IN ('matched', 'no_obs_in_window')
  UNION ALL SELECT 'rates_valid_key_hour', count(*) FROM key_hour
    WHERE flight_count <= 0 OR delayed_count < 0 OR delayed_count > flight_count
       OR delay_rate_15 < 0 OR delay_rate_15 > 1
  UNION ALL SELECT 'rates_valid_route', count(*) FROM route
    WHERE flight_count <= 0 OR delayed_count < 0 OR delayed_count > flight_count
       OR delay_rate_15 < 0 OR delay_rate_15 > 1
  UNION ALL SELECT 'refs_lineitem_suppkey', count(*) FROM
    (SELECT DISTINCT l_suppkey FROM lineitem l WHERE l_suppkey IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey))
  UNION ALL SELECT 'row_count_parity_nearest', count(*) FROM
    (SELECT (SELECT count(*) FROM nn) AS a,
            (SELECT count(*) FROM events WHERE event_type = 'purchase') AS b) WHERE a <> b
  UNION ALL SELECT 'cancelled_null_delay', count(*) FROM clean
    WHERE is_cancelled AND NOT coalesce(delay_clean IS NULL, false)
  UNION ALL SELECT 'cancelled_null_flag', count(*) FROM clean
    WHERE is_cancelled AND NOT coalesce(delay_15_flag IS NULL, false)
  UNION ALL SELECT 'match_flag_consistent', count(*) FROM nn
    WHERE (match_status = 'matched') <> (obs_ts IS NOT NULL)
  UNION ALL SELECT 'null_ts_share', count(*) FROM
    (SELECT count(*) AS t, count(*) FILTER (WHERE ts IS NULL) AS n FROM events) WHERE n > 0.01 * t
  UNION ALL SELECT 'matched_within_window', count(*) FROM nn
    WHERE match_status = 'matched' AND NOT coalesce(abs(lag_minutes) <= 360, false)
  UNION ALL SELECT 'match_share_by_user', count(*) FROM
    (SELECT user_id FROM nn GROUP BY user_id
     HAVING count(*) FILTER (WHERE match_status = 'matched') < 0.9 * count(*)))
SELECT name, violations, violations = 0 AS passed FROM checks
"""

# ------------------------------------------------------------ ranking metrics / folds

SCORED = """
sc AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS segment,
              least(greatest(1.0 / (1.0 + exp(-(value - 50.0) / 25.0)), 0.0), 1.0) AS s,
              CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y
       FROM events)
"""

CUM = """
cnt AS (SELECT s, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) - sum(y) AS DOUBLE) AS neg FROM sc GROUP BY s),
cum AS (SELECT s, pos, neg,
               sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp FROM cnt),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM cnt),
j AS (SELECT cum.*, P, N, tp / (tp + fp) AS prec,
             CASE WHEN P > 0 THEN tp / P ELSE 1.0 END AS rec FROM cum, tot)
"""

ORACLE["ranking_metrics"] = f"""
WITH {SCORED}, {CUM},
m AS (SELECT CASE WHEN max(P) > 0 THEN sum(pos / P * prec) ELSE 0.0 END AS pr_auc,
             CASE WHEN max(P) > 0 AND max(N) > 0 THEN sum(pos * (N - fp + 0.5 * neg)) / (max(P) * max(N)) END
               AS roc_auc,
             sum(pos * pow(s - 1.0, 2) + neg * pow(s, 2)) / (max(P) + max(N)) AS brier,
             max(P) / (max(P) + max(N)) AS positive_rate,
             CAST(max(P) + max(N) AS DOUBLE) AS n_rows,
             arg_min(prec, struct_pack(d := abs(rec - 0.5), s := s)) AS precision_at_recall_50
      FROM j),
cut AS (SELECT quantile_cont(s, 0.9) AS q, avg(y) AS base FROM sc),
lift AS (SELECT CASE WHEN max(cut.base) = 0 OR count(*) = 0 THEN 0.0
                     ELSE avg(sc.y) / max(cut.base) END AS lift_at_top_decile
         FROM sc, cut WHERE sc.s >= cut.q),
pts AS (SELECT row_number() OVER (ORDER BY s DESC) AS r, rec, prec FROM j
        UNION ALL SELECT 0, 0.0, 1.0),
area AS (SELECT sum((a.rec - b.rec) * (a.prec + b.prec) / 2) AS pr_auc_trapezoid
         FROM pts a JOIN pts b ON b.r = a.r - 1)
SELECT round(pr_auc, 6) AS pr_auc, round(roc_auc, 6) AS roc_auc, round(brier, 6) AS brier,
       round(positive_rate, 6) AS positive_rate, round(n_rows, 6) AS n_rows,
       round(precision_at_recall_50, 6) AS precision_at_recall_50,
       round(lift_at_top_decile, 6) AS lift_at_top_decile, round(pr_auc_trapezoid, 6) AS pr_auc_trapezoid
FROM m, lift, area
"""

ORACLE["segment_metrics"] = f"""
WITH {SCORED},
base AS (SELECT avg(y) AS b FROM sc),
cnt AS (SELECT segment, s, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) - sum(y) AS DOUBLE) AS neg
        FROM sc GROUP BY segment, s),
cum AS (SELECT *, sum(pos) OVER (PARTITION BY segment ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(neg) OVER (PARTITION BY segment ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp FROM cnt),
tot AS (SELECT segment, sum(pos) AS P, sum(neg) AS N FROM cnt GROUP BY segment),
m AS (SELECT c.segment, max(t.P) + max(t.N) AS n, max(t.P) / (max(t.P) + max(t.N)) AS pr,
             CASE WHEN max(t.P) > 0 THEN sum(c.pos / t.P * (c.tp / (c.tp + c.fp))) ELSE 0.0 END AS ap
      FROM cum c JOIN tot t USING (segment) GROUP BY c.segment),
bl AS (SELECT segment, CASE WHEN sum(y) > 0 THEN avg(CAST(y AS DOUBLE)) ELSE 0.0 END AS ap
       FROM sc GROUP BY segment)
SELECT 'segment' AS segment_type, m.segment, CAST(m.n AS BIGINT) AS n_rows, round(m.pr, 4) AS positive_rate,
       round(m.ap, 4) AS pr_auc_model, round(bl.ap, 4) AS pr_auc_baseline,
       round(m.ap - bl.ap, 4) AS pr_auc_lift
FROM m JOIN bl USING (segment) WHERE m.n >= 300
"""

ORACLE["calibration_bins"] = f"""
WITH {SCORED},
e AS (SELECT quantile_cont(s, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM sc)
SELECT CAST(len(list_filter(e.q, lambda x: x < sc.s)) AS INTEGER) AS bin, count(*) AS n,
       round(avg(sc.s), 6) AS mean_score, round(avg(CAST(sc.y AS DOUBLE)), 6) AS positive_share
FROM sc, e GROUP BY 1
"""

ORACLE["pr_points"] = f"""
WITH {SCORED}, {CUM}
SELECT round(s, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(prec, 6) AS precision, round(rec, 6) AS recall
FROM j
"""

FOLDS_SQL = """
folds(fold, train_end, val_start, val_end) AS (VALUES
  ('fold1', '1997-12', '1998-01', '1998-12'), ('fold2', '1998-06', '1998-07', '1998-12'),
  ('fold3', '1998-09', '1998-10', '1998-12'))
"""

ORACLE["split_profile"] = """
WITH om AS (SELECT o_custkey, o_orderpriority, o_totalprice, strftime(o_orderdate, '%Y-%m') AS year_month,
                   o_orderstatus = 'F' AS target,
                   CASE WHEN strftime(o_orderdate, '%Y-%m') < '1999-01' THEN 'train' ELSE 'test' END AS split
            FROM orders)
SELECT 'summary' AS report, split, NULL::VARCHAR AS year, count(*) AS rows,
       round(avg(CAST(target AS DOUBLE)), 4) AS positive_rate, count(DISTINCT year_month) AS months,
       count(DISTINCT o_custkey) AS origins, count(DISTINCT o_orderpriority) AS airlines,
       round(avg(CAST(o_totalprice IS NULL AS DOUBLE)), 4) AS missing_price_pct
FROM om GROUP BY split
UNION ALL
SELECT 'train_by_year', 'train', substr(year_month, 1, 4), count(*), round(avg(CAST(target AS DOUBLE)), 4),
       NULL, NULL, NULL, NULL
FROM om WHERE split = 'train' GROUP BY substr(year_month, 1, 4)
"""

ORACLE["expanding_folds"] = f"""
WITH {FOLDS_SQL},
om AS (SELECT strftime(o_orderdate, '%Y-%m') AS year_month, o_orderstatus = 'F' AS target FROM orders),
t AS (SELECT f.fold, count(*) AS n, count(*) FILTER (WHERE target) AS p
      FROM folds f JOIN om ON om.year_month <= f.train_end GROUP BY f.fold),
v AS (SELECT f.fold, count(*) AS n, count(*) FILTER (WHERE target) AS p
      FROM folds f JOIN om ON om.year_month >= f.val_start AND om.year_month <= f.val_end GROUP BY f.fold)
SELECT f.fold, coalesce(t.n, 0) AS train_rows, coalesce(v.n, 0) AS val_rows,
       round(round(CAST(t.p AS DOUBLE) / NULLIF(CAST(t.n AS DOUBLE), 0), 6), 6) AS train_positive_rate,
       round(round(CAST(v.p AS DOUBLE) / NULLIF(CAST(v.n AS DOUBLE), 0), 6), 6) AS val_positive_rate
FROM folds f LEFT JOIN t USING (fold) LEFT JOIN v USING (fold)
"""

# ------------------------------------------------------------ dashboard computations

ORACLE["airport_summaries"] = f"""
WITH {KEY_HOUR}
SELECT event_type, CAST(sum(flight_count) AS BIGINT) AS flight_count,
       CAST(sum(delayed_count) AS BIGINT) AS delayed_count,
       round(CASE WHEN sum(flight_count) > 0 THEN CAST(sum(delayed_count) AS DOUBLE) / sum(flight_count)
                  ELSE 0.0 END, 6) AS delay_rate_15,
       round(CASE WHEN sum(flight_count) > 0 THEN sum(avg_dep_delay_minutes * flight_count) / sum(flight_count)
                  ELSE 0.0 END, 6) AS avg_dep_delay_minutes
FROM key_hour GROUP BY event_type
"""

ORACLE["airport_leaderboard"] = f"""
WITH {KEY_HOUR},
g AS (SELECT event_type, CAST(sum(flight_count) AS BIGINT) AS flight_count,
             CAST(sum(delayed_count) AS BIGINT) AS delayed_count FROM key_hour GROUP BY event_type),
r AS (SELECT *, CAST(delayed_count AS DOUBLE) / greatest(flight_count, 1) AS delay_rate_15 FROM g),
t AS (SELECT event_type, flight_count, delayed_count, round(delay_rate_15, 6) AS delay_rate_15,
             round_even(delay_rate_15 * 100, 1) AS delay_rate_pct,
             row_number() OVER (ORDER BY delay_rate_15 DESC, event_type) AS rank
      FROM r WHERE flight_count >= 500)
SELECT * FROM t WHERE rank <= 10
"""

ORACLE["top_hours"] = f"""
WITH {KEY_HOUR},
t AS (SELECT *, lpad(CAST(event_hour AS VARCHAR), 2, '0') || ':00' AS hour_label,
             row_number() OVER (ORDER BY delay_rate_15 DESC, flight_count DESC, event_hour) AS rank
      FROM key_hour WHERE event_type = 'purchase' AND flight_count >= 50)
SELECT * FROM t WHERE rank <= 5
"""

def _bucket_rates_sql(col: str, order: list[str]) -> str:
    lst = ", ".join(f"'{v}'" for v in order)
    return f"""
SELECT '{col}' AS dimension, {col} AS bucket,
       CASE WHEN coalesce(list_position([{lst}], {col}), 0) = 0 THEN {len(order) + 1}
            ELSE list_position([{lst}], {col}) END AS bucket_order,
       CAST(sum(flight_count) AS BIGINT) AS flight_count, CAST(sum(delayed_count) AS BIGINT) AS delayed_count,
       round(CAST(sum(delayed_count) AS DOUBLE) / greatest(sum(flight_count), 1), 6) AS delay_rate_15,
       round_even(CAST(sum(delayed_count) AS DOUBLE) / greatest(sum(flight_count), 1) * 100, 1) AS delay_rate_pct
FROM buckets GROUP BY {col}"""


# Bucket display orders (same lists as the bucket module).
_WIND = ["calm_0_5kt", "light_6_15kt", "moderate_16_25kt", "strong_26plus_kt", "unknown"]
_PRECIP = ["none", "light", "moderate", "heavy"]
_VIS = ["high_over_10mi", "medium_3_10mi", "low_under_3mi", "unknown"]

ORACLE["bucket_rates"] = f"""
WITH {ORDER_LINES}, {BUCKETS}
{_bucket_rates_sql('wind_speed_bucket', _WIND)}
UNION ALL {_bucket_rates_sql('precip_bucket', _PRECIP)}
UNION ALL {_bucket_rates_sql('visibility_bucket', _VIS)}
"""

ORACLE["weather_summary"] = f"""
WITH {ORDER_LINES}, {BUCKETS}
SELECT CAST(coalesce(sum(flight_count), 0) AS BIGINT) AS flight_count,
       CAST(coalesce(sum(delayed_count), 0) AS BIGINT) AS delayed_count, count(*) AS combo_count,
       round(CASE WHEN coalesce(sum(flight_count), 0) > 0 THEN CAST(sum(delayed_count) AS DOUBLE) / sum(flight_count)
                  ELSE 0.0 END, 6) AS delay_rate_15, 0 AS min_combo_flights
FROM buckets
UNION ALL
SELECT CAST(coalesce(sum(flight_count), 0) AS BIGINT), CAST(coalesce(sum(delayed_count), 0) AS BIGINT), count(*),
       round(CASE WHEN coalesce(sum(flight_count), 0) > 0 THEN CAST(sum(delayed_count) AS DOUBLE) / sum(flight_count)
                  ELSE 0.0 END, 6), 50
FROM buckets WHERE flight_count >= 50
"""

ORACLE["worst_combos"] = f"""
WITH {ORDER_LINES}, {BUCKETS},
t AS (SELECT *, origin || ' — ' || wind_speed_bucket || ' · ' || precip_bucket || ' · ' || visibility_bucket
                  AS combo_label FROM buckets WHERE flight_count >= 50),
r AS (SELECT *, row_number() OVER (ORDER BY delay_rate_15 DESC, flight_count DESC, combo_label) AS rank FROM t)
SELECT * FROM r WHERE rank <= 5
"""

ORACLE["precip_lift"] = f"""
WITH {ORDER_LINES}, {BUCKETS},
p AS (SELECT precip_bucket, CAST(sum(delayed_count) AS DOUBLE) / greatest(sum(flight_count), 1) AS r
      FROM buckets GROUP BY precip_bucket)
SELECT round(max(CASE WHEN precip_bucket = 'heavy' THEN r END)
             - max(CASE WHEN precip_bucket = 'none' THEN r END), 6) AS rate_lift FROM p
"""

ROUTES_SQL = """
routes AS (SELECT * FROM route WHERE l_returnflag IN ('A', 'R'))
"""

ORACLE["route_summary"] = f"""
WITH {ORDER_LINES}, {ROUTE}, {ROUTES_SQL}
SELECT CAST(coalesce(sum(flight_count), 0) AS BIGINT) AS flight_count,
       CAST(coalesce(sum(delayed_count), 0) AS BIGINT) AS delayed_count, count(*) AS route_count,
       round(CASE WHEN coalesce(sum(flight_count), 0) > 0 THEN CAST(sum(delayed_count) AS DOUBLE) / sum(flight_count)
                  ELSE 0.0 END, 6) AS delay_rate_15
FROM routes
"""

ORACLE["top_routes"] = f"""
WITH {ORDER_LINES}, {ROUTE}, {ROUTES_SQL},
l AS (SELECT *, o_orderpriority || ' → ' || o_orderstatus AS route_label,
             l_returnflag || ' ' || o_orderpriority || ' → ' || o_orderstatus AS label,
             round_even(delay_rate_15 * 100, 1) AS delay_rate_pct FROM routes),
v AS (SELECT 'top_volume' AS report, *, row_number() OVER (
        ORDER BY flight_count DESC, l_returnflag, o_orderpriority, o_orderstatus) AS rank FROM l),
d AS (SELECT 'top_delay' AS report, *, row_number() OVER (
        ORDER BY delay_rate_15 DESC, flight_count DESC, l_returnflag, o_orderpriority, o_orderstatus) AS rank
      FROM l WHERE flight_count >= 50)
SELECT report, l_returnflag, o_orderpriority, o_orderstatus, route_label, label, flight_count,
       delay_rate_15, delay_rate_pct, rank FROM v WHERE rank <= 10
UNION ALL
SELECT report, l_returnflag, o_orderpriority, o_orderstatus, route_label, label, flight_count,
       delay_rate_15, delay_rate_pct, rank FROM d WHERE rank <= 10
"""

ORACLE["carrier_leaderboard"] = f"""
WITH {ORDER_LINES}, {ROUTE},
g AS (SELECT l_returnflag, CAST(sum(flight_count) AS BIGINT) AS flight_count,
             CAST(sum(delayed_count) AS BIGINT) AS delayed_count FROM route GROUP BY l_returnflag)
SELECT l_returnflag, flight_count, delayed_count,
       round(CAST(delayed_count AS DOUBLE) / greatest(flight_count, 1), 6) AS delay_rate_15,
       round_even(CAST(delayed_count AS DOUBLE) / greatest(flight_count, 1) * 100, 1) AS delay_rate_pct
FROM g WHERE flight_count >= 200
"""

ORACLE["overview"] = f"""
WITH {KEY_HOUR}, {ORDER_LINES}, {ROUTE}, {BUCKETS},
top AS (SELECT event_type AS top_airport, event_hour AS top_airport_hour,
               round(delay_rate_15, 6) AS top_airport_delay_rate
        FROM key_hour WHERE flight_count >= 50
        ORDER BY delay_rate_15 DESC, event_type, event_hour LIMIT 1),
busy AS (SELECT event_type AS busiest_airport, event_hour AS busiest_hour, flight_count AS busiest_flights
         FROM key_hour ORDER BY flight_count DESC, event_type, event_hour LIMIT 1),
p AS (SELECT precip_bucket, CAST(sum(delayed_count) AS DOUBLE) / greatest(sum(flight_count), 1) AS r
      FROM buckets GROUP BY precip_bucket),
precip AS (SELECT round(max(CASE WHEN precip_bucket = 'none' THEN r END), 6) AS precip_rate_none,
                  round(max(CASE WHEN precip_bucket = 'light' THEN r END), 6) AS precip_rate_light,
                  round(max(CASE WHEN precip_bucket = 'moderate' THEN r END), 6) AS precip_rate_moderate,
                  round(max(CASE WHEN precip_bucket = 'heavy' THEN r END), 6) AS precip_rate_heavy FROM p),
rt AS (SELECT l_returnflag AS top_route_l_returnflag, o_orderpriority AS top_route_o_orderpriority,
              o_orderstatus AS top_route_o_orderstatus, flight_count AS top_route_flights
       FROM route ORDER BY flight_count DESC, l_returnflag, o_orderpriority, o_orderstatus LIMIT 1)
SELECT (SELECT count(*) FROM key_hour) AS airport_hour_rows, (SELECT count(*) FROM buckets) AS weather_bucket_rows,
       (SELECT count(*) FROM route) AS carrier_route_rows, top.*, busy.*, precip.*, rt.*
FROM (SELECT 1 AS one) d LEFT JOIN top ON true LEFT JOIN busy ON true LEFT JOIN precip ON true
     LEFT JOIN rt ON true
"""

ORACLE["zipped_csv_load"] = """
SELECT strftime(o_orderdate, '%Y') || '.zip' AS source_file, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_customers,
       sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents, count(*) FILTER (o_orderpriority = '1-URGENT') AS n_urgent,
       count(*) AS reported_rows, true AS sound
FROM orders GROUP BY 1
"""

ORACLE["month_reload"] = """
WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m') AS year_month
           FROM orders),
l AS (SELECT l_orderkey, count(*) AS line_count, sum(l_quantity) AS total_qty FROM lineitem GROUP BY l_orderkey),
b AS (SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, t.year_month, l.line_count, l.total_qty
      FROM t LEFT JOIN l ON t.o_orderkey = l.l_orderkey WHERE t.o_orderstatus = 'F')
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, year_month, NULL::BIGINT AS line_count,
       NULL::DOUBLE AS total_qty
FROM t WHERE year_month NOT IN (SELECT DISTINCT year_month FROM b)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, NULL::DOUBLE, year_month, line_count, total_qty FROM b
"""

# ------------------------------------------------------------ derived columns, gates and orders

ORACLE["calendar_columns"] = """
SELECT event_id, hour(ts)::INTEGER AS hour, isodow(ts)::INTEGER AS dow_iso, month(ts)::INTEGER AS month,
       round(epoch_us(ts) / 1000000.0, 6) AS epoch_s, ts + INTERVAL 2 HOUR AS ts_plus_2h,
       CASE WHEN value > 50 THEN 1 ELSE 0 END AS is_precip,
       round(sin(2 * pi() * hour(ts) / 24.0), 9) + 0.0 AS sin_hour, round(cos(2 * pi() * hour(ts) / 24.0), 9) + 0.0 AS cos_hour
FROM events
"""

ORACLE["model_buckets"] = """
WITH l AS (SELECT CASE WHEN l_linenumber <> 3 THEN l_quantity END AS w, coalesce(CASE WHEN l_linenumber <> 2 THEN 4 * l_discount END, 0) AS p
           FROM lineitem)
SELECT CASE WHEN w IS NULL THEN 'unknown' WHEN w <= 5 THEN 'calm' WHEN w <= 15 THEN 'light' WHEN w <= 25 THEN 'moderate' ELSE 'strong' END AS wind,
       CASE WHEN p = 0 THEN 'none' WHEN p <= 0.1 THEN 'light' WHEN p <= 0.3 THEN 'moderate' ELSE 'heavy' END AS precip, count(*) AS n
FROM l GROUP BY 1, 2
"""

ORACLE["departure_anchors"] = """
WITH x AS (
  SELECT CASE WHEN l_returnflag <> 'R' AND l_quantity > 10 THEN 'actual' ELSE 'scheduled' END AS time_source, l_shipdate, o_orderdate,
         date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS delay
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT time_source, strftime(CASE WHEN time_source = 'actual' THEN l_shipdate ELSE o_orderdate END, '%Y-%m') AS year_month,
       count(*) AS n, count(*) FILTER (delay >= 15) AS delayed
FROM x GROUP BY 1, 2
"""

ORACLE["station_month_gate"] = f"""
WITH {NEAREST},
scope AS (SELECT DISTINCT user_id % 20 AS station, strftime(ts, '%Y-%m') AS year_month FROM events WHERE ts IS NOT NULL
          UNION SELECT range, '1999-01' FROM range(20)),
c AS (SELECT user_id % 20 AS station, year_month, count(*) AS total_rows, count(*) FILTER (is_matched) AS ok_rows FROM fact GROUP BY 1, 2)
SELECT scope.station, scope.year_month, coalesce(total_rows, 0) AS total_rows, coalesce(ok_rows, 0) AS ok_rows
FROM scope LEFT JOIN c ON c.station = scope.station AND c.year_month = scope.year_month
WHERE coalesce(total_rows, 0) = 0 OR ok_rows < 0.9 * total_rows
"""

ORACLE["readiness_gate"] = """
WITH r AS (SELECT 'orders' AS table_name, o_orderstatus AS u, strftime(o_orderdate, '%Y-%m') AS ym FROM orders
           UNION ALL SELECT 'events', event_type, strftime(ts, '%Y-%m') FROM events),
t AS (SELECT table_name, count(*) AS row_count, count(DISTINCT ym) AS months, count(DISTINCT (u, ym)) AS unit_months,
             min(ym) AS first_month, max(ym) AS last_month FROM r GROUP BY table_name),
g AS (SELECT *, 60 AS min_months, 100 AS min_unit_months,
             CASE WHEN row_count > 0 AND months >= 60 AND unit_months >= 100 THEN 'GO' ELSE 'NO_GO' END AS decision FROM t)
SELECT table_name, row_count, months, unit_months, first_month, last_month, min_months, min_unit_months, decision, NULL::VARCHAR AS warning FROM g
UNION ALL
SELECT 'ALL', NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN bool_and(decision = 'GO') THEN 'GO' ELSE 'NO_GO' END,
       CASE WHEN count(DISTINCT first_month) > 1 OR count(DISTINCT last_month) > 1 THEN 'first or last months differ between tables' END
FROM g
"""

ORACLE["ordered_reports"] = """
WITH p AS (SELECT o_orderpriority AS segment, count(*) AS n_rows FROM orders GROUP BY 1),
s AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS segment, count(*) AS n_rows FROM orders GROUP BY 1),
a AS (SELECT 'labels' AS report, row_number() OVER (ORDER BY CASE segment WHEN '3-MEDIUM' THEN 0 WHEN '1-URGENT' THEN 1 ELSE 2 END, segment) AS rank,
             'priority' AS segment_type, segment, n_rows FROM p),
b AS (SELECT 'nulls_first', row_number() OVER (ORDER BY segment NULLS FIRST), 'status', segment, n_rows FROM s),
c AS (SELECT 'segments', row_number() OVER (ORDER BY n_rows DESC, segment), 'priority', segment, n_rows FROM p)
SELECT * FROM a WHERE rank <= 4 UNION ALL SELECT * FROM b WHERE 1 = 1 UNION ALL (SELECT * FROM c ORDER BY 2 LIMIT 3)
"""
