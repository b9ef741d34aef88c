"""The reference's flows re-aimed at the driver tables.

The driver tables are not flights and weather, so each operator runs on an
analogue that exercises the same semantics:

* nearest observation: ``purchase`` events (the "departures") matched to the
  nearest ``click``/``view`` event (the "observations") of the same user
  within +/- 6 h; ties prefer the later-loaded observation (higher id).
* delay measures: an event counts as "delayed" when ``value >= 75``; the
  mean measure is ``value``. Order-line "routes" use the ship delay in days
  (ship date - order date), "delayed" at >= 15 days.
* weather buckets: the fixed wind / precipitation / visibility cut points
  applied to quantity, 4 x discount and 100 x tax of order lines.

Everything reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearcast.functions import buckets as B
from nearcast.operators import aggregates as A
from nearcast.operators.asof import nearest_asof
from nearcast.sources.tables import load

# Fixed analogue parameters.
WINDOW_HOURS = 6
DELAYED_AT = 75.0
SHIP_DELAYED_DAYS = 15
MIN_HOUR_FLIGHTS = 50
MIN_KEY_FLIGHTS = 500
MIN_ROUTE_FLIGHTS = 50
MIN_COMBO_FLIGHTS = 50
LOW_MATCH_PCT = 50.0


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    ev = load(spark, sf, "events")
    return ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")


def observations(spark: SparkSession, sf: str) -> DataFrame:
    ev = load(spark, sf, "events")
    return ev.filter(F.col("event_type").isin("click", "view")) \
        .select("user_id", "ts", "event_id", "event_type", "value")


def nearest(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases with their nearest click/view of the same user within +/- 6 h."""
    return nearest_asof(purchases(spark, sf), observations(spark, sf), key="user_id",
                        event_time="ts", obs_time="ts", window_hours=WINDOW_HOURS,
                        carry=["event_id", "event_type", "value"], obs_key="event_id")


def nearest_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Joined fact: nearest match plus date, UTC hour, month and matched flag."""
    return nearest(spark, sf).select(
        "*", F.to_date("ts").alias("event_date"), F.hour("ts").alias("event_hour"),
        F.date_format("ts", "yyyy-MM").alias("year_month"),
        (F.col("match_status") == "matched").alias("is_matched"))


def key_hour_agg(spark: SparkSession, sf: str) -> DataFrame:
    """Delay by key x UTC hour (A1)."""
    ev = load(spark, sf, "events")
    return A.delay_aggregate(ev, ["event_type", F.hour("ts").alias("event_hour")],
                             F.col("value") >= DELAYED_AT, "value")


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines joined to their order, with ship delay in days."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity",
                                            "l_discount", "l_tax", "l_shipdate")
    od = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus",
                                          "o_orderdate")
    j = li.join(od, li["l_orderkey"] == od["o_orderkey"])
    return j.withColumn("ship_delay_days",
                        F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")))


ROUTE_KEYS = ["l_returnflag", "o_orderpriority", "o_orderstatus"]


def route_agg(spark: SparkSession, sf: str) -> DataFrame:
    """Delay by "carrier route" (A2)."""
    return A.delay_aggregate(order_lines(spark, sf), ROUTE_KEYS,
                             F.col("ship_delay_days") >= SHIP_DELAYED_DAYS, "ship_delay_days")


def bucket_agg(spark: SparkSession, sf: str) -> DataFrame:
    """Delay by weather-style buckets."""
    ol = order_lines(spark, sf)
    keys = [F.col("l_returnflag").alias("origin"),
            B.wind_bucket(F.col("l_quantity")).alias("wind_speed_bucket"),
            B.precip_bucket(F.col("l_discount") * 4).alias("precip_bucket"),
            B.visibility_bucket(F.col("l_tax") * 100).alias("visibility_bucket")]
    return A.delay_aggregate(ol, keys, F.col("ship_delay_days") >= SHIP_DELAYED_DAYS,
                             "ship_delay_days")


def bucket_and_route_aggs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Bucket (A3) and route (A2) aggregates from one join and one grouping-sets pass.

    Both read the order-line join; computing them together joins once and
    shuffles once (Expand x 2), and the small result is written once.
    """
    from nearcast.session import materialize
    ol = order_lines(spark, sf).select(
        "l_returnflag", "o_orderpriority", "o_orderstatus", "ship_delay_days",
        B.wind_bucket(F.col("l_quantity")).alias("wind_speed_bucket"),
        B.precip_bucket(F.col("l_discount") * 4).alias("precip_bucket"),
        B.visibility_bucket(F.col("l_tax") * 100).alias("visibility_bucket"))
    cols = ["l_returnflag", "wind_speed_bucket", "precip_bucket", "visibility_bucket",
            "o_orderpriority", "o_orderstatus"]
    sets = [cols[:4], ["l_returnflag", "o_orderpriority", "o_orderstatus"]]
    g = ol.groupingSets(sets, *cols).agg(
        *A.delay_measures(F.col("ship_delay_days") >= SHIP_DELAYED_DAYS, "ship_delay_days"),
        F.grouping_id().alias("__gid"))
    g = materialize(g)
    measures = [A.N, A.D, A.RATE, A.AVG]
    # grouping_id bit i (from the right) is set when cols[-1 - i] is not grouped
    wb = g.filter(F.col("__gid") == 0b000011).select(
        F.col("l_returnflag").alias("origin"), "wind_speed_bucket", "precip_bucket", "visibility_bucket", *measures)
    cr = g.filter(F.col("__gid") == 0b011100).select(*ROUTE_KEYS, *measures)
    return wb, cr
