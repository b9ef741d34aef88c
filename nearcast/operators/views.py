"""Computations behind the reference's dashboard pages.

They run on the three (small) aggregates, but as DataFrame operations, so
the same code serves a mart of any size: filters, grouped sums, clipped
rates, display labels and ordered top-n - no pandas round trip.
Display rounding follows pandas (half to even: ``bround``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearcast.functions import buckets as B
from nearcast.operators import reports as R
from nearcast.operators.aggregates import AVG, D, N, RATE


def _sums(keys: list) -> list[Column]:
    return [F.sum(N).cast("long").alias(N), F.sum(D).cast("long").alias(D)]


def clipped_rate(d=D, n=N) -> Column:
    """delayed / max(flights, 1)."""
    return F.col(d).cast("double") / F.greatest(F.col(n), F.lit(1)).cast("double")


def rate_pct(rate: Column) -> Column:
    """Percent with one decimal, half to even (P25)."""
    return F.bround(rate * 100, 1)


def key_summary(agg: DataFrame, keys: list[str]) -> DataFrame:
    """Sums, rate and weighted mean per key; 0 when a key has no flights."""
    g = agg.groupBy(*keys).agg(*_sums(keys), F.sum(F.col(AVG) * F.col(N)).alias("__w"))
    has = F.col(N) > 0
    return g.select(*keys, N, D,
                    F.when(has, F.col(D) / F.col(N)).otherwise(F.lit(0.0)).alias(RATE),
                    F.when(has, F.col("__w") / F.col(N)).otherwise(F.lit(0.0)).alias(AVG))


def filtered_summary(agg: DataFrame, where: Column | None = None) -> DataFrame:
    """One-row summary of an optional selection; zeros when it is empty."""
    src = agg if where is None else agg.filter(where)
    g = src.agg(F.coalesce(F.sum(N), F.lit(0)).cast("long").alias(N),
                F.coalesce(F.sum(D), F.lit(0)).cast("long").alias(D),
                F.count(F.lit(1)).alias("combo_count"))
    return g.withColumn(RATE, F.when(F.col(N) > 0, F.col(D) / F.col(N)).otherwise(F.lit(0.0)))


def leaderboard(agg: DataFrame, key: str, min_flights: int, limit: int | None = None) -> DataFrame:
    """Sums by key, clipped rate, minimum volume, by rate."""
    g = agg.groupBy(key).agg(*_sums([key])).withColumn(RATE, clipped_rate())
    g = g.withColumn("delay_rate_pct", rate_pct(F.col(RATE)))
    order = [F.col(RATE).desc(), F.col(key).asc()]
    if limit is None:
        return g.filter(F.col(N) >= min_flights)
    return R.top_n(g, order, limit, where=F.col(N) >= min_flights)


def bucket_rates(agg: DataFrame, bucket_col: str, where: Column | None = None,
                 min_combo_flights: int = 0) -> DataFrame:
    """Pooled rate per bucket label with domain display order.

    ``min_combo_flights`` drops small combinations before pooling.
    """
    src = agg if where is None else agg.filter(where)
    if min_combo_flights > 0:
        src = src.filter(F.col(N) >= min_combo_flights)
    g = src.groupBy(bucket_col).agg(*_sums([bucket_col])).withColumn(RATE, clipped_rate())
    order = B.BUCKET_ORDERS.get(bucket_col, [])
    return g.select(F.lit(bucket_col).alias("dimension"), F.col(bucket_col).alias("bucket"),
                    B.order_key(F.col(bucket_col), order).alias("bucket_order"), N, D, RATE,
                    rate_pct(F.col(RATE)).alias("delay_rate_pct"))


def rate_difference(rates: DataFrame, label_col: str, rate_col: str, hi: str, lo: str) -> DataFrame:
    """rate(hi) - rate(lo), null when either label is absent."""
    return rates.agg((F.max(F.when(F.col(label_col) == hi, F.col(rate_col)))
                      - F.max(F.when(F.col(label_col) == lo, F.col(rate_col)))).alias("rate_lift"))


def filter_routes(agg: DataFrame, carrier_col: str, origin_col: str, dest_col: str,
                  carriers: list[str] | None = None, origin: str | None = None,
                  dest: str | None = None, min_flights: int = 0) -> DataFrame:
    """Rows that meet every filter that is set."""
    wanted = [F.col(c).isin(list(v)) for c, v in
              ((carrier_col, carriers), (origin_col, origin and [origin]), (dest_col, dest and [dest])) if v]
    return agg.filter(reduce(lambda a, b: a & b, wanted, F.col(N) >= min_flights))


def top_segments(segments: DataFrame, segment_type: str, n: int = 15) -> DataFrame:
    """The first ``n`` segments of one type by rows."""
    one = segments.filter(F.col("segment_type") == segment_type)
    return R.top_n(one, [R.desc_pg("n_rows"), R.asc_pg("segment")], n)


def top_importances(importances: DataFrame, n: int = 12) -> DataFrame:
    """The first ``n`` features by mean importance."""
    return R.top_n(importances, [R.desc_pg("importance_mean"), R.asc_pg("feature")], n)
