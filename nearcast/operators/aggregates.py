"""Volume / rate / mean aggregates and their roll-ups.

Every aggregate here is a single ``groupBy`` / ``groupingSets`` so Spark does
a map-side partial aggregation before the shuffle: a key holding a third of
all rows costs one partial row per input partition, not one hot task.
Grains that the reference computes as separate scans glued with UNION ALL
are one ``groupingSets`` (one scan, one Expand, one shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output names of the standard measure set (A1).
N = "flight_count"
D = "delayed_count"
RATE = "delay_rate_15"
AVG = "avg_dep_delay_minutes"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: Column, den: Column, digits: int = 4, pct: bool = False) -> Column:
    """round(num / nullif(den, 0), digits), double; ``pct`` multiplies by 100 (A5)."""
    q = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    if pct:
        q = F.lit(100.0) * num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return F.round(q, digits)


def delay_measures(flag, measure, n: str = N, d: str = D, rate: str = RATE,
                   avg: str = AVG) -> list[Column]:
    """count, filtered count (null flag not counted), rate 4 dp, mean 2 dp (A1, A4, A5)."""
    f = _col(flag)
    return [
        F.count(F.lit(1)).alias(n),
        F.count_if(F.coalesce(f, F.lit(False))).alias(d),
        safe_ratio(F.count_if(F.coalesce(f, F.lit(False))), F.count(F.lit(1)), 4).alias(rate),
        F.round(F.avg(_col(measure).cast("double")), 2).alias(avg),
    ]


def delay_aggregate(df: DataFrame, keys: list, flag, measure, where: Column | None = None,
                    **names) -> DataFrame:
    """Delay by any grain: airport-hour, carrier-route, weather buckets."""
    src = df if where is None else df.filter(where)
    return src.groupBy(*keys).agg(*delay_measures(flag, measure, **names))


def weighted_measures(n: str = N, d: str = D, rate: str = RATE, avg: str = AVG) -> list[Column]:
    """Roll-up of pre-aggregated rows: sums, rate from sums, mean = sum(avg*n)/sum(n).

    Reproduces K10: the mean is re-weighted from an already rounded average,
    weighted by all rows of the group.
    """
    sn, sd = F.sum(F.col(n)), F.sum(F.col(d))
    return [
        sn.cast("long").alias(n),
        sd.cast("long").alias(d),
        safe_ratio(sd, sn, 4).alias(rate),
        F.round(F.sum(F.col(avg) * F.col(n)) / F.nullif(sn.cast("double"), F.lit(0.0)), 2).alias(avg),
    ]


def weighted_rollup(agg: DataFrame, keys: list, **names) -> DataFrame:
    """Airport-hour -> airport style roll-up."""
    return agg.groupBy(*keys).agg(*weighted_measures(**names))


def pooled_by_dimension(agg: DataFrame, dims: list[str], labels: list[str],
                        value_col: str = "bucket_value", report_col: str = "report") -> DataFrame:
    """One roll-up per dimension, tagged by report label.

    A single ``groupingSets`` pass; ``grouping_id`` picks the label and the
    dimension value. Labels are given in the order of ``dims``.
    """
    sets = [[d] for d in dims]
    g = agg.groupingSets(sets, *dims).agg(*weighted_measures(), F.grouping_id().alias("__gid"))
    nd = len(dims)
    label = None
    value = None
    for i, (d, lab) in enumerate(zip(dims, labels)):
        gid = (1 << nd) - 1 - (1 << (nd - 1 - i))   # only dim i is grouped
        cond = F.col("__gid") == gid
        label = F.when(cond, F.lit(lab)) if label is None else label.when(cond, F.lit(lab))
        value = F.when(cond, F.col(d)) if value is None else value.when(cond, F.col(d))
    return g.select(label.alias(report_col), value.alias(value_col),
                    *[c for c in (N, D, RATE, AVG)])


def grain_coverage(df: DataFrame, base_keys: list[str], grains: dict[str, list[str]],
                   matched: Column, grain_col: str = "grain", n: str = "flights",
                   m: str = "matched_flights", pct: str = "match_pct") -> DataFrame:
    """Match coverage at several grains in one pass.

    ``grains`` maps a label to the extra keys of that grain (on top of
    ``base_keys``); keys absent from a grain come out null.
    """
    extra = []
    for ks in grains.values():
        for k in ks:
            if k not in extra:
                extra.append(k)
    all_keys = list(base_keys) + extra
    sets = [list(base_keys) + list(ks) for ks in grains.values()]
    g = df.groupingSets(sets, *all_keys).agg(
        F.count(F.lit(1)).alias(n), F.count_if(matched).alias(m), F.grouping_id().alias("__gid"))
    label = None
    for lab, ks in grains.items():
        bits = 0
        for i, k in enumerate(all_keys):
            if k not in base_keys and k not in ks:
                bits |= 1 << (len(all_keys) - 1 - i)
        cond = F.col("__gid") == bits
        label = F.when(cond, F.lit(lab)) if label is None else label.when(cond, F.lit(lab))
    return g.select(label.alias(grain_col), *all_keys, n, m,
                    safe_ratio(F.col(m), F.col(n), 2, pct=True).alias(pct))


def coverage_by(df: DataFrame, keys: list, matched: Column, n: str = "flights",
                m: str = "matched_flights", pct: str = "match_pct") -> DataFrame:
    """n, matched, pct by keys (A10)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n), F.count_if(matched).alias(m)) \
        .withColumn(pct, safe_ratio(F.col(m), F.col(n), 2, pct=True))


def key_counts(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """row count, distinct keys, duplicates = count - distinct."""
    k = F.struct(*key_cols) if len(key_cols) > 1 else F.col(key_cols[0])
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.count_distinct(k).alias("distinct_keys")) \
        .withColumn("duplicate_keys", F.col("row_count") - F.col("distinct_keys"))


def exact_percentiles(df: DataFrame, keys: list[str], value: str, qs, names: list[str]) -> DataFrame:
    """Exact interpolated percentiles (``percentile_cont``) per group, without one task per group.

    Spark's ``percentile`` aggregate merges every distinct value of a group
    in one task. Here the (group, value) counts are pre-aggregated, cumulative
    counts come from a prefix sum partitioned by group *and* value range
    (splitters from a quantile sketch), and each quantile picks the values at ranks floor/ceil of q (n - 1).
    """
    from nearcast.operators.metrics import prefix_sums
    v = F.col(value).cast("double")
    c = df.filter(F.col(value).isNotNull()).groupBy(*keys, v.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    cum = prefix_sums(c, "__v", ["__c"], descending=False, partition_cols=keys)
    tot = c.groupBy(*keys).agg(F.sum("__c").alias("__n"))
    j = cum.join(tot, keys) if keys else cum.crossJoin(F.broadcast(tot))
    end = F.col("__c_cum") - 1                    # 0-based ascending rank of the value's last row
    start = F.col("__c_cum") - F.col("__c")
    aggs = []
    for q, name in zip(qs, names):
        h = F.lit(float(q)) * (F.col("__n") - 1)
        lo_r, hi_r = F.floor(h), F.ceil(h)
        lo = F.max(F.when((start <= lo_r) & (lo_r <= end), F.col("__v")))
        hi = F.max(F.when((start <= hi_r) & (hi_r <= end), F.col("__v")))
        aggs.append((lo + (hi - lo) * F.first(h - lo_r)).alias(name))
    return j.groupBy(*keys).agg(*aggs)


def percentiles(df: DataFrame, keys: list, value: str, qs=(0.5, 0.9, 0.99),
                digits: int = 2, prefix: str = "lag") -> DataFrame:
    """count, min, max, avg and exact interpolated percentiles.

    Percentiles come from :func:`exact_percentiles` (distributed, exact);
    count / min / max / avg are ordinary partial aggregates.
    """
    v = F.col(value).cast("double")
    base = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                 F.round(F.min(v), digits).alias(f"{prefix}_min"),
                                 F.round(F.max(v), digits).alias(f"{prefix}_max"),
                                 F.round(F.avg(v), digits).alias(f"{prefix}_avg"))
    names = [f"{prefix}_p{int(round(q * 100))}" for q in qs]
    pct = exact_percentiles(df, [k for k in keys], value, qs, [f"__{n}" for n in names])
    out = base.join(pct, keys, "left") if keys else base.crossJoin(pct)
    return out.select(*keys, "n", f"{prefix}_min", f"{prefix}_max", f"{prefix}_avg",
                      *[F.round(F.col(f"__{n}"), digits).alias(n) for n in names])
