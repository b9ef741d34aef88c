"""Exact ranking metrics without a single-partition window.

All metrics reduce to cumulative counts over distinct scores:

1. ``groupBy(score)`` -> (pos, neg) per distinct score (map-side combine: a
   constant score over a third of the rows becomes one row).
2. Distributed prefix sum (:func:`prefix_sums`): distinct scores are cut into
   ranges of equal numbers of rows at splitters from a quantile sketch;
   totals per range give the offsets; a window partitioned by range adds the
   local running sum. No global window, however the scores are distributed.
3. Metrics are sums over that table.

Definitions follow the reference's metric library: step-wise average
precision (not the trapezoid ``areaUnderPR``), ROC-AUC with ties counted one
half, Brier score, positive rate, precision at the recall nearest 0.5 (ties ->
lowest threshold), lift in the top decile at the interpolated 0.9 quantile.
Scores are clipped to [0, 1].
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearcast.session import materialize

#: Distinct values of one running sum; a range of a prefix sum has about as many rows.
ROWS_PER_BUCKET = 500_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip01(c) -> Column:
    """Clip to [0, 1]."""
    return F.least(F.greatest(_col(c).cast("double"), F.lit(0.0)), F.lit(1.0))


def score_counts(df: DataFrame, score, label, segments: list[str] | None = None) -> DataFrame:
    """(segments..., s, pos, neg) per distinct clipped score."""
    segs = list(segments or [])
    y = F.when(_col(label).cast("boolean"), 1).otherwise(0)
    return (df.select(*segs, clip01(score).alias("s"), y.alias("__y"))
            .groupBy(*segs, "s")
            .agg(F.sum("__y").cast("long").alias("pos"),
                 (F.count(F.lit(1)) - F.sum("__y")).cast("long").alias("neg")))


def splitters(df: DataFrame, order_col: str, rows_per_bucket: int, buckets: int | None = None) -> list[float]:
    """Values of ``order_col`` that cut the rows into ranges of about ``rows_per_bucket`` (sample-sort splitters).

    They come from Spark's mergeable quantile sketch, so they follow the data:
    values crowded in one corner get as many splitters as they have rows. The
    list has one value per ``rows_per_bucket`` rows.
    """
    k = buckets or -(-df.count() // rows_per_bucket)
    if k <= 1:
        return []
    row = df.agg(F.percentile_approx(order_col, [i / k for i in range(1, k)], max(10_000, 20 * k)).alias("e")).first()
    return sorted({v for v in row["e"] or [] if v is not None})


def values_below(edges: list[float], x: Column) -> Column:
    """How many of the sorted ``edges`` are less than ``x``: two levels of about sqrt(len) comparisons."""
    if not edges:
        return F.lit(0)
    step = max(1, math.isqrt(len(edges)))
    blocks = [edges[i:i + step] for i in range(0, len(edges), step)]

    def fixed(values: list[float]) -> Column:
        return F.array(*[F.lit(float(v)) for v in values])
    full = F.size(F.filter(fixed([b[-1] for b in blocks]), lambda e: e < x))
    within = F.size(F.filter(F.get(F.array(*map(fixed, blocks)), full), lambda e: e < x))
    return F.when(full == len(blocks), F.lit(len(edges))).otherwise(full * step + within)


def prefix_sums(df: DataFrame, order_col: str, value_cols: list[str], *, descending: bool = True,
                partition_cols: list[str] | None = None, rows_per_bucket: int = ROWS_PER_BUCKET,
                buckets: int | None = None, suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``value_cols`` along ``order_col`` (unique per partition).

    Distributed: rows are cut into ranges of the order column of about
    ``rows_per_bucket`` rows (:func:`splitters`), each range runs a local
    running sum, and totals per range give the offsets. ``buckets`` sets the
    number of ranges instead. The rows are written once, because the splitters,
    the totals and the sums read them.
    """
    parts = list(partition_cols or [])
    s = F.col(order_col)
    df = materialize(df)
    edges = splitters(df, order_col, rows_per_bucket, buckets)
    order = s.desc() if descending else s.asc()
    if not edges:
        w = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(w).cast("long").alias(f"{c}{suffix}") for c in value_cols])
    b = values_below(edges, s)
    d = df.withColumn("__b", F.lit(len(edges)) - b if descending else b)
    totals = d.groupBy(*parts, "__b").agg(*[F.sum(c).alias(f"__t_{c}") for c in value_cols])
    # offsets: one row per (partition, range)
    w_off = Window.partitionBy(*parts).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*parts, "__b", *[F.coalesce(F.sum(f"__t_{c}").over(w_off), F.lit(0))
                                              .alias(f"__o_{c}") for c in value_cols])
    w_loc = Window.partitionBy(*parts, "__b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = d.select("*", *[F.sum(c).over(w_loc).alias(f"__l_{c}") for c in value_cols])
    out = local.join(offsets, parts + ["__b"])
    return out.select(*df.columns, *[(F.col(f"__o_{c}") + F.col(f"__l_{c}")).cast("long")
                                     .alias(f"{c}{suffix}") for c in value_cols])


def cumulative_table(df: DataFrame, score, label, segments: list[str] | None = None) -> DataFrame:
    """Per distinct score (descending): pos, neg; tp, fp = counts with score >= s;
    rank = number of distinct scores >= s; segment totals P, N."""
    segs = list(segments or [])
    c = score_counts(df, score, label, segs).withColumn("one", F.lit(1))
    cum = prefix_sums(c, "s", ["pos", "neg", "one"], descending=True, partition_cols=segs)
    cum = (cum.withColumnRenamed("pos_cum", "tp").withColumnRenamed("neg_cum", "fp")
           .withColumnRenamed("one_cum", "rank").drop("one"))
    tot = c.groupBy(*segs).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return cum.join(tot, segs) if segs else cum.crossJoin(F.broadcast(tot))


def _metric_aggs() -> list[Column]:
    P, N = F.first("P"), F.first("N")
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    # no positives: every recall is 1 (the metric library's convention)
    recall = F.when(F.col("P") > 0, F.col("tp") / F.col("P")).otherwise(F.lit(1.0))
    # row-level divisions use try_divide: aggregates are evaluated before the
    # CASE guard on the result, and ANSI mode raises on a zero divisor
    ap = F.sum(F.try_divide(F.col("pos"), F.col("P")) * prec)
    auc = F.try_divide(F.sum(F.col("pos") * (F.col("N") - F.col("fp") + 0.5 * F.col("neg"))), P * N)
    # precision at the recall nearest 0.5; ties -> lowest threshold
    p_at_r = F.min_by(prec, F.struct(F.abs(recall - F.lit(0.5)), F.col("s")))
    brier = F.sum(F.col("pos") * F.pow(F.col("s") - 1.0, 2) + F.col("neg") * F.pow(F.col("s"), 2)) / (P + N)
    return [
        F.when(P > 0, ap).otherwise(F.lit(0.0)).alias("pr_auc"),
        F.when((P > 0) & (N > 0), auc).alias("roc_auc"),
        brier.alias("brier"),
        (P / (P + N)).alias("positive_rate"),
        (P + N).cast("double").alias("n_rows"),
        p_at_r.alias("precision_at_recall_50"),
    ]


def ranking_metrics(df: DataFrame, score, label, segments: list[str] | None = None,
                    trapezoid: bool = False) -> DataFrame:
    """pr_auc (step AP), roc_auc, brier, positive_rate, n_rows, precision_at_recall_50,
    lift_at_top_decile (+ pr_auc_trapezoid) - one row per segment (M9, M10, M16, M19)."""
    segs = list(segments or [])
    # the cumulative table feeds 2-3 branches: materialise it once
    cum = materialize(cumulative_table(df, score, label, segs))
    m = cum.groupBy(*segs).agg(*_metric_aggs())
    parts = [top_decile_lift(cum, segs)]
    if trapezoid:
        parts.append(pr_auc_trapezoid(cum, segs))
    for p in parts:
        m = m.join(p, segs) if segs else m.crossJoin(p)
    return m


def exact_quantiles_from_counts(cum: DataFrame, qs: list[float], segs: list[str],
                                names: list[str] | None = None) -> DataFrame:
    """Interpolated quantiles (``percentile_cont``) from the descending cumulative table.

    A value s with count c = pos + neg and ge = tp + fp occupies ascending
    ranks [n - ge, n - ge + c - 1]; quantile q interpolates the values at
    ranks floor(h) and ceil(h), h = q (n - 1). All quantiles come out of one
    aggregate over the (distinct-score) table.
    """
    names = names or [f"q{i}" for i in range(len(qs))]
    n = F.col("P") + F.col("N")
    start = n - (F.col("tp") + F.col("fp"))
    end = start + F.col("pos") + F.col("neg") - 1
    aggs = []
    for q, name in zip(qs, names):
        h = F.lit(q) * (n - 1)
        lo_r, hi_r = F.floor(h), F.ceil(h)
        lo = F.max(F.when((start <= lo_r) & (lo_r <= end), F.col("s")))
        hi = F.max(F.when((start <= hi_r) & (hi_r <= end), F.col("s")))
        frac = F.first(h - lo_r)
        aggs.append((lo + (hi - lo) * frac).alias(name))
    return cum.groupBy(*segs).agg(*aggs)


def exact_quantile_from_counts(cum: DataFrame, q: float, segs: list[str]) -> DataFrame:
    """Single interpolated quantile as column ``q`` (see :func:`exact_quantiles_from_counts`)."""
    return exact_quantiles_from_counts(cum, [q], segs, ["q"])


def top_decile_lift(cum: DataFrame, segments: list[str] | None = None, q: float = 0.9) -> DataFrame:
    """mean(y | score >= interpolated q-quantile) / mean(y); 0 if empty or base 0."""
    segs = list(segments or [])
    cut = exact_quantile_from_counts(cum, q, segs)
    j = cum.join(cut, segs) if segs else cum.crossJoin(F.broadcast(cut))
    top = j.filter(F.col("s") >= F.col("q")).groupBy(*segs).agg(
        F.sum("pos").alias("__tp"), F.sum(F.col("pos") + F.col("neg")).alias("__tn"),
        F.first("P").alias("__P"), F.first("N").alias("__N"))
    base = F.col("__P") / (F.col("__P") + F.col("__N"))
    lift = F.when((base == 0) | (F.col("__tn") == 0), F.lit(0.0)).otherwise(
        (F.col("__tp") / F.col("__tn")) / base)
    return top.select(*segs, lift.alias("lift_at_top_decile"))


def _points(cum: DataFrame, segs: list[str]) -> DataFrame:
    return cum.select(*segs, "rank", F.col("s").alias("threshold"), "tp", "fp",
                      (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                      F.when(F.col("P") > 0, F.col("tp") / F.col("P")).otherwise(F.lit(1.0))
                      .alias("recall"))


def pr_points(df: DataFrame, score, label, segments: list[str] | None = None) -> DataFrame:
    """Precision-recall points per distinct threshold (M19); rank 1 = highest threshold."""
    segs = list(segments or [])
    return _points(cumulative_table(df, score, label, segs), segs)


def pr_auc_trapezoid(cum: DataFrame, segments: list[str] | None = None) -> DataFrame:
    """Trapezoid area under the PR points incl. the (recall 0, precision 1) end.

    The point before a threshold follows from the threshold's own row: its
    counts without the rows that have exactly this score. No join, no window.
    """
    segs = list(segments or [])
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    share = lambda tp: F.coalesce(F.try_divide(tp, F.col("P")), F.lit(1.0))
    precision0 = F.coalesce(F.try_divide(tp0, tp0 + fp0), F.lit(1.0))
    recall0 = F.when(tp0 + fp0 == 0, F.lit(0.0)).otherwise(share(tp0))
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return cum.groupBy(*segs).agg(
        F.sum((share(F.col("tp")) - recall0) * (precision + precision0) / 2).alias("pr_auc_trapezoid"))


def calibration_bins(df: DataFrame, score, label, n_bins: int = 10) -> DataFrame:
    """Quantile-binned calibration table.

    Edges are the exact interpolated 1/n, ..., (n-1)/n quantiles of the
    scores (from the cumulative table, a one-row result broadcast back); a
    score's bin is the number of inner edges strictly below it. Only
    non-empty bins appear.
    """
    cum = materialize(cumulative_table(df, score, label, None))
    names = [f"e{i}" for i in range(1, n_bins)]
    edges = exact_quantiles_from_counts(cum, [i / n_bins for i in range(1, n_bins)], [], names)
    edges = edges.select(F.array(*[F.col(c) for c in names]).alias("__edges"))
    # bin per distinct score (on the pre-aggregated counts), then sum
    j = cum.crossJoin(F.broadcast(edges))
    j = j.withColumn("bin", F.size(F.filter(F.col("__edges"), lambda e: e < F.col("s"))))
    return j.groupBy("bin").agg(
        F.sum(F.col("pos") + F.col("neg")).cast("long").alias("n"),
        (F.sum(F.col("s") * (F.col("pos") + F.col("neg"))) / F.sum(F.col("pos") + F.col("neg"))).alias("mean_score"),
        (F.sum("pos") / F.sum(F.col("pos") + F.col("neg"))).alias("positive_share"))
