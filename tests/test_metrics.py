"""Ranking metrics vs direct numpy statements of the same definitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearcast.operators import metrics as MT


def np_metrics(y, s):
    y = np.asarray(y, dtype=int)
    s = np.clip(np.asarray(s, dtype=float), 0, 1)
    thr = np.unique(s)[::-1]                       # descending distinct thresholds
    P = y.sum()
    N = len(y) - P
    tp = np.array([y[s >= t].sum() for t in thr], dtype=float)
    fp = np.array([(1 - y[s >= t]).sum() for t in thr], dtype=float)
    prec = tp / (tp + fp)
    rec = tp / P if P > 0 else np.ones_like(tp)
    rec_prev = np.concatenate([[0.0], rec[:-1]])
    ap = float(np.sum((rec - rec_prev) * prec)) if P > 0 else 0.0
    # Mann-Whitney AUC with ties counted 1/2
    auc = None
    if P > 0 and N > 0:
        pos, neg = s[y == 1], s[y == 0]
        auc = float(((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (P * N))
    brier = float(np.mean((s - y) ** 2))
    # precision at recall nearest 0.5: arrays in ascending-threshold order, end point (r=0, p=1)
    r_arr = np.concatenate([rec[::-1], [0.0]])
    p_arr = np.concatenate([prec[::-1], [1.0]])
    p_at = float(p_arr[np.argmin(np.abs(r_arr - 0.5))])
    base = y.mean()
    if base == 0:
        lift = 0.0
    else:
        cut = np.quantile(s, 0.9)
        top = s >= cut
        lift = float(y[top].mean() / base) if top.any() else 0.0
    # trapezoid area over the PR points (recall decreasing)
    area = float(np.sum((r_arr[:-1] - r_arr[1:]) * (p_arr[:-1] + p_arr[1:]) / 2))
    return dict(pr_auc=ap, roc_auc=auc, brier=brier, positive_rate=float(base), n_rows=float(len(y)),
                precision_at_recall_50=p_at, lift_at_top_decile=lift, pr_auc_trapezoid=area)


def spark_metrics(spark, y, s):
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    r = MT.ranking_metrics(df, "s", "y", trapezoid=True).first().asDict()
    return r


@pytest.mark.parametrize("case", ["random", "ties", "constant", "perfect", "no_pos", "clipped"])
def test_metrics_match_definitions(spark, case):
    rng = np.random.default_rng(3)
    n = 300
    y = (rng.random(n) < 0.3).astype(int)
    if case == "random":
        s = rng.random(n)
    elif case == "ties":
        s = np.round(rng.random(n), 1)
    elif case == "constant":
        s = np.full(n, 0.25)
    elif case == "perfect":
        s = y * 0.9 + 0.05
    elif case == "no_pos":
        y = np.zeros(n, dtype=int)
        s = rng.random(n)
    else:
        s = rng.normal(0.5, 0.6, n)
    exp = np_metrics(y, s)
    got = spark_metrics(spark, y, s)
    for k, v in exp.items():
        if v is None:
            assert got[k] is None, k
        else:
            assert got[k] == pytest.approx(v, rel=1e-9, abs=1e-12), (case, k)
    if case == "constant":
        assert got["pr_auc"] == pytest.approx(y.mean())
    if case == "perfect":
        assert got["pr_auc"] == pytest.approx(1.0) and got["roc_auc"] == pytest.approx(1.0)


def test_segments_and_calibration(spark):
    rng = np.random.default_rng(5)
    n = 600
    seg = rng.choice(["a", "b", "c"], n)
    y = (rng.random(n) < 0.4).astype(int)
    s = np.round(rng.random(n), 2)
    df = spark.createDataFrame([(str(a), int(b), float(c)) for a, b, c in zip(seg, y, s)], "g string, y int, s double")
    got = {r["g"]: r for r in MT.ranking_metrics(df, "s", "y", ["g"]).collect()}
    for g in "abc":
        e = np_metrics(y[seg == g], s[seg == g])
        assert got[g]["pr_auc"] == pytest.approx(e["pr_auc"], rel=1e-9)
        assert got[g]["roc_auc"] == pytest.approx(e["roc_auc"], rel=1e-9)
        assert got[g]["lift_at_top_decile"] == pytest.approx(e["lift_at_top_decile"], rel=1e-9)
    cal = {r["bin"]: r for r in MT.calibration_bins(df, "s", "y", 10).collect()}
    edges = np.percentile(s, np.arange(0, 101, 10))
    bins = np.searchsorted(edges[1:-1], s)          # side='left': inner edges strictly below
    for b in np.unique(bins):
        assert cal[int(b)]["n"] == int((bins == b).sum())
        assert cal[int(b)]["positive_share"] == pytest.approx(y[bins == b].mean())
        assert cal[int(b)]["mean_score"] == pytest.approx(s[bins == b].mean())


def test_prefix_sums_quantile_edges(spark):
    rng = np.random.default_rng(9)
    v = rng.normal(0, 100, 500)
    df = spark.createDataFrame([(float(x), 1) for x in v], "x double, one int")
    out = MT.prefix_sums(df, "x", ["one"], descending=False, buckets=16)
    got = {r["x"]: r["one_cum"] for r in out.collect()}
    order = np.sort(v)
    for i, x in enumerate(order):
        assert got[float(x)] == i + 1


def _skewed_scores(spark, n=40_000):
    """99 % of the scores below 0.001."""
    u = F.rand(5)
    return spark.range(n).select("id", F.when(F.col("id") % 100 == 0, u).otherwise(u / 1000).alias("score"), (F.rand(6) < 0.2).cast("int").alias("y"))


def test_splitters_follow_crowded_scores(spark):
    df = _skewed_scores(spark).cache()
    edges = MT.splitters(df, "score", 500)
    sizes = [r["count"] for r in df.groupBy(MT.values_below(edges, F.col("score")).alias("b")).count().collect()]
    assert len(sizes) == 80 and max(sizes) <= 2 * np.median(sizes)
    assert sum(e < 0.001 for e in edges) > 70  # a fixed grid of 65,536 cells has 66 there, whatever the number of rows
    df.unpersist()


def test_values_below_against_counting(spark):
    edges = sorted({round(x, 3) for x in np.random.default_rng(1).random(137)})
    xs = [*edges[:40], -1.0, 2.0, *np.random.default_rng(2).random(60)]
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = df.select("x", MT.values_below(edges, F.col("x")).alias("n")).collect()
    assert all(r.n == sum(e < r.x for e in edges) for r in got)
    assert df.select(MT.values_below([], F.col("x")).alias("n")).distinct().collect()[0].n == 0


def test_prefix_sums_are_the_same_for_any_number_of_ranges(spark):
    df = _skewed_scores(spark, 4000).withColumn("seg", F.col("id") % 3).withColumn("one", F.lit(1))
    for descending in (True, False):
        outs = [{r.id: (r.one_cum, r.y_cum) for r in MT.prefix_sums(df, "score", ["one", "y"], descending=descending, partition_cols=["seg"], rows_per_bucket=k).collect()}
                for k in (10_000, 700, 60)]
        assert outs[0] == outs[1] == outs[2]
        assert max(v[0] for v in outs[0].values()) == 1334
