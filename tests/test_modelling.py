"""Modelling data work on a tiny synthetic training frame (fits kept small)."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearcast.operators import modelling as ML


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    n = 600
    months = [f"2024-{m:02d}" for m in range(1, 13)]
    data = []
    for i in range(n):
        hour = int(rng.integers(0, 24))
        wind = float(rng.gamma(2, 5)) if rng.random() > 0.1 else None
        origin = str(rng.choice(["ATL", "ORD", "DEN", "LAX"]))
        y = float(rng.random() < (0.15 + 0.02 * (wind or 0) / 5 + (0.2 if hour > 17 else 0)))
        data.append((i, months[i % 12], origin, hour, wind, None if i % 7 else 0.1, y))
    df = spark.createDataFrame(data, "id long, year_month string, origin string, dep_hour_utc int, "
                                     "wind_speed_knots double, precip_1hr_inches double, target double")
    return ML.add_derived_features(df)


FEATS = ["origin", "dep_hour_utc", "wind_speed_knots", "is_precip", "sin_hour", "cos_hour"]
FOLDS = [("fold1", "2024-06", "2024-07", "2024-12"), ("fold2", "2024-09", "2024-10", "2024-12")]


def test_derived_features(rows):
    r = rows.filter("id = 0").first()
    assert r["is_precip"] == 1 and r["sin_hour"] == pytest.approx(np.sin(2 * np.pi * r["dep_hour_utc"] / 24))


def test_cap_categories(spark):
    df = spark.createDataFrame([(c,) for c in "aaabbc"], "k string")
    got = sorted(r["k"] for r in ML.cap_categories(df, ["k"], 3).collect())
    assert got == ["__other__", "a", "a", "a", "b", "b"]


def test_cv_and_summary(rows):
    cv = ML.cv_run(rows, FOLDS, "target", "t", features=FEATS, models=("baseline", "logistic", "trees"),
                   categorical=["origin"], key=["id"], gbt_params={"maxIter": 5, "maxDepth": 3,
                                                                   "minInstancesPerNode": 5})
    got = {(r["fold"], r["model"]): r for r in cv.collect()}
    assert len(got) == 6
    base = got[("fold1", "baseline_global_rate")]
    assert base["pr_auc"] == pytest.approx(base["positive_rate"])          # constant score: AP = rate
    s = ML.cv_summary(cv).collect()
    assert {r["model"] for r in s} == {"baseline_global_rate", "logistic_regression", "trees_default"}


def test_subsample_is_seeded_and_exact(rows):
    a = sorted(r["id"] for r in ML.seeded_subsample(rows, 50, 42, ["id"]).collect())
    b = sorted(r["id"] for r in ML.seeded_subsample(rows, 50, 42, ["id"]).collect())
    assert a == b and len(a) == 50


def test_fit_save_load_holdout_segments_importance(spark, rows, tmp_dir):
    train = rows.filter(F.col("year_month") <= "2024-09")
    test = rows.filter(F.col("year_month") > "2024-09")
    pipe = ML.logistic_pipeline(FEATS, "target", 50, ["origin"])
    path = os.path.join(tmp_dir, "model")
    ML.fit_save(pipe, ML.with_balanced_weights(train, "target"), path)
    model = ML.load_model(path)
    rep = {r["model"]: r for r in ML.holdout_report(model, train, test, "target").collect()}
    assert set(rep) == {"baseline_global_rate", "model"}
    seg = ML.segment_report(ML.score(model, test), "target", "origin", 0.3, min_rows=10).collect()
    assert {r["segment"] for r in seg} <= {"ATL", "ORD", "DEN", "LAX"} and seg
    imp = {r["feature"]: r for r in ML.permutation_importance(model, test, FEATS, "target", repeats=2).collect()}
    assert set(imp) == set(FEATS)
    best, trials = ML.random_search(rows, FOLDS[:1], "target", trials=2, features=FEATS,
                                    overrides={"maxIter": 3, "maxDepth": 3},
                                    categorical=["origin"], key=["id"])
    assert trials.count() == 2 and set(best["params"]) == {"maxDepth", "stepSize", "maxIter", "minInstancesPerNode"}


def test_logistic_has_the_l2_term(spark):
    """Coefficients against Newton steps on |w|^2 / 2 + balanced losses, intercept free."""
    rng = np.random.default_rng(3)
    n = 80  # few rows, so that the term matters
    x = rng.normal(size=(n, 2)) * [1, 5]
    y = (rng.random(n) < 1 / (1 + np.exp(1.2 - 2 * x[:, 0]))).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(x, y, strict=True)], "a double, b double, y double")
    model = ML.logistic_pipeline(["a", "b"], "y", 300, [], rows=n).fit(ML.with_balanced_weights(df, "y"))
    z = np.column_stack([np.ones(n), (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)])
    weight = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    free, w = np.diag([0.0, 1.0, 1.0]), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve(z.T @ (z * (weight * p * (1 - p))[:, None]) + free, z.T @ (weight * (p - y)) + free @ w)
    got = model.stages[-1]
    assert np.allclose([got.intercept, *got.coefficients], w, atol=2e-3)
    plain = ML.logistic_pipeline(["a", "b"], "y", 300, []).fit(ML.with_balanced_weights(df, "y")).stages[-1]
    assert abs(plain.coefficients[0]) > 1.05 * abs(w[1])


def test_importance_swaps_parts_of_a_logistic_margin(spark, rows, monkeypatch):
    """The parts give what scoring every variant gives, with fewer scored rows."""
    pipe = ML.logistic_pipeline(FEATS, "target", 50, ["origin"])
    model = pipe.fit(ML.with_balanced_weights(rows, "target"))
    scored = []
    transform = type(model).transform
    monkeypatch.setattr(type(model), "transform", lambda self, df, *a: scored.append(1) or transform(self, df, *a))
    test = rows.withColumn("origin", F.when(F.col("id") % 5 > 0, F.col("origin")).otherwise("new"))
    parts = {r["feature"]: r for r in ML.permutation_importance(model, test, FEATS, "target", repeats=3).collect()}
    assert len(scored) == 1
    monkeypatch.setattr(ML, "_additive_parts", lambda *a: None)
    whole = {r["feature"]: r for r in ML.permutation_importance(model, test, FEATS, "target", repeats=3).collect()}
    for f in FEATS:
        assert parts[f][1:] == pytest.approx(whole[f][1:], abs=1e-9), f
    assert any(r["importance_std"] > 0 for r in parts.values())
