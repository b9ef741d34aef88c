"""Delay-risk modelling data work as Spark ML jobs.

Fits, transforms and metrics are distributed: Spark ML estimators train on
the partitioned data, scores come from ``transform``, and every metric is the
exact distributed ranking metric of :mod:`nearcast.operators.metrics`. The
driver only loops over folds x models (a handful of fits), never over rows.

Deliberate differences from the reference's single-machine library (SURVEY
7.4): the median imputer is Spark's (approximate quantile), ``trees`` are Spark's
GBT (no L2 term; ``boosted`` has it), and the seeded subsample
picks a different (but equally sized, seeded and reproducible) subset.
"""

from __future__ import annotations

import math
import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import (
    Imputer, ImputerModel, OneHotEncoder, OneHotEncoderModel, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearcast.operators import boosting as BT
from nearcast.operators import metrics as MT
from nearcast.session import materialize
from nearcast.operators import reports as R

# The reference's feature sets (M2).
SCHEDULE_FEATURES = ["reporting_airline", "origin", "dest", "dep_hour_utc", "dep_dow", "dep_month",
                     "dep_time_source"]
WEATHER_FEATURES = ["wind_speed_knots", "wind_gust_knots", "precip_1hr_inches", "visibility_miles",
                    "temperature_f", "relative_humidity_pct", "weather_obs_lag_minutes", "is_precip",
                    "sin_hour", "cos_hour"]
FEATURE_SETS = {
    "schedule_only": list(SCHEDULE_FEATURES),
    "weather_only": ["origin", *WEATHER_FEATURES],
    "full": SCHEDULE_FEATURES + WEATHER_FEATURES,
}
CATEGORICAL_FEATURES = ["reporting_airline", "origin", "dest", "dep_time_source"]
MAX_CATEGORIES = 30
OTHER = "__other__"

# Default boosted-tree parameters (M5).
GBT_DEFAULTS = {"maxDepth": 8, "stepSize": 0.1, "maxIter": 200, "minInstancesPerNode": 50}


def add_derived_features(df: DataFrame, precip: str = "precip_1hr_inches", hour: str = "dep_hour_utc") -> DataFrame:
    """is_precip (null -> 0, > 0) and the cyclic hour."""
    rad = F.lit(2 * math.pi) * F.coalesce(F.col(hour).cast("double"), F.lit(0.0)) / 24.0
    return (df.withColumn("is_precip", (F.coalesce(F.col(precip).cast("double"), F.lit(0.0)) > 0).cast("int"))
            .withColumn("sin_hour", F.sin(rad)).withColumn("cos_hour", F.cos(rad)))


def frequent_categories(df: DataFrame, cols: list[str], max_categories: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """The ``max_categories - 1`` most frequent values per column of the training rows (M3): bounded top-k reports."""
    return {c: [r[c] for r in R.top_n(df.groupBy(c).count().filter(F.col(c).isNotNull()),
                                      [F.col("count").desc(), F.col(c).asc()], max_categories - 1).select(c).collect()]
            for c in cols}


def with_categories(df: DataFrame, frequent: dict[str, list[str]]) -> DataFrame:
    """Values outside a column's frequent ones become one bucket; nulls stay."""
    return df.withColumns({c: F.when(F.col(c).isin(keep), F.col(c).cast("string")).when(F.col(c).isNotNull(), F.lit(OTHER))
                           for c, keep in frequent.items()}) if frequent else df


def cap_categories(df: DataFrame, cols: list[str], max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """Both steps on the same rows; for a train/test split take the values from the training rows."""
    return with_categories(df, frequent_categories(df, cols, max_categories))


def one_hot(df: DataFrame, features: list[str], frequent: dict[str, list[str]]) -> tuple[DataFrame, list[str]]:
    """Numeric columns only: a 0/1 column per frequent value and one for the others; a value never seen has none (M3).

    Returns the frame and the names of its feature columns.
    """
    columns = {f"{c}__{i}": F.coalesce(F.col(c) == v, F.lit(False)).cast("double")
               for c, values in frequent.items() for i, v in enumerate([*values, OTHER])}
    return df.withColumns(columns), [c for c in features if c not in frequent] + list(columns)


def preprocessing_stages(features: list[str], categorical: list[str] = CATEGORICAL_FEATURES) -> list:
    """Median impute + standardise numerics; index + one-hot categoricals, unknowns ignored (M3)."""
    num = [c for c in features if c not in categorical]
    cat = [c for c in features if c in categorical]
    stages: list = []
    parts: list[str] = []
    if num:
        imp = [f"{c}__imp" for c in num]
        stages += [Imputer(strategy="median", inputCols=num, outputCols=imp),
                   VectorAssembler(inputCols=imp, outputCol="__num_raw", handleInvalid="keep"),
                   StandardScaler(inputCol="__num_raw", outputCol="__num", withMean=True, withStd=True)]
        parts.append("__num")
    if cat:
        idx = [f"{c}__idx" for c in cat]
        oh = [f"{c}__oh" for c in cat]
        stages += [StringIndexer(inputCols=cat, outputCols=idx, handleInvalid="keep"),
                   # the indexer's last index is "unknown": dropping it leaves unknowns without a column
                   OneHotEncoder(inputCols=idx, outputCols=oh, dropLast=True)]
        parts += oh
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return stages


def with_balanced_weights(df: DataFrame, label: str, weight: str = "class_weight") -> DataFrame:
    """sklearn-style balanced weights n / (2 n_class) from one aggregate (M4)."""
    y = F.col(label).cast("int")
    # fixed numbers: a join to the aggregate would read the rows anew in every pass of a fit
    n, p = df.agg(F.count(F.lit(1)), F.sum(y)).first()
    one, other = (F.lit(n / (2.0 * rows) if rows else None).cast("double") for rows in (p, n - (p or 0)))
    return df.withColumn(weight, F.when(y == 1, one).otherwise(other))


def logistic_pipeline(features: list[str], label: str, max_iter: int = 300,
                      categorical: list[str] = CATEGORICAL_FEATURES, rows: int | None = None) -> Pipeline:
    """Balanced logistic regression (M4) with the reference's default L2 term.

    The reference minimises |w|^2 / 2 + the weighted sum of losses; Spark divides
    the losses by the sum of the weights, which balanced weights make the number
    of training ``rows``. So the same minimum has regParam = 1 / rows, on the
    coefficients as they are (no standardisation); the intercept is free in both.
    Without ``rows`` there is no L2 term.
    """
    # tol 1e-4: the convergence tolerance of the reference's solver default
    lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol="class_weight",
                            maxIter=max_iter, tol=1e-4, regParam=1.0 / rows if rows else 0.0, standardization=not rows)
    return Pipeline(stages=preprocessing_stages(features, categorical) + [lr])


def gbt_pipeline(features: list[str], label: str, params: dict | None = None, seed: int = 42,
                 categorical: list[str] = CATEGORICAL_FEATURES) -> Pipeline:
    """Boosted trees (M5)."""
    p = dict(GBT_DEFAULTS)
    p.update(params or {})
    gbt = GBTClassifier(featuresCol="features", labelCol=label, seed=seed, **p)
    return Pipeline(stages=preprocessing_stages(features, categorical) + [gbt])


def score(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    """Positive-class probability."""
    t = model.transform(df)
    return t.withColumn(out, vector_to_array("probability")[1])


def baseline_score(train: DataFrame, val: DataFrame, label: str, out: str = "score") -> DataFrame:
    """Constant train positive rate for every validation row (M6)."""
    rate = train.agg(F.avg(F.col(label).cast("double")).alias(out))
    return val.crossJoin(F.broadcast(rate))


def seeded_subsample(df: DataFrame, n: int | None, seed: int, key: list[str]) -> DataFrame:
    """Exactly n rows chosen by a seeded hash order - a sampling operator (M8).

    Ranks in the seeded hash order come from the distributed prefix sum, so the n kept rows never pass
    through one task the way ``orderBy().limit(n)`` would.
    """
    if n is None:
        return df
    u = F.xxhash64(*[F.col(k) for k in key], F.lit(seed)).cast("double") / F.lit(2.0 ** 64) + 0.5
    d = df.withColumn("__u", u).withColumn("__one", F.lit(1))
    ranked = MT.prefix_sums(d, "__u", ["__one"], descending=False)
    return ranked.filter(F.col("__one_cum") <= n).drop("__u", "__one", "__one_cum")


def fold_frames(df: DataFrame, fold: tuple[str, str, str, str], ym_col: str = "year_month"):
    """Expanding window: train <= end, validation in the closed month range (M7)."""
    _, train_end, val_start, val_end = fold
    train = df.filter(F.col(ym_col) <= train_end)
    val = df.filter((F.col(ym_col) >= val_start) & (F.col(ym_col) <= val_end))
    return train, val


def cv_run(df: DataFrame, folds: list[tuple], label: str, feature_set: str = "full",
           features: list[str] | None = None, models: tuple[str, ...] = ("baseline", "logistic", "trees"),
           ym_col: str = "year_month", subsample: int | None = None,
           seed: int = 42, key: list[str] | None = None, gbt_params: dict | None = None,
           lr_iter: int = 300, categorical: list[str] = CATEGORICAL_FEATURES, boost_params: dict | None = None) -> DataFrame:
    """Folds x models -> one metric row each.

    Models: ``baseline``, ``logistic``, ``trees`` (Spark ML) and ``boosted``
    (histogram trees with the reference's parameters, see ``boosting``).
    """
    feats = features or FEATURE_SETS[feature_set]
    key = key or df.columns
    scored = []

    def tag(df: DataFrame, fold: str, model: str) -> DataFrame:
        return df.select(F.col("score").cast("double").alias("score"), F.col(label).alias(label),
                         F.lit(fold).alias("fold"), F.lit(model).alias("model"))

    for fold in folds:
        train, val = fold_frames(df, fold, ym_col)
        train = seeded_subsample(train, subsample, seed, key)
        frequent = frequent_categories(train, [c for c in feats if c in categorical])
        train, val = with_categories(train, frequent), with_categories(val, frequent)
        if "baseline" in models:
            scored.append(tag(baseline_score(train, val, label), fold[0], "baseline_global_rate"))
        if "logistic" in models:
            m = logistic_pipeline(feats, label, lr_iter, categorical, train.count()).fit(with_balanced_weights(train, label))
            scored.append(tag(score(m, val), fold[0], "logistic_regression"))
        if "trees" in models:
            m = gbt_pipeline(feats, label, gbt_params, seed, categorical).fit(train)
            scored.append(tag(score(m, val), fold[0], "trees_default"))
        if "boosted" in models:
            numeric, names = one_hot(train, feats, frequent)
            boosted = BT.fit(numeric, names, label, **(boost_params or {}))
            scored.append(tag(BT.scored(one_hot(val, feats, frequent)[0], boosted, names), fold[0], "boosted_default"))
    # every fold x model in one segmented metric pass (one prefix sum, one materialisation)
    out = MT.ranking_metrics(R.tagged_union(scored), "score", label, ["fold", "model"])
    return out.withColumn("feature_set", F.lit(feature_set))


def cv_summary(cv: DataFrame, metrics: tuple[str, ...] = ("pr_auc", "roc_auc", "brier", "lift_at_top_decile")) -> DataFrame:
    """Mean and sample standard deviation per model x feature set."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_std")]
    return cv.groupBy("model", "feature_set").agg(*aggs)


def ablation(df: DataFrame, folds: list[tuple], label: str, feature_sets=("schedule_only", "weather_only", "full"),
             **kw) -> DataFrame:
    """Trees on each feature set."""
    return R.tagged_union([cv_run(df, folds, label, fs, models=("trees",), **kw) for fs in feature_sets])


def random_search(df: DataFrame, folds: list[tuple], label: str, trials: int = 30, seed: int = 42,
                  features: list[str] | None = None, overrides: dict | None = None,
                  **kw) -> tuple[dict, DataFrame]:
    """Seeded random search maximising mean fold average precision.

    Search space (fixed values): depth 4-12, step size 0.01-0.2 (log),
    iterations 100-300 step 50, min rows per leaf 20-200 step 10.
    ``overrides`` pins sampled parameters (e.g. a small iteration count).
    """
    rng = random.Random(seed)
    results = []
    best, best_ap = None, -1.0
    for t in range(trials):
        params = {"maxDepth": rng.randint(4, 12),
                  "stepSize": math.exp(rng.uniform(math.log(0.01), math.log(0.2))),
                  "maxIter": rng.choice(range(100, 301, 50)),
                  "minInstancesPerNode": rng.choice(range(20, 201, 10))}
        params.update(overrides or {})
        cv = cv_run(df, folds, label, "full", features, models=("trees",), gbt_params=params, seed=seed, **kw)
        ap = cv.agg(F.avg("pr_auc")).first()[0]
        results.append((t, params["maxDepth"], params["stepSize"], params["maxIter"],
                        params["minInstancesPerNode"], float(ap)))
        if ap > best_ap:
            best, best_ap = params, ap
    spark = df.sparkSession
    trials_df = spark.createDataFrame(results, "trial int, max_depth int, step_size double, max_iter int, "
                                               "min_rows_per_leaf int, mean_pr_auc double")
    return {"params": best, "value": best_ap}, trials_df


def fit_save(pipeline: Pipeline, train: DataFrame, path: str) -> PipelineModel:
    """Final fit on all training rows and persistence."""
    model = pipeline.fit(train)
    model.write().overwrite().save(path)
    return model


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def holdout_report(model: PipelineModel, train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Baseline and model metrics on the holdout, absolute and relative AP lift."""
    sel = lambda d, name: d.select(F.col("score").cast("double").alias("score"), F.col(label).alias(label),
                                   F.lit(name).alias("model"))
    both = MT.ranking_metrics(sel(baseline_score(train, test, label), "baseline_global_rate")
                              .unionByName(sel(score(model, test), "model")), "score", label, ["model"])
    lift = both.agg((F.max(F.when(F.col("model") == "model", F.col("pr_auc")))
                     - F.max(F.when(F.col("model") != "model", F.col("pr_auc")))).alias("pr_auc_lift_abs"),
                    (F.max(F.when(F.col("model") == "model", F.col("pr_auc")))
                     / F.max(F.when(F.col("model") != "model", F.col("pr_auc")))).alias("pr_auc_lift_rel"))
    return both.crossJoin(lift)


def segment_report(scored: DataFrame, label: str, segment_col: str, base_rate: float | DataFrame,
                   min_rows: int = 5000) -> DataFrame:
    """Per segment: rows, positive rate, model / baseline AP and their difference."""
    s = scored.withColumn("__seg", F.col(segment_col).cast("string"))
    b = (F.broadcast(base_rate.select(F.col(base_rate.columns[0]).alias("__b")))
         if isinstance(base_rate, DataFrame) else None)
    sb = s.crossJoin(b) if b is not None else s.withColumn("__b", F.lit(float(base_rate)))
    both = s.select("__seg", label, F.col("score").cast("double").alias("__s"), F.lit("m").alias("__w")) \
        .unionByName(sb.select("__seg", label, F.col("__b").cast("double").alias("__s"), F.lit("b").alias("__w")))
    # model and baseline in one segmented metric pass
    mt = MT.ranking_metrics(both, "__s", label, ["__seg", "__w"])
    pick = lambda w, c: F.first(F.when(F.col("__w") == w, F.col(c)), ignorenulls=True)
    j = mt.groupBy("__seg").agg(pick("m", "n_rows").alias("n_rows"), pick("m", "positive_rate").alias("positive_rate"),
                                pick("m", "pr_auc").alias("__m"), pick("b", "pr_auc").alias("__bl")) \
        .filter(F.col("n_rows") >= min_rows)
    return j.select(F.lit(segment_col).alias("segment_type"), F.col("__seg").alias("segment"),
                    F.col("n_rows").cast("long").alias("n_rows"), F.round("positive_rate", 4).alias("positive_rate"),
                    F.round("__m", 4).alias("pr_auc_model"), F.round("__bl", 4).alias("pr_auc_baseline"),
                    F.round(F.col("__m") - F.col("__bl"), 4).alias("pr_auc_lift"))


def _random_rank(df: DataFrame, seed: int, col: str, n: int) -> DataFrame:
    """Dense 1..n rank of rows in a seeded random order.

    The order is that of hashes of distinct row numbers, which spread evenly, so
    ranges of equal width hold about as many rows each; no splitters are needed.
    """
    u = F.xxhash64(F.col("__rid"), F.lit(seed)).cast("double") / F.lit(2.0 ** 64) + 0.5
    ranges = max(1, -(-n // MT.ROWS_PER_BUCKET))
    at = F.least(F.floor(u * ranges), F.lit(ranges - 1))
    sizes = df.select("__rid").groupBy(at.alias("__at")).agg(F.count("*").alias("__size"))
    before = sizes.select("__at", F.coalesce(F.sum("__size").over(Window.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                          .alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__at").orderBy("__u", "__rid"))
    return df.withColumns({"__u": u, "__at": at}).withColumn("__inside", inside).join(F.broadcast(before), "__at") \
        .withColumn(col, F.col("__before") + F.col("__inside")).drop("__u", "__at", "__inside", "__before")


def _additive_parts(model: PipelineModel, features: list[str]) -> tuple[dict[str, list[int]], list[float], float] | None:
    """Slots of the feature vector per feature, coefficients and what the margin must exceed; None if not of ``logistic_pipeline``."""
    last = model.stages[-1]
    if not isinstance(last, LogisticRegressionModel) or last.numClasses != 2 or not 0 < last.getThreshold() < 1:
        return None
    slots: dict[str, list[int]] = {}
    imputers = [s for s in model.stages if isinstance(s, ImputerModel)]
    encoders = [s for s in model.stages if isinstance(s, OneHotEncoderModel)]
    indexers = [s for s in model.stages if isinstance(s, StringIndexerModel)]
    sizes = [(c, 1) for s in imputers for c in s.getInputCols()]
    if len(indexers) == len(encoders) <= 1:
        sizes += [(c, n - int(e.getDropLast())) for i, e in zip(indexers, encoders, strict=True)
                  for c, n in zip(i.getInputCols(), e.categorySizes, strict=True)]
    for c, n in sizes:
        start = sum(map(len, slots.values()))
        slots[c] = list(range(start, start + n))
    if set(slots) != set(features) or sum(map(len, slots.values())) != last.numFeatures:
        return None
    t = last.getThreshold()
    return slots, [float(c) for c in last.coefficients], math.log(t / (1 - t)) - last.intercept


def permutation_importance(model: PipelineModel, df: DataFrame, features: list[str], label: str,
                           repeats: int = 3, seed: int = 42) -> DataFrame:
    """Accuracy drop when one feature's values are shuffled across rows.

    Per repeat, one seeded permutation pairs every row with the row of the
    same rank in a second random order; each feature's variant swaps in the
    partner's value for that feature only. A logistic model's margin is a sum
    of one part per feature, so its parts are written once for every row and a
    variant swaps one part; the variants of other models are scored in one
    ``transform``. Mean and population std of the drop over ``repeats`` (the
    reference's estimator default score is accuracy).
    """
    # every row takes part under a number of its own; written once, so the numbers are the same in every read
    base = materialize(df.withColumn("__rid", F.monotonically_increasing_id()))
    parts = _additive_parts(model, features)
    if parts:
        slots, weights, cut = parts
        x = model.transform(base).select("__rid", F.col(label).cast("double").alias("__y"), vector_to_array("features").alias("__x"))
        own = {f"__c{i}": sum((F.get("__x", F.lit(k)) * weights[k] for k in slots[f]), F.lit(0.0)) for i, f in enumerate(features)}
        base = materialize(x.select("__rid", "__y", *[c.alias(n) for n, c in own.items()]))
        swapped = list(own)
        margin = sum((F.col(n) for n in swapped[1:]), F.col(swapped[0]))

        def correct(m):
            return (F.when((m > cut) & ~F.isnan(m), 1.0).otherwise(0.0) == F.col("__y")).cast("double")
        acc0 = base.agg(F.avg(correct(margin))).first()[0]
    else:
        keep, swapped = [c for c in base.columns if c != "__rid"], features
        right = (F.col("prediction") == F.col(label).cast("double")).cast("double")
        acc0 = model.transform(base).agg(F.avg(right)).first()[0]
    n = base.count()
    drops: dict[str, list[float]] = {f: [] for f in features}
    for r in range(repeats):
        a = _random_rank(base, seed * 1000 + r, "__ra", n)
        b = _random_rank(base.select("__rid", *[F.col(c).alias(f"__p_{c}") for c in swapped]),
                         seed * 1000 + r + 7919, "__ra", n).drop("__rid")
        perm = a.join(b, "__ra")
        if parts:
            accuracy = perm.agg(*[F.avg(correct(margin - F.col(c) + F.col(f"__p_{c}"))).alias(f) for c, f in zip(swapped, features, strict=True)]).first().asDict()
        else:
            variants = [F.struct(F.lit(f).alias("__feature"), *[F.col(f"__p_{f}" if c == f else c).alias(c) for c in keep]) for f in features]
            scored = model.transform(perm.select(F.explode(F.array(*variants)).alias("v")).select("v.*"))
            accuracy = {row["__feature"]: row["acc"] for row in scored.groupBy("__feature").agg(F.avg(right).alias("acc")).collect()}
        for f in features:
            drops[f].append(acc0 - accuracy[f])
    rows = []
    for f in features:
        d = drops[f]
        mean = sum(d) / len(d)
        rows.append((f, float(mean), float((sum((x - mean) ** 2 for x in d) / len(d)) ** 0.5)))
    return df.sparkSession.createDataFrame(rows, "feature string, importance_mean double, importance_std double")


def split_profile(df: DataFrame, label: str, split_col: str, ym_col: str, count_cols: dict[str, str],
                  missing_cols: dict[str, str]) -> DataFrame:
    """Rows, positive rate, distinct months/keys, missing shares per split."""
    aggs = [F.count(F.lit(1)).alias("rows"),
            F.round(F.avg(F.col(label).cast("double")), 4).alias("positive_rate"),
            F.count_distinct(ym_col).alias("months")]
    aggs += [F.count_distinct(c).alias(n) for n, c in count_cols.items()]
    aggs += [F.round(F.avg(F.col(c).isNull().cast("double")), 4).alias(n) for n, c in missing_cols.items()]
    return df.groupBy(split_col).agg(*aggs)
