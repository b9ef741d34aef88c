"""Bucket / label expressions (P13-P17, P25, L8) and their display orders.

Each bucket takes the measure column as a parameter so the same cut points
apply to any analogue measure.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket labels and display orders, as in the reference.
WIND_LABELS = ["calm_0_5kt", "light_6_15kt", "moderate_16_25kt", "strong_26plus_kt", "unknown"]
PRECIP_LABELS = ["none", "light", "moderate", "heavy"]
VISIBILITY_ORDER = ["high_over_10mi", "medium_3_10mi", "low_under_3mi", "unknown"]
MODEL_WIND_LABELS = ["unknown", "calm", "light", "moderate", "strong"]
LAG_LABELS = ["lag_gte_60m", "lag_30_to_60m", "lag_10_to_30m", "lag_0_to_10m", "lag_0m",
              "lag_neg_0_to_10m", "lag_neg_10_to_30m", "lag_neg_30_to_60m", "lag_lt_neg_60m"]
TIMING_LABELS = ["obs_before_dep", "obs_at_dep", "obs_after_dep"]
SANITY_LABELS = ["before_1970", "after_2030", "null_dep_time", "ok"]

BUCKET_ORDERS = {
    "wind_speed_bucket": WIND_LABELS,
    "precip_bucket": PRECIP_LABELS,
    "visibility_bucket": VISIBILITY_ORDER,
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wind_bucket(c) -> Column:
    """null -> unknown; <=5, <=15, <=25, else."""
    x = _col(c)
    return (F.when(x.isNull(), "unknown").when(x <= 5, "calm_0_5kt")
            .when(x <= 15, "light_6_15kt").when(x <= 25, "moderate_16_25kt")
            .otherwise("strong_26plus_kt"))


def precip_bucket(c) -> Column:
    """null or 0 -> none; <=0.1 light; <=0.3 moderate; else heavy."""
    x = _col(c)
    return (F.when(F.coalesce(x, F.lit(0)) == 0, "none").when(x <= 0.1, "light")
            .when(x <= 0.3, "moderate").otherwise("heavy"))


def visibility_bucket(c) -> Column:
    """null -> unknown; <3 low; <=10 medium; else high."""
    x = _col(c)
    return (F.when(x.isNull(), "unknown").when(x < 3, "low_under_3mi")
            .when(x <= 10, "medium_3_10mi").otherwise("high_over_10mi"))


def model_wind_bucket(c) -> Column:
    """Model-side short labels, same cut points."""
    x = _col(c)
    return (F.when(x.isNull(), "unknown").when(x <= 5, "calm").when(x <= 15, "light")
            .when(x <= 25, "moderate").otherwise("strong"))


def model_precip_bucket(c) -> Column:
    """Model-side precip labels; null counts as 0."""
    x = F.coalesce(_col(c), F.lit(0))
    return (F.when(x == 0, "none").when(x <= 0.1, "light").when(x <= 0.3, "moderate")
            .otherwise("heavy"))


def lag_bucket(c) -> Column:
    """Signed lag minutes -> 9 histogram labels."""
    x = _col(c)
    return (F.when(x >= 60, "lag_gte_60m").when(x >= 30, "lag_30_to_60m")
            .when(x >= 10, "lag_10_to_30m").when(x > 0, "lag_0_to_10m")
            .when(x == 0, "lag_0m").when(x >= -10, "lag_neg_0_to_10m")
            .when(x >= -30, "lag_neg_10_to_30m").when(x >= -60, "lag_neg_30_to_60m")
            .otherwise("lag_lt_neg_60m"))


def timing_label(c) -> Column:
    """Sign of lag -> before / at / after (P16); null stays null."""
    x = _col(c)
    return (F.when(x > 0, "obs_before_dep").when(x == 0, "obs_at_dep")
            .when(x < 0, "obs_after_dep"))


def sanity_label(ts, low: str = "1970-01-01", high: str = "2030-01-01") -> Column:
    """before_1970 / after_2030 / null_dep_time / ok."""
    x = _col(ts)
    return (F.when(x < F.lit(low).cast("timestamp"), "before_1970")
            .when(x >= F.lit(high).cast("timestamp"), "after_2030")
            .when(x.isNull(), "null_dep_time").otherwise("ok"))


def order_key(c, order: list[str]) -> Column:
    """Domain order of labels; unknown labels after all known ones.

    Sort by ``(order_key, label)`` so unknown labels come after, alphabetically.
    """
    arr = F.array(*[F.lit(v) for v in order])
    pos = F.array_position(arr, _col(c))
    return F.when(pos == 0, F.lit(len(order) + 1)).otherwise(pos)


def hour_label(c) -> Column:
    """'HH:00' (P25)."""
    return F.format_string("%02d:00", _col(c).cast("int"))


def route_label(origin, dest) -> Column:
    """'A → B' (P25)."""
    return F.concat(_col(origin), F.lit(" → "), _col(dest))


def combo_label(*cols, sep: str = " | ") -> Column:
    """Bucket combination label."""
    return F.concat_ws(sep, *[_col(c) for c in cols])
