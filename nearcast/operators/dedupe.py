"""Keep-latest dedupe.

``max(struct(order, row))`` per key: partial aggregation runs before the
shuffle, so a key with a third of all rows sends one row per map partition.
Structs are no fixed-width buffers, so Spark plans a sort aggregate, each side
sorted by key within its partition; the row itself is carried once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: list, order_desc: list, keep: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest ``order_desc`` tuple; remaining ties by the row itself.

    ``keys`` are names or aliased Columns; ``keep`` are the payload columns
    (default: every column that is not a key name).
    """
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    key_names = df.select(*key_cols).columns
    keep = keep or [c for c in df.columns if c not in key_names]
    payload = F.struct(*[F.col(c) for c in keep])
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_desc])
    # the payload is part of what is compared, so it is carried once
    best = F.max(F.struct(order.alias("o"), payload.alias("p"))).alias("__best")
    return df.groupBy(*key_cols).agg(best).select(*key_names, "__best.p.*")
