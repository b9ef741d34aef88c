"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Model-fitting queries (``MODEL_QUERIES``) run once and are reported beside the
total (``model_queries``), which so stays comparable between rounds: the
reference publishes no training times. Each query is forced end to end with the ``noop`` sink (full computation, no driver
collection). A warm-up query runs first so JVM start-up and code
generation of the first plan are not charged to one query. Per-query times
are the best of ``$BENCH_REPEAT`` runs (default 2: steady state, after the
JIT has compiled that operator's code); ``cold_value`` is the total of the
first runs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from nearcast.plans.queries import MODEL_QUERIES, QUERIES  # noqa: E402
from nearcast.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # warm-up: JVM, Parquet readers, codegen
    QUERIES["delay_by_key_hour"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    models: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        best = None
        for _ in range(1 if name in MODEL_QUERIES else repeat):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if name not in MODEL_QUERIES:
                cold.setdefault(name, dt)
            best = dt if best is None else min(best, dt)
        (models if name in MODEL_QUERIES else times)[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "repeat": repeat,
                      "cold_value": round(sum(cold.values()), 3), "model_queries": models}))
    spark.stop()


if __name__ == "__main__":
    main()
