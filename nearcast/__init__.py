"""nearcast — Spark-native event/observation analytics.

Layers (each a set of ``DataFrame -> DataFrame`` functions):

* ``sources``   — all-text CSV / zipped-CSV scans, lineage, idempotent reloads
* ``functions`` — Column expressions: cleaning, local time -> UTC, buckets, keys
* ``operators`` — nearest as-of join, aggregates, roll-ups, reports, quality
                  checks, incremental merge, ranking metrics, model data work
* ``plans``     — assembled flows (staging -> joined fact -> marts) and the
                  registered queries on the driver tables
* ``streaming`` — the file-drop ingest expressed as Structured Streaming
"""

__version__ = "0.1.0"
