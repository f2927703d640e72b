"""telemetra: device-telemetry tables as composable PySpark operators.

Sub-packages
------------
functions   pure Column builders (casts, null counts, JSON attributes, predicates)
operators   DataFrame -> DataFrame operators (quality rules, keyed rows, inspection)
sources     batch readers (parquet tables, catalog tables, typed items, snapshots)
sinks       the keyed, partitioned lake table (versioned snapshots + catalog)
plans       end-to-end pipelines (batch clean, change-driven refresh)
streaming   Structured Streaming ingest and change-event matching
"""

__version__ = "0.1.0"
