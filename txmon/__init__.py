"""txmon — transaction monitoring analytics on Spark.

Layout:
  sources/    readers for the input tables, the two data models, sinks
  functions/  column-expression helpers (time, money, scoring)
  operators/  enrichment, rule engine, precision, fan-out weights, graph, quality
  plans/      the analysis queries, read models, exports and reports
  streaming/  Structured Streaming velocity monitor
  oracle/     DuckDB SQL text used as an independent check
"""

from txmon.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
