"""thawline: archived machine-log analytics expressed as Spark DataFrame plans.

Layout:
  sources/    bucket listing, the ``frozen_journal`` data source, the derived log corpus
  functions/  Column -> Column helpers (text decode, prefix strip, regex patterns, repr quoting)
  operators/  classification, parse router, profiles, resume joins, op-log replay, metrics
  sinks/      document tables, NDJSON bulk lines, batching, checkpoint log
  plans/      end-to-end plans (ingest, scan, dry run) and the DuckDB oracle SQL
  streaming/  incremental ingest with Structured Streaming
"""

__version__ = "0.1.0"
