"""Metric rollups over the per-bucket rows that an ingest appends (counters, histograms, gauges, ratios)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Histogram upper bounds (ours; the archive tool does not state them).
BOUNDS = (10, 50, 100, 500, 1000, 5000, 10000)
HIST_METRICS = ("event_count", "message_bytes")
STATUSES = ("completed", "failed", "skipped")


def rollup(m: DataFrame) -> DataFrame:
    """A10: counters per (index, iteration): journals, events, bytes, docs by result, buckets by status."""
    return m.groupBy("index_name", "ingest_iteration").agg(
        F.count(F.lit(1)).alias("journals"), F.sum("event_count").alias("events"), F.sum("message_bytes").alias("bytes"),
        F.sum("docs_success").alias("docs_success"), F.sum("docs_error").alias("docs_error"),
        *(F.count_if(F.col("status") == s).alias(f"buckets_{s}") for s in STATUSES))


def histogram(m: DataFrame) -> DataFrame:
    """Cumulative bucket counts ``count(v <= le)`` per (index, iteration, metric, le), ``+Inf`` last."""
    keys = ["index_name", "ingest_iteration"]
    long = m.select(*keys, F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("bigint").alias("v"))
                                                for n in HIST_METRICS])).alias("mv")).select(*keys, "mv.*")
    bounds = F.array(*[F.lit(b).cast("bigint") for b in BOUNDS], F.lit(None).cast("bigint"))
    long = long.withColumn("bound", F.explode(bounds))
    return long.groupBy(*keys, "metric", "bound").agg(
        F.count_if(F.col("bound").isNull() | (F.col("v") <= F.col("bound"))).alias("count")
    ).select(*keys, "metric", F.coalesce(F.col("bound").cast("string"), F.lit("+Inf")).alias("le"), "count")


def latest_gauges(m: DataFrame) -> DataFrame:
    """Last-value gauges per iteration: events and message bytes of the latest completed bucket."""
    order = F.struct("bucket_latest", "bucket_key")
    done = m.where("status = 'completed'")
    return done.groupBy("ingest_iteration").agg(
        F.max_by("event_count", order).alias("last_event_count"), F.max_by("message_bytes", order).alias("last_message_bytes"))


def throughput(m: DataFrame) -> DataFrame:
    """Documents per second of each call's scan-parse-write job, zero-guarded (a call's rows share its wall time)."""
    per_call = m.groupBy("ingest_iteration", "attempt").agg(F.sum("docs_success").alias("docs"), F.max("wall_ms").alias("wall_ms"))
    agg = per_call.groupBy("ingest_iteration").agg(F.sum("docs").alias("docs"), F.sum("wall_ms").alias("wall_ms"))
    return agg.withColumn("docs_per_s", F.when(F.col("wall_ms") > 0, F.col("docs") * 1000.0 / F.col("wall_ms")).otherwise(F.lit(0.0)))
