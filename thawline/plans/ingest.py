"""Flagship plan: frozen buckets -> documents table, resumable and idempotent.

listing -> anti join completed checkpoints (J1) -> ``frozen_journal`` scan of
the pending journals (one task per journal, big first) -> text decode with the
Latin-1 fast path -> prefix strip + classification -> router/parsers -> stable
document id -> Parquet partitioned by run, attempt and index -> checkpoint rows
appended to the checkpoint log.  One Spark job writes the documents; no
shuffle between scan and write unless asked for.  A commit record (``commits.py``) makes the call
safe to break off anywhere: the next one brings it to its end or starts its buckets anew.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from thawline import storage
from thawline.functions.patterns import KINDS
from thawline.functions.text import decode_text_fast, iso_utc, strip_prefix
from thawline.operators import runs as R
from thawline.operators.classify import classify, parser_name
from thawline.operators.parse import PARSED_COLUMNS, route_and_parse
from thawline.plans import commits
from thawline.session import checkpoint_dir, compiled_methods, ensure_utc
from thawline.sinks.documents import DOC_COLUMNS, MAX_DOCUMENT_BYTES, enforce_schema, reject_reason
from thawline.sources import journal as JS
from thawline.sources.buckets import list_buckets


def parsed_events(ev: DataFrame) -> DataFrame:
    """Decoded journal events -> text decode (Latin-1 fast path), document id, classification, parsers."""
    ev = ev.withColumns({"message": decode_text_fast(F.col("message"), F.col("index_name")),
                         "bucket_key": R.bucket_key(F.col("index_name"), F.col("bucket_name"))})
    ev = ev.withColumn("doc_id", R.doc_id(F.col("bucket_key"), F.col("stream_id"),
                                          F.col("stream_offset"), F.col("stream_sub_offset"), F.col("event_ordinal")))
    return route_and_parse(classify(ev))


def documents(ev: DataFrame) -> DataFrame:
    """Decoded journal events -> parsed documents (flat columns)."""
    c = parsed_events(ev)
    return c.select(
        "doc_id", "bucket_key", "event_ordinal",
        iso_utc(F.col("ts_ms")).alias("ts_iso"), "message",
        strip_prefix(F.col("host")).alias("host"), strip_prefix(F.col("source")).alias("source"),
        strip_prefix(F.col("sourcetype")).alias("sourcetype"),
        F.col("kind").alias("event_kind"), F.col("dataset").alias("event_dataset"),
        F.col("index_name").alias("splunk_index"), F.col("index_time").alias("splunk_index_time"),
        F.col("bucket_name").alias("splunk_bucket_name"), F.col("bucket_latest").alias("splunk_bucket_latest"),
        F.col("bucket_earliest").alias("splunk_bucket_earliest"), parser_name(F.col("kind")).alias("splunk_pipeline"),
        F.col("reason").alias("splunk_classify_reason"),
        F.when(F.size("fields") > 0, F.col("fields")).alias("splunk_fields"),
        *[c for c in PARSED_COLUMNS if c != "ts_ms"],
        # Error.message -- processors ignore their own failures, so only a decode fault sets it
        F.col("_corrupt_reason").alias("error_message"))


METRIC_COLUMNS = ("bucket_key", "index_name", "status", "bucket_latest", "ingest_iteration", "attempt", "journal_size_bytes", "message_bytes",
                  "event_count", "docs_success", "docs_error", "wall_ms")
# event columns that documents are made of; the others are not built by the source
READ_COLUMNS = ("index_name", "bucket_name", "bucket_latest", "bucket_earliest", "event_ordinal", "index_time", "event_time_ms",
                "message", "host", "source", "sourcetype", "stream_id", "stream_offset", "stream_sub_offset", "fields", "_corrupt_reason")
# journal bytes for a task: parsed rows, many times that, are sorted by index before they are written
PARTITION_BYTES = 2 << 20
LOG_COLUMNS = ("bucket_key", "index_name", "bucket_name", "status", "indexed", "errors", "updated_at", "version")


def _step(name: str) -> None:
    """Marks the end of a step of ``ingest``; tests break a call off here."""


def ingest(spark: SparkSession, root: str, out_path: str, ingest_run: str, checkpoint_log_path: str | None = None,
           indices=None, bucket_names=None, resume: bool = True, force: bool = False,
           skip_metadata: bool = True, metrics: dict | None = None, mode: str = "FAILFAST",
           output_partition_bytes: int | None = None, max_records_per_file: int = 1_000_000,
           metrics_path: str | None = None, max_document_bytes: int = MAX_DOCUMENT_BYTES) -> DataFrame:
    """Run one ingest; returns the per-bucket results (completed, failed, and skipped when resuming).

    The documents of one call go to ``<out>/ingest_run=<run>/attempt=<unique>/splunk_index=...``.  An
    attempt is written under a hidden name and moved to its place when it is whole, so readers of
    ``out`` see whole attempts only, and an attempt never touches what others wrote.  Resuming a run
    adds an attempt with the buckets that no completed checkpoint names; ``force``, or a run without
    a checkpoint log, replaces the run's earlier attempts after its own is in place.

    A call that was broken off is taken up by the next call on ``out``: past its commit record it
    is carried out to the end (documents, log, metrics), before that nothing of it is kept.
    ``commits.read_documents`` gives the committed documents also in between.

    ``mode="PERMISSIVE"`` isolates bad journals: their buckets are reported and logged as
    ``failed`` with counts 0 and none of their documents reaches the table; FAILFAST ends the call
    at the first one.  The log gets ``in_progress`` rows before the write and the outcome after it.

    Documents that the table does not take (``reject_reason``: no time, a key field or, over
    ``max_document_bytes``, a message too long) are counted as ``errors`` of their bucket and written to
    ``<out>/_rejects`` with the reason in ``error_message`` (``commits.read_rejects``).

    ``metrics`` (a dict) receives the totals of the rows decoded, counted by an ``Observation``
    during the write itself, and the number of buckets per status.

    ``metrics_path``: a table to which the call appends one row per listed bucket (``METRIC_COLUMNS``):
    journal and message bytes, events decoded, documents by outcome, status, wall time of the call's
    scan-parse-write job.

    ``output_partition_bytes``: deal the decoded events anew into one partition per so many journal
    bytes before parsing and writing, so that a hot journal's parse and write work is spread;
    without it scan, parse and write are one narrow stage.
    """

    ensure_utc(spark)
    if mode.upper() not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"mode must be FAILFAST or PERMISSIVE, not {mode}")
    out_path = out_path.rstrip("/")
    recover(spark, out_path)
    attempt = uuid.uuid4().hex
    started = time.time_ns() // 1_000_000
    logged = checkpoint_log_path is not None and storage.exists(spark, checkpoint_log_path)
    latest = R.checkpoint_latest(spark.read.parquet(checkpoint_log_path)) if logged and resume and not force else None

    # one listing per call: it plans the scan (names and lengths go to the source as files in the
    # shared folder), gives the pending buckets, and is what the results are joined to
    work = f"{checkpoint_dir(spark).rstrip('/')}/thawline-ingest/{attempt}"
    list_buckets(spark, root, indices, bucket_names).write.parquet(f"{work}/listing")
    listing = spark.read.parquet(f"{work}/listing")
    pending = listing if latest is None else R.resume_pending(listing, latest, resume, force)
    skipped = None if latest is None else R.resume_skipped(listing, latest)
    if skipped is not None:
        skipped.write.parquet(f"{work}/skipped")  # as the log stands now; the call's own rows come later
        skipped = spark.read.parquet(f"{work}/skipped")
        pending.write.parquet(f"{work}/pending")
        pending = spark.read.parquet(f"{work}/pending")
    pending.select(F.concat_ws("\t", "journal_path", "journal_size_bytes")).write.text(f"{work}/journals")
    if checkpoint_log_path:
        _log(pending.select("bucket_key", "index_name", "bucket_name", F.lit("in_progress").alias("status"),
                            F.lit(0).cast("bigint").alias("indexed"), F.lit(0).cast("bigint").alias("errors")),
             checkpoint_log_path, started)
    _step("started")

    ev = JS.read(spark, None, pathsDir=f"{work}/journals", skipMetadata=str(skip_metadata).lower(), mode=mode,
                 columns=",".join(READ_COLUMNS), maxPartitionBytes=PARTITION_BYTES)
    if output_partition_bytes:
        size = pending.agg(F.sum("journal_size_bytes")).first()[0] or 0
        ev = ev.repartition(max(1, -(-size // output_partition_bytes)))
    obs = Observation(f"ingest-{attempt}")
    docs = documents(ev)
    reason = reject_reason(max_document_bytes)
    docs = docs.withColumn("rejected", F.col("error_message").isNull() & reason.isNotNull())
    docs = docs.withColumn("error_message", F.coalesce("error_message", reason))
    # the fixed document columns as declared, then ids and parsed fields
    docs = enforce_schema(docs, [c for c in docs.columns if c not in dict(DOC_COLUMNS)]).observe(
        obs, F.count(F.lit(1)).alias("documents"), F.count_if(F.col("error_message").isNotNull() & ~F.col("rejected")).alias("error_documents"),
        F.count_if("rejected").alias("rejected"), *(F.count_if(F.col("event_kind") == k).alias(k) for k in KINDS))
    began = time.time_ns() // 1_000_000
    run_dir, staged = f"{out_path}/ingest_run={ingest_run}", commits.staging(out_path, attempt)
    whole, parts = f"{staged}/all", ["rejected", "splunk_index"]
    with compiled_methods(spark):
        docs.write.option("maxRecordsPerFile", max_records_per_file).partitionBy(*parts).parquet(whole)
    totals = obs.get
    wall_ms = time.time_ns() // 1_000_000 - began
    _step("written")
    bad = spark.createDataFrame([], "bucket_key STRING, is_bad BOOLEAN")
    if totals["error_documents"]:
        rows = spark.read.schema(docs.schema).option("basePath", whole).parquet(whole)
        rows.where("error_message is not null and not rejected").select("bucket_key").distinct().write.parquet(f"{work}/failed")
        bad = spark.read.parquet(f"{work}/failed")
        commits.drop_buckets(spark, whole, bad, parts, max_records_per_file)
        bad = bad.withColumn("is_bad", F.lit(True))
    kept = spark.read.schema(docs.schema).option("basePath", whole).parquet(whole)
    # message lengths are only read where metrics are asked for
    size = F.sum(F.when(~F.col("rejected"), F.octet_length("message"))) if metrics_path else F.lit(0).cast("bigint")
    counts = kept.groupBy("bucket_key").agg(F.count_if(~F.col("rejected")).alias("indexed"), F.count_if("rejected").alias("errors"), size.alias("message_bytes"))
    results = pending.join(counts, "bucket_key", "left").join(bad, "bucket_key", "left").select(
        "bucket_key", "index_name", "bucket_name", "target_index", F.coalesce("indexed", F.lit(0)).alias("indexed"),
        F.coalesce("errors", F.lit(0)).alias("errors"), F.when(F.col("is_bad"), "failed").otherwise("completed").alias("status"),
        F.coalesce("message_bytes", F.lit(0)).alias("message_bytes"), "journal_size_bytes", F.col("latest_epoch").alias("bucket_latest"))
    if skipped is not None:  # the metric rows name skipped buckets too
        none = {c: F.lit(0).cast("bigint") for c in ("message_bytes", "indexed", "errors")}
        info = listing.select("bucket_key", "journal_size_bytes", F.col("latest_epoch").alias("bucket_latest"))
        results = results.unionByName(skipped.withColumns(none).join(info, "bucket_key"))
    saved = commits.results_path(out_path, attempt)
    results.write.parquet(saved)  # fixed before the commit
    _step("counted")

    def some(folder):
        return folder if storage.holds_files(spark, folder, ".parquet") else None

    replaced = [n for n in storage.children(spark, run_dir) if n.startswith("attempt=")] if force or checkpoint_log_path is None else []
    record = {"attempt": attempt, "run": ingest_run, "version": started + 1, "wall_ms": wall_ms, "documents": some(f"{whole}/rejected=false"),
              "rejects": some(f"{whole}/rejected=true"), "replaces": replaced, "log": checkpoint_log_path, "metrics": metrics_path}
    commits.write_record(spark, out_path, record)
    _step("committed")
    _carry_out(spark, out_path, record)
    results = spark.read.parquet(saved).where("status <> 'skipped'").drop("message_bytes", "journal_size_bytes", "bucket_latest")
    if metrics is not None:
        metrics.update(totals)
        metrics.update({r["status"]: r["count"] for r in results.groupBy("status").count().collect()})
    return results if skipped is None else R.run_results(skipped, results)


def _carry_out(spark: SparkSession, out_path: str, record: dict) -> None:
    """What follows a commit record; every step may be repeated."""
    commits.put_in_place(spark, out_path, record)
    _step("placed")
    results = spark.read.parquet(commits.results_path(out_path, record["attempt"]))
    if record["log"]:
        # a repeated row has the same version: the latest state is the same
        own = results.where("status <> 'skipped'").select("bucket_key", "index_name", "bucket_name", "status", "indexed", "errors")
        _log(own, record["log"], record["version"])
    _step("logged")
    if record["metrics"]:
        rows = results.select(
            "bucket_key", "index_name", "status", "bucket_latest", F.lit(record["run"]).alias("ingest_iteration"), F.lit(record["attempt"]).alias("attempt"),
            "journal_size_bytes", "message_bytes", (F.col("indexed") + F.col("errors")).alias("event_count"), F.col("indexed").alias("docs_success"),
            F.col("errors").alias("docs_error"), F.lit(record["wall_ms"]).cast("bigint").alias("wall_ms"))
        if storage.exists(spark, record["metrics"]):  # rows that a broken-off call has appended already
            there = spark.read.parquet(record["metrics"]).where(F.col("attempt") == record["attempt"]).select("bucket_key")
            rows = rows.join(there, "bucket_key", "left_anti")
        rows.select(*METRIC_COLUMNS).write.mode("append").parquet(record["metrics"])
    _step("measured")
    commits.close(spark, out_path, record)
    _step("closed")


def recover(spark: SparkSession, out_path: str) -> list[str]:
    """Bring calls that were broken off to their end (attempts past their commit), drop what others left; returns the former."""
    out_path = out_path.rstrip("/")
    records = commits.open_records(spark, out_path)
    for r in records:
        _carry_out(spark, out_path, r)
    commits.drop_abandoned(spark, out_path)
    return [r["attempt"] for r in records]


def clear_checkpoints(spark: SparkSession, checkpoint_log_path: str, bucket_keys=None) -> None:
    """Append tombstones for the named buckets, or for all: the next ingest takes them up again."""
    latest = R.checkpoint_latest(spark.read.parquet(checkpoint_log_path))
    if bucket_keys is not None:
        latest = latest.where(F.col("bucket_key").isin(list(bucket_keys)))
    gone = latest.select("bucket_key", "index_name", "bucket_name", F.lit(R.CLEARED).alias("status"),
                         F.lit(0).cast("bigint").alias("indexed"), F.lit(0).cast("bigint").alias("errors"))
    _log(gone, checkpoint_log_path, time.time_ns() // 1_000_000)


def _log(rows: DataFrame, path: str, version: int) -> None:
    """Append checkpoint rows; ``version`` is the call's time in ms, so calls within a second keep their order."""
    rows = rows.withColumns({"updated_at": F.lit(version // 1000).cast("bigint"), "version": F.lit(version).cast("bigint")})
    rows.select(*LOG_COLUMNS).write.mode("append").parquet(path)
