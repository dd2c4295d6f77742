"""Bucket bookkeeping: keys, targets, resume joins, checkpoint log, run results and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thawline.operators.classify import TARGET_PREFIX


def bucket_key(index_name: Column, bucket_name: Column) -> Column:
    """``index/bucket``."""
    return F.concat_ws("/", index_name, bucket_name)


def target_index(index_name: Column) -> Column:
    """Plain target name of an index."""
    return F.concat(F.lit(TARGET_PREFIX), index_name)


def versioned_target(index_name: Column, iteration: Column, run_ms: Column) -> Column:
    """``{prefix}{index}-{iteration}-{YYYYMMDDHHMMSS}`` (run time in UTC)."""
    return F.concat(F.lit(TARGET_PREFIX), index_name, F.lit("-"), iteration, F.lit("-"),
                    F.date_format(F.timestamp_millis(run_ms), "yyyyMMddHHmmss"))


def buckets_of(raw: DataFrame) -> DataFrame:
    """Distinct buckets of an event table (partial aggregation map-side, one row per bucket)."""
    b = raw.groupBy("index_name", "bucket_name").agg(
        F.max("bucket_latest").alias("bucket_latest"), F.max("bucket_earliest").alias("bucket_earliest"),
        F.max("bucket_seq").alias("bucket_seq"))
    return b.withColumns({"bucket_key": bucket_key(F.col("index_name"), F.col("bucket_name")),
                          "target_index": target_index(F.col("index_name"))})


def bucket_stats(raw: DataFrame) -> DataFrame:
    """Per bucket: bounds and sequence, events, empty-message events, message bytes (one aggregate)."""
    b = raw.groupBy("index_name", "bucket_name").agg(
        F.max("bucket_latest").alias("bucket_latest"), F.max("bucket_earliest").alias("bucket_earliest"),
        F.max("bucket_seq").alias("bucket_seq"), F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("message") == "").alias("n_empty"), F.sum(F.octet_length("message")).alias("n_bytes"))
    return b.withColumns({"bucket_key": bucket_key(F.col("index_name"), F.col("bucket_name")),
                          "target_index": target_index(F.col("index_name"))})


def listing_with_empty(buckets: DataFrame) -> DataFrame:
    """Bucket listing plus, per index, one bucket (the next day) that holds no events."""
    nxt = buckets.groupBy("index_name").agg((F.max("bucket_earliest") + 86400).alias("bucket_earliest"))
    nxt = nxt.select(
        "index_name",
        F.concat(F.lit("db_"), (F.col("bucket_earliest") + 86399).cast("string"), F.lit("_"),
                 F.col("bucket_earliest").cast("string"), F.lit("_"),
                 (F.floor(F.col("bucket_earliest") / 86400) % 100).cast("string")).alias("bucket_name"),
        (F.col("bucket_earliest") + 86399).alias("bucket_latest"), "bucket_earliest",
        (F.floor(F.col("bucket_earliest") / 86400) % 100).alias("bucket_seq"))
    nxt = nxt.withColumns({"bucket_key": bucket_key(F.col("index_name"), F.col("bucket_name")),
                           "target_index": target_index(F.col("index_name"))})
    return buckets.unionByName(nxt)


STATUSES = ("in_progress", "completed", "failed")
CLEARED = "cleared"


def checkpoint_log(buckets: DataFrame, counts: DataFrame) -> DataFrame:
    """K4 input: append-only checkpoint log derived from the run history of each bucket.

    A bucket with sequence s has versions 0..(s % 3); earlier versions are
    ``in_progress``, the last is completed / failed / completed / in_progress by
    ``s % 4``; buckets with ``s % 10 == 9`` were cleared afterwards (tombstone).
    """
    b = buckets.join(counts.select("bucket_key", "n_events", "n_empty"), "bucket_key", "left")
    last = F.col("bucket_seq") % 3
    tomb = F.when(F.col("bucket_seq") % 10 == 9, 1).otherwise(0)
    b = b.withColumn("version", F.explode(F.sequence(F.lit(0).cast("bigint"), last + tomb)))
    final = F.when(F.col("bucket_seq") % 4 == 1, F.lit("failed")).when(
        F.col("bucket_seq") % 4 == 3, F.lit("in_progress")).otherwise(F.lit("completed"))
    status = (F.when(F.col("version") > last, F.lit(CLEARED))
              .when(F.col("version") < last, F.lit("in_progress")).otherwise(final))
    done = status == "completed"
    return b.select(
        "bucket_key", "index_name", "bucket_name", status.alias("status"),
        F.when(done, F.coalesce(F.col("n_events") - F.col("n_empty"), F.lit(0))).otherwise(0).alias("indexed"),
        F.when(done, F.coalesce(F.col("n_empty"), F.lit(0))).otherwise(0).alias("errors"),
        (F.col("bucket_latest") + 60 * F.col("version")).alias("updated_at"),
        "version")


def checkpoint_latest(log: DataFrame) -> DataFrame:
    """State after the upserts: latest version per bucket (aggregate, no sort); a
    clear tombstone removes the record."""
    order = F.struct("updated_at", "version")
    latest = log.groupBy("bucket_key").agg(
        F.max_by(F.struct("index_name", "bucket_name", "status", "indexed", "errors", "updated_at"), order).alias("r"))
    latest = latest.select("bucket_key", "r.*")
    return latest.where(F.col("status") != CLEARED)


def resume_pending(listing: DataFrame, latest: DataFrame, resume: bool = True, force: bool = False) -> DataFrame:
    """Buckets still to ingest: the listing minus completed checkpoints (anti join).

    ``force`` clears every checkpoint first and ``resume=False`` ignores them: both keep all buckets.
    """
    if force or not resume:
        return listing
    done = latest.where(F.col("status") == "completed").select("bucket_key")
    return listing.join(done, "bucket_key", "left_anti")


def resume_skipped(listing: DataFrame, latest: DataFrame) -> DataFrame:
    """Completed buckets reported as ``skipped`` with their recorded counts."""
    done = latest.where(F.col("status") == "completed").select("bucket_key", "indexed", "errors")
    return listing.join(done, "bucket_key", "inner").select(
        "bucket_key", "index_name", "bucket_name", "target_index", "indexed", "errors",
        F.lit("skipped").alias("status"))


def processed_results(pending: DataFrame, counts: DataFrame) -> DataFrame:
    """Per processed bucket: documents written (non-empty) and rejected (empty message)."""
    p = pending.join(counts.select("bucket_key", "n_events", "n_empty"), "bucket_key", "left")
    return p.select("bucket_key", "index_name", "bucket_name", "target_index",
                    F.coalesce(F.col("n_events") - F.col("n_empty"), F.lit(0)).alias("indexed"),
                    F.coalesce(F.col("n_empty"), F.lit(0)).alias("errors"),
                    F.lit("completed").alias("status"))


def run_results(skipped: DataFrame, processed: DataFrame) -> DataFrame:
    """Skipped and processed bucket results of one run."""
    return skipped.unionByName(processed)


def run_totals(results: DataFrame) -> DataFrame:
    """Indexed counts only completed buckets; errors count all; skipped / failed by status."""
    return results.agg(
        F.coalesce(F.sum(F.when(F.col("status") == "completed", F.col("indexed"))), F.lit(0)).alias("total_indexed"),
        F.coalesce(F.sum("errors"), F.lit(0)).alias("total_errors"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count(F.lit(1)).alias("buckets"))


def doc_id(bucket_key_col: Column, stream_id: Column, stream_offset: Column, stream_sub_offset: Column,
           event_ordinal: Column) -> Column:
    """Stable document id; the ordinal separates events whose stream coordinates collide."""
    return F.sha2(F.concat_ws("|", bucket_key_col, stream_id.cast("string"), stream_offset.cast("string"),
                              stream_sub_offset.cast("string"), event_ordinal.cast("string")), 256)


def parsers_missing(required: DataFrame, registered: DataFrame, key: str = "parser_pipeline") -> DataFrame:
    """Required parsers that are not registered yet (only these are deployed)."""
    return required.join(registered, key, "left_anti")


def parsers_reused(required: DataFrame, registered: DataFrame, key: str = "parser_pipeline") -> DataFrame:
    """Required parsers that already exist and are reused."""
    return required.join(registered, key, "left_semi")


def dedupe_docs(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Idempotent re-delivery: one row per document id."""
    return docs.dropDuplicates([key])


def new_docs(docs: DataFrame, stored: DataFrame, key: str = "doc_id", buckets: DataFrame | None = None,
             indices: list[str] | None = None) -> DataFrame:
    """U3 on re-run: delivered documents that the target does not hold yet, each once.

    An id names its bucket, so only stored rows of the delivered buckets can match.  ``buckets``
    (``bucket_refs`` of the listing: one small row per bucket, not a scan of ``docs``) narrows the
    target before its ids are shuffled, and ``indices`` names the index partitions to read; without
    them the whole target takes part.  Rows whose ``key`` is null are new, and all such rows stay.
    """
    if indices is not None:
        stored = stored.where(F.col("splunk_index").isin(list(indices)))
    if buckets is not None:
        stored = stored.join(buckets.distinct(), ["splunk_index", "splunk_bucket_name"], "left_semi")
    named = dedupe_docs(docs.where(F.col(key).isNotNull()), key)
    return named.join(stored.select(key), key, "left_anti").select(*docs.columns).unionByName(docs.where(F.col(key).isNull()))


def bucket_refs(listing: DataFrame) -> DataFrame:
    """The buckets of a listing under the names that documents give them."""
    return listing.select(F.col("index_name").alias("splunk_index"), F.col("bucket_name").alias("splunk_bucket_name"))


def error_summary(ev: DataFrame) -> DataFrame:
    """Metadata errors by index and ``context: error type``, with the events that hold any."""
    one = ev.where(F.col("extraction_errors").isNotNull()).select(
        "index_name", "journal_path", "event_ordinal", F.explode("extraction_errors").alias("e"))
    kind = F.when(F.endswith("e", F.lit("id out of range")), "decode_field: IndexError").otherwise(F.concat(F.lit("decode_metadata: "), F.col("e")))
    per_event = one.groupBy("index_name", "journal_path", "event_ordinal", kind.alias("error_key")).agg(F.count(F.lit(1)).alias("n"))
    return per_event.groupBy("index_name", "error_key").agg(F.sum("n").alias("n_errors"), F.count(F.lit(1)).alias("n_events"))
