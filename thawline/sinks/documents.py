"""Document sinks: versioned Parquet document tables, NDJSON bulk lines, byte/doc-capped batches."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thawline.session import checkpoint_dir
from thawline.sinks.batches import batches_anywhere

# Fixed document schema enforced before every write (mapping of the document table).
DOC_COLUMNS = (
    ("doc_id", "string"), ("ts_iso", "string"), ("message", "string"), ("host", "string"), ("source", "string"),
    ("sourcetype", "string"), ("event_kind", "string"), ("event_dataset", "string"), ("splunk_index", "string"),
    ("splunk_index_time", "bigint"), ("splunk_bucket_name", "string"), ("splunk_bucket_latest", "bigint"),
    ("splunk_bucket_earliest", "bigint"), ("splunk_pipeline", "string"), ("splunk_classify_reason", "string"),
)
# what a document table takes at most: bytes of a message, bytes of a field that is looked up by its value
MAX_DOCUMENT_BYTES = 100 * 1024 * 1024
MAX_KEY_BYTES = 32_766
KEY_FIELDS = ("host", "source", "sourcetype", "splunk_bucket_name")
DEFAULT_BATCH_DOCS = 500
DEFAULT_BATCH_BYTES = 15 * 1024 * 1024


def enforce_schema(docs: DataFrame, extra=()) -> DataFrame:
    return docs.select(*[F.col(c).cast(t).alias(c) for c, t in DOC_COLUMNS], *extra)


def reject_reason(max_document_bytes: int = MAX_DOCUMENT_BYTES):
    """Why a table does not take a document; null for those it takes."""
    reason = F.when(F.col("ts_iso").isNull(), "no event time").when(
        F.octet_length("message") > max_document_bytes, F.concat(F.lit("message of "), F.octet_length("message").cast("string"), F.lit(" bytes")))
    for c in KEY_FIELDS:
        reason = reason.when(F.octet_length(c) > MAX_KEY_BYTES, F.concat(F.lit(f"{c} of "), F.octet_length(c).cast("string"), F.lit(" bytes")))
    return reason


def runs_root(spark: SparkSession, name: str = "thawline-runs") -> str:
    return os.path.join(checkpoint_dir(spark), name)


def new_run_path(spark: SparkSession, name: str = "thawline-runs") -> str:
    return os.path.join(runs_root(spark, name), uuid.uuid4().hex)


def write_docs(docs: DataFrame, path: str, ingest_run: str, max_records_per_file: int = 1_000_000) -> None:
    """K1/K5: append one run's documents as ``ingest_run=<run>/splunk_index=<index>`` partitions.

    Dynamic partition overwrite makes a retried run replace only its own
    partitions; other runs are never touched.
    """
    out = enforce_schema(docs).withColumn("ingest_run", F.lit(ingest_run))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("ingest_run", "splunk_index").parquet(path))


def bulk_lines(docs: DataFrame, keys=()) -> DataFrame:
    """K2: action line (document id only) and body line (the document without its id); ``keys`` go along."""
    body = F.to_json(F.struct(
        F.col("ts_iso").alias("@timestamp"), "message", "host", "source", "sourcetype",
        F.struct(F.col("event_kind").alias("kind"), F.col("event_dataset").alias("dataset")).alias("event"),
        F.col("splunk_index").alias("splunk.index"), F.col("splunk_index_time").alias("splunk.index_time"),
        F.col("splunk_bucket_name").alias("splunk.bucket_name"),
        F.col("splunk_pipeline").alias("splunk.pipeline"),
        F.col("splunk_classify_reason").alias("splunk.classify_reason")))
    action = F.concat(F.lit('{"index":{"_id":"'), F.col("doc_id"), F.lit('"}}'))
    return docs.select("doc_id", *keys, action.alias("action"), body.alias("body"))


def write_bulk_files(lines: DataFrame, path: str) -> None:
    """NDJSON request bodies as gzip text files (action and body lines interleaved)."""
    lines.select(F.concat_ws("\n", "action", "body").alias("value")).write.mode("overwrite").option(
        "compression", "gzip").text(path)


def batch_by_bytes(lines: DataFrame, max_docs: int = DEFAULT_BATCH_DOCS, max_bytes: int = DEFAULT_BATCH_BYTES,
                   in_scan_order: bool = True) -> DataFrame:
    """K3: per bucket, consecutive batches, each flushed once it holds ``max_docs`` documents or ``max_bytes`` NDJSON bytes.

    (bucket_key, batch, n_docs, n_bytes); ``lines`` has bucket_key, event_ordinal, action, body.  A
    journal scan delivers a bucket's events in order within one task, so batches are cut there
    while streaming, without a shuffle, and do not depend on the partitioning.  Other inputs
    (``in_scan_order=False``) are cut by ``batches_anywhere``: sorted into slices, a hot bucket in many.
    """
    sized = lines.select("bucket_key", "event_ordinal", (F.octet_length("action") + F.octet_length("body") + 2).cast("bigint").alias("nbytes"))
    if not in_scan_order:
        return batches_anywhere(sized, max_docs, max_bytes)

    def cut(batches):
        import pyarrow as pa

        names = ["bucket_key", "batch", "n_docs", "n_bytes"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
        key, batch, docs, size = None, 0, 0, 0
        for b in batches:
            out = []
            for k, nb in zip(b.column("bucket_key").to_pylist(), b.column("nbytes").to_pylist()):
                if k != key:
                    if docs:
                        out.append((key, batch, docs, size))
                    key, batch, docs, size = k, 0, 0, 0
                docs, size = docs + 1, size + nb
                if docs >= max_docs or size >= max_bytes:
                    out.append((key, batch, docs, size))
                    batch, docs, size = batch + 1, 0, 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((key, batch, docs, size), types)], names=names)

    return sized.mapInArrow(cut, "bucket_key STRING, batch BIGINT, n_docs BIGINT, n_bytes BIGINT")
