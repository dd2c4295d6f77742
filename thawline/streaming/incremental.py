"""Incremental ingest of newly frozen buckets with Structured Streaming.

``readStream.format("binaryFile")`` lists new journals (paths only, the file
source remembers what it has seen in the checkpoint); each micro-batch decodes
exactly those journals with the ``frozen_journal`` source and writes their
documents.  ``trigger(availableNow=True)`` gives the hourly-cron behaviour:
process everything new, then stop.  Output is keyed by ``batch_id`` and
replaced, so a re-delivered micro-batch leaves the same rows (R2).

With ``mode="PERMISSIVE"`` a bad journal does not stop the stream: its bucket goes to a
quarantine table under ``<out>/_quarantine`` with the reason, the batch's other buckets to the
output.  ``redeliver`` takes quarantined buckets up again once their journals are repaired.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thawline import storage

JOURNAL_RE = r"/db_[0-9]+_[0-9]+_[0-9]+/rawdata/journal\.zst$"
BINARY_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
QUARANTINE = "bucket_key string, journal_path string, journal_size_bytes bigint, reason string, batch_id bigint"
_KEY = r"([^/]+/[^/]+)/rawdata/journal\.zst$"


def new_journals(spark: SparkSession, root: str, max_files_per_trigger: int = 1000) -> DataFrame:
    return (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .load(root.rstrip("/") + "/*/db_*/rawdata/journal.zst").select("path", "length")
            .where(F.col("path").rlike(JOURNAL_RE)))  # look-alike directories are no buckets


def _write_batch(spark: SparkSession, journals: DataFrame, to_docs, out_path: str, batch_id: int, mode: str, checkpoint_log_path: str | None, resolves: bool) -> None:
    """Decode ``journals`` (path, length) and put their documents in place as ``batch_id=<id>``, replacing what is there.

    The batch gets its name in one step, when documents and quarantine rows are whole.  With ``resolves`` the buckets
    that decode are named in the same folder: they leave the quarantine in that very step.
    """
    from thawline.plans import commits
    from thawline.plans.ingest import _log
    from thawline.sources import journal as JS

    # the batch's journal names go to the source as files next to the output (ignored by
    # readers: leading underscore), never through the driver's memory
    pdir, staged = os.path.join(out_path, "_pending", f"batch_id={batch_id}"), os.path.join(out_path, f"_staging-batch_id={batch_id}")
    place, dead = os.path.join(out_path, f"batch_id={batch_id}"), os.path.join(out_path, "_quarantine", "rows", f"batch_id={batch_id}")
    journals.select(F.concat_ws("\t", "path", "length")).write.mode("overwrite").text(pdir)
    docs = to_docs(JS.read(spark, None, pathsDir=pdir, mode=mode)).withColumn("batch_id", F.lit(batch_id))
    storage.delete(spark, staged)
    docs.write.parquet(f"{staged}/all")
    keyed = journals.select(F.regexp_extract("path", _KEY, 1).alias("bucket_key"), F.col("path").alias("journal_path"), F.col("length").alias("journal_size_bytes"))
    if mode.upper() == "PERMISSIVE":
        if missing := {"bucket_key", "error_message"} - set(docs.columns):
            raise ValueError(f"documents need {sorted(missing)} to tell bad journals apart")
        bad = spark.read.schema(docs.schema).parquet(f"{staged}/all").where("error_message is not null").groupBy("bucket_key").agg(F.min("error_message").alias("reason"))
        bad.write.parquet(f"{staged}/bad")
        bad = spark.read.parquet(f"{staged}/bad")
        commits.drop_buckets(spark, f"{staged}/all", bad, [], 1_000_000)
        rows = keyed.join(bad, "bucket_key").withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        if not resolves:  # what is quarantined stays so until it decodes
            rows.select(*[c.split()[0] for c in QUARANTINE.split(", ")]).write.mode("overwrite").parquet(dead)
        done = keyed.join(bad, "bucket_key", "left_anti")
        if resolves:
            done.select("bucket_key").write.parquet(f"{staged}/all/_resolved/rows")
    if checkpoint_log_path:
        counts = spark.read.schema(docs.schema).parquet(f"{staged}/all").groupBy("bucket_key").agg(F.count(F.lit(1)).alias("n"))
        failed = bad.withColumn("failed", F.lit(True)) if mode.upper() == "PERMISSIVE" else spark.createDataFrame([], "bucket_key string, failed boolean")
        log = keyed.join(counts, "bucket_key", "left").join(failed.select("bucket_key", "failed"), "bucket_key", "left")
        log = log.select("bucket_key", F.split("bucket_key", "/")[0].alias("index_name"), F.split("bucket_key", "/")[1].alias("bucket_name"),
                         F.when(F.col("failed"), "failed").otherwise("completed").alias("status"),
                         F.coalesce("n", F.lit(0)).alias("indexed"), F.lit(0).cast("bigint").alias("errors"))
        log.write.parquet(f"{staged}/log")
    if storage.exists(spark, place):  # an earlier delivery of this batch
        storage.delete(spark, f"{staged}-old")
        storage.move(spark, place, f"{staged}-old")
    storage.move(spark, f"{staged}/all", place)
    if checkpoint_log_path:  # after the documents; a batch that is delivered again logs again, with a later version
        _log(spark.read.parquet(f"{staged}/log"), checkpoint_log_path, time.time_ns() // 1_000_000)
    storage.delete(spark, staged)
    storage.delete(spark, f"{staged}-old")


def ingest_batch(spark: SparkSession, to_docs, out_path: str, mode: str = "FAILFAST", checkpoint_log_path: str | None = None):
    """foreachBatch body: decode the batch's journals, write its documents under ``batch_id=<id>``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        _write_batch(spark, batch, to_docs, out_path, batch_id, mode, checkpoint_log_path, resolves=False)

    return run


def run_incremental(spark: SparkSession, root: str, to_docs, out_path: str, checkpoint: str,
                    max_files_per_trigger: int = 1000, mode: str = "FAILFAST", checkpoint_log_path: str | None = None) -> None:
    """Ingest every journal that is new since the last run, then stop.

    ``mode="PERMISSIVE"`` quarantines bad journals; ``to_docs`` must then keep ``bucket_key`` and ``error_message``
    (as ``plans.ingest.documents`` does).  ``checkpoint_log_path``: the log that gets each bucket's outcome.
    """
    q = (new_journals(spark, root, max_files_per_trigger).writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(ingest_batch(spark, to_docs, out_path, mode, checkpoint_log_path)).trigger(availableNow=True).start())
    q.awaitTermination()


def quarantined(spark: SparkSession, out_path: str) -> DataFrame:
    """Buckets whose journals did not decode and have not been re-delivered since (``QUARANTINE`` columns)."""
    top = os.path.join(out_path, "_quarantine", "rows")
    names = [n for n in storage.children(spark, top) if n.startswith("batch_id=")]
    if not names:
        return spark.createDataFrame([], QUARANTINE)
    rows = spark.read.schema(QUARANTINE).parquet(*(os.path.join(top, n) for n in names))
    done = [os.path.join(out_path, n, "_resolved", "rows") for n in storage.children(spark, out_path) if n.startswith("batch_id=-")]
    done = [p for p in done if storage.exists(spark, p)]
    return rows.join(spark.read.schema("bucket_key string").parquet(*done), "bucket_key", "left_anti") if done else rows


def redeliver(spark: SparkSession, to_docs, out_path: str, root: str | None = None, checkpoint_log_path: str | None = None) -> int:
    """Decode the quarantined buckets anew, from their old places or from below another ``root``; returns how many are left.

    Buckets that decode now are added as a batch of their own (ids -1, -2 ...) and leave the quarantine in the
    step that makes their documents visible; the others stay.
    """
    held = quarantined(spark, out_path)
    path = F.concat(F.lit(root.rstrip("/") + "/"), "bucket_key", F.lit("/rawdata/journal.zst")) if root else F.col("journal_path")
    names = held.select(path.alias("path"))
    if names.isEmpty():
        return 0
    number = -1 - sum(n.startswith("batch_id=-") for n in storage.children(spark, out_path))
    # lengths as they are now: a repaired journal has another size
    sizes = spark.read.format("binaryFile").load([r.path for r in names.collect()]).select("path", "length")  # a bad journal each
    _write_batch(spark, sizes, to_docs, out_path, number, "PERMISSIVE", checkpoint_log_path, resolves=True)
    return quarantined(spark, out_path).count()
