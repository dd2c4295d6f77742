"""Run-level tables derived by Spark from the corpus: listing, counts, checkpoint log, run results, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thawline.operators import runs as R
from thawline.plans import base as B


def stats(spark: SparkSession, sf: str) -> DataFrame:
    """One aggregate per bucket (bounds, events, empty messages, bytes); every run table below is
    derived from it, so a plan holds a single shuffle of the events that Spark reuses."""
    return R.bucket_stats(B.corpus(spark, sf))


def buckets(spark: SparkSession, sf: str) -> DataFrame:
    return stats(spark, sf).select("index_name", "bucket_name", "bucket_latest", "bucket_earliest", "bucket_seq",
                                   "bucket_key", "target_index")


def listing(spark: SparkSession, sf: str) -> DataFrame:
    return R.listing_with_empty(buckets(spark, sf))


def counts(spark: SparkSession, sf: str) -> DataFrame:
    return stats(spark, sf).select("index_name", "bucket_name", "n_events", "n_empty", "n_bytes", "bucket_key")


def ckpt_log(spark: SparkSession, sf: str) -> DataFrame:
    return R.checkpoint_log(buckets(spark, sf), counts(spark, sf))


def latest(spark: SparkSession, sf: str) -> DataFrame:
    return R.checkpoint_latest(ckpt_log(spark, sf))


def results(spark: SparkSession, sf: str) -> DataFrame:
    lst, lt, cnt = listing(spark, sf), latest(spark, sf), counts(spark, sf)
    return R.run_results(R.resume_skipped(lst, lt), R.processed_results(R.resume_pending(lst, lt), cnt))

