"""Shared building blocks of the registered plans (Spark side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thawline.functions.text import iso_utc, strip_prefix
from thawline.operators.classify import classify, parser_name
from thawline.operators.parse import route_and_parse
from thawline.session import ensure_utc
from thawline.sources.corpus import raw_events


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return raw_events(spark, sf_dir)


def classified(spark: SparkSession, sf_dir: str, keep_inputs: bool = False) -> DataFrame:
    return classify(corpus(spark, sf_dir), keep_inputs=keep_inputs)


def parsed(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return route_and_parse(classified(spark, sf_dir), **kw)


def docs(raw: DataFrame, keys=("event_id",)) -> DataFrame:
    """P5: flat document columns of classified raw events (prefixes stripped, ISO time)."""
    c = classify(raw)
    return c.select(
        *keys,
        iso_utc(F.col("event_time_ms")).alias("ts_iso"),
        "message",
        strip_prefix(F.col("host")).alias("host"),
        strip_prefix(F.col("source")).alias("source"),
        strip_prefix(F.col("sourcetype")).alias("sourcetype"),
        F.col("kind").alias("event_kind"),
        F.col("dataset").alias("event_dataset"),
        F.col("index_name").alias("splunk_index"),
        F.col("index_time").alias("splunk_index_time"),
        F.col("bucket_name").alias("splunk_bucket_name"),
        F.col("bucket_latest").alias("splunk_bucket_latest"),
        F.col("bucket_earliest").alias("splunk_bucket_earliest"),
        parser_name(F.col("kind")).alias("splunk_pipeline"),
        F.col("reason").alias("splunk_classify_reason"),
    )
