"""Event profiles: counts by kind / sourcetype, per-index scan, dry run, required parsers, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thawline.functions.text import strip_prefix
from thawline.operators.classify import router_name


def profile_by_kind(classified: DataFrame, by=("kind",)) -> DataFrame:
    """A1/A2: events per kind (merge across buckets is the aggregate's own partial/final split)."""
    return classified.groupBy(*by).agg(F.count(F.lit(1)).alias("n_events"))


def profile_by_sourcetype(classified: DataFrame, by=()) -> DataFrame:
    """A1: events per non-empty stripped sourcetype."""
    st = strip_prefix(F.col("sourcetype"))
    return (classified.select(*by, st.alias("sourcetype")).where(F.col("sourcetype") != "")
            .groupBy(*by, "sourcetype").agg(F.count(F.lit(1)).alias("n_events")))


def kinds_csv(kinds_col) -> F.Column:
    return F.array_join(kinds_col, ",")


def scan_by_index(classified: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """Per index: events, sorted distinct kinds (``generic`` when none), router name."""
    agg = classified.groupBy("index_name").agg(F.count(F.lit(1)).alias("n_events"),
                                                F.sort_array(F.collect_set("kind")).alias("kinds"))
    if listing is not None:
        idx = listing.select("index_name").distinct()
        agg = idx.join(agg, "index_name", "left").withColumn("n_events", F.coalesce("n_events", F.lit(0)))
    kinds = F.when(F.size(F.coalesce("kinds", F.array())) > 0, F.col("kinds")).otherwise(F.array(F.lit("generic")))
    return agg.select("index_name", "n_events", kinds_csv(kinds).alias("required_parsers"),
                      router_name(F.col("index_name")).alias("router_pipeline"))


def dry_run_counts(listing: DataFrame, counts: DataFrame) -> DataFrame:
    """A5: events per bucket (empty buckets kept) with per-index subtotals and the grand total."""
    b = listing.join(counts.select("bucket_key", "n_events"), "bucket_key", "left").withColumn(
        "n_events", F.coalesce("n_events", F.lit(0)))
    return b.rollup("index_name", "bucket_name").agg(F.sum("n_events").alias("n_events"),
                                                     F.count(F.lit(1)).alias("n_buckets"))


def top_sourcetypes(by_st: DataFrame, k: int, by=("index_name",)) -> DataFrame:
    """O2: top-k sourcetypes per index by count (ties by name); input is already aggregated."""
    w = Window.partitionBy(*by).orderBy(F.desc("n_events"), F.asc("sourcetype"))
    return by_st.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)
