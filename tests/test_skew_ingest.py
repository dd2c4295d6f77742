"""A tree where one bucket holds most events: the ingest spreads the post-decode work and stays whole."""

import tempfile

from pyspark.sql import functions as F

from thawline.plans import base as B
from thawline.plans.ingest import ingest
from thawline.sinks.documents import new_run_path
from thawline.sources.journal_writer import write_journals

SF = "/root/testdata/sf0.01"


def test_hot_bucket_ingest(spark):
    raw = B.corpus(spark, SF)
    hot = raw.where(F.col("index_name") == "apache").agg(
        F.min("bucket_name").alias("hb"), F.min("bucket_latest").alias("hl"), F.min("bucket_earliest").alias("he"),
        F.min("bucket_seq").alias("hs")).first()
    is_hot = F.col("index_name").isin("apache", "nginx", "syslog")  # 3 of 8 shapes -> one bucket
    skewed = raw.withColumns({
        "index_name": F.when(is_hot, F.lit("apache")).otherwise(F.col("index_name")),
        "bucket_name": F.when(is_hot, F.lit(hot.hb)).otherwise(F.col("bucket_name")),
        "bucket_latest": F.when(is_hot, F.lit(hot.hl)).otherwise(F.col("bucket_latest")),
        "bucket_earliest": F.when(is_hot, F.lit(hot.he)).otherwise(F.col("bucket_earliest")),
        "bucket_seq": F.when(is_hot, F.lit(hot.hs)).otherwise(F.col("bucket_seq"))})
    root = tempfile.mkdtemp(prefix="thawline-skew-")
    w, e = write_journals(skewed, root)
    w.count()
    e.count()
    m = {}
    res = ingest(spark, root, new_run_path(spark, "thawline-test"), "skew", metrics=m, output_partition_bytes=64 * 1024)
    n = raw.count()
    assert m["documents"] == n
    top = res.orderBy(F.desc("indexed")).first()
    assert top.bucket_key == f"apache/{hot.hb}" and top.indexed > n / 3
