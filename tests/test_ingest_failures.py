"""Listing of empty roots, look-alike directories in a stream, u64 ids, cache keys, clearing checkpoints."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from thawline import storage
from thawline.plans.ingest import clear_checkpoints, documents, ingest
from thawline.plans.registry import ingest_docs, journal_root
from thawline.sinks.documents import new_run_path
from thawline.sources import journal as JS
from thawline.sources.buckets import list_buckets
from thawline.sources.journal_writer import corrupt_copy
from thawline.streaming.incremental import run_incremental

SF = "/root/testdata/sf0.001"


def test_empty_and_missing_root(spark):
    root = new_run_path(spark, "thawline-empty")
    with pytest.raises(FileNotFoundError):
        list_buckets(spark, root)
    os.makedirs(root)
    assert list_buckets(spark, root).count() == 0 and JS.discover(root) == []
    assert ingest(spark, root, new_run_path(spark), "r").count() == 0


def test_stream_ignores_look_alikes(spark):
    src = journal_root(spark, SF)
    base = new_run_path(spark, "thawline-stream-test")
    tree = os.path.join(base, "tree")
    j = next(j for j in JS.discover(src) if j[6] > 64)
    for bucket in (j[1], "db_hot_v1"):
        os.makedirs(os.path.join(tree, j[0], bucket, "rawdata"))
        shutil.copy(j[5], os.path.join(tree, j[0], bucket, "rawdata", "journal.zst"))
    run_incremental(spark, tree, ingest_docs, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    keys = {r.bucket_key for r in spark.read.parquet(os.path.join(base, "out")).select("bucket_key").distinct().collect()}
    assert keys == {f"{j[0]}/{j[1]}"}


def test_u64_stream_ids(spark):
    ev = JS.read(spark, journal_root(spark, SF)).where(F.col("index_name") == "apache").limit(5)
    big = ev.withColumn("stream_id", F.expr("cast('18446744073709551615' as decimal(20,0))"))
    small = ev.withColumn("stream_id", F.expr("cast('9223372036854775808' as decimal(20,0))"))
    ids = [r.doc_id for r in documents(big).union(documents(small)).select("doc_id").collect()]
    assert len(set(ids)) == 10


def test_clear_checkpoints_and_order_within_a_second(spark):
    root = journal_root(spark, SF)
    base = new_run_path(spark, "thawline-clear")
    out, log = f"{base}/docs", f"{base}/log"
    first = ingest(spark, root, out, "a", checkpoint_log_path=log, indices=["apache"])
    n = first.count()
    clear_checkpoints(spark, log)
    again = ingest(spark, root, out, "b", checkpoint_log_path=log, indices=["apache"])
    assert {r.status for r in again.collect()} == {"completed"} and again.count() == n
    third = ingest(spark, root, out, "c", checkpoint_log_path=log, indices=["apache"])
    assert {r.status for r in third.collect()} == {"skipped"}


def test_failfast_ends_the_call_and_leaves_no_documents(spark):
    root = new_run_path(spark, "thawline-bad")
    j = next(j for j in JS.discover(corrupt_copy(spark, journal_root(spark, SF))) if j[4] % 7 == 0 and j[6] > 64)
    p = os.path.join(root, j[0], j[1], "rawdata")
    os.makedirs(p)
    shutil.copy(j[5], os.path.join(p, "journal.zst"))
    out = new_run_path(spark)
    with pytest.raises(Exception, match="Journal decode error"):
        ingest(spark, root, out, "r")
    assert storage.children(spark, f"{out}/ingest_run=r") == []
    res = ingest(spark, root, out, "r", mode="PERMISSIVE").collect()
    assert [r.status for r in res] == ["failed"] and storage.children(spark, f"{out}/ingest_run=r") == []


def test_changed_input_gets_another_key(spark, tmp_path):
    a = tmp_path / "events.parquet"
    spark.range(5).write.parquet(str(a))
    one = storage.fingerprint(spark, str(a))
    assert one == storage.fingerprint(spark, str(a)) and one != storage.fingerprint(spark, str(a), b"x")
    spark.range(6).write.mode("append").parquet(str(a))
    assert one != storage.fingerprint(spark, str(a))
