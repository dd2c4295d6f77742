"""Incremental ingest: an available-now run processes only journals that are new since the last run."""

import os
import shutil

from pyspark.sql import functions as F

from thawline.plans.registry import ingest_docs, journal_root
from thawline.sinks.documents import new_run_path
from thawline.sources.journal import discover
from thawline.streaming.incremental import run_incremental

SF = "/root/testdata/sf0.001"


def test_incremental_picks_up_only_new_buckets(spark):
    src = journal_root(spark, SF)
    base = new_run_path(spark, "thawline-stream-test")
    tree, out, ckpt = (os.path.join(base, x) for x in ("tree", "out", "ckpt"))
    journals = [j for j in discover(src) if j[6] > 64]
    first, later = journals[:-1], journals[-1]
    for idx, bucket, *_rest, path, _size in [(j[0], j[1], j[5], j[6]) for j in first]:
        os.makedirs(os.path.join(tree, idx, bucket, "rawdata"))
        shutil.copy(path, os.path.join(tree, idx, bucket, "rawdata", "journal.zst"))
    run_incremental(spark, tree, ingest_docs, out, ckpt)
    n1 = spark.read.parquet(out).count()
    run_incremental(spark, tree, ingest_docs, out, ckpt)  # nothing new
    assert spark.read.parquet(out).count() == n1
    idx, bucket, path = later[0], later[1], later[5]
    os.makedirs(os.path.join(tree, idx, bucket, "rawdata"))
    shutil.copy(path, os.path.join(tree, idx, bucket, "rawdata", "journal.zst"))
    run_incremental(spark, tree, ingest_docs, out, ckpt)
    back = spark.read.parquet(out)
    n_new = back.where(F.col("bucket_key") == f"{idx}/{bucket}").count()
    assert n_new > 0 and back.count() == n1 + n_new
    assert back.select("doc_id").distinct().count() == back.count()


def test_one_bad_journal_does_not_stop_the_stream(spark):
    import pytest

    from thawline.operators import runs as R
    from thawline.plans.ingest import documents
    from thawline.sources.journal_writer import corrupt_copy
    from thawline.streaming.incremental import ingest_batch, quarantined, redeliver

    src = journal_root(spark, SF)
    base = new_run_path(spark, "thawline-stream-test")
    tree, out, ckpt, log = (os.path.join(base, x) for x in ("tree", "out", "ckpt", "log"))
    whole = {f"{j[0]}/{j[1]}": j for j in discover(src) if j[6] > 64}
    broken = {f"{j[0]}/{j[1]}": j for j in discover(corrupt_copy(spark, src)) if j[6] > 64 and j[4] % 7 == 0}
    bad = sorted(set(whole) & set(broken))[:2]
    names = bad + [k for k in sorted(whole) if k not in broken][:6]

    def put(key, path):
        folder = os.path.join(tree, key, "rawdata")
        os.makedirs(folder, exist_ok=True)
        shutil.copy(path, os.path.join(folder, "journal.zst"))

    for k in names[:-1]:
        put(k, (broken if k in bad else whole)[k][5])
    with pytest.raises(Exception):
        run_incremental(spark, tree, documents, os.path.join(base, "strict"), os.path.join(base, "strict-ckpt"))
    run_incremental(spark, tree, documents, out, ckpt, mode="PERMISSIVE", checkpoint_log_path=log)
    put(names[-1], whole[names[-1]][5])
    run_incremental(spark, tree, documents, out, ckpt, mode="PERMISSIVE", checkpoint_log_path=log)  # the stream goes on
    rows = spark.read.parquet(out)
    assert {r.bucket_key for r in rows.select("bucket_key").distinct().collect()} == set(names) - set(bad)
    held = quarantined(spark, out).collect()
    assert sorted(r.bucket_key for r in held) == bad and all(r.reason and r.batch_id == 0 for r in held)
    # the first batch is delivered again: nothing changes
    first = spark.createDataFrame([(os.path.join(tree, k, "rawdata", "journal.zst"), os.path.getsize(os.path.join(tree, k, "rawdata", "journal.zst"))) for k in names[:-1]], "path string, length bigint")
    n = rows.count()
    ingest_batch(spark, documents, out, "PERMISSIVE", log)(first, 0)
    assert spark.read.parquet(out).count() == n and quarantined(spark, out).count() == 2
    # one is repaired in place, then the other
    put(bad[0], whole[bad[0]][5])
    assert redeliver(spark, documents, out, checkpoint_log_path=log) == 1
    assert [r.bucket_key for r in quarantined(spark, out).collect()] == bad[1:]
    put(bad[1], whole[bad[1]][5])
    assert redeliver(spark, documents, out, checkpoint_log_path=log) == 0 and redeliver(spark, documents, out) == 0
    got = spark.read.parquet(out)
    want = {r.doc_id for r in ingest_docs_of(spark, [whole[k][5] for k in names])}
    assert got.count() == len(want) and {r.doc_id for r in got.select("doc_id").collect()} == want
    assert {(r.bucket_key, r.status) for r in R.checkpoint_latest(spark.read.parquet(log)).collect()} == {(k, "completed") for k in names}


def ingest_docs_of(spark, paths):
    import json

    from thawline.plans.ingest import documents
    from thawline.sources import journal as JS

    return documents(JS.read(spark, None, paths=json.dumps(paths))).select("doc_id").collect()
