"""Bulk NDJSON lines and files; versioned document runs."""

import json
import os

from pyspark.sql import functions as F

from thawline.plans.registry import ingest_docs, journal_events
from thawline.sinks.documents import bulk_lines, new_run_path, write_bulk_files, write_docs

SF = "/root/testdata/sf0.001"


def test_bulk_lines_id_only_in_action(spark):
    lines = bulk_lines(ingest_docs(journal_events(spark, SF))).limit(50).collect()
    for r in lines:
        action, body = json.loads(r.action), json.loads(r.body)
        assert action == {"index": {"_id": r.doc_id}}
        assert "doc_id" not in body and r.doc_id not in r.body
        assert set(body["event"]) <= {"kind", "dataset"} and "@timestamp" in body


def test_bulk_files_round_trip(spark):
    docs = ingest_docs(journal_events(spark, SF))
    path = new_run_path(spark, "thawline-test-bulk")
    write_bulk_files(bulk_lines(docs), path)
    assert any(f.endswith(".gz") for f in os.listdir(path))
    back = spark.read.text(path)
    assert back.count() == 2 * docs.count()
    assert back.where(F.col("value").startswith('{"index":{"_id":"')).count() == docs.count()


def test_runs_never_touch_each_other(spark):
    docs = ingest_docs(journal_events(spark, SF))
    path = new_run_path(spark, "thawline-test-runs")
    write_docs(docs, path, "1.0-a")
    first = sorted(os.listdir(os.path.join(path, "ingest_run=1.0-a")))
    write_docs(docs, path, "1.1-b")
    write_docs(docs, path, "1.1-b")  # a retried run replaces the partitions it writes: no duplicates
    counts = {r.ingest_run: r["count"] for r in spark.read.parquet(path).groupBy("ingest_run").count().collect()}
    n = docs.count()
    assert counts == {"1.0-a": n, "1.1-b": n}
    assert sorted(os.listdir(os.path.join(path, "ingest_run=1.0-a"))) == first


def test_list_buckets_pruning_and_forced_reingest(spark):
    from thawline.plans.ingest import ingest
    from thawline.plans.registry import journal_root
    from thawline.sources.buckets import list_buckets
    from thawline.sources.journal import discover

    root = journal_root(spark, SF)
    all_ = discover(root)
    some = list_buckets(spark, root, indices=["apache", "syslog"]).collect()
    assert sorted(r.bucket_key for r in some) == sorted(f"{i}/{b}" for i, b, *_ in all_ if i in ("apache", "syslog"))
    one = all_[0]
    assert list_buckets(spark, root, bucket_names=[one[1]], indices=[one[0]]).count() == 1

    base = new_run_path(spark, "thawline-test-force")
    out, log = os.path.join(base, "docs"), os.path.join(base, "log")
    first = ingest(spark, root, out, "r1", checkpoint_log_path=log, indices=["apache"])
    n1 = {r.status: r["count"] for r in first.groupBy("status").count().collect()}
    again = ingest(spark, root, out, "r2", checkpoint_log_path=log, indices=["apache"])
    assert {r.status for r in again.collect()} == {"skipped"}
    forced = ingest(spark, root, out, "r3", checkpoint_log_path=log, indices=["apache"], force=True)
    assert {r.status for r in forced.collect()} == {"completed"} and n1 == {"completed": forced.count()}
