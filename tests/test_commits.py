"""Commits: calls broken off after each step, refused renames, files kept when a bucket fails, rejected documents."""

import os

import pytest
from pyspark.sql import functions as F

from thawline import storage
from thawline.operators import runs as R
from thawline.plans import commits
from thawline.plans import ingest as I
from thawline.plans.registry import journal_root
from thawline.sinks.documents import new_run_path
from thawline.sources import journal as JS
from thawline.sources.journal_writer import corrupt_copy

SF = "/root/testdata/sf0.001"
STEPS = ("started", "written", "counted", "committed", "placed", "logged", "measured", "closed")


class Killed(Exception):
    pass


def _kill_at(monkeypatch, step):
    def reached(name):
        if name == step:
            raise Killed(name)

    monkeypatch.setattr(I, "_step", reached)


@pytest.fixture(scope="module")
def expected(spark):
    ev = JS.read(spark, journal_root(spark, SF)).where(F.col("index_name").isin("apache", "syslog"))
    return sorted(r.doc_id for r in I.documents(ev).select("doc_id").collect())


@pytest.mark.parametrize("step", STEPS)
def test_killed_after(spark, monkeypatch, expected, step):
    root, base = journal_root(spark, SF), new_run_path(spark, "thawline-killed")
    args = dict(checkpoint_log_path=f"{base}/log", metrics_path=f"{base}/metrics")
    I.ingest(spark, root, f"{base}/docs", "1", indices=["apache"], **args)
    _kill_at(monkeypatch, step)
    with pytest.raises(Killed):
        I.ingest(spark, root, f"{base}/docs", "1", indices=["apache", "syslog"], **args)
    monkeypatch.undo()
    # readers see the attempt whole from its commit on, and not before
    ids = sorted(r.doc_id for r in commits.read_documents(spark, f"{base}/docs").select("doc_id").collect())
    assert (ids == expected) if STEPS.index(step) >= STEPS.index("committed") else (0 < len(ids) < len(expected))
    last = I.ingest(spark, root, f"{base}/docs", "1", indices=["apache", "syslog"], **args)
    for rows in (commits.read_documents(spark, f"{base}/docs"), spark.read.parquet(f"{base}/docs")):
        assert sorted(r.doc_id for r in rows.select("doc_id").collect()) == expected
    assert {r.status for r in last.collect()} == ({"skipped"} if STEPS.index(step) >= STEPS.index("committed") else {"skipped", "completed"})
    log = R.checkpoint_latest(spark.read.parquet(f"{base}/log")).collect()
    assert {r.status for r in log} == {"completed"} and sum(r.indexed for r in log) == len(expected)
    m = spark.read.parquet(f"{base}/metrics").where("status = 'completed'")
    assert m.agg(F.sum("docs_success")).first()[0] == len(expected) and m.count() == m.select("attempt", "bucket_key").distinct().count()
    assert not [n for n in storage.children(spark, f"{base}/docs") if n.startswith("_staging")]


@pytest.mark.parametrize("step", ["committed", "placed"])
def test_killed_while_replacing(spark, monkeypatch, step):
    """force: the old attempt counts before the commit, the new one after it, never both."""
    root, base = journal_root(spark, SF), new_run_path(spark, "thawline-killed")
    I.ingest(spark, root, f"{base}/docs", "1", indices=["apache"])
    old = {r.attempt for r in commits.read_documents(spark, f"{base}/docs").select("attempt").distinct().collect()}
    n = commits.read_documents(spark, f"{base}/docs").count()
    real = storage.delete
    if step == "placed":  # the documents are in place, the replaced attempt is not gone yet
        monkeypatch.setattr(storage, "delete", lambda spark, path: (_ for _ in ()).throw(Killed(path)) if "attempt=" in path else real(spark, path))
    else:
        _kill_at(monkeypatch, step)
    with pytest.raises(Killed):
        I.ingest(spark, root, f"{base}/docs", "1", indices=["apache"], force=True)
    monkeypatch.undo()
    rows = commits.read_documents(spark, f"{base}/docs")
    assert rows.count() == n and not old & {r.attempt for r in rows.select("attempt").distinct().collect()}
    assert len(I.recover(spark, f"{base}/docs")) == 1 and I.recover(spark, f"{base}/docs") == []
    assert spark.read.parquet(f"{base}/docs").count() == n


def test_refused_rename_is_no_success(spark, monkeypatch):
    root, base = journal_root(spark, SF), new_run_path(spark, "thawline-refused")
    monkeypatch.setattr(storage, "rename", lambda *a: False)
    with pytest.raises(OSError, match="could not move"):
        I.ingest(spark, root, f"{base}/docs", "1", checkpoint_log_path=f"{base}/log", indices=["apache"])
    monkeypatch.undo()
    assert {r.status for r in R.checkpoint_latest(spark.read.parquet(f"{base}/log")).collect()} == {"in_progress"}
    res = I.ingest(spark, root, f"{base}/docs", "1", checkpoint_log_path=f"{base}/log", indices=["apache"])
    assert spark.read.parquet(f"{base}/docs").count() == sum(r.indexed for r in res.collect()) > 0


def test_files_without_a_failed_bucket_stay(spark):
    folder = f"{new_run_path(spark, 'thawline-files')}/all"
    rows = spark.range(4000).selectExpr("concat('b', id div 400) as bucket_key", "id", "concat('i', id div 2000) as splunk_index", "id % 5 = 0 as rejected")
    rows.repartitionByRange(8, "id").sortWithinPartitions("id").write.option("maxRecordsPerFile", 100).partitionBy("rejected", "splunk_index").parquet(folder)
    before = {os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}
    failed = spark.createDataFrame([("b3",), ("b7",), ("nosuch",)], "bucket_key string")
    n = commits.drop_buckets(spark, folder, failed, ["rejected", "splunk_index"], 1000)
    after = {os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}
    got = spark.read.parquet(folder)
    assert sorted(r.id for r in got.collect()) == [i for i in range(4000) if i // 400 not in (3, 7)]
    assert got.where("rejected <> (id % 5 = 0) or splunk_index <> concat('i', id div 2000)").count() == 0
    assert len(before - after) == n and 0 < n < len(before) / 2


def test_rejected_documents(spark):
    root, base = journal_root(spark, SF), new_run_path(spark, "thawline-rejects")
    seen: dict = {}
    res = I.ingest(spark, root, f"{base}/docs", "1", metrics=seen, metrics_path=f"{base}/metrics", max_document_bytes=60).collect()
    sizes = I.documents(JS.read(spark, root)).select("doc_id", F.octet_length("message").alias("n")).collect()
    good, bad = {r.doc_id for r in sizes if r.n <= 60}, {r.doc_id for r in sizes if r.n > 60}
    assert {r.doc_id for r in commits.read_documents(spark, f"{base}/docs").collect()} == good
    rejects = commits.read_rejects(spark, f"{base}/docs").collect()
    assert {r.doc_id for r in rejects} == bad and all(r.error_message == f"message of {len(r.message.encode())} bytes" for r in rejects)
    assert sum(r.indexed for r in res) == len(good) and sum(r.errors for r in res) == len(bad) == seen["rejected"] and {r.status for r in res} == {"completed"}
    assert spark.read.parquet(f"{base}/metrics").agg(F.sum("docs_error")).first()[0] == len(bad)


def test_failed_buckets_leave_rejects_too(spark):
    root, base = corrupt_copy(spark, journal_root(spark, SF)), new_run_path(spark, "thawline-rejects")
    res = {r.bucket_key: r for r in I.ingest(spark, root, f"{base}/docs", "1", mode="PERMISSIVE", max_document_bytes=60).collect()}
    both = commits.read_documents(spark, f"{base}/docs").select("bucket_key", F.lit("indexed").alias("to")).union(
        commits.read_rejects(spark, f"{base}/docs").select("bucket_key", F.lit("errors")))
    n = {(r.bucket_key, r.to): r["count"] for r in both.groupBy("bucket_key", "to").count().collect()}
    assert {r.status for r in res.values()} == {"completed", "failed"}
    for k, r in res.items():
        assert (r.indexed, r.errors) == (n.get((k, "indexed"), 0), n.get((k, "errors"), 0)) and (r.status == "completed" or r.indexed + r.errors == 0)


def test_pointer_is_replaced_in_one_step(spark):
    """A reader that looks all the time finds a whole pointer file always."""
    import threading

    path = f"{new_run_path(spark, 'thawline-pointer')}/current"
    storage.write_text(spark, path, "0" * 1000)
    seen, end = [], threading.Event()

    def look():
        while not end.is_set():
            try:
                seen.append(open(path).read())
            except FileNotFoundError:
                seen.append(None)

    t = threading.Thread(target=look)
    t.start()
    for i in range(60):
        storage.write_text(spark, path, str(i % 10) * 1000)
    end.set()
    t.join()
    assert len(seen) > 60 and all(s is not None and len(s) == 1000 and len(set(s)) == 1 for s in seen)
    assert storage.children(spark, os.path.dirname(path)) == ["current"]
