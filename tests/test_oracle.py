"""Registered plans against their DuckDB twins on sf0.001 (the driver runs all of them at sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.harness import compare, duck

SF = "/root/testdata/sf0.001"
KEYS = ["classify", "classify_reason", "to_docs", "route_and_parse", "parse_access", "parse_syslog",
        "parse_vpc_flow", "parse_cloud_trail", "text_decode", "scan_by_index", "dry_run_counts", "run_results",
        "run_totals", "checkpoint_latest", "top_sourcetypes", "event_ordinal", "doc_id", "metrics_histogram",
        "journal_scan", "bucket_listing", "corrupt_journals", "journal_replay", "metadata_fields", "bulk_ndjson", "ingest_summary"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    ok, msg = compare(spark, key, SF, E.queries(), E.oracle_sql(), con)
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "n_events" in df.columns


def test_batch_by_bytes_respects_caps(spark):
    rows = E.queries()["batch_by_bytes"](spark, SF).collect()
    assert rows and all(r.n_docs <= 500 for r in rows)
    last = {}
    for r in rows:
        last[r.bucket_key] = max(last.get(r.bucket_key, 0), r.batch)
    # every batch but a bucket's last was flushed at a cap
    assert all(r.n_docs == 500 or r.n_bytes >= 64 * 1024 for r in rows if r.batch < last[r.bucket_key])
    assert sum(r.n_docs for r in rows) == spark.read.parquet(f"{SF}/events.parquet").count()


def test_corrupt_journals_keep_reason(spark):
    from thawline.plans.registry import journal_root
    from thawline.sources import journal as JS
    from thawline.sources.journal_writer import corrupt_copy

    ev = JS.read(spark, corrupt_copy(spark, journal_root(spark, SF)), mode="PERMISSIVE")
    reasons = [r[0] for r in ev.where("_corrupt_reason IS NOT NULL").select("_corrupt_reason").collect()]
    assert reasons and all("truncated" in r for r in reasons)


def test_ingest_observed_metrics(spark):
    from thawline.plans.ingest import ingest
    from thawline.plans.registry import journal_root
    from thawline.sinks.documents import new_run_path

    m = {}
    res = ingest(spark, journal_root(spark, SF), new_run_path(spark, "thawline-test"), "t1", metrics=m)
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    assert m["documents"] == n and m["error_documents"] == 0
    assert sum(m[k] for k in ("access_log", "syslog", "cloud_trail", "vpc_flow", "generic")) == n
    assert res.agg({"indexed": "sum"}).collect()[0][0] == n
