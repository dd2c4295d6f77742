"""What an ingest costs per event: row copies while parsing, interpreted code, rows held by a task."""

from thawline.operators.classify import classify
from thawline.operators.parse import PARSED_COLUMNS, route_and_parse
from thawline.plans import ingest as I
from thawline.session import compiled_methods
from thawline.sinks.documents import new_run_path

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def _lines(spark):
    line = '10.0.0.1 - bob [01/Jan/2024:00:00:01 +0000] "GET /a HTTP/1.1" 200 12 "-" "x"'
    rows = [("apache", "access_combined", "", line, 1704067200000), ("syslog", "syslog", "", "<3>Jan  1 00:00:01 web-1 cron[7]: hello", 1704067200000)]
    return spark.createDataFrame(rows, "index_name string, sourcetype string, source string, message string, event_time_ms bigint")


def test_parsers_share_projections(spark):
    out = route_and_parse(classify(_lines(spark))).select("kind", *PARSED_COLUMNS)
    got = {r.kind: r for r in out.collect()}
    assert got["access_log"].client_ip == "10.0.0.1" and got["syslog"].process_pid == 7
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Project [") <= 9


def test_methods_stay_short_enough_to_be_compiled(spark):
    before = spark.conf.get(LIMIT)
    with compiled_methods(spark):
        assert int(spark.conf.get(LIMIT)) <= 8000
    assert spark.conf.get(LIMIT) == before
    spark.conf.set(LIMIT, "20000")
    try:
        with compiled_methods(spark):
            assert spark.conf.get(LIMIT) == "20000"
        assert spark.conf.get(LIMIT) == "20000"
    finally:
        spark.conf.unset(LIMIT)


def test_an_ingest_is_written_compiled_from_small_partitions(spark, monkeypatch):
    from thawline.plans.registry import journal_root

    root, asked, limits = journal_root(spark, "/root/testdata/sf0.001"), [], []
    read, limit = I.JS.read, I.compiled_methods

    def reading(*a, **k):
        asked.append(k)
        return read(*a, **k)

    def limited(s):
        limits.append(s)
        return limit(s)

    monkeypatch.setattr(I.JS, "read", reading)
    monkeypatch.setattr(I, "compiled_methods", limited)
    done = I.ingest(spark, root, new_run_path(spark), "1.0")
    assert done.where("status <> 'completed'").count() == 0 and len(limits) == 1
    assert [int(k["maxPartitionBytes"]) for k in asked] == [I.PARTITION_BYTES] and I.PARTITION_BYTES < 64 << 20
