"""Plan shape: the ingest stage stays narrow and JVM-side; scans prune; the source prunes journals."""

import contextlib
import io

from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In

from thawline.plans import base as B
from thawline.plans.ingest import documents
from thawline.plans.registry import QUERIES, journal_root
from thawline.sources import journal as JS

SF = "/root/testdata/sf0.001"


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n")[0]


def test_ingest_stage_is_one_narrow_codegen_stage(spark):
    p = formatted(documents(JS.read(spark, journal_root(spark, SF))))
    assert "Exchange" not in p
    assert "EvalPython" not in p and "ArrowEvalPython" not in p
    assert "BatchScan frozen_journal" in p
    assert "* Project" in p  # whole-stage codegen over the projections


def test_bucket_level_plans_prune_columns(spark):
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        QUERIES["bucket_keys"](spark, SF).explain("formatted")
    schemas = [line for line in plan.getvalue().splitlines() if "ReadSchema" in line]
    assert schemas and all("message" not in line and "host" not in line for line in schemas), schemas


def test_no_python_udfs_in_parse_plans(spark):
    for key in ("classify", "route_and_parse", "to_docs", "ingest_summary"):
        p = formatted(QUERIES[key](spark, SF))
        assert "EvalPython" not in p, key


def test_source_prunes_journals_by_pushed_filters(spark):
    root = journal_root(spark, SF)
    reader = JS.FrozenJournalReader({"path": root})
    all_parts = sum(len(p.journals) for p in reader.partitions())
    reader = JS.PushdownJournalReader({"path": root})
    rest = list(reader.pushFilters([EqualTo(("index_name",), "apache"), In(("bucket_name",), ("x", "y"))]))
    assert rest == []
    assert sum(len(p.journals) for p in reader.partitions()) == 0
    reader = JS.PushdownJournalReader({"path": root})
    list(reader.pushFilters([EqualTo(("index_name",), "apache")]))
    some = sum(len(p.journals) for p in reader.partitions())
    assert 0 < some < all_parts


def test_source_partitions_largest_first_and_bounded(spark):
    reader = JS.FrozenJournalReader({"path": journal_root(spark, SF), "minPartitions": "4"})
    parts = reader.partitions()
    assert len(parts) >= 4
    sizes = [p.journals[0][6] for p in parts]
    assert sizes == sorted(sizes, reverse=True)


def test_corpus_is_materialised_once(spark):
    a = B.corpus(spark, SF).inputFiles()
    b = B.corpus(spark, SF).inputFiles()
    assert a == b and all("thawline-corpus" in f for f in a)


def test_uri_paths_match_local_paths(spark, tmp_path):
    import pyarrow.fs as pafs

    from thawline.sources import journal_codec as J

    root = journal_root(spark, SF)
    local = JS.discover(root)
    fs, inner = pafs.FileSystem.from_uri("file://" + root)
    remote = JS._discover_remote("file://" + root, fs, inner)
    assert [r[:5] for r in local] == [r[:5] for r in remote]
    assert [r[6] for r in local] == [r[6] for r in remote]
    # a path list written as text files is read back the same way
    d = tmp_path / "pending"
    d.mkdir()
    (d / "part-0.txt").write_text("\n".join(r[5] for r in local[:5]) + "\n")
    (d / "_SUCCESS").write_text("")
    assert JS._read_paths_dir(str(d)) == [r[5] for r in local[:5]]
    # the same journal decodes identically through both routes
    j = max(local, key=lambda r: r[6])
    a = [e[:7] for e in J.decode_events(JS._chunks(j[5]))]
    uri = "file://" + j[5]
    assert JS._fs(uri) is None  # file: URIs take the local route ...
    b = [e[:7] for e in J.decode_events(JS._chunks(uri))]
    # ... so force the pyarrow route the way an hdfs:// or s3:// path takes it
    orig = JS._fs
    JS._fs = lambda p: pafs.FileSystem.from_uri(p) if p.startswith("file://") else orig(p)
    try:
        c = [e[:7] for e in J.decode_events(JS._chunks(uri))]
    finally:
        JS._fs = orig
    assert a == b == c and a


def test_discover_prunes_while_walking(spark, monkeypatch):
    import os as _os

    root = journal_root(spark, SF)
    listed = []
    real = _os.listdir

    def spy(p):
        listed.append(p)
        return real(p)

    monkeypatch.setattr(JS.os, "listdir", spy)
    got = JS.discover(root, indices=["apache"])
    assert got and all(r[0] == "apache" for r in got)
    assert all(p in (root, _os.path.join(root, "apache")) for p in listed), listed
    monkeypatch.undo()
    import pyarrow.fs as pafs
    fs, inner = pafs.FileSystem.from_uri("file://" + root)
    remote = JS._discover_remote("file://" + root, fs, inner, {"apache"}, {got[0][1]})
    assert [r[:5] for r in remote] == [got[0][:5]]


def test_columns_option_builds_only_what_is_asked(spark):
    root = journal_root(spark, SF)
    all_ = JS.read(spark, root)
    some = JS.read(spark, root, columns="bucket_name,event_ordinal,stream_id")
    assert some.columns == ["bucket_name", "event_ordinal", "stream_id"]
    assert sorted(some.collect()) == sorted(all_.select(*some.columns).collect())
    try:
        JS.read(spark, root, columns="nothing").collect()
    except Exception as e:  # noqa: BLE001
        assert "no such event columns" in str(e)
    else:
        raise AssertionError("unknown column accepted")


def test_ordinals_write_no_messages_between_slices(spark):
    for key in ("event_ordinal", "doc_id", "batch_by_docs"):
        plan = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
        scan = [x for x in plan.split("\n") if "Scan ExistingRDD" in x]
        assert scan and all("bucket_key" in x and "message" not in x for x in scan), key


def test_negated_filters_are_applied_after_the_scan(spark):
    ev = JS.read(spark, journal_root(spark, SF), columns="index_name,bucket_name")
    n = {r.index_name: r["count"] for r in ev.groupBy("index_name").count().collect()}
    kept = {r.index_name: r["count"] for r in ev.where(~F.col("index_name").isin("apache", "syslog")).groupBy("index_name").count().collect()}
    assert kept == {k: v for k, v in n.items() if k not in ("apache", "syslog")} and len(kept) < len(n)


def test_excluding_filters_keep_no_journal(spark):
    ev = JS.read(spark, journal_root(spark, SF), indices="apache").where(F.col("index_name") == "nginx")
    assert ev.count() == 0
    assert JS.discover(journal_root(spark, SF), indices=[]) == []
