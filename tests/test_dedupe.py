"""Re-delivery against a large target: only the delivered buckets of the delivered indices are read and joined."""

import contextlib
import io

from thawline.operators import runs as R

DOC = "doc_id STRING, splunk_index STRING, splunk_bucket_name STRING, message STRING"


def target(spark, path):
    rows = [(f"{i}-{b}-{n}", f"i{i}", f"db_{b}", "old") for i in range(4) for b in range(3) for n in range(20)]
    spark.createDataFrame(rows, DOC).write.partitionBy("splunk_index").parquet(path)
    return spark.read.parquet(path)


def test_rows_equal_those_of_the_whole_target(spark, tmp_path):
    stored = target(spark, str(tmp_path / "t"))
    rows = [(f"1-{b}-{n}", "i1", f"db_{b}", "new") for b in (0, 2) for n in range(15, 25)]
    docs = spark.createDataFrame(rows + rows + [(None, "i1", "db_0", "a"), (None, "i1", "db_0", "a")], DOC)
    listing = spark.createDataFrame([("i1", "db_0"), ("i1", "db_2"), ("i1", "db_2")], "index_name STRING, bucket_name STRING")
    narrow = R.new_docs(docs, stored, buckets=R.bucket_refs(listing), indices=["i1"])
    assert narrow.columns == docs.columns
    got = sorted(narrow.collect(), key=str)
    assert got == sorted(R.new_docs(docs, stored).collect(), key=str)
    assert sorted(str(r.doc_id) for r in got) == sorted([f"1-{b}-{n}" for b in (0, 2) for n in range(20, 25)] + ["None", "None"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        narrow.explain("formatted")
    plan = buf.getvalue()
    assert "PartitionFilters" in plan and "splunk_index" in plan.split("PartitionFilters", 1)[1].split("\n", 1)[0]
    read = [x for x in plan.split("\n") if x.startswith("ReadSchema")]
    assert read and all("message" not in x for x in read), read


def test_empty_sides(spark, tmp_path):
    stored = target(spark, str(tmp_path / "t"))
    none = spark.createDataFrame([], DOC)
    assert R.new_docs(none, stored).count() == 0
    one = spark.createDataFrame([("x", "i9", "db_0", "m")], DOC)
    assert R.new_docs(one, none.select(*stored.columns)).count() == 1
    assert R.new_docs(one, stored, indices=[]).count() == 1
