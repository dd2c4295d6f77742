"""The pipeline: stages' columns and decisions, and the registered queries with a DuckDB twin."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from tests.harness import compare, duck
from thawline.llm import op1_sentencepiece, registry
from thawline.llm.common import saved

SF = "/root/testdata/sf0.01"


def test_names():
    assert [f for _, f in P.STAGES] == [P.quality, P.near_dedup, P.passages, P.decontamination, P.pieces]
    names = entry.queries()
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 14)} <= {x.split("_")[0] + "_" for x in names if x.startswith("op")}


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_twins(spark, name):
    ok, msg = compare(spark, name, SF, registry.QUERIES, registry.SQL, duck(SF))
    assert ok, msg


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    ids = [{r.doc_id for r in docs.select("doc_id").collect()}]
    for name, stage in P.STAGES[:-1]:
        docs = saved(stage(spark, docs, SF), "test-stage")
        assert docs.columns == names, name
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert docs.count() == len(ids[-1]) and ids[-1] <= ids[-2]
    bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    assert len(bad & ids[1]) <= 0.1 * len(bad) and len(good & ids[1]) >= 0.98 * len(good)
    assert ids[3] == ids[2] and len(ids[2]) < len(ids[1])  # passages cut texts, not rows
    last = P.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(r.doc_id for r in last) == sorted(ids[-1])
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert all(r.decoded == texts[r.doc_id] for r in last if op1_sentencepiece.SPACE not in texts[r.doc_id])
