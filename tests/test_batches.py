"""Batches of documents in any order equal a row-by-row cut, also where batches cross many slices."""

import random

import pytest

from thawline.sinks.batches import batches_anywhere

SCHEMA = "bucket_key STRING, event_ordinal BIGINT, nbytes BIGINT"


def walked(rows, max_docs, max_bytes):
    out, state = {}, {}
    for k, _, nb in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        batch, docs, size = state.get(k, (0, 0, 0))
        docs, size = docs + 1, size + nb
        out[k, batch] = (docs, size)
        state[k] = (batch + 1, 0, 0) if docs >= max_docs or size >= max_bytes else (batch, docs, size)
    return out


@pytest.mark.parametrize("max_docs,max_bytes", [(7, 10**9), (10**6, 900), (50, 4000), (1, 1), (10**6, 10**9)])
def test_hot_bucket_in_many_slices(spark, max_docs, max_bytes):
    rng = random.Random(max_docs)
    rows = [("hot", i, rng.choice([0, 1, 80, 80, 5000])) for i in range(3000)]
    rows += [(f"b{j}", i, 100) for j in range(20) for i in range(rng.randrange(1, 30))] + [(None, i, 70) for i in range(40)]
    rows += [("", 0, 5), ("-", 0, 5)]
    rng.shuffle(rows)
    got = batches_anywhere(spark.createDataFrame(rows, SCHEMA), max_docs, max_bytes, n_slices=12).collect()
    assert {(r.bucket_key, r.batch): (r.n_docs, r.n_bytes) for r in got} == walked(rows, max_docs, max_bytes)
    assert len(got) == len({(r.bucket_key, r.batch) for r in got})


def test_nothing_and_bad_limits(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert batches_anywhere(none, 500, 100).count() == 0
    with pytest.raises(ValueError):
        batches_anywhere(none, 0, 100)
