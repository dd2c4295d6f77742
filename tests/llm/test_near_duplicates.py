"""Near duplicates against brute force over all pairs of documents."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import docs, empty, prose
from thawline.llm import op10_minhash as M
from thawline.llm.components import components


def brute(rows, words, percent):
    """component of every row by exact similarity of shingle sets (strings, not hashes)"""

    def shingles(t):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or "")).encode().split()
        return {b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({b" ".join(w)} if w else set())

    sets = [shingles(t) for _, t in rows]
    at = list(range(len(rows)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                at[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(sets[i]), low.get(find(i)) if d is not None else None) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("words,list_bound,block", [(2, 32, 2048), (5, 2, 4)])
def test_equals_brute_force(spark, words, list_bound, block):
    df, rows = docs(spark)
    got = M.near_duplicates(df, words=words, list_bound=list_bound, block=block).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, words, 80)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


@pytest.fixture
def apart(spark):
    """Every shuffle partition stays a task of its own, as on a cluster."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_large_group_of_near_copies(spark, apart):
    """Lists longer than the bound: leaders, then blocks; documents that only share a passage stay apart."""
    rng = random.Random(2)
    base, passage = prose(rng, 120).split(), prose(rng, 60)
    rows = []
    for i in range(90):
        v = list(base)
        for _ in range(rng.randint(0, 14)):
            v[rng.randrange(len(v))] = prose(rng, 1)
        rows.append((i, " ".join(v)))
    rows += [(100 + i, passage + " " + prose(rng, rng.randint(10, 80))) for i in range(60)]
    df, rows = docs(spark, rows)
    got = M.near_duplicates(df, words=2, list_bound=4, block=16).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 2, 80)


def test_keep_one_keeps_columns_and_one_row_a_group(spark):
    df, rows = docs(spark)
    kept = M.keep_one(df, words=5)
    assert kept.columns == df.columns
    want = {d for d, n, c in brute(rows, 5, 80) if d is not None and d == c}
    got = [r.doc_id for r in kept.collect()]
    assert {g for g in got if g is not None} == want
    assert sum(g is None for g in got) == sum(d is None for d, _ in rows)
    with_words = [g for g in got if g == 5000]
    assert len(with_words) == 1


def test_keep_one_by_row_not_by_id(spark):
    rng = random.Random(4)
    a, b, c = (prose(rng, 60) for _ in range(3))
    # id 20: leader of a's group, and near to id 10; id 30: two unlinked texts, one of them twice
    rows = [(10, b), (20, a), (20, b + " end"), (21, a + " end"), (22, a), (30, c), (30, c), (30, prose(rng, 60)), (31, c + " end"), (30, None), (30, ""), (None, a)]
    rows.append((20, a.upper()))  # the same shingles, another text
    df, _ = docs(spark, rows)

    def kept(**options):
        return sorted(((r.doc_id, (r.text or "").lower()) for r in M.keep_one(df, words=2, **options).collect()), key=str)

    always = [(10, b), (20, a), (30, ""), (30, ""), (None, a)]
    assert kept(one_row_an_id=False) == sorted([*always, (30, c), (30, rows[7][1])], key=str)
    got = kept()
    assert len(got) == 6 and all(x in got for x in always)


def test_pipeline_stage_keeps_every_group(spark):
    import corpus_pipeline

    df, _ = docs(spark)
    texts = [r.text for r in corpus_pipeline.near_dedup(spark, df, "").collect() if r.doc_id == 5000]
    assert sorted(texts) == ["another text of the id", "same row again and again"]


def test_empty_table(spark):
    assert M.near_duplicates(empty(spark)).count() == 0 and M.keep_one(empty(spark)).count() == 0


def test_runs_of_small_sets_always_meet():
    """Sets that are whole in the sketch share a run whenever they are similar enough."""
    rng = np.random.default_rng(1)
    for _ in range(3000):
        u = int(rng.integers(1, 60))
        union = np.unique(rng.integers(0, 2**62, u))
        off = rng.permutation(len(union))[: int(0.2 * len(union))]
        side = rng.random(len(off)) < 0.5
        a, b = np.delete(union, off[side]), np.delete(union, off[~side])
        assert np.intersect1d(M.run_keys(a), M.run_keys(b)).size, (a, b)


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (3, 3), (2, 1), (20, 25), (25, 21), (21, 24)] + [(i, i + 1) for i in range(100, 160)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 20: 20, 21: 20, 24: 20, 25: 20} | {i: 100 for i in range(100, 161)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).where(F.lit(True)).count() == 0
