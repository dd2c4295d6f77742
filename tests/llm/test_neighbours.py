"""Neighbour search against brute force."""

import numpy as np
import pytest

from thawline.llm import op2_ann as M

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, block int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x", 2) for i, v in rows], SCHEMA)


def brute(rows, k, every):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in ok:
        if q % every == 0:
            s = {(-float((x * y).sum()), i) for i, y in ok if i != q and len(y) == len(x)}
            out[q] = [i for _, i in sorted(s)[:k]]
    return out


def rows(n=700, dim=12, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, dim))
    x = [(i, (centres[i % 8] + 0.3 * rng.standard_normal(dim)).tolist()) for i in range(n)]
    x += [(n + i, x[40][1]) for i in range(60)]  # one very common vector
    return x + [(2000, None), (2020, []), (2040, [0.0] * dim), (2060, [None] + [1.0] * (dim - 1)), (2080, [float("nan")] * dim),
                (2100, [float("inf")] * dim), (None, [1.0] * dim), (2120, [1.0, 2.0]), (2140, [2.0, 1.0])]


@pytest.fixture
def apart(spark):
    """Every shuffle partition stays a task of its own, as on a cluster."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_recall_order_and_scores(spark, apart):
    data = rows()
    want = brute(data, 20, 20)
    got = {}
    vec = {i: np.array(v, np.float32).astype(float) for i, v in data if v and None not in v}
    for r in M.neighbours(table(spark, data), block_rows=200, query_rows=16).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        assert abs(r.score - float((vec[r.query_id] * vec[r.vec_id]).sum())) < 1e-9
    assert set(got) == set(want)
    for q, g in got.items():
        assert [x[0] for x in g] == list(range(1, len(want[q]) + 1))
        assert [x[1] for x in g] == [i for _, i in sorted((-s, i) for _, i, s in g)]
    hits = sum(len(set(want[q]) & {x[1] for x in got[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95
    assert got[2120] == [(1, 2140, 4.0)]


def test_copies_give_their_smallest_ids(spark, apart):
    data = [(i, [1.0, 0.5]) for i in range(50)]
    got = [(r.query_id, r.vec_id) for r in M.neighbours(table(spark, data), k=3, block_rows=7).collect()]
    assert sorted(got) == [(0, 1), (0, 2), (0, 3), (20, 0), (20, 1), (20, 2), (40, 0), (40, 1), (40, 2)]


def test_stopping_test_visits_few_points_of_clustered_data():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((200, 32)) * 10
    x = np.repeat(centres, 50, axis=0) + 0.05 * rng.standard_normal((10_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(len(x))
    q, found, score, verified = M.search(ids, x, ids[:50], x[:50], 20, 1.0, 8, 0.99, 1)
    want = np.argsort(-(x[:50] @ x.T), axis=1)[:, 1:21]
    got = np.array(found).reshape(50, 20)
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(got, want)]) >= 0.9
    assert verified < 0.3 * 50 * len(x)


def test_quantile():
    assert abs(M.chi_square_quantile(0.95, 2) - 5.991) < 1e-3 and abs(M.chi_square_quantile(0.99, 8) - 20.090) < 1e-3


def test_empty_table(spark):
    assert M.neighbours(table(spark, [])).count() == 0


@pytest.mark.parametrize("size", [1e-42, 1e-25, 1e25, 3e37])
def test_every_magnitude(spark, size):
    rng = np.random.default_rng(3)
    data = [(i, (rng.standard_normal(12) * size).tolist()) for i in range(400)] + [(400, [0.0] * 11 + [size / 4]), (500, [1e-3 * size] * 12)]
    vec = {i: np.array(v, np.float32).astype(float) for i, v in data}
    got = {}
    for r in M.neighbours(table(spark, data), block_rows=150, query_rows=16).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r.score == pytest.approx(float((vec[r.query_id] * vec[r.vec_id]).sum()), rel=1e-9, abs=1e-9 * size * size)
    want = brute(data, 20, 20)
    assert set(got) == set(want) and np.mean([len(set(got[q]) & set(want[q])) / len(want[q]) for q in want]) >= 0.95
