"""Whitening: against numpy's eigenvectors and whole-number brute force."""

import math

import numpy as np
import pytest

from thawline.llm import op13_whitening as M

SCHEMA = "vec_id bigint, embedding array<float>, label int, x array<int>, component string"


def test_factor_and_rotations():
    rng = np.random.default_rng(2)
    for d, n in [(1, 4), (5, 40), (12, 6), (33, 200), (4, 1)]:
        x = rng.normal(size=(n, d)) * np.exp(rng.normal(size=d) * 3)
        x -= x.mean(0)
        a = x.T @ x
        low = M.factor(a)
        assert np.allclose(low @ low.T, a, atol=1e-10 * max(1, np.abs(a).max()))
        values, vectors = M.principal(a)
        want = np.linalg.eigvalsh(a)[::-1][: len(values)]
        assert len(values) == (np.linalg.matrix_rank(x, tol=1e-7 * np.linalg.norm(x)) if n > 1 else 0)
        assert np.allclose(values, want, rtol=1e-10, atol=1e-12 * want.max(initial=0))
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-9) and np.allclose(a @ vectors, vectors * values, atol=1e-9 * values.max(initial=1))


def _rows():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 6)) @ np.diag([3, 1.5, 1, 0.5, 0.1, 0.01]) + 5
    rows = [(i, v.tolist(), 1, [1], "c") for i, v in enumerate(x.astype(np.float32))]
    rows += [(1000 + i, rows[3][1], 1, None, "c") for i in range(200)]  # a third of the rows is one vector
    rows += [(None, rows[5][1], None, None, None), (7, rows[8][1], 1, None, None)]
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0, 5.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5, [1.0, 2.0]]
    return rows, rows + [(2000 + i, b, 1, None, "c") for i, b in enumerate(bad)]


def _expect(rows, k=4):
    x = [[math.floor(float(c) * 256) for c in r[1]] for r in rows]
    fit = [list(t) for t in sorted({tuple(v) for v in x})]
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    c = np.array([[(n * a - b) / n for a, b in zip(v, s)] for v in fit])
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    white = np.array([[(n * a - b) / n for a, b in zip(v, s)] for v in x]) @ u / np.sqrt(e)
    dev = [sum((n * a - b) ** 2 for a, b in zip(v, s)) for v in x]
    return n, dev, white, e / np.trace(cov)


def test_rows(spark):
    good, rows = _rows()
    got = M.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    n, dev, white, explained = _expect(good)
    assert len(got) == 4 * len(good) and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9 and len({r.identity_error for r in got}) == 1
    for c in range(4):
        mine = sorted(((r.deviation, r.vec_id, r.whitened) for r in got if r.component == c + 1), key=str)
        want = sorted(((d, g[0], w) for d, g, w in zip(dev, good, white[:, c].tolist())), key=str)
        assert [m[:2] for m in mine] == [w[:2] for w in want]
        a, b = np.array([m[2] for m in mine]), np.array([w[2] for w in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
        assert [r.explained for r in got if r.component == c + 1] == pytest.approx([explained[c]] * len(good), rel=1e-9)


def test_few_and_extreme_vectors(spark):
    df = lambda rows: spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert M.whiten(df([])).count() == 0 and M.whiten(df([(1, None), (2, [])])).count() == 0
    assert M.whiten(df([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # one vector, no variance
    two = M.whiten(df([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [3.0, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation) for r in two] == [(1, 2, 512**2)] * 3 and {round(abs(r.whitened), 9) for r in two} == {1.0}
    far = M.whiten(df([(i, [float(i) * 1e300, 1.0, float(i % 2)]) for i in range(5)] + [(9, [-1e300, 0.0, 0.0])])).collect()
    assert {r.component for r in far} >= {1} and all(r.deviation is None for r in far) and max(r.identity_error for r in far) < 1e-4
