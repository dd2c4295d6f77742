"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on the triangular factor.

Entries are read as fixed-point numbers x = floor(256 c).  The fit list is every distinct x vector
once: n vectors with sums S.  Spark sums the scatter of the centred vectors (n x - S) / n in the
tasks, block by block; only the d x d sum (d dimensions, whatever the number of rows) reaches the
driver.  There the scatter A = L L' is factored with the largest remaining diagonal entry as pivot,
which stops at the rank, and the columns of L are rotated pairwise until they are orthogonal: the
rotated columns' squared norms are the eigenvalues of A, the normalised columns its eigenvectors.

Defined cases: vectors that are null or empty, or hold null or non-finite entries, take no part; neither do
vectors of another length than most have (the smaller length on ties).  Entries beyond 64 bits are
held at the ends of that range.  A null vec_id and repeated rows give rows of their own.  Components
of no variance (eigenvalue up to 1e-13 of the largest) have no rows, so a table with fewer than two different vectors
gives none.  ``deviation`` is null where it does not fit 64 bits.  Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thawline.llm.common import saved

SCALE = 256
WIDE = 16  # entries of a scatter row in one record
RANK = 1e-13


def usable(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the vectors that take part; x is array<bigint>."""
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    fixed = F.transform(v, lambda c: F.floor(c * SCALE))  # floor() holds doubles beyond 64 bits at the ends of the range
    return rows.where(F.coalesce(good, F.lit(False)) & (F.size(vector) > 0)).select(F.col(vec_id).cast("bigint").alias("vec_id"), fixed.alias("x"))


def factor(a: np.ndarray) -> np.ndarray:
    """L with a = L L' (rows in the order of ``a``), by Cholesky with diagonal pivoting; as many columns as the rank."""
    a, d = a.astype(float).copy(), len(a)
    left, columns = a.diagonal().copy(), []
    stop = d * np.finfo(float).eps * max(left.max(initial=0), 0)
    done = np.zeros(d, bool)
    for _ in range(d):
        p = int(np.argmax(np.where(done, -np.inf, left)))
        if left[p] <= stop:
            break
        col = a[:, p].copy()
        for c in columns:
            col -= c * c[p]
        col[done] = 0
        col /= np.sqrt(col[p])
        done[p] = True
        left -= col * col
        columns.append(col)
    return np.stack(columns, axis=1) if columns else np.zeros((d, 0))


def rotated(low: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of ``low``, rotated pairwise until all are orthogonal; disjoint pairs turn together."""
    g = low.copy()
    r = g.shape[1]
    ring = list(range(r)) + ([-1] if r % 2 else [])
    half = len(ring) // 2
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(max(len(ring) - 1, 0)):
            pairs = [(min(p, q), max(p, q)) for p, q in zip(ring[:half], reversed(ring[half:])) if p >= 0 and q >= 0]
            i, j = np.array(pairs, np.int64).reshape(-1, 2).T
            u, v = g[:, i], g[:, j]
            a, b, c = (u * u).sum(0), (v * v).sum(0), (u * v).sum(0)
            size = np.sqrt(a * b)
            open_ = np.abs(c) > 1e-15 * size
            worst = max(worst, float((np.abs(c) / np.where(size > 0, size, 1)).max(initial=0)))
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                z = (b - a) / (2 * c)
                t = np.where(z >= 0, 1.0, -1.0) / (np.abs(z) + np.sqrt(1 + z * z))
            t = np.where(open_, t, 0.0)
            cos = 1 / np.sqrt(1 + t * t)
            sin = cos * t
            g[:, i], g[:, j] = cos * u - sin * v, sin * u + cos * v
            ring = ring[:1] + ring[-1:] + ring[1:-1]
        if worst <= 1e-14:
            break
    return g


def principal(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues of the scatter, falling; unit eigenvectors as columns), those above rounding only."""
    g = rotated(factor(scatter))
    norm = np.sqrt((g * g).sum(0))
    order = np.argsort(-norm, kind="stable")
    order = order[norm[order] ** 2 > RANK * (norm.max(initial=0) ** 2)]
    return norm[order] ** 2, g[:, order] / norm[order]


def _matrix(batch) -> np.ndarray:
    x = batch.column("x")
    return x.values.to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """(n x - S) / n; the difference is taken in whole numbers, so nothing cancels."""
    most = n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, sums), default=0)
    if most < 1 << 62:
        return (x * np.int64(n) - np.array(sums, np.int64)) / n
    return np.array([[float(n * v - s) / n for v, s in zip(row, sums)] for row in x.tolist()]).reshape(x.shape)


def _scatter(n: int, sums: list[int], rows: int = 4096):
    d = len(sums)
    blocks = -(-d // WIDE)

    def run(batches):
        total = np.zeros((d, d))
        for b in batches:
            x = _matrix(b)
            for at in range(0, len(x), rows):
                c = _centred(x[at : at + rows], n, sums)
                total += c.T @ c
        wide = np.zeros((d, blocks * WIDE))
        wide[:, :d] = total
        i, k = np.divmod(np.arange(d * blocks), blocks)
        flat = wide.reshape(d * blocks, WIDE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(k.astype(np.int32)), *(pa.array(flat[:, w].copy()) for w in range(WIDE))], names=["i", "k", *(f"v{w}" for w in range(WIDE))]
        )

    return run


class Whitening:
    """Fitted components: ``n``, ``sums`` of the fit list, ``values`` (eigenvalues of the covariance), ``vectors`` (columns), ``trace``."""

    def __init__(self, n: int, sums: list[int], scatter: np.ndarray):
        self.n, self.sums = n, sums
        values, self.vectors = principal(scatter) if n > 1 else (np.zeros(0), np.zeros((len(sums), 0)))
        self.values, self.trace = values / max(n, 1), float(np.trace(scatter)) / max(n, 1)

    def whitened(self, x: np.ndarray, k: int) -> np.ndarray:
        return _centred(x, self.n, self.sums) @ self.vectors[:, :k] / np.sqrt(self.values[:k])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each row, exact; None beyond 64 bits."""
        most = self.n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, self.sums), default=0)
        if most**2 * len(self.sums) < 1 << 62:
            c = x * np.int64(self.n) - np.array(self.sums, np.int64)
            return (c * c).sum(1).tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist())
        return [e if e < 1 << 63 else None for e in exact]


def fit(vectors: DataFrame) -> tuple[Whitening, DataFrame]:
    """(components, the fit list as a table with column x) of ``usable`` rows of one length."""
    distinct = saved(vectors.select("x").distinct(), "op13-fit")
    d = len((distinct.first() or [[]])[0])
    # sums of 64-bit entries as decimals: they may pass 64 bits
    total = distinct.agg(F.count("*").alias("n"), *(F.sum(F.col("x")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(d))).first()
    n, sums = total["n"], [int(total[f"s{i}"]) for i in range(d)] if d and total["n"] else []
    schema = "i int, k int, " + ", ".join(f"v{w} double" for w in range(WIDE))
    parts = distinct.mapInArrow(_scatter(n, sums), schema).groupBy("i", "k").agg(*(F.sum(f"v{w}").alias(f"v{w}") for w in range(WIDE))) if d else None
    scatter = np.zeros((d, -(-d // WIDE) * WIDE))
    for r in parts.collect() if d else []:  # d * d numbers
        scatter[r["i"], r["k"] * WIDE : (r["k"] + 1) * WIDE] = r[2:]
    return Whitening(n, sums, scatter[:, :d]), distinct


def same_length(rows: DataFrame) -> DataFrame:
    """The rows whose vectors have the most frequent length."""
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("x") == (sizes["d"] if sizes else 0))


def whiten(embeddings: DataFrame, components: int = 4, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row and component."""
    vectors = same_length(usable(embeddings, vec_id, vector))
    model, fit_list = fit(vectors)
    k = min(components, len(model.values))
    shared = embeddings.sparkSession.sparkContext.broadcast(model)  # d x d numbers

    def run(columns):
        def part(batches):
            for b in batches:
                x, m = _matrix(b), shared.value
                w = m.whitened(x, k)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), *([pa.array(m.deviations(x), pa.int64())] if columns else []),
                                                  *(pa.array(np.ascontiguousarray(w[:, i])) for i in range(k))],
                                                 names=[*columns, *(["deviation"] if columns else []), *(f"w{i}" for i in range(k))])

        return part

    schema = ", ".join(f"w{i} double" for i in range(k))
    # Spark's covar_pop moves its centre along, so products are of centred numbers
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    error = 0.0
    if k:
        covariance = fit_list.mapInArrow(run([]), schema).agg(*(F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs)).first()
        error = max(abs(covariance[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    rows = vectors.mapInArrow(run(["vec_id"]), f"vec_id bigint, deviation bigint{', ' + schema if k else ''}")
    each = F.array(*(F.struct(F.lit(i + 1).alias("component"), F.col(f"w{i}").alias("whitened"), F.lit(float(model.values[i] / model.trace)).alias("explained")) for i in range(k)))
    none = F.array().cast("array<struct<component:int,whitened:double,explained:double>>")
    rows = rows.select("vec_id", "deviation", F.inline(each if k else none))
    return rows.select("vec_id", "component", F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened", "explained", F.lit(float(error)).alias("identity_error"))
