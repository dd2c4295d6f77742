"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Largest inner product becomes least Euclidean distance by one more coordinate: a vector x gets
sqrt(M - |x|^2), M the largest squared norm, a query gets 0.  Vectors are projected to
``projections`` dimensions with normal (2-stable) coefficients, so that the squared projected
distance over the squared true distance has a chi-square distribution with that many degrees of
freedom, whatever the vectors.  A block's projected points are in a kd-tree; a query takes them
in the order of projected distance, computes their true inner products, and stops when the next
projected distance is so large that a vector nearer than its k-th best would lie beyond it with
probability 1 - ``confidence`` at most.

All rows are indexed, in blocks by the hash of their id; every block meets the queries in parts
(a pair of blocks is one task's work, of bounded size), and the blocks' results are merged by
rank.  Equal vectors of a block are one point that carries its ids, so copies cost nothing.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows
with a null vec_id, take no part.  Vectors of another length than the query's are no candidates.
Rows that repeat a vec_id: a query's own id is never its neighbour; each row with a usable vector
is a query and a candidate, equal rows count once.  Ties go to the smaller vec_id.  Fewer than k
candidates: all of them.  Empty table: empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEAF = 64
OPEN = 16  # leaves opened at once
BATCH = 1024  # projected neighbours verified at once


def chi_square_quantile(p: float, m: int) -> float:
    """Quantile of the chi-square distribution with an even number of degrees of freedom."""

    def below(x):
        term, total = 1.0, 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


class Tree:
    """kd-tree leaves over projected points: median splits on the widest axis down to LEAF points."""

    def __init__(self, points: np.ndarray, vectors: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        bounds, todo = [], [(0, len(points))]
        while todo:
            s, e = todo.pop()
            if e - s <= LEAF:
                bounds.append((s, e))
                continue
            part = points[self.order[s:e]]
            axis = int(np.argmax(part.max(0) - part.min(0)))
            mid = (e - s) // 2
            self.order[s:e] = self.order[s:e][np.argpartition(part[:, axis], mid)]
            todo += [(s, s + mid), (s + mid, e)]
        self.bounds = np.array(sorted(bounds)).reshape(-1, 2)
        boxes = [points[self.order[s:e]] for s, e in self.bounds]
        self.placed, self.rough = points[self.order], vectors[self.order].astype(np.float32)  # leaf by leaf
        self.low, self.high = np.array([b.min(0) for b in boxes]), np.array([b.max(0) for b in boxes])

    def nearest(self, q: np.ndarray, vector: np.ndarray):
        """Points in the order of squared projected distance, some at a time.

        Yields (indices, single-precision inner products with ``vector``, least squared distance of what follows).
        """
        gap = np.maximum(np.maximum(self.low - q, q - self.high), 0)
        least = (gap * gap).sum(1)
        leaves, vector = np.argsort(least, kind="stable"), vector.astype(np.float32)
        ids, dist, ip, at = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.float32), 0
        while at < len(leaves) or len(ids):
            limit = least[leaves[at]] if at < len(leaves) else np.inf
            ready = dist <= limit
            if at < len(leaves) and np.count_nonzero(ready) < BATCH:
                spans = self.bounds[leaves[at : at + OPEN]].tolist()
                diff = np.concatenate([self.placed[s:e] for s, e in spans]) - q
                ids = np.concatenate([ids, *(self.order[s:e] for s, e in spans)])
                dist = np.concatenate([dist, np.einsum("ij,ij->i", diff, diff)])
                ip = np.concatenate([ip, *(self.rough[s:e] @ vector for s, e in spans)])
                at += OPEN
                continue
            rest = ~ready
            ahead = min(limit, dist[rest].min() if rest.any() else np.inf)
            yield ids[ready], ip[ready], ahead
            ids, dist, ip = ids[rest], dist[rest], ip[rest]


def search(vec_ids, vectors, query_ids, queries, k: int, largest: float, projections: int, confidence: float, seed: int, exponent: int = 0):
    """(query row, vec_id, score) of the ``k`` best found for each query among ``vectors``.

    ``largest``: the largest squared norm of all vectors times ``2 ** -exponent``.
    """
    vectors, queries = vectors.astype(np.float64), queries.astype(np.float64)
    # powers of two change no digit: all magnitudes meet single precision, and products do not overflow
    scale = -np.frexp(np.abs(queries).max(1, initial=0))[1]
    originals, queries = queries, np.ldexp(queries, scale[:, None])
    points, where = np.unique(vectors, axis=0, return_inverse=True)
    exact, points = points, np.ldexp(points, -exponent)
    by = np.lexsort((vec_ids, where.ravel()))
    first = np.searchsorted(where.ravel()[by], np.arange(len(points) + 1))
    held = [np.unique(vec_ids[by[s:e]])[: k + 1] for s, e in zip(first[:-1], first[1:])]  # k + 1 least ids of equal vectors
    extra = np.sqrt(np.maximum(largest - (points * points).sum(1), 0))
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((points.shape[1] + 1, projections))
    tree = Tree(np.column_stack([points, extra]) @ a, points)
    stop = chi_square_quantile(confidence, projections)
    out_q, out_id, out_s, verified = [], [], [], 0
    for i, q in enumerate(queries):
        norm = float(q @ q) + largest
        ids, score, place = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        slack = 1e-4 * (float(q @ q) * largest) ** 0.5  # far above single precision's error
        for found, rough, ahead in tree.nearest(np.append(q, 0) @ a, q):
            verified += len(found)
            if len(score) >= k:
                found = found[rough >= score[k - 1] - slack]
            elif len(found) > k + 1:  # one of them may be the query's own
                found = found[rough >= np.partition(rough, -k - 1)[-k - 1] - 2 * slack]
            ip = (points[found] * q).sum(1)
            if len(score) >= k:
                better = ip >= score[k - 1]
                found, ip = found[better], ip[better]
            own = [held[f] for f in found.tolist()]
            new_ids = np.concatenate(own) if own else np.zeros(0, np.int64)
            new_scores = np.repeat(ip, [len(x) for x in own])
            other = new_ids != query_ids[i]
            new_place = np.repeat(found, [len(x) for x in own]).astype(np.int64)
            ids, score, place = np.concatenate([ids, new_ids[other]]), np.concatenate([score, new_scores[other]]), np.concatenate([place, new_place[other]])
            best = np.lexsort((ids, -score))[:k]
            ids, score, place = ids[best], score[best], place[best]
            if len(score) >= k and ahead > stop * max(norm - 2 * score[k - 1], 0):
                break
        out_q += [i] * len(ids)
        out_id.append(ids)
        with np.errstate(over="ignore", invalid="ignore"):
            out_s.append((exact[place] * originals[i]).sum(1))
    return out_q, np.concatenate(out_id or [np.zeros(0, np.int64)]), np.concatenate(out_s or [np.zeros(0)]), verified


def _pair(k, largest, projections, confidence, seed, exponent):
    def run(index, queries):
        import pandas as pd

        if not len(index) or not len(queries):
            return pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})
        q_ids = queries["q_id"].to_numpy()
        row, ids, score, _ = search(
            index["v_id"].to_numpy(), np.stack(index["v"].to_list()), q_ids, np.stack(queries["q"].to_list()), k, largest, projections, confidence, seed, exponent
        )
        return pd.DataFrame({"query_id": q_ids[row], "vec_id": ids, "score": score})

    return run


def usable(embeddings: DataFrame) -> DataFrame:
    """(v_id, v) rows that take part."""
    x = embeddings.select(F.col("vec_id").cast("bigint").alias("v_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = "v_id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)"
    return x.where(fine)


def neighbours(
    embeddings: DataFrame,
    k: int = 20,
    every: int = 20,
    projections: int = 8,
    confidence: float = 0.99,
    block_rows: int = 16384,
    query_rows: int = 1024,
    seed: int = 1,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row whose id ``every`` divides."""
    rows = usable(embeddings)
    n, n_q, top = rows.agg(F.count("*"), F.count_if(F.col("v_id") % every == 0), F.max(F.array_max(F.transform("v", F.abs)))).first()
    exponent = int(np.frexp(top or 1.0)[1])  # no entry is over one at this scale
    half = exponent // 2
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + F.pow(x * 2.0**-half * 2.0 ** (half - exponent), F.lit(2.0)))
    largest = rows.agg(F.max(norm)).first()[0]
    blocks, parts = max(1, -(-n // block_rows)), max(1, -(-n_q // query_rows))
    # keys of both sides have the same types: equal numbers of other types hash apart
    index = rows.withColumn("dim", F.size("v")).withColumn("block", F.pmod(F.xxhash64("v_id"), F.lit(blocks)).cast("int"))
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = rows.where(F.col("v_id") % every == 0).select(F.col("v_id").alias("q_id"), F.col("v").alias("q")).distinct()
    asked = asked.withColumn("q_dim", F.size("q")).withColumn("q_part", F.pmod(F.xxhash64("q_id", F.lit(7)), F.lit(parts)).cast("int"))
    asked = asked.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = index.groupBy("dim", "block", "part").cogroup(asked.groupBy("q_dim", "q_block", "q_part"))
    found = found.applyInPandas(_pair(k, largest or 0.0, projections, confidence, seed, exponent), "query_id bigint, vec_id bigint, score double")
    ranked = found.distinct().withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
