"""Quality classifier: a linear-chain conditional random field over the lines of a document.

A line is what stands between newlines, wrapped at ``WRAP`` bytes.  Its emission score uses
binned shape features of the line and of both neighbours; the chain adds transitions between
good and bad.  Forward-backward gives each line's probability of being good; their mean,
weighted by line length, is calibrated to the document's score.

Training: a sample of at most ``train_docs`` labelled documents and ``train_bytes`` of text, whole
texts in the order of their ids' hashes, only the training folds.  Tasks turn the sample's lines
into binned features; the driver gets 13 bytes a line and fits.  Lines inherit
their document's label; a second round relabels lines of bad documents that the first model
finds clearly good, so that a bad document may hold good lines.  All documents are scored whole.

Defined cases: null or empty text scores the share of good labels; without labels, or with one
kind only, every document scores that share (0.5 without any).  Null doc_ids and null labels
take no part in training; a null doc_id is scored and not held out.  An id with several labels
counts as the least of them.  Repeated rows are scored alike.  Empty table: empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thawline.llm.common import doc_texts

WRAP = 256
GROUP = 1 << 20
FOLDS = 5

_KINDS = [
    (b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2), (b" \t\n\r\v\f", 3),
    (b".,;:", 4), (b"'\"()-", 5), (b"!?", 6), (b"|", 7), (b"*$%&#@^~", 8), (b"<>{}[]=_/\\+`", 9),
]
_KIND = np.full(256, 11, np.uint8)
_KIND[128:] = 10
for _chars, _k in _KINDS:
    _KIND[list(_chars)] = _k
_SHARE = np.array([0.0005, 0.02, 0.08, 0.25, 0.6])
_EDGES = [_SHARE] * 10 + [np.array([3, 4, 5, 6, 8.0]), np.array([20, 60, 120, 200, 255.0])]
BINS = 6
N_FEATURES = len(_EDGES) * BINS


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document of each line, its length, its feature bins as indices into N_FEATURES)."""
    lens = np.array([len(t) + 1 for t in texts], np.int64)
    x = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    stop = np.flatnonzero(x == 10)
    start = np.concatenate([[0], stop[:-1] + 1])
    size = stop - start
    start, size = start[size > 0], size[size > 0]
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(_EDGES)), np.uint8)
    parts = -(-size // WRAP)
    k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(start, parts) + k * WRAP
    size = np.minimum(np.repeat(size, parts) - k * WRAP, WRAP)
    doc = np.searchsorted(np.cumsum(lens), start, "right")
    n = len(start)
    line = np.searchsorted(start, np.arange(len(x)), "right") - 1 if n < 2 else np.cumsum(np.bincount(start, minlength=len(x))) - 1
    line = np.maximum(line, 0)
    kind = _KIND[x]
    counts = np.bincount(line * 12 + kind, minlength=12 * n)[: 12 * n].reshape(n, 12).astype(float)
    space = kind == 3
    first = ~space
    first[1:] &= space[:-1]
    last = ~space
    last[:-1] &= space[1:]
    w0, w1 = np.flatnonzero(first), np.flatnonzero(last)
    pad = np.concatenate([x, np.zeros(4, np.uint8)]).astype(np.uint64)
    code = pad[w0] | pad[w0 + 1] << np.uint64(8) | pad[w0 + 2] << np.uint64(16) | (w1 - w0).astype(np.uint64) << np.uint64(24)
    again = np.zeros(len(w0))
    again[1:] = code[1:] == code[:-1]
    in_line = line[w0]
    words = np.maximum(np.bincount(in_line, minlength=n), 1)
    repeats = np.bincount(in_line, weights=again, minlength=n)
    letters = np.maximum(counts[:, 0] + counts[:, 1], 1)
    values = [counts[:, 1] / letters, counts[:, 2] / size, counts[:, 4] / words, counts[:, 5] / words, counts[:, 6] / words,
              counts[:, 7] / words, counts[:, 8] / words, counts[:, 9] / words, (counts[:, 10] + counts[:, 11]) / size, repeats / words,
              (size - counts[:, 3]) / words, size]
    bins = np.stack([np.digitize(v, e) + i * BINS for i, (v, e) in enumerate(zip(values, _EDGES))], axis=1)
    return doc, size, bins.astype(np.uint8)


@dataclass
class Chain:
    """CRF over states good (0) and bad (1): emission weights for own, previous and next line."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    bias: float
    trans: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    prior: float = 0.5
    fitted: bool = False


def _neighbours(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    same = doc[1:] == doc[:-1]
    has_prev = np.concatenate([[False], same])
    has_next = np.concatenate([same, [False]])
    return has_prev, has_next


def _weight(w: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Sum of the weights of each line's bins, feature by feature."""
    out = np.zeros(len(bins))
    for j in range(bins.shape[1]):
        out += w[bins[:, j]]
    return out


def _emissions(m: Chain, doc, bins) -> np.ndarray:
    has_prev, has_next = _neighbours(doc)
    e = m.bias + _weight(m.own, bins)
    e[1:] += np.where(has_prev[1:], _weight(m.before, bins[:-1]), 0)
    e[:-1] += np.where(has_next[:-1], _weight(m.after, bins[1:]), 0)
    return e


def marginals(e: np.ndarray, doc: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(bad) of every line, and the summed pair marginals (2 x 2); all documents at once, line by line."""
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    n = np.diff(np.append(first, len(doc)))
    order = np.argsort(-n, kind="stable")
    first, n = first[order], n[order]
    t = np.exp(trans)
    em = np.stack([np.exp(-np.maximum(e, 0)), np.exp(np.minimum(e, 0))], axis=1)  # scaled, at most 1
    alpha, beta = np.zeros((len(e), 2)), np.ones((len(e), 2))
    longest = int(n[0])
    alive = np.searchsorted(-n, -np.arange(longest), "left")  # documents with more than k lines
    a = em[first]
    a /= a.sum(1, keepdims=True)
    alpha[first] = a
    for k in range(1, longest):
        at = first[: alive[k]] + k
        a = (alpha[at - 1] @ t) * em[at]
        alpha[at] = a / a.sum(1, keepdims=True)
    for k in range(longest - 2, -1, -1):
        at = first[: alive[k + 1]] + k
        b = (beta[at + 1] * em[at + 1]) @ t.T
        beta[at] = b / b.sum(1, keepdims=True)
    g = alpha * beta
    g /= g.sum(1, keepdims=True)
    pairs = np.zeros((2, 2))
    nxt = np.flatnonzero(np.concatenate([doc[1:] == doc[:-1], [False]]))
    if len(nxt):
        p = alpha[nxt][:, :, None] * t[None] * (em[nxt + 1] * beta[nxt + 1])[:, None, :]
        pairs = (p / p.sum((1, 2), keepdims=True)).sum(0)
    return g[:, 1], pairs


def _fit(doc, bins, y, rounds: int, rate: float, ridge: float, m: Chain) -> Chain:
    """Adam on the conditional likelihood of the line labels ``y`` (1 = bad)."""
    has_prev, has_next = _neighbours(doc)
    pairs_seen = np.zeros((2, 2))
    i = np.flatnonzero(has_next)
    np.add.at(pairs_seen, (y[i], y[i + 1]), 1)
    p = np.concatenate([m.own, m.before, m.after, [m.bias], m.trans.ravel()])
    mom, sq = np.zeros_like(p), np.zeros_like(p)
    nf, columns = N_FEATURES, [np.ascontiguousarray(c) for c in bins.T]
    for step in range(1, rounds + 1):
        m = Chain(p[:nf], p[nf : 2 * nf], p[2 * nf : 3 * nf], p[3 * nf], p[3 * nf + 1 :].reshape(2, 2))
        bad, pairs = marginals(_emissions(m, doc, bins), doc, m.trans)
        r = y - bad
        before = np.where(has_next, np.concatenate([r[1:], [0]]), 0)  # this line as the previous one of the next
        after = np.where(has_prev, np.concatenate([[0], r[:-1]]), 0)
        g = np.concatenate([*(sum(np.bincount(c, weights=v, minlength=nf) for c in columns) for v in (r, before, after)), [r.sum()], (pairs_seen - pairs).ravel()])
        g = g / len(y) - ridge * p
        mom, sq = 0.9 * mom + 0.1 * g, 0.99 * sq + 0.01 * g * g
        p = p + rate * (mom / (1 - 0.9**step)) / (np.sqrt(sq / (1 - 0.99**step)) + 1e-8)
    return Chain(p[:nf], p[nf : 2 * nf], p[2 * nf : 3 * nf], p[3 * nf], p[3 * nf + 1 :].reshape(2, 2))


def _document_share(doc, size, bad, n_docs) -> np.ndarray:
    """Length-weighted mean of P(good); NaN for documents without lines."""
    total = np.bincount(doc, weights=size, minlength=n_docs)
    good = np.bincount(doc, weights=size * (1 - bad), minlength=n_docs)
    with np.errstate(invalid="ignore"):
        return good / total


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    w = np.array([1.0, 0.0])
    a = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        w = w + np.linalg.solve(h, a.T @ (y - p) - 1e-3 * w)
    return float(w[0]), float(w[1])


def fit(doc: np.ndarray, size: np.ndarray, bins: np.ndarray, quality: np.ndarray, rounds: int = 60) -> Chain:
    """Model of lines (document, length, bins) and of the documents' labels (1 = good)."""
    zero = np.zeros(N_FEATURES)
    m = Chain(zero, zero, zero, 0.0, np.zeros((2, 2)), prior=float(quality.mean()) if len(quality) else 0.5)
    prior = m.prior
    if not len(doc) or prior in (0.0, 1.0):
        return m
    bad_doc = (1 - quality).astype(np.int64)
    y = bad_doc[doc]
    m = _fit(doc, bins, y, rounds, 0.1, 1e-4, m)
    bad, _ = marginals(_emissions(m, doc, bins), doc, m.trans)
    y = np.where((y == 1) & (bad < 0.5), 0, y)
    m = _fit(doc, bins, y, rounds, 0.1, 1e-4, m)
    bad, _ = marginals(_emissions(m, doc, bins), doc, m.trans)
    share = _document_share(doc, size, bad, len(quality))
    has = ~np.isnan(share)
    m.slope, m.offset = _logistic(share[has] * 4 - 2, quality[has])
    m.prior, m.fitted = prior, True
    return m


def score(m: Chain, texts: list[bytes]) -> np.ndarray:
    out = np.full(len(texts), m.prior)
    if not m.fitted:
        return out
    doc, size, bins = line_features(texts)
    if not len(doc):
        return out
    bad, _ = marginals(_emissions(m, doc, bins), doc, m.trans)
    share = _document_share(doc, size, bad, len(texts))
    has = ~np.isnan(share)
    out[has] = 1 / (1 + np.exp(-(m.slope * (share[has] * 4 - 2) + m.offset)))
    return out


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, total_bytes: int) -> DataFrame:
    """(at, text, label): whole texts of at most ``rows`` labelled rows of the training folds.

    They come in the order of their ids' hashes (then ids and text hashes), numbered by ``at``; a text that
    would bring the sample over ``total_bytes`` is passed over.  Rows that repeat an id and its text count once.
    """
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    known = known.agg(F.min(label).cast("int").alias("label")).where(~held_out(F.col("doc_id")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = doc_texts(docs).withColumn("tag", F.xxhash64("text"))
    sizes = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "tag", "label", F.octet_length("text").alias("n")).distinct()  # at most ``rows`` ids
    keep, held = [], 0
    for r in sizes.orderBy(F.xxhash64("doc_id"), "doc_id", "tag").limit(rows).collect():  # four numbers a row
        if held + r.n <= total_bytes:
            keep.append((r.doc_id, r.tag, r.label, len(keep)))
            held += r.n
    sample = spark.createDataFrame(keep, "doc_id bigint, tag bigint, label int, at int")
    return texts.join(F.broadcast(sample), ["doc_id", "tag"]).select("at", "text", "label")


def groups(batch, size: int = GROUP):
    """Slices (start, texts) of an Arrow batch of some bytes each, so memory stays with one slice."""
    texts, group, held = batch.column("text"), [], 0
    for i in range(batch.num_rows):
        group.append((texts[i].as_py() or "").encode("utf-8", "surrogatepass"))
        held += len(group[-1])
        if held >= size or i == batch.num_rows - 1:
            yield i + 1 - len(group), group
            group, held = [], 0


def _sample_features(batches):
    """One row a text: its lines' lengths less one, and bins, a byte each."""
    for b in batches:
        for first, texts in groups(b):
            doc, size, bins = line_features(texts)
            edge = np.searchsorted(doc, np.arange(len(texts) + 1))
            cut = list(zip(edge[:-1].tolist(), edge[1:].tolist()))
            columns = [pa.array([(size[i:j] - 1).astype(np.uint8).tobytes() for i, j in cut], pa.binary()), pa.array([bins[i:j].tobytes() for i, j in cut], pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column("at").slice(first, len(texts)), b.column("label").slice(first, len(texts)), *columns], names=["at", "label", "sizes", "bins"])


def trained(docs: DataFrame, labels: DataFrame, train_docs: int, train_bytes: int) -> Chain:
    """Model fitted on the driver to the features of the bounded sample."""
    sample = training_sample(docs, labels, "quality", train_docs, train_bytes)
    rows = sample.mapInArrow(_sample_features, "at int, label int, sizes binary, bins binary").dropDuplicates(["at"]).orderBy("at").toArrow()
    sizes = rows["sizes"].to_pylist()
    doc = np.repeat(np.arange(len(sizes)), [len(x) for x in sizes])
    size = np.frombuffer(b"".join(sizes), np.uint8).astype(np.int64) + 1
    bins = np.frombuffer(b"".join(rows["bins"].to_pylist()), np.uint8).reshape(-1, len(_EDGES))
    return fit(doc, size, bins, rows["label"].to_numpy().astype(float))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, train_docs: int = 4000, train_bytes: int = 1 << 25) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    m = trained(docs, labels, train_docs, train_bytes)

    def run(batches):
        for b in batches:
            parts = [score(m, g) for _, g in groups(b)]
            s = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s)], names=["doc_id", "score"])

    out = doc_texts(docs).mapInArrow(run, "doc_id bigint, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, train_docs: int = 4000, train_bytes: int = 1 << 25) -> DataFrame:
    """The rows of ``docs`` that are predicted good, all columns as they were (no shuffle)."""
    m = trained(docs, labels, train_docs, train_bytes)
    return docs.mapInArrow(keep_slices("text", lambda texts: score(m, texts) >= threshold), docs.schema)


def keep_slices(column: str, good):
    """Function for ``mapInArrow`` that passes on the rows whose text ``good`` accepts, some bytes of text at a time."""

    def run(batches):
        for b in batches:
            texts, group, held, start = b.column(b.schema.names.index(column)), [], 0, 0
            for i in range(b.num_rows):
                group.append((texts[i].as_py() or "").encode("utf-8", "surrogatepass"))
                held += len(group[-1])
                if held >= GROUP or i == b.num_rows - 1:
                    yield b.slice(start, len(group)).filter(pa.array(good(group)))
                    group, held, start = [], 0, i + 1

    return run
