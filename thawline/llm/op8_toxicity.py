"""Toxicity by multiple-instance learning: sentences are scored, noisy-or makes the document's score.

A sentence's probability is a logistic function of the trained terms in it; a document is toxic
unless none of its sentences is: 1 - (1 - leak) * product(1 - p).  ``leak`` takes the share of
toxic labels that no term explains.  Only documents carry labels; the gradient of the
documents' likelihood reaches the sentences through the noisy-or.  Sentences with a probability
of one half or more are the offending ones.

Training: a sample of at most ``train_docs`` labelled documents and ``train_bytes`` of text, whole
texts in the order of their ids' hashes, only the training folds, whatever they share.  Terms
are words and word beginnings of the sample that at least ``MIN_DOCS`` documents hold and that a
likelihood-ratio test finds over-represented in toxic documents.  Tasks count the terms and turn
the texts into the terms of their sentences; the driver fits those.  All documents are scored whole.

Defined cases: null or empty text scores the leak; without labels, or with one kind only, every
document scores the share of toxic labels (0 without any) and no sentence offends.  Null doc_ids
and null labels take no part in training; a null doc_id is scored and not held out.  An id with
several labels counts as the least of them.  Repeated rows are scored alike.  Empty table: empty
result.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thawline.llm.common import doc_texts, saved
from thawline.llm.op7_quality import held_out, training_sample

MIN_DOCS = 5
BEGINNINGS = (4, 5)
_LETTERS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_SENTENCE = re.compile(rb"[^\n.!?]*(?:[.!?](?![\s\x22')]|$)[^\n.!?]*)*[.!?\x22')]*\n?")


def words(text: bytes) -> list[bytes]:
    """Lower-case runs of ASCII letters, digits and non-ASCII bytes."""
    return text.lower().translate(_LETTERS).split()


def terms_of(text: bytes) -> set[bytes]:
    """Words, and beginnings of four and five bytes of longer words (marked by a trailing '-')."""
    w = set(words(text))
    return w | {x[:n] + b"-" for n in BEGINNINGS for x in w if len(x) > n}


def sentences(text: bytes) -> list[tuple[int, int]]:
    """Byte ranges of the text's sentences: up to a newline, or to '.', '!' or '?' before white space."""
    return [m.span() for m in _SENTENCE.finditer(text) if m.group().strip()]


@dataclass
class Bags:
    terms: dict = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -2.0
    leak: float = 0.0


def _instances(text: bytes, terms: dict) -> list[tuple[int, int, list[int]]]:
    """(start, end, terms) of the sentences that hold any term."""
    if not terms or terms.keys().isdisjoint(terms_of(text)):
        return []
    out = []
    for s, e in sentences(text):
        hit = sorted(terms[w] for w in terms_of(text[s:e]) if w in terms)
        if hit:
            out.append((s, e, hit))
    return out


def over_represented(counts: dict, n: int, n1: float, least: float) -> dict:
    """Numbers of the terms (term: documents, toxic documents) that toxic ones of ``n`` (``n1`` toxic) hold too often."""
    terms = {}
    for w, (k, bad) in sorted(counts.items()):
        if k < MIN_DOCS:
            continue
        obs = np.array([bad, k - bad, n1 - bad, n - n1 - k + bad], float)
        exp = np.array([k * n1, k * (n - n1), (n - k) * n1, (n - k) * (n - n1)], float) / n
        g = 2 * np.sum(np.where(obs > 0, obs * np.log(np.maximum(obs, 1e-9) / np.maximum(exp, 1e-9)), 0))
        if obs[0] > exp[0] and g >= least:
            terms[w] = len(terms)
    return terms


def likelihood(p: np.ndarray, rows, cols, bag, y) -> tuple[float, np.ndarray]:
    """Mean log-likelihood of the documents' labels and its gradient.

    ``p``: term weights, sentence bias, log odds of the leak; (rows, cols): terms of each sentence; ``bag``: document of each.
    """
    n_terms = len(p) - 2
    z = p[-2] + np.bincount(rows, weights=p[cols], minlength=len(bag))
    q = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    leak = 1 / (1 + np.exp(-p[-1]))
    log_not = np.bincount(bag, weights=np.log1p(-np.minimum(q, 1 - 1e-9)), minlength=len(y)) + np.log1p(-leak)
    none = np.exp(log_not)
    value = np.where(y > 0, np.log(np.maximum(1 - none, 1e-9)), log_not).mean()
    # d loglik / d log_not: toxic documents pull it down, the others up
    pull = np.where(y > 0, -none / np.maximum(1 - none, 1e-9), 1.0)
    dz = -pull[bag] * q
    return float(value), np.concatenate([np.bincount(cols, weights=dz[rows], minlength=n_terms), [dz.sum(), (-pull * leak).sum()]]) / len(y)


def fit_bags(terms: dict, bags: list[list[list[int]]], toxic: np.ndarray, steps: int = 300) -> Bags:
    """Model of documents given as their sentences' terms, and of their labels."""
    sentences_ = [hit for b in bags for hit in b]
    bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags]).astype(int)
    rows = np.repeat(np.arange(len(sentences_)), [len(h) for h in sentences_]).astype(int)
    cols = np.array([t for h in sentences_ for t in h], int)
    p = np.concatenate([np.full(len(terms), 2.0), [-1.0, np.log(0.05)]])
    mom, sq = np.zeros_like(p), np.zeros_like(p)
    y = toxic.astype(float)
    for step in range(1, steps + 1):
        _, g = likelihood(p, rows, cols, bag, y)
        g[:-2] -= 1e-4 * p[:-2]
        mom, sq = 0.9 * mom + 0.1 * g, 0.99 * sq + 0.01 * g * g
        p = p + 0.05 * (mom / (1 - 0.9**step)) / (np.sqrt(sq / (1 - 0.99**step)) + 1e-8)
    return Bags(terms, p[:-2], float(p[-2]), float(1 / (1 + np.exp(-p[-1]))))


def fit(texts: list[bytes], toxic: np.ndarray, steps: int = 300, least: float = 30.0) -> Bags:
    """Model of texts in memory, in whatever order they come."""
    order = sorted(range(len(texts)), key=lambda i: (texts[i], toxic[i]))
    texts, toxic = [texts[i] for i in order], toxic[order]
    share = float(toxic.mean()) if len(toxic) else 0.0
    if share in (0.0, 1.0):
        return Bags(leak=share)
    seen, bad = Counter(), Counter()
    for t, y in zip(texts, toxic):
        w = terms_of(t)
        seen.update(w)
        if y:
            bad.update(w)
    terms = over_represented({w: (k, bad[w]) for w, k in seen.items()}, len(texts), toxic.sum(), least)
    return fit_bags(terms, [[hit for _, _, hit in _instances(t, terms)] for t in texts], toxic, steps)


def _sample_terms(batches):
    for b in batches:
        for t, y in zip(b.column("text"), b.column("label").to_pylist()):
            w = list(terms_of(t.as_py().encode("utf-8", "surrogatepass")))
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.binary()), pa.array([y] * len(w), pa.int32())], names=["term", "label"])


def _sample_bags(terms: dict):
    def run(batches):
        for b in batches:
            hits = [[hit for _, _, hit in _instances(t.as_py().encode("utf-8", "surrogatepass"), terms)] for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("at"), b.column("label"), pa.array(hits, pa.list_(pa.list_(pa.int32())))], names=["at", "label", "hits"])

    return run


def trained(docs: DataFrame, labels: DataFrame, train_docs: int, train_bytes: int, least: float = 30.0) -> Bags:
    """Model fitted on the driver to the sentences' terms of the bounded sample."""
    sample = saved(training_sample(docs, labels, "toxic", train_docs, train_bytes).dropDuplicates(["at"]), "op8-sample")
    n, n1 = sample.agg(F.count("*"), F.sum("label")).first()
    if not n or n1 in (0, n):
        return Bags(leak=float(n1 == n) if n else 0.0)
    counts = sample.mapInArrow(_sample_terms, "term binary, label int").groupBy("term").agg(F.count("*").alias("k"), F.sum("label").alias("bad")).where(F.col("k") >= MIN_DOCS).toArrow()
    terms = over_represented({w: (k, bad) for w, k, bad in zip(*(counts[c].to_pylist() for c in ("term", "k", "bad")))}, n, float(n1), least)
    rows = sample.mapInArrow(_sample_bags(terms), "at int, label int, hits array<array<int>>").orderBy("at").toArrow()
    return fit_bags(terms, rows["hits"].to_pylist(), rows["label"].to_numpy().astype(float))


def score(m: Bags, text: bytes) -> tuple[float, list[tuple[int, int, float]]]:
    """(document score, [(start, end, probability)] of its sentences with any term)."""
    found = []
    none = 1 - m.leak
    for s, e, hit in _instances(text, m.terms):
        p = float(1 / (1 + np.exp(-(m.bias + m.weights[hit].sum()))))
        none *= 1 - p
        found.append((s, e, p))
    return 1 - none, found


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, train_docs: int = 6000, train_bytes: int = 1 << 25) -> DataFrame:
    """(doc_id, held_out, score, predicted, offending) for every document.

    ``offending``: byte ranges and probabilities of the sentences with probability 0.5 or more.
    """
    m = trained(docs, labels, train_docs, train_bytes)
    offence = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches):
        for b in batches:
            texts = b.column("text")
            out, found = np.zeros(b.num_rows), []
            for i in range(b.num_rows):
                out[i], inst = score(m, texts[i].as_py().encode("utf-8", "surrogatepass"))
                found.append([{"start": s, "end": e, "p": p} for s, e, p in inst if p >= 0.5])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out), pa.array(found, offence)], names=["doc_id", "score", "offending"])

    out = doc_texts(docs).mapInArrow(run, "doc_id bigint, score double, offending array<struct<start: int, end: int, p: double>>")
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "offending"
    )
