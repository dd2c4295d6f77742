"""Quality and toxicity: held-out accuracy on the given tables, chain arithmetic, awkward rows."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import docs, empty
from thawline.llm import op7_quality as Q
from thawline.llm import op8_toxicity as X

SF = "/root/testdata/sf0.1"


def held_out_rows(spark, scores, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    rows = scores.where("held_out").join(labels, "doc_id").select("score", "predicted", label).collect()
    y, s = np.array([r[label] for r in rows]), np.array([r.score for r in rows])
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    auc = (rank[y == 1].mean() - ((y == 1).sum() - 1) / 2) / (y == 0).sum()
    return auc, np.mean(np.array([r.predicted for r in rows]) == y), len(rows)


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_on_held_out(spark):
    auc, accuracy, n = held_out_rows(spark, Q.quality_scores(*tables(spark)), "quality")
    assert n > 300 and auc > 0.95 and accuracy > 0.95


def test_toxicity_on_held_out(spark):
    auc, accuracy, n = held_out_rows(spark, X.toxicity_scores(*tables(spark)), "toxic")
    assert n > 300 and auc > 0.95 and accuracy > 0.95


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(5)
    doc = np.array([0] * 4 + [1] + [2] * 6)
    e, trans = rng.standard_normal(len(doc)) * 2, rng.standard_normal((2, 2))
    bad, pairs = Q.marginals(e, doc, trans)
    want, want_pairs = np.zeros(len(doc)), np.zeros((2, 2))
    for d in range(3):
        at = np.flatnonzero(doc == d)
        paths = list(itertools.product([0, 1], repeat=len(at)))
        w = np.array([np.exp(sum(e[i] * y for i, y in zip(at, p)) + sum(trans[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        w /= w.sum()
        for p, x in zip(paths, w):
            want[at] += x * np.array(p)
            for a, b in zip(p, p[1:]):
                want_pairs[a, b] += x
    assert np.allclose(bad, want) and np.allclose(pairs, want_pairs)


def test_line_features_wrap_and_repeat():
    doc, size, bins = Q.line_features([b"abc def\n\nX", b"", b"q" * 600, b"\n\n"])
    assert doc.tolist() == [0, 0, 2, 2, 2] and size.tolist() == [7, 1, 256, 256, 88]
    again = bins[:, 9] - 9 * Q.BINS
    assert Q.line_features([b"Und Und Und Und"])[2][0, 9] - 9 * Q.BINS > again[0] == 0


@pytest.mark.parametrize("scores,label,empty_score", [(Q.quality_scores, "quality", None), (X.toxicity_scores, "toxic", None)])
def test_awkward_rows(spark, scores, label, empty_score):
    df, rows = docs(spark)
    labels = spark.createDataFrame([(d, i % 2, i % 2) for i, (d, _) in enumerate(rows)] + [(rows[0][0], 1, 1), (None, 1, 1), (1, None, None)], "doc_id bigint, quality int, toxic int")
    got = scores(df, labels).collect()
    assert sorted((str(r.doc_id) for r in got)) == sorted(str(d) for d, _ in rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert len({r.score for r in got if r.doc_id == 5000}) <= 2
    # one kind of label, no label, no document
    ones = labels.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert {r.score for r in scores(df, ones).collect()} == {1.0 if label == "quality" else 0.0}
    none = labels.where("false")
    assert {r.score for r in scores(df, none).collect()} == {0.5 if label == "quality" else 0.0}
    assert scores(empty(spark), labels).count() == 0


def test_keep_good_keeps_columns(spark):
    df, rows = docs(spark)
    labels = spark.createDataFrame([(d, 1) for d, _ in rows if d is not None], "doc_id bigint, quality int")
    kept = Q.keep_good(df, labels)
    assert kept.columns == df.columns and kept.count() == len(rows)
    assert Q.keep_good(empty(spark), labels).count() == 0


def test_offending_sentences():
    rng = np.random.default_rng(2)
    words = [f"word{i}" for i in range(200)]
    texts, toxic = [], []
    for i in range(600):
        s = [" ".join(rng.choice(words, 8)) for _ in range(6)]
        if i % 4 == 0:
            s[int(rng.integers(6))] += " vilething now"
        texts.append((". ".join(s) + ".").encode())
        toxic.append(i % 4 == 0)
    m = X.fit(texts, np.array(toxic, float))
    score, found = X.score(m, b"All is well here. You vilething there! Good day.")
    bad = [(s, e) for s, e, p in found if p >= 0.5]
    assert score > 0.5 and len(bad) == 1 and b"vilething" in b"All is well here. You vilething there! Good day."[bad[0][0] : bad[0][1]]
    assert X.score(m, b"All is well here.")[0] < 0.5 and X.score(m, b"") == (m.leak + 0.0, []) or m.leak < 0.5


def test_documents_with_one_header_all_train():
    """The same 20 first words in every text, and the rows in any order."""
    rng = np.random.default_rng(3)
    words = [f"word{i}" for i in range(200)]
    header = " ".join(f"head{i}" for i in range(25)) + ". "
    texts = [(header + " ".join(rng.choice(words, 30)) + (" vilething now." if i % 3 == 0 else ".")).encode() for i in range(300)]
    toxic = np.arange(300) % 3 == 0
    m = X.fit(texts, toxic.astype(float))
    assert X.score(m, (header + "a vilething here.").encode())[0] > 0.5 > X.score(m, (header + "all is well.").encode())[0]
    order = rng.permutation(300)
    again = X.fit([texts[i] for i in order], toxic[order].astype(float))
    assert list(again.terms.items()) == list(m.terms.items()) and again.leak == m.leak and (again.weights == m.weights).all()


def test_sentences_cover_the_text():
    t = 'Hello there. This is v2.0 ok! "Right?" yes\nnew line... and\n\n x'.encode()
    got = X.sentences(t)
    assert b"".join(t[s:e] for s, e in got).replace(b" ", b"").replace(b"\n", b"") == t.replace(b" ", b"").replace(b"\n", b"")
    assert len(got) >= 5


def test_noisy_or_by_hand():
    m = X.Bags({b"vile": 0, b"wors-": 1}, np.array([3.0, 1.5]), -2.0, 0.1)
    text = "A vile, VILE thing. Nothing here! It gets worse? vile worst"
    none = 0.9
    for sentence in ("a vile vile thing", "nothing here", "it gets worse", "vile worst"):
        z = -2.0 + 3.0 * ("vile" in sentence.split()) + 1.5 * any(w.startswith("wors") and len(w) > 4 for w in sentence.split())
        none *= 1 if z == -2.0 else 1 - 1 / (1 + np.exp(-z))  # sentences without a term are no evidence
    assert abs(X.score(m, text.encode())[0] - (1 - none)) < 1e-12


def test_gradient_equals_differences():
    rng = np.random.default_rng(4)
    bag = np.array([0, 0, 1, 3, 3, 3])
    rows, cols = np.array([0, 0, 1, 2, 3, 4, 5, 5]), np.array([0, 1, 2, 0, 1, 1, 2, 0])
    y = np.array([1.0, 0, 0, 1, 1])  # the last document has no sentence: only the leak explains it
    p = rng.standard_normal(5)
    value, g = X.likelihood(p, rows, cols, bag, y)
    q = [1 / (1 + np.exp(-(p[3] + sum(p[c] for r, c in zip(rows, cols) if r == s)))) for s in range(6)]
    leak = 1 / (1 + np.exp(-p[4]))
    none = [(1 - leak) * np.prod([1 - q[s] for s in range(6) if bag[s] == d]) for d in range(5)]
    assert abs(value - np.mean([np.log(1 - x) if t else np.log(x) for x, t in zip(none, y)])) < 1e-9
    for i in range(5):
        step = np.eye(5)[i] * 1e-6
        assert abs((X.likelihood(p + step, rows, cols, bag, y)[0] - X.likelihood(p - step, rows, cols, bag, y)[0]) / 2e-6 - g[i]) < 1e-6


def test_long_training_texts_are_read_whole(spark):
    """What tells the classes apart stands behind 60,000 characters."""
    rng = np.random.default_rng(6)
    words = [f"word{i}" for i in range(300)]
    train = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5][:60]
    rows = [(d, " ".join(rng.choice(words, 9000)) + ". " + ("one vilething here." if i % 2 else "all is well.")) for i, d in enumerate(train)]
    df = spark.createDataFrame(rows + rows[:5], "doc_id bigint, text string")
    labels = spark.createDataFrame([(d, 0, i % 2) for i, d in enumerate(train)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r.predicted for r in X.toxicity_scores(df, labels).collect()}
    assert got == {d: i % 2 for i, d in enumerate(train)}
    junk = "|*|*|*|*|*|*|*|*|*|*|*|*|\n" * 900
    rows = [(d, (rows[i][1] + "\n") + (junk * 4 if i % 2 else "")) for i, d in enumerate(train)]
    labels = labels.select("doc_id", (1 - F.col("toxic")).alias("quality"))
    got = {r.doc_id: r.predicted for r in Q.quality_scores(spark.createDataFrame(rows, "doc_id bigint, text string"), labels).collect()}
    assert got == {d: 1 - i % 2 for i, d in enumerate(train)}


def test_sample_bounds(spark):
    df = spark.createDataFrame([(i, "x" * (i % 50 + 1)) for i in range(400)] * 2, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id bigint, quality int")
    rows = Q.training_sample(df, labels, "quality", 100, 10**9).dropDuplicates(["at"]).collect()
    assert len(rows) == 100 and sorted(r["at"] for r in rows) == list(range(100))
    few = Q.training_sample(df, labels, "quality", 100, 300).dropDuplicates(["at"]).collect()
    assert 0 < sum(len(r.text) for r in few) <= 300
