"""Encoding against the library (BPE) and brute force (unigram); decoding gives the text back."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.llm.cases import docs, empty
from thawline.llm import op1_sentencepiece as M

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return M.Pieces.load(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    parts = list("abcdeéñ'́  \t\n　漢字😀²._0123!?<>s/") + ["the", "ing", " ", " ", "ation"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_long_words_equal_library(vocabulary, library):
    for t in odd_texts(2000) + ["a" * 3000, "thethe" * 200, "漢字" * 100]:
        ids = [i for w in vocabulary.words(t) for i in vocabulary.fold_long(w)]
        assert ids == library.encode(t), t
        assert vocabulary.decode(ids) == t


def test_documents_equal_library(spark, vocabulary, library):
    df, rows = docs(spark)
    rows = rows + [(9000 + i, t) for i, t in enumerate(odd_texts(300, 9))]
    df, rows = docs(spark, rows)
    got = M.encode(df, vocabulary, chunk_chars=20_000).collect()
    want = [(d, len(t or ""), library.encode(t or ""), t or "") for d, t in rows]
    assert sorted(((r.doc_id, r.n_chars, np.frombuffer(bytes(r.ids), "<i4").tolist(), r.decoded) for r in got), key=str) == sorted(want, key=str)
    assert all(r.n_pieces == len(r.ids) // 4 for r in got)
    digest = {r.doc_id: r for r in M.encode(df, vocabulary, digest=True).collect() if r.doc_id is not None and r.doc_id != 5000}
    for d, _, ids, _ in want:
        if d in digest:
            assert digest[d].ids_crc32 == zlib.crc32(np.array(ids, "<i4").tobytes()) and digest[d].exact


def test_unigram_viterbi_equals_brute_force(spark):
    rng = random.Random(4)
    pieces = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(30)} - {"c"})
    v = M.Pieces([(p, i + 5, rng.uniform(-9, -1)) for i, p in enumerate(pieces)], [], 0, "unigram")
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(150)})
    score = {p: s for p, _, s in v.pieces}
    low = min(score.values()) - 10

    def best(w):
        """highest score over all segmentations"""
        if not w:
            return 0.0
        heads = [w[:n] for n in range(1, len(w) + 1)]
        return max((score.get(h, low if len(h) == 1 else -1e9)) + best(w[len(h) :]) for h in heads)

    text = {i: p for p, i, _ in v.pieces}
    got = {r.word: r.ids for r in M.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), v).collect()}
    assert set(got) == set(words)
    for w in words[:80]:
        total = sum(score[text[i]] if i else low for i in got[w])
        assert abs(total - best(w)) < 1e-9, w
        total = sum(score[text[i]] if i else low for i in v.fold_long(w))
        assert abs(total - best(w)) < 1e-9, w


def test_empty_table(spark, vocabulary):
    assert M.encode(empty(spark), vocabulary).count() == 0


def test_substrings_meet_pieces_by_number(spark, monkeypatch):
    """The lattice looks its substrings up by a 64-bit number, and texts that share one are still told apart."""
    v = M.Pieces([(p, i, -float(i)) for i, p in enumerate(["▁", "a", "b", "c", "ab", "▁ab", "bc", "▁abc"])], [], 99, "bpe")
    texts = ["▁abc", "▁bab", "xbc", "é", "cab", "abcabc"]
    words = spark.createDataFrame([(w,) for w in texts], "word string")
    plan = M.lattice(words, v.table(spark), v.longest)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"BroadcastHashJoin \[key#\d+L\], \[known_key#\d+L\], LeftOuter", plan)
    spans = lambda w: [(s, e) for s in range(len(w)) for e in range(s + 1, len(w) + 1) if e == s + 1 or w[s:e] in v.by_text]
    for key in (M._key, lambda c: F.length(c).cast("long")):
        monkeypatch.setattr(M, "_key", key)
        edges = {r.word: sorted((e.start, e.end, e.piece_id) for e in r.edges) for r in M.lattice(words, v.table(spark), v.longest).collect()}
        assert edges == {w: [(s, e, v.by_text.get(w[s:e], (None,))[0]) for s, e in spans(w)] for w in texts}
        assert {r.word: r.ids for r in M.encode_words(words, v).collect()} == {w: v.fold_long(w) for w in texts}


def test_decoding_joins_bytes(vocabulary, library):
    for ids in ([], library.encode(" a  b"), library.encode("é漢😀\n²"), vocabulary.byte_ids[195:196], vocabulary.byte_ids[195:196] + vocabulary.byte_ids[169:170]):
        want = b"".join(vocabulary.as_bytes[i] for i in ids).decode("utf-8", "replace").replace(M.SPACE, " ").removeprefix(" ")
        assert vocabulary.decode(ids) == vocabulary.decode(np.array(ids, np.int32)) == want
    for wrong in (vocabulary.unknown, -1, 10**6):
        with pytest.raises(KeyError):
            vocabulary.decode([wrong])
