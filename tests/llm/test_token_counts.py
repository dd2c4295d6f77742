"""Token counts: equal to the library on whole texts, for every kind of tokenizer; table and summary by brute force."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.cases import docs, empty
from tests.llm.test_sentencepiece import odd_texts
from thawline.llm import op11_token_counts as M

WORD = public_tokenizers.path("word_bpe_49k.json")


def _library(path):
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda t: len(sp.encode(t))
    tok = Tokenizer.from_file(path)
    return lambda t: len(tok.encode(t, add_special_tokens=False).ids)


@pytest.mark.parametrize("name,mode", [("word_bpe_49k.json", "drop"), ("byte_bpe_50k.json", "keep"), ("piece_bpe_32k.model", "whole")])
def test_counts_equal_library(name, mode):
    path = public_tokenizers.path(name)
    tokens, one = M.Tokens(path), _library(path)
    assert tokens.mode == mode
    texts = odd_texts(600) + ["", " ", "<|endoftext|> a<|endoftext|>b", "don't we'LL İstanbul ΑΣ ẞ", "a\x00 a b\x00\x00", "x" * 3000, "  lead", "trail \n "]
    data = [t.encode() for t in texts]
    none = M.LengthTable(*(np.zeros(0, np.uint64),) * 2, np.zeros(0, np.int64))
    want = [one(t) for t in texts]
    assert M.count_tokens(data, tokens, none).tolist() == want
    # the same through a table that holds every second short piece
    _, x, sizes = M._bytes_of(data)
    start, end, _ = M.spans(x[: int(sizes.sum()) + len(data)], sizes, mode)
    short = end - start <= M.SHORT
    low, high = M.packed(x, start[short][::2], (end - start)[short][::2])
    keep = np.unique(np.stack([low, high], 1), axis=0)
    low, high = keep[:, 0].copy(), keep[:, 1].copy()
    table = M.LengthTable(low, high, np.array(tokens.fresh(M.unpacked(low, high)), np.int64))
    assert M.count_tokens(data, M.Tokens(path), table).tolist() == want


def test_table_tells_pieces_apart():
    pieces = [b"a", b"a\x00", b"\x00a", b"abcdefgh", b"abcdefghi", b"abcdefghijklmno"] + [b"%d" % i for i in range(5000)]
    x = np.frombuffer(b"".join(pieces) + b" " * 16, np.uint8)
    size = np.array([len(p) for p in pieces])
    low, high = M.packed(x, np.cumsum(size) - size, size)
    assert M.unpacked(low, high) == pieces
    table = M.LengthTable(low[::2], high[::2], np.arange(len(low[::2])) % 300)
    want = np.full(len(low), -1)
    want[::2] = np.where(np.arange(len(low[::2])) % 300 < 255, np.arange(len(low[::2])) % 300, -1)
    assert table.find(low, high).tolist() == want.tolist()


def test_summary_keeps_frequent_pieces():
    rng = np.random.default_rng(3)
    stream = rng.zipf(1.3, 60_000) % 5000
    whole, parts = Counter(stream.tolist()), []
    for part in np.array_split(stream, 7):
        s = M.Summary(100)
        for chunk in np.array_split(part, 40):
            v, n = np.unique(chunk, return_counts=True)
            s.add(v.astype(np.uint64), v.astype(np.uint64), n)
        parts.append(s.fold(100))
    top = M.Summary(100)
    for p in parts:
        top.add(*p)
    low, _, n = top.fold(100)
    assert len(low) <= 100 and {v for v, c in whole.items() if c > len(stream) / 50} <= set(low.tolist())


def test_documents(spark):
    df, rows = docs(spark)
    one = _library(WORD)
    got = M.token_counts(df.repartition(9), WORD, limit=500, slots=64).collect()
    want = [(d, len((t or "").encode()), one(t or ""), one(t or "") > 500) for d, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert any(r.over_limit for r in got) and M.token_counts(empty(spark), WORD).count() == 0
