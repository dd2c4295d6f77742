"""Token-id shards: round trip with the tokenizer, keyed access, the perfect hash."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.cases import docs, empty
from tests.llm.test_sentencepiece import odd_texts
from thawline.llm import op6_token_ids as M

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 20_000))
    index = M.PerfectHash.build(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    assert M.PerfectHash.build(keys[:1]).slots(keys[:1]).tolist() == [0]


def test_shard_lookup():
    ids = np.array([-5, 3, 3, 10, M.NULL_KEY])
    ids.sort()
    lens = [2, 0, 3, 1, 4]
    payload = np.arange(10, dtype="<u2").tobytes()
    shard = M.Shard(M.pack(ids, np.concatenate([[0], np.cumsum(lens)]), payload, 2))
    assert [x.tolist() for x in shard.get(3)] == [[2, 3, 4], [5]] and [x.tolist() for x in shard.get(None)] == [[0, 1]]
    assert [x.tolist() for x in shard.get(10)] == [[6, 7, 8, 9]] and shard.get(4) == []
    strange = np.arange(1000, 4000)
    assert (shard.rows_of(strange)[1] > 0).sum() == 0


def test_pieces_equal_whole_text():
    tokenizer, enc = Tokenizer.from_file(PATH), M.Encoder(PATH)
    texts = odd_texts(1500) + ["<|endoftext|> a<|endoftext|>b", "don't we'LL İstanbul ΑΣ ẞ", "á b́ ́c"]
    for t in texts:
        assert np.frombuffer(enc.encode(t.encode()), "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_documents_round_trip(spark):
    df, rows = docs(spark)
    tokenizer = Tokenizer.from_file(PATH)
    manifest = M.write_shards(df, PATH, 2, shard_tokens=3000, shard_chars=20_000)
    assert manifest.count() > 3
    got = sorted((tuple(r) for r in M.read_digests(manifest).collect()), key=lambda r: r[1])
    assert [g[0] if g[0] is not None else M.NULL_KEY for g in got] == sorted(d if d is not None else M.NULL_KEY for d, _ in rows)
    start, want = 0, []
    for d, s, n, crc in got:
        assert s == start
        start += n
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(((d, n, c) for d, _, n, c in got), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert M.read_digests(M.write_shards(empty(spark), PATH)).count() == 0
