"""A chunk's words are gone before the next chunk's are read; a task of the lattice gets few words."""

import gc
import weakref

import pyarrow as pa

from thawline.llm import op1_sentencepiece as S


def test_words_of_a_chunk_are_freed(monkeypatch, tmp_path):
    pieces = [(p, i, -float(i)) for i, p in enumerate(["▁", "a", "b", "c", "ab", "▁ab"])]

    class Shared:
        value = S.Pieces(pieces, [], 99, "bpe")

    known, left = [], []
    init = S._Ids.__init__

    def counted(self, *a):
        left.append(sum(len(d) + len(d.behind) for r in known if (d := r()) is not None))
        init(self, *a)
        known.append(weakref.ref(self))

    monkeypatch.setattr(S._Ids, "__init__", counted)
    monkeypatch.setattr(S, "_chunk_id", lambda k: k)
    monkeypatch.setattr(S, "tidy_worker", lambda: None)
    rows = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "text": ["ab c", "a b", "c ab", "b"]})
    gc.collect()
    gc.disable()
    try:
        out = [r for b in S._encode_texts(Shared, str(tmp_path), 3, False)([rows]) for r in b.to_pylist()]
    finally:
        gc.enable()
    assert [r["decoded"] for r in out] == ["ab c", "a b", "c ab", "b"]
    assert len(left) > 2 and max(left) == 0


def test_words_are_dealt_finely(spark, monkeypatch):
    """A task keeps all edges of its words for sorting: in the pipeline they go to more tasks than the session's number."""
    import corpus_pipeline

    vocabulary = S.Pieces([(p, i, -float(i)) for i, p in enumerate(["▁", "a", "b", "c", "ab", "▁ab"])], [], 99, "bpe")
    dealt, real = [], S.encode_words
    monkeypatch.setattr(S, "encode_words", lambda words, v: dealt.append(words.rdd.getNumPartitions()) or real(words, v))
    monkeypatch.setattr(S.Pieces, "load", lambda path: vocabulary)
    rows = [(1, "ab c"), (2, None), (None, "a bab"), (4, "c" * 70 + " ab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for out in (S.encode(docs, vocabulary), corpus_pipeline.pieces(spark, docs, "")):
        got = {r.doc_id: (list(memoryview(bytes(r.ids)).cast("i")), r.decoded) for r in out.collect()}
        assert got == {1: ([5, 0, 3], "ab c"), 2: ([], ""), None: ([0, 1, 0, 2, 4], "a bab"), 4: ([0] + [3] * 70 + [5], "c" * 70 + " ab")}
    assert dealt == [width, 4 * width]
