"""Repeated windows against a brute-force count of all windows."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.cases import docs, empty
from thawline.llm import op4_suffix as S


def covered(tokens, threshold, counts):
    flag = np.zeros(len(tokens), bool)
    for p in range(len(tokens) - threshold + 1):
        if counts[tuple(tokens[p : p + threshold])] > 1:
            flag[p : p + threshold] = True
    return flag


def count_windows(all_tokens, threshold):
    return Counter(tuple(t[p : p + threshold]) for t in all_tokens for p in range(len(t) - threshold + 1))


@pytest.mark.parametrize("threshold,gram,step", [(40, 8, 8), (100, 32, 32)])
def test_bytes_equal_brute_force(spark, threshold, gram, step):
    df, rows = docs(spark)
    tokens = [list((t or "").encode()) for _, t in rows]
    counts = count_windows(tokens, threshold)
    want = []
    for (d, _), x in zip(rows, tokens):
        f = covered(x, threshold, counts)
        kept = bytes(b for b, gone in zip(x, f) if not gone)
        want.append((d, len(x), int(f.sum()), int((f & ~np.concatenate([[False], f[:-1]])).sum()) if len(f) else 0, hashlib.sha256(kept).hexdigest()))
    got = S.removed_bytes(df, threshold, gram, step).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_words_equal_brute_force(spark):
    df, rows = docs(spark)
    tokens = [(t or "").encode().split() for _, t in rows]
    counts = count_windows(tokens, 20)
    out = S.without_repeats(df, 20, 4, 4)
    assert out.columns == df.columns
    want = sorted(((d, [w.decode() for w, gone in zip(x, covered(x, 20, counts)) if not gone]) for (d, _), x in zip(rows, tokens)), key=str)
    got = sorted(((r.doc_id, [w.decode() for w in (r.text or "").encode().split()]) for r in out.collect()), key=str)
    assert got == want
    same = {(d, t) for (d, t), x in zip(rows, tokens) if not covered(x, 20, counts).any()}
    assert same <= {(r.doc_id, r.text) for r in out.collect()}  # untouched texts stay byte for byte, nulls too
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in out.collect())


def test_long_text_is_cut_into_chunks(monkeypatch):
    """Runs found chunk by chunk cover the same suffixes with the same anchors."""
    x = np.random.default_rng(3).integers(97, 100, 5000).astype(np.uint8)
    whole = [(p, int(a)) for p0, p1, a, _ in S.runs(x, np.array([3000, 2000]), 50, 8) for s, e, a in zip(p0, p1, a) for p in range(s, e + 1)]
    monkeypatch.setattr(S, "_CHUNK", 700)
    cut = [(p, int(a)) for p0, p1, a, _ in S.runs(x, np.array([3000, 2000]), 50, 8) for s, e, a in zip(p0, p1, a) for p in range(s, e + 1)]
    assert whole == cut and len(whole) == 5000 - 2 * 49


def test_empty_table(spark):
    assert S.removed_bytes(empty(spark)).count() == 0 and S.without_repeats(empty(spark)).count() == 0


def test_workers_hold_few_rows(monkeypatch):
    """However many runs a batch holds, blocks and suffixes leave the worker in small batches: the same as at once."""
    import pyarrow as pa

    runs = [[{"p0": p, "n": 90, "off": 40} for p in range(0, 900, 30)] for _ in range(40)]
    rows = {"rid": list(range(40)), "rk": [-i for i in range(40)], "text": ["".join(chr(97 + (i * k) % 23) for k in range(1200)) for i in range(40)]}
    fields = pa.list_(pa.struct([("p0", pa.int32()), ("n", pa.int32()), ("off", pa.int32())]))
    open_ = pa.RecordBatch.from_arrays([*map(pa.array, rows.values()), pa.array(runs, fields)], names=[*rows, "runs"])
    two = pa.list_(pa.struct([("p0", pa.int32()), ("n", pa.int32())]))
    open2 = pa.RecordBatch.from_arrays([*map(pa.array, rows.values()), pa.array([[{"p0": r["p0"], "n": r["n"]} for r in x] for x in runs], two)], names=[*rows, "runs"])
    for make, batch in ((S._blocks("bytes", 100, 32), open_), (S._suffixes("bytes", 100), open2)):
        monkeypatch.setattr(S, "_ROWS", 1 << 30, raising=False)
        whole = pa.Table.from_batches(make(iter([batch])))
        monkeypatch.setattr(S, "_ROWS", 800, raising=False)
        parts = list(make(iter([batch])))
        assert pa.Table.from_batches(parts).combine_chunks().equals(whole.combine_chunks())
        assert whole.num_rows > 4000 and max(b.num_rows for b in parts) <= 1600


def test_text_that_repeats_itself_meets_once(spark, monkeypatch):
    """Equal runs of a chunk go on as one row, also within a document; every window of theirs is still found."""
    rng = np.random.default_rng(8)
    word = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 10**9, n))
    copy = word(300)
    rows = [(i, f"{word(30)} " + "ab cd " * 300 + word(30)) for i in range(20)] + [(i, copy) for i in range(30, 60)] + [(70, word(200)), (71, "ab cd " * 12), (72, copy[40:])]
    df, rows = docs(spark, rows)
    met, real = {}, S.saved

    def counted(frame, name):
        out = real(frame, name)
        met[name] = out.count()
        return out

    monkeypatch.setattr(S, "saved", counted)
    tokens = [t.split() for _, t in rows]
    counts = count_windows(tokens, 20)
    got = {r.doc_id: r.text.split() for r in S.without_repeats(df.coalesce(2), 20, 4, 4).collect()}
    assert got == {i: [w for w, gone in zip(x, covered(x, 20, counts)) if not gone] for (i, _), x in zip(rows, tokens)}
    assert met["op4-pass1"] < 400  # 6,833 when every run went on


def test_first_of_each():
    key, digest = np.array([5, 1, 5, 1, 5, 2]), np.array([7, 7, 7, 8, 7, 8])
    one, again = S._first_of_each(key, digest)
    assert one.tolist() == [0, 1, 3, 5] and again.tolist() == [0, 2, 4]
    one, again = S._first_of_each(key[:1], digest[:1])
    assert one.tolist() == [0] and again.tolist() == []
