"""Collocations: brute force over small texts, the DuckDB twin, the trie with spills, the slices of long texts."""

import random
import re
from collections import Counter, namedtuple

import numpy as np
import pyarrow as pa

from tests.llm.cases import docs, empty
from thawline.llm import op12_collocations as M

SF = "/root/testdata/sf0.001"


def brute(rows, least, inside, top, max_words=3):
    f = {}
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^ \t]+", piece)
            c = f.setdefault("und" if lang is None else lang, Counter())
            for m in (1, 2, 3):
                c.update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        n = sum(k for p, k in c.items() if len(p) == 1)
        cand = {p: a for p, a in c.items() if 2 <= len(p) <= max_words and a >= least}
        found = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= inside * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out, key=str)


def _texts(seed, n=140):
    rng = random.Random(seed)
    words = ["Ära", "the", "of", "New", "york", "city", "a.b", "x\x00", "ÉÉ", "\xa0z", "it's"] + [f"w{i}" for i in range(12)]
    sep = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\r\n", "!?", " ; "]
    out = []
    for _ in range(n):
        t = "".join(rng.choice(words) + rng.choice(sep) for _ in range(rng.randint(0, 60)))
        out.append(t + rng.choice(["New York city", "the w1 w2", "", "of the"]))
    return out


def _check(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, g, "x", 1, "p") for i, (g, t) in enumerate(rows)], "doc_id bigint, text string, lang string, phrase string, n int, part string")
    got = sorted((tuple(r) for r in M.collocations(df.repartition(7), **kw).collect()), key=str)
    assert got == brute(rows, kw["least"], kw["inside"], kw["top"], kw.get("max_words", 3)) and got
    return got


def test_brute_force(spark):
    langs = ["en", "en", "en", "de", None, ""]
    rows = [(langs[i % 6], t) for i, t in enumerate(_texts(1) * 2)] + [("en", None), ("fr", "nothing twice here"), (None, "")]
    _check(spark, rows, least=10, inside=50, top=2000)
    # a filter of 64 bits lets nearly everything through: the same rows
    _check(spark, rows, least=10, inside=50, top=5, filter_bits=6)
    _check(spark, rows, least=4, inside=90, top=2000, max_words=2)


def test_repeats_and_runs_of_one_word(spark):
    rows = [("en", "a " * 500)] * 3 + [("en", "b a a b " * 40), ("en", "x" * 3000 + " a a"), ("en", "\n.,\t ")]
    got = _check(spark, rows, least=10, inside=50, top=2000)
    assert any(r[2] == "a a a" for r in got)


def test_slices_end_at_borders():
    rng = random.Random(4)
    for _ in range(200):
        t = "".join(rng.choice("ab  .,\n") for _ in range(rng.randint(0, 400))).encode()
        parts = list(M.slices(t, 20))
        assert b"".join(parts) == t and all(p[-1:] in (b".", b",", b"\n") for p in parts[:-1])
        assert [w for p in parts for w in M.words_of(p) + [b"."] if w != b"."] == [w for w in M.words_of(t) if w != b"."]


def test_trie_bursts_and_spills(monkeypatch):
    monkeypatch.setattr(M, "BURST", 5)
    monkeypatch.setattr(M, "GROUP", 300)
    held = namedtuple("Held", "value")(M.BitFilter(6, np.full(1, 2**64 - 1, np.uint64)))
    texts = _texts(9, 60)
    batch = pa.RecordBatch.from_arrays([pa.array([b"en", b"de"] * 30), pa.array([t.encode() for t in texts])], names=["lang", "text"])
    for size in (2, 3):
        want = Counter()
        for i, t in enumerate(texts):
            for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), t)):
                w = re.findall("[^ \t]+", piece)
                want.update((("en", "de")[i % 2], " ".join(w[j : j + size])) for j in range(len(w) - size + 1))
        for entries, held_words in [(10**6, 10**6), (40, 10**6), (10**6, 12)]:
            got, runs = Counter(), 0
            hot = {(b"en", b"the"), (b"de", b"of the")}
            for b in M._count_phrases(size, held, held, hot, entries, held_words)(batch.slice(i, 1) for i in range(batch.num_rows)):
                rows = list(zip(*(b.column(c).to_pylist() for c in b.schema.names)))
                assert rows == sorted(rows, key=lambda r: (r[0], r[1].split(b" "), r[2])) and len({r[:3] for r in rows}) == len(rows)
                assert all(s == 0 or (g, p) in hot for g, p, s, _, _ in rows)
                runs += 1
                for g, p, _, lasts, n in rows:
                    assert lasts.split() == sorted(lasts.split())
                    got.update({(g.decode(), (p + b" " + w).decode()): k for w, k in zip(lasts.split(b" "), n, strict=True)})
            assert got == want and (runs > 5 if entries == 40 else runs >= 1)


def test_awkward_documents(spark):
    df, rows = docs(spark)
    got = sorted((tuple(r) for r in M.collocations(df, least=5, inside=50, top=300).collect()), key=str)
    assert got == brute([("en", t) for _, t in rows], 5, 50, 300)
    assert M.collocations(empty(spark)).count() == 0


def test_twin(spark):
    from tests.harness import compare, duck
    from thawline.llm import registry

    ok, msg = compare(spark, "op12_phrase_collocations", SF, registry.QUERIES, registry.SQL, duck(SF))
    assert ok, msg


def test_hot_prefixes_are_found_by_id():
    """A task looks its hot prefixes up once a run, not every phrase in the set of their names."""

    class Names(set):
        asked = 0

        def __contains__(self, x):
            Names.asked += 1
            return super().__contains__(x)

    held = namedtuple("Held", "value")(M.BitFilter(6, np.full(1, 2**64 - 1, np.uint64)))
    batch = pa.RecordBatch.from_arrays([pa.array([b"en", b"de"]), pa.array([b"the w%d the x the w%d y. " % (i, i) * 2 for i in range(2)])], names=["lang", "text"])
    for size, hot in ((2, Names([(b"en", b"the"), (b"de", b"nowhere"), (b"fr", b"the")])), (3, Names([(b"en", b"the w0"), (b"de", b"the nowhere")]))):
        rows = [r for b in M._count_phrases(size, held, held, hot)(iter([batch])) for r in b.to_pylist()]
        assert {(r["lang"], r["prefix"]) for r in rows if r["slice"]} <= {(b"en", b"the"), (b"en", b"the w0")}
        cut = [r for r in rows if (r["lang"], r["prefix"]) == ((b"en", b"the") if size == 2 else (b"en", b"the w0"))]
        seed = M.lang_seed(b"en")
        assert cut and all(r["slice"] == M.word_hash(w, seed) % M.SLICES for r in cut for w in r["lasts"].split())
    assert Names.asked == 0
