"""Benchmark items against brute-force semi-global alignment."""

import random

from tests.llm.cases import docs, empty, prose
from thawline.llm import op9_decontam as D


def least_edits(pattern, text):
    """edits of the best region of ``text`` (full dynamic programming)"""
    prev = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        cur = [i]
        for j, c in enumerate(text, 1):
            cur.append(min(prev[j - 1] + (p != c), prev[j] + 1, cur[j - 1] + 1))
        prev = cur
    return min(prev)


def edited(rng, text, n):
    y = list(text)
    for _ in range(n):
        p, r = rng.randrange(1, len(y) - 1), rng.random()
        if r < 0.33:
            y[p] = rng.choice("xqz")
        elif r < 0.66:
            del y[p]
        else:
            y.insert(p, rng.choice("qj"))
    return "".join(y)


def cases():
    rng = random.Random(8)
    items = [(i, prose(rng, rng.randint(12, 50))) for i in range(14)]
    rows = []
    for i, t in items:
        e = D.edit_budget(len(D.normalised(t)), 12, 16)
        for k in (0, e // 2, e, e + 1, e + 4):
            rows.append((len(rows), prose(rng, 15) + ". " + edited(rng, t, k).upper() + "! " + prose(rng, 9)))
        rows.append((len(rows), t[: len(t) // 2]))
        rows.append((len(rows), t.replace(" ", " ,\n")))
    rows += [(1000, ""), (1001, None), (1002, "short"), (None, items[0][1]), (1003, items[1][1]), (1003, items[1][1]), (1004, items[2][1] * 3 + " " + items[3][1])]
    items += [(50, None), (51, ""), (52, "tiny"), (None, "an item without an id but with a long enough text"), (53, items[0][1]), (54, "Short!")]
    return items, rows


def test_equals_brute_force(spark):
    items, rows = cases()
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, doc_id int")
    df, _ = docs(spark, rows)
    want = []
    for d, t in rows:
        for i, x in items:
            p = D.normalised(x or "")
            if i is None or not p:
                continue
            if len(p) < 12:
                if f" {p} " in f" {D.normalised(t or '')} ":
                    want.append((d, i, 0))
                continue
            k = least_edits(p, D.normalised(t or ""))
            if k <= D.edit_budget(len(p), 12, 16):
                want.append((d, i, k))
    for block_chars in (4_000_000, 300):
        got = D.contaminated(df, bench, block_chars=block_chars).collect()
        assert sorted({(r.doc_id, r.item_id) for r in got}, key=str) == sorted({w[:2] for w in want}, key=str)
        assert len(got) == len(want)
        edits = {w[:2]: w[2] for w in want}
        assert all(edits[r.doc_id, r.item_id] <= r.edits <= D.edit_budget(10_000, 12, 16) for r in got)
    kept = D.without_leaks(df, bench, block_chars=300)
    assert kept.columns == df.columns
    bad = [(d, t) for d, t in rows if any(w[0] == d for w in want)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted((x for x in rows if x not in bad), key=str)


def test_empty_tables(spark):
    items, rows = cases()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df, _ = docs(spark, rows)
    assert D.contaminated(empty(spark), bench).count() == 0 and D.contaminated(df, bench.where("false")).count() == 0
    assert D.without_leaks(df, bench.where("false")).count() == len(rows) and D.without_leaks(empty(spark), bench).count() == 0


def test_short_items(spark):
    question = "\u4f60\u597d\u4e16\u754c\u5417\uff1f"  # five characters and a mark, no spaces around
    items = [(1, question), (2, "Tiny one"), (3, "x"), (4, "!?"), (5, "\u4e16"), (2, "other")]
    rows = [(1, "\u8bf7\u95ee" + question + "\u662f"), (2, "a tiny, ONE."), (3, "a tiny ones untiny one"), (4, "X"), (5, "xx ax xa"), (6, ""), (None, "x"), (7, "other tiny one"), (7, "other tiny one")]
    got = D.contaminated(docs(spark, rows)[0], spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted(((r.doc_id, r.item_id, r.edits, r.start) for r in got), key=str) == sorted([(1, 1, 0, 2), (1, 5, 0, 4), (2, 2, 0, 2), (4, 3, 0, 0), (None, 3, 0, 0), (7, 2, 0, 0), (7, 2, 0, 0)], key=str)
    block = D.Block([(i, "w%d" % i) for i in range(200)], 12, 16)  # many short items: every place is looked up
    assert {(item, s) for _, item, _, s, _ in block.find(["w7 aw8 w19 w7 w199x"])} == {(7, 0), (19, 7)}


def test_item_with_texts_in_several_blocks(spark):
    rng = random.Random(3)
    a, b = prose(rng, 40), prose(rng, 40)
    rows = [(1, "x " + a + " y " + edited(rng, b, 2)), (1, "x " + a + " y " + b), (2, edited(rng, b, 3)), (3, a), (3, a)]
    bench = spark.createDataFrame([(9, a), (9, b), (8, b)], "item_id bigint, text string")
    want = None
    for block_chars in (4_000_000, 10):
        got = sorted(tuple(r) for r in D.contaminated(docs(spark, rows)[0], bench, block_chars=block_chars).collect())
        assert want in (None, got)
        want = got
    assert [r[:2] for r in want] == [(1, 8), (1, 8), (1, 9), (1, 9), (2, 8), (2, 9), (3, 9), (3, 9)]
