"""Small tables with the awkward rows every operator must take."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, word string, n_spans int, component_id bigint, kept string, gone_id int, cid int"


def prose(rng, n, words=None):
    syl = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    return " ".join(rng.choice(words) if words and rng.random() < 0.4 else "".join(rng.choice(syl) for _ in range(rng.randint(1, 3))) for _ in range(n))


def texts(seed=5):
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(30, 260)) for _ in range(40)]
    out = list(base)
    for b in base[:12]:  # near copies
        w = b.split()
        for _ in range(3):
            v = list(w)
            for _ in range(rng.randint(0, 3)):
                v[rng.randrange(len(v))] = prose(rng, 1)
            out.append(" ".join(v))
    out += [base[3]] * 4 + [base[20]]
    passage = prose(rng, 120)
    out += [prose(rng, 40) + " " + passage + " " + prose(rng, 30) for _ in range(5)] + [passage, passage + " x"]
    out += ["aaaa" * 300, "ab " * 500, "ab " * 500 + "c", "Und " * 400]
    out += ["", None, " ", "\n\t ", "one", "ONE", "one two", "One  two", "x" * 5000, "é" * 450 + " z", "é" * 450 + " y"]
    out += [prose(rng, 6000)]
    return out


def docs(spark, rows=None, extra=True):
    """A documents table; extra columns clash with operators' own names."""
    rows = rows if rows is not None else [(i * 7 % 1000 + i, t) for i, t in enumerate(texts())] + [(None, "one two three four five six"), (None, None), (5000, "same row again and again"), (5000, "same row again and again"), (5000, "another text of the id")]
    data = [(i, t, "en", "s", None if t is None else len(t), "w", 1, 2, "k", 3, 4) for i, t in rows]
    return spark.createDataFrame(data, SCHEMA), rows


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
