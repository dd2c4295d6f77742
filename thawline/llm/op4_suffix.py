"""Suffix-array dedup: which windows of ``threshold`` tokens occur more than once, exactly.

The suffixes are ordered only through their first ``threshold`` tokens, by passes from the most
significant digit on; a group of one leaves after every pass, and the groups that are equal
after the last digit are the repeated windows.  Four choices keep the passes small:

* The first digit of a suffix is its *anchor*: the gram with the smallest hash among the
  ``threshold`` tokens (leftmost on ties) and its offset.  Equal windows have equal anchors, and
  neighbouring suffixes mostly share one, so a maximal run of suffixes with one anchor is one
  record, about one for every ``threshold / 2`` tokens.
* Runs of one text in one chunk of documents (copies, text that repeats itself) are known to be
  repeated where they are found: one of them goes on, and their ranges, neighbours joined, are
  kept aside.  So a group has a row for every chunk and text, however often the text comes.
* Pass 1 groups runs by their anchor gram.  Where all runs of a group have one text (all
  suffixes of the run through the threshold), they are equal without looking further.
* Pass 2 deals runs that differ out as blocks of suffixes with a common offset grid: first
  digit the tokens that all suffixes of the block share, second the block's whole text.  Pass 3
  orders the single suffixes of blocks that still differ by all ``threshold`` tokens.

Each pass is a count per digit (with partial aggregation) and a join back; no group is collected.
A text present n times sends one representative to the next pass.

Units: ``bytes`` (UTF-8) or ``words`` (runs without ASCII white space).  Null text is empty; a
document shorter than the threshold has no window.  Repeated rows, also of one doc_id or of a
null doc_id, are documents of their own, so their windows repeat.  Empty table: empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thawline.llm.common import U64, WORD_HASHES, mix, saved, small_batches

_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_CHUNK = 1 << 20
_ROWS = 1 << 15
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def tokens(text: str, unit: str) -> np.ndarray:
    data = text.encode("utf-8", "surrogatepass")
    if unit == "bytes":
        return np.frombuffer(data, np.uint8)
    return WORD_HASHES.of(data.split())


def _gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` tokens (a power of two) that start at each position."""
    h = _BYTE[x] if x.dtype == np.uint8 else mix(x)
    width, mult = 1, _BASE
    while width < gram:
        h = h[:-width] * U64(mult) + h[width:]
        width, mult = width * 2, mult * mult % (1 << 64)
    return mix(h)


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    m, width = v, 1
    while width * 2 <= w:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    return np.minimum(m[: len(v) - w + 1], m[w - width : w - width + len(v) - w + 1])


def runs(x: np.ndarray, lengths: np.ndarray, threshold: int, gram: int):
    """Runs of suffixes with one anchor in the documents concatenated in ``x``.

    Yields arrays (first suffix, last suffix, anchor, anchor gram's hash), positions in ``x``.
    """
    ends = np.repeat(np.cumsum(lengths), lengths)
    n = len(x) - threshold + 1
    for at in range(0, max(n, 0), _CHUNK):
        to = min(at + _CHUNK, n)
        h = _gram_hashes(x[at : to - 1 + threshold], gram)
        place = np.arange(len(h), dtype=np.uint64)
        low = U64((1 << int(len(h)).bit_length()) - 1)
        best = _sliding_min((h & ~low) | place, threshold - gram + 1)
        anchor = (best & low).astype(np.int64)
        whole = ends[at:to] - np.arange(at, to) >= threshold
        first = whole.copy()
        first[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1])
        last = whole.copy()
        last[:-1] &= ~whole[1:] | (anchor[1:] != anchor[:-1])
        p0, p1 = np.flatnonzero(first), np.flatnonzero(last)
        a = anchor[p0]
        yield p0 + at, p1 + at, a + at, h[a].view(np.int64)


def _digests(size: int, parts) -> np.ndarray:
    """Digests of ``size`` bytes of the parts, a row each, as signed 64-bit integers."""
    joined = b"".join([hashlib.blake2b(x, digest_size=size).digest() for x in parts])
    return np.frombuffer(joined, "<i8").reshape(-1, size // 8)


def _open_rows(batch: pa.RecordBatch, unit: str):
    """(rid, rk, tokens, the array of its runs' fields) of one document at a time: a batch's runs are never Python objects at once."""
    column = batch.column("runs")
    ends, fields = column.offsets.to_numpy(), column.values
    fields = [fields.field(i).to_numpy(zero_copy_only=False) for i in range(fields.type.num_fields)]
    text = batch.column("text")
    for i, (rid, rk) in enumerate(zip(batch.column("rid").to_pylist(), batch.column("rk").to_pylist())):
        yield rid, rk, tokens(text[i].as_py(), unit), [f[ends[i] : ends[i + 1]] for f in fields]


_ITEMS = pa.schema([(c, pa.int64()) for c in ("rid", "rk", "c1", "c2", "digest")] + [("p0", pa.int32()), ("n", pa.int32())])


_RUN = "rid bigint, rk bigint, digest bigint, key bigint, p0 int, n int, off int"
_RUN_NAMES = [c.split()[0] for c in _RUN.split(", ")]


def _runs(unit: str, threshold: int, gram: int):
    def run(batches):
        for b in batches:
            rid, rk = b.column("rid").to_numpy(zero_copy_only=False), b.column("rk").to_numpy(zero_copy_only=False)
            group, size = [], 0
            texts = b.column("text")
            for i in range(b.num_rows):
                group.append(tokens(texts[i].as_py(), unit))
                size += len(group[-1])
                if size >= _CHUNK or i == b.num_rows - 1:
                    at = slice(i + 1 - len(group), i + 1)
                    yield from _run_rows(group, rid[at], rk[at], threshold, gram)
                    group, size = [], 0

    return run


def _run_rows(group, rid, rk, threshold, gram):
    """The runs of some documents, one for each text; where a text comes again, all its runs as ranges without a key."""
    lengths = np.array([len(x) for x in group])
    x = np.concatenate(group)
    starts = np.cumsum(lengths) - lengths
    for p0, p1, a, key in runs(x, lengths, threshold, gram):
        if not len(p0):
            continue
        doc = np.searchsorted(starts, p0, "right") - 1
        for lo in range(0, len(p0), _ROWS):
            at = slice(lo, lo + _ROWS)
            f, l, d, k = p0[at], p1[at], doc[at], key[at]  # noqa: E741
            digest = _digests(8, (x[i : j + threshold].tobytes() for i, j in zip(f.tolist(), l.tolist())))[:, 0]
            one, again = _first_of_each(k, digest)
            columns = [rid[d], rk[d], digest, k, (f - starts[d]).astype(np.int32), (l - f + 1).astype(np.int32), (a[at] - f).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c[one]) for c in columns], names=_RUN_NAMES)
            if len(again):
                # neighbours in a document are one range
                s, e, of = f[again], l[again] + 1, d[again]
                joins = (s[1:] == e[:-1]) & (of[1:] == of[:-1])
                s, e, of = s[np.concatenate([[True], ~joins])], e[np.concatenate([~joins, [True]])], of[np.concatenate([[True], ~joins])]
                none = pa.nulls(len(s), pa.int64())
                ranges = [pa.array(rid[of]), pa.array(rk[of]), none, none, pa.array((s - starts[of]).astype(np.int32)), pa.array((e - s).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*ranges, pa.nulls(len(s), pa.int32())], names=_RUN_NAMES)


def _first_of_each(key: np.ndarray, digest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the first place of every pair, all places of the pairs that come more than once), ascending."""
    order = np.lexsort((digest, key))
    k, g = key[order], digest[order]
    first = np.concatenate([[True], (k[1:] != k[:-1]) | (g[1:] != g[:-1])])
    alone = first & np.concatenate([first[1:], [True]])
    return np.sort(order[first]), np.sort(order[~alone])


def _blocks(unit: str, threshold: int, step: int):
    """Blocks of up to ``step`` suffixes of the open runs, on the grid of offsets from the anchor."""

    def rows(held):
        c = _digests(16, (h[2] for h in held))
        digest = _digests(8, (h[3] for h in held))
        of = lambda k, t: np.fromiter((h[k] for h in held), t, len(held))
        columns = [of(0, np.int64), of(1, np.int64), c[:, 0], c[:, 1], digest[:, 0], of(4, np.int32), of(5, np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=_ITEMS)

    def run(batches):
        for b in batches:
            held = []
            for rid, rk, x, (starts, counts, offs) in _open_rows(b, unit):
                for p0, n, off in zip(starts.tolist(), counts.tolist(), offs.tolist()):
                    a = p0 + off
                    # suffix p has offset a - p; block j holds offsets j * step .. j * step + step - 1
                    for j in range((off - n + 1) // step, off // step + 1):
                        lo, hi = max(p0, a - j * step - step + 1), min(p0 + n - 1, a - j * step)
                        core = x[a - j * step : a - j * step - step + 1 + threshold].tobytes()
                        held.append((rid, rk, core, x[lo : hi + threshold].tobytes(), lo, hi - lo + 1))
                    if len(held) >= _ROWS // 8:  # with two byte strings each
                        yield rows(held)
                        held = []
            if held:
                yield rows(held)

    return run


def _suffixes(unit: str, threshold: int):
    def run(batches):
        schema = pa.schema([f for f in _ITEMS if f.name not in ("digest", "n")])
        for b in batches:
            held, size = [], 0

            def rows(held):
                rid, rk, p0 = (np.concatenate([h[k] for h in held]) for k in (0, 1, 3))
                c = np.concatenate([h[2] for h in held])
                return pa.RecordBatch.from_arrays([pa.array(v) for v in (rid, rk, c[:, 0], c[:, 1], p0)], schema=schema)

            for rid, rk, x, (starts, counts) in _open_rows(b, unit):
                flag = np.zeros(len(x) + 1, np.int32)
                np.add.at(flag, starts, 1)
                np.add.at(flag, starts + counts, -1)
                places = np.flatnonzero(np.cumsum(flag) > 0)
                for at in range(0, len(places), _ROWS):
                    p = places[at : at + _ROWS]
                    c = _digests(16, (x[i : i + threshold].tobytes() for i in p.tolist()))
                    held.append((np.full(len(p), rid), np.full(len(p), rk), c, p.astype(np.int32)))
                    size += len(p)
                    if size >= _ROWS:
                        yield rows(held)
                        held, size = [], 0
            if held:
                yield rows(held)

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, rk, text): rid stands for the doc_id also when null, rk tells texts of one doc_id apart."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("rid"),
        F.xxhash64(text).alias("rk"),
        text.alias("text"),
    )


def _with_text(texts: DataFrame, items: DataFrame, fields: list[str]) -> DataFrame:
    """Each document that has items with the array of them (bounded by its length)."""
    per_doc = items.groupBy("rid", "rk").agg(F.collect_set(F.struct(*fields)).alias("runs"))
    one = texts.select("rid", "rk", "text")
    return per_doc.join(one, ["rid", "rk"]).dropDuplicates(["rid", "rk"])


def _open(items: DataFrame, digit: list[str]) -> tuple[DataFrame, DataFrame]:
    """(groups whose texts are all equal: digit; groups to be told apart: digit), of two items or more."""
    groups = items.groupBy(*digit).agg(F.count("*").alias("size"), F.min("digest").alias("d0"), F.max("digest").alias("d1")).where("size > 1")
    return groups.select(*digit, (F.col("d0") == F.col("d1")).alias("equal"))


def repeated(texts: DataFrame, unit: str, threshold: int, gram: int, step: int) -> DataFrame:
    """(rid, rk, p0, n): ranges of suffixes whose first ``threshold`` tokens occur elsewhere too."""
    found = saved(texts.select("rid", "rk", "text").mapInArrow(_runs(unit, threshold, gram), _RUN), "op4-runs")
    near, all_runs = found.where("key is null").select("rid", "rk", "p0", "n"), found.where("key is not null")
    many = saved(all_runs.join(_open(all_runs, ["key"]), "key"), "op4-pass1")
    equal = many.where("equal").select("rid", "rk", "p0", "n")

    rest = many.where("not equal").drop("equal")
    texts_of = rest.groupBy("key", "digest").agg(
        F.count("*").alias("copies"), F.min(F.struct("rid", "rk", "p0", "n", "off")).alias("one")
    )
    texts_of = saved(texts_of, "op4-texts")
    equal2 = rest.join(texts_of.where("copies > 1").select("key", "digest"), ["key", "digest"], "left_semi").select("rid", "rk", "p0", "n")

    with_runs = _with_text(texts, texts_of.select("one.*"), ["p0", "n", "off"])
    with_runs = saved(with_runs, "op4-open")
    blocks = saved(
        with_runs.select("rid", "rk", "text", "runs").mapInArrow(
            _blocks(unit, threshold, step), "rid bigint, rk bigint, c1 bigint, c2 bigint, digest bigint, p0 int, n int"
        ),
        "op4-blocks",
    )
    many2 = saved(blocks.join(_open(blocks, ["c1", "c2"]), ["c1", "c2"]), "op4-pass2")
    equal3 = many2.where("equal").select("rid", "rk", "p0", "n")
    rest2 = many2.where("not equal").drop("equal")
    texts2 = rest2.groupBy("c1", "c2", "digest").agg(F.count("*").alias("copies"), F.min(F.struct("rid", "rk", "p0", "n")).alias("one"))
    texts2 = saved(texts2, "op4-texts2")
    equal4 = rest2.join(texts2.where("copies > 1").select("c1", "c2", "digest"), ["c1", "c2", "digest"], "left_semi").select("rid", "rk", "p0", "n")

    open2 = _with_text(with_runs, texts2.select("one.*"), ["p0", "n"])
    single = saved(
        open2.select("rid", "rk", "text", "runs").mapInArrow(_suffixes(unit, threshold), "rid bigint, rk bigint, c1 bigint, c2 bigint, p0 int"),
        "op4-pass3",
    )
    twice = single.groupBy("c1", "c2").agg(F.count("*").alias("size")).where("size > 1").select("c1", "c2")
    equal5 = single.join(twice, ["c1", "c2"], "left_semi").select("rid", "rk", "p0", F.lit(1).alias("n"))
    return near.union(equal).union(equal2).union(equal3).union(equal4).union(equal5)


def merged(ranges: list, threshold: int) -> list[tuple[int, int]]:
    """Maximal covered token ranges [start, end) of suffix ranges."""
    out: list[list[int]] = []
    for p0, n in sorted((r["p0"], r["n"]) for r in ranges):
        if out and p0 <= out[-1][1]:
            out[-1][1] = max(out[-1][1], p0 + n - 1 + threshold)
        else:
            out.append([p0, p0 + n - 1 + threshold])
    return [tuple(x) for x in out]


def _digest_rows(threshold: int):
    def run(batches):
        for b in batches:
            cols = [[] for _ in range(4)]
            texts, ranges = b.column("text"), b.column("ranges")
            for i in range(b.num_rows):  # one document's text and ranges as Python objects at a time
                data = texts[i].as_py().encode("utf-8", "surrogatepass")
                spans = merged(ranges[i].as_py() or [], threshold)
                kept, at = hashlib.sha256(), 0
                for s, e in spans:
                    kept.update(data[at:s])
                    at = e
                kept.update(data[at:])
                for c, v in zip(cols, (len(data), sum(e - s for s, e in spans), len(spans), kept.hexdigest())):
                    c.append(v)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return run


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and the white space that follows them."""
    data = text.encode("utf-8", "surrogatepass")
    at = [m.start() for m in _WORD.finditer(data)] + [len(data)]
    out, pos = [], 0
    for s, e in spans:
        out.append(data[pos : at[s]])
        pos = at[e]
    out.append(data[pos:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def _ranges(docs: DataFrame, unit: str, threshold: int, gram: int, step: int) -> DataFrame:
    found = repeated(keyed(docs), unit, threshold, gram, step)
    return found.groupBy("rid", "rk").agg(F.collect_set(F.struct("p0", "n")).alias("ranges"))


def removed_bytes(docs: DataFrame, threshold: int = 400, gram: int = 32, step: int = 32) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): every byte of a repeated window goes."""
    ranges = _ranges(docs, "bytes", threshold, gram, step)
    out = keyed(docs).join(ranges, ["rid", "rk"], "left").select("doc_id", "text", "ranges")
    return out.mapInArrow(_digest_rows(threshold), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, threshold: int = 50, gram: int = 8, step: int = 8) -> DataFrame:
    """``docs`` with all words of repeated windows of ``threshold`` words cut out of ``text``.

    Every row stays, also one whose whole text goes; ``n_chars``, where present, is counted anew.
    """
    ranges = _ranges(docs, "words", threshold, gram, step)
    names = docs.columns
    inner = docs.select(
        F.struct(*(docs[c] for c in names)).alias("row"),
        F.coalesce(docs["doc_id"].cast("bigint"), F.lit(-(2**63))).alias("rid"),
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("rk"),
    )
    both = inner.join(ranges, ["rid", "rk"], "left")
    flat = both.select(*(F.col("row").getField(c).alias(c) for c in names), F.col("ranges").alias("thawline_op4_ranges"))
    return flat.mapInArrow(_cut_rows(names, threshold), docs.schema)


def _cut_rows(names: list[str], threshold: int):
    """Texts without their ranges' words (the column behind the table's own), some bytes of text at a time."""

    def run(batches):
        text, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None
        for b in batches:
            columns, ranges = b.columns[: len(names)], b.column(len(names))
            start, held, new, sizes = 0, 0, [], []
            for i in range(b.num_rows):
                t, r = columns[text][i].as_py(), ranges[i].as_py()
                if r is not None:
                    t = cut_words(t or "", merged(r, threshold))
                new.append(t)
                sizes.append(columns[chars][i].as_py() if chars is not None and r is None else len(t or ""))
                held += len(t or "")
                if held >= 1 << 20 or i == b.num_rows - 1:
                    out = [c.slice(start, len(new)) for c in columns]
                    out[text] = pa.array(new, columns[text].type)
                    if chars is not None:
                        out[chars] = pa.array(sizes, columns[chars].type)
                    yield pa.RecordBatch.from_arrays(out, schema=pa.schema([b.schema.field(k) for k in range(len(names))]))
                    start, held, new, sizes = i + 1, 0, [], []

    return run


def removed_bytes_sql(threshold: int = 400) -> str:
    """DuckDB twin of ``removed_bytes`` over ``documents`` (every window by its digest; small tables only)."""
    t = threshold
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
  FROM documents),
starts AS (SELECT rid, h, unnest(range(0, n - {t - 1})) AS p FROM d WHERE n >= {t}),
windows AS (SELECT rid, p, md5(substr(h, CAST(2 * p + 1 AS BIGINT), {2 * t})) AS k FROM starts),
twice AS (SELECT rid, p FROM windows WHERE k IN (SELECT k FROM windows GROUP BY k HAVING count(*) > 1)),
marked AS (SELECT rid, p, CASE WHEN p <= lag(p) OVER (PARTITION BY rid ORDER BY p) + {t} THEN 0 ELSE 1 END AS is_new FROM twice),
grouped AS (SELECT rid, p, sum(is_new) OVER (PARTITION BY rid ORDER BY p) AS g FROM marked),
spans AS (SELECT rid, g, min(p) AS s, max(p) + {t} AS e FROM grouped GROUP BY rid, g),
gaps AS (SELECT rid, s, e, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY s), 0) AS before FROM spans),
kept AS (
  SELECT g.rid, count(*) AS n_spans, sum(e - s) AS n_removed, max(e) AS last,
    string_agg(substr(d.h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (s - before) AS BIGINT)), '' ORDER BY s) AS head
  FROM gaps g JOIN d ON d.rid = g.rid GROUP BY g.rid)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
