"""Benchmark decontamination: q-gram lemma over diagonal bands, then banded alignment.

Texts are compared normalised: lower case, everything but letters and digits (Unicode) one
space.  An item of m characters is found in a document where some region can be turned into it
with at most ``m // per_edit`` edits (semi-global edit distance).  Such a region shares at least
``m + 1 - q * (e + 1)`` q-grams with the item, on diagonals that differ by at most e.  So

1. every document position whose q-gram is a benchmark q-gram is a hit (item, diagonal),
2. hits are counted in bands of 2e + 1 diagonals that overlap by half, so that any e + 1
   neighbouring diagonals lie in one band,
3. bands below the bound go; the others are verified by banded dynamic programming.

The edit budget is lowered for short items so that the bound stays at least one.  Items with
fewer than ``q`` normalised characters have no q-gram: they are found where the whole item stands
at word borders without an edit.  Characters from U+0E00 on (scripts that put no spaces between
words) are borders themselves.

The benchmark is the stated query set: it goes to the executors in blocks of at most
``block_chars`` characters, each a broadcast of that bounded size, and every block meets all
documents.  Documents are read as they are partitioned; nothing is shuffled but the found rows,
of which the best of an item's texts stays, wherever the blocks end.

Defined cases: null or empty document text: no match; null or empty item text (also one without
letters and digits) or null item_id:
not looked for; repeated item ids: each text is looked for, one row per id and document; null
doc_id: reported with a null id; repeated rows: one row each.  Empty tables: empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thawline.llm.common import U64, doc_texts, mix, small_batches
from thawline.llm.op7_quality import GROUP, keep_slices

_OTHER = re.compile(r"[\W_]+")
_MULT = 0x9E3779B97F4A7C15


def normalised(text: str) -> str:
    return _OTHER.sub(" ", text.lower()).strip()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(x: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q characters at each position (every position of ``x`` that has q)."""
    n = len(x) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, mult, width, done, h = x.astype(np.uint64), _MULT, 1, 0, None
    while True:  # hashes of 1, 2, 4 ... characters, joined by the binary digits of q
        if q & width:
            part = power[done : done + n]
            h = part if h is None else h * U64(mult) + part
            done += width
        if width * 2 > q:
            return mix(h)
        power = power[:-width] * U64(mult) + power[width:]
        width, mult = width * 2, mult * mult % (1 << 64)


def edit_budget(m: int, q: int, per_edit: int) -> int:
    return max(0, min(m // per_edit, (m + 1) // q - 1))


def banded_distance(pattern: np.ndarray, text: np.ndarray, lo: int, hi: int, budget: int) -> tuple[int, int, int]:
    """Least edits that turn a region of ``text`` starting on diagonals lo..hi into ``pattern``.

    Row i of the pattern meets text positions i + lo .. i + hi only; returns (edits, start, end),
    edits = budget + 1 where none is within the budget.
    """
    w, big = hi - lo + 1, budget + 1
    at = np.arange(lo, hi + 1)
    inside = (at >= 0) & (at <= len(text))
    cost = np.where(inside, 0, big)
    start = at.copy()
    steps = np.arange(w)
    for i in range(1, len(pattern) + 1):
        at = at + 1
        ok = (at >= 1) & (at <= len(text))
        same = np.zeros(w, bool)
        same[ok] = text[at[ok] - 1] == pattern[i - 1]
        sub = np.where(ok, cost + ~same, big)
        dele = np.full(w, big)  # a pattern character without a counterpart
        dele[:-1] = cost[1:] + 1
        best = np.minimum(sub, dele)
        from_ = np.where(sub <= dele, start, np.append(start[1:], 0))
        best = np.where((at >= 0) & (at <= len(text)), best, big)
        # text characters without a counterpart: running minimum of best - position
        run = np.minimum.accumulate(best - steps)
        keep = np.maximum.accumulate(np.where(best - steps == run, steps, 0))
        cost, start = np.minimum(run + steps, big), from_[keep]
        if cost.min() >= big:
            return big, 0, 0
    j = int(np.argmin(cost))
    return int(cost[j]), int(start[j]), int(at[j])


def _places(text: str, part: str):
    at = text.find(part)
    while at >= 0:
        yield at
        at = text.find(part, at + 1)


def _border(text: str, at: int) -> bool:
    """Whether a word may end or begin before ``at``."""
    return at in (0, len(text)) or " " in text[at - 1 : at + 1] or max(text[at - 1 : at + 1]) >= "\u0e00"


class Block:
    """Q-gram table of some benchmark items."""

    def __init__(self, items: list[tuple[int, str]], q: int, per_edit: int):
        self.q = q
        self.short: dict[int, dict[str, list[int]]] = {}  # items too short for a q-gram, by length
        for i, t in items:
            if len(t) < q:
                self.short.setdefault(len(t), {}).setdefault(t, []).append(i)
        items = [(i, t) for i, t in items if len(t) >= q]
        self.texts = [t for _, t in items]
        self.items = [(i, _codes(t)) for i, t in items]
        m = np.array([len(x) for _, x in self.items])
        self.edits = np.array([edit_budget(int(k), q, per_edit) for k in m], np.int64)
        self.least = m + 1 - q * (self.edits + 1)
        h = [gram_hashes(x, q) for _, x in self.items]
        item = np.repeat(np.arange(len(h)), [len(x) for x in h])
        place = np.concatenate([np.arange(len(x)) for x in h]) if h else np.zeros(0, np.int64)
        h = np.concatenate(h) if h else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        h, self.item, self.place = h[order], item[order], place[order]
        self.grams, self.first, self.count = np.unique(h, return_index=True, return_counts=True)
        self.bits = 22
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[(self.grams >> U64(64 - self.bits)).astype(np.int64)] = True

    def candidates(self, x: np.ndarray, lengths: np.ndarray):
        """(document, item, first diagonal, last diagonal) of bands that reach the bound."""
        if not self.items:
            return []
        h = gram_hashes(x, self.q)
        at = np.flatnonzero(self.seen[(h >> U64(64 - self.bits)).astype(np.int64)])
        g = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        hit = self.grams[g] == h[at]
        at, g = at[hit], g[hit]
        ends = np.cumsum(lengths)
        doc = np.searchsorted(ends, at, "right")
        whole = at + self.q <= ends[doc]
        at, g, doc = at[whole], g[whole], doc[whole]
        if not len(at):
            return []
        k = self.count[g]
        ref = np.repeat(self.first[g], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        at, doc = np.repeat(at, k), np.repeat(doc, k)
        item = self.item[ref]
        diagonal = at - (ends - lengths)[doc] - self.place[ref]
        width = self.edits[item] + 1  # band b covers diagonals b * width .. b * width + 2 * width - 1
        band = diagonal // width
        both = [(doc, item, b, at) for b in (band, band - 1)]
        doc, item, band, at = (np.concatenate(c) for c in zip(*both))
        order = np.lexsort((at, band, item, doc))
        doc, item, band, at = doc[order], item[order], band[order], at[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        # each document position counts once in a band: distinct (band, position)
        fresh = new.copy()
        fresh[1:] |= at[1:] != at[:-1]
        group = np.cumsum(new) - 1
        n = np.bincount(group, weights=fresh)
        f = np.flatnonzero(new)
        good = n >= self.least[item[f]]
        f = f[good]
        w = self.edits[item[f]] + 1
        return list(zip(doc[f].tolist(), item[f].tolist(), (band[f] * w).tolist(), (band[f] * w + 2 * w - 1).tolist()))

    def find(self, texts: list[str]):
        """(text index, item id, edits, start, end) of the best region of each found item, normalised positions."""
        plain = [normalised(t) for t in texts]
        codes = [_codes(t) for t in plain]
        lengths = np.array([len(c) for c in codes])
        best: dict = {}
        for d, i, lo, hi in self.candidates(np.concatenate(codes).astype(np.uint64), lengths):
            item, pattern = self.items[i]
            if best.get((d, item), (1,))[0] == 0:
                continue
            s = plain[d].find(self.texts[i], max(0, lo), hi + 1 + len(pattern))
            e, s, t = (0, s, s + len(pattern)) if s >= 0 else banded_distance(pattern, codes[d], lo, hi, int(self.edits[i]))
            if e <= self.edits[i] and (e, s) < best.get((d, item), (1 << 30, 0, 0))[:2]:
                best[d, item] = (e, s, t)
        for d, item, s, t in self._short_items(plain):
            if (0, s) < best.get((d, item), (1 << 30, 0))[:2]:
                best[d, item] = (0, s, t)
        return [(d, item, *v) for (d, item), v in sorted(best.items())]

    def _short_items(self, plain: list[str]):
        """(text index, item id, start, end) of the first place of each short item at word borders."""
        for size, items in self.short.items():
            for d, t in enumerate(plain):
                found = set()
                for s in range(len(t) - size + 1) if len(items) > 64 else sorted({p for x in items for p in _places(t, x)}):
                    ids = items.get(t[s : s + size])
                    if ids and t[s : s + size] not in found and _border(t, s) and _border(t, s + size):
                        found.add(t[s : s + size])
                        for item in ids:
                            yield d, item, s, s + size


def _blocks(benchmark: DataFrame, block_chars: int):
    """Benchmark items read block by block through the driver, each of bounded size."""
    rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("bigint"), "text")
    block, held = [], 0
    for item, text in rows.distinct().toLocalIterator():
        text = normalised(text)
        if not text:
            continue
        block.append((item, text))
        held += len(text)
        if held >= block_chars:
            yield block
            block, held = [], 0
    if block:
        yield block


_OUT = "doc_id bigint, tag bigint, item_id bigint, edits int, start int, end int"


def _find(block):
    def run(batches):
        b = block.value
        for batch in batches:
            texts, group, held = batch.column("text"), [], 0
            ids, tags = batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist()
            rows = []
            for i in range(batch.num_rows):
                group.append(texts[i].as_py())
                held += len(group[-1])
                if held >= GROUP or i == batch.num_rows - 1:
                    at = i + 1 - len(group)
                    rows += [(ids[at + d], tags[at + d], item, e, s, t) for d, item, e, s, t in b.find(group)]
                    group, held = [], 0
            cols = list(zip(*rows)) if rows else [()] * 6
            types = [*[pa.int64()] * 3, *[pa.int32()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=["doc_id", "tag", "item_id", "edits", "start", "end"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, q: int = 12, per_edit: int = 16, block_chars: int = 4_000_000) -> DataFrame:
    """(doc_id, item_id, edits, start, end): benchmark items found in documents, best region of each.

    ``start`` and ``end`` are character positions in the normalised text.  ``per_edit``: one edit
    is allowed for so many characters of the item.
    """
    spark = docs.sparkSession
    out, texts = None, doc_texts(docs)
    texts = texts.withColumn("tag", F.xxhash64("text"))
    for number, items in enumerate(_blocks(benchmark, block_chars)):
        block = spark.sparkContext.broadcast(Block(items, q, per_edit))
        part = texts.mapInArrow(_find(block), _OUT).withColumn("block", F.lit(number))
        out = part if out is None else out.union(part)
    if out is None:
        out = spark.createDataFrame([], _OUT + ", block int")
    # rows that repeat an id and its text are told from an item that several blocks found
    best = out.groupBy("doc_id", "tag", "item_id", "block").agg(F.min(F.struct("edits", "start", "end")).alias("best"), F.count("*").alias("copies"))
    best = best.groupBy("doc_id", "tag", "item_id").agg(F.min("best").alias("best"), F.max("copies").alias("copies"))
    best = best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return best.select("doc_id", "item_id", "best.edits", "best.start", "best.end")


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they were."""
    spark = docs.sparkSession
    small_batches(spark)
    kept = docs
    for items in _blocks(benchmark, options.get("block_chars", 4_000_000)):
        block = spark.sparkContext.broadcast(Block(items, options.get("q", 12), options.get("per_edit", 16)))
        kept = kept.mapInArrow(keep_slices("text", _without_leak(block)), docs.schema)
    return kept


def _without_leak(block):
    def good(texts: list[bytes]) -> np.ndarray:
        out = np.ones(len(texts), bool)
        for d, *_ in block.value.find([t.decode("utf-8", "surrogatepass") for t in texts]):
            out[d] = False
        return out

    return good
