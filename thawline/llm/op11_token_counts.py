"""Token counts: how many tokens a tokenizer gives each text, by a two-tier lookup of piece lengths in the tasks.

A text is cut into pieces that the tokenizer never joins, so its count is the sum of theirs.

* Tier one is a compact hash table of frequent pieces, broadcast to all tasks: two 64-bit words (a
  piece's bytes and its size, so a hit is exact) and one byte (its number of tokens) a slot.  Whole
  batches of pieces are looked up in it at once.
* Tier two holds what the table misses: a cache of the worker, which asks the tokenizer once for
  each new piece and is emptied when it has grown large.

No piece is shuffled.  The frequent pieces come from a summary of all texts: every task counts its
pieces in a bounded table (counts of ``slots`` pieces; a full table gives up the smallest count
throughout, so any piece with more than one in ``slots`` of all occurrences stays), and these
tables, one row a task, are merged in a tree.  Which pieces are in the table changes the time only.

Pieces: for tokenizers that drop white space, what stands between it; for byte-level ones that
keep it, white space and what follows.  ``pieces_of`` tries which of both holds; for any other
tokenizer, and for sentencepiece models, a text is one piece.

Defined cases: null and empty texts have no token.  Rows are counted one by one, so repeated rows
and null doc_ids stay.  Special strings inside texts are handled as the library does by default.
Empty table: empty result.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thawline.llm.common import U64, doc_texts, mix, saved
from thawline.llm.op6_token_ids import _BYTE_CHARS, _plain_lower

SLOTS = 1 << 15
SHORT = 15  # bytes of a piece in tier one: a slot's last byte is the size
GROUP = 1 << 20
FAN_IN = 64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


class Tokens:
    """A tokenizer's token counts; ``mode`` says how its texts may be cut: drop, keep (white space) or whole."""

    LIMIT = 400_000
    _made: dict = {}

    def __init__(self, path: str):
        self.cache: dict[bytes, int] = {}
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._ids = lambda texts: model.encode(texts, num_threads=1)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            self._ids = lambda texts: [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]
        self.mode = pieces_of(self._ids)
        self.model = None
        if self.mode == "drop" and not path.endswith(".model"):
            self.model = t.model
            self.stops = {c: len(i) for c, i in zip(b",.", self._ids([",", "."]))}
            words = [b"aba", b"ABA", "Th\u00e9".encode(), b"other,", "stra\u00dfe,".encode(), "\u00dcnd.".encode(), b"x."]
            if [self._word(w) for w in words] != [len(i) for i in self._ids([w.decode() for w in words])]:
                self.model = None

    @classmethod
    def of(cls, path: str) -> Tokens:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _word(self, piece: bytes) -> int | None:
        """Tokens of a piece that is one word of Latin letters, perhaps with a comma or stop behind it, by the model alone."""
        stop = self.stops.get(piece[-1], 0)
        low = _plain_lower(piece[:-1] if stop else piece)
        if low is None:
            return None
        return len(self.model.tokenize(low.decode("ascii") if low.isascii() else low.decode("latin-1").translate(_BYTE_CHARS))) + stop

    def fresh(self, pieces: list[bytes]) -> list[int]:
        out = [self._word(p) for p in pieces] if self.model else [None] * len(pieces)
        left = [i for i, n in enumerate(out) if n is None]
        for i, ids in zip(left, self._ids([pieces[i].decode("utf-8", "replace") for i in left])):
            out[i] = len(ids)
        return out

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each piece, through the worker's cache."""
        if len(self.cache) > self.LIMIT:
            self.cache.clear()
        new = [p for p in set(pieces) if p not in self.cache]
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            self.cache.update(zip(part, self.fresh(part)))
        return np.fromiter(map(self.cache.__getitem__, pieces), np.int64, len(pieces))


def pieces_of(ids) -> str:
    """How texts may be cut before ``ids`` (a function of a list of texts): ``drop``, ``keep`` or ``whole``."""
    probes = ["a b", "ab  cd ef ", " It's 12 o'clock,\n\n\tsaid he.  ", "é ß\r\n--- x1 y22!? 'll\x0b\x0cz  ", "<|endoftext|> a <|endoftext|>b", "日本 語　z  q"]
    for mode in ("drop", "keep"):
        cut = []
        for p in probes:
            data = p.encode()
            start, end, _ = spans(np.frombuffer(data + b" ", np.uint8), np.array([len(data)]), mode)
            cut.append([data[s:e].decode() for s, e in zip(start.tolist(), end.tolist())])
        if all(sum(ids(c), []) == ids([p])[0] for p, c in zip(probes, cut)):
            return mode
    return "whole"


def spans(x: np.ndarray, sizes: np.ndarray, mode: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end, text) of each piece in ``x``: texts of ``sizes`` bytes, a space behind each."""
    stop = np.cumsum(sizes + 1) - 1
    first = stop - sizes
    if mode == "whole":
        some = np.flatnonzero(sizes)
        return first[some], stop[some], some
    edge = np.flatnonzero(np.diff(_SPACE[x].view(np.int8), prepend=1))
    start, end = edge[0::2], edge[1::2]
    if mode == "keep":
        end = np.union1d(end, stop[sizes > 0])  # with the white space that ends a text
        start = np.concatenate([[0], end[:-1]])
    text = np.searchsorted(stop, end - 1, "right") if len(end) else end
    return np.maximum(start, first[text]), end, text


def packed(x: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of up to ``SHORT`` bytes as two words; ``x`` has 16 bytes more than the pieces."""
    words = np.ndarray((len(x) - 7,), "<u8", x, strides=(1,))
    low = words[start] & _MASK[np.minimum(size, 8)]
    high = words[start + 8] & _MASK[np.maximum(size - 8, 0)]
    return low, high | size.astype(np.uint64) << U64(56)


def unpacked(low: np.ndarray, high: np.ndarray) -> list[bytes]:
    raw = np.stack([low, high], axis=1).astype("<u8").tobytes()
    return [raw[i : i + raw[i + 15]] for i in range(0, len(raw), 16)]


def _hash(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return mix(low ^ mix(high))


class LengthTable:
    """Open addressing over packed pieces; a slot's byte is the piece's tokens and one, 0 where it is free."""

    def __init__(self, low: np.ndarray, high: np.ndarray, tokens: np.ndarray):
        fits = tokens < 255
        low, high, tokens = low[fits], high[fits], tokens[fits]
        n = 1 << max(4, int(2 * len(low)).bit_length())
        self.low, self.high, self.tokens = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, np.uint8)
        left, at = np.arange(len(low)), (_hash(low, high) & U64(n - 1)).astype(np.int64)
        while len(left):
            place, who = np.unique(at[left], return_index=True)
            free = self.tokens[place] == 0
            i, place = left[who[free]], place[free]
            self.low[place], self.high[place], self.tokens[place] = low[i], high[i], tokens[i] + 1
            left = np.setdiff1d(left, i, assume_unique=True)
            at[left] = (at[left] + 1) & (n - 1)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Tokens of each piece, -1 where the table has none."""
        last = len(self.tokens) - 1
        out = np.full(len(low), -1, np.int64)
        at = (_hash(low, high) & U64(last)).astype(np.int64)
        open_ = np.arange(len(low))
        while len(open_):
            n = self.tokens[at]
            hit = (self.low[at] == low[open_]) & (self.high[at] == high[open_]) & (n > 0)
            out[open_[hit]] = n[hit].astype(np.int64) - 1
            go = ~hit & (n > 0)
            open_, at = open_[go], (at[go] + 1) & last
        return out


def _grouped(batch):
    """(texts' bytes, first row) of some rows of an Arrow batch, about ``GROUP`` bytes at a time."""
    texts, group, held, first = batch.column("text"), [], 0, 0
    for i in range(batch.num_rows):
        group.append((texts[i].as_py() or "").encode("utf-8", "surrogatepass"))
        held += len(group[-1])
        if held >= GROUP or i == batch.num_rows - 1:
            yield group, first
            group, held, first = [], 0, i + 1


def _bytes_of(group: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    data = b" ".join(group) + b" " * 17
    return data, np.frombuffer(data, np.uint8), np.array([len(t) for t in group], np.int64)


def count_tokens(group: list[bytes], tokens: Tokens, table: LengthTable) -> np.ndarray:
    data, x, sizes = _bytes_of(group)
    start, end, text = spans(x[: int(sizes.sum()) + len(group)], sizes, tokens.mode)
    found = np.full(len(start), -1, np.int64)
    short = np.flatnonzero(end - start <= SHORT)
    found[short] = table.find(*packed(x, start[short], (end - start)[short]))
    miss = np.flatnonzero(found < 0)
    found[miss] = tokens.counts([data[s:e] for s, e in zip(start[miss].tolist(), end[miss].tolist())])
    return np.bincount(text, weights=found, minlength=len(group)).astype(np.int64)


class Summary:
    """Counts of at most ``slots`` pieces; sums of summaries keep the bound on what they give up."""

    def __init__(self, slots: int):
        self.slots, self.held, self.parts = slots, 0, []

    def add(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((low, high, n))
        self.held += len(low)
        if self.held > 8 * self.slots:
            self.fold(4 * self.slots)

    def fold(self, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low, high, n = (np.concatenate(c) if self.parts else np.zeros(0, np.int64) for c in (zip(*self.parts) if self.parts else ((),) * 3))
        _, one, piece = np.unique(_hash(low.astype(np.uint64), high.astype(np.uint64)), return_index=True, return_inverse=True)
        low, high, n = low[one], high[one], np.bincount(piece, weights=n, minlength=len(one)).astype(np.int64)
        if len(n) > slots:
            n = n - np.partition(n, -slots - 1)[-slots - 1]  # the largest count that has no slot
            low, high, n = low[n > 0], high[n > 0], n[n > 0]
        self.parts, self.held = [(low, high, n)], len(n)
        return low, high, n

    def row(self) -> pa.RecordBatch:
        low, high, n = self.fold(self.slots)
        arrays = [pa.array([c.astype(np.int64, copy=False) if c.dtype != np.uint64 else c.view(np.int64)], pa.list_(pa.int64())) for c in (low, high, n)]
        return pa.RecordBatch.from_arrays(arrays, names=["low", "high", "n"])


_SUMMARY = "low array<bigint>, high array<bigint>, n array<bigint>"


def _summaries(path: str, slots: int):
    def run(batches):
        tokens, summary = Tokens.of(path), Summary(slots)
        for b in batches:
            for group, _ in _grouped(b):
                _, x, sizes = _bytes_of(group)
                start, end, _ = spans(x[: int(sizes.sum()) + len(group)], sizes, tokens.mode)
                short = end - start <= SHORT
                low, high = packed(x, start[short], (end - start)[short])
                _, one, n = np.unique(_hash(low, high), return_index=True, return_counts=True)
                summary.add(low[one], high[one], n)
        yield summary.row()

    return run


def _merge(slots: int):
    def run(batches):
        summary, some = Summary(slots), False
        for b in batches:
            for i in range(b.num_rows):
                low, high, n = (b.column(c)[i].values.to_numpy() for c in ("low", "high", "n"))
                summary.add(low.view(np.uint64), high.view(np.uint64), n)
                some = True
        if some:
            yield summary.row()

    return run


def frequent_pieces(docs: DataFrame, path: str, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """The frequent pieces of all texts, packed; at most ``slots``."""
    level = saved(doc_texts(docs).select("text").mapInArrow(_summaries(path, slots), _SUMMARY), "op11-summaries")
    while (rows := level.count()) > 1:
        level = saved(level.repartition(-(-rows // FAN_IN)).mapInArrow(_merge(slots), _SUMMARY), "op11-summaries")
    top = level.first()  # one row of at most ``slots`` entries
    if top is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.array(top[c], np.int64).view(np.uint64) for c in ("low", "high"))


def length_table(docs: DataFrame, path: str, slots: int = SLOTS) -> LengthTable:
    low, high = frequent_pieces(docs, path, slots)
    return LengthTable(low, high, np.array(Tokens.of(path).fresh(unpacked(low, high)), np.int64))


def token_counts(docs: DataFrame, path: str, limit: int = 2048, slots: int = SLOTS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; ``slots`` bounds the broadcast table (about 35 bytes each)."""
    table = docs.sparkSession.sparkContext.broadcast(length_table(docs, path, slots))

    def run(batches):
        tokens = Tokens.of(path)
        for b in batches:
            for group, first in _grouped(b):
                n = count_tokens(group, tokens, table.value)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(first, len(group)), pa.array([len(t) for t in group], pa.int64()), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"]
                )

    out = doc_texts(docs).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
