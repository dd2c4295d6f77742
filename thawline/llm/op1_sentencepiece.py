"""SentencePiece encoding and decoding by a relational lattice.

Distinct words are exploded into their substrings of bounded length, joined to the piece table
(an equi-join; the table is the vocabulary file, so its size is known and it is broadcast),
and the found edges are grouped by word.  A Spark higher-order ``aggregate`` folds a word's
edges into its pieces.  The fold follows the model's own type, as only that gives the ids the
model means:

* ``unigram``: Viterbi, the path with the largest sum of scores (ties: the longer last piece),
* ``bpe``: of the edges that join exactly two pieces of the current cut, the one with the best
  score, leftmost on ties, is merged, as long as there is one.  (Viterbi over a BPE model's
  scores, which are merge ranks, gives other ids than the model.)

Words are cut where no piece of the vocabulary can cross, so their ids follow each other in a
document: before a space run, and between letters or digits and other characters.  Characters
without a piece become the pieces of their UTF-8 bytes.

Texts are never shuffled: each scan partition names the distinct words of its chunks of about
``chunk_chars`` characters, these are joined to the folded words, and every chunk's words and ids
are written to a file in the shared folder, which the second scan of the partition reads when it
comes to that chunk.  Words longer than ``LONGEST`` characters, and words a chunk's file does not
hold because an upstream plan gave the rows in another order, are folded in place by the same
rule with a heap.

Decoding joins ids to pieces, bytes back to characters, and drops the space put before the text.

Defined cases: null or empty text: no ids; a text that holds the space mark itself does not come
back exactly (``exact`` is false); null doc_ids and repeated rows are encoded like any other.
Empty table: empty result.
"""

from __future__ import annotations

import heapq
import re
import uuid
import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thawline.llm.common import doc_texts, shared_path, tidy_worker
from thawline.storage import open_fs, put_in_place

SPACE = "▁"
LONGEST = 60
KEPT_UNITS = 80_000
_WHOLE = "(?s).+"


class Pieces:
    """Vocabulary of a SentencePiece model: pieces with ids and scores, byte pieces, type."""

    def __init__(self, pieces: list[tuple[str, int, float]], byte_ids: list[int], unknown: int, fold: str):
        self.pieces, self.byte_ids, self.unknown, self.fold = pieces, byte_ids, unknown, fold
        self.by_text = {p: (i, s) for p, i, s in pieces}
        self.wide = max([unknown, *byte_ids, *(i for _, i, _ in pieces)]) >= 1 << 16
        self.longest = max((len(p) for p, _, _ in pieces), default=1)
        self.pattern = self._pattern()

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        bytes_ = {sp.id_to_piece(i): i for i in range(n) if sp.is_byte(i)}
        with open(path, "rb") as f:
            fold = "unigram" if _model_type(f.read()) == 1 else "bpe"
        return cls(
            [(sp.id_to_piece(i), i, sp.get_score(i)) for i in plain], [bytes_[f"<0x{b:02X}>"] for b in range(256)] if len(bytes_) == 256 else [], sp.unk_id(), fold
        )

    def _pattern(self) -> re.Pattern:
        """Cuts a marked text where no piece crosses."""
        self.apart: set[str] = set()
        glue = {(a, b) for p, _, _ in self.pieces for a, b in zip(p, p[1:])}
        if any(b == SPACE and a != SPACE for a, b in glue):
            return re.compile(_WHOLE)
        apart = self.apart  # letters and digits that are cut like other characters

        def kind(c):
            return c.isalnum() and c not in apart

        while True:
            new = {a if kind(a) else b for a, b in glue if a != SPACE and b != SPACE and kind(a) != kind(b)}
            if not new:
                break
            apart |= new
        if len(apart) > 200:
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        also = "_" + "".join(map(re.escape, sorted(apart)))
        return re.compile(f"{SPACE}*[^\\W{also}]+|{SPACE}*(?:[^\\w{SPACE}]|[{also}])+|{SPACE}+")

    def words(self, text: str) -> list[str]:
        return self.pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def units(self, text: str) -> tuple[list[str], bool]:
        """The text in parts that are encoded on their own: (parts, whether each stands behind a space).

        A text without runs of spaces is cut at its spaces, the space in front of each part left
        out; any other text is cut into words at once.
        """
        if not text:
            return [], False
        if self.pattern.pattern == _WHOLE or text[0] == " " or "  " in text or SPACE in text:
            return self.words(text), False
        return text.split(" "), True

    def char_ids(self, char: str) -> list[int]:
        if char in self.by_text:
            return [self.by_text[char][0]]
        return [self.byte_ids[b] for b in char.encode("utf-8")] if self.byte_ids else [self.unknown]

    def fold_long(self, word: str) -> list[int]:
        """Ids of one word of any length by the model's fold: a heap of merges, or one Viterbi pass."""
        n = len(word)
        if self.fold == "unigram":
            best = [(0.0, 0, 0)] + [(-np.inf, 0, 0)] * n
            low = min((s for _, _, s in self.pieces), default=0.0) - 10
            for e in range(1, n + 1):
                for s in range(max(0, e - self.longest), e):
                    got = self.by_text.get(word[s:e])
                    score = got[1] if got else low if e - s == 1 else None
                    if score is not None and best[s][0] + score > best[e][0]:
                        best[e] = (best[s][0] + score, s, e)
            cuts, e = [], n
            while e:
                cuts.append((best[e][1], e))
                e = best[e][1]
            spans = cuts[::-1]
        else:
            end, prev = list(range(1, n + 1)), list(range(-1, n))
            alive = [True] * n
            heap: list = []

            def offer(s):
                if s >= 0 and end[s] < n:
                    e = end[end[s]]
                    got = self.by_text.get(word[s:e]) if e - s <= self.longest else None
                    if got:
                        heapq.heappush(heap, (-got[1], s, end[s], e))

            for s in range(n):
                offer(s)
            while heap:
                _, s, mid, e = heapq.heappop(heap)
                if not alive[s] or end[s] != mid or not alive[mid] or end[mid] != e:
                    continue
                alive[mid] = False
                end[s] = e
                if e < n:
                    prev[e] = s
                offer(s)
                offer(prev[s])
            spans = [(s, end[s]) for s in range(n) if alive[s]]
        out: list[int] = []
        for s, e in spans:
            out += [self.by_text[word[s:e]][0]] if word[s:e] in self.by_text else self.char_ids(word[s:e])
        return out

    @cached_property
    def as_bytes(self) -> dict[int, bytes]:
        return {i: p.encode("utf-8", "surrogatepass") for p, i, _ in self.pieces} | {i: bytes([b]) for b, i in enumerate(self.byte_ids)}

    @cached_property
    def by_id(self) -> pa.Array:
        """Bytes of each id, null where it has none."""
        return pa.array([self.as_bytes.get(i) for i in range(max(self.as_bytes, default=-1) + 1)], pa.binary())

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """Text of the ids; bytes of neighbouring byte pieces make characters again."""
        ids = np.asarray(ids, np.int32)
        if not len(ids):
            return ""
        try:
            found = self.by_id.take(pa.array(ids))
        except pa.ArrowIndexError as e:
            raise KeyError("id without a piece") from e
        if found.null_count:
            raise KeyError("id without a piece")
        _, ends, data = found.buffers()
        text = str(data[: np.frombuffer(ends, np.int32, len(ids) + 1)[-1]], "utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text

    def table(self, spark: SparkSession) -> DataFrame:
        opens = self.opening()
        rows = [(p, i, float(s), p in opens) for p, i, s in self.pieces]
        return spark.createDataFrame(rows, "piece string, piece_id int, score double, opens boolean")

    def opening(self) -> set[str]:
        """Pieces that begin or end a piece of a better score whose other part is a piece or a character."""
        out = set()
        for p, _, score in self.pieces:
            for n in range(1, len(p)):
                a, b = p[:n], p[n:]
                for part, other in ((a, b), (b, a)):
                    # equal scores: the merge to the left is better, so they count as better
                    if len(part) > 1 and part in self.by_text and self.by_text[part][1] <= score and (len(other) == 1 or other in self.by_text):
                        out.add(part)
        return out


def _model_type(data: bytes) -> int:
    """trainer_spec.model_type of a serialised model (fields 2 and 3; 1 unigram, 2 bpe)."""

    def fields(buf):
        at = 0

        def varint():
            nonlocal at
            shift = x = 0
            while True:
                b = buf[at]
                at += 1
                x |= (b & 127) << shift
                shift += 7
                if b < 128:
                    return x

        while at < len(buf):
            key = varint()
            kind = key & 7
            if kind == 0:
                yield key >> 3, varint()
            else:
                size = varint() if kind == 2 else 8 if kind == 1 else 4
                yield key >> 3, buf[at : at + size]
                at += size

    for number, value in fields(data):
        if number == 2:
            return next((v for k, v in fields(value) if k == 3), 1)
    return 1


def _key(text):
    """64-bit number of a text: a join finds numbers in a third of the time that it takes for strings."""
    return F.xxhash64(text)


def lattice(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(word, edges): the word's substrings that are pieces, as structs (score, start, end, id).

    ``words`` holds distinct words; if it is partitioned by word, nothing is shuffled.
    """
    n = F.length("word")
    at = words.select("word", F.explode(F.sequence(F.lit(0), n - 1)).alias("start"))
    at = at.select("word", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), n - F.col("start")))).alias("size"))
    sub = at.select("word", "start", "size", F.col("word").substr(F.col("start") + 1, F.col("size")).alias("piece"))
    sub = sub.withColumn("key", _key("piece"))
    known = pieces.select(_key("piece").alias("known_key"), F.col("piece").alias("known"), "piece_id", "score", "opens")
    # equal, whatever texts share a number; written like this it does not become a second key
    same = F.col("piece").startswith(F.col("known")) & F.col("known").startswith(F.col("piece"))
    # a single character stays without a piece, so every word keeps an edge for each of its characters
    edge = sub.join(F.broadcast(known), (F.col("key") == F.col("known_key")) & same, "left").where("piece_id is not null or size = 1")
    rank = F.expr(
        "struct(-coalesce(score, double('-infinity')) as rank, start, start + size as end, piece_id, coalesce(opens, false) as opens,"
        " shiftleft(1L, start) | shiftleft(1L, start + size) as ends, shiftleft(1L, start + size) - shiftleft(2L, start) as inside)"
    )
    return edge.select("word", rank.alias("edge")).groupBy("word").agg(F.sort_array(F.collect_list("edge")).alias("edges"))


# one merge: the edge's ends are cuts, and exactly one cut lies inside
_JOINS = "(cuts & e.ends) = e.ends and bit_count(cuts & e.inside) = 1"


def _fold_bpe(edges: DataFrame) -> DataFrame:
    """Cuts of each word (a bit mask over 0 .. n) after all merges.

    One pass over the edges from the best score on makes the model's merges in the model's order,
    unless a merge opens a better one that was passed already.  Only pieces marked ``opens`` can
    do that, and only where the word has a better edge over them; such words (bit 62 of the state)
    are folded again, taking the best open edge each time.
    """
    x = edges.selectExpr("word", "edges", "length(word) as n", "filter(edges, e -> e.end - e.start > 1) as joins")
    better = "exists(joins, f -> f.rank < e.rank and ((f.start = e.start and f.end > e.end) or (f.end = e.end and f.start < e.start)))"
    once = (
        f"aggregate(joins, shiftleft(1L, n) * 2L - 1L, (cuts, e) -> if({_JOINS}, "
        f"(cuts & ~e.inside) | if(e.opens and {better}, shiftleft(1L, 62), 0L), cuts))"
    )
    best = f"get(filter(joins, e -> {_JOINS}), 0)"
    full = f"aggregate(if(n > 1, sequence(1, n - 1), array()), shiftleft(1L, n) * 2L - 1L, (cuts, k) -> coalesce(cuts & ~{best}.inside, cuts))"
    x = x.selectExpr("word", "edges", "n", "joins", f"{once} as once")
    return x.selectExpr("word", "edges", f"if(once >= shiftleft(1L, 62), {full}, once) as cuts")


def _fold_viterbi(edges: DataFrame, low: float) -> DataFrame:
    """Best path by a fold over end positions: state i is (score, start) of the best way to position i."""
    into = f"transform(filter(edges, x -> x.end = i), x -> struct(acc[x.start].score + if(x.piece_id is null, {low}D, -x.rank) as score, x.start as start))"
    # of equal scores the smaller start, the longer piece, comes first
    best = f"array_sort({into}, (l, r) -> case when l.score > r.score then -1 when l.score < r.score then 1 when l.start < r.start then -1 when l.start > r.start then 1 else 0 end)[0]"
    acc = f"aggregate(sequence(1, n), array(struct(0D as score, 0 as start)), (acc, i) -> concat(acc, array({best})))"
    x = edges.selectExpr("word", "edges", "length(word) as n").selectExpr("word", "edges", "n", f"{acc} as acc")
    back = "aggregate(sequence(1, n), array(n), (cuts, k) -> if(cuts[0] = 0, cuts, concat(array(acc[cuts[0]].start), cuts)))"
    x = x.selectExpr("word", "edges", f"{back} as at")
    return x.selectExpr("word", "edges", "aggregate(at, 0L, (m, i) -> m | shiftleft(1L, i)) as cuts")


def encode_words(words: DataFrame, vocabulary: Pieces) -> DataFrame:
    """(word, ids) of distinct words of at most LONGEST characters."""
    spark = words.sparkSession
    edges = lattice(words, vocabulary.table(spark), vocabulary.longest)
    low = min((s for _, _, s in vocabulary.pieces), default=0.0) - 10
    cut = _fold_viterbi(edges, low) if vocabulary.fold == "unigram" else _fold_bpe(edges)
    # the word's pieces are the edges that reach from one cut to the next
    path = "sort_array(transform(filter(edges, e -> (cuts & e.ends) = e.ends and (cuts & e.inside) = 0), e -> struct(e.start, e.piece_id)))"
    if vocabulary.byte_ids:
        table = f"array({', '.join(map(str, vocabulary.byte_ids))})"
        utf8 = "encode(substring(word, x.start + 1, 1), 'UTF-8')"
        unknown = f"transform(sequence(1, octet_length({utf8})), k -> get({table}, cast(conv(hex(substring({utf8}, k, 1)), 16, 10) as int)))"
    else:
        unknown = f"array({vocabulary.unknown})"
    cut = cut.selectExpr("word", f"{path} as path")
    known = "not exists(path, x -> x.piece_id is null)"
    spelled = f"flatten(transform(path, x -> if(x.piece_id is null, {unknown}, array(x.piece_id))))"
    return cut.selectExpr("word", f"if({known}, path.piece_id, {spelled}) as ids")


def _chunk_id(chunk: int) -> int:
    """Number of a partition's chunk; a rescan of the same partitions gives the same numbers."""
    from pyspark import TaskContext

    return (TaskContext.get().partitionId() << 20) | min(chunk, (1 << 20) - 1)


def _chunk_words(vocabulary, chunk_chars: int):
    """Distinct words of each chunk of consecutive documents."""

    def run(batches):
        tidy_worker()
        v = vocabulary.value
        chunk, chars, held, units = 0, 0, set(), set()
        plain, marks = not any(c.isalpha() for c in v.apart) and v.pattern.pattern != _WHOLE, frozenset(",.")

        def rows():
            for u in units:
                if u.isalpha() and plain:
                    held.add(SPACE + u)
                elif u[-1:] in marks and u[:-1].isalpha() and plain:
                    held.add(SPACE + u[:-1])
                    held.add(u[-1])
                else:
                    held.update(v.pattern.findall(SPACE + u))
            words, block = [w for w in held if len(w) <= LONGEST], _chunk_id(chunk)
            for at in range(0, len(words), 20_000):
                part = words[at : at + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([block] * len(part), pa.int64())], names=["word", "block"])

        for b in batches:
            for t in b.column("text"):
                text = t.as_py()
                parts, behind_space = v.units(text)
                (units if behind_space else held).update(parts)
                chars += len(text)
                if chars >= chunk_chars:
                    yield from rows()
                    chunk, chars, held, units = chunk + 1, 0, set(), set()
        yield from rows()
        held.clear()
        units.clear()
        tidy_worker()

    return run


_ROWS = 120_000


def _blob(words: pa.Array, ids: np.ndarray, counts: np.ndarray, wide: bool) -> bytes:
    """Words and their ids, compressed: number, lengths, counts, words, ids."""
    off = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4)
    data = words.buffers()[2].slice(int(off[0]), int(off[-1] - off[0])).to_pybytes()
    head = [np.array([len(words)], "<u4"), np.diff(off).astype(np.uint8), counts.astype(np.uint8)]
    raw = b"".join([*(x.tobytes() for x in head), data, ids.astype("<u4" if wide else "<u2").tobytes()])
    return np.array([len(raw)], "<u4").tobytes() + pa.Codec("zstd", compression_level=6).compress(raw, asbytes=True)


def _unblob(blob: bytes, wide: bool) -> dict[str, bytes]:
    """Word -> little-endian 32-bit ids."""
    raw = pa.Codec("zstd").decompress(blob[4:], decompressed_size=int.from_bytes(blob[:4], "little"), asbytes=True)
    n = int.from_bytes(raw[:4], "little")
    size, count = np.frombuffer(raw, np.uint8, n, 4).astype(np.int64), np.frombuffer(raw, np.uint8, n, 4 + n).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(size)]) + 4 + 2 * n
    ids = np.frombuffer(raw, "<u4" if wide else "<u2", int(count.sum()), int(at[-1])).astype("<i4").tobytes()
    off = (np.concatenate([[0], np.cumsum(count)]) * 4).tolist()
    at = at.tolist()
    return {raw[at[i] : at[i + 1]].decode("utf-8", "surrogatepass"): ids[off[i] : off[i + 1]] for i in range(n)}


def _pack(wide: bool):
    """Words and ids as compressed records, one per chunk for every so many rows."""

    def flush(held: list):
        rows = pa.Table.from_batches(held).combine_chunks()
        block = rows.column("block").to_numpy()
        order = np.argsort(block, kind="stable")
        block = block[order]
        words = rows.column("word").chunk(0)
        column = rows.column("ids").chunk(0)
        flat, off = column.values.to_numpy(), column.offsets.to_numpy().astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
        keys, blobs = [], []
        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
            at = order[s:e]
            n = off[at + 1] - off[at]
            ids = flat[np.repeat(off[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            keys.append(int(block[s]))
            blobs.append(_blob(words.take(pa.array(at)), ids, n, wide))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], names=["block", "packed"])

    def run(batches):
        tidy_worker()
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= _ROWS:
                yield flush(held)
                held, n = [], 0
        if held:
            yield flush(held)

    return run


_PACKED = pa.schema([("packed", pa.binary())])


def _write_chunks(folder: str):
    """One file of packed words for each chunk; rows come sorted by chunk.  A repeated task writes the same again."""

    def run(batches):
        block, sink, tmp = None, None, ""
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)

        def close():
            sink[1].close()
            sink[0].close()
            put_in_place(fs, tmp, f"{base}/{block}.words")
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64())], names=["block"])

        for b in batches:
            for k, packed in zip(b.column("block").to_pylist(), b.column("packed")):
                if k != block:
                    if sink:
                        yield close()
                    block, tmp = k, f"{base}/{k}.{uuid.uuid4().hex}.tmp"
                    out = fs.open_output_stream(tmp, compression=None)
                    sink = (out, pa.ipc.new_stream(out, _PACKED))
                sink[1].write_batch(pa.RecordBatch.from_arrays([pa.array([packed.as_py()], pa.binary())], schema=_PACKED))
        if sink:
            yield close()

    return run


class _Behind(dict):
    """Ids of the parts that stand behind a space, the space left out."""

    def __init__(self, vocabulary: Pieces, words: dict):
        super().__init__()
        self.vocabulary, self.words, self.room = vocabulary, words, KEPT_UNITS

    def __missing__(self, unit: str) -> bytes:
        last = unit[-1:]
        if last in self.words and last in ",." and unit[-2:-1].isalpha() and unit[:-1] in self and unit[-2] not in self.vocabulary.apart:
            ids = self[unit[:-1]] + self.words[last]
        else:
            parts = self.vocabulary.pattern.findall(SPACE + unit)
            first = self.words[parts[0]] if len(parts) == 1 or parts[0] == SPACE else self[parts[0][1:]]
            ids = first + b"".join(map(self.words.__getitem__, parts[1:]))
        if self.room:  # what a chunk's words do not make up is kept up to a bound
            self.room -= 1
            self[unit] = ids
        return ids


class _Ids(dict):
    """Words' little-endian 32-bit ids as a chunk's file gives them; others are folded here.

    Others are long words, and words of rows that an upstream plan gave in another order.  Words
    with one space in front are in ``behind``.
    """

    def __init__(self, vocabulary: Pieces, folder: str, block: int):
        import pyarrow.fs as pafs

        super().__init__()
        self.vocabulary, self.behind = vocabulary, _Behind(vocabulary, self)
        fs, base = open_fs(folder)
        path = f"{base}/{block}.words"
        if fs.get_file_info(path).type != pafs.FileType.NotFound:
            with fs.open_input_stream(path, compression=None) as f, pa.ipc.open_stream(f) as rows:
                for row in rows:
                    for blob in row.column("packed"):
                        for w, ids in _unblob(blob.as_py(), vocabulary.wide).items():
                            if w[0] == SPACE and w[1:2] not in ("", SPACE):
                                self.behind[w[1:]] = ids
                            else:
                                self[w] = ids

    def drop(self) -> None:
        """Free the words; the two dictionaries know each other, so they would stay until the collector comes by."""
        self.behind.clear()
        self.behind.words = None
        self.clear()

    def __missing__(self, word: str) -> bytes:
        if word[0] == SPACE and word[1:] in self.behind:
            return self.behind[word[1:]]
        ids = self[word] = np.array(self.vocabulary.fold_long(word), "<i4").tobytes()
        return ids


_FULL = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_pieces", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])
_DIGEST = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("decoded_crc32", pa.int64()), ("exact", pa.bool_())]
)


def _encode_texts(vocabulary, folder: str, chunk_chars: int, digest: bool):
    schema = _DIGEST if digest else _FULL

    def run(batches):
        tidy_worker()
        v = vocabulary.value
        chunk, chars = 0, 0
        known = _Ids(v, folder, _chunk_id(0))

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

        for b in batches:
            rows, held = [], 0
            for doc_id, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
                text = t.as_py()
                parts, behind_space = v.units(text)
                ids = b"".join(map((known.behind if behind_space else known).__getitem__, parts))
                decoded = v.decode(np.frombuffer(ids, "<i4"))
                found = (zlib.crc32(ids), zlib.crc32(decoded.encode("utf-8", "surrogatepass")), decoded == text) if digest else (ids, decoded)
                rows.append((doc_id, len(text), len(ids) // 4, *found))
                held += len(text)
                chars += len(text)
                if held >= 1 << 20:
                    yield batch(rows)
                    rows, held = [], 0
                if chars >= chunk_chars:
                    chunk, chars = chunk + 1, 0
                    known.drop()  # before the next chunk's are read
                    known = _Ids(v, folder, _chunk_id(chunk))
            if rows:
                yield batch(rows)
        known.drop()
        tidy_worker()

    return run


def encode(docs: DataFrame, vocabulary: Pieces, chunk_chars: int = 12_000_000, digest: bool = False, shares: int = 1) -> DataFrame:
    """(doc_id, n_chars, n_pieces, ids, decoded) of every document; ids as little-endian 32-bit integers.

    With ``digest``: (doc_id, n_chars, n_pieces, ids_crc32, decoded_crc32, exact) instead of ids
    and decoded text; ``exact`` says that decoding gave back the text.  A task of the lattice sorts
    all edges of its words: ``shares`` times the session's shuffle partitions get the words.
    """
    spark = docs.sparkSession
    texts = doc_texts(docs)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(vocabulary)
    folder = shared_path(spark, "op1-words")
    # the shuffle by word is read twice; equal columns let Spark reuse it
    by_word = texts.select("text").mapInArrow(_chunk_words(shared, chunk_chars), "word string, block bigint").repartition(shares * width, "word")
    words = by_word.groupBy("word").agg(F.count("block").alias("blocks")).where("blocks > 0").select("word")
    packed = by_word.join(encode_words(words, vocabulary), "word").select("block", "word", "ids").mapInArrow(_pack(vocabulary.wide), "block bigint, packed binary")
    packed.repartition(width, "block").sortWithinPartitions("block").mapInArrow(_write_chunks(folder), "block bigint").count()
    schema = "doc_id bigint, n_chars bigint, n_pieces bigint, " + ("ids_crc32 bigint, decoded_crc32 bigint, exact boolean" if digest else "ids binary, decoded string")
    return texts.mapInArrow(_encode_texts(shared, folder, chunk_chars, digest), schema)
