"""Token-id output: binary shards of raw ids, each with a minimal perfect hash index of its documents.

Documents are dealt to range partitions of ascending (doc_id, text hash), sorted, encoded and
written as shards; a shard ends where its payload reaches ``SHARD_TOKENS``.  File layout, little
endian, all sections at computable places:

    header      8s magic, u32 bytes per id, u32 levels, u64 rows, u64 keys, u64 tokens
    levels      u64 size of each level's bit array
    bits        the levels' bit arrays, packed, one byte string of ceil(sum / 8) bytes
    fingerprint u32 x keys      by slot
    first row   u32 x keys      by slot
    row count   u32 x keys      by slot
    doc ids     i64 x rows      in file order
    offsets     u64 x rows + 1  token offsets
    payload     ids

The index is a minimal perfect hash: level by level, keys that fall on a bit of their own take
it, the others go to the next level; a key's slot is the number of set bits before its own.  A
stored fingerprint turns strange keys away.  A lookup reads a few bits, one slot and one run of
ids, whatever the shard's size.

The manifest table (one row a shard: path, key range, rows, tokens) names the files that
committed tasks wrote; file names carry a unique suffix, so a repeated task leaves an unnamed
file and no harm.  Files go to the shared folder through ``pyarrow.fs``.

Encoding: a text's ids are those of its pieces between ASCII white space, which the tokenizer
never joins (its splitter stops at white space); each distinct piece is encoded once per worker.

Defined cases: null or empty text: the end id alone.  A null doc_id is stored under the key
-2**63 (not a doc_id), sorted first, and returned as null.  Rows that repeat a doc_id are rows of their own,
ordered by text hash, found together under their key (in neighbouring shards where one ends
between them).  Empty table: no shard, empty result.
"""

from __future__ import annotations

import struct
import unicodedata
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thawline.llm.common import U64, mix, saved, shared_path, small_batches

MAGIC = b"THAWIDS1"
HEAD = struct.Struct("<8sIIQQQ")
SHARD_TOKENS = 16_000_000
SHARD_CHARS = 24_000_000
NULL_KEY = -(2**63)
GAMMA = 1.7


def _level_bit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    h = mix(keys.view(np.uint64) + U64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    return (h % U64(size)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.view(np.uint64) ^ U64(0xA5A5A5A55A5A5A5A)) >> U64(32)).astype(np.uint32)


class PerfectHash:
    """Minimal perfect hash of distinct int64 keys: slot in 0 .. n - 1 for every key."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, parts, left = [], [], keys
        while len(left):
            size = max(int(len(left) * GAMMA), 2)
            at = _level_bit(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(alone)
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(parts) if parts else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level holds it (a strange key may get any slot)."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = self.base[level] + _level_bit(keys[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.before[at[hit]]
            left = left[~hit]
        return out


def pack(doc_ids: np.ndarray, offsets: np.ndarray, payload: bytes, id_bytes: int) -> bytes:
    """A shard's bytes; ``doc_ids`` ascending, ``offsets`` in tokens, one more than rows."""
    keys, first, count = np.unique(doc_ids, return_index=True, return_counts=True)
    index = PerfectHash.build(keys)
    slot = index.slots(keys)
    by_slot = np.argsort(slot, kind="stable")
    out = [HEAD.pack(MAGIC, id_bytes, len(index.sizes), len(doc_ids), len(keys), int(offsets[-1]))]
    out.append(np.array(index.sizes, "<u8").tobytes())
    out.append(np.packbits(index.bits, bitorder="little").tobytes())
    out += [fingerprints(keys)[by_slot].astype("<u4").tobytes(), first[by_slot].astype("<u4").tobytes(), count[by_slot].astype("<u4").tobytes()]
    out += [doc_ids.astype("<i8").tobytes(), offsets.astype("<u8").tobytes(), payload]
    return b"".join(out)


class Shard:
    """Keyed access to the bytes of one shard."""

    def __init__(self, data):
        magic, self.id_bytes, levels, self.rows, n_keys, self.tokens = HEAD.unpack_from(data, 0)
        if magic != MAGIC:
            raise ValueError("not a token-id shard")
        at = HEAD.size

        def section(dtype, n):
            nonlocal at
            x = np.frombuffer(data, dtype, n, at)
            at += x.nbytes
            return x

        sizes = section("<u8", levels).astype(np.int64).tolist()
        bits = np.unpackbits(section(np.uint8, -(-sum(sizes) // 8)), count=sum(sizes), bitorder="little").astype(bool)
        self.index = PerfectHash(sizes, bits)
        self.fingerprint, self.first, self.count = section("<u4", n_keys), section("<u4", n_keys), section("<u4", n_keys)
        self.doc_ids, self.offsets = section("<i8", self.rows), section("<u8", self.rows + 1).astype(np.int64)
        self.ids = section("<u2" if self.id_bytes == 2 else "<u4", self.tokens)

    def rows_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first row, row count) of each key; count 0 for keys that are not stored."""
        slot = self.index.slots(keys)
        safe = np.maximum(slot, 0)
        known = (slot >= 0) & (self.fingerprint[safe] == fingerprints(keys)) if len(self.fingerprint) else np.zeros(len(keys), bool)
        return np.where(known, self.first[safe], 0).astype(np.int64), np.where(known, self.count[safe], 0).astype(np.int64)

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The id arrays of the rows stored under ``doc_id``."""
        if not self.rows:
            return []
        first, n = self.rows_of(np.array([NULL_KEY if doc_id is None else doc_id], np.int64))
        return [self.ids[self.offsets[r] : self.offsets[r + 1]] for r in range(int(first[0]), int(first[0] + n[0]))]


def _byte_chars() -> dict[int, str]:
    """Byte-level alphabet: visible Latin-1 characters stand for their own bytes, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}


_BYTE_CHARS = _byte_chars()


class Encoder(dict):
    """Ids of white-space-free pieces, remembered per worker; emptied when the memory has grown large.

    A piece of plain Latin letters is one word to the tokenizer's splitter, so the tokenizer's
    model is asked directly for its lower-case form; a capital or a closing stop or comma goes
    back to that word.  Every other piece goes through the whole tokenizer.
    """

    LIMIT = 700_000
    _made: dict = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.id_bytes = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.plain = self._plain_words()
        self.stops = {b",": self._whole(b","), b".": self._whole(b".")}

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _plain_words(self) -> bool:
        """Whether this tokenizer lowers its text, splits at letters and maps bytes one to one."""
        probe = ["aba", "Thé", "straße,", "Ünd."]
        return all(
            self._whole(w.encode()) == self._word(w.rstrip(".,").lower().encode()) + (self._whole(w[-1].encode()) if w[-1] in ".," else b"") for w in probe
        )

    def _packed(self, ids: list[int]) -> bytes:
        return array("H" if self.id_bytes == 2 else "I", ids).tobytes()

    def _whole(self, piece: bytes) -> bytes:
        return self._packed(self.tokenizer.encode(piece.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def _word(self, word: bytes) -> bytes:
        text = word.decode("ascii") if word.isascii() else word.decode("latin-1").translate(_BYTE_CHARS)
        return self._packed([t.id for t in self.model.tokenize(text)])

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= self.LIMIT:
            self.clear()
        stop = piece[-1:] if self.plain and piece[-1] in b",." else b""
        word = piece[:-1] if stop else piece
        low = _plain_lower(word) if self.plain else None
        if low is None:
            ids = self._whole(piece)
        elif low == piece:
            ids = self._word(low)
        else:
            ids = self[low] + self.stops[stop] if stop else self[low]
        self[piece] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """Little-endian ids of a text."""
        return b"".join(map(self.__getitem__, text.split()))


def _plain_lower(word: bytes) -> bytes | None:
    """Lower-case form of a word of Latin letters; None for anything else."""
    if word.isalpha():  # ASCII letters only
        return word.lower()
    if word.isascii() or not word:
        return None
    text = word.decode("utf-8", "replace")
    low = text.lower()
    if not low.isalpha() or max(low) > "\u024f" or len(low) != len(text) or not unicodedata.is_normalized("NFC", low):
        return None
    return low.encode("utf-8")


_MANIFEST = "partition int, part int, path string, low bigint, high bigint, n_rows bigint, n_tokens bigint"


def _writer(folder: str, tokenizer_path: str, end_id: int, shard_tokens: int):
    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyarrow import fs
        from pyspark import TaskContext

        enc = Encoder.of(tokenizer_path)
        end = np.array([end_id], f"<u{enc.id_bytes}").tobytes()
        store, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        partition, part = TaskContext.get().partitionId(), 0
        keys, chunks, held = [], [], 0

        def flush():
            nonlocal keys, chunks, held, part
            lens = np.array([len(c) for c in chunks], np.int64) // enc.id_bytes
            offsets = np.concatenate([[0], np.cumsum(lens)])
            data = pack(np.array(keys, np.int64), offsets, b"".join(chunks), enc.id_bytes)
            path = f"{base}/shard-{partition:06d}-{part:04d}-{uuid.uuid4().hex}.ids"
            store.create_dir(base, recursive=True)
            with store.open_output_stream(path) as out:
                out.write(data)
            row = [partition, part, path, keys[0], keys[-1], len(keys), int(offsets[-1])]
            keys, chunks, held, part = [], [], 0, part + 1
            types = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=[f.split()[0] for f in _MANIFEST.split(", ")])

        for b in batches:
            ids, texts = b.column("key"), b.column("text").cast(pa.binary())
            for k, text in zip(ids.to_pylist(), texts):
                keys.append(k)
                chunks.append(enc.encode(text.as_py()) + end)
                held += len(chunks[-1])
                if held >= shard_tokens * enc.id_bytes:
                    yield flush()
        if keys:
            yield flush()

    return run


def write_shards(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, folder: str | None = None, shard_tokens: int = SHARD_TOKENS, shard_chars: int = SHARD_CHARS
) -> DataFrame:
    """Write all documents as shards in ascending doc_id order; returns the manifest.

    Manifest: partition, part, path, low, high, n_rows, n_tokens, start (ids before the shard).
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or shared_path(spark, "token-ids")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_KEY)).alias("key"), F.xxhash64(text).alias("tie"), text.alias("text"))
    chars = keyed.agg(F.sum(F.length("text"))).first()[0] or 0
    dealt = keyed.repartitionByRange(max(1, -(-chars // shard_chars)), "key", "tie").sortWithinPartitions("key", "tie")
    wrote = dealt.select("key", "text").mapInArrow(_writer(folder, tokenizer_path, end_id, shard_tokens), _MANIFEST)
    manifest = saved(wrote, "token-ids-manifest")
    before = Window.orderBy("partition", "part").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _reader(scheme_of: str):
    def run(batches):
        from pyarrow import fs

        store = fs.FileSystem.from_uri(scheme_of)[0] if "://" in scheme_of or scheme_of.startswith("file:") else fs.LocalFileSystem()
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                with store.open_input_stream(path) as f:
                    shard = Shard(f.read())
                keys = np.unique(shard.doc_ids)
                first, count = shard.rows_of(keys)
                row = np.concatenate([np.arange(f, f + n) for f, n in zip(first.tolist(), count.tolist())]) if len(keys) else np.zeros(0, np.int64)
                ids = [shard.ids[shard.offsets[r] : shard.offsets[r + 1]] for r in row.tolist()]
                key = np.repeat(keys, count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, mask=key == NULL_KEY), pa.array(start + shard.offsets[row]), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def read_digests(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document, by keyed access to the files."""
    spark = manifest.sparkSession
    shards = max(1, manifest.count())
    spread = manifest.select("path", "start").repartition(shards, "path")
    return spread.mapInArrow(_reader(shared_path(spark, "x")), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
