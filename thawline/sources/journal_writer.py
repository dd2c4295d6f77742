"""Materialise a frozen-bucket tree from an event table (a Spark job; used for round-trip checks and the bench).

Rows are shuffled by bucket and sorted within partitions, then one
``mapInPandas`` task streams each bucket's events into its journal file with a
zstd stream writer (bounded memory, never a whole bucket in one pandas frame).
Files are written under a temporary name and renamed, so a retried task
leaves exactly one journal.  Buckets that hold no events get a header-only
journal.  Injected variety (all by ``event_id``): event opcode 1/2/34/38,
a stream id of 2**63 and more on every 29th,
metadata on every fifth event (a repeated key on every tenth), a dangling
metadata id on every 23rd, delete / hash-slice / private / NOP blocks, junk low
bit in the sub-seconds, Latin-1 message bytes on every 17th, and two zstd
frames in buckets whose sequence is a multiple of 5.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from thawline.operators import runs as R
from thawline import storage
from thawline.session import checkpoint_dir
from thawline.sources import journal_codec as J
from thawline.storage import open_fs, put_in_place

EVENT_OPS = (J.EVENT, J.EVENT_HASH, 34, 38)
SUMMARY = "bucket_key STRING, journal_path STRING, n_events BIGINT"


def journal_path(root: str, index_name: str, bucket_name: str) -> str:
    return os.path.join(root, index_name, bucket_name, "rawdata", "journal.zst")


def _write_file(path: str, chunks, two_frames: bool) -> None:
    import zstandard

    fs, inner = open_fs(path)
    fs.create_dir(os.path.dirname(inner), recursive=True)
    tmp = f"{inner}.tmp-{uuid.uuid4().hex}"
    with fs.open_output_stream(tmp, compression=None) as fh:
        cctx = zstandard.ZstdCompressor(level=3)
        w = cctx.stream_writer(fh, closefd=False)
        for i, c in enumerate(chunks):
            w.write(c)
            if two_frames and i == 0:
                w.flush(zstandard.FLUSH_FRAME)
        w.flush(zstandard.FLUSH_FRAME)
    put_in_place(fs, tmp, inner)


def _writer_task(root: str):
    def run(batches):
        import pandas as pd

        state = {"key": None, "w": None, "n": 0, "chunks": [], "meta": None}
        out = []

        def finish():
            if state["key"] is None:
                return
            idx, bucket, seq = state["meta"]
            w = state["w"]
            chunks = state["chunks"] + [w.getvalue()]
            path = journal_path(root, idx, bucket)
            _write_file(path, chunks, two_frames=(seq % 5 == 0))
            out.append((f"{idx}/{bucket}", path, state["n"]))

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                key = (r.index_name, r.bucket_name)
                if key != state["key"]:
                    finish()
                    state.update(key=key, w=J.JournalWriter(int(r.bucket_earliest)), n=0, chunks=[],
                                 meta=(r.index_name, r.bucket_name, int(r.bucket_seq)))
                w = state["w"]
                eid = int(r.event_id)
                fields = []
                if eid % 5 == 0:
                    fields.append(("user", f"u{eid % 7}"))
                    if eid % 10 == 0:
                        fields.append(("user", "again"))
                msg = r.message
                raw = msg.encode("utf-8")
                if eid % 17 == 0:
                    try:
                        raw = msg.encode("latin-1")
                    except UnicodeEncodeError:
                        pass
                w.event(EVENT_OPS[eid % 4], r.host, r.source, r.sourcetype, int(r.index_time), int(r.event_time_ms),
                        raw, int(r.index_time) % 1000 + (2**63 if eid % 29 == 0 else 0), int(r.event_time_ms) // 1000, 0, fields, junk_bit=eid % 2)
                if eid % 23 == 0:
                    # a metadata pair whose value id is 0 (dangling): decoded as an extraction error
                    w.parts[-1] = _with_bad_meta(w.parts[-1])
                tail = eid % 50
                if tail == 0:
                    w.block(J.DELETE, b"dead" + bytes([eid % 256]))
                elif tail == 1:
                    w.block(J.HASH_SLICE, b"x" * 8)
                elif tail == 2:
                    w.block(J.PRIVATE, b"p")
                elif tail == 3:
                    w.parts.append(bytes([J.NOP]))
                state["n"] += 1
                if len(w.parts) > 4096:
                    state["chunks"].append(w.getvalue())
                    w.parts = []
        finish()
        yield pd.DataFrame(out, columns=["bucket_key", "journal_path", "n_events"])

    return run


def _with_bad_meta(event_bytes: bytes) -> bytes:
    """Re-encode one event op with an extra metadata pair (key id 1, value id 0)."""
    op = event_bytes[0]
    length, p = J._uvarint(event_bytes, 1, len(event_bytes))
    body = bytearray(event_bytes[p:p + length])
    q = 0
    if op & 4 and op >= 32:
        _, q = J._uvarint(body, q, len(body))
    if (op & 1) == 0:
        q += J.HASH_SIZE
    q += 8
    for _ in range(4):
        _, q = J._uvarint(body, q, len(body))
    nmeta, q2 = J._uvarint(body, q, len(body))
    key = 1 << 1 if op <= 2 else (1 << 2 if op < 36 else 1 << 4)
    # the new pair goes first, right after the count
    new = bytes(body[:q]) + J._enc_uv(nmeta + 1) + J._enc_uv(key) + J._enc_uv(0) + bytes(body[q2:])
    return bytes([op]) + J._enc_uv(len(new)) + new


def write_journals(raw: DataFrame, root: str, n_parts: int | None = None) -> DataFrame:
    """Spark job: one journal per bucket under ``root``; returns (bucket_key, journal_path, n_events)."""
    spark = raw.sparkSession
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = ["index_name", "bucket_name", "bucket_earliest", "bucket_seq", "event_id", "event_time_ms", "index_time",
            "host", "source", "sourcetype", "message"]
    srt = raw.select(*cols).repartition(n, "index_name", "bucket_name").sortWithinPartitions(
        "index_name", "bucket_name", "event_time_ms", "event_id")
    written = srt.mapInPandas(_writer_task(root), SUMMARY)
    # header-only journals for listed buckets without events (derived from the per-bucket
    # aggregate, not from ``written``, so the writer job runs once)
    buckets = R.buckets_of(raw)
    listing = R.listing_with_empty(buckets)
    empty = listing.join(buckets.select("bucket_key"), "bucket_key", "left_anti")

    def write_empty(rows):
        import pandas as pd

        out = []
        for pdf in rows:
            for r in pdf.itertuples(index=False):
                p = journal_path(root, r.index_name, r.bucket_name)
                _write_file(p, [J.JournalWriter(int(r.bucket_earliest)).getvalue()], False)
                out.append((r.bucket_key, p, 0))
        yield pd.DataFrame(out, columns=["bucket_key", "journal_path", "n_events"])

    return written, empty.select("bucket_key", "index_name", "bucket_name", "bucket_earliest").mapInPandas(
        write_empty, SUMMARY)


def add_decoys(root: str) -> None:
    """Directories and files the listing must ignore (hot bucket, replicated bucket, no journal, stray file)."""
    from pyarrow.fs import FileSelector, FileType

    fs, inner = open_fs(root)
    idx = sorted(i.base_name for i in fs.get_file_info(FileSelector(inner)) if i.type == FileType.Directory)[0]
    for d in ("hot_v1_0", "rb_1700000000_1690000000_0_ABC", "db_hot_v1"):
        p = f"{inner}/{idx}/{d}/rawdata"
        fs.create_dir(p, recursive=True)
        with fs.open_output_stream(f"{p}/journal.zst", compression=None) as fh:
            fh.write(b"not a journal")
    fs.create_dir(f"{inner}/{idx}/db_1_0_0/rawdata", recursive=True)
    with fs.open_output_stream(f"{inner}/{idx}/stray.txt") as fh:
        fh.write(b"x")


def ensure_journals(spark: SparkSession, sf_dir: str, raw: DataFrame) -> str:
    """Journal tree of ``sf_dir``'s corpus in the shared folder, written once (``_SUCCESS`` marker)."""
    import inspect
    import sys

    # a changed input, writer or codec never reuses an old tree
    code = [inspect.getsource(m).encode() for m in (sys.modules[__name__], J)]
    tag = storage.fingerprint(spark, f"{sf_dir}/events.parquet", *code)
    root = f"{checkpoint_dir(spark).rstrip('/')}/thawline-journals/{tag}"
    if storage.exists(spark, f"{root}/_SUCCESS"):
        return root
    written, empty = write_journals(raw, root)
    written.count()
    empty.count()
    add_decoys(root)
    storage.write_text(spark, f"{root}/_SUCCESS", "ok")
    return root


def _cut_inside_event(data: bytes) -> bytes:
    """Shortest cut from the end (at least one byte) that leaves an event unfinished."""
    for cut in range(len(data) - 1, len(data) // 2, -1):
        try:
            list(J.decode_ops([data[:cut]]))
        except J.JournalError:
            return data[:cut]
    return data[:-1]


def corrupt_copy(spark: SparkSession, root: str) -> str:
    """Copy of the whole tree where every journal with ``sequence % 7 == 0`` is cut inside an event.

    A Spark job over the listing: each task copies its journals (decompress,
    maybe cut, recompress, rename), so no journal passes through the driver.
    """
    from thawline.sources.buckets import list_buckets

    out = root.rstrip("/") + "-corrupt-v3"
    if storage.exists(spark, f"{out}/_SUCCESS"):
        return out

    def copy(batches):
        import pandas as pd
        import zstandard

        done = []
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                fs, inner = open_fs(r.journal_path)
                with fs.open_input_stream(inner, compression=None) as fh:
                    data = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True).read()
                cut = r.sequence % 7 == 0 and len(data) > 16
                if cut:
                    data = _cut_inside_event(data)
                dst = journal_path(out, r.index_name, r.bucket_name)
                _write_file(dst, [data], False)
                done.append((f"{r.index_name}/{r.bucket_name}", dst, int(cut)))
        yield pd.DataFrame(done, columns=["bucket_key", "journal_path", "n_events"])

    lst = list_buckets(spark, root).select("index_name", "bucket_name", "sequence", "journal_path")
    lst.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInPandas(copy, SUMMARY).count()
    storage.write_text(spark, f"{out}/_SUCCESS", "ok")
    return out
