"""``frozen_journal``: Spark data source over a tree of frozen buckets.

    <root>/<index>/db_<latest>_<earliest>_<seq>/rawdata/journal.zst

One input partition per journal (a journal is one stateful zstd stream and
cannot be split), largest journals first so the long tasks start early.
Readers run in executors and yield Arrow record batches.

Options:
  path          bucket tree root (or ``paths``: JSON list of journal files, or ``pathsDir``: a
                directory of text files with one journal path per line, e.g. written by Spark)
  emit          ``events`` (default, dictionary/state replayed) or ``ops`` (one row per opcode)
  columns       comma list of the event columns to build (default all); others are neither
                built nor sent to Spark
  skipMetadata  ``true`` (default): walk metadata without mapping it (no ``fields``)
  mode          ``FAILFAST`` (default) or ``PERMISSIVE`` (a bad journal becomes one row with
                ``_corrupt_reason``; the events decoded before the fault are kept)
  indices / buckets   comma lists to prune journals (``index_name`` / ``bucket_name``
                filters of type ``=`` and ``IN`` are also pushed down when
                ``spark.sql.python.filterPushdown.enabled`` is true)
"""

from __future__ import annotations

import json
import os
import re

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

BUCKET_DIR = re.compile(r"^db_(\d+)_(\d+)_(\d+)$")
BATCH_ROWS = 8192
BATCH_BYTES = 8 << 20  # a batch is flushed at 8192 rows or 8 MiB of message bytes, whichever first

EVENT_SCHEMA = (
    "journal_path STRING, index_name STRING, bucket_name STRING, bucket_latest BIGINT, bucket_earliest BIGINT, "
    "event_ordinal BIGINT, index_time BIGINT, event_time_ms BIGINT, message BINARY, host STRING, source STRING, "
    "sourcetype STRING, stream_id DECIMAL(20,0), stream_offset BIGINT, stream_sub_offset BIGINT, has_hash BOOLEAN, "
    "hash BINARY, include_punctuation BOOLEAN, fields MAP<STRING, ARRAY<STRING>>, extraction_errors ARRAY<STRING>, "
    "_corrupt_reason STRING"
)
EVENT_COLUMNS = dict(re.findall(r"(\w+) ((?:[A-Z]+)(?:<.*?>+|\([0-9,]+\))?)(?:, |$)", EVENT_SCHEMA))
OPS_SCHEMA = (
    "journal_path STRING, index_name STRING, bucket_name STRING, ord BIGINT, opcode INT, text STRING, "
    "state_host BIGINT, state_source BIGINT, state_sourcetype BIGINT, base_event_time INT, base_index_time INT, "
    "stream_id DECIMAL(20,0), stream_offset BIGINT, stream_sub_offset BIGINT, index_time_diff BIGINT, "
    "time_sub_raw BIGINT, meta ARRAY<STRUCT<key: BIGINT, value: BIGINT>>, message BINARY, block_length BIGINT, "
    "_corrupt_reason STRING"
)


def _fs(path: str):
    """(pyarrow filesystem, path inside it) for URI paths; None for plain or ``file:`` paths."""
    if "://" not in path or path.startswith("file:"):
        return None
    import pyarrow.fs as pafs

    uri = "s3://" + path[len("s3a://"):] if path.startswith("s3a://") else path
    return pafs.FileSystem.from_uri(uri)


def discover(root: str, indices=None, buckets=None) -> list[tuple[str, str, int, int, int, str, int]]:
    """(index, bucket, latest, earliest, seq, journal path, size) for ``root/<index>/db_*/rawdata/journal.zst``.

    ``indices`` / ``buckets`` prune while walking: other index directories are never listed and
    other bucket directories never stat'ed.
    """
    root = "/" + root[len("file:"):].lstrip("/") if root.startswith("file:") else root
    indices, buckets = (None if x is None else set(x) for x in (indices, buckets))
    remote = _fs(root)
    if remote is not None:
        return _discover_remote(root, *remote, indices, buckets)
    if not os.path.isdir(root):
        raise FileNotFoundError(f"Frozen root not found: {root}")
    out = []
    for idx in sorted(os.listdir(root)):
        if indices is not None and idx not in indices:
            continue
        ip = os.path.join(root, idx)
        if not os.path.isdir(ip):
            continue
        for b in sorted(os.listdir(ip)):
            if buckets is not None and b not in buckets:
                continue
            m = BUCKET_DIR.match(b)
            j = os.path.join(ip, b, "rawdata", "journal.zst")
            if m and os.path.isdir(os.path.join(ip, b)) and os.path.isfile(j):
                out.append((idx, b, int(m.group(1)), int(m.group(2)), int(m.group(3)), j, os.path.getsize(j)))
    return out


def _discover_remote(root: str, fs, base: str, indices=None, buckets=None):
    import pyarrow.fs as pafs

    out = []
    base = base.rstrip("/")
    prefix = root[: len(root) - len(base)] if root.rstrip("/").endswith(base) else root.split("://", 1)[0] + "://"
    if indices is None:
        selectors = [pafs.FileSelector(base, recursive=True)]
    else:
        selectors = [pafs.FileSelector(f"{base}/{i}", recursive=True, allow_not_found=True) for i in sorted(indices)]
    for sel in selectors:
        for info in fs.get_file_info(sel):
            parts = info.path.rstrip("/").split("/")
            if info.type != pafs.FileType.File or len(parts) < 4 or parts[-2:] != ["rawdata", "journal.zst"]:
                continue
            rel = info.path[len(base):].strip("/").split("/")
            m = BUCKET_DIR.match(parts[-3])
            if len(rel) == 4 and m and (buckets is None or parts[-3] in buckets):
                out.append((parts[-4], parts[-3], int(m.group(1)), int(m.group(2)), int(m.group(3)),
                            prefix + info.path, info.size))
    return sorted(out)


class JournalPartition(InputPartition):
    def __init__(self, journals):
        super().__init__(journals)
        self.journals = journals


class FrozenJournalSource(DataSource):
    @classmethod
    def name(cls):
        return "frozen_journal"

    def schema(self):
        options = {k.lower(): v for k, v in self.options.items()}
        if options.get("emit", "events").lower() == "ops":
            return OPS_SCHEMA
        kept = _kept(options)
        return EVENT_SCHEMA if kept is None else ", ".join(f"{n} {t}" for n, t in EVENT_COLUMNS.items() if n in kept)

    def reader(self, schema):
        opts = dict(self.options)
        pushdown = {k.lower(): v for k, v in opts.items()}.get("pushdown", "false").lower() == "true"
        return (PushdownJournalReader if pushdown else FrozenJournalReader)(opts)


def _kept(options: dict) -> set | None:
    """Event columns of the ``columns`` option (None: all); unknown names are an error."""
    kept = _csv(options.get("columns"))
    if kept is not None and not kept <= set(EVENT_COLUMNS):
        raise ValueError(f"no such event columns: {sorted(kept - set(EVENT_COLUMNS))}")
    return kept


def _csv(v):
    """Names of a comma list; None (no filter) if the option is not given.  An empty set keeps nothing."""
    return None if v is None else {x for x in v.split(",") if x}


class FrozenJournalReader(DataSourceReader):
    def __init__(self, options: dict):
        options = {k.lower(): v for k, v in options.items()}
        self.options = options
        self.emit = options.get("emit", "events").lower()
        self.skip_metadata = options.get("skipmetadata", "true").lower() == "true"
        self.mode = options.get("mode", "FAILFAST").upper()
        self.columns = _kept(options)
        self.target_bytes = int(options.get("maxpartitionbytes", 64 << 20))
        self.keep = {"index_name": _csv(options.get("indices")), "bucket_name": _csv(options.get("buckets"))}

    def _journals(self):
        if "paths" in self.options or "pathsdir" in self.options:
            listed = json.loads(self.options["paths"]) if "paths" in self.options else _read_paths_dir(
                self.options["pathsdir"])
            rows = []
            for line in listed:
                p, _, size = line.partition("\t")  # a listing that knows the length passes it along
                parts = p.rstrip("/").split("/")
                m = BUCKET_DIR.match(parts[-3]) if len(parts) > 3 else None
                if m is None:
                    raise ValueError(f"not a bucket's journal: {p}")
                rows.append((parts[-4], parts[-3], int(m.group(1)), int(m.group(2)), int(m.group(3)), p,
                             int(size) if size else _size_of(p)))
        else:
            rows = discover(self.options["path"], self.keep["index_name"], self.keep["bucket_name"])
        for at, keep in ((0, self.keep["index_name"]), (1, self.keep["bucket_name"])):
            rows = rows if keep is None else [r for r in rows if r[at] in keep]
        return sorted(rows, key=lambda r: -r[6])

    def partitions(self):
        """Largest-first onto the least-loaded partition (LPT, O(n log k)).

        k = max(``minPartitions``, total / ``maxPartitionBytes``): big journals
        end up alone, small ones share; partitions are returned largest first.
        """
        import heapq

        journals = self._journals()
        if not journals:
            return [JournalPartition([])]
        total = sum(r[6] for r in journals)
        k = max(1, min(len(journals), max(int(self.options.get("minpartitions", 16)),
                                           -(-total // max(1, self.target_bytes)))))
        heap = [(0, i) for i in range(k)]
        bins: list[list] = [[] for _ in range(k)]
        for r in journals:
            used, i = heapq.heappop(heap)
            bins[i].append(r)
            heapq.heappush(heap, (used + max(r[6], 1), i))
        bins = [b for b in bins if b]
        bins.sort(key=lambda b: -b[0][6])
        return [JournalPartition(b) for b in bins]

    def read(self, partition):
        for j in partition.journals:
            yield from read_journal(j, self.emit, self.skip_metadata, self.mode, self.columns)


def _read_paths_dir(d: str) -> list[str]:
    """Journal paths from the text files of a directory written by Spark (one path per line)."""
    remote = _fs(d)
    out: list[str] = []
    if remote is None:
        d = d[len("file:"):] if d.startswith("file:") else d
        names = sorted(f for f in os.listdir(d) if not f.startswith((".", "_")))
        for f in names:
            with open(os.path.join(d, f), encoding="utf-8") as fh:
                out.extend(line.strip() for line in fh if line.strip())
        return out
    import pyarrow.fs as pafs

    fs, base = remote
    for info in fs.get_file_info(pafs.FileSelector(base)):
        name = info.path.rsplit("/", 1)[-1]
        if info.type == pafs.FileType.File and not name.startswith((".", "_")):
            with fs.open_input_stream(info.path, compression=None) as fh:
                out.extend(line.strip() for line in fh.read().decode("utf-8").splitlines() if line.strip())
    return out


def _size_of(p: str) -> int:
    remote = _fs(p)
    if remote is None:
        q = p[len("file:"):] if p.startswith("file:") else p
        return os.path.getsize(q) if os.path.exists(q) else 0
    fs, inner = remote
    return fs.get_file_info(inner).size or 0


class PushdownJournalReader(FrozenJournalReader):
    """Reader that also takes ``index_name`` / ``bucket_name`` ``=`` and ``IN`` filters.

    Spark refuses a Python source implementing ``pushFilters`` unless
    ``spark.sql.python.filterPushdown.enabled`` is true, so this class is used only
    when ``read()`` finds that setting on (option ``pushdown=true``).
    """

    def pushFilters(self, filters):
        for f in filters:
            # a negation holds another filter and no attribute: Spark applies it after the scan
            name = getattr(f, "attribute", ())
            col = name[0] if len(name) == 1 else None
            if col in self.keep and isinstance(f, EqualTo):
                vals = {f.value}
            elif col in self.keep and isinstance(f, In):
                vals = set(f.value)
            else:
                yield f
                continue
            self.keep[col] = vals if self.keep[col] is None else self.keep[col] & vals


def _open(path: str):
    path = path[len("file:"):] if path.startswith("file:") else path
    remote = _fs(path)
    if remote is None:
        return open(path, "rb")
    fs, inner = remote
    # raw bytes: pyarrow would otherwise decompress ".zst" by extension before our zstd reader
    return fs.open_input_stream(inner, compression=None)


def _chunks(path: str):
    import zstandard

    with _open(path) as fh:
        reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
        while True:
            c = reader.read(1 << 22)
            if not c:
                return
            yield c


def read_journal(j, emit: str, skip_metadata: bool, mode: str, columns: set | None = None):
    import pyarrow as pa

    from thawline.sources import journal_codec as J

    idx, bucket, latest, earliest, _seq, path, _size = j
    schema = _arrow_schema(emit)
    kept = schema if columns is None else pa.schema([f for f in schema if f.name in columns])
    rows: list[tuple] = []
    bad: dict = {}
    held = 0

    def flush_ops():
        cols = list(zip(*rows))
        batch = pa.RecordBatch.from_arrays([pa.array(list(c), type=schema.field(i).type) for i, c in enumerate(cols)],
                                           schema=schema)
        rows.clear()
        return batch

    def flush_events():
        # decoded tuples transposed once; per-journal constants repeated by Arrow, not Python
        n = len(rows)
        (ordn, it, et, msg, host, src, st, sid, off, sub, hh, h, punct, fields, errs) = (
            list(c) for c in zip(*rows)) if n else ([],) * 15
        constant = {"journal_path": path, "index_name": idx, "bucket_name": bucket, "bucket_latest": latest, "bucket_earliest": earliest}
        values = {"event_ordinal": ordn, "index_time": it, "event_time_ms": et, "message": msg, "host": host, "source": src,
                  "sourcetype": st, "stream_offset": off, "stream_sub_offset": sub, "has_hash": hh, "hash": h,
                  "include_punctuation": punct, "extraction_errors": errs}

        def array(f):
            if f.name in constant:
                return pa.repeat(pa.scalar(constant[f.name], f.type), n)
            if f.name == "stream_id":
                return pa.array(sid, pa.uint64()).cast(f.type)
            if f.name == "fields":
                return pa.array([None if x is None else list(x.items()) for x in fields], f.type)
            return pa.nulls(n, f.type) if f.name == "_corrupt_reason" else pa.array(values[f.name], f.type)

        rows.clear()
        return pa.RecordBatch.from_arrays([array(f) for f in kept], schema=kept)

    try:
        if emit == "ops":
            for o, op, pl in J.decode_ops(_chunks(path), skip_metadata):
                row = _op_row(path, idx, bucket, o, op, pl, J)
                rows.append(row)
                held += len(row[17] or b"") + len(row[5] or "")
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    held = 0
                    yield flush_ops()
        else:
            for e in J.decode_events(_chunks(path), skip_metadata):
                rows.append(e)
                held += len(e[3])
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    held = 0
                    yield flush_events()
    except Exception as exc:  # noqa: BLE001
        if mode != "PERMISSIVE":
            raise RuntimeError(f"Journal decode error in {path}: {exc}") from exc
        bad = {"journal_path": path, "index_name": idx, "bucket_name": bucket, "_corrupt_reason": f"{type(exc).__name__}: {exc}"}
    if rows:
        yield flush_ops() if emit == "ops" else flush_events()
    if bad:
        yield pa.RecordBatch.from_arrays([pa.array([bad.get(f.name)], f.type) for f in kept], schema=kept)


def _op_row(path, idx, bucket, o, op, pl, J):
    text = sh = ss = sst = bet = bit = sid = off = sub = diff = tsub = meta = msg = blen = None
    if J.is_event(op):
        _ext, _hh, _h, sid, off, sub, diff, tsub, m, _n, msg = pl
        meta = None if m is None else [{"key": k, "value": v} for k, v in m]
    elif op in (J.NEW_HOST, J.NEW_SOURCE, J.NEW_SOURCETYPE, J.NEW_STRING):
        text = J.text(pl)
    elif 17 <= op <= 31:
        sh, ss, sst, bet = pl
    elif op == J.HEADER:
        bit = pl[1]
    elif op in (J.PRIVATE, J.DELETE, J.HASH_SLICE):
        blen = pl
    return (path, idx, bucket, o, op, text, sh, ss, sst, bet, bit, sid, off, sub, diff, tsub, meta, msg, blen, None)


_SCHEMAS = {}


def _arrow_schema(emit: str):
    import pyarrow as pa

    if emit in _SCHEMAS:
        return _SCHEMAS[emit]
    s, i64, b, bo, i32 = pa.string(), pa.int64(), pa.binary(), pa.bool_(), pa.int32()
    dec = pa.decimal128(20, 0)
    if emit == "ops":
        fields = [("journal_path", s), ("index_name", s), ("bucket_name", s), ("ord", i64), ("opcode", i32),
                  ("text", s), ("state_host", i64), ("state_source", i64), ("state_sourcetype", i64),
                  ("base_event_time", i32), ("base_index_time", i32), ("stream_id", dec), ("stream_offset", i64),
                  ("stream_sub_offset", i64), ("index_time_diff", i64), ("time_sub_raw", i64),
                  ("meta", pa.list_(pa.struct([("key", i64), ("value", i64)]))), ("message", b),
                  ("block_length", i64), ("_corrupt_reason", s)]
    else:
        fields = [("journal_path", s), ("index_name", s), ("bucket_name", s), ("bucket_latest", i64),
                  ("bucket_earliest", i64), ("event_ordinal", i64), ("index_time", i64), ("event_time_ms", i64),
                  ("message", b), ("host", s), ("source", s), ("sourcetype", s), ("stream_id", dec),
                  ("stream_offset", i64), ("stream_sub_offset", i64), ("has_hash", bo), ("hash", b),
                  ("include_punctuation", bo), ("fields", pa.map_(s, pa.list_(s))),
                  ("extraction_errors", pa.list_(s)), ("_corrupt_reason", s)]
    _SCHEMAS[emit] = pa.schema(fields)
    return _SCHEMAS[emit]


def register(spark) -> None:
    from thawline.session import ship_package

    ship_package(spark)
    spark.dataSource.register(FrozenJournalSource)


def read(spark, root: str | None = None, **options):
    """``spark.read.format('frozen_journal')`` with the source registered."""
    register(spark)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false").lower() == "true"
    r = (spark.read.format("frozen_journal").option("minPartitions", 2 * spark.sparkContext.defaultParallelism)
         .option("pushdown", str(pushdown).lower()))
    if root is not None:
        r = r.option("path", root)
    for k, v in options.items():
        r = r.option(k, v if isinstance(v, str) else json.dumps(v) if isinstance(v, (list, dict)) else str(v).lower())
    return r.load()
