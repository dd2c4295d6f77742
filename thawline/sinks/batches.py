"""K3 for documents in any order: a bucket's batches cut in many tasks at once.

A batch ends at the first document that brings it to ``max_docs`` documents or ``max_bytes`` bytes, so
where one ends depends on where all earlier ones did.  Within a slice of a bucket (a range of
its documents) only the first end depends on earlier slices: it lies somewhere in the slice's
first ``max_docs`` documents, and everything after it follows from it.  So

1. each slice lists, for every place where a first batch may end there, the batches and the open
   rest that follow (at most ``max_docs`` rows a slice);
2. a fold over the slices of a bucket, which reads these lists alone, gives each slice its start;
3. each slice cuts its documents from that start; the pieces of batches that cross slices are summed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thawline.operators.scan import _sliced


def _runs(batches, *columns):
    """(bucket, arrays of ``columns``) of each run of one bucket in a sorted partition."""
    import numpy as np

    key, parts = None, []
    for b in batches:
        keys = b.column("bucket_key").to_pylist()
        values = [b.column(c).to_numpy(zero_copy_only=False) for c in columns]
        at = 0
        while at < len(keys):
            end = at
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            if parts and keys[at] != key:
                yield key, [np.concatenate(x) for x in zip(*parts)]
                parts = []
            key = keys[at]
            parts.append([v[at:end] for v in values])
            at = end
    if parts:
        yield key, [np.concatenate(x) for x in zip(*parts)]


def _ends(sizes, max_docs: int, max_bytes: int):
    """Sums before each document, and for each document the last one of a batch that starts with it (n: stays open)."""
    import numpy as np

    n = len(sizes)
    sums = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    full = np.searchsorted(sums, sums[:-1] + max_bytes, side="left") - 1
    full = np.maximum(full, np.arange(n))  # a batch holds one document at least
    return sums, np.minimum(np.minimum(full, np.arange(n) + max_docs - 1), n)


def _frame(rows, names, types):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def batches_anywhere(sized: DataFrame, max_docs: int, max_bytes: int, n_slices: int | None = None) -> DataFrame:
    """(bucket_key, event_ordinal, nbytes) in any order -> (bucket_key, batch, n_docs, n_bytes).

    ``event_ordinal`` orders a bucket's documents and must be unique in it; documents without a bucket
    count as one bucket of their own, with ``bucket_key`` NULL.
    """
    if max_docs < 1 or max_bytes < 1:
        raise ValueError("batches hold one document and one byte at least")
    # joins and runs compare buckets: a missing one gets a name that no other has
    rows = sized.select(F.coalesce(F.concat(F.lit("+"), "bucket_key"), F.lit("-")).alias("bucket_key"), "event_ordinal", "nbytes")
    slices = _sliced(rows, ["bucket_key"], ["event_ordinal"], n_slices)

    def first_ends(batches):
        import pyarrow as pa

        pid = None

        def seen():
            nonlocal pid
            for b in batches:
                if b.num_rows:
                    pid = b.column("_pid")[0].as_py()
                    yield b

        for key, (sizes,) in _runs(seen(), "nbytes"):
            sums, ends = _ends(sizes, max_docs, max_bytes)
            n = len(sizes)
            # by going backwards: batches that end in the slice from each start on, and the start of the open rest
            count, rest = [0] * (n + 1), [n] * (n + 1)
            e = ends.tolist()
            for i in range(n - 1, -1, -1):
                if e[i] < n:
                    count[i], rest[i] = count[e[i] + 1] + 1, rest[e[i] + 1]
                else:
                    rest[i] = i
            total = int(sums[n])
            last = e[0] if e[0] < n else n - 1
            out = [(key, pid, p, int(sums[p + 1]), count[p + 1], n - rest[p + 1], total - int(sums[rest[p + 1]]), n, total) for p in range(last + 1)]
            i64 = pa.int64()
            yield _frame(out, ["bucket_key", "_pid", "p", "p_bytes", "more", "rest_docs", "rest_bytes", "docs", "bytes"],
                         [pa.string(), pa.int32(), *[i64] * 7])

    table = slices.select("bucket_key", "nbytes", "_pid").mapInArrow(
        first_ends, "bucket_key STRING, _pid INT, p BIGINT, p_bytes BIGINT, more BIGINT, rest_docs BIGINT, rest_bytes BIGINT, docs BIGINT, bytes BIGINT")

    def fold(pdf):
        import pandas as pd

        out, docs, size, batch = [], 0, 0, 0
        for pid, s in pdf.sort_values(["_pid", "p"]).groupby("_pid"):
            out.append((s.bucket_key.iloc[0], pid, docs, size, batch))
            hit = s[(docs + s.p + 1 >= max_docs) | (size + s.p_bytes >= max_bytes)]
            if len(hit):
                h = hit.iloc[0]
                batch, docs, size = batch + 1 + int(h.more), int(h.rest_docs), int(h.rest_bytes)
            else:
                docs, size = docs + int(s.docs.iloc[0]), size + int(s.bytes.iloc[0])
        return pd.DataFrame(out, columns=["bucket_key", "_pid", "s_docs", "s_bytes", "s_batch"])

    starts = table.groupBy("bucket_key").applyInPandas(fold, "bucket_key STRING, _pid INT, s_docs BIGINT, s_bytes BIGINT, s_batch BIGINT")
    begun = slices.join(starts, ["_pid", "bucket_key"]).select(
        "bucket_key", "event_ordinal", "nbytes", "s_docs", "s_bytes", "s_batch", "_pid")
    # a bucket's slices are ranges of its ordinals: after the join, too, a slice is whole and may be set in order
    begun = begun.sortWithinPartitions("_pid", "bucket_key", "event_ordinal")

    def cut(batches):
        import itertools

        import numpy as np
        import pyarrow as pa

        def by_slice():
            for b in batches:
                pid = b.column("_pid").to_numpy(zero_copy_only=False)
                at = [0, *(np.flatnonzero(pid[1:] != pid[:-1]) + 1).tolist(), len(pid)]
                for lo, hi in zip(at, at[1:]):
                    if hi > lo:
                        yield int(pid[lo]), b.slice(lo, hi - lo)

        for _pid, group in itertools.groupby(by_slice(), key=lambda x: x[0]):
            for key, (sizes, d0, b0, k0) in _runs((b for _, b in group), "nbytes", "s_docs", "s_bytes", "s_batch"):
                sums, ends = _ends(sizes, max_docs, max_bytes)
                n, docs, size, batch, at, out = len(sizes), int(d0[0]), int(b0[0]), int(k0[0]), 0, []
                # the batch that was open before ends where it is full
                first = min(max(max_docs - docs - 1, 0), max(int(np.searchsorted(sums, max_bytes - size, side="left")) - 1, 0))
                while at < n:
                    end = min(first if at == 0 else int(ends[at]), n - 1)
                    out.append((key, batch, end + 1 - at, int(sums[end + 1] - sums[at])))
                    batch, at = batch + 1, end + 1
                yield _frame(out, ["bucket_key", "batch", "n_docs", "n_bytes"], [pa.string(), pa.int64(), pa.int64(), pa.int64()])

    pieces = begun.mapInArrow(cut, "bucket_key STRING, batch BIGINT, n_docs BIGINT, n_bytes BIGINT")
    whole = pieces.groupBy("bucket_key", "batch").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_bytes").alias("n_bytes"))
    return whole.withColumn("bucket_key", F.when(F.col("bucket_key") != "-", F.expr("substring(bucket_key, 2)")))
