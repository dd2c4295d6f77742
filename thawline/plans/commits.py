"""Commit records: an ingest attempt counts from the moment its record is in place, whatever happens to the call then.

``<out>/_commits/<attempt>.open`` is written in one step once the attempt's documents and results
are whole under their staging names.  What follows (moving the documents to their place, dropping
attempts they replace, the log and metric rows) can be repeated, so a call that ended in between
is brought to its end by the next one (``recover``); the record is then renamed to ``.done``.  A
call that ended before its record was written has done nothing but leave a staging folder, which
``recover`` drops.  ``read_documents`` joins the attempts to the records and so sees each commit
whole or not at all, also while it is being carried out.

One call at a time writes to one ``out``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thawline import storage
from thawline.sinks.documents import DOC_COLUMNS

OPEN, DONE, STAGING = ".open", ".done", "_staging-"


def staging(out: str, attempt: str) -> str:
    return f"{out}/{STAGING}{attempt}"


def results_path(out: str, attempt: str) -> str:
    return f"{out}/_commits/{attempt}-results"


def place(out: str, run: str, attempt: str) -> str:
    return f"{out}/ingest_run={run}/attempt={attempt}"


def rejects_place(out: str, run: str, attempt: str) -> str:
    return f"{out}/_rejects/ingest_run={run}/attempt={attempt}"


def write_record(spark: SparkSession, out: str, record: dict) -> None:
    """The commit itself.  ``record``: attempt, run, documents and rejects (staged folders or None), replaces, and
    what the log and metric rows need."""
    storage.write_text(spark, f"{out}/_commits/{record['attempt']}{OPEN}", json.dumps(record))


def open_records(spark: SparkSession, out: str) -> list[dict]:
    """Commits that are not carried out yet (of calls that ended early)."""
    names = [n for n in storage.children(spark, f"{out}/_commits") if n.endswith(OPEN)]
    return sorted((json.loads(storage.read_text(spark, f"{out}/_commits/{n}")) for n in names), key=lambda r: r["version"])


def put_in_place(spark: SparkSession, out: str, record: dict) -> None:
    """Documents and rejects to their names, replaced attempts away."""
    if record["documents"]:
        storage.move(spark, record["documents"], place(out, record["run"], record["attempt"]))
    if record["rejects"]:
        storage.move(spark, record["rejects"], rejects_place(out, record["run"], record["attempt"]))
    for name in record["replaces"]:
        storage.delete(spark, f"{out}/ingest_run={record['run']}/{name}")
        storage.delete(spark, f"{out}/_rejects/ingest_run={record['run']}/{name}")


def close(spark: SparkSession, out: str, record: dict) -> None:
    storage.delete(spark, staging(out, record["attempt"]))
    storage.move(spark, f"{out}/_commits/{record['attempt']}{OPEN}", f"{out}/_commits/{record['attempt']}{DONE}")


def drop_abandoned(spark: SparkSession, out: str) -> None:
    """Staging folders of calls that ended before their commit."""
    kept = {n.removesuffix(OPEN) for n in storage.children(spark, f"{out}/_commits") if n.endswith(OPEN)}
    for name in storage.children(spark, out):
        if name.startswith(STAGING) and name.removeprefix(STAGING) not in kept:
            storage.delete(spark, f"{out}/{name}")


def _attempts(spark: SparkSession, top: str) -> list[str]:
    runs = [n for n in storage.children(spark, top) if n.startswith("ingest_run=")]
    return [f"{r}/{a}" for r in runs for a in storage.children(spark, f"{top}/{r}") if a.startswith("attempt=")]


def _read(spark: SparkSession, out: str, top: str, staged: str) -> DataFrame:
    pending = open_records(spark, out)
    gone = {f"ingest_run={r['run']}/{a}" for r in pending for a in r["replaces"]}
    there = _attempts(spark, top)
    frames = []
    if paths := [f"{top}/{a}" for a in there if a not in gone]:
        frames.append(spark.read.option("basePath", top).parquet(*paths))
    for r in pending:
        if r[staged] and f"ingest_run={r['run']}/attempt={r['attempt']}" not in there:
            frames.append(spark.read.parquet(r[staged]).withColumns({"ingest_run": F.lit(r["run"]), "attempt": F.lit(r["attempt"])}))
    if not frames:
        return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in DOC_COLUMNS) + ", bucket_key string, ingest_run string, attempt string")
    rows = frames[0].withColumns({"ingest_run": F.col("ingest_run").cast("string"), "attempt": F.col("attempt").cast("string")})
    for f in frames[1:]:
        rows = rows.unionByName(f, allowMissingColumns=True)
    return rows


def read_documents(spark: SparkSession, out: str) -> DataFrame:
    """The documents of all committed attempts, each once."""
    return _read(spark, out, out, "documents")


def read_rejects(spark: SparkSession, out: str) -> DataFrame:
    """The documents that committed attempts turned away, with the reason in ``error_message``."""
    return _read(spark, out, f"{out}/_rejects", "rejects")


def drop_buckets(spark: SparkSession, folder: str, failed: DataFrame, partitions: list[str], max_records_per_file: int) -> int:
    """Take the rows of the ``failed`` buckets (bucket_key) out of a staged Parquet folder, in place.

    Only files that hold such a row are written anew; the others keep their names.  Returns the number of those files.
    """
    rows = spark.read.parquet(folder)
    schema = rows.schema
    holding = rows.select("bucket_key", F.col("_metadata.file_path").alias("file")).join(failed, "bucket_key", "left_semi").select("file").distinct()
    holding.write.parquet(f"{folder}-holding")
    n = 0
    for r in spark.read.parquet(f"{folder}-holding").toLocalIterator():
        inner = "/".join(r.file.rstrip("/").split("/")[-1 - len(partitions):])
        storage.move(spark, f"{folder}/{inner}", f"{folder}-mixed/{inner}")
        n += 1
    if n:
        mixed = spark.read.schema(schema).option("basePath", f"{folder}-mixed").parquet(f"{folder}-mixed")
        kept = mixed.join(failed, "bucket_key", "left_anti")
        kept.select(*schema.names).write.option("maxRecordsPerFile", max_records_per_file).partitionBy(*partitions).parquet(f"{folder}-rest")
        _merge(spark, f"{folder}-rest", folder, len(partitions))
    return n


def _merge(spark: SparkSession, src: str, dst: str, depth: int) -> None:
    """Move the files ``depth`` folders below ``src`` to the same folders of ``dst``."""
    for name in storage.children(spark, src):
        if name.startswith(("_", ".")):
            continue
        if depth:
            _merge(spark, f"{src}/{name}", f"{dst}/{name}", depth - 1)
        else:
            storage.move(spark, f"{src}/{name}", f"{dst}/{name}")
