"""Helpers shared by the operators: input columns, tables written to the shared folder, hashes.

Every operator reads only the columns it names (``doc_id``, ``text`` ...), so extra columns of
the input, whatever their names, never meet its own columns.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thawline.session import checkpoint_dir, ensure_utc

U64 = np.uint64
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in Arrow batches of 4 MB, unless the session has a setting of its own.

    Spark's own 64 MB stand in an executor several times: in the JVM and in every worker.
    """
    if spark.conf.get(_BATCH_BYTES) == "67108864b":
        spark.conf.set(_BATCH_BYTES, "4m")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of a documents table; a null text is the empty text."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/thawline-llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (uint64 in, uint64 out)."""
    x = x ^ (x >> U64(30))
    x = x * _M1
    x = x ^ (x >> U64(27))
    x = x * _M2
    return x ^ (x >> U64(31))


def digest16(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


class WordHashes(dict):
    """64-bit hashes of words, computed once per distinct word; emptied when it has grown large."""

    LIMIT = 80_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


WORD_HASHES = WordHashes()


def tidy_worker() -> None:
    """Give back what earlier tasks left in this worker, to the system too, where a task needs much itself."""
    import ctypes
    import gc

    import pyarrow as pa

    WORD_HASHES.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed memory otherwise
    if trim:
        trim(0)
