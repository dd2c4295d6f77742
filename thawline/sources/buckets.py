"""Bucket listing through Spark's ``binaryFile`` source (metadata only, content never read)."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thawline import storage

from thawline.operators.runs import bucket_key, target_index

BUCKET_RE = r"^db_([0-9]+)_([0-9]+)_([0-9]+)$"


def _any_of(names) -> str:
    """Hadoop glob that matches exactly these names."""
    return "{" + ",".join(re.sub(r"([\\{}\[\]*?,^])", r"\\\1", n) for n in sorted(set(names))) + "}"


def list_buckets(spark: SparkSession, root: str, indices=None, bucket_names=None) -> DataFrame:
    """``root/<index>/db_<latest>_<earliest>_<seq>/rawdata/journal.zst`` at exactly this depth.

    The glob skips hot / replicated / deeper directories and stray files; the
    anchored regex drops look-alike names.  Only path and length are selected,
    so no journal bytes are read.  ``indices`` / ``bucket_names`` prune (S3): they are part of the
    glob, so other indices' folders are not even listed.  Empty lists list nothing.
    """
    # a bare string is one name
    indices, bucket_names = ([x] if isinstance(x, str) else x for x in (indices, bucket_names))
    index_names = None if indices is None else [n for n in indices if n and "/" not in n]
    names = None if bucket_names is None else [n for n in bucket_names if re.fullmatch(BUCKET_RE, n)]
    if not storage.exists(spark, root):
        raise FileNotFoundError(f"Frozen root not found: {root}")
    glob = "/".join([root.rstrip("/"), "*" if index_names is None else _any_of(index_names),
                     "db_*" if names is None else _any_of(names), "rawdata/journal.zst"])
    files = spark.createDataFrame([], "path STRING, length BIGINT")
    if index_names != [] and names != []:
        try:
            files = spark.read.format("binaryFile").load(glob)
        except AnalysisException as e:  # a root without such a bucket lists nothing
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    files = files.select("path", "length")
    parts = F.split(F.regexp_replace("path", "^[a-z]+:", ""), "/")
    n = F.size(parts)
    df = files.select(
        F.element_at(parts, n - 3).alias("index_name"),
        F.element_at(parts, n - 2).alias("bucket_name"),
        F.regexp_replace("path", "^file:", "").alias("journal_path"),
        F.col("length").alias("journal_size_bytes"))
    df = df.where(F.col("bucket_name").rlike(BUCKET_RE))
    return df.select(
        "index_name", "bucket_name",
        F.regexp_extract("bucket_name", BUCKET_RE, 1).cast("bigint").alias("latest_epoch"),
        F.regexp_extract("bucket_name", BUCKET_RE, 2).cast("bigint").alias("earliest_epoch"),
        F.regexp_extract("bucket_name", BUCKET_RE, 3).cast("bigint").alias("sequence"),
        "journal_path", "journal_size_bytes",
        bucket_key(F.col("index_name"), F.col("bucket_name")).alias("bucket_key"),
        target_index(F.col("index_name")).alias("target_index"),
    )
