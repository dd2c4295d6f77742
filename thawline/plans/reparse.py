"""Re-parse a stored document table into a new version; readers follow a pointer that moves last."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thawline import storage
from thawline.functions.text import strip_prefix
from thawline.operators.classify import router_default_kind
from thawline.operators.parse import route_and_parse

POINTER = "_CURRENT"


def reparse(spark: SparkSession, stored_path: str, target: str) -> str:
    """Parse the documents of ``stored_path`` anew (kind from the router where none is stored).

    The new version is written under ``target`` and the pointer is replaced only after that, so
    readers see the old or the new version, never a part.  Returns the new version's path.
    """
    stored = spark.read.parquet(stored_path)
    stored = stored.withColumn("kind", router_default_kind(F.col("kind"), strip_prefix(F.col("sourcetype"))))
    version = f"{target.rstrip('/')}/version-{uuid.uuid4().hex}"
    route_and_parse(stored).write.parquet(version)
    storage.write_text(spark, f"{target.rstrip('/')}/{POINTER}", version)
    return version


def current(spark: SparkSession, target: str) -> DataFrame:
    """The version that the pointer names."""
    return spark.read.parquet(storage.read_text(spark, f"{target.rstrip('/')}/{POINTER}").strip())
