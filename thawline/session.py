"""Session helpers shared by plans, tests and the bench."""

from __future__ import annotations

import os
import re
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# All times in the archive are UTC; every plan pins the session zone so that
# formatting and zone-less parsing do not depend on the cluster default.
UTC = "UTC"


def ensure_utc(spark: SparkSession) -> SparkSession:
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and run state.

    The cluster names it in ``spark.checkpoint.dir`` (a path or URI).  Where that is unset, local
    mode gets a folder of its own; on a cluster that is an error, as its machines share no
    temporary folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="thawline-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    # in local mode Python reads and writes below the folder too: a plain path serves both
    return "/" + d[len("file:"):].lstrip("/") if d.startswith("file:") and sc.master.startswith("local") else d


_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled_methods(spark: SparkSession):
    """Plans run inside fuse no operators into a method beyond 8000 bytes of code, unless the session has a limit of its own.

    The JVM never compiles longer methods: a wide plan fused into one is interpreted row by row.
    """
    default = spark.conf.get(_METHOD_LIMIT) == "65535"
    if default:
        spark.conf.set(_METHOD_LIMIT, "8000")
    try:
        yield
    finally:
        if default:
            spark.conf.unset(_METHOD_LIMIT)


def _driver_memory() -> str:
    """Half the machine's memory, between 1 and 8 GiB (local mode runs everything in the driver)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(8, int(total / 2 / 2**30)))}g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "thawline") -> SparkSession:
    """Session for tests and the local bench (Spark UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.python.filterPushdown.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("THAWLINE_DRIVER_MEMORY", _driver_memory()))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``thawline`` importable in Python workers (data source, ``mapInPandas`` functions).

    Equivalent of ``--py-files``: the package is zipped once on the driver, whose file server hands
    it to the executors; workers put it on ``sys.path`` per task.
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    files = []
    for dp, _dn, fn in os.walk(pkg):
        for f in fn:
            if f.endswith(".py"):
                files.append(os.path.join(dp, f))
    z = os.path.join(tempfile.mkdtemp(prefix="thawline-pyfiles-"), "thawline-package.zip")
    with zipfile.ZipFile(z, "w", zipfile.ZIP_DEFLATED) as zf:
        for f in sorted(files):
            zf.write(f, os.path.relpath(f, os.path.dirname(pkg)))
    sc.addPyFile(z)  # served to the executors from here
    _SHIPPED.add(key)
