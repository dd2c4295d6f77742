"""Files of the shared folder, local or remote: Hadoop's FileSystem on the driver, ``pyarrow.fs`` in tasks."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory; none if it does not exist."""
    fs, p = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def holds_files(spark: SparkSession, path: str, suffix: str) -> bool:
    """Whether a file of this kind is anywhere below a directory."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(suffix):
            return True
    return False


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    """Move a finished file or directory to its name; false if that name is taken."""
    fs, s = _hadoop(spark, src)
    d = spark._jvm.org.apache.hadoop.fs.Path(dst)
    if fs.exists(d):
        return False
    fs.mkdirs(d.getParent())
    return fs.rename(s, d)


def move(spark: SparkSession, src: str, dst: str) -> None:
    """Move a finished file or directory to a free name; raises where it did not get there.

    Calling it again after it was done does nothing, so a broken-off caller may repeat it.
    """
    fs, s = _hadoop(spark, src)
    d = spark._jvm.org.apache.hadoop.fs.Path(dst)
    if not fs.exists(s) and fs.exists(d):
        return
    if not rename(spark, src, dst) or fs.exists(s) or not fs.exists(d):
        raise OSError(f"could not move {src} to {dst}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or directory, if it is there; raises where it stays."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)
    if fs.exists(p):
        raise OSError(f"could not delete {path}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file: written under another name, which then takes the file's place in one step."""
    jvm = spark._jvm
    fs, p = _hadoop(spark, path)
    local = fs.getUri().getScheme() == "file"
    fs = fs.getRawFileSystem() if local else fs  # no checksum file beside it, which could not change in the same step
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if local:
        if not fs.rename(tmp, p):  # replaces the file, as POSIX does
            raise OSError(f"could not write {path}")
        return
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(tmp), fs.makeQualified(p), how)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.hadoop.thirdparty.com.google.common.io.ByteStreams.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def fingerprint(spark: SparkSession, path: str, *more: bytes) -> str:
    """Hash of a path's files (names, sizes, modification times) and ``more``: a changed input gets another one."""
    fs, p = _hadoop(spark, path)
    h = hashlib.sha1(path.encode())
    todo = [fs.getFileStatus(p)]
    while todo:
        s = todo.pop()
        if s.isDirectory():
            todo += list(fs.listStatus(s.getPath()))
        else:
            h.update(f"{s.getPath().toString()}|{s.getLen()}|{s.getModificationTime()}\n".encode())
    for m in more:
        h.update(m)
    return h.hexdigest()[:16]


def put_in_place(fs, tmp: str, path: str) -> None:
    """Give a task's finished file its name; a repeated task has written the same and only cleans up."""
    import pyarrow.fs as pafs

    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        fs.move(tmp, path)
    else:
        fs.delete_file(tmp)


def open_fs(path: str):
    """(pyarrow filesystem, path in it) of a plain path or URI, for use in tasks."""
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri("s3://" + path[len("s3a://"):] if path.startswith("s3a://") else path)
