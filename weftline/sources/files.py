"""Small files through Hadoop's file system, so that a path means the same on the driver and on a cluster."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def _open(path: str, spark: SparkSession | None = None):
    spark = spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    at = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return spark, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(path: str) -> bool:
    _, at, fs = _open(path)
    return fs.exists(at)


def read_text(path: str) -> str:
    spark, at, fs = _open(path)
    if not fs.exists(at):
        raise FileNotFoundError(path)
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_text(path: str, text: str) -> None:
    write_bytes(path, text.encode("utf-8"))


def write_bytes(path: str, content: bytes) -> None:
    """Written beside and renamed, so that readers see the old or the new file."""
    spark, at, fs = _open(path)
    fs.mkdirs(at.getParent())
    new = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    stream = fs.create(new, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
    fs.delete(at, False)
    if not fs.rename(new, at):
        raise OSError(f"Cannot write {path}")


def folders(path: str) -> list[str]:
    """The names of the folders in a folder, in order."""
    _, at, fs = _open(path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()) if fs.exists(at) else []


def remove(path: str) -> None:
    _, at, fs = _open(path)
    fs.delete(at, True)


_made: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that the session names in spark.checkpoint.dir, removed at exit; a local one only in local mode."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set")
        top = tempfile.mkdtemp(prefix="weftline-")
    _made.append(f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


@atexit.register
def _clean() -> None:
    session = SparkSession.getActiveSession()
    if session is None or session.sparkContext._jsc is None:
        return
    for path in _made:
        try:
            remove(path)
        except Exception:  # the JVM is ending
            return
