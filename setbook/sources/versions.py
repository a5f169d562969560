"""Tables that are replaced as a whole: versions and a pointer.

``publish`` writes a new version folder and then a pointer to it; readers
resolve the newest pointer whose version exists.  A pointer is a file named
by its number, created in one step by the file system and only after Spark
has committed the version, so a run that fails at any point leaves the
previous version as the published one.  Nothing is overwritten in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_POINTERS = "_published"
DONE = "_SUCCESS"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of every pointer, newest first; a pointer is named ``<number>=<version>``."""
    fs, at = _fs(spark, path)
    folder = at(f"{path}/{_POINTERS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    found = [n.split("=", 1) for n in names if "=" in n and not n.startswith(".")]
    return sorted(((int(n), v) for n, v in found), reverse=True)


def published(spark: SparkSession, path: str) -> str:
    """The folder of the published version (``path`` itself for a plain table)."""
    path = path.rstrip("/")
    for _, version in _pointers(spark, path):
        return f"{path}/{version}"
    return path


def write_version(df: DataFrame, path: str, partition_by=(), fmt: str = "parquet") -> str:
    """Write ``df`` as a version of the table ``path`` that nothing points to yet; returns its folder."""
    spark, path = df.sparkSession, path.rstrip("/")
    folder = f"{path}/v-{uuid.uuid4().hex}"
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(folder)
    fs, at = _fs(spark, path)
    if not fs.exists(at(f"{folder}/{DONE}")):
        raise RuntimeError(f"{folder} was not committed")
    return folder


def point_to(spark: SparkSession, path: str, folder: str, keep: int = 2) -> None:
    """Make the version ``folder`` the published one of the table ``path``.

    The newest ``keep`` versions stay for readers that have already resolved
    theirs; older ones are deleted after the new one is published.
    """
    path = path.rstrip("/")
    version = folder.rsplit("/", 1)[1]
    fs, at = _fs(spark, path)
    old = _pointers(spark, path)
    fs.mkdirs(at(f"{path}/{_POINTERS}"))
    number = old[0][0] + 1 if old else 1
    fs.create(at(f"{path}/{_POINTERS}/{number}={version}"), False).close()
    for n, v in old[keep - 1:]:
        fs.delete(at(f"{path}/{_POINTERS}/{n}={v}"), False)
        fs.delete(at(f"{path}/{v}"), True)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a version that was never published."""
    fs, at = _fs(spark, folder)
    fs.delete(at(folder), True)


def publish(df: DataFrame, path: str, partition_by=(), fmt: str = "parquet", keep: int = 2) -> str:
    """Write ``df`` as the new version of the table ``path`` and return its folder."""
    folder = write_version(df, path, partition_by, fmt)
    point_to(df.sparkSession, path, folder, keep)
    return folder
