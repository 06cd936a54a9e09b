"""Folder operations on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _open(spark, path)
    return fs.exists(location)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, location = _open(spark, path)
    return fs.exists(location) and fs.getFileStatus(location).isDirectory()


def size_in_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below a path, 0 where it does not exist."""
    fs, location = _open(spark, path)
    return fs.getContentSummary(location).getLength() if fs.exists(location) else 0


def child_folders(spark: SparkSession, path: str) -> list[str]:
    fs, location = _open(spark, path)
    if not fs.exists(location):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(location) if s.isDirectory())


def file_names(spark: SparkSession, path: str) -> set[str]:
    fs, location = _open(spark, path)
    if not fs.exists(location):
        return set()
    return {s.getPath().getName() for s in fs.listStatus(location) if s.isFile()}


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since the epoch at which a file or folder last changed."""
    fs, location = _open(spark, path)
    return fs.getFileStatus(location).getModificationTime() / 1000


def qualified(spark: SparkSession, path: str) -> str:
    """A path in full, with its file system."""
    fs, location = _open(spark, path)
    return fs.makeQualified(location).toUri().toString()


def delete(spark: SparkSession, path: str) -> bool:
    fs, location = _open(spark, path)
    return fs.delete(location, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, location = _open(spark, source)
    if not fs.rename(location, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {source} to {target}")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename, making the folders above the target."""
    fs, location = _open(spark, target)
    fs.mkdirs(location.getParent())
    rename(spark, source, target)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, location = _open(spark, path)
    if not fs.exists(location):
        return None
    stream = fs.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, location = _open(spark, path)
    stream = fs.create(location, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
