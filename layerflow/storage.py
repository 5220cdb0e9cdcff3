"""Folders on the session's file systems: existence, small files, replacement as a whole."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders (``column=value``) below a folder; none if it is not there."""
    fs, here, _ = _fs(spark, path)
    if not fs.exists(here):
        return []
    return [f.getPath().getName() for f in fs.listStatus(here) if f.isDirectory() and "=" in f.getPath().getName()]


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the plain files directly in a folder, in order; none if it is not there."""
    fs, here, _ = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(here) if f.isFile()) if fs.exists(here) else []


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file, read without a job."""
    fs, here, _ = _fs(spark, path)
    stream = fs.open(here)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file as a whole: it is not there, or complete. A file of that name that is there raises."""
    fs, here, path_of = _fs(spark, path)
    new = path_of(here.getParent(), f".{here.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(new)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(here) or not fs.rename(new, here):
        fs.delete(new, False)
        raise OSError(f"cannot write {path}")


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, as the file system counts them."""
    fs, here, _ = _fs(spark, path)
    return int(fs.getContentSummary(here).getLength()) if fs.exists(here) else 0


def bytes_and_files(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and number of all files below a folder, or below all that a pattern names."""
    fs, here, _ = _fs(spark, path)
    found = [fs.getContentSummary(f.getPath()) for f in fs.globStatus(here) or []]
    return sum(int(f.getLength()) for f in found), sum(int(f.getFileCount()) for f in found)


def replace_folder(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Write ``df`` beside ``path``, then let it take the place: ``df`` may read ``path``, and a failed write leaves
    it as it was."""
    run = uuid.uuid4().hex
    new, old = f"{path.rstrip('/')}.new-{run}", f"{path.rstrip('/')}.old-{run}"
    df.write.parquet(new)
    fs, here, path_of = _fs(spark, path)
    if fs.exists(here):
        if not fs.rename(here, path_of(old)):
            raise OSError(f"cannot move {path} aside")
    elif here.getParent() is not None:
        fs.mkdirs(here.getParent())
    if not fs.rename(path_of(new), here):
        raise OSError(f"cannot move {new} to {path}")
    if fs.exists(path_of(old)):
        fs.delete(path_of(old), True)
    spark.catalog.refreshByPath(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, here, _ = _fs(spark, path)
    if fs.exists(here):
        fs.delete(here, True)
    spark.catalog.refreshByPath(path)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another place by one rename; a place that is taken raises."""
    fs, here, path_of = _fs(spark, path)
    there = path_of(to)
    fs.mkdirs(there.getParent())
    if fs.exists(there) or not fs.rename(here, there):
        raise OSError(f"cannot move {path} to {to}")
    spark.catalog.refreshByPath(to)
