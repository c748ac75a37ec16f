"""Which files exist, asked of the file system the session is set up for."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def last_version(spark: SparkSession, path: str) -> int:
    """The largest n of folders ``v=n`` below a path with a commit marker; 0 without any."""
    return next(iter(versions(spark, path, "v")), 0)


def versions(spark: SparkSession, path: str, kind: str) -> Iterator[int]:
    """Each n of folders ``<kind>=n`` below a path with a commit marker, the largest first."""
    names = [n for n in child_names(spark, path) if n.startswith(f"{kind}=")]
    for number in sorted((int(n.partition("=")[2]) for n in names), reverse=True):
        if exists(spark, f"{path}/{kind}={number}/_SUCCESS"):
            yield number


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as any process of a mounted disk knows it; None on another file system."""
    fs, target = _file_system(spark, path)
    return fs.makeQualified(target).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def clear_folder(spark: SparkSession, path: str) -> None:
    """An empty folder, whatever was there."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)
    fs.mkdirs(target)


def mark_complete(spark: SparkSession, path: str) -> None:
    """The marker of a finished write."""
    fs, target = _file_system(spark, f"{path}/_SUCCESS")
    fs.create(target, True).close()
