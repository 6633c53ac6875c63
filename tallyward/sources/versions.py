"""Tables in versioned folders: a refresh becomes visible by one small file, which is written last."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

KEPT = 2  # versions that stay: the one in use, and the one before for readers that have begun


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and folder name of every version that was published, in order. A commit is the name of a file."""
    files, folder = _files(spark, path), _path(spark, path, "_commits")
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted((int(n.split("-", 1)[0]), n.split("-", 1)[1]) for n in names if n[:1].isdigit())


def current_folder(spark: SparkSession, path: str) -> str | None:
    """The folder of the version in use, or None before the first one."""
    path = path.rstrip("/")
    found = commits(spark, path)
    return f"{path}/{found[-1][1]}" if found else None


def write_version(df: DataFrame, path: str, **options: str) -> str:
    """Write a new version of the table and publish it; returns its folder.

    The rows are written to a folder of their own, which no reader looks at. Then one empty file is created whose name
    holds the next number and the folder: creating it is the publication. A failure before leaves the old version, a
    failure after leaves the new one; folders that were never published and versions older than the last ``KEPT`` are
    removed by a later refresh. ``df`` may read the table itself. Two refreshes at once both publish, and the one of the
    higher number and name is in use.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    name = f"version-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(f"{path}/{name}")
    publish(spark, path, name)
    forget(spark, path)
    return f"{path}/{name}"


def publish(spark: SparkSession, path: str, name: str) -> None:
    found = commits(spark, path)
    number = found[-1][0] + 1 if found else 1
    _files(spark, path).create(_path(spark, path, "_commits", f"{number:012d}-{name}"), False).close()


def forget(spark: SparkSession, path: str, kept: int = KEPT) -> None:
    """Remove versions beyond the last ``kept``: first the commit, then the folder."""
    files = _files(spark, path)
    for number, name in commits(spark, path)[:-kept]:
        files.delete(_path(spark, path, "_commits", f"{number:012d}-{name}"), False)
        files.delete(_path(spark, path, name), True)


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The version in use, or a table that has none: plain files below ``path``."""
    return spark.read.parquet(current_folder(spark, path) or path)
