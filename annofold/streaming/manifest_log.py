"""Versions of a manifest, each committed by one rename. Id: DOM-19.

A version is a folder of Parquet below the log's path. It is written under a hidden name and
renamed when it is whole, so readers see a version entirely or not at all; what a killed writer
leaves has a hidden name and is never read. One writer at a time, as a stream has.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _store(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions, in order."""
    folder, store = _store(spark, path)
    if not store.exists(folder):
        return []
    names = [f.getPath().getName() for f in store.listStatus(folder)]
    return sorted(int(n.removeprefix("version-")) for n in names if n.startswith("version-"))


def commit_manifest(manifest: DataFrame, path: str, version: int) -> bool:
    """Commit ``manifest`` as ``version``; False, and nothing is done, where that is committed already."""
    spark = manifest.sparkSession
    if version in versions(spark, path):
        return False
    hidden = f"{path}/_writing-{uuid.uuid4().hex}"
    manifest.write.parquet(hidden)
    goal, store = _store(spark, f"{path}/version-{version:010d}")
    if not store.rename(_store(spark, hidden)[0], goal):
        raise OSError(f"cannot commit {goal}")
    return True


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version."""
    known = versions(spark, path)
    if not known:
        raise ValueError(f"no manifest at {path}")
    return spark.read.parquet(f"{path}/version-{known[-1]:010d}")
