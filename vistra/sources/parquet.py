"""Parquet sink and source whose tables are replaced as a whole.

A write goes to a fresh folder under ``path/_versions``; when all of it is
there, an empty file ``path/_commit-<version>`` is made, and that is the switch:
readers take the version of the highest commit. A write that fails on its way
leaves no commit, so the table stays what it was, on stores without an atomic
rename too. The version before the current one is kept for readers that began
on it; older ones are deleted after the switch.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

VERSIONS, COMMIT = "_versions", "_commit-"


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop knows them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, place = _folder(spark, path)
    if not fs.exists(place):
        return []
    return [s.getPath().getName() for s in fs.listStatus(place)]


def versions(spark: SparkSession, path: str) -> list[str]:
    """Committed versions of a table, oldest first."""
    return sorted(n[len(COMMIT):] for n in _names(spark, path) if n.startswith(COMMIT))


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str = "snappy"
) -> None:
    """Replace the table at ``path`` with ``df`` as snappy Parquet (no index column exists)."""
    spark = df.sparkSession
    before = versions(spark, path)
    version = f"{int(before[-1].split('-')[0]) + 1 if before else 1:09d}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{VERSIONS}/{version}")
    fs, place = _folder(spark, f"{path}/{COMMIT}{version}")
    fs.create(place, False).close()
    _clear(spark, path, keep={version, *before[-1:]})


def _clear(spark: SparkSession, path: str, keep: set[str]) -> None:
    """Delete what neither the current version nor the one before it needs."""
    fs, place = _folder(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    newest = max(keep)
    for name in _names(spark, path):
        old = name[len(COMMIT):] if name.startswith(COMMIT) else None
        if name != VERSIONS and old not in keep and (old is None or old < newest):
            fs.delete(hadoop.Path(place, name), True)
    for name in _names(spark, f"{path}/{VERSIONS}"):
        if name not in keep and name < newest:
            fs.delete(hadoop.Path(place, f"{VERSIONS}/{name}"), True)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table; a folder without commits is read as it is."""
    found = versions(spark, path)
    return spark.read.parquet(f"{path}/{VERSIONS}/{found[-1]}" if found else path)
