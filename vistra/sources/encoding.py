"""Encoding detection from the first two bytes of each input file.

The file list comes from Spark's ``binaryFile`` source with only ``path`` and
``length`` selected, so file contents are never loaded; then one small task
per batch of paths reads two bytes of each file through Arrow's file system
layer (local, HDFS or object stores alike). Works for files of any size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: byte-order marks that select UTF-16 -----------------------
UTF16_BOMS = (b"\xff\xfe", b"\xfe\xff")
# --- end of fixed values -------------------------------------------------------

UTF8 = "UTF-8"
UTF16 = "UTF-16"


def encoding_of_prefix(prefix: bytes) -> str:
    return UTF16 if prefix[:2] in UTF16_BOMS else UTF8


def reader_options(encoding: str) -> dict[str, str]:
    """CSV reader options for an encoding.

    UTF-16 text cannot be split at arbitrary byte offsets, so it is read with
    ``multiLine`` (one task per file); without it Spark returns garbage rows.
    """
    if encoding.upper().startswith("UTF-16"):
        return {"encoding": encoding, "multiLine": "true"}
    return {"encoding": encoding}


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, length) of every data file under the given paths, contents pruned."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(list(paths))
        .select("path", "length")
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` (file, folder or glob) exists; other errors are raised."""
    from pyspark.errors import AnalysisException

    try:
        list_files(spark, [path])
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def open_file(path: str):
    """A file opened for reading bytes, wherever it is: local, HDFS or an object store."""
    if path.startswith("file:"):
        local = path[len("file:"):]
        while local.startswith("//"):
            local = local[1:]
        return open(local, "rb")
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs as pafs

    filesystem, inner = pafs.FileSystem.from_uri(path)
    return filesystem.open_input_file(inner)


def _open_prefix(path: str, n: int = 2) -> bytes:
    with open_file(path) as f:
        return f.read(n)


def _detect_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame(
            {
                "path": pdf["path"],
                "length": pdf["length"],
                "encoding": [encoding_of_prefix(_open_prefix(p)) for p in pdf["path"]],
            }
        )


def encoding_table(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """DataFrame (path, length, encoding) over all non-empty files under ``paths``."""
    files = list_files(spark, paths).filter(F.col("length") > 0)
    return files.mapInPandas(_detect_batches, "path string, length long, encoding string")


def detect_encodings(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """path → encoding for each input file (one short row per file)."""
    return {r["path"]: r["encoding"] for r in encoding_table(spark, paths).collect()}


def _distinct_encodings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch: the distinct (root, encoding) pairs — at most a few rows."""
    for pdf in batches:
        enc = [encoding_of_prefix(_open_prefix(p)) for p in pdf["path"]]
        yield pd.DataFrame({"root": pdf["root"], "encoding": enc}).drop_duplicates()


def _rooted_listing(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    parts = [
        list_files(spark, [r]).filter(F.col("length") > 0).select(F.lit(i).alias("root"), "path")
        for i, r in enumerate(roots)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_groups_many(spark: SparkSession, roots: Sequence[str]) -> list[list[tuple[str, list[str]]]]:
    """For each root (file, folder or glob): (encoding, paths to read with it).

    One job for all roots. Each task returns only the distinct (root,
    encoding) pairs it saw, so the driver receives a few rows however many
    files there are, and a root in one encoding is read as given. Only for a
    root whose files mix encodings are that root's file paths collected (one
    short row per file, never contents).
    """
    listing = _rooted_listing(spark, roots)
    seen = listing.mapInPandas(_distinct_encodings, "root int, encoding string").collect()
    found: dict[int, set[str]] = {}
    for r in seen:
        found.setdefault(r["root"], set()).add(r["encoding"])
    mixed = sorted(i for i, encs in found.items() if len(encs) > 1)
    per_file: dict[int, dict[str, list[str]]] = {}
    if mixed:
        rows = (
            listing.filter(F.col("root").isin(mixed))
            .mapInPandas(_detect_rooted, "root int, path string, encoding string")
            .collect()
        )
        for r in rows:
            per_file.setdefault(r["root"], {}).setdefault(r["encoding"], []).append(r["path"])
    out = []
    for i, root in enumerate(roots):
        if i in per_file:
            out.append(sorted(per_file[i].items()))
        else:
            encs = found.get(i, {UTF8})
            out.append([(next(iter(encs)), [root])])
    return out


def _detect_rooted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame(
            {
                "root": pdf["root"],
                "path": pdf["path"],
                "encoding": [encoding_of_prefix(_open_prefix(p)) for p in pdf["path"]],
            }
        )


def read_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, list[str]]]:
    """How to read ``paths`` together: a list of (encoding, paths to read with it)."""
    merged: dict[str, list[str]] = {}
    for groups in read_groups_many(spark, list(paths)):
        for enc, ps in groups:
            merged.setdefault(enc, []).extend(ps)
    return sorted(merged.items())
