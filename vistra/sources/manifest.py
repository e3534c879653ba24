"""Input manifest: which expected inputs exist, and how large they are."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistra.sources.encoding import list_files

BYTES_PER_GB = 1024.0**3


class MissingInputError(FileNotFoundError):
    pass


def expected_files(spark: SparkSession, data_dir: str, expected: Sequence[str]) -> DataFrame:
    """(file_name, path, length) of all files under the expected paths, contents pruned.

    One listing for all of them: a pattern of their names, which Spark's
    ``binaryFile`` source expands, many folders in parallel. Names that don't
    exist match nothing; a file belongs to each expected name that its path begins with.
    """
    nothing = spark.range(0).select(F.lit("").alias("file_name"), F.lit("").alias("path"), F.lit(0).cast("bigint").alias("length"))
    if not expected:
        return nothing
    root = data_dir.rstrip("/")
    pattern = ",".join(re.sub(r"([\\{}\[\],*?])", r"\\\1", n) for n in dict.fromkeys(expected))
    try:
        files = list_files(spark, [f"{root}/{{{pattern}}}"])
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return nothing
        raise
    bare = re.sub(r"^[A-Za-z0-9+.-]+:/*", "/", root)
    steps = F.split(F.substring_index("path", f"{bare}/", -1), "/")
    begins = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    wanted = spark.createDataFrame([(n,) for n in dict.fromkeys(expected)], "file_name string")
    return files.select("path", "length", F.explode(begins).alias("file_name")).join(wanted, "file_name").select("file_name", "path", "length")


def input_manifest(spark: SparkSession, data_dir: str, expected: Sequence[str]) -> DataFrame:
    """Rows (file_name, present, n_files, size_bytes, size_gb) per expected input.

    An input may be one file or a folder of part files (as Spark writes
    them). One that doesn't exist, or whose folder doesn't, is ``present =
    false``. An empty folder is missing too.
    """
    sizes = expected_files(spark, data_dir, expected).groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("size_bytes")
    )
    wanted = spark.createDataFrame([(n,) for n in expected], "file_name string")
    return wanted.join(sizes, "file_name", "left").select(
        "file_name",
        F.col("size_bytes").isNotNull().alias("present"),
        F.coalesce(F.col("n_files"), F.lit(0)).cast("bigint").alias("n_files"),
        F.coalesce(F.col("size_bytes"), F.lit(0)).cast("bigint").alias("size_bytes"),
        F.round(F.coalesce(F.col("size_bytes"), F.lit(0)) / BYTES_PER_GB, 2).alias("size_gb"),
    )


def manifest_total(manifest: DataFrame) -> DataFrame:
    """One row: inputs present / missing, total bytes and GB (2 digits)."""
    return manifest.agg(
        F.count_if(F.col("present")).alias("present"),
        F.count_if(~F.col("present")).alias("missing"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint").alias("total_bytes"),
    ).withColumn("total_gb", F.round(F.col("total_bytes") / BYTES_PER_GB, 2))


def require_inputs(manifest: DataFrame) -> None:
    """Fail (like the reference) when any expected input is missing."""
    missing = [r["file_name"] for r in manifest.filter(~F.col("present")).select("file_name").collect()]
    if missing:
        raise MissingInputError(f"missing inputs: {', '.join(sorted(missing))}")
