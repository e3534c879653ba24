"""Run-metrics record: one row with nested fields, written as JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: field names of the record, as in the reference -------------------
CONFIG_TYPE = T.StructType(
    [
        T.StructField("shuffle_partitions", T.IntegerType()),
        T.StructField("pipeline_seconds", T.DoubleType()),
        T.StructField("comparison_seconds", T.DoubleType()),
    ]
)

INGEST_TYPE = T.StructType(
    [
        T.StructField("pipeline_seconds", T.DoubleType()),
        T.StructField("comparison_seconds", T.DoubleType()),
    ]
)

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("pipeline", T.StringType()),
        T.StructField("data_exchange", T.StringType()),
        T.StructField("ingest", INGEST_TYPE),
        T.StructField("spark_configurations", T.ArrayType(CONFIG_TYPE)),
        T.StructField("equivalent_operation", T.StringType()),
        T.StructField("comparison_results", T.MapType(T.StringType(), T.LongType())),
        T.StructField("advanced_spark", T.MapType(T.StringType(), T.StringType())),
        T.StructField("visualizations", T.ArrayType(T.StringType())),
        T.StructField("shuffle_configurations", T.ArrayType(T.IntegerType())),
    ]
)
# --- end of fixed values -------------------------------------------------------


def metrics_record(
    yearly: DataFrame,
    ingest_seconds: float,
    configurations: Sequence[Mapping[str, float]],
    ingest_comparison_seconds: float = 0.0,
    visualizations: Sequence[str] = (),
) -> DataFrame:
    """One-row metrics DataFrame (seconds rounded to 3 digits).

    ``comparison_results`` (year → count) is built by Spark from the yearly
    table (one row per year, so bounded); timings are driver-side scalars.
    Memory deltas of the driver process are not recorded.
    """
    configs = F.array(
        *[
            F.struct(
                F.lit(int(c["shuffle_partitions"])).alias("shuffle_partitions"),
                F.lit(round(float(c["pipeline_seconds"]), 3)).alias("pipeline_seconds"),
                F.lit(round(float(c["comparison_seconds"]), 3)).alias("comparison_seconds"),
            )
            for c in configurations
        ]
    ).cast(T.ArrayType(CONFIG_TYPE))
    results = yearly.agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(
                    F.struct(F.col("visit_year").cast("string"), F.col("visit_count").cast("bigint"))
                )
            )
        ).alias("comparison_results")
    )
    return results.select(
        F.lit("visit files to result tables").alias("pipeline"),
        F.lit("one Parquet table of clean visits").alias("data_exchange"),
        F.struct(
            F.lit(round(float(ingest_seconds), 3)).alias("pipeline_seconds"),
            F.lit(round(float(ingest_comparison_seconds), 3)).alias("comparison_seconds"),
        ).alias("ingest"),
        configs.alias("spark_configurations"),
        F.lit("visits per year").alias("equivalent_operation"),
        F.col("comparison_results"),
        F.create_map(
            F.lit("join"), F.lit("visits_by_gender"),
            F.lit("window"), F.lit("top_months"),
        ).alias("advanced_spark"),
        F.array(*[F.lit(str(v)) for v in visualizations]).cast(T.ArrayType(T.StringType())).alias("visualizations"),
        F.array(*[F.lit(int(c["shuffle_partitions"])) for c in configurations])
        .cast(T.ArrayType(T.IntegerType()))
        .alias("shuffle_configurations"),
    )


def write_metrics(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def metrics_table(record: DataFrame) -> DataFrame:
    """The record's facts that don't change from run to run, as (section, item, value).

    Yearly counts, shuffle settings, chart names (the path's last part), the
    number of configurations, and how many timings are below zero or missing.
    """
    seconds = F.concat(
        F.array("ingest.pipeline_seconds", "ingest.comparison_seconds"),
        F.transform("spark_configurations", lambda c: c["pipeline_seconds"]),
        F.transform("spark_configurations", lambda c: c["comparison_seconds"]),
    )
    bad = F.size(F.filter(seconds, lambda s: s.isNull() | (s < 0)))
    one = F.lit(1).cast("bigint")
    parts = [
        record.select(F.lit("yearly").alias("section"), F.explode("comparison_results").alias("item", "value")),
        record.select(F.explode("shuffle_configurations").alias("item")).select(
            F.lit("shuffle_setting").alias("section"), F.col("item").cast("string").alias("item"), one.alias("value")
        ),
        record.select(F.lit("chart").alias("section"), F.explode("visualizations").alias("item")).select(
            "section", F.substring_index("item", "/", -1).alias("item"), one.alias("value")
        ),
        record.select(F.lit("count").alias("section"), F.lit("configurations").alias("item"), F.size("spark_configurations").cast("bigint").alias("value")),
        record.select(F.lit("count").alias("section"), F.lit("bad_seconds").alias("item"), bad.cast("bigint").alias("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(path)
