"""The visit batch job, Spark-first.

Stage 1 (ingest): CSV files → clean → snappy Parquet. One plan, one action.
Stage 2 (analyse): Parquet → valid visits → monthly aggregate written once;
everything per month/year/chart is then read from that small table, so the
large table is scanned twice in total (the monthly aggregate, and the
visit → person join behind the gender summary) instead of once per report.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vistra.operators import aggregate, charts, clean, quality, window
from vistra.sources.csv import VisitFile, read_person_csv, read_visits_csv
from vistra.sources.encoding import list_files, path_exists
from vistra.sources.metrics import metrics_record, write_metrics
from vistra.sources.parquet import read_parquet, write_parquet


@dataclass
class AnalysisResult:
    valid_visits: int
    yearly: dict[int, int]
    gender: DataFrame
    top_months: DataFrame
    monthly: DataFrame
    seconds: float
    comparison_seconds: float


def ingest(
    spark: SparkSession,
    files: Sequence[VisitFile],
    out_dir: str,
    files_per_year: int | None = None,
    loss_dir: str | None = None,
) -> float:
    """CSV → clean visits → Parquet (replacing ``out_dir``). Returns seconds.

    By default the table is written as the input splits come (no shuffle).
    ``files_per_year=k`` writes it partitioned by ``visit_year`` for
    partition pruning: rows are first shuffled on (year, hash(row) mod k), so
    each year lands in about k files however the input was split, and a year
    holding a third of all visits is still written by k tasks. ``loss_dir``
    receives what the cleaning dropped and why, counted in the same pass.
    """
    t0 = time.perf_counter()
    loss = Observation("loss") if loss_dir else None
    visits = clean.clean_visits(read_visits_csv(spark, files), loss)
    if files_per_year:
        salt = F.pmod(
            F.xxhash64("visit_occurrence_id", "visit_start_datetime", "visit_type_concept_id"),
            F.lit(int(files_per_year)),
        )
        visits = visits.repartition("visit_year", salt)
        write_parquet(visits, out_dir, partition_by=["visit_year"])
    else:
        write_parquet(visits, out_dir)
    if loss:
        write_parquet(clean.loss_report(loss, visits), loss_dir)
    return time.perf_counter() - t0


def analyse(
    spark: SparkSession, visits_dir: str, person_path: str, results_dir: str
) -> AnalysisResult:
    """Monthly, gender, top months and yearly results from the clean table.

    Two passes over the large table: the monthly aggregate (written, then
    every month/year result reads that small table) and the visit → person
    join behind the gender summary (visits are counted per person first). The valid-visit total and
    the yearly counts are roll-ups of the monthly table, so they cost no scan.
    """
    t0 = time.perf_counter()
    valid = clean.valid_visits(read_parquet(spark, visits_dir))

    write_parquet(aggregate.monthly_visits(valid), f"{results_dir}/monthly")
    monthly = read_parquet(spark, f"{results_dir}/monthly")

    person = clean.person_dim(read_person_csv(spark, person_path))
    write_parquet(
        aggregate.visits_by_gender(valid, person, ordered=False), f"{results_dir}/visits_by_gender"
    )

    write_parquet(window.top_months(monthly, ordered=False), f"{results_dir}/top_months")

    c0 = time.perf_counter()
    yearly_rows = charts.visits_per_year(monthly, ordered=False).collect()
    comparison_seconds = time.perf_counter() - c0
    yearly = {int(r["visit_year"]): int(r["visit_count"]) for r in yearly_rows}

    return AnalysisResult(
        valid_visits=sum(yearly.values()),
        yearly=yearly,
        gender=read_parquet(spark, f"{results_dir}/visits_by_gender"),
        top_months=read_parquet(spark, f"{results_dir}/top_months"),
        monthly=monthly,
        seconds=time.perf_counter() - t0,
        comparison_seconds=comparison_seconds,
    )


def write_charts(spark: SparkSession, results_dir: str) -> list[str]:
    """Chart tables from the written monthly table; returns their paths."""
    monthly = read_parquet(spark, f"{results_dir}/monthly")
    paths = []
    for name, table in chart_tables(monthly).items():
        write_parquet(table, f"{results_dir}/{name}")
        paths.append(f"{results_dir}/{name}")
    return paths


def chart_tables(monthly: DataFrame, ordered: bool = False) -> dict[str, DataFrame]:
    return {
        "chart_visits_per_year": charts.visits_per_year(monthly, ordered),
        "chart_mean_visits_per_month": charts.mean_visits_per_month(monthly, ordered),
        "chart_duration_by_period": charts.duration_by_period(monthly, ordered),
    }


def yearly_from_parquet(spark: SparkSession, visits_dir: str) -> DataFrame:
    """The engines' comparison: valid visits per year from the Parquet table."""
    return aggregate.yearly_visits(clean.valid_visits(read_parquet(spark, visits_dir)))


@dataclass
class SettingRun:
    shuffle_partitions: int
    seconds: float
    rows: int
    checksum: str


def run_with_shuffle_settings(
    spark: SparkSession, job: Callable[[], DataFrame], settings: Sequence[int]
) -> list[SettingRun]:
    """Run ``job`` once per ``spark.sql.shuffle.partitions`` setting.

    Each run ends in an order-insensitive checksum computed by Spark (one row
    back to the driver). The previous setting is restored afterwards. With
    AQE on, the setting is the upper bound that AQE coalesces from.
    """
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    out = []
    try:
        for n in settings:
            spark.conf.set(key, str(int(n)))
            t0 = time.perf_counter()
            row = quality.checksum(job()).first()
            out.append(
                SettingRun(int(n), time.perf_counter() - t0, int(row["rows"]), str(row["checksum"]))
            )
    finally:
        spark.conf.set(key, previous)
    return out


def invariance_table(spark: SparkSession, runs: Sequence[SettingRun], value: DataFrame) -> DataFrame:
    """(shuffle_partitions, <value columns>, same_answer) per setting.

    ``value`` is a one-row DataFrame describing the answer (e.g. its total);
    it is joined to nothing and computed once, only extended with per-setting literals.
    """
    first = runs[0].checksum
    each = F.array(*[F.struct(F.lit(r.shuffle_partitions).alias("shuffle_partitions"), F.lit(r.checksum == first).alias("same_answer")) for r in runs])
    return value.select(*value.columns, F.inline(each)).select("shuffle_partitions", *value.columns, "same_answer")


def _has_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` (file, folder or glob) holds at least one data file."""
    return path_exists(spark, path) and bool(list_files(spark, [path]).select("path").limit(1).collect())


def run_all(
    spark: SparkSession,
    files: Sequence[VisitFile],
    person_path: str,
    out_root: str,
    shuffle_settings: Sequence[int] = (8, 16),
    strict: bool = True,
) -> DataFrame:
    """The whole job: ingest, engine-1 count, analysis per shuffle setting
    with reconciliation, chart tables, metrics record (written as JSON).

    Inputs are checked first (a missing input raises); with ``strict`` a
    yearly count that differs from the ingest-side count raises, as the
    reference does. Returns the one-row metrics DataFrame.
    """
    missing = [p for p in [f.path for f in files] + [person_path] if not _has_files(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing inputs: {', '.join(missing)}")

    visits_dir = f"{out_root}/visits"
    ingest_seconds = ingest(spark, files, visits_dir, loss_dir=f"{out_root}/loss")

    c0 = time.perf_counter()
    engine1 = aggregate.yearly_rows(read_parquet(spark, visits_dir), ordered=False)
    engine1_rows = engine1.collect()
    ingest_comparison_seconds = time.perf_counter() - c0
    engine1 = spark.createDataFrame(engine1_rows, engine1.schema)  # one row per year

    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    configs = []
    try:
        for n in shuffle_settings:
            spark.conf.set(key, str(int(n)))
            result = analyse(spark, visits_dir, person_path, f"{out_root}/results-{int(n)}")
            diff = quality.reconcile(
                engine1,
                spark.createDataFrame(sorted(result.yearly.items()), engine1.schema),
                ["visit_year"], "visit_count", "all_rows", "valid_visits",
            )
            if strict:
                quality.assert_reconciled(diff)
            configs.append(
                {
                    "shuffle_partitions": int(n),
                    "pipeline_seconds": result.seconds,
                    "comparison_seconds": result.comparison_seconds,
                }
            )
    finally:
        spark.conf.set(key, previous)

    last = f"{out_root}/results-{int(shuffle_settings[-1])}"
    charts_written = write_charts(spark, last)
    record = metrics_record(
        read_parquet(spark, f"{last}/monthly").groupBy("visit_year").agg(
            F.sum("visit_count").cast("bigint").alias("visit_count")
        ),
        ingest_seconds,
        configs,
        ingest_comparison_seconds=ingest_comparison_seconds,
        visualizations=charts_written,
    )
    write_metrics(record, f"{out_root}/metrics")
    return record
