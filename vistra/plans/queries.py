"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Each query reads the driver's tables (through ``vistra.fixtures``) in full and
builds one lazy plan; queries that exercise files write their inputs to a
fresh folder under the shared checkpoint directory first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vistra import fixtures
from vistra.functions.dates import period_label
from vistra.operators import aggregate, charts, clean, quality, window
from vistra.operators.join import observe_keys, observed_keys, visits_person_left
from vistra.operators import candidates as C
from vistra.plans import search
from vistra.plans import visits as job
from vistra.schema import NA_TOKENS
from vistra.session import scratch_path
from vistra.sources.csv import VisitFile, malformed_rows, read_person_csv, read_visits_csv, write_csv
from vistra.sources.encoding import read_groups
from vistra.sources.manifest import input_manifest, manifest_total
from vistra.sources.metrics import metrics_table, read_metrics
from vistra.sources.parquet import read_parquet, write_parquet

Query = Callable[[SparkSession, str], DataFrame]

# Averages are rounded to 6 digits in every registered result: sums of floats
# depend on the order of addition, which differs between engines.
AVG_DIGITS = 6


def _round(df: DataFrame, *cols: str, digits: int = AVG_DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def clean_of(spark: SparkSession, sf_dir: str, missing_end: bool = False) -> DataFrame:
    return clean.clean_visits(fixtures.visits_raw(spark, sf_dir, missing_end=missing_end))


def valid_of(spark: SparkSession, sf_dir: str, missing_end: bool = False) -> DataFrame:
    return clean.valid_visits(clean_of(spark, sf_dir, missing_end))


def monthly_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.monthly_visits(valid_of(spark, sf_dir))


def person_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.person_dim(fixtures.person_raw(spark, sf_dir))


# --- cleaning ------------------------------------------------------------------


def q_clean_visits(spark, sf_dir):
    return clean_of(spark, sf_dir)


def q_fill_missing(spark, sf_dir):
    return clean.fill_report(clean_of(spark, sf_dir))


def q_valid_visits(spark, sf_dir):
    return valid_of(spark, sf_dir, missing_end=True)


def q_valid_visit_count(spark, sf_dir):
    return aggregate.visit_count(valid_of(spark, sf_dir, missing_end=True))


def q_person_dim(spark, sf_dir):
    return person_of(spark, sf_dir)


# --- aggregation, join, window ------------------------------------------------


def q_monthly_visits(spark, sf_dir):
    return _round(monthly_of(spark, sf_dir), "avg_duration_days")


def q_yearly_visits(spark, sf_dir):
    return aggregate.yearly_visits(valid_of(spark, sf_dir))


def q_yearly_rows(spark, sf_dir):
    return aggregate.yearly_rows(clean_of(spark, sf_dir))


def q_visits_person_left(spark, sf_dir):
    # as in the batch job the visits are written first; their heavy persons are found in that pass
    seen, path = Observation("persons"), scratch_path(spark, "visits_person_left")
    write_parquet(observe_keys(valid_of(spark, sf_dir), ["person_id"], seen), path)
    return visits_person_left(read_parquet(spark, path), person_of(spark, sf_dir), observed_keys(spark, seen))


def q_visits_by_gender(spark, sf_dir):
    return aggregate.visits_by_gender(valid_of(spark, sf_dir), person_of(spark, sf_dir))


def q_ranked_months(spark, sf_dir):
    return _round(window.ranked_months(monthly_of(spark, sf_dir)), "avg_duration_days")


def q_top_months(spark, sf_dir):
    return _round(window.top_months(monthly_of(spark, sf_dir)), "avg_duration_days")


def q_top_months_ties(spark, sf_dir):
    # Counts bucketed by 100 create ties, so years return more than 3 months.
    monthly = monthly_of(spark, sf_dir).withColumn(
        "visit_count", F.expr("visit_count div 100")
    )
    return _round(window.top_months(monthly), "avg_duration_days")


# --- chart tables, reconciliation, profile, sample ----------------------------


def q_chart_visits_per_year(spark, sf_dir):
    return charts.visits_per_year(monthly_of(spark, sf_dir))


def q_chart_mean_visits_per_month(spark, sf_dir):
    return _round(charts.mean_visits_per_month(monthly_of(spark, sf_dir)), "mean_visit_count")


def q_chart_duration_by_period(spark, sf_dir):
    return _round(charts.duration_by_period(monthly_of(spark, sf_dir)), "avg_duration_days")


def q_reconcile_yearly(spark, sf_dir):
    c = clean_of(spark, sf_dir, missing_end=True)
    return quality.reconcile(
        aggregate.yearly_rows(c),
        aggregate.yearly_visits(clean.valid_visits(c)),
        ["visit_year"],
        "visit_count",
        "all_rows",
        "valid_visits",
    )


def q_table_profile(spark, sf_dir):
    return quality.table_profile(
        {
            "visit_occurrence": fixtures.visits_raw(spark, sf_dir),
            "person": fixtures.person_raw(spark, sf_dir),
        }
    )


SAMPLE_ORDER = [
    "visit_occurrence_id",
    "visit_type_concept_id",
    "visit_concept_id",
    "person_id",
    "provider_id",
    "care_site_id",
    "visit_source_value",
    "visit_start_datetime",
    "visit_end_datetime",
]


def q_sample_rows(spark, sf_dir):
    return quality.sample_rows(
        clean_of(spark, sf_dir), 5, [F.asc_nulls_first(c) for c in SAMPLE_ORDER]
    )


# --- file boundary -------------------------------------------------------------

VISIT_FILE_NAMES = ["visit_occurrence_0.csv", "visit_occurrence_1.csv"]
PERSON_FILE_NAME = "person.csv"


def _write_visit_files(raw: DataFrame, root: str, encoding: str = "UTF-8") -> list[VisitFile]:
    """Split raw rows by id parity into a headed and a headerless CSV input.

    The headed one has its columns in reverse order and one more before them,
    so that only its names tell which is which.
    """
    even = F.coalesce(F.col("visit_occurrence_id").try_cast("bigint") % 2 == 0, F.lit(False))
    first, second = (f"{root}/{n}" for n in VISIT_FILE_NAMES)
    turned = raw.filter(even).select(F.lit("x,\"y").alias("batch"), *reversed(raw.columns))
    write_csv(turned, first, header=True, encoding=encoding, doubled_quotes=True)
    write_csv(raw.filter(~even), second, header=False, encoding=encoding, doubled_quotes=True)
    return [VisitFile(first, True), VisitFile(second, False)]


def with_quoted_values(raw: DataFrame) -> DataFrame:
    """Source values with quotes, commas and backslashes, by visit type."""
    kind, value = F.pmod(F.col("visit_type_concept_id").try_cast("bigint"), F.lit(4)), F.col("visit_source_value")
    quoted = (
        F.when(kind == 0, F.concat(F.lit('say "'), value, F.lit('", ok')))
        .when(kind == 1, F.concat(F.lit("C:\\"), value, F.lit("\\")))
        .when(kind == 2, F.concat(F.lit('"'), value, F.lit('"')))
        .otherwise(value)
    )
    return raw.withColumn("visit_source_value", quoted)


def q_csv_ingest(spark, sf_dir):
    raw = with_quoted_values(fixtures.visits_raw(spark, sf_dir))
    return clean.clean_visits(read_visits_csv(spark, _write_visit_files(raw, scratch_path(spark, "csv_ingest"))))


def q_csv_ingest_utf16(spark, sf_dir):
    raw = with_quoted_values(fixtures.visits_raw(spark, sf_dir))
    files = _write_visit_files(raw, scratch_path(spark, "csv_ingest_utf16"), encoding="UTF-16")
    return clean.clean_visits(read_visits_csv(spark, files))


def with_line_breaks(raw: DataFrame) -> DataFrame:
    """One visit type's source values go over two lines."""
    line = F.pmod(F.col("visit_type_concept_id").try_cast("bigint"), F.lit(7))
    return raw.withColumn("visit_source_value", F.when(line == 3, F.lit("two\nlines")).otherwise(F.col("visit_source_value")))


def q_malformed_rows(spark, sf_dir):
    # a value with a line break stands on two lines: both are malformed as lines
    raw = with_line_breaks(fixtures.visits_raw(spark, sf_dir))
    return malformed_rows(spark, _write_visit_files(raw, scratch_path(spark, "malformed_rows")))


def q_csv_ingest_line_breaks(spark, sf_dir):
    raw = with_line_breaks(with_quoted_values(fixtures.visits_raw(spark, sf_dir)))
    return clean.clean_visits(read_visits_csv(spark, _write_visit_files(raw, scratch_path(spark, "csv_line_breaks"))))


def q_csv_ingest_utf16_line_breaks(spark, sf_dir):
    raw = with_line_breaks(with_quoted_values(fixtures.visits_raw(spark, sf_dir)))
    files = _write_visit_files(raw, scratch_path(spark, "csv_utf16_line_breaks"), encoding="UTF-16")
    return clean.clean_visits(read_visits_csv(spark, files))


def q_dropped_rows(spark, sf_dir):
    raw = fixtures.visits_raw(spark, sf_dir, missing_end=True)
    files = _write_visit_files(raw, scratch_path(spark, "dropped_rows"))
    out = scratch_path(spark, "dropped_rows_out")
    job.ingest(spark, files, f"{out}/visits", loss_dir=f"{out}/loss")
    return read_parquet(spark, f"{out}/loss")


# Columns that receive a missing-value string where the fixture has NULL.
NA_TOKEN_COLUMNS = ["person_id", "provider_id", "care_site_id", "visit_source_value"]


def with_na_tokens(raw: DataFrame) -> DataFrame:
    """Write one of the reader's missing-value strings in place of each NULL.

    The string is chosen by a rule on the row (concept id + column index), so
    every string occurs.
    """
    tokens = F.array(*[F.lit(t) for t in NA_TOKENS])
    key = F.coalesce(F.col("visit_concept_id").try_cast("bigint"), F.lit(0))
    replaced = {
        c: F.coalesce(F.col(c), F.element_at(tokens, (F.pmod(key + i, F.lit(len(NA_TOKENS))) + 1).cast("int")))
        for i, c in enumerate(NA_TOKEN_COLUMNS)
    }
    return raw.withColumns(replaced)


def q_na_tokens(spark, sf_dir):
    raw = with_na_tokens(fixtures.visits_raw(spark, sf_dir))
    files = _write_visit_files(raw, scratch_path(spark, "na_tokens"))
    cleaned = clean.clean_visits(read_visits_csv(spark, files))
    rows = aggregate.visit_count(cleaned, "filled_rows").select(
        F.lit("clean_rows").alias("column_name"), "filled_rows"
    )
    return clean.fill_report(cleaned).unionByName(rows)


ENCODED_SETS = [("person_utf8", "UTF-8"), ("person_utf16", "UTF-16")]


def q_detect_encoding(spark, sf_dir):
    raw = fixtures.person_raw(spark, sf_dir)
    root = scratch_path(spark, "encodings")
    parts = []
    for name, encoding in ENCODED_SETS:
        write_csv(raw, f"{root}/{name}", header=True, encoding=encoding)
    for name, _ in ENCODED_SETS:
        groups = read_groups(spark, [f"{root}/{name}"])
        person = clean.person_dim(read_person_csv(spark, f"{root}/{name}", groups=groups))
        parts.append(
            person.agg(F.count(F.lit(1)).alias("person_rows")).select(
                F.lit(name).alias("file_set"),
                F.lit(",".join(sorted(enc for enc, _ in groups))).alias("encoding"),
                "person_rows",
            )
        )
    return parts[0].unionByName(parts[1])


def q_input_manifest(spark, sf_dir):
    root = scratch_path(spark, "manifest")
    # The second visit file is deliberately not written: it must show as missing.
    write_csv(fixtures.visits_raw(spark, sf_dir), f"{root}/{VISIT_FILE_NAMES[0]}", header=True)
    write_csv(fixtures.person_raw(spark, sf_dir), f"{root}/{PERSON_FILE_NAME}", header=True)
    names = [*VISIT_FILE_NAMES, PERSON_FILE_NAME]
    out = None
    for folder, path in (("data", root), ("absent", f"{root}/no-such-folder")):
        manifest = input_manifest(spark, path, names)
        total = manifest_total(manifest).select(F.lit("total").alias("file_name"), (F.col("missing") == 0).alias("present"), (F.col("total_bytes") > 0).alias("has_bytes"))
        rows = manifest.select("file_name", "present", ((F.col("size_bytes") > 0) & (F.col("n_files") > 0)).alias("has_bytes")).unionByName(total)
        rows = rows.select(F.lit(folder).alias("folder"), "file_name", "present", "has_bytes")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_parquet_round_trip(spark, sf_dir):
    path = scratch_path(spark, "visits_parquet")
    write_parquet(clean_of(spark, sf_dir), path)
    return read_parquet(spark, path)


SHUFFLE_SETTINGS = [1, 8, 16]


def q_shuffle_invariance(spark, sf_dir):
    # the raw visits are made once, under the session's own setting; the job on them runs under each
    path = scratch_path(spark, "shuffle_invariance")
    write_parquet(fixtures.visits_raw(spark, sf_dir), path)
    valid = clean.valid_visits(clean.clean_visits(read_parquet(spark, path)))
    runs = job.run_with_shuffle_settings(spark, lambda: aggregate.yearly_visits(valid), SHUFFLE_SETTINGS)
    return job.invariance_table(spark, runs, aggregate.visit_count(valid))


def q_run_metrics(spark, sf_dir):
    root = scratch_path(spark, "run")
    files = _write_visit_files(fixtures.visits_raw(spark, sf_dir), f"{root}/raw")
    person_path = f"{root}/raw/{PERSON_FILE_NAME}"
    write_csv(fixtures.person_raw(spark, sf_dir), person_path, header=True)
    # the fixture has no missing end times, so both yearly counts agree
    job.run_all(spark, files, person_path, f"{root}/out", shuffle_settings=(8, 16), strict=True)
    facts = metrics_table(read_metrics(spark, f"{root}/out/metrics"))
    # the result tables were written once per setting; the last ones must hold the whole answer
    month = period_label("visit_year", "visit_month")
    monthly = read_parquet(spark, f"{root}/out/results-16/monthly").select(F.lit("monthly").alias("section"), month.alias("item"), F.col("visit_count").alias("value"))
    top = read_parquet(spark, f"{root}/out/results-16/top_months").select(F.lit("top_month").alias("section"), month.alias("item"), F.col("month_rank").cast("bigint").alias("value"))
    return facts.unionByName(monthly).unionByName(top)


# --- evolutionary search over candidate tables -------------------------------

# One independent search per supplier row; a run's work is pop_size rows.
SEARCH_POP = 20
SEARCH_GENERATIONS = 2
SWEEP_CONFIGS = [
    {"config_id": 1, "pop_size": 10, "mutation_rate": 0.15, "sigma": 0.3},
    {"config_id": 2, "pop_size": 20, "mutation_rate": 0.15, "sigma": 0.3},
    {"config_id": 3, "pop_size": 20, "mutation_rate": 0.3, "sigma": 0.6},
]


def search_runs(spark, sf_dir, pop_size: int = SEARCH_POP):
    return C.runs_table(fixtures.load_table(spark, sf_dir, "supplier"), "s_suppkey", pop_size)


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return _round(df, *cols, digits=6)


def _scored0(spark, sf_dir):
    return C.score(C.init_population(search_runs(spark, sf_dir)))


def q_cand_init(spark, sf_dir):
    pop = C.init_population(search_runs(spark, sf_dir))
    return _r6(pop.select("run_id", "generation", "slot", "x", "y"), "x", "y")


def q_cand_score(spark, sf_dir):
    return _r6(_scored0(spark, sf_dir).select("run_id", "generation", "slot", "x", "y", "fitness"), "x", "y", "fitness")


def q_cand_tournament(spark, sf_dir):
    parents = C.tournament(_scored0(spark, sf_dir))
    cols = ["p1_x", "p1_y", "p2_x", "p2_y"]
    return _r6(parents.select("run_id", "generation", "child_slot", *cols), *cols)


def q_cand_crossover(spark, sf_dir):
    kids = C.crossover(C.tournament(_scored0(spark, sf_dir)))
    return _r6(kids.select("run_id", "generation", "child_slot", "x", "y"), "x", "y")


def q_cand_mutate(spark, sf_dir):
    kids = C.mutate(C.crossover(C.tournament(_scored0(spark, sf_dir))))
    return _r6(kids.select("run_id", "generation", "child_slot", "x", "y"), "x", "y")


def q_cand_next_generation(spark, sf_dir):
    pop = C.next_generation(_scored0(spark, sf_dir))
    return _r6(pop.select("run_id", "generation", "slot", "x", "y"), "x", "y")


def q_cand_history(spark, sf_dir):
    result = search.evolve(search_runs(spark, sf_dir), SEARCH_GENERATIONS)
    return _r6(result.history, "best_fitness")


def q_cand_best(spark, sf_dir):
    result = search.evolve(search_runs(spark, sf_dir), SEARCH_GENERATIONS)
    best = result.best.select("run_id", "config_id", "best_x", "best_y", "best_fitness")
    return _r6(best, "best_x", "best_y", "best_fitness")


def q_cand_sweep(spark, sf_dir):
    runs = C.runs_for_configs(fixtures.load_table(spark, sf_dir, "supplier"), "s_suppkey", SWEEP_CONFIGS)
    result = search.evolve(runs, SEARCH_GENERATIONS)
    return _r6(search.sweep_summary(result.best), "best_fitness", "mean_best_fitness")


QUERIES: dict[str, Query] = {
    "clean_visits": q_clean_visits,
    "fill_missing": q_fill_missing,
    "valid_visits": q_valid_visits,
    "valid_visit_count": q_valid_visit_count,
    "person_dim": q_person_dim,
    "monthly_visits": q_monthly_visits,
    "yearly_visits": q_yearly_visits,
    "yearly_rows": q_yearly_rows,
    "visits_person_left": q_visits_person_left,
    "visits_by_gender": q_visits_by_gender,
    "ranked_months": q_ranked_months,
    "top_months": q_top_months,
    "top_months_ties": q_top_months_ties,
    "chart_visits_per_year": q_chart_visits_per_year,
    "chart_mean_visits_per_month": q_chart_mean_visits_per_month,
    "chart_duration_by_period": q_chart_duration_by_period,
    "reconcile_yearly": q_reconcile_yearly,
    "table_profile": q_table_profile,
    "sample_rows": q_sample_rows,
    "csv_ingest": q_csv_ingest,
    "csv_ingest_utf16": q_csv_ingest_utf16,
    "csv_ingest_line_breaks": q_csv_ingest_line_breaks,
    "csv_ingest_utf16_line_breaks": q_csv_ingest_utf16_line_breaks,
    "dropped_rows": q_dropped_rows,
    "malformed_rows": q_malformed_rows,
    "na_tokens": q_na_tokens,
    "detect_encoding": q_detect_encoding,
    "input_manifest": q_input_manifest,
    "parquet_round_trip": q_parquet_round_trip,
    "shuffle_invariance": q_shuffle_invariance,
    "run_metrics": q_run_metrics,
    "cand_init": q_cand_init,
    "cand_score": q_cand_score,
    "cand_tournament": q_cand_tournament,
    "cand_crossover": q_cand_crossover,
    "cand_mutate": q_cand_mutate,
    "cand_next_generation": q_cand_next_generation,
    "cand_history": q_cand_history,
    "cand_best": q_cand_best,
    "cand_sweep": q_cand_sweep,
}
